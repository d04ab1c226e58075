"""Registered queries of this package, each with its SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrail.llm.decontaminate import decontaminate
from velotrail.llm.exact_dedup import exact_dedup
from velotrail.llm.language import identify
from velotrail.llm.line_dedup import line_dedup
from velotrail.llm.line_quality import PHRASES, line_quality
from velotrail.llm.near_dedup import near_dedup
from velotrail.llm.packing import pack
from velotrail.llm.pii import BASE, find_private, span_list
from velotrail.llm.quality import judge_quality
from velotrail.llm.sharding import hilbert_shards
from velotrail.llm.token_files import read_token_files, token_checksums, write_token_files
from velotrail.llm.variants import spelling_variants
from velotrail.llm.whitening import whiten
from velotrail.plans.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op1_exact_dedup"] = f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
  sha256({FOLDED}) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY {FOLDED})"""


@query
def op4_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    write_token_files(documents(spark, sf_dir), path)
    return token_checksums(read_token_files(spark, path))


@query
def op5_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir)).drop("ids")


@query
def op8_line_dedup(spark, sf_dir):
    return line_dedup(documents(spark, sf_dir)).drop("kept")


ORACLES["op8_line_dedup"] = f"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS position FROM documents),
keys AS (SELECT *, {FOLDED.replace("coalesce(text, '')", "trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k FROM lines),
found AS (SELECT k, max(doc_id) AS last, count(DISTINCT doc_id) AS n FROM keys WHERE length(k) >= 20 GROUP BY k),
judged AS (SELECT keys.*, coalesce(n >= 3 AND doc_id <> last, false) AS gone FROM keys LEFT JOIN found USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


@query
def op6_decontaminate(spark, sf_dir):
    found = decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLES["op6_decontaminate"] = f"""
WITH items AS (SELECT item_id, {_WORDS.format(FOLDED)} AS w FROM benchmark),
windows AS (SELECT item_id, least(len(w), 10) AS m, unnest(range(len(w) - least(len(w), 10) + 1)) AS p, w FROM items WHERE len(w) > 0),
patterns AS (SELECT DISTINCT item_id, m, array_to_string(w[p + 1 : p + m], ' ') AS pattern FROM windows),
docs AS (SELECT doc_id, {_WORDS.format(FOLDED)} AS w FROM documents),
places AS (SELECT doc_id, m, unnest(range(len(w) - m + 1)) AS p, w FROM docs, (SELECT DISTINCT m FROM patterns) WHERE len(w) >= m),
found AS (SELECT doc_id, item_id, p, m FROM (SELECT doc_id, m, p, array_to_string(w[p + 1 : p + m], ' ') AS pattern FROM places)
  JOIN patterns USING (m, pattern)),
hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS word FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""


@query
def op9_hilbert_shards(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id", "lang", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    # A cell of the checksum is the third axis: rows with equal texts lie side by side, whatever their ids and sources.
    rows = rows.withColumn("text_cell", F.col("text_crc32").cast("string"))
    placed = hilbert_shards(rows, ["lang", "size", "text_cell"], ["text_crc32", "doc_id"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def _counter(kind):
    return lambda n, x: n + F.when(x["kind"] == kind, 1).otherwise(0)


@query
def op10_private_spans(spark, sf_dir):
    found = find_private(documents(spark, sf_dir))
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    count = [F.aggregate("spans", F.lit(0).cast("long"), _counter(k)).alias(f"n_{k}") for k in (*BASE, "iban")]
    return found.select("doc_id", *count, F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"),
                        F.array_max(F.transform("spans", lambda x: x["score"])).alias("top_score"))


@query
def op2_near_dedup(spark, sf_dir):
    return near_dedup(documents(spark, sf_dir))


ORACLES["op2_near_dedup"] = f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({FOLDED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
  ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(doc_id, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, b FROM reach JOIN links ON seen = a)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(seen) AS component_id, doc_id = min(seen) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""


@query
def op7_language(spark, sf_dir):
    return identify(documents(spark, sf_dir))


@query
def op3_weak_quality(spark, sf_dir):
    return judge_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op13_line_quality(spark, sf_dir):
    return line_quality(documents(spark, sf_dir), texts=False).drop("clean_text")


_WORD = "[^\\x20\\x09-\\x0D]+"
_FAILED = {
    "punctuation": r"""n < 40 AND NOT regexp_matches(w[n], '[.!?:;"'')\]}…”’»。！？]$')""",
    "navigation": "len(list_filter(w, lambda x: x IN ('|', '>', '/', '»', '·', '•'))) >= greatest(2, n / 10.0)",
    "symbols": "10 * symbols > n",
    "shouting": r"""(upper + lower >= 10 AND 10 * upper > 6 * (upper + lower))
      OR 4 * len(list_filter(w, lambda x: regexp_matches(x, '(!!|\?\?)$'))) > n""",
    "stutter": "n >= 4 AND 2 * len(list_filter(range(2, n + 1), lambda i: w[i] = w[i - 1])) >= n",
    "boilerplate": f"regexp_matches({FOLDED.replace("coalesce(text, '')", 'line')}, '{'|'.join(PHRASES)}')",
    "repeated": "again",
}
_LATIN = "length(regexp_replace(line, '[^{}]', '', 'g'))"
ORACLES["op13_line_quality"] = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS position FROM docs),
measured AS (SELECT *, regexp_extract_all(line, '{_WORD}') AS w, {_LATIN.format('#*$%&|<>')} AS symbols, {_LATIN.format('A-ZÀ-ÖØ-Þ')} AS upper,
  {_LATIN.format('a-zß-öø-ÿ')} AS lower, row_number() OVER (PARTITION BY r, line ORDER BY position) > 1 AS again FROM lines),
sized AS (SELECT *, len(w) AS n, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS chars FROM measured),
judged AS (SELECT r, n, chars, symbols, again, {', '.join(f'n > 0 AND coalesce({sql}, false) AS failed_{rule}' for rule, sql in _FAILED.items())} FROM sized),
sums AS (SELECT r, sum(n)::BIGINT AS n_words, sum(chars)::BIGINT AS word_chars, sum(symbols)::BIGINT AS n_symbols, count(*) FILTER (WHERE n > 0 AND again) AS n_dup_lines,
  count(*) AS n_lines, count(*) FILTER (WHERE {' OR '.join(f'failed_{rule}' for rule in _FAILED)}) AS n_failed_lines,
  coalesce(sum(chars) FILTER (WHERE {' OR '.join(f'failed_{rule}' for rule in _FAILED)}), 0)::BIGINT AS lost_chars,
  {', '.join(f'count(*) FILTER (WHERE failed_{rule}) AS failed_{rule}' for rule in _FAILED)} FROM judged GROUP BY r),
words AS (SELECT r, regexp_extract_all(t, '{_WORD}') AS w FROM docs),
windows AS (SELECT r, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS key FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS p FROM words WHERE len(w) >= 3)),
repeats AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, key) AS times FROM windows) WHERE times > 1),
found AS (SELECT r, count(DISTINCT place) AS n_repeat_words FROM (SELECT r, unnest([p, p + 1, p + 2]) AS place FROM repeats) GROUP BY r),
whole AS (SELECT doc_id, sums.* EXCLUDE r, coalesce(n_repeat_words, 0) AS n_repeat_words FROM docs JOIN sums USING (r) LEFT JOIN found USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost_chars <= 50 * word_chars AS kept
FROM whole"""


@query
def op11_whitening(spark, sf_dir):
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op12_spelling_variants(spark, sf_dir):
    return spelling_variants(documents(spark, sf_dir))


# Checksums byte by byte, from the table of the usual polynomial.
_TABLE = """list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""
_BYTES = "list_transform(range(octet_length(encode({0}))), lambda k: ('0x' || substr(hex(encode({0})), 2 * k + 1, 2))::BIGINT)"
_CRC = f"xor(list_reduce(list_prepend(4294967295, {_BYTES}), lambda c, b: xor(c >> 8, t[xor(c % 256, b) + 1])), 4294967295)"
ORACLES["op12_spelling_variants"] = f"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT {_TABLE} AS t),
runs AS (SELECT doc_id, unnest(regexp_extract_all({FOLDED}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS name, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, n, {_CRC.format('name')} AS h FROM counted, crc),
spoilt AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM spoilt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words),
less AS MATERIALIZED (SELECT word, n, p, length(word) AS size, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM places),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.size = b.size AND a.p = b.p AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, w.word, w.n FROM less a JOIN words w ON a.rest = w.word
  UNION SELECT w.word, a.word, a.n FROM less a JOIN words w ON a.rest = w.word),
best AS (SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM near),
forms AS MATERIALIZED (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form,
  CASE WHEN other_n >= 10 * n THEN other_n END AS form_n FROM words LEFT JOIN best ON best.word = words.word AND place = 1),
chain(word, root) AS (SELECT word, word FROM forms UNION SELECT chain.word, form FROM chain JOIN forms ON forms.word = root WHERE form IS NOT NULL)
SELECT forms.*, root FROM forms JOIN chain USING (word) JOIN (SELECT word AS root FROM forms WHERE form IS NULL) USING (root)"""
