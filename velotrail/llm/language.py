"""Language identification by interpolated Kneser-Ney character models, one for each language.

Texts are read as words (runs of letters and characters beyond ASCII, lower-cased) between three begin marks and an end
mark.  ``train`` lets Spark count the 4-grams of each language's rows and, order by order, the continuation counts, context
totals, probabilities and back-off weights of all grams that the language has, nothing left out, and stores them.  A model is
for each order the sorted hashes of its grams with their log probabilities and of its contexts with their log weights;
``score`` reads texts with it, also such as were never trained on: a gram that a model lacks is backed off, down to a floor.
The language with the lowest cross-entropy for each character is chosen.  Cross-entropies of the training rows give each
language a limit, beyond which a text is rejected.

Models are broadcast in slices of whole languages with about MODEL_ENTRIES entries (or one language).  There is one slice for
usual corpora; with more, texts are read slice by slice and the sums of a text are put together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrail.llm.spans import U64, hashes, mix, parts, per_text, runs, utf8
from velotrail.llm.tables import map_batches, small, write_out

#: Entries of the models in a slice, 12 bytes each; languages that can be told apart.
MODEL_ENTRIES, MAX_LANGUAGES = 8_000_000, 10_000
#: How sharply the score tells languages apart, by cross-entropy.
SHARPNESS = 10.0
#: A language's limit lies SPREAD times as far above the median cross-entropy of its training rows as this quantile, and at
#: least MARGIN above it; texts of n characters get SHORT / sqrt(n) more, since short ones vary more.
CALIBRATED, SPREAD, MARGIN, SHORT = 0.999, 2.0, 1.0, 8.0
UNKNOWN = "und"
ORDER = 4
BEGIN, END = "\x02", "\x03"
#: A-Z, a-z and every byte of a character beyond ASCII.
LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
TOTALS = "doc_id long, held_out boolean, lang string, row long, n_chars long, sums array<double>"
SCORED = "doc_id long, held_out boolean, lang string, row long, lang_pred string, score double, entropy double, n_chars long"


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """4-grams of the words as four 16-bit units, and the word of each."""
    text = BEGIN * 3 + (END + BEGIN * 3).join(words) + END
    unit = np.frombuffer(text.encode("utf-16-le"), np.uint16).astype(U64)
    code = (unit[:-3] << U64(48)) | (unit[1:-2] << U64(32)) | (unit[2:-1] << U64(16)) | unit[3:]
    real = unit[3:] != ord(BEGIN)
    word = np.cumsum(unit[3:] == ord(END)) - (unit[3:] == ord(END))
    return code[real], word[real]


def _distinct(data, starts, ends, word):
    """Distinct words by hash: their lower-case texts, the number of each span, and how often each occurs."""
    _, where, number, count = np.unique(word, return_index=True, return_inverse=True, return_counts=True)
    raw = data.tobytes()
    texts = b"\n".join([raw[s:e] for s, e in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]).decode()
    # Marks and other control characters cannot be part of a word; lower-casing keeps the newlines apart.
    return texts.lower().split("\n") if len(where) else [], number, count


def _counts(batches):
    for batch in batches:
        langs, column = batch.column(0).dictionary_encode(), batch.column(1)
        names = [*langs.dictionary.to_pylist(), None]
        index = langs.indices.fill_null(len(names) - 1).to_numpy(zero_copy_only=False)
        for begin, end in parts(column):
            data, at = utf8(column.slice(begin, end - begin))
            starts, ends, first = runs(data, at, LETTER)
            word = hashes(data, starts, ends)
            of = np.repeat(index[begin:end], np.diff(first))
            for lang in np.unique(of):
                own = of == lang
                words, _, count = _distinct(data, starts[own], ends[own], word[own])
                code, of_word = _grams(words)
                grams, place = np.unique(code, return_inverse=True)
                n = np.bincount(place, weights=count[of_word]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([names[lang]] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of docs (lang, text); grams of rows without language have a null lang."""
    return map_batches(docs.select("lang", "text"), _counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted hash in the sorted table, and whether it is there."""
    order = np.argsort(wanted)  # neighbours in the table are looked up one after the other
    at = np.empty(len(wanted), np.int64)
    at[order] = np.searchsorted(table, wanted[order])
    at[at == len(table)] = 0
    return at, (table[at] == wanted) if len(table) else np.zeros(len(wanted), bool)


#: One language: for each order (hashes of grams, log probabilities, hashes of contexts, log weights), and the floor.
Model = tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], float]


def log_p(model: Model, code: np.ndarray) -> np.ndarray:
    """Log probability of the last unit of each gram after the others."""
    orders, floor = model
    out, left = np.zeros(len(code)), np.arange(len(code))
    for order in range(ORDER, 0, -1):
        grams, values, contexts, weights = orders[order - 1]
        own = code[left] & U64((1 << 16 * order) - 1)
        at, there = _find(grams, mix(own))
        out[left[there]] += values[at[there]]
        left, own = left[~there], own[~there]
        if not len(left):
            return out
        at, there = _find(contexts, mix(own >> U64(16)))
        out[left[there]] += weights[at[there]]
    out[left] += floor
    return out


@dataclass
class Models:
    """``rows``: lang, kind ('gram', 'context'), size (the order), code, value, sorted, in one folder."""

    rows: DataFrame | None
    langs: list[str]
    floor: float
    #: Languages of each slice, in order of their names.
    slices: list[list[str]]

    def slice(self, k: int) -> list[Model]:
        """The models of the slice's languages."""
        if not self.slices:
            return []
        own = self.slices[k]
        number = F.array_position(F.array(*map(F.lit, own)), F.col("lang")).cast("int")
        table = self.rows.filter(F.col("lang").isin(own) & (F.col("kind") != "floor")).select(
            number.alias("lang"), (F.col("kind") == "gram").alias("gram"), "size", "code", "value").toArrow()
        of, gram, order = (table[c].to_numpy() for c in ("lang", "gram", "size"))
        code, value = table["code"].to_numpy().view(U64), table["value"].to_numpy()

        def arrays(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            hash_ = mix(code[own])
            by_hash = np.argsort(hash_)
            return hash_[by_hash], value[own][by_hash]

        return [([(*arrays((of == n) & gram & (order == k)), *arrays((of == n) & ~gram & (order == k))) for k in range(1, ORDER + 1)], self.floor)
                for n in range(1, len(own) + 1)]


def _models(rows: DataFrame, entries: int) -> Models:
    """Models of a stored table."""
    sizes = sorted((r.lang, r.n) for r in rows.filter("kind <> 'floor'").groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect())
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    slices, room = [], 0
    for name, n in sizes:
        if not slices or room + n > entries:
            slices, room = [*slices, []], 0
        slices[-1].append(name)
        room += n
    floor = rows.filter("kind = 'floor'").first()
    return Models(rows, [name for name, _ in sizes], floor.value if floor else 0.0, slices)


MODEL = "lang string, kind string, size int, code long, value float"


def load(spark: SparkSession, path: str, entries: int = MODEL_ENTRIES) -> Models:
    """Models that ``train`` wrote to ``path``."""
    return _models(spark.read.schema(MODEL).parquet(path), entries)


def _context(gram: str = "gram") -> Column:
    return F.shiftrightunsigned(gram, 16)


def train(docs: DataFrame, entries: int = MODEL_ENTRIES, path: str | None = None) -> Models:
    """docs: lang, text.  Rows without text or language are left out; ``path`` is a new folder, by default in the scratch folder.

    No join key holds more than 65,536 rows, whatever the texts: grams of a language that share a context differ in one unit,
    as do grams that share a suffix.
    """
    spark = docs.sparkSession
    orders = {ORDER: write_out(gram_counts(docs.filter("text IS NOT NULL AND lang IS NOT NULL")), "grams")}
    for k in range(ORDER - 1, 0, -1):
        # Kneser-Ney counts in how many contexts an n-gram continues.
        suffix = F.col("gram").bitwiseAND(F.lit((1 << 16 * k) - 1).cast("long"))
        orders[k] = write_out(orders[k + 1].groupBy("lang", suffix.alias("gram")).agg(F.count("*").alias("n")), "order")
    units = orders[1].select("gram").distinct().count() + 1
    floor = float(np.log(1.0 / units))
    found = spark.createDataFrame([("", "floor", 0, 0, floor)], MODEL)
    below = None
    for k in range(1, ORDER + 1):
        once, twice = (F.sum((F.col("n") == v).cast("double")) for v in (1, 2))
        share = F.least(F.greatest(once / (once + 2 * twice), F.lit(0.1)), F.lit(0.95))
        off = orders[k].groupBy("lang").agg(F.when(once > 0, share).otherwise(0.5).alias("off"))
        around = orders[k].groupBy("lang", _context().alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        around = around.join(F.broadcast(off), "lang").withColumn("weight", F.col("off") * F.col("kinds") / F.col("total"))
        both = orders[k].withColumn("context", _context()).join(around, ["lang", "context"])
        if k == 1:
            both = both.withColumn("lower", F.lit(1.0 / units))
        else:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << 16 * (k - 1)) - 1).cast("long"))
            both = both.withColumn("suffix", suffix).join(below.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower")), ["lang", "suffix"])
        p = F.greatest(F.col("n") - F.col("off"), F.lit(0.0)) / F.col("total") + F.col("weight") * F.col("lower")
        below = write_out(both.select("lang", "gram", p.alias("p")), "probabilities")
        size = F.lit(k).alias("size")
        found = found.union(below.select("lang", F.lit("gram"), size, "gram", F.log("p").cast("float")))
        found = found.union(around.select("lang", F.lit("context"), size, "context", F.log("weight").cast("float")))
    models = _models(found, entries)
    if path is None and len(models.slices) <= 1:
        return models
    # A slice is read from the files that hold its languages.
    ordered = found.repartitionByRange("lang", "kind", "size", "code").sortWithinPartitions("lang", "kind", "size", "code")
    if path is None:
        return _models(write_out(ordered, "model"), entries)
    ordered.write.parquet(path)
    return load(spark, path, entries)


def _read(column: pa.Array, models: list[Model]) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: the characters read (0 without a letter), and the sum of log probabilities by each of the models."""
    n_langs = len(models)
    sizes, sums = [np.zeros(0, np.int64)], [np.zeros((0, n_langs))]
    for begin, end in parts(column):
        own = column.slice(begin, end - begin)
        data, at = utf8(own)
        starts, ends, first = runs(data, at, LETTER)
        words, number, _ = _distinct(data, starts, ends, hashes(data, starts, ends))
        code, of = _grams(words) if words else (np.zeros(0, U64), np.zeros(0, np.int64))
        kinds, place = np.unique(code, return_inverse=True)
        length = np.bincount(of, minlength=len(words))
        each = np.zeros((len(words), n_langs))
        for j, model in enumerate(models):
            each[:, j] = np.bincount(of, weights=log_p(model, kinds)[place], minlength=len(words))
        size = per_text(np.add, length[number].astype(np.int64), first) if len(number) else np.zeros(end - begin, np.int64)
        total = np.zeros((end - begin, n_langs))
        for j in range(n_langs if len(number) else 0):
            total[:, j] = per_text(np.add, each[number, j], first)
        ascii_letter = per_text(np.maximum, LETTER[data] & (data < 128), at) if len(data) else np.zeros(end - begin, bool)
        for t in np.flatnonzero((size > 0) & ~ascii_letter):
            if not any(c.isalpha() for c in own[t].as_py() or ""):
                size[t] = 0
        sizes.append(size), sums.append(total)
    return np.concatenate(sizes), np.concatenate(sums)


def _totals(models):
    def run(batches):
        own = models.value
        for batch in batches:
            sizes, sums = _read(batch.column(4), own)
            at = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * len(own))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sizes), pa.ListArray.from_arrays(at, pa.array(sums.ravel()))],
                                             [c.split()[0] for c in TOTALS.split(", ")])

    return run


def _choose(langs: list[str]):
    def run(batches):
        for batch in batches:
            size, n = batch.column(4).to_numpy(zero_copy_only=False), batch.num_rows
            known, names, score, entropy = size > 0, [UNKNOWN] * n, np.zeros(n), np.zeros(n)
            if langs and n:
                h = -batch.column(5).flatten().to_numpy(zero_copy_only=False).reshape(n, len(langs)) / np.maximum(size, 1)[:, None]
                best, least = h.argmin(axis=1), h.min(axis=1)
                names = [langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
                score = np.where(known, 1.0 / np.exp(-SHARPNESS * (h - least[:, None])).sum(axis=1), 0.0)
                entropy = least
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(names, pa.string()), pa.array(score), pa.array(entropy, mask=~known), batch.column(4)],
                                             [c.split()[0] for c in SCORED.split(", ")])

    return run


def score(rows: DataFrame, models: Models) -> DataFrame:
    """SCORED of each of ``rows`` (doc_id, held_out, lang, row, text); the models need not have seen them."""
    broadcast = rows.sparkSession.sparkContext.broadcast
    if len(models.slices) <= 1:
        # Both steps in one function, since each Python step of a stage has a worker of its own, which stays.
        sums, choose = _totals(broadcast(models.slice(0))), _choose(models.langs)
        return write_out(map_batches(rows, lambda batches: choose(sums(batches)), SCORED), "languages")
    union = None
    for k in range(len(models.slices)):
        own_models = broadcast(models.slice(k))
        own = map_batches(rows, _totals(own_models), TOTALS).select("doc_id", "row", "n_chars", F.lit(k).alias("slice"), "sums")
        own = write_out(own.dropDuplicates(["doc_id", "row"]), "sums")
        own_models.unpersist()
        union = own if union is None else union.union(own)
    each = union.groupBy("doc_id", "row").agg(F.first("n_chars").alias("n_chars"), F.array_sort(F.collect_list(F.struct("slice", "sums"))).alias("each"))
    each = each.select(F.col("doc_id").alias("d"), F.col("row").alias("r"), "n_chars", F.flatten(F.transform("each", lambda x: x["sums"])).alias("sums"))
    plain = rows.drop("text")
    totals = plain.join(each, plain.doc_id.eqNullSafe(each.d) & (plain.row == each.r)).select(*[c.split()[0] for c in TOTALS.split(", ")])
    return write_out(map_batches(totals, _choose(models.langs), SCORED), "languages")


def held_out(id_: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 2 when divided by 4; rows without id are learned from."""
    return F.coalesce(F.crc32(F.encode(id_.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def _fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, model_entries: int):
    """SCORED of all rows, and whether each is rejected."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       F.col(lang_col).cast("string").alias("lang"), F.xxhash64(text).alias("row"), text.alias("text"))
    scored = score(rows, train(rows.filter("not held_out").select("lang", "text"), model_entries))
    learned = scored.filter("not held_out AND lang = lang_pred AND entropy IS NOT NULL").groupBy("lang").agg(
        F.percentile_approx("entropy", [0.5, CALIBRATED], 10_000).alias("at"))
    limit = F.lit(None).cast("double")
    for r in learned.collect():
        limit = F.when(F.col("lang_pred") == r.lang, r.at[0] + max(MARGIN, SPREAD * (r.at[1] - r.at[0]))).otherwise(limit)
    beyond = F.col("entropy").isNull() | F.coalesce(F.col("entropy") > limit + SHORT / F.sqrt(F.greatest("n_chars", F.lit(1))), F.lit(False))
    return scored.withColumn("rejected", beyond)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model_entries: int = MODEL_ENTRIES) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, entropy, n_chars, rejected.

    Learned from the texts and non-null languages of rows that are not held out.  ``lang_pred`` is a learned language, the
    first by name of equally good ones; ``und`` with score 0 for texts that are null or have no letter, and for all when
    nothing could be learned.  ``rejected``: ``und`` for want of letters, or beyond the language's limit.  Repeated rows count
    as often as they occur.  Other columns are not read; an empty table gives an empty result.
    """
    return _fit(docs, id_col, text_col, lang_col, model_entries).select("doc_id", "held_out", "lang_pred", "score", "entropy", "n_chars", "rejected")


def accepted_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model_entries: int = MODEL_ENTRIES) -> DataFrame:
    """The rows of ``docs`` that ``identify`` does not reject, with all their columns.

    Null texts and texts without a letter go; rows alike in id and text are judged alike, and so are rows without id.  If no
    row has a language, all go; an empty table gives an empty result.
    """
    mark = "_" * (1 + max(len(c) for c in docs.columns))  # no column has this name or one that begins with it
    rejected = write_out(_fit(docs, id_col, text_col, lang_col, model_entries).filter("rejected").select(
        F.col("doc_id").alias(f"{mark}d"), F.col("row").alias(f"{mark}r")).distinct(), "rejected")
    keys = docs.select("*", F.col(id_col).cast("long").alias(f"{mark}doc"), F.xxhash64(F.col(text_col).cast("string")).alias(f"{mark}row"))
    same = F.col(f"{mark}doc").eqNullSafe(F.col(f"{mark}d")) & (F.col(f"{mark}row") == F.col(f"{mark}r"))
    return keys.join(small(rejected, 64), same, "left_anti").select(*docs.columns)
