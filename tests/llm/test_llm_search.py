import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from brute import contamination, empty, frame, rows
from pyspark.sql import functions as F

from velotrail.llm.decontaminate import clean_documents, decontaminate
from velotrail.llm.pii import BASE as KINDS
from velotrail.llm.pii import find_private, mod97, span_list
from velotrail.llm.queries import QUERIES
from velotrail.llm.sharding import hilbert_shards

SF = "/root/testdata/sf0.001"

ITEMS = [(1, " ".join(f"w{k}" for k in range(5, 30))), (2, "Other OTHER other"), (3, None), (4, "?!"), (5, "été"), (None, "and a line"),
         (6, " ".join(f"W{k}" for k in range(10, 20))), (10, " ".join(f"w{k}" for k in range(10, 20))), (6, "other other other")]


def bench(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("slice_bytes", [8 << 20, 40])
def test_hits_equal_plain_search(spark, slice_bytes):
    data = rows()
    found = decontaminate(frame(spark, data), bench(spark, ITEMS), slice_bytes=slice_bytes)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in found.collect()), key=repr)
    want = [(r[0], *contamination(r[1], ITEMS)) for r in data]
    assert got == sorted(((*w, w[2] > 0) for w in want), key=repr)
    clean = clean_documents(frame(spark, data), bench(spark, ITEMS), slice_bytes=slice_bytes)
    assert clean.schema == frame(spark, data).schema
    assert sorted(map(repr, (r[:2] for r in clean.collect()))) == sorted(repr(r[:2]) for r, w in zip(data, want, strict=True) if not w[2])


def test_hits_of_random_texts(spark):
    """Few different words, so that blocks, shifts and windows overlap in many ways."""
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choice("a b c A".split()) + rng.choice(["", ".", "!"]) for _ in range(n))
    items = [(k, text(rng.choice((1, 2, 3, 4, 6, 9)) + 3)) for k in range(25)]
    data = [(k, text(rng.randrange(60)), None, None, 0) for k in range(300)]
    for width in (4, 6):
        got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate(frame(spark, data), bench(spark, items), width).collect()}
        assert got == {r[0]: contamination(r[1], items, width) for r in data}


def test_one_text_under_very_many_items(spark):
    """The text is searched once, its items are joined to the documents that hit it."""
    text = " ".join(f"w{k}" for k in range(80))
    items = spark.range(100_000).selectExpr("id AS item_id", f"'{text}' AS text").unionByName(spark.createDataFrame([(-1, "w5 w6 w7"), (-1, text)], "item_id long, text string"))
    data = [(1, "so w5 w6 w7 then", None, None, 0), (2, " ".join(f"w{k}" for k in range(30, 41)), None, None, 0), (3, "none", None, None, 0), (2, None, None, None, 0)]
    found = decontaminate(frame(spark, data), items).select("doc_id", "n_hit", F.size("items").alias("n"), "contaminated").collect()
    assert sorted(map(tuple, found)) == [(1, 3, 1, True), (2, 0, 0, False), (2, 11, 100_001, True), (3, 0, 0, False)]


def test_no_benchmark_and_no_documents(spark):
    assert decontaminate(frame(spark, rows()), bench(spark, [])).filter("contaminated").count() == 0
    assert decontaminate(empty(spark), bench(spark, ITEMS)).count() == 0
    assert clean_documents(empty(spark), bench(spark, ITEMS)).count() == 0


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                out.append((m.start(), number, kind, m.end()))
    return ",".join(f"{kind}:{s}:{e}" for s, _, kind, e in sorted(out))


def base_of(df):
    base = F.filter("spans", lambda x: x["kind"].isin(*KINDS))
    return sorted(((r.doc_id, r.base) for r in find_private(df).select("doc_id", span_list(base).alias("base")).collect()), key=repr)


def test_spans_equal_plain_search(spark):
    data = rows()
    assert base_of(frame(spark, data)) == sorted(((r[0], base_spans(r[1])) for r in data), key=repr)
    assert find_private(empty(spark)).count() == 0


def test_spans_of_random_and_repetitive_texts(spark):
    rng = random.Random(11)
    parts = ["a", "b.c", "@", "x@y.zz", "1", "22", "333", ".", "4.5.6.7", "1.2.3", "-", " ", "+", "(", ")", "4111 1111 1111 1111", "4111111111111111",
             "+1 555 123 4567", "é", "\U0001f600", "_", "%", "@@", "a@b", "..", ",", "256.1.1.1", "00255.1.1.1", "DE89 3704 0044 0532 0130 00", "\n", "9"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(15))) for _ in range(2000)]
    texts += ["7-" * 20_000 + "7", "a" * 50_000, "a@b" + ".c" * 20_000, "x@y.z " * 3000, "1.2.3.4 " * 5000, "1" * 60_000]
    data = [(k, t, None, None, 0) for k, t in enumerate(texts)]
    assert base_of(frame(spark, data)) == sorted(((r[0], base_spans(r[1])) for r in data), key=repr)


def test_account_numbers_and_context(spark):
    data = [(1, "GB82 WEST 1234 5698 7654 32", None, None, 0), (2, "GB82WEST12345698765433", None, None, 0),
            (3, "Bank account DE89370400440532013000 please", None, None, 0), (4, "DE89370400440532013000", None, None, 0)]
    found = {r.doc_id: r.spans for r in find_private(frame(spark, data)).collect()}
    spans = {k: [(s.kind, s.start, s.end) for s in v] for k, v in found.items()}
    assert spans == {1: [("iban", 0, 27)], 2: [], 3: [("iban", 13, 35)], 4: [("iban", 0, 22)]}
    assert found[3][0].score > found[4][0].score
    assert spark.range(1).select(mod97(F.lit("GB82WEST12345698765432"))).first()[0]


def test_account_numbers_end_where_their_country_says(spark):
    """Before a capital word, with blanks between or without; longer and shorter runs are none."""
    texts = ["DE89370400440532013000 AND more", "DE89 3704 0044 0532 0130 00 BIC COBADEFF", "DE893704004405320130001", "DE8937040044053201300",
             "XX89370400440532013000", "NO9386011117947 IS short", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "GB82WEST12345698765432GB82WEST12345698765432"]
    got = {r.doc_id: [(x.start, x.end) for x in r.spans if x.kind == "iban"] for r in find_private(frame(spark, [(k, t, None, None, 0) for k, t in enumerate(texts)])).collect()}
    assert got == {0: [(0, 22)], 1: [(0, 27)], 2: [], 3: [], 4: [], 5: [(0, 15)], 6: [(0, 38)], 7: []}


def test_context_words_are_whole(spark):
    def score(text, kind):
        (row,) = find_private(frame(spark, [(1, text, None, None, 0)])).collect()
        return next(x.score for x in row.spans if x.kind == kind)

    phone, far = "+1 555 123 4567", "x" * 39
    for text, raised in ((f"tel {phone}", True), (f"hotel {phone}", False), (f"{phone} tel", True), (f"{phone} telling", False), (f"Tel: {phone}", True),
                         (f"ho tel {'x' * 35} {phone}", True), (f"hotel {'x' * 35} {phone}", False), (f"{phone} {'x' * 35} tel", True),
                         (f"{phone} {'x' * 35} telly", False), (f"tel {far} {phone}", False), (f"\u00e9tel {phone}", False), ("relationship with 10.0.0.1", None)):
        if raised is None:
            assert score(text, "ip") == 0.6
        else:
            assert score(text, "phone") == pytest.approx(0.8 if raised else 0.7), text


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_private_query_counts_base_spans(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op10_private_spans"](spark, SF).collect():
        base = base_spans(texts[r.doc_id])
        kinds = Counter(x.split(":")[0] for x in base.split(",") if x)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in ("email", "ip", "card", "phone"))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) - {""} <= set(r.spans.split(","))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_shard_query_keeps_equal_texts_together(spark):
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op9_hilbert_shards"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    shards, groups = defaultdict(list), defaultdict(set)
    for r in got:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id]), "rows", None)
        shards[r.shard].append(r.slot)
        groups[texts[r.doc_id]].add(r.shard)
    assert set(shards) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    count = Counter(texts.values())
    copies = [len(s) == 1 for t, s in groups.items() if count[t] > 1]
    assert len(copies) >= 5 and sum(copies) >= 0.9 * len(copies)


def test_shards_of_columns_with_clashing_names(spark):
    data = [(k, str(k % 7), k % 5, k, k, k) for k in range(100)]
    df = spark.createDataFrame(data, "doc_id long, lang string, n int, __place long, __part long, __rank long")
    for law in ("rows", "bytes"):
        placed = hilbert_shards(df, ["lang", "n"], ["doc_id"], 4, law, "doc_id" if law == "bytes" else None)
        assert placed.columns == [*df.columns, "shard", "slot"]
        assert sorted((r.doc_id, r["__place"], r["__rank"]) for r in placed.collect()) == [(k, k, k) for k in range(100)]
    with pytest.raises(ValueError):
        hilbert_shards(df, ["lang", "n"], ["doc_id"], bits=32)


def test_native_plan(spark):
    df = find_private(frame(spark, rows()))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(span_list(F.expr("array()").cast(df.schema["spans"].dataType)), 256)).first()[0]
