import re
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import empty, frame, rows
from pyspark.sql import functions as F

from velotrail.llm.language import BEGIN, END, SHARPNESS, _grams, accepted_documents, identify, load, log_p, train
from velotrail.llm.quality import estimate, judge_quality
from velotrail.llm.sharding import hilbert_index, hilbert_shards, write_shards
from velotrail.plans.scratch import scratch_path

SF = "/root/testdata/sf0.01"


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def kneser_ney(words, units):
    """P(unit | three before) of a model of these words, straight from the definition; ``units`` exist in all languages."""
    grams = Counter()
    for w in words:
        s = BEGIN * 3 + w + END
        grams.update(s[k - 3 : k + 1] for k in range(3, len(s)))
    counts = {4: grams}
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    off = {}
    for n, c in counts.items():
        one, two = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        off[n] = min(max(one / (one + 2 * two), 0.1), 0.95) if one else 0.5

    def p(gram):
        if not gram:
            return 1 / units
        c, n = counts[len(gram)], len(gram)
        total = sum(v for g, v in c.items() if g[:-1] == gram[:-1])
        if not total:
            return p(gram[1:])
        kinds = sum(g[:-1] == gram[:-1] for g in c)
        return max(c[gram] - off[n], 0) / total + off[n] * kinds / total * p(gram[1:])

    return p


TEXTS = {"x": ["Banana ban", "nab; BANANA"], "y": ["été tête", "bat"], "z": ["\U0001f600 bat", None]}


def small_docs(spark):
    return spark.createDataFrame([(lang, t) for lang, own in TEXTS.items() for t in own] + [(None, "unknown"), ("none", None)], "lang string, text string")


def plain_models():
    """P of each language, by the definition, and the words of a text."""
    def words(text):
        return [w.lower() for w in re.findall(r"[A-Za-z\u0080-\U0010ffff]+", text or "")]

    own = {lang: [w for t in texts for w in words(t)] for lang, texts in TEXTS.items()}
    def marks(w):
        return np.frombuffer(w.encode("utf-16-le"), np.uint16).tolist() + [END]

    units = len({u for ws in own.values() for w in ws for u in marks(w)}) + 1
    return {lang: kneser_ney(["".join(map(chr, np.frombuffer(w.encode("utf-16-le"), np.uint16))) for w in ws], units) for lang, ws in own.items()}, words


def test_models_equal_the_definition(spark):
    """Grams that a language has, that only others have, and that none has."""
    models, (plain, _) = train(small_docs(spark)), plain_models()
    assert models.langs == ["x", "y", "z"] and len(models.slices) == 1
    code, _ = _grams(["banana", "tab", "zé", "q", "été", "bat"])
    for name, model in zip(models.langs, models.slice(0), strict=True):
        assert all((np.diff(keys.astype(object)) > 0).all() for own in model[0] for keys in (own[0], own[2]))
        for c, got in zip(code.tolist(), log_p(model, code), strict=True):
            text = "".join(chr(c >> s & 0xFFFF) for s in (48, 32, 16, 0))
            assert got == pytest.approx(np.log(plain[name](text)), abs=1e-4), text


def test_predictions_and_scores_equal_the_definition(spark):
    """Every text is read with the models of the learned ones, word by word."""
    learned = [(k, t, lang) for k, (lang, t) in enumerate((lang, t) for lang, own in TEXTS.items() for t in own)]
    free = iter(k for k in range(1000, 2000) if zlib.crc32(str(k).encode()) % 4 != 2)
    learned = [(next(free), t, lang) for _, t, lang in learned]
    held = iter(k for k in range(2000, 3000) if zlib.crc32(str(k).encode()) % 4 == 2)
    asked = [(next(held), t, "y") for t in ("ban", "Tête-à-tête", "abba zz", "", None, "12", "bat bat nab", "\U0001f600\U0001f600")]
    got = {r.doc_id: r for r in identify(spark.createDataFrame(learned + asked, "doc_id long, text string, lang string")).collect()}
    plain, words = plain_models()
    for doc_id, text, _ in learned + asked:
        grams = ["".join(chr(c >> s & 0xFFFF) for s in (48, 32, 16, 0)) for c in (_grams(words(text))[0].tolist() if words(text) else [])]
        if not any(c.isalpha() for c in text or ""):
            assert (got[doc_id].lang_pred, got[doc_id].score) == ("und", 0.0)
            continue
        h = {lang: -sum(np.log(p(g)) for g in grams) / len(grams) for lang, p in plain.items()}
        best = min(sorted(h), key=h.get)
        assert got[doc_id].lang_pred == best and got[doc_id].n_chars == len(grams)
        assert got[doc_id].entropy == pytest.approx(h[best], abs=1e-4)
        assert got[doc_id].score == pytest.approx(1 / sum(np.exp(-SHARPNESS * (x - h[best])) for x in h.values()), abs=1e-3)


def test_stored_models_read_other_texts(spark):
    path = scratch_path(spark, "models")
    made = train(small_docs(spark), path=path)
    again = load(spark, path, entries=1)
    assert again.langs == made.langs and again.slices == [["x"], ["y"], ["z"]] and again.floor == made.floor
    code, _ = _grams(["banana", "neverseen"])
    for k, model in enumerate(made.slice(0)):
        (own,) = again.slice(k)
        assert (log_p(own, code) == log_p(model, code)).all()


def test_foreign_texts_are_rejected(spark):
    """Other languages and scripts, as long as a sentence; short ones may pass for the nearest language."""
    foreign = ["Съешь же ещё этих мягких французских булок, да выпей чаю", "いろはにほへとちりぬるをわかよたれそつねならむ", "Zażółć gęślą jaźń i pchnij w tę łódź jeża lub ośm skrzyń fig " * 3,
               "Þetta er íslenskur texti sem á ekki heima hér og er nógu langur til að þekkjast " * 3, "xkq zvw qqj jjx wvk zzq kxj qvx wwz kkq jvz xxw " * 4]
    docs = docs_of(spark).select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(10**6 + k, t, None) for k, t in enumerate(foreign)], "doc_id long, text string, lang string"))
    got = {r.doc_id: r.rejected for r in identify(docs).filter("doc_id >= 1000000").collect()}
    assert all(got.values()), got


def test_languages_of_held_out_documents(spark):
    got = identify(docs_of(spark)).join(docs_of(spark).select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.99 * len(held)
    assert not any(r.rejected for r in got)


def test_language_edges(spark):
    odd = [(10**6 + k, t, lang) for k, (t, lang) in enumerate([(None, "en"), ("", "en"), ("12 345 !?", None), ("— … —", "fr"), ("мир труд май июнь", None),
                                                              ("xqzj kvwq zzxq jjkq wvvx qqqz xxkj", None), ("The the of and", None)])]
    every = docs_of(spark).select("doc_id", "text", "lang").unionByName(spark.createDataFrame([*odd, odd[6], (None, "The of and", "en")], "doc_id long, text string, lang string"))
    got = {r.doc_id: r for r in identify(every).filter("doc_id >= 1000000 OR doc_id IS NULL").collect()}
    assert [got[10**6 + k].lang_pred for k in range(4)] == ["und"] * 4
    assert [got[10**6 + k].score for k in range(4)] == [0.0] * 4
    assert [got[10**6 + k].rejected for k in range(7)] == [True] * 6 + [False]
    assert got[10**6 + 6].lang_pred == got[None].lang_pred == "en"
    kept = accepted_documents(every)
    assert kept.schema == every.schema
    assert kept.count() == every.count() - 6


def test_language_without_training_rows(spark):
    assert identify(empty(spark)).count() == 0 and accepted_documents(empty(spark)).count() == 0
    none = frame(spark, rows()).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in identify(none).collect()} == {"und"}


def test_rare_grams_and_small_languages_stay(spark):
    """However few entries a slice may have, each language is learned, and from all its grams."""
    big = [("big", " ".join(f"{a}{b}na" for a in "bdfgk" for b in "aeiou"))] * 40
    docs = spark.createDataFrame([*big, ("small", "zwölf Boxkämpfer jagen"), (None, "Quer über zwölf banana"), ("none", None)], "lang string, text string")
    whole = train(docs)
    for entries in (10, 100, 8_000_000):
        models = train(docs, entries)
        assert models.langs == ["big", "small"] and len(models.slices) == (2 if entries < 1000 else 1)
        for k, name in enumerate(models.langs):
            (model,) = models.slice(k) if entries < 1000 else models.slice(0)[k : k + 1]
            own = {"big": big[0][1], "small": "zwölf boxkämpfer jagen"}[name]
            grams, _ = _grams(own.lower().split())
            assert len(model[0][3][0]) == len(np.unique(grams))
            np.testing.assert_allclose(log_p(model, grams), log_p(whole.slice(0)[k], grams))


def test_languages_by_slices_are_the_same(spark):
    odd = [(10**6 + k, t, lang) for k, (t, lang) in enumerate([(None, "en"), ("12 345 !?", None), ("мир труд май июнь", None), ("The the of and", None)])]
    docs = docs_of(spark).select("doc_id", "text", "lang").unionByName(spark.createDataFrame([*odd, odd[3], (None, "The of and", "en")], "doc_id long, text string, lang string"))
    whole, parts = (sorted((tuple(r) for r in identify(docs, **more).collect()), key=repr) for more in ({}, {"model_entries": 20_000}))
    assert len(whole) == len(parts) == 1006
    for a, b in zip(whole, parts, strict=True):
        assert a[:3] == b[:3] and a[5:] == b[5:] and a[3:5] == pytest.approx(b[3:5], abs=1e-9)
    kept = accepted_documents(docs, model_entries=20_000)
    assert sorted(kept.collect(), key=repr) == sorted(accepted_documents(docs).collect(), key=repr) and kept.schema == docs.schema


def test_em_finds_the_labellers_that_are_right():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.8
    accuracy = np.array([0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.65, 0.6, 0.9])
    right = rng.random((20_000, 9)) < accuracy
    votes = np.where(right == truth[:, None], 2, 0)
    votes[rng.random(votes.shape) < 0.3] = 1
    patterns, place, counts = np.unique((votes * 3 ** np.arange(9)).sum(axis=1), return_inverse=True, return_counts=True)
    prior, found, posterior = estimate(patterns, counts)
    assert prior == pytest.approx(0.8, abs=0.03)
    assert np.abs(found - accuracy).max() < 0.05
    assert ((posterior[place] > 0.5) == truth).mean() > 0.93


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = judge_quality(docs, labels).withColumnRenamed("toxic", "toxicity").join(labels, "doc_id").filter("crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2").collect()
    clean = [r for r in got if r.quality == 1 and r.toxic == 0]
    bad = [r for r in got if r.quality == 0]
    assert sum(r.kept for r in clean) >= 0.97 * len(clean)
    assert sum(r.score < 0.5 for r in bad) >= 0.75 * len(bad)
    assert sum(r.toxicity >= 0.5 for r in got if r.toxic) >= 0.5 * sum(r.toxic for r in got)


def test_quality_edges(spark):
    got = judge_quality(frame(spark, rows())).collect()
    assert len(got) == len(rows())
    blank = [r for r in got if r.doc_id in (0, 1, 2, 3)]
    assert all((r.posterior, r.score, r.toxic, r.kept) == (0, 0, 0, False) for r in blank)
    assert judge_quality(empty(spark)).count() == 0
    labels = spark.createDataFrame([(9, 1, None), (None, 0, 1), (9, 0, 0)], "doc_id long, quality int, toxic int")
    assert judge_quality(frame(spark, rows()), labels).count() == len(rows())


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(spark, dims, bits):
    grid = spark.range(1 << dims * bits)
    for k in range(dims):
        cell = F.shiftright("id", k * bits).bitwiseAND((1 << bits) - 1).cast("int")
        grid = grid.withColumns({f"a{k}": cell, f"x{k}": cell})
    cells = sorted(hilbert_index(grid, [f"x{k}" for k in range(dims)], bits, "h").select("h", *[f"a{k}" for k in range(dims)]).collect())
    assert [c.h for c in cells] == list(range(1 << dims * bits))
    assert all(sum(abs(a - b) for a, b in zip(x[1:], y[1:], strict=True)) == 1 for x, y in zip(cells, cells[1:], strict=False))


@pytest.mark.parametrize("shards", [1, 5, 24, 60])
def test_shards_have_equal_rows(spark, shards):
    data = rows() * 3
    got = hilbert_shards(frame(spark, data).repartition(4), ["lang", "source", "n_chars", "doc_id"], ["text"], shards)
    sizes = Counter()
    slots = {}
    for r in got.collect():
        sizes[r.shard] += 1
        slots.setdefault(r.shard, []).append(r.slot)
    every = [sizes[k] for k in range(shards)]
    assert sum(every) == len(data) and max(every) - min(every) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert hilbert_shards(empty(spark), ["lang", "n_chars"], ["doc_id"], shards).count() == 0


def test_shards_by_bytes(spark):
    for docs in (frame(spark, rows()), docs_of(spark)):
        sized = docs.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)) + 8)
        got = hilbert_shards(sized, ["lang", "n_chars"], ["doc_id"], 4, "bytes", "size").select("shard", "slot", "size").collect()
        assert len(got) == docs.count()
        total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
        for shard in range(4):
            own = [r for r in got if r.shard == shard]
            assert sorted(r.slot for r in own) == list(range(len(own)))
            assert abs(sum(r["size"] for r in own) - total / 4) <= largest


def test_shard_files_can_be_pruned(spark):
    path = scratch_path(spark, "test-shards")
    write_shards(docs_of(spark), path, ["lang", "source", "n_chars", "doc_id"], ["doc_id"], 16)
    back = spark.read.parquet(path)
    assert back.count() == 1000
    holding = back.filter("lang = 'es'").select("shard").distinct().count()
    assert holding <= 8
    plan = hilbert_shards(docs_of(spark), ["lang", "n_chars"], ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
