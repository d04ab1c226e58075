import random

import numpy as np
import pyarrow as pa
import pytest
from brute import FOLD, TEXTS, empty, frame, keep_lines, near, rows, sha, shingles

from velotrail.llm import exact_dedup as exact_module
from velotrail.llm import near_dedup as near_module
from velotrail.llm.exact_dedup import exact_dedup
from velotrail.llm.line_dedup import line_dedup, without_repeated_lines
from velotrail.llm.near_dedup import near_dedup, without_near_copies


def plain(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def exact_expected(data):
    groups = {}
    for r in data:
        groups.setdefault((r[1] or "").translate(FOLD), []).append(r[0])
    out, stays = [], set()
    for doc, text, *_ in data:
        key = (text or "").translate(FOLD)
        best = max(groups[key], key=lambda d: -1 if d is None else d)
        first = doc == best and key not in stays
        stays |= {key} if first else set()
        out.append((doc, best, len(groups[key]), first, sha(key)))
    return sorted(out, key=repr)


def test_exact_equals_plain_version(spark):
    data = rows()
    got = plain(exact_dedup(frame(spark, data)), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == exact_expected(data)


def test_exact_in_slices_and_hot_groups(spark, monkeypatch):
    monkeypatch.setattr(exact_module, "ROW_SLOTS", 4096)
    monkeypatch.setattr(exact_module, "SLICE_BLOCKS", 5)
    rng = random.Random(1)
    data = [(k, rng.choice(["hot", "Hot", f"t{k}", f"t{k // 2}"]), None, None, 0) for k in range(400)]
    result = exact_dedup(frame(spark, data))
    assert plain(result, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == exact_expected(data)
    alone = {r[0] for r in exact_expected(data) if r[2] == 1}
    passed = {r.doc_id for r in result.filter("not shuffled").collect()}
    assert passed <= alone and len(passed) > 0.9 * len(alone)


def test_exact_empty(spark):
    assert exact_dedup(empty(spark)).count() == 0


@pytest.mark.parametrize("width", [1, 2, 5])
def test_near_equals_all_pairs(spark, width):
    data = rows()
    want = near(data, width, 80)
    strays = [(None, len(shingles(r[1], width)), None, True) for r in data if r[0] is None]
    want = [(r[0], len(shingles(r[1], width)), want[k], r[0] == want[k]) for k, r in enumerate(data) if r[0] is not None] + strays
    assert plain(near_dedup(frame(spark, data), width), "doc_id", "n_shingles", "component_id", "kept") == sorted(want, key=repr)


def test_near_groups_that_need_several_rounds(spark):
    """Chains of small changes, a hub that only it links, and texts that share most but not enough."""
    rng = random.Random(2)
    word = lambda: f"v{rng.randrange(10**6)}"
    data = []
    for _ in range(6):
        text = [word() for _ in range(80)]
        for _ in range(12):
            data.append(" ".join(text))
            text[rng.randrange(80)] = word()
            text[rng.randrange(80)] = word()
    hub = [word() for _ in range(80)]
    data.append(" ".join(hub))
    for _ in range(25):
        own = list(hub)
        for at in rng.sample(range(0, 80, 3), 4):
            own[at] = word()
        data.append(" ".join(own))
    passage = [word() for _ in range(60)]
    data += [" ".join(passage + [word() for _ in range(25)]) for _ in range(40)]
    rng.shuffle(data)
    data = [(k, t, None, None, 0) for k, t in enumerate(data)]
    want = near(data, 2, 80)
    assert len(set(want.values())) > 40
    got = {r.doc_id: r.component_id for r in near_dedup(frame(spark, data)).collect()}
    assert got == want


@pytest.mark.parametrize("percent", [60, 80, 95])
def test_near_members_of_large_buckets(spark, monkeypatch, percent):
    """Buckets that one task does not compare: templates with links, chains and texts that share much but not enough."""
    monkeypatch.setattr(near_module, "BLOCK", 3)
    rng = random.Random(percent)
    word = lambda: f"v{rng.randrange(10**6)}"
    data = []
    for shared, n in ((100, 40), (60, 25), (30, 15)):
        template = [word() for _ in range(shared)]
        for _ in range(n):
            text = list(template)
            for at in rng.sample(range(shared), rng.randrange(max(1, shared * (100 - percent) // 60))):
                text[at] = word()
            data.append(" ".join(text[: rng.randrange(shared - 12, shared + 1)]))
    data = [(k, t, None, None, 0) for k, t in enumerate(data)]
    want = near(data, 2, percent)
    assert {r.doc_id: r.component_id for r in near_dedup(frame(spark, data), percent=percent, bands=14 if percent > 70 else 24).collect()} == want
    assert len(data) // 10 < len(set(want.values())) < len(data)


def test_near_template_families_have_few_candidates(spark, monkeypatch):
    """Texts on one template, none similar enough: all fall into the same buckets, and almost none meet."""
    monkeypatch.setattr(near_module, "BLOCK", 16)
    met, verified = [], near_module._verified
    monkeypatch.setattr(near_module, "_verified", lambda pairs, sets, percent: met.append(pairs.count()) or verified(pairs, sets, percent))
    rng = random.Random(4)
    template = [f"t{k}" for k in range(100)]
    data = []
    for k in range(800):
        text = list(template)
        for _ in range(40):
            text.insert(rng.randrange(len(text)), f"own{k}x{rng.randrange(10**6)}")
        data.append((k, " ".join(text), None, None, 0))
    got = near_dedup(frame(spark, data), 1).collect()
    assert all(r.kept for r in got)
    # The first step meets the two ends of each bucket, the second what is left; 800 texts have 320,000 pairs.
    assert len(met) == 2 and met[1] < 800 and met[0] < 800 * 14 * 2


def test_near_sketches_rule_out_no_link():
    rng = random.Random(6)
    number = lambda: rng.randrange(1 << 63)
    base, sets = [number() for _ in range(300)], [[], [number()], [number() for _ in range(33)], [number() for _ in range(2000)]]
    sets += [base[k:] + [number() for _ in range(k // 2)] for k in range(0, 120, 8)]
    value, at = np.array([x for own in sets for x in sorted(own)], np.uint64), np.cumsum([0, *map(len, sets)])
    sketches, passed = near_module._sketches(value, at).to_pylist(), 0
    for k, a in enumerate(sets):
        for m, b in enumerate(sets[:k]):
            both = len(set(a) & set(b))
            ok = near_module._may_link(80, [0, 1], [0, 1], [len(a), len(b)], [sketches[k], sketches[m]]).all()
            similar = 100 * both >= 80 * (len(a) + len(b) - both) > 0
            assert ok or not similar
            assert not ok or 100 * both >= 70 * (len(a) + len(b) - both)
            passed += similar
    assert passed > 15
    assert not near_module._may_link(80, [0, 1], [0, 0], [300, 300], [sketches[4]] * 2).any()


def test_near_candidates_of_a_large_group_are_few(spark, monkeypatch):
    """A group of near copies is compared with few ends of its buckets, and its sets meet where sketches leave a link open."""
    met, verified, left, links = [], near_module._verified, [], near_module._links
    monkeypatch.setattr(near_module, "_verified", lambda pairs, sets, percent: met.append(pairs.count()) or verified(pairs, sets, percent))
    monkeypatch.setattr(near_module, "_links", lambda open_, sets, percent: left.append(open_.count()) or links(open_, sets, percent))
    rng = random.Random(8)
    word = lambda: f"v{rng.randrange(10**6)}"
    group, template, data = [word() for _ in range(80)], [f"t{k}" for k in range(100)], []
    for k in range(200):
        text = list(group)
        for at in rng.sample(range(80), 3):
            text[at] = word()
        data.append((k, " ".join(text), None, None, 0))
    for k in range(200, 300):
        text = list(template)
        for _ in range(40):
            text.insert(rng.randrange(len(text)), word())
        data.append((k, " ".join(text), None, None, 0))
    got = {r.doc_id: r.component_id for r in near_dedup(frame(spark, data), 1).collect()}
    assert got == near(data, 1, 80)
    assert met[0] <= near_module.NEAREST * len(data) and left[0] < 100


def test_near_classes_are_sent_once_for_each_left_sub_signature(spark, monkeypatch):
    """The tables of all pairs are made where equal left sub-signatures meet; what is sent there doesn't grow with their number."""
    sent, plain_map = [], near_module.map_batches
    monkeypatch.setattr(near_module, "map_batches", lambda df, fn, schema: (fn is near_module._repeated and sent.append(df.count())) or plain_map(df, fn, schema))
    data = [(k, " ".join(f"w{k}x{m}" for m in range(40)), None, None, 0) for k in range(30)]
    assert all(r.kept for r in near_dedup(frame(spark, data)).collect())
    assert sent == [30 * near_module.BANDS]


@pytest.mark.parametrize("kept", [100_000, 5])
def test_near_buckets_of_sorted_rows(monkeypatch, kept):
    """Buckets are those of all pairs of a left and a right sub-signature, wherever batches and partitions end."""
    monkeypatch.setattr(near_module, "KEPT", kept)
    monkeypatch.setattr(near_module, "BLOCK", 4)
    rng = random.Random(kept)
    rows_ = sorted((rng.randrange(12) if rng.random() < 0.8 else 99, k, k - k % rng.choice([1, 1, 4]), 5, [rng.randrange(-3, 3) for _ in range(3)]) for k in range(150))
    want = {}
    for key, member, root, _, right in rows_:
        for j, r in enumerate(right):
            want.setdefault((key, j, r), set()).add((member, root))
    want = {frozenset(own) for own in want.values() if len({root for _, root in own}) > 1}
    kind = pa.schema([("key", pa.int64()), ("class", pa.int64()), ("root", pa.int64()), ("n", pa.int64()), ("right", pa.list_(pa.int32()))])
    cut, whole, sizes = {}, {}, {}
    for part in (rows_[:37], [], rows_[37:111], rows_[111:]):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part[k : k + 8], strict=True), kind, strict=True)], schema=kind)
                   for k in range(0, len(part), 8)]
        for out in near_module._repeated(iter(batches)):
            for bucket, member, root, n, large in zip(*(c.to_pylist() for c in out.columns), strict=True):
                (cut if large is None else whole).setdefault(bucket, set()).add((member, root))
                sizes[bucket] = large
                assert n == 5
    assert all(sizes[bucket] == (len(own) > 4) for bucket, own in whole.items())
    assert all(len({root for _, root in own}) > 1 for own in whole.values())
    assert {frozenset(own) for own in [*cut.values(), *whole.values()] if len({root for _, root in own}) > 1} == want
    assert len(whole) == len({frozenset(own) for own in whole.values()}) and (kept == 5 or len(whole) > 10)


def test_near_groups_of_several_buckets_have_one_number():
    """Members that sketches connect are a bucket of their own, the same one wherever they are together with others."""
    rng = random.Random(12)
    number = lambda: rng.randrange(1 << 63)
    one, two = [number() for _ in range(300)], [number() for _ in range(300)]
    sets = {10: one, 11: one[2:] + [number()], 20: two, 21: two[3:] + [number()], 30: [number() for _ in range(300)], 40: [number() for _ in range(300)]}
    value, at = np.array([x for own in sets.values() for x in sorted(own)], np.uint64), np.cumsum([0, *map(len, sets.values())])
    sketch = dict(zip(sets, near_module._sketches(value, at).to_pylist(), strict=True))
    rows_ = [(b, c, c, len(sets[c]), sketch[c]) for b, own in ((1, (10, 11, 20, 21, 30)), (2, (10, 11, 40)), (3, (20, 21)), (4, (30, 40))) for c in own]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows_, strict=True)], ["bucket", "class", "root", "n", "sketch"])
    got = {}
    for out in near_module._sketched(80)(iter([batch.slice(0, 6), batch.slice(6)])):
        for bucket, member, root in zip(*(c.to_pylist() for c in out.columns), strict=True):
            assert member == root
            got.setdefault(bucket, set()).add(member)
    assert sorted(map(sorted, got.values())) == [[10, 11], [20, 21]]


def test_near_sets_come_once_when_rows_repeat_an_id(spark):
    text, other = "a b c d", "e f g"
    docs = spark.createDataFrame([(1, text), (1, text), (1, other), (2, "a  b C d"), (3, other), (4, "x")], "doc_id long, text string")
    classes = near_module.map_batches(docs.select("doc_id", "doc_id", "text").toDF("doc_id", "row", "text"), near_module._classes(2, 2, 1), near_module.CLASS)
    classes = classes.groupBy("class").agg({"doc_id": "min"}).toDF("class", "first_id")
    got = near_module._sets_of(docs, classes, classes.filter("first_id < 4").select("class"), 2).collect()
    assert sorted(len(r.set) // 8 for r in got) == [2, 3] and len({r["class"] for r in got}) == 2


def test_near_stage_keeps_one_of_each_group(spark):
    data = rows()
    kept = without_near_copies(frame(spark, data))
    assert kept.columns == frame(spark, data).columns
    want = near([(k, *r[1:]) if r[0] is not None else r for k, r in enumerate(data)], 5, 80)  # by place, since rows repeat ids
    alone = [k for k, r in enumerate(data) if r[0] is None or not shingles(r[1], 5)]
    best = {}
    for k in sorted(set(range(len(data))) - set(alone), key=lambda k: data[k][0]):
        best.setdefault(want[k], k)
    stay = alone + list(best.values())
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr) == sorted([data[k][:2] for k in stay], key=repr)


def test_near_stage_judges_each_text_of_an_id(spark):
    """A clean text under the id of a near copy stays; a group keeps one row, whatever ids and rows repeat."""
    text, other = " ".join(f"w{k}" for k in range(100)), " ".join(f"x{k}" for k in range(100))
    third = " ".join(f"y{k}" for k in range(100))
    data = [(1, text), (2, text + " end"), (2, other), (3, other + " end"), (4, third), (4, third), (4, third + " end"), (5, third), (None, text), (None, text), (6, " "), (6, " ")]
    kept = without_near_copies(frame(spark, [(*r, None, None, 0) for r in data])).collect()
    got = sorted((r.doc_id or 0, r.text[:1]) for r in kept)
    assert got == [(0, "w"), (0, "w"), (1, "w"), (2, "x"), (4, "y"), (6, " "), (6, " ")]


def test_near_empty(spark):
    assert near_dedup(empty(spark)).count() == 0
    assert without_near_copies(empty(spark)).count() == 0
    blank = frame(spark, [(1, None, None, None, 0), (2, " ", None, None, 0)])
    assert plain(near_dedup(blank), "doc_id", "n_shingles", "component_id", "kept") == [(1, 0, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("min_docs", [2, 3, 4])
def test_lines_equal_plain_version(spark, min_docs):
    rng = random.Random(min_docs)
    pool = [f"a line that repeats number {k}" for k in range(12)] + ["short", "", "é" * 20, "é" * 19, "x" * 20]
    made = ["\n".join(rng.choice(("", " ", "\t")) + rng.choice((str, str.upper))(rng.choice(pool)) for _ in range(rng.randrange(9))) for _ in range(300)]
    data = rows(TEXTS + made)
    want = sorted(((r[0], (r[1] or "").count("\n") + 1, n, sha(k)) for r, (k, n) in zip(data, keep_lines(data, 20, min_docs), strict=True)), key=repr)
    assert plain(line_dedup(frame(spark, data), 20, min_docs), "doc_id", "n_lines", "n_dropped", "kept_sha256") == want


def test_lines_stage_keeps_columns_and_counts(spark):
    data = rows()
    result = without_repeated_lines(frame(spark, data))
    assert result.schema == frame(spark, data).schema
    want = sorted(((r[0], None if r[1] is None else k, None if r[1] is None else len(k)) for r, (k, _) in zip(data, keep_lines(data, 20, 3), strict=True)), key=repr)
    assert plain(result, "doc_id", "text", "n_chars") == want
    assert line_dedup(empty(spark)).count() == 0 and without_repeated_lines(empty(spark)).count() == 0


def test_long_texts_are_cut_at_newlines(spark, monkeypatch):
    from velotrail.llm import line_dedup as module

    monkeypatch.setattr(module, "MOST", 200)
    data = [(k, "\n".join(f"a rather long line with number {(k * j) % 40}" for j in range(60)), None, None, 0) for k in range(1, 9)]
    got = {r.doc_id: r.kept for r in line_dedup(frame(spark, data)).collect()}
    assert got == {r[0]: t for r, (t, _) in zip(data, keep_lines(data, 20, 3), strict=True)}


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5])
@pytest.mark.parametrize("min_docs", [2, 3, 4])
def test_lines_that_batches_cut(size, min_docs):
    """Sorted rows in batches of few rows, one document holding most lines, against all rows at once."""
    import pyarrow as pa

    from velotrail.llm.line_dedup import LINE, _stream

    names = [c.split()[0] for c in LINE.split(", ")]
    rng = random.Random(10 * size + min_docs)
    for _ in range(60):
        held = {(h // 2, h % 2, 99, position) for h in range(8) for position in range(rng.randrange(3))}
        held |= {(h // 2, h % 2, rng.randrange(1, 100), rng.randrange(50)) for h in range(8) for _ in range(rng.randrange(6))}
        # Equal documents and hashes as they come from the sort; a document's row id is its id.
        data = [(a, b, doc, doc, position, False) for a, b, doc, position in sorted(held, key=lambda x: (x[0], x[1], -x[2], x[3]))]
        docs = {}
        for a, b, doc, *_ in data:
            docs.setdefault((a, b), set()).add(doc)
        want = {(doc, position) for a, b, doc, _, position, _ in data if len(docs[a, b]) >= min_docs and doc != max(docs[a, b])}
        batches = [pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*data[k : k + size], strict=True)], names) for k in range(0, len(data), size)]
        got = {(doc, position) for out in _stream(min_docs)(iter(batches)) for doc, _, position in zip(*(c.to_pylist() for c in out.columns), strict=True)}
        assert got == want
