import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest
from brute import empty, frame, rows

from velotrail.llm import variants
from velotrail.llm.variants import choose_pivots, near_words, spelling_variants, variants_of


def edits(a, b):
    """Whether one inserted, deleted or replaced code point turns a into b."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_words(data, least_length, least_count, damaged=31):
    count = Counter()
    for doc_id, text, *_ in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % damaged == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= least_length and n >= least_count}


def plain(words, times):
    near = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if edits(a, b):
            near[a].append(b), near[b].append(a)
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, n, len(near[w]), form[w], words.get(form[w]), root(w)) for w, n in words.items())


def result(df):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect())


def test_pivots_do_not_overlap_and_cost_least():
    rng = random.Random(1)
    for _ in range(300):
        places = sorted(rng.sample(range(12), rng.randrange(3, 8)))
        costs = [rng.randrange(10) for _ in places]
        cost = dict(zip(places, costs))
        got = choose_pivots(list(zip(places, costs)))
        assert got[1] - got[0] >= 2
        assert sum(cost[p] for p in got) == min(cost[a] + cost[b] for a, b in combinations(places, 2) if b - a >= 2)


def random_words(rng, n):
    stems = ["".join(rng.choice("abcé×") for _ in range(rng.randrange(4, 9))) for _ in range(n // 6)]
    out = set(stems)
    while len(out) < n:
        w = list(rng.choice(stems))
        for _ in range(rng.randrange(1, 3)):
            k = rng.randrange(len(w) + 1)
            if rng.random() < 0.5:
                w.insert(k, rng.choice("abcé"))
            elif k < len(w) and len(w) > 4:
                w[k : k + 1] = rng.choice(["", "a", "b"])
        if len(w) >= 4:
            out.add("".join(w))
    return {w: rng.choice([1, 2, 5, 10, 30, 100, 1000, 10000]) for w in out}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pairs_and_forms_equal_all_pairs(spark, seed):
    """Few letters make many near words, ties, chains and grams that a word holds twice."""
    words = random_words(random.Random(seed), 500)
    df = spark.createDataFrame(sorted(words.items()), "word string, n long")
    assert result(variants_of(df)) == plain(words, 10)


@pytest.mark.parametrize("sure", [2, 4, 99])
def test_keys_of_any_length(spark, monkeypatch, sure):
    monkeypatch.setattr(variants, "SURE", sure)
    words = random_words(random.Random(sure), 300)
    df = spark.createDataFrame(sorted(words.items()), "word string, n long")
    assert result(variants_of(df)) == plain(words, 10)


def test_no_pair_twice(spark):
    df = spark.createDataFrame([("aaaaaaa", 5), ("aaaaaaaa", 50), ("aaaaaab", 7)], "word string, n long")
    got = sorted((r.word, r.near) for r in near_words(df).collect())
    assert got == sorted([("aaaaaaa", "aaaaaaaa"), ("aaaaaaaa", "aaaaaaa"), ("aaaaaaa", "aaaaaab"), ("aaaaaab", "aaaaaaa")])


def test_words_of_texts(spark, monkeypatch):
    monkeypatch.setattr(variants, "CHUNK", 40)
    monkeypatch.setattr(variants, "HELD", 3)
    rng = random.Random(9)
    base = ["Spelling", "SPELING", "spellings", "ÉCOLES×", "écoles×", "variant", "varient", "variants", "xé" * 5, "short"]
    texts = [" ".join(rng.choice(base) + rng.choice(["", ".", "1", "Ā", "\n", "'s"]) for _ in range(60)) for _ in range(40)]
    data = rows() + [(500 + k, t, None, None, None) for k, t in enumerate(texts)]
    words = plain_words(data, 7, 2)
    assert len(words) > 10 and any(w not in {b.lower() for b in base} for w in words)
    assert result(spelling_variants(frame(spark, data).repartition(3))) == plain(words, 10)


def test_no_words(spark):
    assert spelling_variants(empty(spark)).count() == 0
    assert spelling_variants(frame(spark, [(1, None, None, None, 0), (2, "", None, None, 0), (3, "once only words", None, None, 0)])).count() == 0
    with pytest.raises(ValueError):
        spelling_variants(empty(spark), least_length=3)
