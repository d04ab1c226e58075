"""Spelling variants: words one edit apart, found by pivotal grams.

Words are counted over all texts.  A word's grams are its overlapping pairs of characters; a global order puts rare ones
first.  Of the first three in that order, its prefix (with all that tie with the last), two that do not overlap are its
pivots: the two whose lists are shortest together, chosen by dynamic programming.  One edit spoils one pivot at most, so of
two words one edit apart, that whose prefix ends earlier has a pivot that stands in the other one's prefix too.

Where such a pivot stands, the edit is on one side of it, and all on the other side is equal: an edit behind it leaves the
beginning up to the pivot, an edit before it leaves the rest from the pivot on.  So pivots are not looked up by their
gram and place alone but by the gram with its equal side, which fixes its place, among words at most one character longer or
shorter.  Where that is short (less than SURE characters), the other side is halved: the edit leaves one half, which belongs to
the key too.  A word is filed under the halves of its own length, and looked up by those of all lengths that one edit gives.
The candidates are confirmed by their edit distance.  Keys with very many words are left to Spark's splitting of skewed joins.

A word's form is its much more frequent neighbour; forms are followed to the last by doubling their steps.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotrail.llm.tables import map_batches
from velotrail.plans.scratch import write_out

#: Code points and occurrences that a word has at least; how many times as frequent a form is.
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
#: Edits, characters of a gram, grams of a prefix.
EDITS, GRAM = 1, 2
PREFIX = EDITS * GRAM + 1
#: Equal characters that make a key by themselves.
SURE = 6
#: Every so many pairs of document and run, by their checksum, lose a character; 0: none.
DAMAGED = 31
#: Characters that are searched at a time, and words that are counted in a task before they are sent on.
CHUNK, HELD = 1 << 20, 200_000
LETTERS = "A-Za-zÀ-ÿ"


def _pieces(text: str, outside: re.Pattern):
    """A text cut behind characters that no word holds."""
    begin = 0
    while begin < len(text):
        cut = outside.search(text, begin + CHUNK) if len(text) - begin > CHUNK else None
        end = cut.end() if cut else len(text)
        yield text[begin:end]
        begin = end


def _count(least: int, damaged: int):
    def run(batches):
        words, outside = re.compile(f"[{LETTERS}]{{{least},}}"), re.compile(f"[^{LETTERS}]")
        count: Counter = Counter()

        def emit():
            out = pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["word", "n"])
            count.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                # Folding bytes leaves all but A-Z.
                for piece in _pieces(text.encode().lower().decode() if text else "", outside):
                    for run_, n in Counter(words.findall(piece)).items():
                        h = zlib.crc32(run_.encode(), seed) if damaged else 1
                        if damaged and h % damaged == 0:
                            k = h % len(run_)
                            run_ = run_[:k] + run_[k + 1 :]
                            if len(run_) < least:
                                continue
                        count[run_] += n
                if len(count) >= HELD:
                    yield emit()
        yield emit()

    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, damaged: int = DAMAGED) -> DataFrame:
    """(word, n) of all runs of letters of at least ``least_length`` code points, A-Z folded, each after its damage.

    A run loses the code point h % length if ``damaged`` divides h, the checksum of ``<doc_id>:<run>``; absent ids count as empty.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, _count(least_length, damaged), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _gram_counts(batches):
    count: Counter = Counter()
    for batch in batches:
        for word in batch.column(0).to_pylist():
            count.update({word[k : k + GRAM] for k in range(len(word) - GRAM + 1)})
    yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["gram", "n"])


def choose_pivots(places: list[tuple[int, int]]) -> list[int]:
    """Places (place, length of the gram's list), ascending, of EDITS + 1 grams that do not overlap, with the shortest lists in all.

    ``best[j]`` holds the cheapest choice of j grams among those seen so far that end before the next place.
    """
    best: list[list[tuple[int, list[int]] | None]] = [[(0, [])] + [None] * (EDITS + 1)]
    for k, (place, cost) in enumerate(places):
        before = k
        while before and places[before - 1][0] > place - GRAM:
            before -= 1
        line = list(best[-1])
        for j in range(EDITS + 1):
            own = best[before][j]
            if own is not None and (line[j + 1] is None or own[0] + cost < line[j + 1][0]):
                line[j + 1] = own[0] + cost, [*own[1], place]
        best.append(line)
    return best[-1][EDITS + 1][1]


def keys_of(word: str, place: int, shifts: tuple[int, ...]) -> set[str]:
    """Keys of the gram at ``place``: either side with it, and a half of a long other side, for other sides longer by ``shifts``."""
    out = set()
    # The other side is read away from the gram, so the second pair is turned round.
    for mark, equal, rest in (("<", word[: place + GRAM], word[place + GRAM :]), (">", word[place:][::-1], word[:place][::-1])):
        if len(equal) >= SURE:
            out.add(mark + equal)
            continue
        for size in (len(rest) + s for s in shifts):
            near, far = size // 2, size - size // 2
            if 0 <= near <= len(rest):
                out.add(f"{mark}{equal}<{rest[:near]}")
            if 0 <= far <= len(rest):
                out.add(f"{mark}{equal}>{rest[len(rest) - far :]}")
    return out


def _entries(order: dict[str, tuple[int, int]], pivots: bool):
    """Of each word: the keys of its pivots, or of its prefix grams, and the rank of the last gram of its prefix."""

    def run(batches):
        for batch in batches:
            out = []
            for word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                grams = sorted((order[word[k : k + GRAM]][0], k) for k in range(len(word) - GRAM + 1))
                last = grams[min(PREFIX, len(grams)) - 1][0]
                if pivots:
                    places = choose_pivots([(k, order[word[k : k + GRAM]][1]) for k in sorted(k for _, k in grams[:PREFIX])])
                else:
                    places = [k for rank, k in grams if rank <= last]
                keys = set().union(*[keys_of(word, k, (-1, 0, 1) if pivots else (0,)) for k in places])
                out += [(key, word, n, last) for key in keys]
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int32()), strict=True)],
                                             ["key", "word", "n", "last"])

    return run


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of all pairs of ``words`` (word, n; words are distinct and have at least four characters) that are one edit apart, both ways."""
    # LETTERS are 116 characters, 90 when A-Z are folded, so grams are 8,100 at most.
    counted = map_batches(words.select("word"), _gram_counts, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    ranked = sorted((r.n, r.gram) for r in counted.collect())
    order = {gram: (rank, n) for rank, (n, gram) in enumerate(ranked)}
    made = "key string, word string, n long, last int"
    # Keys are told apart by 64 bits: what meets by chance is not confirmed.
    wanted = map_batches(words.select("word", "n"), _entries(order, True), made).select(F.xxhash64("key").alias("key"), "word", "n", "last")
    filed = map_batches(words.select("word", "n"), _entries(order, False), made).select(
        F.xxhash64("key").alias("key"), F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("last").alias("near_last"))
    met = wanted.join(filed, "key").filter(
        (F.col("last") <= F.col("near_last")) & (F.abs(F.length("word") - F.length("near")) <= EDITS) & (F.col("word") != F.col("near")))
    found = met.filter(F.levenshtein("word", "near", EDITS) == EDITS)
    # A pair is found by several keys, and from both ends when both prefixes end alike.
    first = F.col("word") < F.col("near")
    pairs = found.select(*[F.when(first, F.col(a)).otherwise(F.col(b)).alias(c) for a, b, c in (
        ("word", "near", "a"), ("near", "word", "b"), ("n", "near_n", "a_n"), ("near_n", "n", "b_n"))]).dropDuplicates(["a", "b"])
    both = F.array(F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
                   F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    return pairs.select(F.inline(both))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: ``forms`` (word, form) followed to the last.

    A form has TIMES its word's count, so a chain is as long as the largest count has digits, and a few doublings end it.
    """
    roots = write_out(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = write_out(roots.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if not step.filter("moved").limit(1).count():
            return step.select("word", "root")
        roots = step.select("word", "root")


def variants_of(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of ``words`` (word, n)."""
    near = near_words(words)
    rival: Column = F.struct((-F.col("near_n")).alias("less"), F.col("near"))
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(rival).alias("best"))
    joined = words.join(best, "word", "left")
    holds = -F.col("best.less") >= times * F.col("n")
    table = write_out(joined.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(holds, F.col("best.near")).alias("form"),
                                    F.when(holds, -F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(table.filter("form IS NOT NULL"))
    return table.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                      times: int = TIMES, damaged: int = DAMAGED) -> DataFrame:
    """One row per word of the texts: word, n, n_near, form, form_n, root.

    Words are maximal runs of LETTERS with A-Z folded (see ``word_counts`` for the damage done to some), of at least
    ``least_length`` code points (four or more) and ``least_count`` occurrences ``n`` in all rows.  Two are near if one inserted, deleted or
    replaced code point turns one into the other; ``n_near`` counts a word's.  ``form`` is the near word with the largest n,
    the first in code-point order of several, if its n, ``form_n``, is at least ``times`` the word's own; else both are null.
    ``root`` is where following forms ends, the word itself if it has none.  Null and empty texts have no words; repeated
    rows count each time.  Other columns are not read; an empty table gives an empty result.
    """
    if least_length < PREFIX + 1:
        raise ValueError(f"words of less than {PREFIX + 1} characters have too few grams")
    words = write_out(word_counts(docs, id_col, text_col, least_length, damaged).filter(F.col("n") >= least_count), "words")
    return variants_of(words, times)
