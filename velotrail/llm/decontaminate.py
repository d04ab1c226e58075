"""Benchmark decontamination by Wu-Manber search over words.

The patterns are the windows of ten consecutive words of every item, and whole items of fewer words.  For patterns of m
words a table gives, for the block of words that ends at a position, how far the search may move on; blocks that end no
pattern soon skip up to m - 1 words.  Where the shift is 0 the block selects a bucket by the suffix, the block at the
pattern's begin selects the test strings in it, and the words themselves are compared.

Items that share a text are one pattern source: tables hold numbers of texts, and which items have a text is joined to the
documents that hit it.  The patterns are broadcast in slices of at most SLICE_BYTES of different texts (or one text), whose tables take
some 130 times that.  There is one slice for usual benchmarks; with more, documents are searched slice by slice and the hits
of a document are put together.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrail.llm.spans import FOLD, U64, WORDY, hashes, mix, parts, runs, utf8
from velotrail.llm.tables import map_batches, write_out

WINDOW, BLOCK = 10, 2
SLICE_BYTES = 1 << 20
FOUND = "doc_id long, row long, n_words long, hits array<struct<start: int, end: int>>, texts array<long>"


class WuManber:
    """Tables for patterns of ``m`` words; a window is the folded bytes of its words joined by a space."""

    def __init__(self, m: int, shift: dict[int, int], bucket: dict[int, dict[int, list[bytes]]], texts: dict[bytes, list[int]]):
        self.m, self.block = m, min(BLOCK, m)
        self.most = m - self.block + 1
        self.shift, self.bucket, self.texts = shift, bucket, texts

    def add(self, window: bytes, blocks: list[int], text: int) -> None:
        """blocks: hashes of the window's blocks, by their last word; the windows of a text come one after the other."""
        known = self.texts.get(window)
        if known is None:
            known = self.texts[window] = []
            for k, b in enumerate(blocks):
                self.shift[b] = min(self.shift.get(b, self.most), self.most - 1 - k)
            self.bucket.setdefault(blocks[-1], {}).setdefault(blocks[0], []).append(window)
        if not known or known[-1] != text:
            known.append(text)

    def search(self, blocks: list[int], window_at):
        """(first word, window) of every occurrence; ``window_at(k)`` gives the words from the k-th on as bytes."""
        shift, most, at, end = self.shift.get, self.most, self.most - 1, len(blocks)
        while at < end:
            step = shift(blocks[at], most)
            if step:
                at += step
                continue
            first = at - most + 1
            tests = self.bucket[blocks[at]].get(blocks[first])
            if tests:
                found = window_at(first, self.m)
                if found in tests:
                    yield first, found
            at += 1


def _blocks(word: np.ndarray, width: int) -> np.ndarray:
    return word if width == 1 else mix(word[:-1] * U64(3) + word[1:])


def _words(column: pa.Array):
    data, at = utf8(column)
    starts, ends, first = runs(data, at, WORDY)
    return data, starts, ends, first, hashes(data, starts, ends)


def _tables(texts: list[tuple[int, str]], width: int) -> list[tuple]:
    """What makes up one searcher for each pattern length."""
    by: dict[int, WuManber] = {}
    data, starts, ends, first, word = _words(pa.array([t for _, t in texts], pa.string()))
    for k, (number, _) in enumerate(texts):
        s, e = int(first[k]), int(first[k + 1])
        m = min(width, e - s)
        if not m:
            continue
        own = by.setdefault(m, WuManber(m, {}, {}, {}))
        blocks = _blocks(word[s:e], own.block).tolist()
        text = [FOLD[data[a:b]].tobytes() for a, b in zip(starts[s:e], ends[s:e], strict=True)]
        for w in range(e - s - m + 1):
            own.add(b" ".join(text[w : w + m]), blocks[w : w + own.most], number)
    return [(t.m, t.shift, t.bucket, t.texts) for t in by.values()]


def _hits(column: pa.Array, parts_of: list[tuple]):
    """Of each document's text: its number of words, the runs of hit words, and the texts found."""
    tables = [WuManber(*x) for x in parts_of]
    for begin, stop in parts(column):
        data, starts, ends, first, word = _words(column.slice(begin, stop - begin))

        def window_at(k: int, m: int, base: int) -> bytes:
            return b" ".join([FOLD[data[starts[j] : ends[j]]].tobytes() for j in range(base + k, base + k + m)])

        for t in range(stop - begin):
            s, e = int(first[t]), int(first[t + 1])
            spans, texts = [], set()
            for table in tables:
                if e - s < table.m:
                    continue
                blocks = _blocks(word[s:e], table.block).tolist()
                for at, window in table.search(blocks, lambda k, m, s=s: window_at(k, m, s)):
                    spans.append((at, at + table.m))
                    texts.update(table.texts[window])
            yield e - s, _joined(spans), sorted(texts)


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


_HITS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _search(tables, only_hit: bool):
    def run(batches):
        for batch in batches:
            found = list(_hits(batch.column(2), tables.value))
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.int64()),
                 pa.array([[{"start": s, "end": e} for s, e in f[1]] for f in found], _HITS),
                 pa.array([f[2] for f in found], pa.list_(pa.int64()))], ["doc_id", "row", "n_words", "hits", "texts"])
            yield out.filter(pa.array([bool(f[1]) for f in found], pa.bool_())) if only_hit else out

    return run


def _merge(batches):
    for batch in batches:
        hits = [_joined([(h["start"], h["end"]) for part in own for h in part]) for own in batch.column(3).to_pylist()]
        texts = [sorted({i for part in own for i in part}) for own in batch.column(4).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([[{"start": s, "end": e} for s, e in h] for h in hits], _HITS),
                                          pa.array(texts, pa.list_(pa.int64()))], batch.schema.names)


def _keep(tables, at: int):
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array([not f[1] for f in _hits(batch.column(at).cast(pa.string()), tables.value)], pa.bool_()))

    return run


def _items(benchmark: DataFrame, item_col: str, item_text_col: str) -> DataFrame:
    """(item, number, text) of items with text; equal texts have one number."""
    text = F.col(item_text_col).cast("string")
    return benchmark.select(F.col(item_col).cast("string").alias("item"), F.xxhash64(text).alias("number"), text.alias("text")).filter("text <> ''")


def _slices(items: DataFrame, width: int, slice_bytes: int):
    """Broadcast search tables, each of at most so many bytes of texts (or one text)."""
    spark = items.sparkSession
    texts = write_out(items.groupBy("number").agg(F.first("text").alias("text")), "texts")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // slice_bytes)
    for k in range(n):
        own = texts.filter(F.pmod(F.xxhash64("number"), F.lit(n)) == k) if n > 1 else texts
        yield spark.sparkContext.broadcast(_tables([tuple(r) for r in own.collect()], width))


def _named(found: DataFrame, items: DataFrame) -> DataFrame:
    """``found`` with the items of its texts, sorted."""
    ids = items.filter("item IS NOT NULL").select("number", "item").distinct()
    hit = found.filter(F.size("texts") > 0)
    each = hit.select("doc_id", "row", F.explode("texts").alias("number")).distinct().join(ids, "number")
    each = each.groupBy(F.col("doc_id").alias("d"), F.col("row").alias("r")).agg(F.sort_array(F.collect_set("item")).alias("items"))
    none = F.array().cast("array<string>")
    named = hit.join(each, hit.doc_id.eqNullSafe(each.d) & (hit.row == each.r), "left").select("doc_id", "n_words", "hits", F.coalesce("items", none).alias("items"))
    return found.filter(F.size("texts") == 0).select("doc_id", "n_words", "hits", none.alias("items")).unionByName(named)


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, hits (runs of hit words), items (sorted as strings), contaminated.

    Words are runs of digits, letters a-z (A-Z folded) and characters beyond ASCII.  A word is hit when it lies in an
    occurrence of ``width`` consecutive words of an item, or of a whole shorter item.  Null and empty texts have no words;
    items without words or text find nothing; items without id are searched but not listed.  Repeated items count once
    for each id.  Other columns are not read; an empty table gives an empty result, an empty benchmark no hits.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    nothing = docs.sparkSession.sparkContext.broadcast([])
    items = _items(benchmark, item_col, item_text_col)
    slices = _slices(items, width, slice_bytes)
    first, second = next(slices, nothing), next(slices, None)
    if second is None:
        found = map_batches(rows, _search(first, False), FOUND)
    else:
        union = None
        for tables in chain((first, second), slices):
            own = write_out(map_batches(rows, _search(tables, True), FOUND).dropDuplicates(["doc_id", "row"]), "hits")
            union = own if union is None else union.union(own)
            tables.unpersist()
        hit = union.groupBy("doc_id", "row").agg(F.first("n_words").alias("n_words"), F.collect_list("hits").alias("hits"),
                                                 F.collect_list("texts").alias("texts"))
        hit = map_batches(hit, _merge, FOUND).select("doc_id", "row", F.col("hits").alias("h"), F.col("texts").alias("t"))
        plain = map_batches(rows, _search(nothing, False), FOUND)
        found = plain.join(hit, plain.doc_id.eqNullSafe(hit.doc_id) & (plain.row == hit.row), "left").select(
            plain.doc_id, plain.row, "n_words", F.coalesce("h", "hits").alias("hits"), F.coalesce("t", "texts").alias("texts"))
    found = _named(write_out(found, "hits"), items)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "hits", "items", (F.size("hits") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The rows of ``docs`` without a hit word, with all their columns.

    Null and empty texts have no words and stay; rows alike in text stay or go together.  An empty benchmark leaves all rows, an
    empty table gives an empty result.
    """
    at, waiting = docs.columns.index(text_col), None
    for tables in _slices(_items(benchmark, item_col, item_text_col), width, slice_bytes):
        if waiting is not None:
            docs = write_out(docs, "clean")
            waiting.unpersist()
        docs, waiting = map_batches(docs, _keep(tables, at), docs.schema), tables
    return docs
