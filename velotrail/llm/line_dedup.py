"""Line dedup: hashes of lines are range-partitioned, sorted by document and streamed; keep bitmaps come back, not text.

A batch of documents first settles what it can: of a line found in several of its documents it sends on at most three
documents' rows, however many hold it, and where three or more hold it, those but the largest are dropped at once.  So a
line of a third of all documents makes three rows a batch.  Hashes are even, so equal ranges of hashes are equal loads.
Within a range rows come by hash and descending document: the first occurrence stays, and the others go from the third
document on.  A document's lines become one compressed keep bitmap, which is joined to its text at the end.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrail.llm.spans import BLANK, hashes, mix, parts, signed, utf8
from velotrail.llm.tables import map_batches, write_out

MIN_CHARS, MIN_DOCS = 20, 3
LINE = "h1 long, h2 long, doc_id long, row long, position int, settled boolean"
#: Bitmaps up to this many bytes, with 64 for each row, are broadcast.
BROADCAST = 32 << 20
#: Texts beyond this many bytes are taken in pieces.
MOST = 4 << 20


def _blocks(column: pa.Array):
    """Parts of the column with the index of each text and the position of its first line; long texts are cut at newlines."""
    for begin, end in parts(column, MOST):
        own = column.slice(begin, end - begin)
        raw = own[0].as_py().encode() if end - begin == 1 and own[0].is_valid else b""
        if len(raw) <= MOST:
            yield own, np.arange(begin, end), np.zeros(end - begin, dtype=np.int64)
            continue
        at = position = 0
        while at <= len(raw):
            cut = raw.find(b"\n", at + MOST)
            cut = len(raw) if cut < 0 else cut
            yield pa.array([raw[at:cut].decode()]), np.array([begin]), np.array([position])
            position += raw.count(b"\n", at, cut) + 1
            at = cut + 1


def _lines(column: pa.Array):
    """Of each line: its text, position, code points of its key, and where the key begins and ends in the data."""
    data, at = utf8(column)
    newline = np.flatnonzero(data == 10)
    # A line begins at every text's start and after every newline; it ends before a newline or at its text's end.
    text = np.concatenate([np.arange(len(at) - 1), np.searchsorted(at, newline, "right") - 1])
    start = np.concatenate([at[:-1], newline + 1])
    order = np.lexsort((start, text))
    text, start = text[order], start[order]
    first = np.searchsorted(text, np.arange(len(at)))
    end = np.append(start[1:] - 1, 0)
    end[first[1:] - 1] = at[1:]
    position = np.arange(len(start)) - first[text]
    seen = np.flatnonzero(~BLANK[data])
    lo, hi = np.searchsorted(seen, start), np.searchsorted(seen, end)
    full = lo < hi
    key_start, key_end = start.copy(), start.copy()
    key_start[full], key_end[full] = seen[lo[full]], seen[hi[full] - 1] + 1
    points = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    return data, text, position, points[key_end] - points[key_start], key_start, key_end


def _settle(min_chars: int, min_docs: int):
    """Rows of one batch: what others must see, and what is dropped already."""

    def run(batches):
        for batch in batches:
            ids, rows = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:2])
            pieces = []
            for column, own, base in _blocks(batch.column(2)):
                data, text, position, size, s, e = _lines(column)
                long = np.flatnonzero(size >= min_chars)
                pieces.append([signed(hashes(data, s[long], e[long], seed)) for seed in (21, 22)]
                              + [own[text[long]], position[long] + base[text[long]]])
            if not pieces:
                continue
            h1, h2, text, position = (np.concatenate(c) for c in zip(*pieces, strict=True))
            order = np.lexsort((position, rows[text], -ids[text], h2, h1))
            h1, h2, text, position = h1[order], h2[order], text[order], position[order].astype(np.int32)
            rank, last = _ranks(h1, h2, ids[text])
            gone = (rank > 0) & (last >= min_docs - 1)
            # What is gone still counts as documents for other batches, but min_docs of them are enough.
            sent = ~gone | (rank < min_docs)
            spread = signed(mix(rows[text[gone]].view(np.uint64) + position[gone].astype(np.uint64)))
            columns = ((h1[sent], spread), (h2[sent], spread), (ids[text[sent]], ids[text[gone]]), (rows[text[sent]], rows[text[gone]]),
                       (position[sent], position[gone]), (np.zeros(sent.sum(), bool), np.ones(gone.sum(), bool)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in columns], [c.split()[0] for c in LINE.split(", ")])

    return run


def _ranks(h1, h2, ids):
    """Of rows sorted by hash and document: the document's rank within its hash, and the last rank there."""
    n = len(h1)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new_hash, new_doc = np.ones(n, bool), np.ones(n, bool)
    new_hash[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    new_doc[1:] = new_hash[1:] | (ids[1:] != ids[:-1])
    docs, run, begin = np.cumsum(new_doc), np.cumsum(new_hash) - 1, np.flatnonzero(new_hash)
    rank = docs - docs[begin][run]
    return rank, rank[np.append(begin[1:], n) - 1][run]


def _stream(min_docs: int):
    """Sorted rows in, dropped lines out.  What an unfinished hash needs is carried to the next batch."""

    def run(batches):
        held = None
        for batch in batches:
            settled = batch.column(5).to_numpy(zero_copy_only=False)
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:5]]
            out = [[c[settled] for c in rows[2:]]]
            rows = [c[~settled] for c in rows] + [np.zeros(int((~settled).sum()), bool)]
            if held is not None:
                rows = [np.concatenate(c) for c in zip(held, rows, strict=True)]
            if len(rows[0]):
                h1, h2, ids, _, _, told = rows
                rank, last = _ranks(h1, h2, ids)
                drop = (rank > 0) & (last >= min_docs - 1)
                out.append([c[drop & ~told] for c in rows[2:5]])
                open_ = (h1 == h1[-1]) & (h2 == h2[-1])
                first = np.ones(len(rank), bool)
                # The hash counts too: a document can be the only holder of one hash and the largest holder of the next.
                first[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (ids[1:] != ids[:-1])
                # One row of each document counts it; undecided rows stay until the hash has min_docs documents.
                needed = open_ & (rank < min_docs) & (first | ((rank > 0) & ~drop))
                held = [c[needed] for c in [*rows[:5], told | drop]]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["doc_id", "row", "position"])

    return run


def line_bitmaps(rows: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, row, bitmap) of each document that loses lines; rows: doc_id, row, text.

    A bitmap has a bit for each line up to the last that goes, set where the line stays, and is zlib-compressed.
    """
    lines = map_batches(rows, _settle(min_chars, min_docs), LINE)
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Ranges of the 64-bit hash of the same width.
    place = F.least(F.lit(ranges - 1), F.floor((F.col("h1").cast("double") / 2.0**64 + 0.5) * ranges)).cast("int")
    ordered = lines.repartitionById(ranges, place).sortWithinPartitions("h1", "h2", F.desc("doc_id"), "row", "position")
    drops = map_batches(ordered, _stream(min_docs), "doc_id long, row long, position int")
    positions = drops.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("position")).alias("gone"))
    return map_batches(positions, _bitmaps, "doc_id long, row long, bitmap binary")


def _bitmaps(batches):
    for batch in batches:
        maps = []
        for gone in batch.column(2).to_pylist():
            bits = np.ones((gone[-1] // 8 + 1) * 8, dtype=np.uint8)
            bits[gone] = 0
            maps.append(zlib.compress(np.packbits(bits).tobytes()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(maps, pa.binary())], ["doc_id", "row", "bitmap"])


def keep_lines(text: str, bitmap: bytes) -> list[str]:
    """The lines that the bitmap keeps; lines beyond its end stay."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))
    return [x for k, x in enumerate(text.split("\n")) if k >= len(bits) or bits[k]]


def _apply(batches):
    for batch in batches:
        kept, n, dropped = [], [], []
        for text, bitmap in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            text = text or ""
            n.append(text.count("\n") + 1)
            stay = keep_lines(text, bitmap) if bitmap is not None else None
            dropped.append(0 if stay is None else n[-1] - len(stay))
            kept.append(text if stay is None else "\n".join(stay))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string()),
             pa.array([hashlib.sha256(x.encode()).hexdigest() for x in kept], pa.string())],
            ["doc_id", "n_lines", "n_dropped", "kept", "kept_sha256"])


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and a hash of the text as ``row``: rows alike in id and text lose the same lines."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))


def with_bitmaps(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``rows`` (doc_id, row, ...) with their bitmap, or null."""
    return rows.join(F.broadcast(bitmaps) if _size(bitmaps) <= BROADCAST else bitmaps, ["doc_id", "row"], "left")


def _size(bitmaps: DataFrame) -> int:
    return bitmaps.agg(F.sum(F.length("bitmap") + 64)).first()[0] or 0


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept (the text that stays), kept_sha256.

    A line's key is the line without blanks at both ends and with A-Z lower-cased.  Keys of at least ``min_chars`` code
    points that are found in ``min_docs`` documents lose their lines but in the largest doc_id.  A null text is one empty
    line.  Rows that repeat an id are one document here: a line that stays in it stays in all its rows.  Rows without id
    keep their lines and don't count.  Other columns are not read; an empty table gives an empty result.
    """
    rows = keyed(docs, id_col, text_col)
    bitmaps = write_out(line_bitmaps(rows.filter("doc_id IS NOT NULL"), min_chars, min_docs), "line-bitmaps")
    return map_batches(with_bitmaps(rows, bitmaps).select("doc_id", "text", "bitmap"), _apply,
                       "doc_id long, n_lines long, n_dropped long, kept string, kept_sha256 string")


def _replace(at: int, count_at: int | None):
    """Rows with their bitmap last: the text without the dropped lines, and its length."""

    def run(batches):
        for batch in batches:
            columns = list(batch.columns[:-1])
            texts = [t if b is None or t is None else "\n".join(keep_lines(t, b))
                     for t, b in zip(columns[at].to_pylist(), batch.column(len(columns)).to_pylist(), strict=True)]
            columns[at] = pa.array(texts, pa.string())
            if count_at is not None:
                lengths = pa.array([None if t is None else len(t) for t in texts], pa.int64())
                columns[count_at] = lengths.cast(columns[count_at].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return run


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, id_col: str = "doc_id",
                           text_col: str = "text", count_col: str = "n_chars") -> DataFrame:
    """All rows and columns of ``docs``, with ``text_col`` as ``line_dedup`` leaves it and its code points in ``count_col``, if any.

    Null texts stay null; a text that loses all lines becomes empty.
    """
    bitmaps = write_out(line_bitmaps(keyed(docs, id_col, text_col).filter("doc_id IS NOT NULL"), min_chars, min_docs), "line-bitmaps")
    names = docs.columns
    mark = "_" * (1 + max(len(c) for c in names))  # no column has this name or one that begins with it
    keys = docs.select("*", F.col(id_col).cast("long").alias(f"{mark}doc"), F.xxhash64(F.col(text_col).cast("string")).alias(f"{mark}row"))
    renamed = bitmaps.withColumnsRenamed({"doc_id": f"{mark}doc", "row": f"{mark}row", "bitmap": f"{mark}bitmap"})
    both = keys.join(F.broadcast(renamed) if _size(bitmaps) <= BROADCAST else renamed, [f"{mark}doc", f"{mark}row"], "left")
    count_at = names.index(count_col) if count_col in names else None
    return map_batches(both.select(*names, f"{mark}bitmap"), _replace(names.index(text_col), count_at), docs.schema)
