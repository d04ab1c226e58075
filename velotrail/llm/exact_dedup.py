"""Exact dedup: a two-pass Bloom filter picks the rows that may have a copy, and only these are shuffled.

Pass 1 counts, in blocks of a Bloom filter, slots hit once and slots hit more often.  Slots grow with the rows, a row's
slots lie in one block, and blocks are merged by block, so no task or group holds the whole filter.  Pass 2 tests every
row against the slots hit more often: equal texts share all slots, so a row with a slot hit once has no copy and passes
straight through.  Blocks reach the tasks in slices of SLICE_BLOCKS blocks.  The digests of a task are written in order of their
slices, so with more slices each reads its own digests only: every row is tested once, whatever the number of slices.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrail.llm.spans import U64, mix
from velotrail.llm.tables import join_groups, map_batches, write_out

#: Slots of a block and slots for each row; hash functions.
BLOCK_SLOTS, ROW_SLOTS, PROBES = 1 << 16, 16, 4
DIGESTS = "row long, doc_id long, digest binary, head long, slice int"
#: Blocks that are broadcast at once: 32 MB, enough for 16 million rows.
SLICE_BLOCKS = 4096


def _places(head: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each hash, and its PROBES different slots there (one row per hash)."""
    h = mix(head.view(U64))
    block = ((h >> U64(32)) * U64(blocks)) >> U64(32)
    start, step = h & U64(0xFFFF), ((h >> U64(16)) & U64(0xFFFF)) | U64(1)
    return block.astype(np.int64), ((start[:, None] + step[:, None] * np.arange(PROBES, dtype=U64)) & U64(0xFFFF)).astype(np.int64)


def _digests(blocks: int):
    def run(batches):
        for batch in batches:
            keys = [hashlib.sha256((t or "").encode().lower()).digest() for t in batch.column(2).to_pylist()]
            heads = np.frombuffer(b"".join(k[:8] for k in keys), np.int64)
            slices = (_places(heads, blocks)[0] // SLICE_BLOCKS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(heads), pa.array(slices)],
                                             ["row", "doc_id", "digest", "head", "slice"])

    return run


def _hits(blocks: int):
    def run(batches):
        for batch in batches:
            block, slot = _places(batch.column(0).to_numpy(zero_copy_only=False), blocks)
            place, n = np.unique((block[:, None] * BLOCK_SLOTS + slot).ravel(), return_counts=True)
            cut = np.flatnonzero(np.diff(place // BLOCK_SLOTS)) + 1
            own = [int(p[0]) // BLOCK_SLOTS for p in np.split(place, cut)] if len(place) else []
            hit = [(p % BLOCK_SLOTS).astype(np.uint16) for p in np.split(place, cut)] if own else []
            more = [h[c > 1].tobytes() for h, c in zip(hit, np.split(n, cut), strict=False)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int64()), pa.array([h.tobytes() for h in hit], pa.binary()), pa.array(more, pa.binary())],
                ["block", "hit", "more"])

    return run


def _merge(batches):
    """Sorted by block: the bits of slots that were hit more than once."""
    now, seen = None, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([np.packbits(seen > 1).tobytes()], pa.binary())],
                                          ["block", "bits"])

    for batch in batches:
        for block, hit, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if block != now:
                if now is not None:
                    yield done()
                now, seen = block, np.zeros(BLOCK_SLOTS, dtype=np.uint8)
            for part in (hit, more):
                at = np.frombuffer(part, np.uint16)
                seen[at] = np.minimum(seen[at] + 1, 2)
    if now is not None:
        yield done()


def _test(filter_, blocks: int):
    def run(batches):
        first, table = filter_.value
        bits = np.frombuffer(table, np.uint8).reshape(-1, BLOCK_SLOTS // 8)
        for batch in batches:
            block, slot = _places(batch.column(3).to_numpy(zero_copy_only=False), blocks)
            byte = bits[(block - first)[:, None], slot >> 3]
            maybe = ((byte >> (7 - (slot & 7))) & 1).all(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(maybe)], [*batch.schema.names, "maybe"])

    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, shuffled.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.  The row with the largest id stays; of
    rows that repeat that id one stays, and an absent id is smaller than any.  ``shuffled`` tells which rows the filter
    could not pass straight through.  Other columns of ``docs`` are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    total = rows.select("row").count()
    blocks = max(1, -(-total * ROW_SLOTS // BLOCK_SLOTS))
    slices = -(-blocks // SLICE_BLOCKS)
    rows = map_batches(rows, _digests(blocks), DIGESTS)
    rows = write_out(rows.sortWithinPartitions("slice") if slices > 1 else rows, "digests")
    hits = map_batches(rows.select("head"), _hits(blocks), "block long, hit binary, more binary")
    bits = write_out(map_batches(hits.repartition("block").sortWithinPartitions("block"), _merge, "block long, bits binary"), "bloom")

    tested = []
    for k in range(slices):
        first, last = k * SLICE_BLOCKS, min((k + 1) * SLICE_BLOCKS, blocks)
        found = dict(bits.filter(F.col("block").between(first, last - 1)).collect())
        none = bytes(BLOCK_SLOTS // 8)
        filter_ = spark.sparkContext.broadcast((first, b"".join(bytes(found.get(b, none)) for b in range(first, last))))
        own = rows.filter(F.col("slice") == k) if slices > 1 else rows
        tested.append(write_out(map_batches(own, _test(filter_, blocks), f"{DIGESTS}, maybe boolean"), "tested"))
        filter_.unpersist()
    table = tested[0]
    for more in tested[1:]:
        table = table.union(more)

    repeated = table.filter("maybe").select("row", "doc_id", "digest")
    groups = write_out(repeated.groupBy("digest").agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size")), "copies")
    joined = join_groups(repeated, groups, "digest", "group_size", max(total, 1)).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("best.row") == F.col("row")).alias("kept"),
        "digest", F.lit(True).alias("shuffled"))
    alone = table.filter("not maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                             F.lit(True).alias("kept"), "digest", F.lit(False).alias("shuffled"))
    return alone.unionByName(joined).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"), "shuffled")

