"""Token-id files: ORC with run-length coded integers, row indexes and Bloom filters on document ids.

Texts are tokenised where they are read; only ids travel, two bytes each where the vocabulary allows.  They go to ranges of
document ids, whose bounds come from the ids of documents alone: a row between two bounds has one range, and rows whose id
is itself a bound may lie in any range that it borders, so that an id with very many rows spreads over several.  Each range
is sorted and written as one file.  A row holds the range's number and the ids before it in its file, so no second pass is
needed; where a document starts in the whole is that plus the sizes of earlier files, which a reader sums from two small
columns.  Readers split files at stripes, and a search for document ids skips stripes and row groups by their statistics and
Bloom filters.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from velotrail.llm.spans import U64, mix
from velotrail.llm.tables import map_batches
from velotrail.llm.tokens import default_tokenizer, encoder

FILE = "doc_id long, part int, first long, n_tokens long, ids array<int>"
#: Bytes of a stripe before compression; rows between index entries.
STRIPE, STRIDE = 64 << 20, 1000
#: Rows of a file at most, about.
FILE_ROWS = 1_000_000
#: Stands for an absent id, which comes first.
LEAST = -(1 << 63)


def _bounds(docs: DataFrame, id_col: str, files: int | None) -> list[int]:
    """Ids that part the rows into equal ranges, ascending; an id with many rows is several bounds."""
    ids = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("id"))
    if files is None:
        files = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-ids.count() // FILE_ROWS))
    cuts = [k / files for k in range(1, files)]
    return list(ids.agg(F.percentile_approx("id", cuts, 100 * files).alias("at")).first()["at"] or []) if cuts else []


def _tokenised(path: str, end_id: int, bounds: list[int]):
    def run(batches):
        code, cuts = encoder(path), np.array(bounds, np.int64)
        kind = np.uint16 if max(code.whole.get_vocab_size() - 1, end_id) < 1 << 16 else np.uint32
        for batch in batches:
            row = batch.column(2).to_numpy(zero_copy_only=False)
            key = batch.column(0).fill_null(LEAST).to_numpy(zero_copy_only=False)
            low, high = np.searchsorted(cuts, key, "left"), np.searchsorted(cuts, key, "right")
            part = low + (mix(row.view(U64)) % (high - low + 1).astype(U64)).astype(np.int64)
            ids, at = code.encode_all(batch.column(1), end_id)
            raw = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * np.dtype(kind).itemsize).astype(np.int32)),
                                                                   pa.py_buffer(ids.astype(kind))])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(part.astype(np.int32)), pa.array(np.diff(at)), raw],
                                             ["doc_id", "row", "part", "n_tokens", "raw"])

    return run


def _placed(batches):
    """Sorted rows of one range: the ids before each."""
    first = 0
    for batch in batches:
        n, raw = batch.column(2).to_numpy(zero_copy_only=False), batch.column(3)
        if not batch.num_rows:
            continue
        edge = np.frombuffer(raw.buffers()[1], np.int32, len(n) + 1, 4 * raw.offset)
        size = int(edge[-1] - edge[0])
        kind = np.uint16 if size == 2 * n.sum() else np.uint32
        ids = np.frombuffer(raw.buffers()[2], kind, size // np.dtype(kind).itemsize, int(edge[0])).astype(np.int32)
        at = np.concatenate([[0], np.cumsum(n)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(first + at[:-1]), batch.column(2),
             pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))], ["doc_id", "part", "first", "n_tokens", "ids"])
        first += int(at[-1])


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0,
                      id_col: str = "doc_id", text_col: str = "text", files: int | None = None) -> None:
    """Write the ids of every whole text, each followed by ``end_id``, in ascending id order to new files in ``path``.

    Null texts count as empty; absent ids come first; rows that repeat an id stand side by side in any order.  An empty
    table gives files without rows.  ``tokenizer`` is a file of the tokenizers library that all executors have.  ``files``
    is the number of ranges; by default that of shuffle partitions, and more where files had over about FILE_ROWS rows.
    """
    bounds = _bounds(docs, id_col, files)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    coded = map_batches(rows, _tokenised(tokenizer or default_tokenizer(), end_id, bounds), "doc_id long, row long, part int, n_tokens long, raw binary")
    ordered = coded.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("part", "doc_id", "row").select("doc_id", "part", "n_tokens", "raw")
    (map_batches(ordered, _placed, FILE).write
     .option("compression", "lz4").option("orc.stripe.size", STRIPE).option("orc.row.index.stride", STRIDE)
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of files in ``path``; start counts the ids of all documents before it."""
    rows = spark.read.schema(FILE).orc(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    bases = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids")


def _checksums(batches):
    for batch in batches:
        ids = batch.column(3)
        at = ids.offsets.to_numpy().astype(np.int64)
        raw = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)).view(np.uint8)
        crc = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def token_checksums(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of what ``read_token_files`` returns; ids as little-endian 32-bit integers."""
    return map_batches(files, _checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")
