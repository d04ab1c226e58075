"""A stored table of versioned cells: a log of changes, resolved on reading.

A change is a batch (run, batch_id) of operations below ``live`` (see ``sources.log``); batches take effect in the order of
(batch_id, run).  Puts are versions.  Deletes are marks: up to a time of a row, a family or a column, or one version; a mark
hides what earlier batches put and nothing of later ones.  Counters and appends are kept as what is added and are worked
out on reading, so a batch that is written twice counts once.  Reading takes the newest copy with the batches that are in
none; ``compact_cells`` resolves them into a new copy, which clears marks and may apply versions and time to live.  A batch that
a copy holds is not taken again; a new one acts after the copy, whatever its number.

What is added and marked is folded by batch when it is written, so on reading a cell has one addition and a key one mark for
each batch since the last copy, however many the batch brought.

A copy is in key order, and ``index/version=<k>`` has the least and greatest key of each of its files: a range, a prefix or a few
keys open only the files that may hold them, and in these Bloom filters on the keys leave out blocks.  Batches lie in buckets by
row key.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrail.operators.cells import CELL, CELLS, VERSION, newest, restrict, scan_range
from velotrail.operators.history import bucket_of
from velotrail.operators.mutations import (
    CHUNK, DELETE_KINDS, ROW_FAMILY, expire_ttl, folded_mutations, joined_values, retain_versions, stamped_puts, summed,
)
from velotrail.plans.scratch import write_out
from velotrail.plans.skew import is_small, shuffled, skew_join, top_n
from velotrail.sources.log import BATCH_SCHEMA, CALL, Log, Snapshot, new_run, only, stored

# The fold travels to the workers as code, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 64
ROW = "row_key string, family string, qualifier string, ts bigint, value string"
#: ``kind`` is the scope of a mark ('row', 'family', 'columns', 'column') or of an addition ('count', 'text').
OPERATIONS = f"{ROW}, kind string, op string, bucket int"
INDEX = "file string, least string, greatest string"
#: So many keys are looked up in the index; more read all files.
LOOKED_UP = 1000
FOREVER = (1 << 63) - 1
#: Columns by which operations are ordered: batches, and in one batch marks before all else.
ORDER = ("batch_id", "run", "late")
_SCOPES = {"row": ["row_key"], "family": ROW_FAMILY, "columns": CELL}


def _write(operations: DataFrame, path: str, buckets: int, run: str | None, batch_id: int | None) -> bool:
    """operations: row_key, family, qualifier, ts, value, kind, op.  False if a settled copy holds the batch already."""
    log = Log(operations.sparkSession, path)
    run, batch_id = _place(log, run, batch_id)
    if log.covered(run, batch_id):
        return False
    placed = operations.withColumn("bucket", bucket_of(F.col("row_key"), buckets)).hint("rebalance", "op", "bucket")
    sorted_ = placed.sortWithinPartitions("op", "bucket", *VERSION)
    sorted_.write.mode("overwrite").partitionBy("op", "bucket").parquet(log.folder(run, batch_id))
    log.add(run, batch_id)
    return True


def _place(log: Log, run: str | None, batch_id: int | None) -> tuple[str, int]:
    """A call without a number acts after all that is there."""
    if batch_id is None:
        batch_id = max((n for _, n in log.snapshot().batches), default=-1) + 1
    return run or new_run(), batch_id


def _before(log: Log, run: str, batch_id: int) -> Snapshot:
    """What a batch acts on."""
    now = log.snapshot()
    return Snapshot(now.version, tuple((r, n) for r, n in now.batches if (n, r) < (batch_id, run)))


def write_puts(puts: DataFrame, path: str, now_ms: int, run: str | None = None, batch_id: int | None = None, buckets: int = BUCKETS) -> bool:
    """Versions as for ``put_cells``."""
    rows = stamped_puts(puts, now_ms).select(*CELLS, F.lit("").alias("kind"), F.lit("put").alias("op"))
    return _write(rows, path, buckets, run, batch_id)


def write_mutations(mutations: DataFrame, path: str, ts: int, run: str | None = None, batch_id: int | None = None, buckets: int = BUCKETS) -> bool:
    """Puts and deletes as for ``mutate_rows``."""
    cells, families = folded_mutations(mutations, is_small(mutations))
    at, none = F.lit(ts).cast("bigint").alias("ts"), F.lit(None).cast("string")
    puts = cells.filter("_put").select(*CELL, at, F.col("_last.value").alias("value"), F.lit("").alias("kind"), F.lit("put").alias("op"))
    marks = cells.filter("_deleted").select(*CELL, at, none.alias("value"), F.lit("columns").alias("kind"), F.lit("mark").alias("op"))
    wide = families.select(*ROW_FAMILY, none.alias("qualifier"), at, none.alias("value"), F.lit("family").alias("kind"), F.lit("mark").alias("op"))
    return _write(puts.unionByName(marks).unionByName(wide), path, buckets, run, batch_id)


def write_deletes(
    deletes: DataFrame, path: str, now_ms: int | None = None, run: str | None = None, batch_id: int | None = None, buckets: int = BUCKETS
) -> bool:
    """Deletes of a ``kind`` as for ``delete_typed``; the newest version of a cell is that before the batch."""
    # Every kind reads them, so they are worked out once.
    deletes = write_out(deletes.select(*[F.col(c).cast("string") for c in CELL], F.col("ts").cast("bigint"), "kind"), "deletes")
    strange = deletes.filter(~F.coalesce(F.col("kind").isin(*DELETE_KINDS), F.lit(False))).select("kind").first()
    if strange:
        raise ValueError(f"unknown kind of delete: {strange.kind}")
    log = Log(deletes.sparkSession, path)
    run, batch_id = _place(log, run, batch_id)
    none, rows = F.lit(None).cast("string"), None
    forever = F.lit(FOREVER if now_ms is None else now_ms).cast("bigint")
    for kind, keys in _SCOPES.items():
        cut = deletes.filter(F.col("kind") == kind).groupBy(*keys).agg(F.max(F.coalesce("ts", forever)).alias("ts"))
        own = cut.select(*[F.col(c) if c in keys else none.alias(c) for c in CELL], "ts", F.lit(kind).alias("kind"))
        rows = own if rows is None else rows.unionByName(own)
    single = deletes.filter(F.col("kind") == "column")
    open_ = single.filter(F.col("ts").isNull())
    exact = single.filter(F.col("ts").isNotNull()).select(*VERSION)
    if open_.limit(1).count():
        there = _resolved(log, _before(log, run, batch_id), _Part(keys=open_, buckets=buckets))
        exact = exact.unionByName(newest(restrict(there, open_, CELL)).select(*VERSION))
    rows = rows.unionByName(exact.distinct().withColumn("kind", F.lit("column")))
    return _write(rows.withColumn("value", none).withColumn("op", F.lit("mark")), path, buckets, run, batch_id)


def write_increments(increments: DataFrame, path: str, now_ms: int, run: str | None = None, batch_id: int | None = None, buckets: int = BUCKETS) -> bool:
    """Amounts (default 1) that are added to counters, as for ``increment_cells``."""
    rows = summed(increments).select(*CELL, F.lit(now_ms).cast("bigint").alias("ts"), F.col("_sum").cast("string").alias("value"),
                                     F.lit("count").alias("kind"), F.lit("add").alias("op"))
    return _write(rows, path, buckets, run, batch_id)


def write_appends(
    appends: DataFrame, path: str, now_ms: int, run: str | None = None, batch_id: int | None = None, buckets: int = BUCKETS, chunk: int = CHUNK
) -> bool:
    """Values that are joined to cells in ``seq`` order, as for ``append_cells``."""
    rows = joined_values(appends, chunk).select(*CELL, F.lit(now_ms).cast("bigint").alias("ts"), F.col("_added").alias("value"),
                                                F.lit("text").alias("kind"), F.lit("add").alias("op"))
    return _write(rows, path, buckets, run, batch_id)


@dataclass(frozen=True)
class _Part:
    """Rows that are asked for: those in ``keys`` (row_key), and of keys from ``start`` to before ``stop``."""

    keys: DataFrame | None = None
    start: str = ""
    stop: str | None = None
    buckets: int = BUCKETS

    def of(self, rows: DataFrame, bucketed: bool = True) -> DataFrame:
        rows = scan_range(rows, self.start, self.stop)
        if self.keys is None:
            return rows
        return only(rows, self.keys, "row_key", self.buckets) if bucketed else restrict(rows, self.keys, ["row_key"])

    def files(self, log: Log, version: int) -> list[str] | None:
        """The files of a copy that may hold such rows; None: not worth a look."""
        few = None if self.keys is None else self.keys.select("row_key").distinct().limit(LOOKED_UP + 1).collect()
        few = None if few is None or len(few) > LOOKED_UP else sorted(r.row_key for r in few if r.row_key is not None)
        if few is None and not self.start and self.stop is None:
            return None
        index = stored(log.spark, f"{log.path}/index/version={version}", INDEX)
        if self.start:
            index = index.filter(F.col("greatest") >= self.start)
        if self.stop is not None:
            index = index.filter(F.col("least") < self.stop)
        if few is not None:
            index = index.filter(F.exists(F.array(*map(F.lit, few)).cast("array<string>"), lambda k: k.between(F.col("least"), F.col("greatest"))))
        return [r.file for r in index.select("file").collect()]


def read_cells(
    spark: SparkSession, path: str, at: Snapshot | None = None, keys: DataFrame | None = None, start: str = "", stop: str | None = None,
    prefix: str | None = None, buckets: int = BUCKETS,
) -> DataFrame:
    """The cells that are there (CELLS), now or at a ``snapshot``.

    Only rows in ``keys`` (row_key), from ``start`` to before ``stop``, with ``prefix``, if given; ``buckets`` are those that
    batches were written with.
    """
    if prefix:
        start, end = max(start, prefix), _behind(prefix)
        stop = end if stop is None else stop if end is None else min(stop, end)
    log = Log(spark, path)
    return _resolved(log, at or log.snapshot(), _Part(keys, start, stop, buckets))


def _behind(prefix: str) -> str | None:
    """The first key behind all that begin with the prefix."""
    own = prefix.rstrip("\U0010ffff")
    if not own:
        return None
    last = ord(own[-1]) + 1
    return own[:-1] + chr(0xE000 if last == 0xD800 else last)


def compact_cells(
    spark: SparkSession, path: str, n: int | None = None, ttl_s: int | None = None, now_ms: int | None = None, newest: bool = True
) -> bool:
    """Write a new copy of what is there, with the newest ``n`` versions of a cell and none older than ``ttl_s``, if given.

    False if there is no batch to take.  Without ``newest`` the last batch of each run stays out; then batches behind it that
    other runs wrote stay out too, so that the order holds.
    """
    if ttl_s is not None and now_ms is None:
        raise ValueError("a time to live needs now_ms")
    log = Log(spark, path)
    now = log.snapshot()
    last = dict(now.batches)  # batches ascend
    open_ = [] if newest else [(n_, r) for r, n_ in now.batches if not r.startswith(CALL) and n_ == last[r]]
    taken = [(r, n_) for r, n_ in now.batches if not open_ or (n_, r) < min(open_)]
    if not taken:
        return False
    cells = _resolved(log, Snapshot(now.version, tuple(taken)), _Part())
    if ttl_s is not None:
        cells = expire_ttl(cells, ttl_s, now_ms)
    if n:
        cells = retain_versions(cells, n)
    version = now.version + 1
    ordered = cells.repartitionByRange(*VERSION).sortWithinPartitions(*VERSION)
    ordered.write.mode("overwrite").option("parquet.bloom.filter.enabled#row_key", "true").parquet(log.settled(version))
    copy = stored(spark, log.settled(version), ROW)
    index = copy.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min("row_key").alias("least"), F.max("row_key").alias("greatest"))
    index.coalesce(1).write.mode("overwrite").parquet(f"{log.path}/index/version={version}")
    log.settle(version, taken)
    return True


def _resolved(log: Log, now: Snapshot, part: _Part) -> DataFrame:
    """The cells that a snapshot stands for."""
    copy = log.spark.createDataFrame([], ROW)
    if now.version:
        copy = part.of(stored(log.spark, log.settled(now.version), ROW, part.files(log, now.version)), bucketed=False)
    first = copy.select(*CELLS, F.lit(-1).cast("bigint").alias("batch_id"), F.lit("").alias("run"), F.lit(1).alias("late"))
    if not now.batches:
        return first.select(*CELLS)
    live = stored(log.spark, f"{log.path}/live", f"{OPERATIONS}, {BATCH_SCHEMA}", [log.folder(*b) for b in now.batches])
    live = part.of(live).withColumn("late", (F.col("op") != "mark").cast("int"))
    puts = first.unionByName(live.filter("op = 'put'").select(*CELLS, *ORDER))
    marks = live.filter("op = 'mark'").select(*VERSION, "kind", *ORDER)
    added = live.filter("op = 'add'").select(*CELLS, "kind", *ORDER)
    # The kinds of operations are folders, so these read nothing where there is none.
    marked = bool(marks.limit(1).count())
    if added.limit(1).count():
        puts = puts.unionByName(_worked_out(puts, marks if marked else None, added))
    best = puts.groupBy(*VERSION).agg(F.max(F.struct(*ORDER, "value")).alias("_put"))
    return _unhidden(best, marks, puts).select(*VERSION, F.col("_put.value").alias("value")) if marked else best.select(*VERSION, F.col("_put.value").alias("value"))


def _when(rows: str | None = None) -> Column:
    return F.struct(*[F.col(f"{rows}.{c}" if rows else c) for c in ORDER])


def _unhidden(best: DataFrame, marks: DataFrame, puts: DataFrame) -> DataFrame:
    """Versions that no later mark hides.  A key's marks are one row: one mark for each batch since the last copy.

    Hot keys are looked for in ``puts``, which ``best`` was made of: that only reads keys.
    """
    out = best
    for kind, keys in _SCOPES.items():
        own = marks.filter(F.col("kind") == kind).groupBy(*keys).agg(F.collect_list(F.struct(_when().alias("when"), "ts")).alias("_marks"))
        met = skew_join(out, own, keys, "left", count_in=puts)
        hidden = F.exists("_marks", lambda m: (m["ts"] >= F.col("ts")) & (m["when"] > _when("_put")))
        out = met.filter(~F.coalesce(hidden, F.lit(False))).drop("_marks")
    exact = marks.filter("kind = 'column'").groupBy(*VERSION).agg(F.max(_when()).alias("_mark"))
    met = skew_join(out, exact, VERSION, "left", skewed=False)
    return met.filter(F.col("_mark").isNull() | (F.col("_mark") < _when("_put"))).drop("_mark")


def _worked_out(puts: DataFrame, marks: DataFrame | None, added: DataFrame) -> DataFrame:
    """The versions that additions make, as puts of their batches.

    Each addition needs the newest version that is there before it, so of a cell's puts in a batch the newest are enough:
    one, and one more for each single version that is marked.
    """
    cells = added.select(*CELL).distinct()
    small, more = is_small(cells), 1
    events = added.select(*CELLS, "kind", *ORDER)
    if marks is not None:
        wide = None
        for kind, keys in {**_SCOPES, "column": CELL}.items():
            own = marks.filter(F.col("kind") == kind)
            met = skew_join(cells, own.select(*keys, "ts", *ORDER), keys, skewed=False) if keys == CELL else own.select(
                *keys, "ts", *ORDER).join(shuffled(cells, small), keys)
            met = met.select(*VERSION, F.lit(None).cast("string").alias("value"), F.lit(kind).alias("kind"), *ORDER)
            wide = met if wide is None else wide.unionByName(met)
        events = events.unionByName(wide)
        more += wide.filter("kind = 'column'").groupBy(*CELL).count().agg(F.max("count")).first()[0] or 0
    near = skew_join(puts, cells, CELL, "left_semi", small_side=small)
    near = top_n(near, [*CELL, "batch_id", "run"], [F.col("ts").desc()], more)
    events = events.unionByName(near.select(*CELLS, F.lit("put").alias("kind"), *ORDER))
    ordered = events.repartition(*CELL).sortWithinPartitions(*CELL, *ORDER).select(*CELLS, "kind", *ORDER)
    return ordered.mapInArrow(_fold, f"{ROW}, batch_id bigint, run string, late int")


def _fold(batches):
    """Events sorted by cell and order: what each addition makes."""
    now, there = None, {}
    for batch in batches:
        out = []
        for row, family, qualifier, ts, value, kind, batch_id, run, late in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            cell = row, family, qualifier
            if cell != now:
                now, there = cell, {}
            if kind == "put":
                there[ts] = value
            elif kind == "column":
                there.pop(ts, None)
            elif kind in ("row", "family", "columns"):
                there = {t: v for t, v in there.items() if t > ts}
            else:
                last = max(there, default=None)
                old = there.get(last)
                if kind == "count":
                    try:
                        value = str((0 if old is None else int(old)) + int(value))
                    except ValueError:
                        raise ValueError(f"no counter: {old}") from None
                else:
                    value = (old or "") + value
                ts = ts if last is None else max(ts, last)
                there[ts] = value
                out.append((*cell, ts, value, batch_id, run, late))
        columns = list(zip(*out, strict=True)) if out else [()] * 8
        types = (*[pa.string()] * 3, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                         [*CELLS, *ORDER])
