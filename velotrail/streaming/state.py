"""Recent sets and running reports as the state of a stream.

Recent sets: what is kept is what the state store holds.

Each vehicle has a list state with its ``n`` newest members, sorted, in the state store below the checkpoint on the shared folder.
A batch merges its members into the lists and cuts them, so a vehicle never holds more, and Spark's own recovery makes a
repeated batch count once.  The sets are read from the store.  Before the shuffle every task cuts its own rows to ``n`` for each
vehicle, so that a vehicle with a large share of a batch sends little; ``pieces`` splits each vehicle over several lists,
which are merged on reading, where even that is too much for one task.

Reports: a vehicle's open group of samples and its count so far are values that go from batch to batch, so that the groups and
marks are those of ``delay_report`` and ``progress_marks`` over all rows, however these are cut into batches, as long as batches come
in order of arrival.  What a batch completes is written to a folder of its own, so a repeated batch changes nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from velotrail.operators.latency import DELAYS, delays
from velotrail.operators.parse import parse_line, score_of
from velotrail.operators.recent import keep_last_n, with_member
from velotrail.plans.scratch import setting
from velotrail.sources.tables import read_report, write_report
from velotrail.streaming.jobs import run_of, start, with_arrival

# The functions travel to the workers as code, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MEMBER = "score double, line string, arrival_ms bigint"
CHANGED = f"vehicle_id string, piece int, held bigint, {MEMBER}"
POINT = f"vehicle_id string, piece int, {MEMBER}"
#: Rows that a task gathers before it cuts them.
GATHERED = 200_000


def _order(member: tuple) -> tuple:
    """By score, then by the member's text as bytes."""
    score, line, arrival_ms = member
    return score, f"{line}@{arrival_ms}".encode()


def merged(held: Iterator[tuple], new: Iterator[tuple], n: int, dedup: str) -> list[tuple]:
    """The ``n`` highest of all members, ascending; a line that comes again keeps its first arrival, unless dedup='member'."""
    if dedup == "member":
        every = {*map(tuple, held), *map(tuple, new)}
    else:
        first: dict[tuple, int] = {}
        for rows in (held, new):
            for score, line, arrival_ms in rows:
                known = first.get((score, line))
                first[score, line] = arrival_ms if known is None else min(known, arrival_ms)
        every = {(*key, arrival_ms) for key, arrival_ms in first.items()}
    return sorted(every, key=_order)[-n:]


def _cut(n: int, dedup: str):
    """Rows of POINT: of each vehicle's piece, as far as a task has gathered them, the newest ``n``."""

    def cut(gathered: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(gathered, ignore_index=True)
        keys = ["vehicle_id", "piece", "score", "line"]
        if dedup == "member":
            rows = rows.drop_duplicates()
        else:
            rows = rows.groupby(keys, as_index=False, sort=False)["arrival_ms"].min()
        large = rows.groupby(keys[:2])["score"].transform("size") > n
        # The n-th highest score bounds what can be among the newest; ties with it stay for the state to settle.
        low = rows[large].groupby(keys[:2])["score"].transform(lambda s: s.nlargest(n).iloc[-1])
        return pd.concat([rows[~large], rows[large][rows[large]["score"] >= low]])

    def run(batches):
        gathered, size = [], 0
        for batch in batches:
            gathered.append(batch)
            size += len(batch)
            if size >= GATHERED:
                yield cut(gathered)
                gathered, size = [], 0
        if gathered:
            yield cut(gathered)

    return run


class Newest(StatefulProcessor):
    """The newest ``n`` members of one vehicle's piece; gives the newest and how many are held whenever rows came."""

    def __init__(self, n: int, dedup: str):
        self.n, self.dedup = n, dedup

    def init(self, handle) -> None:
        self.members = handle.getListState("members", MEMBER)

    def handleInputRows(self, key, rows, timer_values):  # noqa: N802 (Spark's name)
        kept = merged(self.members.get(), ((r.score, r.line, r.arrival_ms) for r in rows), self.n, self.dedup)
        self.members.put(kept)
        score, line, arrival_ms = kept[-1]
        yield Row(vehicle_id=key[0], piece=key[1], held=len(kept), score=score, line=line, arrival_ms=arrival_ms)

    def close(self) -> None:
        pass


def _nothing(batch: DataFrame, batch_id: int) -> None:
    batch.write.format("noop").mode("overwrite").save()


def start_recent_state(
    lines: DataFrame, checkpoint: str, n: int = 1000, dedup: str = "line", mode: str = "strict", pieces: int = 1,
    changed: Callable[[DataFrame, int], None] | None = None, **when,
) -> StreamingQuery:
    """Keep the ``n`` newest members of each vehicle in the state below ``checkpoint``; read them with ``read_recent_state``.

    ``changed`` gets, for each batch, a row of CHANGED for every vehicle's piece that rows came for: the newest member and how
    many are held.  In lenient mode bad lines are left out.  ``n``, ``dedup`` and ``pieces`` stay the same for a checkpoint.
    """
    if dedup not in ("line", "member"):
        raise ValueError(f"dedup must be 'line' or 'member', not {dedup!r}")
    track = _track(lines, mode)
    piece = F.pmod(F.xxhash64("line"), F.lit(pieces)).cast("int").alias("piece")
    points = track.select("vehicle_id", piece, score_of(F.col("line")).alias("score"), "line", "arrival_ms")
    few = points.mapInPandas(_cut(n, dedup), POINT)
    changes = few.groupBy("vehicle_id", "piece").transformWithState(Newest(n, dedup), CHANGED, "Update", "None")
    with setting(lines.sparkSession, PROVIDER, ROCKS):  # the query keeps the settings it starts with
        return start(changes, changed or _nothing, checkpoint, output="update", **when)


def read_recent_state(spark: SparkSession, checkpoint: str, n: int = 1000, batch_id: int | None = None) -> DataFrame:
    """The ``n`` newest members of each vehicle that the state holds, after the last batch or after ``batch_id``."""
    reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "members")
    state = (reader if batch_id is None else reader.option("batchId", batch_id)).load()
    return keep_last_n(with_member(state.select("key.vehicle_id", "list_element.*")), n)


SUMS = "count bigint, send_to_write bigint, write_to_read bigint, send_to_read bigint"
REPORT = ("vehicle_id string, group_no bigint, n bigint, " + ", ".join(f"avg_{d} bigint" for d in DELAYS) + ", "
          + ", ".join(f"mean_{d} double" for d in DELAYS))
MARK = "vehicle_id string, running_count bigint, arrival_ms bigint"


def _in_order(rows) -> list:
    """A batch's rows of one vehicle by arrival and line, as bytes."""
    return sorted(rows, key=lambda r: (r.arrival_ms, r.line.encode()))


class DelayGroups(StatefulProcessor):
    """Averages of each ``every`` samples of a vehicle; the open group is the state."""

    def __init__(self, every: int):
        self.every = every

    def init(self, handle) -> None:
        self.open = handle.getValueState("open", SUMS)

    def handleInputRows(self, key, rows, timer_values):  # noqa: N802 (Spark's name)
        count, *sums = self.open.get() if self.open.exists() else (0, 0, 0, 0)
        for r in _in_order(rows):
            count += 1
            sums = [s + r[d] for s, d in zip(sums, DELAYS, strict=True)]
            if count % self.every == 0:
                yield Row(vehicle_id=key[0], group_no=count // self.every - 1, n=self.every, **{f"avg_{d}": s // self.every for d, s in zip(DELAYS, sums, strict=True)},
                          **{f"mean_{d}": s / self.every for d, s in zip(DELAYS, sums, strict=True)})
                sums = [0, 0, 0]
        self.open.update((count, *sums))

    def close(self) -> None:
        pass


class Marks(StatefulProcessor):
    """Every ``every``-th row of a vehicle; its count so far is the state."""

    def __init__(self, every: int):
        self.every = every

    def init(self, handle) -> None:
        self.so_far = handle.getValueState("count", "count bigint")

    def handleInputRows(self, key, rows, timer_values):  # noqa: N802 (Spark's name)
        count = self.so_far.get()[0] if self.so_far.exists() else 0
        for r in _in_order(rows):
            count += 1
            if count % self.every == 0:
                yield Row(vehicle_id=key[0], running_count=count, arrival_ms=r.arrival_ms)
        self.so_far.update((count,))

    def close(self) -> None:
        pass


def _start_report(rows: DataFrame, processor: StatefulProcessor, schema: str, path: str, checkpoint: str, **when) -> StreamingQuery:
    found = rows.groupBy("vehicle_id").transformWithState(processor, schema, "Update", "None")

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_report(batch, path, run_of(batch.sparkSession, checkpoint), batch_id)

    with setting(rows.sparkSession, PROVIDER, ROCKS):  # the query keeps the settings it starts with
        return start(found, sink, checkpoint, output="update", **when)


def _track(lines: DataFrame, mode: str) -> DataFrame:
    parsed = parse_line(with_arrival(lines), mode=mode)
    return parsed if mode == "strict" else parsed[0]


def start_delay_report(lines: DataFrame, path: str, checkpoint: str, now_ms: int, every: int = 100, mode: str = "strict", **when) -> StreamingQuery:
    """A running ``delay_report``; the groups that a batch completes are added to ``path`` (see ``read_delay_report``)."""
    rows = delays(_track(lines, mode), now_ms).select("vehicle_id", "arrival_ms", "line", *DELAYS)
    return _start_report(rows, DelayGroups(every), REPORT, path, checkpoint, **when)


def start_progress_marks(lines: DataFrame, path: str, checkpoint: str, every: int = 100_000, mode: str = "strict", **when) -> StreamingQuery:
    """Running ``progress_marks`` per vehicle, added to ``path`` (see ``read_progress_marks``)."""
    return _start_report(_track(lines, mode).select("vehicle_id", "arrival_ms", "line"), Marks(every), MARK, path, checkpoint, **when)


def read_delay_report(spark: SparkSession, path: str) -> DataFrame:
    return read_report(spark, path, REPORT)


def read_progress_marks(spark: SparkSession, path: str) -> DataFrame:
    return read_report(spark, path, MARK)
