"""The log of a table: which batches and which settled copies a reader takes.

A table lies in a folder with four others below it.  ``live/run=<id>/batch_id=<n>`` holds the rows of a batch, and
``settled/version=<k>`` a copy of all rows that earlier copies and batches had.  ``log`` has an empty file for each batch that is
complete and in no copy yet, and one for each complete copy, so one listing of names is all that a reader needs, whatever
number of batches there ever were.  ``covered/version=<k>`` remembers what a copy took, for cleaning up.

A batch's file is made after its rows, so nobody reads half of one.  A copy's file is made before those of the batches that it
took are deleted, and a reader lists batches before copies, so it may see a batch twice but never misses one; the tables settle
rows that come twice.  A batch that comes late, with whatever number, or is written again after a copy took it, has a file
again and is read with the copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrail.operators.history import bucket_of
from velotrail.plans.skew import is_small, shuffled

#: Runs of single calls; their one batch is complete once it is there.
CALL = "call-"
BATCH_SCHEMA = "run string, batch_id bigint"


def new_run() -> str:
    """A run of its own for one call."""
    return CALL + uuid.uuid4().hex


@dataclass(frozen=True)
class Snapshot:
    """What a read takes: a settled copy (0: none) and batches.  Later writes and copies don't change what it stands for."""

    version: int
    batches: tuple[tuple[str, int], ...]


class Log:
    """The names in a table's ``log`` folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, kind: str) -> list[str]:
        found = self._fs.globStatus(self._at(f"{self.path}/log/{kind}~*"))
        return [f.getPath().getName().removeprefix(f"{kind}~") for f in found or []]

    def _mark(self, name: str) -> None:
        self._fs.create(self._at(f"{self.path}/log/{name}"), True).close()

    def _drop(self, name: str) -> None:
        self._fs.delete(self._at(f"{self.path}/{name}"), True)

    def snapshot(self) -> Snapshot:
        # Batches first: what is gone from them by then is in a copy that the second listing shows.
        batches = sorted((unquote(run), int(n)) for run, n in (x.rsplit("~", 1) for x in self._names("batch")))
        return Snapshot(max((int(v) for v in self._names("copy")), default=0), tuple(batches))

    def folder(self, run: str, batch_id: int) -> str:
        return f"{self.path}/live/run={quote(run, safe='')}/batch_id={batch_id}"

    def settled(self, version: int) -> str:
        return f"{self.path}/settled/version={version}"

    def add(self, run: str, batch_id: int) -> None:
        """A batch is complete."""
        self._mark(f"batch~{quote(run, safe='')}~{batch_id}")

    def settle(self, version: int, batches: Iterable[tuple[str, int]]) -> None:
        """A copy is complete that holds these batches."""
        batches = list(batches)
        taken = self.spark.createDataFrame(batches, BATCH_SCHEMA)
        taken.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/covered/version={version}")
        self._mark(f"copy~{version}")
        for run, n in batches:
            self._drop(f"log/batch~{quote(run, safe='')}~{n}")

    def covered(self, run: str, batch_id: int) -> bool:
        """Whether a copy has taken the batch."""
        rows = stored(self.spark, f"{self.path}/covered", f"{BATCH_SCHEMA}, version bigint")
        return bool(rows.filter((F.col("run") == run) & (F.col("batch_id") == batch_id)).limit(1).count())

    def clean(self) -> int:
        """Delete the batches that the newest copy holds, and older copies; the number of batches deleted.

        Not while someone reads an older snapshot or writes a covered batch again.  That batches of named runs were taken stays
        known.
        """
        now = self.snapshot()
        rows = stored(self.spark, f"{self.path}/covered", f"{BATCH_SCHEMA}, version bigint").filter(F.col("version") <= now.version)
        rows = rows.filter(F.col("version") >= 0)
        named = rows.filter(~F.col("run").startswith(CALL)).select("run", "batch_id")
        if named.limit(1).count():
            # Version -1, -2, ... are what cleaning has put together: one file for each time.
            least = min(0, stored(self.spark, f"{self.path}/covered", f"{BATCH_SCHEMA}, version bigint").agg(F.min("version")).first()[0])
            named.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/covered/version={least - 1}")
        gone = 0
        for run, n in {(r.run, r.batch_id) for r in rows.toLocalIterator()} - set(now.batches):
            self._drop(self.folder(run, n).removeprefix(f"{self.path}/"))
            gone += 1
        for text in self._names("copy"):
            if int(text) < now.version:
                self._drop(f"settled/version={text}")
                self._drop(f"index/version={text}")
                self._drop(f"log/copy~{text}")
            self._drop(f"covered/version={text}")
        return gone


def stored(spark: SparkSession, path: str, schema: str, paths: list[str] | None = None) -> DataFrame:
    """The files below ``path`` (or ``paths`` there); none if it is not there yet."""
    if paths is not None and not paths:
        return spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(*(paths or [path]))
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def only(rows: DataFrame, ids: DataFrame, key: str, buckets: int) -> DataFrame:
    """The stored ``rows`` whose ``key`` is in ``ids``.  A few ids are broadcast with their buckets, and other buckets are not opened."""
    asked = ids.select(key).distinct().withColumn("bucket", bucket_of(F.col(key), buckets))
    # Spark prunes partitions at run time only if the other side has a comparison.
    asked = asked.filter(F.col("bucket") < buckets)
    return rows.join(F.broadcast(asked) if is_small(asked) else shuffled(asked), ["bucket", key], "left_semi").select(*rows.columns)
