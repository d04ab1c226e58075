"""Long chains of checks on one cell, over several tasks.

A chain of checks that all look at one cell and change only it is cut into segments.  What a segment does depends on the value
it begins with, and only on how that compares with the values its checks expect: for each of these, and for what lies
between two of them, a segment either leaves the value as it is or ends with a value of its own.  So a segment is a table of
results, made without knowing the value.  Going over the tables gives each segment the value it begins with, and then all
segments are run at once.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right, insort

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrail.functions.text import whole_parts
from velotrail.plans.ranks import group_rank
from velotrail.plans.scratch import write_out

# The functions travel to the workers as code, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Checks of a segment; chains with more are cut.
SEGMENT = 20_000
CHAIN = ["row_key", "_chain_family", "_chain_qualifier"]
_KEYS = "row_key string, _chain_family string, _chain_qualifier string, segment bigint"
#: ``results`` begins with that for no value; then come, by turns, what lies before a point and the point itself.
TABLE = f"{_KEYS}, points array<string>, same array<boolean>, results array<string>"


def effect(steps: list[dict] | None) -> tuple[bool, str | None]:
    """Whether the steps change the cell, and the value they leave (None: none)."""
    return (False, None) if not steps else (True, steps[-1]["value"] if steps[-1]["op"] == "put" else None)


class _Groups:
    """Values that begin alike and what has become of them: groups by their value now, joined when they become equal."""

    def __init__(self):
        self.values: list[str] = []
        self.group: dict[str | None, int] = {}
        self.parent: list[int] = []
        self.now: list[str | None] = []

    def find(self, g: int) -> int:
        while self.parent[g] != g:
            self.parent[g] = self.parent[self.parent[g]]
            g = self.parent[g]
        return g

    def at(self, value: str | None) -> int:
        """The group that has the value."""
        if value not in self.group:
            self.group[value] = len(self.parent)
            self.parent.append(len(self.parent))
            self.now.append(value)
            if value is not None:
                insort(self.values, value)
        return self.group[value]

    def passing(self, op: str, expected: str | None) -> list[str | None]:
        """Values of groups for which the check holds."""
        if expected is None:
            if op == "=":
                return [None] if None in self.group else []
            return list(self.values) if op in ("<>", "exists") else []
        if op == "=":
            return [expected] if expected in self.group else []
        low, high = bisect_left(self.values, expected), bisect_right(self.values, expected)
        return {"<": self.values[:low], "<=": self.values[:high], ">": self.values[high:], ">=": self.values[low:],
                "<>": self.values[:low] + self.values[high:], "exists": list(self.values)}[op]

    def become(self, old: list[str | None], value: str | None) -> int:
        """Groups with the ``old`` values get the new one."""
        moved = [self.group.pop(v) for v in old]
        gone = {v for v in old if v is not None}
        if len(gone) > 8:
            self.values = [v for v in self.values if v not in gone]
        else:
            for v in gone:
                del self.values[bisect_left(self.values, v)]
        target = self.at(value)
        for g in moved:
            self.parent[self.find(g)] = target
        return target


def results_of(checks: list[tuple]) -> tuple[list[str], list[bool], list[str | None]]:
    """(points, same, results) of a segment: (op, expected, passed if known, steps) in order.

    Each piece of what the value may be is settled once, by the first check that holds for it and changes the cell; from
    there on it is in the group of its value.
    """
    points = sorted({expected for _, expected, _, _ in checks if expected is not None})
    place = {p: k for k, p in enumerate(points)}
    n = 2 * len(points) + 2
    after = list(range(n + 1))  # the next piece that is not settled
    group: list[int | None] = [None] * n
    groups = _Groups()

    def next_(k: int) -> int:
        while after[k] != k:
            after[k] = after[after[k]]
            k = after[k]
        return k

    for op, expected, passed, steps in checks:
        changes, value = effect(steps)
        if not changes or passed is False:
            continue
        if passed:
            ranges, old = [(0, n)], list(groups.group)
        else:
            old = groups.passing(op, expected)
            if expected is None:
                ranges = [(0, 1)] if op == "=" else [(1, n)] if op in ("<>", "exists") else []
            else:
                at = 2 * place[expected] + 2
                ranges = {"=": [(at, at + 1)], "<": [(1, at)], "<=": [(1, at + 1)], ">": [(at + 1, n)], ">=": [(at, n)],
                          "<>": [(1, at), (at + 1, n)], "exists": [(1, n)]}[op]
        target = groups.become(old, value) if old else None
        for low, high in ranges:
            k = next_(low)
            while k < high:
                target = groups.at(value) if target is None else target
                group[k] = target
                after[k] = k + 1
                k = next_(k)
    ends = [None if g is None else groups.now[groups.find(g)] for g in group]
    return points, [g is None for g in group], ends


def result_for(value: str | None, points: list[str], same: list[bool], results: list[str | None]) -> str | None:
    """What a segment leaves of the value it begins with."""
    if value is None:
        k = 0
    else:
        at = bisect_left(points, value)
        k = 2 * at + (2 if at < len(points) and points[at] == value else 1)
    return value if same[k] else results[k]


def _tables(batches):
    """Rows sorted by chain, segment and seq: a table for each segment."""
    key, held = None, []

    def out():
        points, same, results = results_of(held)
        columns = [*([k] for k in key), [points], [same], [results]]
        kinds = (*[pa.string()] * 3, pa.int64(), pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                          [c.split()[0] for c in TABLE.split(", ")])

    for batch in batches:
        for *now, op, expected, passed, steps in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now != key:
                if key is not None:
                    yield out()
                key, held = now, []
            held.append((op, expected, passed, steps))
    if key is not None:
        yield out()


def _entries(batches):
    """Tables sorted by chain and segment, each with the cell's value before all checks: the value before each segment."""
    chain, value = None, None
    for batch in batches:
        out = []
        for row, family, qualifier, segment, points, same, results, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (row, family, qualifier) != chain:
                chain, value = (row, family, qualifier), first
            out.append((*chain, segment, value))
            value = result_for(value, points, same, results)
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        kinds = (*[pa.string()] * 3, pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], [*CHAIN, "segment", "entry"])


def cut(acts: DataFrame, begin: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``acts`` (CHAIN, seq, op, expected, passed, steps, ...) and ``begin`` (CHAIN, expected) of long one-cell chains, as
    chains of their own for each segment: a running number goes behind the chain's qualifier."""
    ranked = group_rank(acts, CHAIN, [F.col("seq")], "_rank")
    placed = write_out(ranked.withColumn("segment", whole_parts(F.col("_rank"), SEGMENT)).drop("_rank"), "segments")
    each = placed.select(*CHAIN, "segment", "seq", "op", "expected", "passed", "steps")
    ordered = each.repartition(*CHAIN, "segment").sortWithinPartitions(*CHAIN, "segment", "seq").drop("seq")
    tables = ordered.mapInArrow(_tables, TABLE).join(begin.select(*CHAIN, F.col("expected").alias("first")), CHAIN, "left")
    entries = tables.repartition(*CHAIN).sortWithinPartitions(*CHAIN, "segment").mapInArrow(_entries, f"{_KEYS}, entry string")
    entries = write_out(entries, "entries")
    named = F.concat("_chain_qualifier", F.lit("\\u0001"), F.col("segment").cast("string"))
    cut_acts = placed.withColumn("_chain_qualifier", named).drop("segment")
    starts = entries.filter("entry IS NOT NULL").select(
        "row_key", "_chain_family", named.alias("_chain_qualifier"), F.col("_chain_family").alias("family"),
        F.col("_chain_qualifier").alias("qualifier"), F.col("entry").alias("expected"))
    return cut_acts, starts
