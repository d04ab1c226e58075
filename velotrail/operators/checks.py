"""Conditional changes: mutate a row only if a stored value passes a check.

A chain is a set of checks that can influence each other: all checks of a row, or of one
cell where every check of the row changes only the cell it looks at.  A check whose cell no
earlier check of its chain may change is answered by a join.  Only the others must run in ``seq``
order: with the changes of answered checks among them they are sorted within partitions and
folded as a stream that holds just the current chain's cell values.  A long chain on one cell is
cut into segments that run side by side (``chains``); one that touches several cells is one
stream in one task, and of n such checks costs n steps there.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotrail.operators import chains as long_chains
from velotrail.operators.cells import CELL, newest, restrict
from velotrail.operators.mutations import ROW_FAMILY, mutate_rows
from velotrail.plans.scratch import write_out
from velotrail.plans.skew import is_small, shuffled, skew_join

OPS = ("<", "<=", "=", "<>", ">=", ">", "exists")

_CHAIN = ["row_key", "_chain_family", "_chain_qualifier"]
_STEP = "struct<step:bigint,family:string,qualifier:string,op:string,value:string>"


def holds(stored: Column, op: Column, expected: Column) -> Column:
    """``stored <op> expected`` in byte order.

    Without a stored value only ``= null`` holds; with one, ``<> null`` holds and ``exists`` does.
    """
    both = (
        F.when(op == "<", stored < expected).when(op == "<=", stored <= expected)
        .when(op == "=", stored == expected).when(op == "<>", stored != expected)
        .when(op == ">=", stored >= expected).when(op == ">", stored > expected)
    )
    return (
        F.when(stored.isNull(), (op == "=") & expected.isNull())
        .when(op == "exists", F.lit(True))
        .when(expected.isNull(), op == "<>")
        .otherwise(both)
    )


def check_and_mutate(
    cells: DataFrame, checks: DataFrame, mutations: DataFrame, now_ms: int
) -> tuple[DataFrame, DataFrame]:
    """(cells, outcome).  ``checks``: seq (unique), row_key, family, qualifier, op, expected.
    ``mutations``: seq of their check, step (order in it), family, qualifier, op, value.
    ``outcome``: seq, row_key, passed.  Changes are made at ``now_ms``, or at the newest time stored in the checked rows if
    that is later, so that a later check sees them.
    """
    small = is_small(checks) and is_small(mutations)
    # Written once: the answers decide both results and must not be worked out twice.
    outcome = write_out(_outcome(cells, checks, mutations, small), "outcome")
    passed = outcome.filter("passed").select(F.col("seq").alias("_check"), "row_key")
    applied = mutations.withColumnRenamed("seq", "_check").join(shuffled(passed, small), "_check").withColumn(
        "seq", F.struct("_check", "step")
    )
    latest = restrict(cells, checks, ["row_key"], small).agg(F.max("ts")).first()[0]
    return mutate_rows(cells, applied, max(now_ms, latest if latest is not None else now_ms), small), outcome


def _outcome(cells: DataFrame, checks: DataFrame, mutations: DataFrame, small: bool) -> DataFrame:
    known = F.col("op").isin(*OPS)
    failure = F.raise_error(F.concat(F.lit("unknown comparison: "), F.coalesce("op", F.lit("null"))))
    checks = checks.filter(F.when(known, F.lit(True)).otherwise(failure.cast("boolean")))
    steps = mutations.groupBy("seq").agg(
        F.array_sort(F.collect_list(F.struct("step", "family", "qualifier", "op", "value"))).alias("steps")
    )
    own = F.forall(
        F.coalesce("steps", F.array().cast(f"array<{_STEP}>")),
        lambda s: s["family"].eqNullSafe(F.col("family")) & s["qualifier"].eqNullSafe(F.col("qualifier")),
    )
    asked = checks.join(shuffled(steps, small), "seq", "left").withColumn("_own", own)
    per_cell = asked.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_cell_n"), F.min("_own").alias("_cell_own"))
    per_row = per_cell.groupBy("row_key").agg(F.sum("_cell_n").alias("_row_n"), F.min("_cell_own").alias("_row_own"))
    chains = skew_join(per_cell, per_row, ["row_key"], small_side=small).select(
        *CELL,
        F.when(F.col("_row_own"), F.col("family")).otherwise("").alias("_chain_family"),
        F.when(F.col("_row_own"), F.col("qualifier")).otherwise("").alias("_chain_qualifier"),
        F.when(F.col("_row_own"), F.col("_cell_n")).otherwise(F.col("_row_n")).alias("_length"),
    )
    stored = newest(restrict(cells, checks, CELL, small)).select(*CELL, F.col("value").alias("_stored"))
    # One row per checked cell: its chain and its value before the checks.
    states = chains.join(shuffled(stored, small), CELL, "left")
    # Stored values may be of any length, so with few checks it is left to Spark whether to broadcast them.
    sized = asked.drop("_own")
    sized = sized.join(states, CELL) if small else skew_join(sized, states, CELL, small_side=False)

    passed = holds(F.col("_stored"), F.col("op"), F.col("expected")).alias("passed")
    single = sized.filter(F.col("_length") == 1).select("seq", "row_key", passed)
    free = _unchanged(sized.filter(F.col("_length") > 1), asked, small).withColumn("passed", F.when(F.col("_free"), passed))
    answers = single.unionByName(free.filter("_free").select("seq", "row_key", "passed"))

    # Chains that have checks to run, with the changes of the answered ones.
    open_ = shuffled(free.filter(~F.col("_free")).select(*_CHAIN).distinct(), small)
    acts = free.filter(~F.col("_free") | (F.col("passed") & (F.size("steps") > 0))).join(open_, _CHAIN, "left_semi")
    steps_type = f"array<{_STEP}>"
    before = states.filter((F.col("_length") > 1) & F.col("_stored").isNotNull()).join(open_, _CHAIN, "left_semi").select(
        *_CHAIN, "family", "qualifier", F.col("_stored").alias("expected"))
    acts = acts.select(*_CHAIN, F.col("seq").cast("bigint").alias("seq"), "family", "qualifier", "op", "expected", "passed",
                       F.col("steps").cast(steps_type).alias("steps"))
    if checks.groupBy(*CELL).count().filter(F.col("count") > long_chains.SEGMENT).limit(1).count():
        acts, before = _side_by_side(acts, before)
    stream = acts.select(
        *_CHAIN, F.lit(True).alias("check"), "seq", "family", "qualifier", "op", "expected", "passed", "steps",
    )
    begin = before.select(
        *_CHAIN, F.lit(False).alias("check"), F.lit(0).cast("bigint").alias("seq"), "family", "qualifier",
        F.lit("").alias("op"), "expected", F.lit(None).cast("boolean").alias("passed"),
        F.lit(None).cast(steps_type).alias("steps"),
    )
    # By a hash of the chain: both parts are already placed by the chain itself, but not by the same tasks.
    together = begin.unionByName(stream).repartition(F.xxhash64(*_CHAIN))
    stream = together.sortWithinPartitions(*_CHAIN, "check", "seq")
    folded = stream.mapInArrow(_fold_functions()[1], "seq bigint, row_key string, passed boolean")
    return answers.unionByName(folded)


def _side_by_side(acts: DataFrame, before: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The acts and first values of all chains; long ones on one cell as several chains."""
    # Chains on one cell have its names; those on several have none.
    counts = acts.filter("_chain_qualifier <> ''").groupBy(*_CHAIN).count().filter(F.col("count") > long_chains.SEGMENT)
    long_ = write_out(counts.select(*_CHAIN), "long-chains")
    if not long_.limit(1).count():
        return acts, before
    few = F.broadcast(long_)  # a chain has more than SEGMENT checks
    cut_acts, starts = long_chains.cut(acts.join(few, _CHAIN, "left_semi"), before.join(few, _CHAIN, "left_semi"))
    return (acts.join(few, _CHAIN, "left_anti").unionByName(cut_acts),
            before.join(few, _CHAIN, "left_anti").unionByName(starts))


def _unchanged(sized: DataFrame, asked: DataFrame, small: bool) -> DataFrame:
    """``sized`` with ``_free``: no earlier check of the row has a step on the check's cell or on its whole family."""
    steps = asked.select("row_key", "seq", F.explode("steps").alias("s")).select("row_key", "seq", "s.family", "s.qualifier")
    by_cell = steps.filter(F.col("qualifier").isNotNull()).groupBy(*CELL).agg(F.min("seq").alias("_cell_first"))
    by_family = steps.filter(F.col("qualifier").isNull()).groupBy(*ROW_FAMILY).agg(F.min("seq").alias("_family_first"))
    marked = skew_join(sized, by_cell, CELL, "left", small_side=small)
    marked = skew_join(marked, by_family, ROW_FAMILY, "left", small_side=small)
    first = F.least("_cell_first", "_family_first")  # nulls are left out
    return marked.withColumn("_free", F.coalesce(first >= F.col("seq"), F.lit(True))).drop("_cell_first", "_family_first")


def _fold_functions():
    """(passes, fold).  Made inside a function so that they travel to the workers by value and
    need no copy of this package there."""
    compare = {"<": operator.lt, "<=": operator.le, "=": operator.eq, "<>": operator.ne, ">=": operator.ge, ">": operator.gt}

    def passes(stored: str | None, op: str, expected: str | None) -> bool:
        if stored is None:
            return op == "=" and expected is None
        if op == "exists":
            return True
        if expected is None:
            return op == "<>"
        return compare[op](stored, expected)

    def apply(state: dict, steps: list[dict]) -> dict:
        for s in steps:
            if s["op"] == "put":
                state[s["family"], s["qualifier"]] = s["value"]
            elif s["qualifier"] is None:
                state = {k: v for k, v in state.items() if k[0] != s["family"]}
            else:
                state.pop((s["family"], s["qualifier"]), None)
        return state

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Run sorted chains: rows that are no check set a cell's value before the checks begin."""
        chain, state = None, {}
        for batch in batches:
            out = []
            for row, cf, cq, check, seq, family, qualifier, op, expected, known, steps in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if (row, cf, cq) != chain:
                    chain, state = (row, cf, cq), {}
                if not check:
                    state[family, qualifier] = expected
                    continue
                passed = known
                if known is None:
                    passed = passes(state.get((family, qualifier)), op, expected)
                    out.append((seq, row, passed))
                if passed and steps:
                    state = apply(state, steps)
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            kinds = (pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["seq", "row_key", "passed"]
            )

    return passes, fold


def check_and_put(cells: DataFrame, checks: DataFrame, now_ms: int) -> tuple[DataFrame, DataFrame]:
    """Put if the stored value equals ``expected``, or is absent when that is null.

    ``checks``: seq, row_key, family, qualifier, expected, put_family, put_qualifier, put_value.
    """
    puts = checks.select(
        "seq", F.lit(0).cast("bigint").alias("step"), F.col("put_family").alias("family"),
        F.col("put_qualifier").alias("qualifier"), F.lit("put").alias("op"), F.col("put_value").alias("value"),
    )
    return check_and_mutate(cells, _equal(checks), puts, now_ms)


def check_and_delete(cells: DataFrame, checks: DataFrame, now_ms: int) -> tuple[DataFrame, DataFrame]:
    """Delete (a family if ``delete_qualifier`` is null) under the same condition.

    ``checks``: seq, row_key, family, qualifier, expected, delete_family, delete_qualifier.
    """
    removals = checks.select(
        "seq", F.lit(0).cast("bigint").alias("step"), F.col("delete_family").alias("family"),
        F.col("delete_qualifier").alias("qualifier"), F.lit("delete").alias("op"),
        F.lit(None).cast("string").alias("value"),
    )
    return check_and_mutate(cells, _equal(checks), removals, now_ms)


def _equal(checks: DataFrame) -> DataFrame:
    return checks.select("seq", "row_key", "family", "qualifier", F.lit("=").alias("op"), "expected")
