"""Hot keys, joins and top-n that hold when one key owns a large share of all rows.

The same idea everywhere: measure the keys once with a small sketch per task (only key
columns are read), and split only the keys that turn out to be hot.  Data without hot keys
gets the ordinary plan.  A key that the sketch does not report costs time, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A key with fewer rows than this is never split; a larger one is cut into pieces of about so many.
HOT_ROWS = 5_000_000
#: At most this many keys are split.
MAX_HOT = 4_096
#: Keys that a sketch tracks (its table has 8,192 places), and groups its merging starts with.
TRACKED = 6_144
MERGE_GROUPS = 256
#: Up to this n a task sends so few rows of a key (Spark limits each window group before the
#: shuffle) that even a key with a third of all rows is small where it arrives.
PLAIN_TOP = 100
#: A side is broadcast only below both of these, checked on the data itself.
SMALL_ROWS = 100_000
SMALL_BYTES = 32 * 1024 * 1024

_SALT = "_salt"
_HOT = "_hot"
#: Pieces of a hot key.
PIECES = "_pieces"


def key_text(keys: Sequence[str]) -> Column:
    """A key as one text.  Two keys may share a text; then both are treated alike on both sides."""
    return F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys])


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> DataFrame | None:
    """Texts of the keys with more than ``hot_rows`` rows (at most ``MAX_HOT`` of them) with the pieces to cut them into, or None.

    A frequent-items sketch and not a count per key: what is shuffled does not grow with the
    number of keys.  Sketches of the tasks are merged in groups first.  It never misses a key
    with more than ``7 / 8192`` of all rows, and counts exactly while there are few keys.
    """
    limit = HOT_ROWS if hot_rows is None else hot_rows
    texts = df.select(key_text(keys).alias("_text"))
    # One empty text more, because sketches of nothing cannot be merged.
    texts = texts.union(df.sparkSession.range(1).select(F.lit("")))
    parts = texts.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    sketches = parts.groupBy("_group").agg(F.expr(f"approx_top_k_accumulate(_text, {TRACKED})").alias("_sketch"))
    # A group, since without one a task that has no sketch would make an empty buffer, which Spark cannot pass on.
    top = sketches.groupBy(F.pmod("_group", F.lit(1))).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(_sketch, {TRACKED}), {MAX_HOT})").alias("_top"))
    items = top.first()["_top"]  # no more than MAX_HOT
    counts = [(t.item, t["count"] - (t.item == "")) for t in items]
    found = [(text, max(2, -(-n // max(limit, 1)))) for text, n in counts if n > limit]
    return df.sparkSession.createDataFrame(found, f"_hot_text string, {PIECES} bigint") if found else None


def flag_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame, name: str = _HOT, pieces: bool = False) -> DataFrame:
    """``df`` with a true/false column; ``hot`` has at most MAX_HOT rows, so it is broadcast.

    ``pieces`` keeps the number of pieces of hot keys as a column too.
    """
    marks = F.broadcast(hot.withColumn(name, F.lit(True)))
    flagged = (
        df.withColumn("_key_text", key_text(keys))
        .join(marks, F.col("_key_text") == F.col("_hot_text"), "left")
        .drop("_key_text", "_hot_text")
        .withColumn(name, F.coalesce(F.col(name), F.lit(False)))
    )
    return flagged if pieces else flagged.drop(PIECES)


def is_small(df: DataFrame) -> bool:
    """Whether ``df`` may be broadcast: its rows and bytes, added up in every task."""
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in df.columns]
    n, size = df.agg(F.count(F.lit(1)), F.sum(sum(sizes, F.lit(0)))).first()
    return n <= SMALL_ROWS and (size or 0) <= SMALL_BYTES


def shuffled(df: DataFrame, small: bool = False) -> DataFrame:
    """``df`` for the right side of a join: shuffled unless it is ``small``.

    Spark guesses sizes from compressed files and knows nothing of rows that are made after reading, so
    without a hint it would broadcast a table of any size through the driver.
    """
    return df if small else df.hint("merge")


def skew_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    small_side: bool | None = None,
    skewed: bool = True,
    hot_rows: int | None = None,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """``big JOIN small`` on ``keys`` where ``big`` (the left side) may have hot keys.

    ``how`` is any of inner, left, left_semi, left_anti: a left row meets exactly one copy of
    the right side, so splitting the left side does not change the result.  ``small_side`` is
    the answer of ``is_small`` if the caller has it; ``skewed=False`` says that ``keys`` are
    unique on the left, so there is nothing to measure.  ``count_in`` is a frame with the same keys that is cheaper to
    count than ``big`` and has no fewer rows of a key.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    keys = list(keys)
    if is_small(small) if small_side is None else small_side:
        return big.join(F.broadcast(small), keys, how)
    hot = hot_keys(big if count_in is None else count_in, keys, hot_rows) if skewed else None
    if hot is None:
        return big.join(shuffled(small), keys, how)
    rest = [c for c in big.columns if c not in keys] or keys
    salted = flag_hot(big, keys, hot, pieces=True).withColumn(
        _SALT, F.when(F.col(_HOT), F.pmod(F.xxhash64(*rest), F.col(PIECES))).otherwise(F.lit(0).cast("bigint"))
    ).drop(_HOT, PIECES)
    copies = flag_hot(small, keys, hot, pieces=True).withColumn(
        _SALT,
        F.explode(
            F.when(F.col(_HOT), F.sequence(F.lit(0).cast("bigint"), F.col(PIECES) - 1))
            .otherwise(F.array(F.lit(0).cast("bigint")))
        ),
    ).drop(_HOT, PIECES)
    return salted.join(shuffled(copies), [*keys, _SALT], how).drop(_SALT)


def match(
    left: DataFrame, right: DataFrame, keys: Sequence[str], hot_rows: int | None = None,
    small_side: bool | None = None,
) -> DataFrame:
    """Inner join where either side may repeat a key many times.

    Keys that are hot on the right are joined with the sides exchanged, so the side that is
    split is always the hot one.
    """
    keys = list(keys)
    if is_small(right) if small_side is None else small_side:
        return left.join(F.broadcast(right), keys)
    hot = hot_keys(right, keys, hot_rows)
    if hot is None:
        return skew_join(left, right, keys, small_side=False, hot_rows=hot_rows)
    left, right = flag_hot(left, keys, hot), flag_hot(right, keys, hot)
    cold = skew_join(
        left.filter(~F.col(_HOT)).drop(_HOT), right.filter(~F.col(_HOT)).drop(_HOT), keys,
        small_side=False, hot_rows=hot_rows,
    )
    turned = skew_join(
        right.filter(F.col(_HOT)).drop(_HOT), left.filter(F.col(_HOT)).drop(_HOT), keys, hot_rows=hot_rows
    )
    return cold.unionByName(turned)


def top_n(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    hot_rows: int | None = None,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """The first ``n`` rows of each key; for a large ``n`` hot keys are reduced in pieces first.

    ``count_in`` is a frame with the same keys that is cheaper to count than ``df``, such as
    the rows before they were deduplicated.
    """
    keys = list(keys)
    measure = n > PLAIN_TOP or hot_rows is not None
    hot = hot_keys(df if count_in is None else count_in, keys, hot_rows) if measure else None
    number = "_rn"
    out = df
    if hot is not None:
        rest = [c for c in df.columns if c not in keys] or keys
        pieces = flag_hot(df, keys, hot, pieces=True).withColumn(
            _SALT, F.when(F.col(_HOT), F.pmod(F.xxhash64(*rest), F.col(PIECES)))
        ).drop(_HOT, PIECES)
        by_piece = Window.partitionBy(*keys, _SALT).orderBy(*order)
        # Rows of ordinary keys have no piece and are settled by the second step alone.
        cold = pieces.filter(F.col(_SALT).isNull())
        firsts = (
            pieces.filter(F.col(_SALT).isNotNull())
            .withColumn(number, F.row_number().over(by_piece))
            .filter(F.col(number) <= n).drop(number)
        )
        out = cold.unionByName(firsts).drop(_SALT)
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return out.withColumn(number, last).filter(F.col(number) <= n).drop(number)
