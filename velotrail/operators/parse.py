"""Track lines to columns and back, in strict and lenient reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotrail.functions import text

FIELDS = ("longitude", "latitude", "angle", "velocity")

# Column families and qualifiers of the stored cells (spelling as stored).
CELL_COLUMNS = {
    "longitude": ("position", "longtitude"),
    "latitude": ("position", "latitude"),
    "angle": ("move", "angle"),
    "velocity": ("move", "velocity"),
}


def _demand(df: DataFrame, good: Column, message: str, shown: str) -> DataFrame:
    """Fail the job on a bad row.  A filter, so that column pruning cannot drop the check."""
    failure = F.raise_error(F.concat(F.lit(message + ": "), F.coalesce(F.col(shown), F.lit("null"))))
    return df.filter(good | failure.cast("boolean"))


def _number(time_text: Column) -> Column:
    return F.coalesce(
        time_text.try_cast("bigint"), time_text.try_cast("double").try_cast("bigint")
    )


def parse_line(
    df: DataFrame, mode: str = "strict", split_key: bool = True, line: str = "line"
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Add the track columns to ``df``.

    strict: trailing empty fields are dropped before counting, and a bad line fails the job;
    returns one frame.  lenient: trailing empty fields count, bad lines are set aside; returns
    (good, rejects).  ``split_key=False`` keeps the first field whole as ``row_key``.
    """
    if mode not in ("strict", "lenient"):
        raise ValueError(f"mode must be 'strict' or 'lenient', not {mode!r}")
    strict = mode == "strict"
    text_line = _without_last(F.col(line), ",") if strict else F.col(line)
    fields = F.split(text_line, ",", -1)
    reason = _reason(fields, strict, split_key)
    # Nearly all lines pass one pattern; only the others are judged field by field.
    good = F.col(line).rlike(_usual(strict, split_key)) | reason.isNull()
    if strict:
        return _fields(_demand(df, good, "bad track line", line), fields, strict, split_key)
    bad = df.filter(F.coalesce(~good, F.lit(True)))
    return _fields(df.filter(good), fields, strict, split_key), bad.select(F.col(line).alias("line"), reason.alias("reason"))


def _usual(strict: bool, split_key: bool) -> str:
    # Possessive, since no part can match what follows it: nothing to go back to.
    key = "[^,@]*+@[0-9]{1,18}+" if split_key else "[^,]*+"
    return f"^{key}(?:,[^,]*+){{3}},[^,]{'++' if strict else '*+'}$"


def _without_last(value: Column, mark: str) -> Column:
    """The text without the marks at its end; most texts have none and are not touched."""
    return F.when(F.endswith(value, F.lit(mark)), F.rtrim(value, F.lit(mark))).otherwise(value)


def _key_parts(key: Column, strict: bool) -> Column:
    return F.split(_without_last(key, "@") if strict else key, "@", -1)


def _reason(fields: Column, strict: bool, split_key: bool) -> Column:
    reason = F.when(F.coalesce(F.size(fields), F.lit(0)) != 5, "bad_field_count")
    if split_key:
        parts = _key_parts(F.get(fields, F.lit(0)), strict)
        reason = reason.when(F.size(parts) != 2, "bad_key").when(_number(F.get(parts, F.lit(1))).isNull(), "bad_time")
    return reason


def _fields(df: DataFrame, fields: Column, strict: bool, split_key: bool) -> DataFrame:
    out = df.withColumn("_f", fields).withColumns(
        {"row_key": F.get("_f", F.lit(0))} | {name: F.get("_f", F.lit(i + 1)) for i, name in enumerate(FIELDS)}
    ).drop("_f")
    if not split_key:
        return out
    return (
        out.withColumn("_parts", _key_parts(F.col("row_key"), strict))
        .withColumns({"vehicle_id": F.get("_parts", F.lit(0)), "event_ms": _number(F.get("_parts", F.lit(1)))})
        .drop("_parts", "row_key")
    )


def with_numbers(track: DataFrame) -> DataFrame:
    """Numeric columns beside the kept text; text that is no number gives null."""
    names = {"lon": "longitude", "lat": "latitude", "angle_deg": "angle", "velocity_kmh": "velocity"}
    return track.withColumns({n: F.col(c).try_cast("double") for n, c in names.items()})


def time_text(line: Column) -> Column:
    """The time of a line as it is written."""
    return text.split_key(F.substring_index(line, ",", 1))[1]


def keyed_by_time(track: DataFrame) -> DataFrame:
    """(vehicle_id, ``time@line``)."""
    return track.select("vehicle_id", F.concat_ws("@", time_text(F.col("line")), "line").alias("timed_line"))


def score_of(line: Column) -> Column:
    """The time of a line as a number, with its fraction if it has one."""
    return time_text(line).try_cast("double")


def score(track: DataFrame) -> DataFrame:
    return track.withColumn("score", score_of(F.col("line")))


def stamp(track: DataFrame, target: str = "line", unit: str = "ms", into: str | None = None) -> DataFrame:
    """Append ``@arrival`` to the line (recent set) or the velocity (history)."""
    if target not in ("line", "velocity"):
        raise ValueError(f"target must be 'line' or 'velocity', not {target!r}")
    return track.withColumn(into or target, text.stamped(F.col(target), F.col("arrival_ms"), unit))


def unstamp(track: DataFrame) -> DataFrame:
    """Split a stamped velocity back into ``velocity`` and ``arrival_ms``."""
    value, arrival = text.unstamped(F.col("velocity"))
    return track.withColumns({"velocity": value, "arrival_ms": arrival})


def to_cells(track: DataFrame) -> DataFrame:
    """Four cells per record; needs row_key, the four fields and arrival_ms."""
    def cell(name: str) -> Column:
        family, qualifier = CELL_COLUMNS[name]
        value = F.col(name)
        if name == "velocity":
            value = text.stamped(value, F.col("arrival_ms"))
        return F.struct(
            F.lit(family).alias("family"), F.lit(qualifier).alias("qualifier"),
            F.col("arrival_ms").alias("ts"), value.alias("value"),
        )

    return track.select("row_key", F.inline(F.array(*[cell(n) for n in FIELDS])))


def from_cells(cells: DataFrame, strict: bool = True) -> DataFrame:
    """Cells back to one wide record per row, newest version of each column.

    strict: a record with a missing column fails the job, as reading it would.
    """
    def newest(name: str) -> Column:
        family, qualifier = CELL_COLUMNS[name]
        wanted = (F.col("family") == family) & (F.col("qualifier") == qualifier)
        return F.max(F.when(wanted, F.struct("ts", "value")))["value"].alias(name)

    wide = cells.groupBy("row_key").agg(*[newest(n) for n in FIELDS])
    if strict:
        whole = F.lit(True)
        for n in FIELDS:
            whole = whole & F.col(n).isNotNull()
        wide = _demand(wide, whole, "row without all four columns", "row_key")
    vehicle, time = text.split_key(F.col("row_key"))
    return wide.withColumns({"vehicle_id": vehicle, "event_ms": time.try_cast("bigint")})


def encode_track(records: DataFrame, sig_digits: int = 6) -> DataFrame:
    """Numeric record -> wire line; needs vehicle_id, event_ms, lon, lat, angle_deg, velocity_kmh."""
    columns = {f"_t_{c}": c for c in ("lon", "lat", "angle_deg", "velocity_kmh")}
    shown = text.general_numbers(records, columns, sig_digits)
    key = text.row_key(F.col("vehicle_id"), F.col("event_ms"))
    return shown.withColumn("line", F.concat_ws(",", key, *columns)).drop(*columns)


def track_report(
    track: DataFrame,
    with_arrival: bool = False,
    raw: bool = False,
    unit: str = "ms",
    now_ms: int | None = None,
) -> DataFrame:
    """Readable status text per point, from records whose velocity is stamped.

    ``with_arrival`` adds the line with the read clock and the arrival time; ``raw`` prints the
    stamped velocity as it is stored.
    """
    value, arrival = text.unstamped(F.col("velocity"))
    report = text.report_text(
        F.col("vehicle_id"), F.col("event_ms"), F.col("longitude"), F.col("latitude"),
        F.col("angle"), F.col("velocity") if raw else value, unit,
    )
    if with_arrival:
        if now_ms is None:
            raise ValueError("with_arrival needs now_ms")
        report = F.concat(text.report_read_line(now_ms, arrival, unit), report)
    return track.withColumn("report", report)
