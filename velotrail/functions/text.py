"""Expressions on the text of track lines, row keys and stamps.

Everything here is a plain Spark expression, so it stays inside generated code.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separators and name formats found in the stored data.
KEY_SEPARATOR = "@"
FIELD_SEPARATOR = ","
SET_NAME_PREFIX = "info_"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Layout of the status text, one piece per line of output.
REPORT_READ_LINE = "current time is %s, trackinfo pushed into redis time is %s\n"
REPORT_BODY = (
    "bicycle %s's track status at time %s is : \n"
    "                 longtitude : %s %s\n"
    "                 latitude   : %s %s\n"
    "                 angle      : %s\n"
    "                 velocity   : %s\n"
)

# Seed, factor and word size of the 32-bit key hash.
HASH_SEED = 5381
HASH_FACTOR = 33
HASH_MASK = 4294967295


def split_key(key: Column) -> tuple[Column, Column]:
    """``id@time`` -> (id, time) as text; the time is null when there is none."""
    parts = F.split(key, KEY_SEPARATOR, -1)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def row_key(vehicle_id: Column, event_ms: Column) -> Column:
    return F.concat_ws(KEY_SEPARATOR, vehicle_id.cast("string"), event_ms.cast("string"))


def set_name(vehicle_id: Column) -> Column:
    return F.concat(F.lit(SET_NAME_PREFIX), vehicle_id.cast("string"))


def stamp_text(millis: Column, unit: str = "ms") -> Column:
    """Arrival stamp as text: all digits, or the first ten (whole seconds)."""
    text = millis.cast("string")
    return text if _unit(unit) == "ms" else F.substring(text, 1, 10)


def stamped(text: Column, millis: Column, unit: str = "ms") -> Column:
    return F.concat(text, F.lit(KEY_SEPARATOR), stamp_text(millis, unit))


def unstamped(text: Column) -> tuple[Column, Column]:
    """``value@arrival`` -> (value, arrival as LONG or null)."""
    parts = F.split(text, KEY_SEPARATOR, -1)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1)).try_cast("bigint")


def hemisphere(longitude: Column, latitude: Column, numeric: bool = False) -> tuple[Column, Column]:
    """(E|W, N|S).  By default a minus sign anywhere in the text decides."""
    def negative(c: Column) -> Column:
        return (c.try_cast("double") < 0) if numeric else F.contains(c, F.lit("-"))

    return (
        F.when(negative(longitude), "W").otherwise("E"),
        F.when(negative(latitude), "S").otherwise("N"),
    )


def moment(epoch: Column, unit: str = "ms") -> Column:
    epoch = epoch.cast("bigint")
    return F.timestamp_millis(epoch) if _unit(unit) == "ms" else F.timestamp_seconds(epoch)


def format_time(epoch: Column, unit: str = "ms") -> Column:
    """Epoch number -> text in the session time zone."""
    return F.date_format(moment(epoch, unit), TIME_FORMAT)


def report_text(
    vehicle_id: Column,
    event_time: Column,
    longitude: Column,
    latitude: Column,
    angle: Column,
    velocity: Column,
    unit: str = "ms",
) -> Column:
    east, north = hemisphere(longitude, latitude)
    return F.format_string(
        REPORT_BODY, vehicle_id, format_time(event_time, unit), longitude, east,
        latitude, north, angle, velocity,
    )


def report_read_line(now_ms: int, arrival: Column, unit: str = "ms") -> Column:
    """First line of the report: read clock (with microseconds if not whole) and arrival."""
    pattern = TIME_FORMAT if now_ms % 1000 == 0 else TIME_FORMAT + ".SSSSSS"
    now_text = F.date_format(F.timestamp_millis(F.lit(now_ms).cast("bigint")), pattern)
    return F.format_string(REPORT_READ_LINE, now_text, format_time(arrival, unit))


def general_numbers(df: DataFrame, columns: Mapping[str, str], sig_digits: int = 6) -> DataFrame:
    """Number columns (new name -> source) as the shortest text with ``sig_digits`` digits.

    The JVM rounds the printed decimal half up, C rounds the exact binary value; they differ
    only where the printed decimal ends in a 5 right behind the kept digits, so those values
    are moved down first where that is what the exact value says.  The steps are columns of
    their own, which keeps the generated code small.
    """
    def step(make) -> dict[str, Column]:
        return {k: v for name in columns for k, v in make(name).items()}

    def col(kind: str, name: str) -> Column:
        return F.col(f"_{kind}_{name}")

    def digits(name: str) -> dict[str, Column]:
        value = F.col(columns[name]).cast("double")
        shown = F.abs(value).cast("string")
        return {
            f"_v_{name}": value,
            f"_d_{name}": F.regexp_replace(F.regexp_replace(shown, r"E.*|\.", ""), r"^0+|0+$", ""),
        }

    def scale(name: str) -> dict[str, Column]:
        # |value| = whole / 10^places up to the rounding error of the double.
        whole = col("d", name).try_cast("double")
        tie = (F.length(col("d", name)) == sig_digits + 1) & F.endswith(col("d", name), F.lit("5"))
        return {f"_w_{name}": F.when(tie, whole), f"_p_{name}": F.when(tie, F.round(F.log10(whole / F.abs(col("v", name)))))}

    def below(name: str) -> dict[str, Column]:
        size, power, places = F.abs(col("v", name)), F.pow(F.lit(10.0), col("p", name)), col("p", name)
        error = _exact_product_error(size, power) + (size * power - col("w", name))
        even = F.substring(col("d", name), sig_digits, 1).isin("0", "2", "4", "6", "8")
        exact = places.between(0, 22)
        down = (exact & ((error < 0) | ((error == 0) & even))) | (~exact & even)
        return {f"_b_{name}": F.when(col("w", name).isNotNull() & down, col("v", name) * F.lit(1.0 - 1e-9)).otherwise(col("v", name))}

    def show(name: str) -> dict[str, Column]:
        plain = F.format_string(f"%.{sig_digits}g", col("b", name))
        no_zeros = F.regexp_replace(plain, r"(\.\d*?)0+($|e)", "$1$2")
        zero = F.when(F.startswith(col("v", name).cast("string"), F.lit("-")), "-0").otherwise("0")
        return {name: F.when(col("v", name) == 0, zero).otherwise(F.regexp_replace(no_zeros, r"\.($|e)", "$1"))}

    for make in (digits, scale, below, show):
        df = df.withColumns(step(make))
    return df.drop(*[f"_{kind}_{name}" for kind in "vdwpb" for name in columns])


def _exact_product_error(a: Column, b: Column) -> Column:
    """What rounding took from ``a * b``: both factors are split into halves of 26 bits."""
    split = F.lit(134217729.0)
    a_high, b_high = split * a - (split * a - a), split * b - (split * b - b)
    a_low, b_low = a - a_high, b - b_high
    return ((a_high * b_high - a * b) + a_high * b_low + a_low * b_high) + a_low * b_low


def key_hash(key: Column) -> Column:
    """32-bit multiplicative hash of an ASCII key (``h * 33 + byte``, seed 5381)."""
    seed = F.lit(HASH_SEED).cast("bigint")
    hashed = F.aggregate(
        F.split(key, "", -1),
        seed,
        lambda h, ch: (h * HASH_FACTOR + F.ascii(ch)).bitwiseAND(F.lit(HASH_MASK).cast("bigint")),
    )
    return F.when(key == "", seed).otherwise(hashed)


def key_bucket(key: Column, n: int) -> Column:
    return (key_hash(key) % F.lit(n).cast("bigint")).cast("int")


def whole_parts(value: Column, n: int) -> Column:
    """``value / n`` rounded down, in whole numbers all the way."""
    divisor = F.lit(n).cast("bigint")
    return F.call_function("div", value - F.pmod(value, divisor), divisor)


def _unit(unit: str) -> str:
    if unit not in ("ms", "s"):
        raise ValueError(f"unit must be 'ms' or 's', not {unit!r}")
    return unit
