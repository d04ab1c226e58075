"""Track lines, cells and requests made from the given tables, in Spark and in SQL.

Every row of the events table gives one line and one cell version, every customer one request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Read clock of the delay reports: after the last event.
NOW_MS = 1706745600000
#: A moment in the middle of the events.
MID_MS = 1705363200000

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
_MS = "unix_millis(CAST(ts AS TIMESTAMP))"
_LINE = """concat(CAST(1000000+user_id AS STRING),'@',CAST({ms} AS STRING),',',
    CASE WHEN user_id % 7 = 0 THEN '-' ELSE '' END,'116.',lpad(CAST((event_id*7919) % 1000000 AS STRING),6,'0'),',',
    CASE WHEN user_id % 5 = 0 THEN '-' ELSE '' END,'40.',lpad(CAST((event_id*104729) % 1000000 AS STRING),6,'0'),',',
    CAST((event_id*31) % 360 - 180 AS STRING),{velocity})"""
_VELOCITY = "',',CAST(15 + event_id % 10 AS STRING)"
_SOME_VELOCITY = f"CASE WHEN event_id % 97 = 0 THEN '' ELSE concat({_VELOCITY}) END"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1000) -> DataFrame:
    """The events table as a file stream, whether it is a folder of files or one file.

    A stream watches a folder.  The files of a folder lie in it; a table that is one file is picked out of the folder above.
    """
    path = f"{sf_dir}/events.parquet"
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
    files = spark.read.schema(EVENTS_SCHEMA).parquet(path).inputFiles()
    if files and all(f.rstrip("/").endswith("/events.parquet") for f in files):
        return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return reader.parquet(path)


def lines_of(events: DataFrame, flawed: bool = False) -> DataFrame:
    """One line per event; ``flawed``: some lack the velocity field."""
    line = _LINE.format(ms=_MS, velocity=_SOME_VELOCITY if flawed else _VELOCITY)
    return events.selectExpr("event_id", f"{line} AS line", f"{_MS} + 50 + event_id % 900 AS arrival_ms")


def lines(spark: SparkSession, sf_dir: str, flawed: bool = False) -> DataFrame:
    return lines_of(events(spark, sf_dir), flawed)


def replayed(lines: DataFrame) -> DataFrame:
    """All lines, and all of them again a second later."""
    return lines.unionByName(lines.withColumn("arrival_ms", F.col("arrival_ms") + 1000))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(
        "CAST(1000000+user_id AS STRING) AS row_key",
        "CASE WHEN event_type IN ('click','view') THEN 'move' ELSE 'position' END AS family",
        "event_type AS qualifier", f"{_MS} AS ts", "CAST(15 + event_id % 10 AS STRING) AS value",
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, row_key, family, qualifier); most customers have no cells."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").cast("bigint").alias("pos"))
    return customers.selectExpr(
        "pos", "CAST(1000000+pos AS STRING) AS row_key",
        "CASE WHEN pos % 5 IN (0, 4) THEN 'move' ELSE 'position' END AS family",
        "element_at(array('click','error','purchase','signup','view'), CAST(pos % 5 AS INT) + 1) AS qualifier",
    )


# The same inputs in SQL.
MS = "(epoch_us(ts)//1000)"


def _sql(text: str) -> str:
    return text.replace("STRING", "VARCHAR")


def _lines_sql(name: str, velocity: str) -> str:
    line = _sql(_LINE.format(ms=MS, velocity=velocity))
    return f"{name} AS (SELECT event_id, {line} AS line, {MS} + 50 + event_id % 900 AS arrival_ms FROM events)"


LINES = _lines_sql("lines", _sql(_VELOCITY))
FLAWED = _lines_sql("lines", _sql(_SOME_VELOCITY))
REPLAYED = LINES.replace("lines AS", "once AS") + (
    ", lines AS (SELECT * FROM once UNION ALL SELECT event_id, line, arrival_ms + 1000 FROM once)"
)
TRACK = """track AS (SELECT event_id, line, arrival_ms, split_part(line, ',', 1) AS row_key,
    split_part(split_part(line, ',', 1), '@', 1) AS vehicle_id,
    CAST(split_part(split_part(line, ',', 1), '@', 2) AS BIGINT) AS event_ms,
    split_part(line, ',', 2) AS longitude, split_part(line, ',', 3) AS latitude,
    split_part(line, ',', 4) AS angle, split_part(line, ',', 5) AS velocity
  FROM lines WHERE len(string_split(line, ',')) = 5)"""
RECENT = """recent AS (SELECT vehicle_id, CAST(event_ms AS DOUBLE) AS score,
    line || '@' || CAST(min(arrival_ms) AS VARCHAR) AS member, line, min(arrival_ms) AS arrival_ms
  FROM track GROUP BY vehicle_id, event_ms, line)"""
HISTORY = """history AS (SELECT row_key, vehicle_id, event_ms, longitude, latitude, angle, velocity, arrival_ms
  FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY arrival_ms DESC, line DESC) AS rn FROM track)
  WHERE rn = 1)"""
CELLS = f"""cells AS (SELECT CAST(1000000+user_id AS VARCHAR) AS row_key,
    CASE WHEN event_type IN ('click','view') THEN 'move' ELSE 'position' END AS family,
    event_type AS qualifier, {MS} AS ts, CAST(15 + event_id % 10 AS VARCHAR) AS value FROM events)"""
NEWEST = """newest AS (SELECT row_key, family, qualifier, max(ts) AS ts, arg_max(value, ts) AS value
  FROM cells GROUP BY row_key, family, qualifier)"""
REQUESTS = """requests AS (SELECT CAST(c_custkey AS BIGINT) AS pos, CAST(1000000+c_custkey AS VARCHAR) AS row_key,
    CASE WHEN c_custkey % 5 IN (0, 4) THEN 'move' ELSE 'position' END AS family,
    (['click','error','purchase','signup','view'])[CAST(c_custkey % 5 AS INT) + 1] AS qualifier FROM customer)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
