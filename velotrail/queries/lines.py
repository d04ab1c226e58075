"""Parsing, expressions, distribution and motion over the lines of all events."""

from __future__ import annotations

from pyspark.sql import functions as F

from velotrail.functions import text
from velotrail.operators import distribute, latency, motion, parse
from velotrail.queries.inputs import FLAWED, LINES, NOW_MS, REPLAYED, TRACK, lines, replayed, with_
from velotrail.queries.registry import query

_FIELDS = ["longitude", "latitude", "angle", "velocity"]
_TRACK_OUT = ["vehicle_id", "event_ms", *_FIELDS, "line", "arrival_ms"]
_TRACK_SQL = "SELECT vehicle_id, event_ms, longitude, latitude, angle, velocity, line, arrival_ms FROM track"


def _track(spark, sf):
    return parse.parse_line(lines(spark, sf))


@query("parse_strict", with_(LINES, TRACK) + _TRACK_SQL)
def parse_strict(spark, sf):
    return _track(spark, sf).select(*_TRACK_OUT)


@query("parse_lenient", with_(FLAWED, TRACK) + _TRACK_SQL)
def parse_lenient(spark, sf):
    good, _ = parse.parse_line(lines(spark, sf, flawed=True), mode="lenient")
    return good.select(*_TRACK_OUT)


@query("parse_rejects", with_(FLAWED) + """
    SELECT line, 'bad_field_count' AS reason FROM lines WHERE len(string_split(line, ',')) <> 5""")
def parse_rejects(spark, sf):
    return parse.parse_line(lines(spark, sf, flawed=True), mode="lenient")[1]


@query("parse_key_only", with_(LINES, TRACK) + "SELECT row_key, longitude, latitude, angle, velocity FROM track")
def parse_key_only(spark, sf):
    return parse.parse_line(lines(spark, sf), split_key=False).select("row_key", *_FIELDS)


@query("split_row_key", with_(LINES, TRACK) + "SELECT row_key, vehicle_id, CAST(event_ms AS VARCHAR) AS event_time FROM track")
def split_row_key(spark, sf):
    rows = parse.parse_line(lines(spark, sf), split_key=False)
    vehicle, time = text.split_key(F.col("row_key"))
    return rows.select("row_key", vehicle.alias("vehicle_id"), time.alias("event_time"))


@query("compose_key", with_(LINES, TRACK) + "SELECT row_key FROM track")
def compose_key(spark, sf):
    return _track(spark, sf).select(text.row_key(F.col("vehicle_id"), F.col("event_ms")).alias("row_key"))


@query("set_name", with_(LINES, TRACK) + "SELECT event_ms, 'info_' || vehicle_id AS set_name FROM track")
def set_name(spark, sf):
    return _track(spark, sf).select("event_ms", text.set_name(F.col("vehicle_id")).alias("set_name"))


@query("time_prefix_pair", with_(LINES, TRACK) + """
    SELECT vehicle_id, CAST(event_ms AS VARCHAR) || '@' || line AS timed_line FROM track""")
def time_prefix_pair(spark, sf):
    return parse.keyed_by_time(_track(spark, sf))


@query("score_of_time", with_(LINES, TRACK) + "SELECT vehicle_id, line, CAST(event_ms AS DOUBLE) AS score FROM track")
def score_of_time(spark, sf):
    return parse.score(_track(spark, sf)).select("vehicle_id", "line", "score")


@query("stamp_arrival", with_(LINES, TRACK) + """
    SELECT line || '@' || CAST(arrival_ms AS VARCHAR) AS member,
      line || '@' || left(CAST(arrival_ms AS VARCHAR), 10) AS member_s,
      velocity || '@' || CAST(arrival_ms AS VARCHAR) AS velocity FROM track""")
def stamp_arrival(spark, sf):
    track = parse.stamp(_track(spark, sf), "line", into="member")
    track = parse.stamp(track, "line", unit="s", into="member_s")
    return parse.stamp(track, "velocity").select("member", "member_s", "velocity")


@query("unstamp_arrival", with_(LINES, TRACK) + "SELECT line, velocity, arrival_ms FROM track")
def unstamp_arrival(spark, sf):
    stamped = parse.stamp(_track(spark, sf), "velocity").drop("arrival_ms")
    return parse.unstamp(stamped).select("line", "velocity", "arrival_ms")


_CELLS_SQL = """
  SELECT row_key, 'position' AS family, 'longtitude' AS qualifier, arrival_ms AS ts, longitude AS value FROM track
  UNION ALL SELECT row_key, 'position', 'latitude', arrival_ms, latitude FROM track
  UNION ALL SELECT row_key, 'move', 'angle', arrival_ms, angle FROM track
  UNION ALL SELECT row_key, 'move', 'velocity', arrival_ms, velocity || '@' || CAST(arrival_ms AS VARCHAR) FROM track"""


@query("to_cells", with_(LINES, TRACK) + _CELLS_SQL)
def to_cells(spark, sf):
    return parse.to_cells(parse.parse_line(lines(spark, sf), split_key=False))


@query("from_cells", with_(REPLAYED, TRACK) + """
    SELECT row_key, vehicle_id, event_ms, any_value(longitude) AS longitude, any_value(latitude) AS latitude,
      any_value(angle) AS angle, any_value(velocity) || '@' || CAST(max(arrival_ms) AS VARCHAR) AS velocity
    FROM track GROUP BY row_key, vehicle_id, event_ms""")
def from_cells(spark, sf):
    cells = parse.to_cells(parse.parse_line(replayed(lines(spark, sf)), split_key=False))
    return parse.from_cells(cells)


@query("hemisphere", with_(LINES, TRACK) + """
    SELECT longitude, latitude, CASE WHEN position('-' IN longitude) > 0 THEN 'W' ELSE 'E' END AS east_west,
      CASE WHEN position('-' IN latitude) > 0 THEN 'S' ELSE 'N' END AS north_south FROM track""")
def hemisphere(spark, sf):
    east, north = text.hemisphere(F.col("longitude"), F.col("latitude"))
    return _track(spark, sf).select("longitude", "latitude", east.alias("east_west"), north.alias("north_south"))


_TIME = "strftime(make_timestamp({} * 1000), '%Y-%m-%d %H:%M:%S')"


@query("format_time", with_(LINES, TRACK) + f"""
    SELECT line, {_TIME.format('event_ms')} AS event_time, {_TIME.format('(event_ms // 1000) * 1000')} AS event_time_s
    FROM track""")
def format_time(spark, sf):
    seconds = F.floor(F.col("event_ms") / 1000)
    return _track(spark, sf).select(
        "line", text.format_time(F.col("event_ms")).alias("event_time"),
        text.format_time(seconds, "s").alias("event_time_s"),
    )


_PAD = " " * 17
_BODY = f"""'bicycle ' || vehicle_id || '''s track status at time ' || {_TIME.format('event_ms')} || ' is : ' || chr(10)
    || '{_PAD}longtitude : ' || longitude || CASE WHEN longitude LIKE '%-%' THEN ' W' ELSE ' E' END || chr(10)
    || '{_PAD}latitude   : ' || latitude || CASE WHEN latitude LIKE '%-%' THEN ' S' ELSE ' N' END || chr(10)
    || '{_PAD}angle      : ' || angle || chr(10) || '{_PAD}velocity   : ' || {{v}} || chr(10)"""


@query("track_report", with_(LINES, TRACK) + f"""
    SELECT line, 'current time is 2024-02-01 00:00:00, trackinfo pushed into redis time is '
        || {_TIME.format('arrival_ms')} || chr(10) || {_BODY.format(v='velocity')} AS report_with_arrival,
      {_BODY.format(v="velocity || '@' || CAST(arrival_ms AS VARCHAR)")} AS report_raw,
      {_BODY.format(v='velocity')} AS report FROM track""")
def track_report(spark, sf):
    stamped = parse.stamp(_track(spark, sf), "velocity")
    full = parse.track_report(stamped, with_arrival=True, now_ms=NOW_MS).withColumnRenamed("report", "report_with_arrival")
    raw = parse.track_report(full, raw=True).withColumnRenamed("report", "report_raw")
    return parse.track_report(raw).select("line", "report_with_arrival", "report_raw", "report")


@query("delay_parts", with_(LINES, TRACK) + f"""
    SELECT vehicle_id, line, arrival_ms - event_ms AS send_to_write, {NOW_MS} - arrival_ms AS write_to_read,
      {NOW_MS} - event_ms AS send_to_read FROM track""")
def delay_parts(spark, sf):
    return latency.delays(_track(spark, sf), NOW_MS).select("vehicle_id", "line", *latency.DELAYS)


def _numbers(spark, sf):
    return parse.with_numbers(_track(spark, sf))


@query("encode_track", with_(LINES, TRACK) + """
    SELECT line AS source_line, row_key || ',' || printf('%g', CAST(longitude AS DOUBLE)) || ',' ||
      printf('%g', CAST(latitude AS DOUBLE)) || ',' || printf('%g', CAST(angle AS DOUBLE)) || ',' ||
      printf('%g', CAST(velocity AS DOUBLE)) AS line FROM track""")
def encode_track(spark, sf):
    records = _numbers(spark, sf).withColumnRenamed("line", "source_line")
    return parse.encode_track(records).select("source_line", "line")


_HASH_SQL = """SELECT row_key, list_reduce(list_prepend(CAST(5381 AS BIGINT),
    list_transform(string_split(row_key, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda h, c: (h * 33 + c) % 4294967296) AS key_hash FROM track"""


@query("key_hash", with_(LINES, TRACK, f"hashed AS ({_HASH_SQL})") + """
    SELECT row_key, key_hash, CAST(key_hash % 16 AS INTEGER) AS bucket FROM hashed""")
def key_hash(spark, sf):
    rows = parse.parse_line(lines(spark, sf), split_key=False)
    key = F.col("row_key")
    return rows.select("row_key", text.key_hash(key).alias("key_hash"), text.key_bucket(key, 16).alias("bucket"))


# CAST so that no constant is read as a decimal.
_STEP = """(CAST(velocity AS DOUBLE) / CAST(3.6 AS DOUBLE) * 10 * CAST(8.9832e-6 AS DOUBLE)
    * {f}(CAST(angle AS DOUBLE) * CAST(3.1415926 AS DOUBLE) / 180))"""


@query("motion_step", with_(LINES, TRACK) + f"""
    SELECT line, CAST(round((CAST(longitude AS DOUBLE) + {_STEP.format(f='cos')}) * 1e9) AS BIGINT) AS next_lon_e9,
      CAST(round((CAST(latitude AS DOUBLE) + {_STEP.format(f='sin')}) * 1e9) AS BIGINT) AS next_lat_e9 FROM track""")
def motion_step(spark, sf):
    return motion.dead_reckon(_numbers(spark, sf)).select("line", _nano("next_lon"), _nano("next_lat"))


def _nano(name):
    """Degrees as whole billionths: floats are compared by value, not by their last bit."""
    return F.round(F.col(name) * F.lit(1e9)).cast("bigint").alias(f"{name}_e9")


@query("integrate_track", with_(LINES, TRACK) + f"""
    SELECT line, CAST(round((116 + coalesce(sum({_STEP.format(f='cos')}) OVER w, 0)) * 1e9) AS BIGINT) AS path_lon_e9,
      CAST(round((40 + coalesce(sum({_STEP.format(f='sin')}) OVER w, 0)) * 1e9) AS BIGINT) AS path_lat_e9
    FROM track WINDOW w AS (PARTITION BY vehicle_id ORDER BY event_ms, line
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def integrate_track(spark, sf):
    return motion.integrate_track(_numbers(spark, sf)).select("line", _nano("path_lon"), _nano("path_lat"))


@query("src_union", with_(REPLAYED) + "SELECT line, arrival_ms FROM lines")
def src_union(spark, sf):
    first = lines(spark, sf).select("line", "arrival_ms")
    return distribute.union_sources(first, first.withColumn("arrival_ms", F.col("arrival_ms") + 1000))


@query("round_robin", with_(LINES, TRACK) + """
    SELECT line, CAST((row_number() OVER (ORDER BY arrival_ms, line) - 1) % 8 AS INTEGER) AS queue FROM track""")
def round_robin(spark, sf):
    track = _track(spark, sf).select("arrival_ms", "line")
    return distribute.deal_in_order(track, 8, [F.col("arrival_ms"), F.col("line")]).select("line", "queue")


@query("hash_partition", with_(LINES, TRACK.replace("track AS", "parsed AS"),
       "track AS (SELECT DISTINCT vehicle_id AS row_key FROM parsed)", f"hashed AS ({_HASH_SQL})") + """
    SELECT vehicle_id, line, CAST(key_hash % 16 AS INTEGER) AS partition_no, CAST(key_hash % 16 AS INTEGER) AS placed_in
    FROM parsed JOIN hashed ON vehicle_id = hashed.row_key""")
def hash_partition(spark, sf):
    placed = distribute.partition_by_hash(_track(spark, sf), 16)
    return placed.select("vehicle_id", "line", "partition_no", F.spark_partition_id().alias("placed_in"))


@query("repartition", with_(LINES) + "SELECT line, arrival_ms FROM lines")
def repartition(spark, sf):
    return distribute.with_parallelism(lines(spark, sf), 16).select("line", "arrival_ms")


@query("deal", with_(LINES) + "SELECT line, arrival_ms FROM lines")
def deal(spark, sf):
    return distribute.deal(lines(spark, sf), 8).select("line", "arrival_ms")


@query("batch_latency", with_(LINES, TRACK) + f"""
    SELECT count(*) AS n, CAST(sum({NOW_MS} - event_ms) AS DOUBLE) AS total_ms,
      CAST(sum({NOW_MS} - event_ms) AS DOUBLE) / count(*) AS avg_ms FROM track""")
def batch_latency(spark, sf):
    return latency.batch_latency(_track(spark, sf), NOW_MS)


@query("delay_report", with_(LINES, TRACK, """samples AS (SELECT *,
      (row_number() OVER (PARTITION BY vehicle_id ORDER BY arrival_ms, line) - 1) // 20 AS group_no FROM track)""") + f"""
    SELECT vehicle_id, group_no, count(*) AS n,
      CAST(floor(sum(arrival_ms - event_ms) / 20.0) AS BIGINT) AS avg_send_to_write,
      CAST(floor(sum({NOW_MS} - arrival_ms) / 20.0) AS BIGINT) AS avg_write_to_read,
      CAST(floor(sum({NOW_MS} - event_ms) / 20.0) AS BIGINT) AS avg_send_to_read,
      CAST(sum(arrival_ms - event_ms) AS DOUBLE) / 20 AS mean_send_to_write,
      CAST(sum({NOW_MS} - arrival_ms) AS DOUBLE) / 20 AS mean_write_to_read,
      CAST(sum({NOW_MS} - event_ms) AS DOUBLE) / 20 AS mean_send_to_read
    FROM samples GROUP BY vehicle_id, group_no HAVING count(*) = 20""")
def delay_report(spark, sf):
    return latency.delay_report(_track(spark, sf), NOW_MS, every=20)


@query("progress_marks", with_(LINES, TRACK, """counted AS (SELECT arrival_ms,
      row_number() OVER (ORDER BY arrival_ms, line) AS running_count FROM track)""") + """
    SELECT running_count, arrival_ms FROM counted WHERE running_count % 1000 = 0""")
def progress_marks(spark, sf):
    return latency.progress_marks(_track(spark, sf), every=1000)


@query("progress_marks_by_vehicle", with_(LINES, TRACK, """counted AS (SELECT vehicle_id, arrival_ms,
      row_number() OVER (PARTITION BY vehicle_id ORDER BY arrival_ms, line) AS running_count FROM track)""") + """
    SELECT vehicle_id, running_count, arrival_ms FROM counted WHERE running_count % 10 = 0""")
def progress_marks_by_vehicle(spark, sf):
    return latency.progress_marks(_track(spark, sf), every=10, by="vehicle_id")


@query("throughput", with_(LINES, TRACK) + """
    SELECT count(*) AS n, min(arrival_ms) AS first_ms, max(arrival_ms) AS last_ms,
      count(*) / ((max(arrival_ms) - min(arrival_ms)) / 1000.0::DOUBLE) AS records_per_s FROM track""")
def throughput(spark, sf):
    return latency.throughput(_track(spark, sf))
