"""History, recent sets and their reads over the lines of all events."""

from __future__ import annotations

from pyspark.sql import functions as F

from velotrail.operators import cells as cell_ops
from velotrail.operators import history as hist
from velotrail.operators import latency, parse
from velotrail.operators import recent as rec
from velotrail.queries.inputs import (
    HISTORY, LINES, NOW_MS, RECENT, REPLAYED, REQUESTS, TRACK, lines, replayed, requests, with_,
)
from velotrail.queries.registry import query

_H = with_(REPLAYED, TRACK, HISTORY)
_R = with_(REPLAYED, TRACK, RECENT)
_RECENT_OUT = "vehicle_id, score, member, line, arrival_ms"


def history(spark, sf):
    return hist.newest_rows(hist.history_rows(replayed(lines(spark, sf))))


def recent(spark, sf, dedup="line"):
    return rec.recent_set(_tracks(spark, sf), dedup)


def _tracks(spark, sf):
    """The lines before they are made a set: cheap to count."""
    return parse.parse_line(replayed(lines(spark, sf)))


def _vehicles(spark, sf):
    return requests(spark, sf).select("pos", F.col("row_key").alias("vehicle_id"))


_VEHICLES = "vehicles AS (SELECT pos, row_key AS vehicle_id FROM requests)"


@query("track_history", _H + "SELECT * FROM history")
def track_history(spark, sf):
    return hist.track_history(history(spark, sf))


@query("track_history_many", with_(REPLAYED, TRACK, HISTORY, REQUESTS, _VEHICLES) + """
    SELECT pos, history.* FROM history JOIN vehicles USING (vehicle_id)""")
def track_history_many(spark, sf):
    found = hist.track_history(history(spark, sf), _vehicles(spark, sf))
    return found.select("pos", *hist.HISTORY)


_RANGE = ("1000003@000000", "1000100@000000")


@query("track_history_bytes", with_(REPLAYED, TRACK, HISTORY, REQUESTS, _VEHICLES) + """
    SELECT pos, history.* FROM history JOIN vehicles ON row_key >= vehicles.vehicle_id || '@000000'
      AND row_key < CAST(CAST(vehicles.vehicle_id AS BIGINT) + 1 AS VARCHAR) || '@000000'""")
def track_history_bytes(spark, sf):
    """The byte range of every customer's vehicle."""
    found = hist.track_history(history(spark, sf), _vehicles(spark, sf), mode="bytes")
    return found.select("pos", *hist.HISTORY)


@query("key_range_scan", with_(LINES, TRACK) + """,
    cells AS (SELECT row_key, 'position' AS family, 'longtitude' AS qualifier, arrival_ms AS ts, longitude AS value FROM track
      UNION ALL SELECT row_key, 'position', 'latitude', arrival_ms, latitude FROM track
      UNION ALL SELECT row_key, 'move', 'angle', arrival_ms, angle FROM track)
    SELECT * FROM cells WHERE row_key >= '{}' AND row_key < '{}'""".format(*_RANGE))
def key_range_scan(spark, sf):
    cells = parse.to_cells(parse.parse_line(lines(spark, sf), split_key=False))
    return cell_ops.scan_range(cells, *_RANGE, columns=["position", "move:angle"])


@query("scan_pages", with_(REPLAYED, TRACK, HISTORY) + """
    SELECT row_key, (row_number() OVER (ORDER BY row_key) - 1) // 50 AS page_no FROM history""")
def scan_pages(spark, sf):
    return hist.page_numbers(history(spark, sf).select("row_key"), 50)


@query("scan_next_page", _H + """
    SELECT * FROM history WHERE row_key > '1000003@1' ORDER BY row_key LIMIT 50""")
def scan_next_page(spark, sf):
    return hist.page(history(spark, sf), 50, after="1000003@1")


@query("recent_track", _R + f"SELECT {_RECENT_OUT} FROM recent")
def recent_track(spark, sf):
    return rec.recent_track(recent(spark, sf))


@query("recent_track_many", with_(REPLAYED, TRACK, RECENT, REQUESTS, _VEHICLES) + """
    SELECT pos, recent.* FROM recent JOIN vehicles USING (vehicle_id)""")
def recent_track_many(spark, sf):
    return rec.recent_track(recent(spark, sf), _vehicles(spark, sf)).select("pos", *rec.RECENT)


@query("recent_members", with_(REPLAYED, TRACK) + """
    SELECT DISTINCT vehicle_id, CAST(event_ms AS DOUBLE) AS score, line || '@' || CAST(arrival_ms AS VARCHAR) AS member,
      line, arrival_ms FROM track""")
def recent_members(spark, sf):
    return recent(spark, sf, dedup="member")


def _ranked(where: str) -> str:
    return with_(REPLAYED, TRACK, RECENT, """ranked AS (SELECT *,
        row_number() OVER (PARTITION BY vehicle_id ORDER BY score, member) - 1 AS rank,
        row_number() OVER (PARTITION BY vehicle_id ORDER BY score DESC, member DESC) - 1 AS back,
        count(*) OVER (PARTITION BY vehicle_id) AS size FROM recent)""") + f"""
        SELECT {_RECENT_OUT}, rank FROM ranked WHERE {where}"""


@query("rank_range", _ranked("rank >= 3 AND rank <= size - 4"))
def rank_range(spark, sf):
    return rec.rank_range(recent(spark, sf), 3, -4, count_in=_tracks(spark, sf))


@query("rank_range_all", _ranked("true"))
def rank_range_all(spark, sf):
    return rec.rank_range(recent(spark, sf), 0, -1, count_in=_tracks(spark, sf))


@query("latest_position", _R + f""", newest AS (SELECT *,
      row_number() OVER (PARTITION BY vehicle_id ORDER BY score DESC, member DESC) AS rn FROM recent)
    SELECT newest.vehicle_id, newest.score, track.event_ms, track.longitude, track.latitude, track.angle, track.velocity,
      newest.arrival_ms - track.event_ms AS send_to_write, {NOW_MS} - newest.arrival_ms AS write_to_read,
      {NOW_MS} - track.event_ms AS send_to_read
    FROM newest JOIN track ON newest.line = track.line AND newest.arrival_ms = track.arrival_ms WHERE rn = 1
    """)
def latest_position(spark, sf):
    """Newest point per vehicle, read back from its line, with the three delays."""
    latest = rec.latest_position(recent(spark, sf)).drop("member")
    track = latency.delays(parse.parse_line(latest.drop("vehicle_id")), NOW_MS)
    return track.select("vehicle_id", "score", "event_ms", *parse.FIELDS, *latency.DELAYS)


@query("last_of_first_n", _H + """, firsts AS (SELECT *,
      row_number() OVER (PARTITION BY vehicle_id ORDER BY row_key) AS rn FROM history)
    SELECT row_key, vehicle_id, event_ms, longitude, latitude, angle, velocity, arrival_ms FROM firsts
    WHERE rn <= 20 QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY rn DESC) = 1""")
def last_of_first_n(spark, sf):
    return hist.last_of_first_n(history(spark, sf), 20).select(*hist.HISTORY)


@query("set_size", _R + "SELECT vehicle_id, count(*) AS n FROM recent GROUP BY vehicle_id")
def set_size(spark, sf):
    return rec.set_size(recent(spark, sf))


@query("set_keys", _R + "SELECT DISTINCT 'info_' || vehicle_id AS set_name FROM recent")
def set_keys(spark, sf):
    return rec.set_keys(recent(spark, sf))


def _newest_n(where: str) -> str:
    return _R + f""", counted AS (SELECT *,
        row_number() OVER (PARTITION BY vehicle_id ORDER BY score DESC, member DESC) AS rn FROM recent)
        SELECT {_RECENT_OUT} FROM counted WHERE {where}"""


@query("keep_last_n", _newest_n("rn <= 5"))
def keep_last_n(spark, sf):
    return rec.keep_last_n(recent(spark, sf), 5)


@query("trimmed_rows", _newest_n("rn > 5"))
def trimmed_rows(spark, sf):
    return rec.trimmed_rows(recent(spark, sf), 5, count_in=_tracks(spark, sf))


@query("key_slices", _R + """, keys AS (SELECT DISTINCT 'info_' || vehicle_id AS set_name FROM recent),
    ranked AS (SELECT set_name, row_number() OVER (ORDER BY set_name) - 1 AS rank, count(*) OVER () AS total FROM keys)
    SELECT set_name, CAST(CASE WHEN total // 7 = 0 THEN 6 ELSE least(rank // (total // 7), 6) END AS INTEGER) AS slice
    FROM ranked""")
def key_slices(spark, sf):
    return rec.key_slices(rec.set_keys(recent(spark, sf)), 7)
