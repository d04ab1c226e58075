"""Reads of the cells of all events, asked for by all customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from velotrail.operators import cells as ops
from velotrail.queries.inputs import CELLS, MID_MS, NEWEST, REQUESTS, cells, requests, with_
from velotrail.queries.registry import query

_COLS = "row_key, family, qualifier, ts, value"
_VERSIONS = """versions AS (SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC) AS rn
  FROM cells)"""
_ASKED = "(row_key, family, qualifier) IN (SELECT (row_key, family, qualifier) FROM requests)"
_BEFORE = CELLS.replace("cells AS", "stored AS") + f", cells AS (SELECT * FROM stored WHERE ts <= {MID_MS})"


@query("cell_get", with_(CELLS, NEWEST, REQUESTS) + f"SELECT {_COLS} FROM newest WHERE {_ASKED}")
def cell_get(spark, sf):
    return ops.cell_get(cells(spark, sf), requests(spark, sf))


@query("cell_versions", with_(CELLS, _VERSIONS, REQUESTS) + f"SELECT {_COLS} FROM versions WHERE rn <= 3 AND {_ASKED}")
def cell_versions(spark, sf):
    return ops.cell_versions(cells(spark, sf), requests(spark, sf), 3)


@query("cell_versions_as_of", with_(_BEFORE, _VERSIONS, REQUESTS) + f"""
    SELECT {_COLS} FROM versions WHERE rn <= 3 AND {_ASKED}""")
def cell_versions_as_of(spark, sf):
    return ops.cell_versions(cells(spark, sf), requests(spark, sf), 3, ts=MID_MS)


@query("row_get", with_(CELLS, NEWEST) + f"SELECT {_COLS} FROM newest")
def row_get(spark, sf):
    return ops.row_get(cells(spark, sf))


@query("row_get_columns", with_(CELLS, NEWEST) + f"""
    SELECT {_COLS} FROM newest WHERE family = 'move' OR family = 'position' AND qualifier = 'error'""")
def row_get_columns(spark, sf):
    return ops.row_get(cells(spark, sf), columns=["move", "position:error"])


@query("row_get_at", with_(_BEFORE, NEWEST) + f"SELECT {_COLS} FROM newest WHERE family = 'move'")
def row_get_at(spark, sf):
    return ops.row_get(cells(spark, sf), columns=["move"], ts=MID_MS, at="as_of")


_KEYS = "row_key IN (SELECT row_key FROM requests)"


@query("rows_get", with_(CELLS, NEWEST, REQUESTS) + f"SELECT {_COLS} FROM newest WHERE {_KEYS}")
def rows_get(spark, sf):
    return ops.rows_get(cells(spark, sf), requests(spark, sf))


@query("rows_get_columns", with_(CELLS, NEWEST, REQUESTS) + f"""
    SELECT {_COLS} FROM newest WHERE {_KEYS} AND family = 'position'""")
def rows_get_columns(spark, sf):
    return ops.rows_get(cells(spark, sf), requests(spark, sf), columns=["position"])


@query("rows_get_at", with_(CELLS) + f"""
    SELECT {_COLS} FROM cells JOIN (SELECT row_key, min(ts) AS ts FROM cells GROUP BY row_key) USING (row_key, ts)""")
def rows_get_at(spark, sf):
    """Every row at the exact time of its first cell."""
    table = cells(spark, sf)
    return ops.rows_get(table, table.groupBy("row_key").agg(F.min("ts").alias("ts")))


@query("rows_get_as_of", with_(_BEFORE, NEWEST, REQUESTS) + f"SELECT {_COLS} FROM newest WHERE {_KEYS}")
def rows_get_as_of(spark, sf):
    return ops.rows_get(cells(spark, sf), requests(spark, sf), ts=MID_MS, at="as_of")


@query("rows_get_ordered", with_(CELLS, NEWEST, REQUESTS) + f"""
    SELECT pos, {_COLS.replace('family, qualifier', 'newest.family, newest.qualifier').replace('row_key', 'requests.row_key')}
    FROM requests LEFT JOIN newest ON requests.row_key = newest.row_key""")
def rows_get_ordered(spark, sf):
    return ops.rows_get_ordered(cells(spark, sf), requests(spark, sf))


@query("rows_exist", with_(CELLS, NEWEST, REQUESTS) + f"SELECT pos, row_key, family, qualifier, {_ASKED.replace('requests', 'newest')} AS found FROM requests")
def rows_exist(spark, sf):
    return ops.rows_exist(cells(spark, sf), requests(spark, sf))


@query("time_range_get", with_(CELLS) + f"SELECT * FROM cells WHERE ts >= {MID_MS} AND ts < {MID_MS + 864000000}")
def time_range_get(spark, sf):
    return ops.time_range(cells(spark, sf), MID_MS, MID_MS + 864000000)


@query("family_time_range", with_(CELLS) + f"""
    SELECT * FROM cells WHERE family <> 'move' OR ts >= {MID_MS - 864000000} AND ts < {MID_MS}""")
def family_time_range(spark, sf):
    ranges = spark.createDataFrame([("move", MID_MS - 864000000, MID_MS)], "family string, min_ts bigint, max_ts bigint")
    return ops.family_time_range(cells(spark, sf), ranges)


@query("scan_from", with_(CELLS, NEWEST) + f"""
    SELECT {_COLS} FROM newest WHERE row_key >= '1000004'
      AND (family = 'move' OR family = 'position' AND regexp_full_match(qualifier, 's.*|.*r'))""")
def scan_from(spark, sf):
    return ops.scan(cells(spark, sf), "1000004", columns=["move", "position:s.*|.*r"])


@query("scan_prefix", with_(CELLS, NEWEST) + f"SELECT {_COLS} FROM newest WHERE starts_with(row_key, '100000')")
def scan_prefix(spark, sf):
    return ops.scan(cells(spark, sf), prefix="100000")


@query("scan_at", with_(CELLS) + f"SELECT {_COLS} FROM cells WHERE row_key >= '1' AND ts = (SELECT max(ts) FROM cells)")
def scan_at(spark, sf):
    """Every cell with the newest timestamp of the table."""
    table = cells(spark, sf)
    return ops.scan(table, "1", ts=table.agg(F.max("ts")).first()[0])


@query("scan_at_as_of", with_(_BEFORE, NEWEST) + f"SELECT {_COLS} FROM newest WHERE row_key >= '1000001' AND row_key < '1000120'")
def scan_at_as_of(spark, sf):
    return ops.scan(cells(spark, sf), "1000001", "1000120", ts=MID_MS, at="as_of")


@query("scan_spec", with_(CELLS.replace("cells AS", "stored AS") + f""", cells AS (SELECT * FROM stored
      WHERE row_key >= '1000001' AND row_key < '1000140' AND family IN ('move', 'position')
        AND ts >= {MID_MS - 864000000} AND ts < {MID_MS + 864000000} AND value > '17')""", _VERSIONS) + f"""
    SELECT {_COLS} FROM versions WHERE rn <= 2""")
def scan_spec(spark, sf):
    return ops.scan(
        cells(spark, sf), "1000139", "1000000", columns=["move", "position"],
        time_limits=(MID_MS - 864000000, MID_MS + 864000000), where=F.col("value") > "17",
        max_versions=2, reversed=True,
    )


@query("scan_limit", with_(CELLS, NEWEST) + f"""
    SELECT {_COLS} FROM newest WHERE row_key IN (SELECT DISTINCT row_key FROM newest ORDER BY row_key LIMIT 10)""")
def scan_limit(spark, sf):
    return ops.scan(cells(spark, sf), limit=10)


@query("scan_reversed", with_(CELLS, NEWEST) + f"""
    SELECT {_COLS} FROM newest WHERE row_key <= '1000100' AND row_key > '1000003'
      AND row_key IN (SELECT DISTINCT row_key FROM newest WHERE row_key <= '1000100' AND row_key > '1000003' ORDER BY row_key DESC LIMIT 20)""")
def scan_reversed(spark, sf):
    """From the larger key down."""
    return ops.scan(cells(spark, sf), "1000100", "1000003", reversed=True, limit=20)


@query("scan_family_time_range", with_(CELLS.replace("cells AS", "stored AS") + f""", cells AS (SELECT * FROM stored
      WHERE CASE family WHEN 'move' THEN ts >= {MID_MS} ELSE ts < {MID_MS} END)""", NEWEST) + f"SELECT {_COLS} FROM newest")
def scan_family_time_range(spark, sf):
    """A family's own time range instead of the general one."""
    own = spark.createDataFrame([("move", MID_MS, None)], "family string, min_ts bigint, max_ts bigint")
    return ops.scan(cells(spark, sf), time_limits=(None, MID_MS), family_limits=own)


def _limited_requests(spark, sf):
    """Requests with limits of their own by their position."""
    by = F.col("pos") % 4
    return requests(spark, sf).select("pos", "row_key").withColumns({
        "columns": F.when(by == 0, F.array(F.lit("move"), F.lit("position:error"))),
        "ts": F.lit(None).cast("bigint"),
        "min_ts": F.when(by == 1, F.lit(MID_MS)),
        "max_ts": F.when(by == 2, F.lit(MID_MS)),
        "n": F.when(by == 3, F.lit(2)),
    })


_MEETS = f"""c.row_key = r.row_key AND CASE r.pos % 4 WHEN 0 THEN c.family = 'move' OR c.qualifier = 'error'
    WHEN 1 THEN c.ts >= {MID_MS} WHEN 2 THEN c.ts < {MID_MS} ELSE true END"""


@query("rows_get_limits", with_(CELLS, REQUESTS) + f"""
    SELECT r.pos, r.row_key, f.family, f.qualifier, f.ts, f.value FROM requests r LEFT JOIN
      (SELECT r.pos, c.*, row_number() OVER (PARTITION BY r.pos, c.family, c.qualifier ORDER BY c.ts DESC) AS rn FROM requests r JOIN cells c ON {_MEETS}) f
      ON r.pos = f.pos AND rn <= CASE r.pos % 4 WHEN 3 THEN 2 ELSE 1 END""")
def rows_get_limits(spark, sf):
    return ops.rows_get_ordered(cells(spark, sf), _limited_requests(spark, sf))


@query("rows_exist_limits", with_(CELLS, REQUESTS) + f"""
    SELECT pos, row_key, EXISTS (SELECT 1 FROM cells c WHERE {_MEETS}) AS found FROM requests r""")
def rows_exist_limits(spark, sf):
    return ops.rows_exist(cells(spark, sf), _limited_requests(spark, sf)).select("pos", "row_key", "found")


@query("cell_versions_limits", with_(CELLS, REQUESTS) + f"""
    SELECT r.pos, c.* FROM requests r JOIN cells c USING (row_key, family, qualifier)
    WHERE r.pos % 4 <> 1 OR ts <= {MID_MS}
    QUALIFY row_number() OVER (PARTITION BY r.pos ORDER BY ts DESC) <= r.pos % 3 + 1""")
def cell_versions_limits(spark, sf):
    asked = requests(spark, sf).withColumns({"n": (F.col("pos") % 3 + 1).cast("int"), "ts": F.when(F.col("pos") % 4 == 1, F.lit(MID_MS))})
    return ops.cell_versions_ordered(cells(spark, sf), asked)


def _column(family, qualifier):
    return f"max(CASE WHEN family = '{family}' AND qualifier = '{qualifier}' THEN value END) AS {qualifier}"


@query("row_result_map", with_(CELLS, NEWEST) + f"""
    SELECT row_key, CAST(count(*) AS INTEGER) AS n, {_column('move', 'click')}, {_column('move', 'view')},
      {_column('position', 'error')}, {_column('position', 'purchase')}, {_column('position', 'signup')},
      max(CASE WHEN qualifier = 'click' THEN ts END) AS click_ts FROM newest GROUP BY row_key""")
def row_result_map(spark, sf):
    """The map column, shown by its size and by what it holds for each column."""
    rows = ops.as_row_map(ops.newest(cells(spark, sf)))
    names = ("move:click", "move:view", "position:error", "position:purchase", "position:signup")
    cell = {n: F.try_element_at("columns", F.lit(n)) for n in names}
    return rows.select(
        "row_key", F.size("columns").alias("n"), *[c["value"].alias(n.split(":")[1]) for n, c in cell.items()],
        cell["move:click"]["ts"].alias("click_ts"),
    )


@query("row_result_sorted", with_(CELLS, NEWEST) + """
    SELECT row_key, string_agg(family || ':' || qualifier || '=' || value || '@' || CAST(ts AS VARCHAR), ';'
      ORDER BY family || ':' || qualifier) AS columns FROM newest GROUP BY row_key""")
def row_result_sorted(spark, sf):
    """The sorted list, joined to text."""
    return _shown(ops.as_row_list(ops.newest(cells(spark, sf)))).select("row_key", "columns")


@query("row_result_parts", with_(CELLS, NEWEST) + """
    SELECT row_key, part, string_agg(name || '=' || value || '@' || CAST(ts AS VARCHAR), ';' ORDER BY name) AS columns
    FROM (SELECT *, family || ':' || qualifier AS name,
      (row_number() OVER (PARTITION BY row_key ORDER BY family, qualifier) - 1) // 2 AS part FROM newest) GROUP BY row_key, part""")
def row_result_parts(spark, sf):
    """Results of two columns each, which the caller asks for."""
    return _shown(ops.as_row_list(ops.newest(cells(spark, sf)), batch=2, count_in=cells(spark, sf)))


def _shown(rows):
    shown = F.transform("columns", lambda e: F.concat(
        e["column"], F.lit("="), e["cell"]["value"], F.lit("@"), e["cell"]["ts"].cast("string")))
    return rows.withColumn("columns", F.array_join(shown, ";"))
