"""Changes to the cells of all events; the batches come from all events or all customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from velotrail.operators import checks as chk
from velotrail.operators import mutations as mut
from velotrail.plans.scratch import scratch_path
from velotrail.queries.inputs import CELLS, MID_MS, NEWEST, NOW_MS, REQUESTS, cells, events, requests, with_
from velotrail.queries.registry import ORACLES, query
from velotrail.sources import cell_table as store

_COLS = "row_key, family, qualifier, ts, value"
_CELL = "row_key, family, qualifier"

# One change per event, aimed at the row of its vehicle or of the next two, so that some rows are new.
_TARGET = (
    "CAST(1000000 + user_id + event_id % 3 AS STRING) AS row_key",
    "CASE WHEN event_type IN ('click','view') THEN 'move' ELSE 'position' END AS family",
    "event_type AS qualifier",
)


def _changes(spark, sf, *columns):
    return events(spark, sf).selectExpr("event_id AS seq", *_TARGET, *columns)


def _changes_sql(columns: str) -> str:
    target = ", ".join(_TARGET).replace("STRING", "VARCHAR")
    return f"changes AS (SELECT event_id AS seq, {target}, {columns} FROM events)"


_PUT_TS = f"CASE WHEN event_id % 3 = 0 THEN NULL ELSE {MID_MS} + event_id % 1000 END"
_PUT_DEFAULT = f"CASE WHEN event_id % 2 = 0 THEN {MID_MS} END"
_PUT_VALUE = "CAST(30 + event_id % 7 AS STRING)"


@query("put_cells", with_(CELLS, _changes_sql(f"""coalesce({_PUT_TS}, {_PUT_DEFAULT}, {NOW_MS}) AS ts,
      {_PUT_VALUE.replace('STRING', 'VARCHAR')} AS value"""),
      f"puts AS (SELECT {_CELL}, ts, max(value) AS value FROM changes GROUP BY {_CELL}, ts)") + f"""
    SELECT {_COLS} FROM cells ANTI JOIN puts USING ({_CELL}, ts) UNION ALL SELECT {_COLS} FROM puts""")
def put_cells(spark, sf):
    return mut.put_cells(cells(spark, sf), _puts(spark, sf), NOW_MS)


def _puts(spark, sf):
    return _changes(spark, sf, f"CAST({_PUT_TS} AS BIGINT) AS ts", f"CAST({_PUT_DEFAULT} AS BIGINT) AS put_ts", f"{_PUT_VALUE} AS value")


_OP = "CASE WHEN event_id % 10 IN (7, 9) THEN 'delete' ELSE 'put' END"


@query("mutate_rows", with_(CELLS, _changes_sql(f"""{_OP} AS op, 'm' || CAST(event_id AS VARCHAR) AS value,
      event_id % 100 = 99 AS whole_family"""),
      f"""per_cell AS (SELECT {_CELL}, max(seq) AS seq, arg_max(op, seq) AS op, arg_max(value, seq) AS value,
        bool_or(op = 'delete') AS deleted FROM changes WHERE NOT whole_family GROUP BY {_CELL})""",
      "per_family AS (SELECT row_key, family, max(seq) AS family_seq FROM changes WHERE whole_family GROUP BY ALL)",
      f"""kept AS (SELECT cells.* FROM cells LEFT JOIN per_cell p USING ({_CELL}) LEFT JOIN per_family f USING (row_key, family)
        WHERE NOT (cells.ts <= {MID_MS} AND (coalesce(p.deleted, false) OR f.family_seq IS NOT NULL))
          AND NOT (cells.ts = {MID_MS} AND coalesce(p.op = 'put', false)))""") + f"""
    SELECT {_COLS} FROM kept UNION ALL
    SELECT {_CELL}, {MID_MS} AS ts, value FROM per_cell LEFT JOIN per_family USING (row_key, family)
    WHERE op = 'put' AND (family_seq IS NULL OR seq > family_seq)""")
def mutate_rows(spark, sf):
    return mut.mutate_rows(cells(spark, sf), _mutations(spark, sf), MID_MS)


def _mutations(spark, sf):
    changes = _changes(spark, sf, f"{_OP} AS op", "concat('m', CAST(event_id AS STRING)) AS value", "event_id")
    whole_family = F.col("event_id") % 100 == 99
    return changes.withColumn("qualifier", F.when(~whole_family, F.col("qualifier"))).drop("event_id")


_COUNTED = (
    CELLS, NEWEST, _changes_sql("event_id % 10 AS amount"),
    f"sums AS (SELECT {_CELL}, sum(amount) AS amount FROM changes GROUP BY {_CELL})",
    f"""counted AS (SELECT {_CELL}, CAST(coalesce(CAST(newest.value AS BIGINT), 0) + sums.amount AS BIGINT) AS value
      FROM sums LEFT JOIN newest USING ({_CELL}))""",
)


def _increments(spark, sf):
    return mut.increment_cells(cells(spark, sf), _changes(spark, sf, "event_id % 10 AS amount"), NOW_MS)


@query("increment_cells", with_(*_COUNTED) + f"""
    SELECT {_COLS} FROM cells UNION ALL SELECT {_CELL}, {NOW_MS} AS ts, CAST(value AS VARCHAR) FROM counted""")
def increment_cells(spark, sf):
    return _increments(spark, sf)[0]


@query("increment_values", with_(*_COUNTED) + f"SELECT {_CELL}, value FROM counted")
def increment_values(spark, sf):
    return _increments(spark, sf)[1]


@query("increment_late_clock", with_(*_COUNTED) + f"""
    , after AS (SELECT {_CELL}, greatest({MID_MS}, coalesce(newest.ts, {MID_MS})) AS ts, CAST(counted.value AS VARCHAR) AS value
      FROM counted LEFT JOIN newest USING ({_CELL}))
    SELECT {_COLS} FROM cells WHERE ({_CELL}, ts) NOT IN (SELECT ({_CELL}, ts) FROM after) UNION ALL SELECT {_COLS} FROM after""")
def increment_late_clock(spark, sf):
    """The clock is behind many stored times; the counted value is the newest all the same."""
    return mut.increment_cells(cells(spark, sf), _changes(spark, sf, "event_id % 10 AS amount"), MID_MS)[0]


_JOINED = (
    CELLS, NEWEST, _changes_sql("'|' || CAST(event_id AS VARCHAR) AS value"),
    f"added AS (SELECT {_CELL}, string_agg(value, '' ORDER BY seq) AS value FROM changes GROUP BY {_CELL})",
    f"""joined AS (SELECT {_CELL}, coalesce(newest.value, '') || added.value AS value
      FROM added LEFT JOIN newest USING ({_CELL}))""",
)


def _appends(spark, sf):
    values = _changes(spark, sf, "concat('|', CAST(event_id AS STRING)) AS value")
    return mut.append_cells(cells(spark, sf), values, NOW_MS)


@query("append_cells", with_(*_JOINED) + f"""
    SELECT {_COLS} FROM cells UNION ALL SELECT {_CELL}, {NOW_MS} AS ts, value FROM joined""")
def append_cells(spark, sf):
    return _appends(spark, sf)[0]


@query("append_values", with_(*_JOINED) + f"SELECT {_CELL}, value FROM joined")
def append_values(spark, sf):
    return _appends(spark, sf)[1]


_ASKED = f"({_CELL}) IN (SELECT ({_CELL}) FROM requests)"


@query("delete_column", with_(CELLS, REQUESTS) + f"SELECT {_COLS} FROM cells WHERE NOT {_ASKED}")
def delete_column(spark, sf):
    return mut.delete_column(cells(spark, sf), requests(spark, sf))


@query("delete_column_ts", with_(CELLS, REQUESTS) + f"SELECT {_COLS} FROM cells WHERE NOT ({_ASKED} AND ts <= {MID_MS})")
def delete_column_ts(spark, sf):
    return mut.delete_column(cells(spark, sf), requests(spark, sf), MID_MS)


# Rows of customers in the building segment; the others keep their cells.
_DROPPED = "dropped AS (SELECT CAST(1000000 + c_custkey AS VARCHAR) AS row_key FROM customer WHERE c_mktsegment = 'BUILDING')"


def _dropped(spark, sf):
    customers = spark.read.parquet(f"{sf}/customer.parquet").filter(F.col("c_mktsegment") == "BUILDING")
    return customers.selectExpr("CAST(1000000 + c_custkey AS STRING) AS row_key")


@query("delete_row", with_(CELLS, _DROPPED) + f"SELECT {_COLS} FROM cells ANTI JOIN dropped USING (row_key)")
def delete_row(spark, sf):
    return mut.delete_row(cells(spark, sf), _dropped(spark, sf))


@query("delete_row_ts", with_(CELLS, _DROPPED) + f"""
    SELECT {_COLS} FROM cells WHERE NOT (row_key IN (SELECT row_key FROM dropped) AND ts <= {MID_MS})""")
def delete_row_ts(spark, sf):
    return mut.delete_row(cells(spark, sf), _dropped(spark, sf), MID_MS)


_KIND = """CASE pos % 7 WHEN 0 THEN 'family' WHEN 1 THEN 'columns' WHEN 2 THEN 'row' WHEN 3 THEN 'columns' ELSE 'column' END"""
_WHEN = f"CASE WHEN pos % 7 IN (0, 1, 2) THEN {MID_MS} WHEN pos % 7 IN (4, 5) THEN first_ts END"


@query("delete_typed", with_(CELLS, REQUESTS, f"""deletes AS (SELECT requests.*, {_KIND} AS kind, {_WHEN} AS ts FROM requests
      LEFT JOIN (SELECT {_CELL}, min(ts) AS first_ts FROM cells GROUP BY {_CELL}) USING ({_CELL}))""",
      f"marked AS (SELECT *, ts = max(ts) OVER (PARTITION BY {_CELL}) AS is_newest FROM cells)") + f"""
    SELECT {_COLS} FROM marked m WHERE NOT EXISTS (SELECT 1 FROM deletes d WHERE d.row_key = m.row_key AND (
         d.kind = 'row' AND m.ts <= d.ts
      OR d.kind = 'family' AND d.family = m.family AND m.ts <= d.ts
      OR d.kind = 'columns' AND d.family = m.family AND d.qualifier = m.qualifier AND m.ts <= coalesce(d.ts, m.ts)
      OR d.kind = 'column' AND d.family = m.family AND d.qualifier = m.qualifier AND (m.ts = d.ts OR d.ts IS NULL AND m.is_newest)))""")
def delete_typed(spark, sf):
    table = cells(spark, sf)
    return mut.delete_typed(table, _typed_deletes(spark, sf, table))


def _typed_deletes(spark, sf, table):
    first = table.groupBy("row_key", "family", "qualifier").agg(F.min("ts").alias("first_ts"))
    return requests(spark, sf).join(first, ["row_key", "family", "qualifier"], "left").selectExpr(
        "row_key", "family", "qualifier", f"{_KIND} AS kind", f"CAST({_WHEN} AS BIGINT) AS ts")


@query("retain_versions", with_(CELLS) + f"""
    SELECT {_COLS} FROM cells QUALIFY row_number() OVER (PARTITION BY {_CELL} ORDER BY ts DESC) <= 3""")
def retain_versions(spark, sf):
    return mut.retain_versions(cells(spark, sf))


@query("expire_ttl", with_(CELLS) + f"SELECT {_COLS} FROM cells WHERE {NOW_MS} - ts <= 1296000 * 1000")
def expire_ttl(spark, sf):
    return mut.expire_ttl(cells(spark, sf), 1296000, NOW_MS)


# Conditional changes.  Three checks per customer run one behind the other on one cell:
# newest value -> 99, 99 -> 77, and a first value where there was none.
def _cell_checks(spark, sf):
    asked = requests(spark, sf).select("pos", "row_key")
    step = F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(e).cast("string").alias("expected"), F.lit(v).alias("put_value"))
        for i, e, v in ((0, "18", "99"), (1, "99", "77"), (2, None, "new"))
    ])).alias("s")
    cell = [F.lit("move").alias("family"), F.lit("click").alias("qualifier")]
    return asked.select("pos", "row_key", step).select(
        (F.col("pos") * 3 + F.col("s.i")).alias("seq"), "row_key", *cell, "s.expected",
        F.lit("move").alias("put_family"), F.lit("click").alias("put_qualifier"), "s.put_value",
    )


_CLICK = """asked AS (SELECT pos, requests.row_key, c.value AS v FROM requests
      LEFT JOIN newest c ON c.row_key = requests.row_key AND c.family = 'move' AND c.qualifier = 'click')"""
_AFTER = "CASE WHEN v = '18' THEN '77' WHEN v = '99' THEN '77' WHEN v IS NULL THEN 'new' END"


@query("check_and_put", with_(CELLS, NEWEST, REQUESTS, _CLICK) + f"""
    SELECT {_COLS} FROM cells UNION ALL
    SELECT row_key, 'move', 'click', {NOW_MS}, {_AFTER} FROM asked WHERE {_AFTER} IS NOT NULL""")
def check_and_put(spark, sf):
    return chk.check_and_put(cells(spark, sf), _cell_checks(spark, sf), NOW_MS)[0]


@query("check_and_put_outcome", with_(CELLS, NEWEST, REQUESTS, _CLICK) + """
    SELECT pos * 3 AS seq, row_key, coalesce(v = '18', false) AS passed FROM asked
    UNION ALL SELECT pos * 3 + 1, row_key, coalesce(v IN ('18', '99'), false) FROM asked
    UNION ALL SELECT pos * 3 + 2, row_key, v IS NULL FROM asked""")
def check_and_put_outcome(spark, sf):
    return chk.check_and_put(cells(spark, sf), _cell_checks(spark, sf), NOW_MS)[1]


# One check per customer: where the newest click is 18, drop the whole position family.
def _delete_checks(spark, sf):
    return requests(spark, sf).select(
        F.col("pos").alias("seq"), "row_key", F.lit("move").alias("family"), F.lit("click").alias("qualifier"),
        F.lit("18").alias("expected"), F.lit("position").alias("delete_family"),
        F.lit(None).cast("string").alias("delete_qualifier"),
    )


@query("check_and_delete", with_(CELLS, NEWEST, REQUESTS, _CLICK) + f"""
    SELECT {_COLS} FROM cells WHERE NOT (family = 'position' AND row_key IN (SELECT row_key FROM asked WHERE v = '18'))""")
def check_and_delete(spark, sf):
    return chk.check_and_delete(cells(spark, sf), _delete_checks(spark, sf), NOW_MS)[0]


@query("check_and_delete_outcome", with_(CELLS, NEWEST, REQUESTS, _CLICK) + """
    SELECT pos AS seq, row_key, coalesce(v = '18', false) AS passed FROM asked""")
def check_and_delete_outcome(spark, sf):
    return chk.check_and_delete(cells(spark, sf), _delete_checks(spark, sf), NOW_MS)[1]


# Two checks per customer that touch different cells of a row: the first compares the click
# cell and writes the signup cell, the second asks for the signup cell and writes the view cell.
_COMPARE = "element_at(array('<','<=','=','<>','>=','>','exists'), CAST(pos % 7 AS INT) + 1)"
_HOLDS = """CASE WHEN v IS NULL THEN false ELSE CASE pos % 7 WHEN 0 THEN v < '18' WHEN 1 THEN v <= '18' WHEN 2 THEN v = '18'
    WHEN 3 THEN v <> '18' WHEN 4 THEN v >= '18' WHEN 5 THEN v > '18' ELSE true END END"""


def _mixed(spark, sf):
    asked = requests(spark, sf)
    first = asked.selectExpr("pos * 2 AS seq", "row_key", "'move' AS family", "'click' AS qualifier", f"{_COMPARE} AS op", "'18' AS expected")
    second = asked.selectExpr("pos * 2 + 1 AS seq", "row_key", "'position' AS family", "'signup' AS qualifier", "'exists' AS op",
                              "CAST(NULL AS STRING) AS expected")
    put = asked.selectExpr("pos * 2 AS seq", "0L AS step", "'position' AS family", "'signup' AS qualifier", "'put' AS op", "'in' AS value")
    drop = asked.selectExpr("pos * 2 AS seq", "1L AS step", "'position' AS family", "'error' AS qualifier", "'delete' AS op",
                            "CAST(NULL AS STRING) AS value")
    view = asked.selectExpr("pos * 2 + 1 AS seq", "0L AS step", "'move' AS family", "'view' AS qualifier", "'put' AS op", "'42' AS value")
    return chk.check_and_mutate(
        cells(spark, sf), first.unionByName(second), put.unionByName(drop).unionByName(view), NOW_MS
    )


_MIXED = (
    CELLS, NEWEST, REQUESTS, _CLICK,
    f"""answered AS (SELECT asked.*, {_HOLDS} AS first_passed, {_HOLDS} OR s.value IS NOT NULL AS second_passed FROM asked
      LEFT JOIN newest s ON s.row_key = asked.row_key AND s.family = 'position' AND s.qualifier = 'signup')""",
)


@query("check_and_mutate", with_(*_MIXED) + f"""
    SELECT {_COLS} FROM cells WHERE NOT (family = 'position' AND qualifier = 'error'
      AND row_key IN (SELECT row_key FROM answered WHERE first_passed))
    UNION ALL SELECT row_key, 'position', 'signup', {NOW_MS}, 'in' FROM answered WHERE first_passed
    UNION ALL SELECT row_key, 'move', 'view', {NOW_MS}, '42' FROM answered WHERE second_passed""")
def check_and_mutate(spark, sf):
    return _mixed(spark, sf)[0]


@query("check_and_mutate_outcome", with_(*_MIXED) + """
    SELECT pos * 2 AS seq, row_key, first_passed AS passed FROM answered
    UNION ALL SELECT pos * 2 + 1, row_key, second_passed FROM answered""")
def check_and_mutate_outcome(spark, sf):
    return _mixed(spark, sf)[1]


# The same changes made to a stored table, in batches of a run: the cells are batch 0.
def _table(spark, sf):
    path = scratch_path(spark, "cells")
    store.write_puts(cells(spark, sf), path, NOW_MS, "r", 0, buckets=8)
    return path


@query("stored_put_cells", ORACLES["put_cells"])
def stored_put_cells(spark, sf):
    """A copy is made between the batches."""
    path = _table(spark, sf)
    store.compact_cells(spark, path)
    store.write_puts(_puts(spark, sf), path, NOW_MS, "r", 1, buckets=8)
    return store.read_cells(spark, path)


@query("stored_mutate_rows", ORACLES["mutate_rows"])
def stored_mutate_rows(spark, sf):
    """Deletes are marks that stay beside the batch they hide."""
    path = _table(spark, sf)
    store.write_mutations(_mutations(spark, sf), path, MID_MS, "r", 1, buckets=8)
    return store.read_cells(spark, path)


@query("stored_delete_typed", ORACLES["delete_typed"])
def stored_delete_typed(spark, sf):
    """The marks are cleared by a copy."""
    path = _table(spark, sf)
    store.write_deletes(_typed_deletes(spark, sf, cells(spark, sf)), path, None, "r", 1, buckets=8)
    store.compact_cells(spark, path)
    return store.read_cells(spark, path)


@query("stored_increment_cells", ORACLES["increment_cells"])
def stored_increment_cells(spark, sf):
    """The batch is written twice, and a third time when a copy holds it; it counts once."""
    path, amounts = _table(spark, sf), _changes(spark, sf, "event_id % 10 AS amount")
    for _ in range(2):
        store.write_increments(amounts, path, NOW_MS, "r", 1, buckets=8)
    store.compact_cells(spark, path)
    store.write_increments(amounts, path, NOW_MS, "r", 1, buckets=8)
    return store.read_cells(spark, path)


@query("stored_append_cells", ORACLES["append_cells"])
def stored_append_cells(spark, sf):
    path, values = _table(spark, sf), _changes(spark, sf, "concat('|', CAST(event_id AS STRING)) AS value")
    for _ in range(2):
        store.write_appends(values, path, NOW_MS, "r", 1, buckets=8)
    return store.read_cells(spark, path)
