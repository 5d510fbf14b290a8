"""Queries over irregular JSON: one record per order, made of the order's own values.

Records differ from each other: fields come and go, types vary, a key may be repeated, and lines
that hold no record lie between them. Each record is built within its row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondage.operators import columns, dedup, fields, sampling, shred
from sondage.plans import flattening
from sondage.plans.flattening import ChildTable, FlatteningPlan
from sondage.queries.inputs import run_over, table
from sondage.queries.profile_queries import named
from sondage.queries.profile_sql import union
from sondage.session import scratch_path, spread
from sondage.sources import files
from sondage.sources.sinks import remove

LINES = """SELECT o_orderkey * 2 + pos AS line, value FROM (SELECT o_orderkey, posexplode(array_compact(array(
    concat(IF(o_orderkey % 8 = 0, '  ', ''), '{"order_id":', o_orderkey, ',"status":"', o_orderstatus, '","total":', o_totalprice,
        ',"flag":', IF(o_orderkey % 2 = 0, 'true', 'false'),
        IF(o_orderkey % 4 = 0, concat(',"note":"order ', o_orderkey, '"'), ''),
        IF(o_orderkey % 50 = 0, ',"rare":1', ''),
        IF(o_orderkey % 30 = 0, ',"third":{"x":1}', ''),
        ',"mixed":', CASE o_orderkey % 3 WHEN 0 THEN CAST(o_custkey AS STRING) WHEN 1 THEN concat('"c', o_custkey, '"') ELSE 'null' END,
        ',"tags":[', IF(o_orderkey % 11 = 0, '', concat('"', replace(o_orderpriority, '-', '","'), '"',
            IF(o_orderkey % 5 = 0, ',null', ''), IF(o_orderkey % 7 = 0, ',[1]', ''))), ']',
        ',"attrs":{"cust":', o_custkey, ',"prio":"', o_orderpriority, '"',
            IF(o_orderkey % 3 = 0, concat(',"weight":', o_orderkey % 13, '.5'), ''),
            IF(o_orderkey % 6 = 0, ',"deep":{"a":1}', ''), '}',
        ',"items":[', array_join(array_compact(array(
            IF(o_orderkey % 4 >= 1, concat('{"line":1,"part":', o_custkey + 1, '}'), NULL),
            IF(o_orderkey % 4 >= 2, concat('{"line":2,"part":', o_custkey + 2, ',"qty":1.5}'), NULL),
            IF(o_orderkey % 4 >= 3, concat('{"line":3,"part":', o_custkey + 3, '}'), NULL),
            IF(o_orderkey % 10 = 0, '7', NULL))), ','), ']',
        IF(o_orderkey % 9 = 0, ',"flag":false', ''), '}'),
    IF(o_orderkey % 6 = 0, element_at(array('', '{bad', '[1,2]', '3', 'null'), CAST(o_orderkey DIV 6 % 5 AS INT) + 1), NULL)
    ))) AS (pos, value) FROM orders)"""

PLAN = FlatteningPlan(
    "record",
    "order_id",
    ("status", "total", "flag", "note", "mixed", "attrs"),
    (
        ChildTable("record_items", "items", "objects", ("line", "part", "qty")),
        ChildTable("record_tags", "tags", "values"),
        ChildTable("record_attrs", "attrs", "keyvalue"),
    ),
)
# The same records keyed by a field that repeats and is missing in a third of them.
LOOSE_PLAN = FlatteningPlan("record", "mixed", ("order_id",), PLAN.children)


def lines(spark, folder) -> DataFrame:
    return run_over({"orders": spread(table(spark, folder, "orders"))}, LINES)


def records(spark, folder) -> DataFrame:
    return files.parse_objects(lines(spark, folder)).drop("value")


# One field that is text, a list of objects or a list of texts, by the record; objects of 30 keys; a seldom field.
SHAPES = """SELECT o_orderkey AS line, concat('{"order_id":', o_orderkey, ',"note":',
        CASE o_orderkey % 3 WHEN 0 THEN concat('"', o_orderpriority, '"') WHEN 1 THEN '[{"a":1}]' ELSE '["x"]' END,
        ',"wide":[{', array_join(transform(sequence(1, 30), i -> concat('"k', 10 + i, '":', i)), ','), '}]',
        IF(o_orderkey % 40 = 0, ',"seldom":2', ''), '}') AS value FROM orders"""


def shapes(spark, folder) -> DataFrame:
    lines_ = run_over({"orders": spread(table(spark, folder, "orders"))}, SHAPES)
    return files.parse_objects(lines_).drop("value")


def plan_mixed_shapes(spark, folder):
    return named(flattening.plan_rows(spark, flattening.propose(shapes(spark, folder), "record", F.col("line"))))


def consensus_disagreeing_shards(spark, folder):
    proposals = flattening.proposals_by_shard(shapes(spark, folder), fields.member("record", "order_id", "bigint"))
    return flattening.consensus(proposals)


def propose_by_consensus(spark, folder):
    data = shapes(spark, folder)
    shard = fields.member("record", "order_id", "bigint")
    return named(flattening.plan_rows(spark, flattening.propose_by_consensus(data, "record", shard, F.col("line"))))


def object_fields_wide(spark, folder):
    return fields.object_fields(shapes(spark, folder), ["note", "wide"], F.col("line"))


def jsonl_rejected_lines(spark, folder):
    return files.rejected_lines(files.read_lines(spark, _written_lines(spark, folder)))


def _written_lines(spark, folder) -> str:
    """The lines as text files whose names follow the order of the lines."""
    path = scratch_path(spark, "lines")
    ordered = lines(spark, folder).repartitionByRange("line").sortWithinPartitions("line")
    ordered.select("value").write.text(path)
    return path


def _order_id():
    return fields.member("record", "order_id", "bigint").alias("order_id")


def json_lines_scan(spark, folder):
    found = files.parse_objects(files.read_lines(spark, _written_lines(spark, folder)))
    return found.select(
        _order_id(), fields.member("record", "status", "string").alias("status"),
        fields.member("record", "total", "double").alias("total"),
    )


# Raw lines that the registered head query loads.
HEAD = 1_000


def jsonl_head_lines(spark, folder):
    head = sampling.head_lines(files.read_lines(spark, _written_lines(spark, folder)), HEAD)
    return files.parse_objects(head).select("line_no", _order_id())


def json_types(spark, folder):
    marked = records(spark, folder).withColumn("order_id", _order_id())
    return fields.field_types(marked, ["order_id"])


def field_catalog(spark, folder):
    catalog = fields.field_catalog(records(spark, folder))
    return catalog.select("field", "present_pct", F.explode("types").alias("type"))


def plan_from_catalog(spark, folder):
    data = records(spark, folder)
    plan = flattening.propose(data, "record", F.col("line"))
    return named(flattening.plan_rows(spark, plan))


def plan_consensus(spark, folder):
    proposals = flattening.proposals_by_shard(records(spark, folder), fields.member("record", "order_id", "bigint"))
    return flattening.consensus(proposals)


def object_fields(spark, folder):
    return fields.object_fields(records(spark, folder), "items", F.col("line"))


def flatten_main(spark, folder):
    rows = shred.main_table(records(spark, folder), PLAN, "line")
    return rows.select(
        F.col("order_id").cast("bigint"), "status", F.col("total").cast("double"), "flag", "note", "mixed",
        F.get_json_object("attrs", "$.prio").alias("attr_prio"),
    )


def _child(spark, folder, number: int) -> DataFrame:
    rows = shred.child_rows(records(spark, folder), PLAN, PLAN.children[number])
    return rows.withColumn("order_id", F.col("order_id").cast("bigint"))


def flatten_objects(spark, folder):
    items = _child(spark, folder, 0)
    return items.select("order_id", F.col("line").cast("bigint"), F.col("part").cast("bigint"), F.col("qty").cast("double"))


def flatten_values(spark, folder):
    return _child(spark, folder, 1)


def flatten_keyvalue(spark, folder):
    return _child(spark, folder, 2)


def flatten_row_counts(spark, folder):
    return named(shred.table_row_counts(records(spark, folder), LOOSE_PLAN))


def replace_all_load(spark, folder):
    """Two loads into one folder: the second leaves nothing of the first."""
    target = scratch_path(spark, "warehouse")
    first = FlatteningPlan("stale", "order_id", ("status",), (ChildTable("stale_tags", "tags", "values"),))
    data, parsed = shred.parsed_records(records(spark, folder), "line")
    shred.load_records(data, first, target, "line", parsed=True).count()
    shred.load_records(data, LOOSE_PLAN, target, "line", parsed=True).count()
    remove(spark, parsed)
    return named(columns.row_counts(files.load_tables(spark, target)))


def first_wins_dedup(spark, folder):
    orders = table(spark, folder, "orders")
    key = F.when(F.col("o_orderkey") % 40 != 0, F.col("o_custkey"))
    rows = orders.withColumn("o_custkey", key)
    return dedup.first_per_key(rows, F.col("o_custkey"), F.col("o_orderkey"))


QUERIES = {
    f.__name__: f
    for f in (
        json_lines_scan, jsonl_head_lines, json_types, field_catalog, plan_from_catalog, plan_consensus, object_fields,
        flatten_main, flatten_objects, flatten_values, flatten_keyvalue, flatten_row_counts, replace_all_load,
        first_wins_dedup, plan_mixed_shapes, consensus_disagreeing_shards, propose_by_consensus, object_fields_wide,
        jsonl_rejected_lines,
    )
}

_TAGS = """'list[' || CASE WHEN o_orderkey % 11 = 0 THEN 'empty' ELSE
    CASE WHEN o_orderkey % 7 = 0 THEN 'list|' ELSE '' END || CASE WHEN o_orderkey % 5 = 0 THEN 'null|' ELSE '' END || 'str' END || ']'"""
_ITEMS = """CASE WHEN o_orderkey % 4 > 0 THEN 'list[object]' WHEN o_orderkey % 10 = 0 THEN 'list[int]' ELSE 'list[empty]' END"""
_MIXED = "CASE o_orderkey % 3 WHEN 0 THEN 'int' WHEN 1 THEN 'str' ELSE 'null' END"
_FIELDS = {
    "order_id": ("true", "'int'"), "status": ("true", "'str'"), "total": ("true", "'float'"), "flag": ("true", "'bool'"),
    "note": ("o_orderkey % 4 = 0", "'str'"), "rare": ("o_orderkey % 50 = 0", "'int'"),
    "third": ("o_orderkey % 30 = 0", "'object'"), "mixed": ("true", _MIXED), "tags": ("true", _TAGS),
    "attrs": ("true", "'object'"), "items": ("true", _ITEMS),
}
_TYPES = "types AS (" + union(
    f"SELECT o_orderkey AS order_id, '{field}' AS field, {kind} AS type FROM orders WHERE {test}"
    for field, (test, kind) in _FIELDS.items()
) + ")"
_CHILD = """CASE WHEN max(CASE WHEN type = 'list[object]' THEN 1 ELSE 0 END) = 1 THEN 'objects'
    WHEN max(CASE WHEN type LIKE 'list[%' THEN 1 ELSE 0 END) = 1 THEN 'values'
    WHEN max(CASE WHEN type = 'object' THEN 1 ELSE 0 END) = 1 THEN 'keyvalue' END"""
_MAIN = f"CASE WHEN {_CHILD} IS NULL OR bool_or(type IN ('bool', 'float', 'int', 'str')) THEN 'main' END"
_OBJECT_ROWS = """SELECT o_orderkey AS order_id, i AS line, o_custkey + i AS part, CASE WHEN i = 2 THEN CAST(1.5 AS DOUBLE) END AS qty
    FROM orders, range(1, 4) AS r(i) WHERE i <= o_orderkey % 4"""
_VALUE_ROWS = """SELECT o_orderkey AS order_id, unnest(string_split(o_orderpriority, '-')) AS value FROM orders WHERE o_orderkey % 11 <> 0
    UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 5 = 0"""
_PAIR_ROWS = """SELECT o_orderkey AS order_id, 'cust' AS key, CAST(o_custkey AS VARCHAR) AS value FROM orders
    UNION ALL SELECT o_orderkey, 'prio', o_orderpriority FROM orders
    UNION ALL SELECT o_orderkey, 'weight', (o_orderkey % 13) || '.5' FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL SELECT o_orderkey, 'deep', '{"a":1}' FROM orders WHERE o_orderkey % 6 = 0"""
_MIXED_VALUE = "CASE o_orderkey % 3 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN 'c' || o_custkey END"
_LOOSE_COUNTS = f"""SELECT 'record' AS table_name, count(*) AS rows_seen,
        count(*) FILTER (WHERE k IS NULL) + count(DISTINCT k) AS rows_loaded FROM (SELECT {_MIXED_VALUE} AS k FROM orders) AS m
    UNION ALL SELECT 'record_items', count(*), count(*) FROM ({_OBJECT_ROWS}) AS a
    UNION ALL SELECT 'record_tags', count(*), count(*) FROM ({_VALUE_ROWS}) AS b
    UNION ALL SELECT 'record_attrs', count(*), count(*) FROM ({_PAIR_ROWS}) AS c"""
_SHAPE_KEY = "SELECT DISTINCT 'record' AS table_name, 'order_id' AS source_field, 'key' AS kind FROM orders"
_SHAPE_ROWS = """SELECT DISTINCT 'record' AS table_name, 'note' AS source_field, 'main' AS kind FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL SELECT DISTINCT 'record_note', 'note', 'objects' FROM orders WHERE o_orderkey % 3 = 1
    UNION ALL SELECT DISTINCT 'record_wide', 'wide', 'objects' FROM orders
    UNION ALL SELECT DISTINCT 'record', 'seldom', 'main' FROM orders WHERE o_orderkey % 40 = 0"""

ORACLES = {
    "json_lines_scan": "SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS total FROM orders",
    "jsonl_head_lines": f"""SELECT line_no, o_orderkey AS order_id FROM (
        SELECT o_orderkey, extra, row_number() OVER (ORDER BY o_orderkey, extra) - 1 AS line_no FROM (
            SELECT o_orderkey, 0 AS extra FROM orders
            UNION ALL SELECT o_orderkey, 1 FROM orders WHERE o_orderkey % 6 = 0) AS raw) AS numbered
        WHERE line_no < {HEAD} AND extra = 0""",
    "json_types": f"WITH {_TYPES} SELECT order_id, field, type FROM types",
    "field_catalog": f"""WITH {_TYPES}, present AS (SELECT field, count(*) AS n FROM types GROUP BY field)
        SELECT DISTINCT field, round(n / (SELECT count(*) FROM orders) * 100, 1) AS present_pct, type
        FROM types JOIN present USING (field) WHERE n / (SELECT count(*) FROM orders) * 100 >= 5""",
    "plan_from_catalog": f"""WITH {_TYPES}, found AS (SELECT field, {_CHILD} AS child, {_MAIN} AS main FROM types GROUP BY field),
        kinds AS (SELECT field, child AS kind FROM found WHERE child IS NOT NULL
            UNION ALL SELECT field, main FROM found WHERE main IS NOT NULL)
        SELECT CASE WHEN kind = 'main' THEN 'record' ELSE 'record_' || field END AS table_name, field AS source_field,
            CASE WHEN field = 'order_id' THEN 'key' ELSE kind END AS kind FROM kinds""",
    "plan_consensus": f"""WITH {_TYPES}, proposals AS (SELECT order_id % 3 AS shard, field, {_CHILD} AS child, {_MAIN} AS main
            FROM types GROUP BY 1, 2)
        SELECT field AS source_field, arg_min(child, shard) AS kind FROM proposals WHERE child IS NOT NULL GROUP BY field
        UNION ALL SELECT DISTINCT field, main FROM proposals WHERE main IS NOT NULL""",
    "plan_mixed_shapes": f"""SELECT * FROM ({_SHAPE_KEY}) AS k UNION ALL SELECT * FROM ({_SHAPE_ROWS}) AS r""",
    "consensus_disagreeing_shards": f"SELECT source_field, 'main' AS kind FROM ({_SHAPE_KEY}) AS k UNION ALL "
    f"SELECT source_field, kind FROM ({_SHAPE_ROWS}) AS r",
    "propose_by_consensus": f"""SELECT * FROM ({_SHAPE_KEY}) AS k UNION ALL SELECT * FROM ({_SHAPE_ROWS}) AS r""",
    "object_fields_wide": """SELECT DISTINCT 'note' AS source_field, 'a' AS inner_field, 1 AS place FROM orders WHERE o_orderkey % 3 = 1
        UNION ALL SELECT 'wide', 'k' || (10 + i), CAST(i AS INTEGER) FROM range(1, 31) AS r(i) WHERE EXISTS (SELECT 1 FROM orders)""",
    "jsonl_rejected_lines": """SELECT CASE (o_orderkey // 6) % 5 WHEN 0 THEN 'blank' WHEN 1 THEN 'malformed' ELSE 'not an object' END
        AS reason, count(*) AS lines FROM orders WHERE o_orderkey % 6 = 0 GROUP BY 1""",
    "object_fields": f"""WITH keys AS (SELECT order_id, line, unnest(CASE WHEN qty IS NULL THEN ['line', 'part']
            ELSE ['line', 'part', 'qty'] END) AS inner_field FROM ({_OBJECT_ROWS}) AS a),
        first_seen AS (SELECT inner_field, min(order_id * 10 + line) AS seen FROM keys GROUP BY inner_field)
        SELECT 'items' AS source_field, inner_field, CAST(row_number() OVER (ORDER BY seen, inner_field) AS INTEGER) AS place
        FROM first_seen""",
    "flatten_main": f"""SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS total,
        CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 9 <> 0 THEN 'true' ELSE 'false' END AS flag,
        CASE WHEN o_orderkey % 4 = 0 THEN 'order ' || o_orderkey END AS note, {_MIXED_VALUE} AS mixed,
        o_orderpriority AS attr_prio FROM orders""",
    "flatten_objects": _OBJECT_ROWS,
    "flatten_values": _VALUE_ROWS,
    "flatten_keyvalue": f"SELECT *, TRY_CAST(value AS DOUBLE) AS value_num FROM ({_PAIR_ROWS}) AS p",
    "flatten_row_counts": _LOOSE_COUNTS,
    "replace_all_load": f"SELECT table_name, rows_loaded AS row_count FROM ({_LOOSE_COUNTS}) AS l",
    "first_wins_dedup": """SELECT o_orderkey, key AS o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
        SELECT *, row_number() OVER (PARTITION BY key ORDER BY o_orderkey) AS place FROM (
            SELECT *, CASE WHEN o_orderkey % 40 <> 0 THEN o_custkey END AS key FROM orders) AS keyed) AS placed
        WHERE place = 1 OR key IS NULL""",
}
