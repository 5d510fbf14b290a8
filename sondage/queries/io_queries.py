"""Round trips through the sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from sondage.operators.profile import DatabaseProfile
from sondage.queries.inputs import COLUMNS, table, tables
from sondage.queries.profile_queries import named
from sondage.session import scratch_path, spread
from sondage.sources import files, sinks
from sondage.sources.split_csv import read_csv_split
from sondage.streaming.chunked_load import load_in_chunks

PREFIX, SUFFIX = "export_", "_dataset"


def _schema(name: str) -> str:
    return ", ".join(f"{c} {k}" for c, k in COLUMNS[name].items())


def csv_roundtrip(spark, folder):
    """Tables to a folder of CSV files, loaded with inferred types, stored as Parquet, read back."""
    exported, stored = scratch_path(spark, "csv"), scratch_path(spark, "stored")
    for name in ("customer", "nation"):
        sinks.write_csv(table(spark, folder, name), f"{exported}/{PREFIX}{name}{SUFFIX}.csv")
    for name, df in files.load_csv_folder(spark, exported, PREFIX, SUFFIX).items():
        sinks.write_table(df, stored, name)
    back = files.load_tables(spark, stored)
    customers = back["customer"].select(F.lit("customer").alias("table"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                        F.col("c_nationkey").alias("parent"), F.col("c_acctbal").alias("balance"))
    nations = back["nation"].select(F.lit("nation").alias("table"), F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"),
                                    F.col("n_regionkey").alias("parent"), F.lit(None).cast("double").alias("balance"))
    both = customers.unionByName(nations)
    return named(both.withColumns({c: F.col(c).cast("bigint") for c in ("id", "parent")}))


def csv_gz_load(spark, folder):
    """A compressed export, read with a given schema and stored as Parquet, which can be split."""
    exported, stored = scratch_path(spark, "gz"), scratch_path(spark, "stored")
    sinks.write_csv(spread(table(spark, folder, "lineitem")), exported, "gzip")
    sinks.write_table(files.read_csv(spark, exported, _schema("lineitem")), stored, "lineitem")
    return files.load_tables(spark, stored)["lineitem"]


def append_load(spark, folder):
    """An export of several files, appended chunk by chunk."""
    exported, stored = scratch_path(spark, "parts"), scratch_path(spark, "stored")
    sinks.write_csv(spread(table(spark, folder, "lineitem")), exported)
    parts = [f"{exported}/{n}" for n in files.list_folder(spark, exported) if n.endswith(".csv")]
    size = max(len(parts) // 4, 1)
    chunks = [files.read_csv(spark, parts[i : i + size], _schema("lineitem")) for i in range(0, len(parts), size)]
    total = sinks.append_chunks(chunks, stored, "lineitem")
    loaded = files.load_tables(spark, stored)["lineitem"]
    return loaded.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("rows"), F.sum("l_quantity").alias("quantity"), F.lit(total).cast("bigint").alias("total_rows")
    )


def chunked_csv_load(spark, folder):
    """All documents, line breaks included, exported and loaded a few files at a time."""
    exported, stored, progress = (scratch_path(spark, label) for label in ("bulk", "stored", "progress"))
    sinks.write_csv(spread(table(spark, folder, "documents")), exported)
    load_in_chunks(spark, exported, _schema("documents"), f"{stored}/documents.parquet", progress, files_per_chunk=3)
    return files.load_tables(spark, stored)["documents"]


def csv_split_multiline(spark, folder):
    """All documents, line breaks included, exported and read back split by split."""
    exported = scratch_path(spark, "multiline")
    sinks.write_csv(table(spark, folder, "documents"), exported)
    return read_csv_split(spark, exported, _schema("documents"))


def _csv_roundtrip_of(name: str):
    def roundtrip(spark, folder):
        exported = scratch_path(spark, "csv")
        # A file may hold line breaks and so is read by one task: files of bounded rows.
        sinks.write_csv(spread(table(spark, folder, name)), f"{exported}/{PREFIX}{name}{SUFFIX}.csv")
        loaded = files.load_csv_folder(spark, exported, PREFIX, SUFFIX)[name]
        # Inference tells numbers, times and texts apart; widths are those of the given table.
        return loaded.select(*[F.col(c).cast(k) for c, k in COLUMNS[name].items()])

    roundtrip.__doc__ = f"All of ``{name}`` to CSV and back with inferred types."
    return roundtrip


#: Tables without lists, which CSV cannot hold.
FLAT = [t for t, kinds in COLUMNS.items() if not any("array" in k for k in kinds.values())]


def profile_json_roundtrip(spark, folder):
    """A profile written as JSON documents and read back."""
    profile = DatabaseProfile(tables(spark, folder, ["customer", "nation", "orders", "region"])).table_profile
    path = scratch_path(spark, "profile")
    sinks.write_json(profile, path)
    back = files.read_json_document(spark, path, profile.schema)
    return named(back.select("table", "row_count", "duplicate_rows", F.explode("pk_candidates").alias("pk")))


QUERIES = {f.__name__: f for f in (csv_roundtrip, csv_gz_load, append_load, chunked_csv_load, csv_split_multiline, profile_json_roundtrip)}
QUERIES |= {f"csv_roundtrip_{name}": _csv_roundtrip_of(name) for name in FLAT}

ORACLES = {
    "csv_roundtrip": """SELECT 'customer' AS table_name, c_custkey AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS parent,
            c_acctbal AS balance FROM customer
        UNION ALL SELECT 'nation', n_nationkey, n_name, n_regionkey, NULL FROM nation""",
    "csv_gz_load": "SELECT * FROM lineitem",
    "chunked_csv_load": "SELECT * FROM documents",
    "csv_split_multiline": "SELECT * FROM documents",
    **{f"csv_roundtrip_{name}": f"SELECT * FROM {name}" for name in FLAT},
    "append_load": """SELECT l_returnflag, l_linestatus, count(*) AS rows, sum(l_quantity) AS quantity,
        (SELECT count(*) FROM lineitem) AS total_rows FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "profile_json_roundtrip": """WITH keys AS (
            SELECT 'customer' AS table_name, unnest(['c_custkey', 'c_name', 'c_acctbal']) AS pk, count(*) AS n,
                unnest([count(DISTINCT c_custkey), count(DISTINCT c_name), count(DISTINCT c_acctbal)]) AS d,
                (SELECT count(*) FROM (SELECT DISTINCT * FROM customer) AS u) AS kinds FROM customer
            UNION ALL SELECT 'nation', unnest(['n_nationkey', 'n_name', 'n_regionkey']), count(*),
                unnest([count(DISTINCT n_nationkey), count(DISTINCT n_name), count(DISTINCT n_regionkey)]),
                (SELECT count(*) FROM (SELECT DISTINCT * FROM nation) AS u) FROM nation
            UNION ALL SELECT 'orders', unnest(['o_orderkey', 'o_custkey', 'o_totalprice']), count(*),
                unnest([count(DISTINCT o_orderkey), count(DISTINCT o_custkey), count(DISTINCT o_totalprice)]),
                (SELECT count(*) FROM (SELECT DISTINCT * FROM orders) AS u) FROM orders
            UNION ALL SELECT 'region', unnest(['r_regionkey', 'r_name']), count(*),
                unnest([count(DISTINCT r_regionkey), count(DISTINCT r_name)]),
                (SELECT count(*) FROM (SELECT DISTINCT * FROM region) AS u) FROM region)
        SELECT table_name, n AS row_count, n - kinds AS duplicate_rows, pk FROM keys WHERE n = d""",
}
