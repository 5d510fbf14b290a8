"""Inputs of the registered queries: the given tables, some of them made untidy by SQL that Spark
and the checking database both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from sondage.session import prepare

# Columns of the given tables, with Spark types.
COLUMNS = {
    "benchmark": {"item_id": "bigint", "text": "string"},
    "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
    "customer": {
        "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
        "c_mktsegment": "string",
    },
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
    "embeddings": {"vec_id": "bigint", "embedding": "array<float>", "label": "int"},
    "events": {
        "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
        "value": "double", "props": "string",
    },
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "lineitem": {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
        "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
        "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
    },
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "orders": {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
    },
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "part": {
        "p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int",
        "p_retailprice": "double",
    },
    "region": {"r_regionkey": "int", "r_name": "string"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
}
TABLES = list(COLUMNS)

# The given tables hold no nulls, duplicate rows or spelling variants, so three are made untidy:
# missing balances and mixed spellings, NaN values, rows that occur twice.
UNTIDY = {
    "customer": """SELECT c_custkey, c_name, c_nationkey,
        CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
        CASE c_custkey % 4 WHEN 0 THEN lower(c_mktsegment) WHEN 1 THEN concat('  ', c_mktsegment)
             ELSE c_mktsegment END AS c_mktsegment
        FROM customer""",
    "events": """SELECT event_id, ts, user_id, event_type,
        CASE WHEN event_id % 97 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END AS value, props
        FROM events""",
    "conversations": """SELECT conv_id, turn, role, text FROM (
        SELECT conv_id, turn, role, text FROM conversations
        UNION ALL
        SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN text END AS text FROM conversations) AS twice""",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def tables(spark: SparkSession, folder: str, names=None) -> dict[str, DataFrame]:
    return {n: table(spark, folder, n) for n in names or TABLES}


def run(spark: SparkSession, folder: str, sql: str, *names: str) -> DataFrame:
    """SQL over the named tables, without leaving temporary views behind."""
    return run_over(tables(spark, folder, names), sql)


def run_over(frames: dict[str, DataFrame], sql: str) -> DataFrame:
    sql = sql.replace("{", "{{").replace("}", "}}")
    for name in frames:
        sql = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", sql)
    return next(iter(frames.values())).sparkSession.sql(sql, **frames)


def untidy(spark: SparkSession, folder: str, names=None) -> dict[str, DataFrame]:
    """All tables, some in their untidy form."""
    return {
        n: run(spark, folder, UNTIDY[n], n) if n in UNTIDY else table(spark, folder, n) for n in names or TABLES
    }


def untidy_sql(name: str) -> str:
    """The same table for the checking database."""
    return f"({UNTIDY[name]})" if name in UNTIDY else name
