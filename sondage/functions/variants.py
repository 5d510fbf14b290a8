"""Expressions over parsed JSON values (VARIANT)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondage.functions.canonical import sql_text


def path_of(key: str) -> str:
    """The path of a top-level key, whatever characters it holds."""
    return f"$['{key}']" if "'" not in key else f'$["{key}"]'


def member(record: str, key: str, kind: str = "variant") -> Column:
    """Value of ``key`` in the object column ``record``; NULL when it is absent or does not fit
    ``kind``. As a string, a nested value is JSON text."""
    return F.expr(f"try_variant_get({record}, {sql_text(path_of(key))}, {sql_text(kind)})")


def items(value: Column) -> Column:
    """Items of a JSON list, NULL for anything else."""
    return value.try_cast("array<variant>")


def entries(value: Column) -> Column:
    """Key and value pairs of a JSON object, NULL for anything else."""
    return value.try_cast("map<string,variant>")


def is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT<")


def is_nested(value: Column) -> Column:
    # In one test, since inside a lambda the shape would be read for each.
    return F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)<")


def _scalar_type(shape: Column) -> Column:
    # Whole numbers beyond 64 bits come as decimals of 19 digits or more without a fraction.
    wide_int = shape.rlike(r"^DECIMAL\((19|[23][0-9]),0\)$")
    return (
        F.when(shape == "BOOLEAN", "bool")
        .when((shape == "BIGINT") | wide_int, "int")
        .when(shape.startswith("DECIMAL") | shape.isin("DOUBLE", "FLOAT"), "float")
        .when(shape == "STRING", "str")
        .when(shape == "VOID", "null")
    )


def with_type_name(df: DataFrame, value: str, into: str) -> DataFrame:
    """Add the type name of a JSON value: bool, int, float, str, null, object, or list[...], where a
    list is ``list[object]`` when its first item is an object, else the sorted types of all items,
    ``empty`` for none. Shapes are read in steps of their own, so that each is read once, and not where the
    type is known without: of a list itself, and of the items behind an object."""
    outer = df.withColumn("_items", items(F.col(value)))
    outer = outer.withColumn("_shape", F.when(F.col("_items").isNull(), F.schema_of_variant(value)))
    outer = outer.withColumn("_first", F.schema_of_variant(F.get("_items", F.lit(0))))
    shapes = F.when(F.col("_first").startswith("OBJECT<"), F.array("_first")).otherwise(F.transform("_items", F.schema_of_variant))
    shaped = outer.withColumn("_shapes", F.when(F.col("_items").isNotNull(), shapes))

    def item_type(shape: Column) -> Column:
        nested = F.when(shape.startswith("OBJECT<"), "dict").when(shape.startswith("ARRAY<"), "list")
        return nested.otherwise(_scalar_type(shape))

    inner = (
        F.when(F.size("_shapes") == 0, "empty")
        .when(F.get("_shapes", F.lit(0)).startswith("OBJECT<"), "object")
        .otherwise(F.array_join(F.array_sort(F.array_distinct(F.transform(F.array_distinct("_shapes"), item_type))), "|"))
    )
    named = (
        F.when(F.col("_shapes").isNotNull(), F.concat(F.lit("list["), inner, F.lit("]")))
        .when(F.col("_shape").startswith("OBJECT<"), "object")
        .otherwise(_scalar_type(F.col("_shape")))
    )
    return shaped.withColumn(into, named).drop("_items", "_shape", "_first", "_shapes")
