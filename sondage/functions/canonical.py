"""Canonical forms of values, so that equal values of different types meet in one group."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type families: values are only ever compared within one family.
NUM, STR, TS, OTHER = 0, 1, 2, 3

UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00")

# Strings longer than this travel through shuffles as a digest.
DIGEST_OVER = 64


def quoted(name: str) -> Column:
    """The column called ``name``, whatever punctuation the name holds."""
    return F.col(sql_name(name))


def sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_clean(value: str, dtype: T.DataType) -> str:
    """``clean`` as SQL, for statements over many columns."""
    return f"NANVL({value}, NULL)" if isinstance(dtype, (T.DoubleType, T.FloatType)) else value


def sql_number(name: str, dtype: T.DataType) -> str:
    return f"CAST({sql_clean(sql_name(name), dtype)} AS DOUBLE)"


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_string(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StringType)


def clean(col: Column, dtype: T.DataType) -> Column:
    """NaN counts as missing, as NULL does."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(col, F.lit(None).cast(dtype))
    return col


def as_number(col: Column, dtype: T.DataType) -> Column:
    return clean(col, dtype).cast("double")


def sql_as_text(value: str, dtype: T.DataType) -> str:
    """SQL for the text of a single value; negative zero reads as zero."""
    if isinstance(dtype, T.BinaryType):
        return f"HEX({value})"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"CAST({value} + CAST(0 AS {dtype.simpleString()}) AS STRING)"
    return f"CAST({value} AS STRING)"


def value_key(name: str, dtype: T.DataType) -> tuple[str, str, str, str]:
    """SQL for ``(family, whole, frac, text)`` of a column; family is NULL for a missing value.

    Integers, booleans and integral doubles share ``whole``, so 1 meets 1.0 but never '1';
    64-bit keys keep all digits, and decimals that no double holds are told apart by their digits. Long strings are replaced by their MD5 behind a NUL byte, which
    no short string of a text export starts with.
    """
    col = sql_name(name)
    no_whole, no_frac, no_text = "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS STRING)"

    def family(number: int, value: str) -> str:
        return f"IF({value} IS NULL, NULL, {number})"

    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return family(NUM, col), f"CAST({col} AS BIGINT)", no_frac, no_text
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        number = f"NANVL(CAST({col} AS DOUBLE), NULL)"
        integral = f"{number} = RINT({number}) AND ABS({number}) < 9.0E18D"
        return (
            family(NUM, number),
            f"IF({integral}, CAST({number} AS BIGINT), NULL)",
            f"IF({integral}, NULL, {number})",
            no_text,
        )
    if isinstance(dtype, T.DecimalType):
        whole = f"TRY_CAST({col} AS BIGINT)"
        integral = f"COALESCE({whole} = {col}, FALSE)"
        # A double stands for the value only if it leads back to it; else its digits do.
        held = f"COALESCE(TRY_CAST(CAST({col} AS DOUBLE) AS {dtype.simpleString()}) = {col}, FALSE)"
        digits = f"CAST({col} AS STRING)"
        if dtype.scale > 0:
            digits = f"TRIM(TRAILING '.' FROM TRIM(TRAILING '0' FROM {digits}))"
        return (
            family(NUM, col),
            f"IF({integral}, {whole}, NULL)",
            f"IF({integral} OR NOT {held}, NULL, CAST({col} AS DOUBLE))",
            f"IF({integral} OR {held}, NULL, {digits})",
        )
    if isinstance(dtype, (T.DateType, T.TimestampType)):
        return family(TS, col), f"UNIX_MICROS(CAST({col} AS TIMESTAMP))", no_frac, no_text
    if isinstance(dtype, T.TimestampNTZType):
        return family(TS, col), _wall_clock_micros(col), no_frac, no_text
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        text = f"TO_JSON({col})"
    else:
        text = f"HEX({col})" if isinstance(dtype, T.BinaryType) else col
    short = f"IF(OCTET_LENGTH({text}) <= {DIGEST_OVER}, {text}, CONCAT('\\0', MD5({text})))"
    return family(STR if is_string(dtype) else OTHER, text), no_whole, no_frac, short


def _wall_clock_micros(col: str) -> str:
    """Microseconds of a timestamp without time zone. The quick way goes through the session's
    zone, which is safe only if that zone skips no hours."""
    session = SparkSession.getActiveSession()
    if session is not None and session.conf.get("spark.sql.session.timeZone") in UTC_NAMES:
        return f"UNIX_MICROS(CAST({col} AS TIMESTAMP))"
    return f"TIMESTAMPDIFF(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {col})"


def row_digest(fields: list[tuple[Column, T.DataType]]) -> tuple[Column, Column]:
    """128 bits for a whole row: two 64-bit hashes of all its values with different starts. NULL
    equals NULL; which values are missing is hashed too, since the hash passes over them. Among
    10^12 rows the chance that any two different ones share a digest is about 10^-15."""
    values, missing = [], []
    for col, dtype in fields:
        value = clean(col, dtype)
        missing.append(value.isNull())
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            value = value + F.lit(0.0).cast(dtype)
        elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            value = F.to_json(value)
        values.append(value)
    start = [F.struct(*missing)] if missing else []
    return tuple(F.xxhash64(F.lit(seed), *start, *values) for seed in (1, 2))
