"""Type recovery as column expressions (no Python UDF on the data path)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamframe.constants import DATETIME_FORMATS, FALSE_WORDS, NULL_WORDS, SQL_TYPES, TRUE_WORDS

# Plain decimal notation. Java also accepts "12d" or "1f" as doubles, so the
# text is checked before it is cast.
NUMBER = r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$"
FIRST_NUMBER = r"[-+]?[0-9]*\.?[0-9]+"


def strip(text: Column) -> Column:
    """Text without leading and trailing white space of any kind."""
    return F.btrim(text, F.lit(" \t\n\r\f\v"))


def is_missing(raw: Column) -> Column:
    """Null, empty text or one of the null words."""
    return raw.isNull() | F.lower(raw).isin(*NULL_WORDS)


def plain_number(text: Column) -> Column:
    """Double for text in decimal notation, else null (also for nan and inf)."""
    value = F.when(text.rlike(NUMBER), strip(text).try_cast("double"))
    return F.when(~F.abs(value).isin(float("inf")), value)


def as_number(df: DataFrame, column: str) -> Column:
    """Double of a column: numeric columns as they are, text if it is a number."""
    if isinstance(df.schema[column].dataType, T.NumericType):
        value = F.col(column).cast("double")
        return F.when(F.abs(value) < float("inf"), value)
    return plain_number(F.col(column).cast("string"))


def to_int(raw: Column) -> Column:
    """Truncate toward zero; on failure take the first number inside the text."""
    number = F.coalesce(plain_number(raw), F.regexp_extract(raw, FIRST_NUMBER, 0).try_cast("double"))
    return F.when(~is_missing(raw), number.try_cast("long"))


def to_float(raw: Column) -> Column:
    """Double; on failure retry without currency signs, commas and blanks."""
    cleaned = F.regexp_replace(raw, r"[$, ]", "")
    return F.when(~is_missing(raw), F.coalesce(plain_number(raw), plain_number(cleaned)))


def to_bool(raw: Column) -> Column:
    word = F.lower(strip(raw))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def to_string(raw: Column, empty_string: bool = True) -> Column:
    """Stripped text; null becomes "" unless ``empty_string`` is off."""
    return F.when(is_missing(raw), F.lit("") if empty_string else F.lit(None).cast("string")).otherwise(
        strip(raw)
    )


def to_datetime(raw: Column) -> Column:
    parsed = F.coalesce(*[F.try_to_timestamp(raw, F.lit(fmt)) for fmt in DATETIME_FORMATS])
    # All formats start with three numbers; other text skips the attempts.
    return F.when(raw.rlike(r"^[0-9]{1,4}[-/][0-9]{1,2}[-/][0-9]{1,4}"), parsed).cast("timestamp_ntz")


def to_bytes(raw: Column) -> Column:
    return F.when(~is_missing(raw), F.encode(raw, "UTF-8"))


_FAMILIES: dict[str, Callable[[Column], Column]] = {
    "int": to_int,
    "float": to_float,
    "bool": to_bool,
    "string": to_string,
    "datetime": to_datetime,
    "bytes": to_bytes,
}
SPARK_TYPES = {
    "int": "bigint",
    "float": "double",
    "bool": "boolean",
    "string": "string",
    "datetime": "timestamp_ntz",
    "bytes": "binary",
}
_custom: dict[str, tuple[str, Callable[[Column], Column]]] = {}


def register_converter(sql_type: str, spark_type: str, fn: Callable[[Column], Column]) -> None:
    """Use ``fn`` (a column expression or a pandas UDF) for a SQL type name."""
    _custom[sql_type.lower()] = (spark_type, fn)


def unregister_converter(sql_type: str) -> None:
    _custom.pop(sql_type.lower(), None)


def family(sql_type: str) -> str:
    """Conversion family of a SQL type name; unknown names are text."""
    base = sql_type.lower().split("(")[0].strip()
    return SQL_TYPES.get(base, "string")


def spark_type(sql_type: str) -> str:
    known = _custom.get(sql_type.lower())
    return known[0] if known else SPARK_TYPES[family(sql_type)]


def convert(raw: Column, sql_type: str, empty_string: bool = True) -> Column:
    """Typed value of a text column, null where it cannot be recovered."""
    known = _custom.get(sql_type.lower())
    if known:
        return known[1](raw).cast(known[0])
    kind = family(sql_type)
    return to_string(raw, empty_string) if kind == "string" else _FAMILIES[kind](raw)
