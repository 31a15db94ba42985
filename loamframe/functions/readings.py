"""Column expressions for station times, flags and element codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loamframe.constants import SECOND_NETWORK_CODES


def parse_station_time(text: Column) -> Column:
    """Naive timestamp from ISO text (zone applied, in UTC), "date time" or a date.

    Unreadable text gives null.
    """
    iso = F.when(text.contains("T"), text.try_cast("timestamp"))
    spaced = F.when(
        ~text.contains("T"),
        F.coalesce(
            F.try_to_timestamp(text, F.lit("yyyy-M-d H:m")),
            F.try_to_timestamp(text, F.lit("yyyy-M-d H:m:s")),
            F.try_to_timestamp(text, F.lit("yyyy-M-d")),
        ),
    )
    return F.coalesce(iso, spaced).cast("timestamp_ntz")


def local_to_utc(ts: Column, offset_hours: Column) -> Column:
    """UTC time of a naive local time; unchanged without an offset."""
    return F.coalesce(ts - F.make_dt_interval(hours=offset_hours), ts)


def qc_flags(qc: Column, qa: Column, orig_qc: Column) -> Column:
    """QC:x, QA:x and ORIG_QC:x for the flags that are set."""
    label = lambda name, c: F.when(c != "", F.concat(F.lit(name + ":"), c))
    return F.array_compact(F.array(label("QC", qc), label("QA", qa), label("ORIG_QC", orig_qc)))


def cm_to_inches(depth: Column) -> Column:
    return depth / 2.54


def element_string(code: Column, depth_cm: Column, ordinal: Column) -> Column:
    """BASE:depth:ordinal with whole inches below ground; blank without depth."""
    inches = F.abs(F.bround(F.abs(cm_to_inches(depth_cm)))).cast("int")
    return F.concat(code, F.lit(":"), F.coalesce((-inches).cast("string"), F.lit("")), F.lit(":"), ordinal.cast("string"))


def parse_element(text: Column) -> Column:
    """struct(base_code, depth_inches, ordinal); malformed text is all base."""
    part = lambda i: F.split_part(text, F.lit(":"), F.lit(i))
    good = F.length(text) - F.length(F.replace(text, F.lit(":"), F.lit(""))) == 2
    return F.struct(
        F.when(good, part(1)).otherwise(text).alias("base_code"),
        F.when(good, part(2).try_cast("int")).alias("depth_inches"),
        F.coalesce(F.when(good, part(3).try_cast("int")), F.lit(1)).alias("ordinal"),
    )


def base_code(variable: Column) -> Column:
    """Element code of a second-network variable, any case, else UNKNOWN."""
    name = F.lower(variable)
    codes = F.create_map(*[F.lit(x) for pair in SECOND_NETWORK_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(codes, name), F.lit("UNKNOWN"))
