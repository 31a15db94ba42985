"""Survey metadata documents (XML) as typed columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamframe.constants import METADATA_BOUNDS, METADATA_TEXT_FIELDS
from loamframe.functions.conversion import plain_number, strip
from loamframe.functions.rows import compute_once


def _schema() -> T.StructType:
    """Nested read schema from the dotted field paths."""
    tree: dict = {}
    for path in [*METADATA_TEXT_FIELDS.values(), *METADATA_BOUNDS.values()]:
        node = tree
        *parents, leaf = path.split(".")
        for name in parents:
            node = node.setdefault(name, {})
        node[leaf] = T.StringType()
    words = lambda key: T.ArrayType(T.StructType().add(key, T.ArrayType(T.StringType())))
    tree["idinfo"]["keywords"] = {"theme": words("themekey"), "place": words("placekey")}
    step = T.StructType().add("procdesc", "string").add("procdate", "string").add("srcused", "string")
    tree["dataqual"]["lineage"] = {"procstep": T.ArrayType(step)}

    def build(node: dict) -> T.StructType:
        return T.StructType([T.StructField(k, build(v) if isinstance(v, dict) else v) for k, v in node.items()])

    return build(tree).add("_corrupt_record", "string")


def _text(column: Column) -> Column:
    return F.nullif(strip(column), F.lit(""))


def _words(groups: str, key: str) -> Column:
    """Flat list of non-blank keywords over the repeated groups."""
    lists = F.transform(F.col(groups), lambda g: F.coalesce(g[key], F.array().cast("array<string>")))
    flat = F.coalesce(F.flatten(lists), F.array().cast("array<string>"))
    return F.array_compact(F.transform(flat, _text))


def ingest_survey_xml(df: DataFrame, xml: str, keep: list[str]) -> DataFrame:
    """One row per document; ``is_valid`` is false for text that is not XML."""
    options = {"columnNameOfCorruptRecord": "_corrupt_record", "ignoreSurroundingSpaces": "true"}
    parsed = compute_once(df, "x", F.from_xml(F.col(xml), _schema(), options))
    date = F.col("publication_date")
    steps = F.transform(
        F.coalesce(F.col("x.dataqual.lineage.procstep"), F.array()),
        lambda s: F.struct(
            _text(s["procdesc"]).alias("description"), _text(s["procdate"]).alias("date"), _text(s["srcused"]).alias("source_used")
        ),
    )
    return parsed.select(
        *keep,
        (F.col("x").isNotNull() & F.col("x._corrupt_record").isNull()).alias("is_valid"),
        *[_text(F.col(f"x.{path}")).alias(name) for name, path in METADATA_TEXT_FIELDS.items()],
        F.struct(*[plain_number(F.col(f"x.{path}")).alias(name) for name, path in METADATA_BOUNDS.items()]).alias("bounding_box"),
        _words("x.idinfo.keywords.theme", "themekey").alias("theme_keywords"),
        _words("x.idinfo.keywords.place", "placekey").alias("place_keywords"),
        steps.alias("process_steps"),
    ).withColumns(
        {
            "keywords": F.concat("theme_keywords", "place_keywords"),
            "published": F.coalesce(
                F.try_to_timestamp(date, F.lit("yyyyMMdd")), F.try_to_timestamp(date, F.lit("yyyy-M-d"))
            ).cast("date"),
            "scale_denominator": _text(F.regexp_extract("map_form", r"1:([0-9]+)", 1)).try_cast("long"),
        }
    )


def metadata_summary(metadata: DataFrame, keep: list[str]) -> DataFrame:
    """Headline fields per document, or an error marker for bad XML."""
    good = F.col("is_valid")
    only = lambda c: F.when(good, c)
    return metadata.select(
        *keep,
        only(F.col("title")).alias("title"),
        only(F.col("publication_date")).alias("publication_date"),
        only(F.col("publisher")).alias("publisher"),
        only(F.col("bounding_box")).alias("bounding_box"),
        only(F.size("keywords")).alias("keywords_count"),
        only(F.col("contact_email")).alias("contact_email"),
        only(F.coalesce(F.length("abstract"), F.lit(0))).alias("abstract_length"),
        F.when(~good, "Failed to parse metadata").alias("error"),
    )


def has_keywords(words: list[str], match_all: bool = False) -> Column:
    """Whether ``keywords`` has any (or all) of the words, in any case."""
    wanted = F.array(*[F.lit(w.lower()) for w in words])
    found = F.transform("keywords", F.lower)
    return F.size(F.array_except(wanted, found)) == 0 if match_all else F.arrays_overlap(wanted, found)


def search_keywords(metadata: DataFrame, words: list[str], match_all: bool = False) -> DataFrame:
    """Documents having any (or all) of the words as whole keywords, any case."""
    return metadata.where(has_keywords(words, match_all))


def search_keyword_sets(metadata: DataFrame, searches: Mapping[str, Column], name: str = "search") -> DataFrame:
    """Documents of several named searches (see :func:`has_keywords`), each with
    the search's name, in one pass over the metadata."""
    hits = F.array_compact(F.array(*[F.when(test, F.lit(label)) for label, test in searches.items()]))
    return metadata.select("*", F.explode(hits).alias(name))


def filter_bbox_overlap(metadata: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    """Documents whose box overlaps; touching boxes and missing bounds do not."""
    box = F.col("bounding_box")
    return metadata.where((box["west"] < east) & (box["east"] > west) & (box["south"] < north) & (box["north"] > south))


def metadata_statistics(metadata: DataFrame, as_of: str) -> DataFrame:
    """Counts and means over the valid documents as of a given day."""
    age = F.datediff(F.lit(as_of).cast("date"), F.col("published")) / 365.25
    scale = F.when(F.col("scale_denominator") != 0, F.col("scale_denominator"))
    return metadata.where("is_valid").agg(
        F.count(F.lit(1)).alias("count"),
        F.floor(F.avg(scale)).alias("avg_scale"),
        F.count_distinct("publisher").alias("n_publishers"),
        F.count_if(age < 10).alias("recent_surveys"),
        F.count_if(F.col("contact_email").isNotNull() | F.col("contact_phone").isNotNull()).alias("has_contact"),
        F.coalesce(F.bround(F.avg(F.size("keywords")), 1), F.lit(0.0)).alias("avg_keywords"),
    )


def metadata_publishers(metadata: DataFrame) -> DataFrame:
    """The distinct publishers, as rows (their number may grow with the data)."""
    return metadata.where("is_valid AND publisher IS NOT NULL").select("publisher").distinct()
