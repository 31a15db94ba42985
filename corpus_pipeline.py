"""A corpus pipeline over documents, from quality filter to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result and reads it again before the next, so a lost executor
costs no earlier stage.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamframe.llm import jaccard_join, line_dedup, packing, quality
from loamframe.llm.common import fresh, table, whole_text
from loamframe.llm.queries import QUALITY_KEPT, quality_model, tokenizer_file
from loamframe.session import scratch_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Every row is judged by its own text, so repeated rows stay or go together;
    a null text is empty and scored like one, null keys are kept, an empty table
    gives no rows.
    """
    score = fresh(docs, "_score")
    scored = quality.score(docs, quality_model(spark, sf_dir), name=score)
    return scored.where(F.col(score) >= QUALITY_KEPT).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every class of similar documents: the one with the least key
    (null ones last), then with the least hash of the text.

    Rows equal in key and text are one document, for which the row stands that
    is least in its other columns (those that have an order); rows that share a
    key only are told apart by their text. A null text is empty, texts without
    words are copies of each other, an empty table gives no rows.
    """
    parts = [fresh(docs, n) for n in ("_key", "_none", "_hash")]
    whole = fresh(docs, "_whole")
    marks = lambda key, mark: [F.coalesce(key, F.lit(0)).alias(parts[0]), key.isNull().alias(parts[1]), mark.alias(parts[2])]
    first = jaccard_join.first_of_classes(docs).select(*marks(F.col("key"), F.col("text_hash")))
    other = [f.name for f in docs.schema if f.name not in ("doc_id", "text") and not {"map", "variant"} & set(re.findall("[a-z]+", f.dataType.simpleString()))]
    order = F.struct(*other) if other else F.lit(0)
    # Repeated rows are one before the shuffle, so no key is hot.
    once = docs.groupBy(*marks(F.col("doc_id").cast("long"), F.xxhash64(whole_text()))).agg(F.min_by(F.struct(*docs.columns), order).alias(whole))
    return once.join(first, parts).select(f"{whole}.*")


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines and sentences that an earlier document
    has; n_chars follows the text.

    No row goes, also if its whole text does. The text with the lesser key (null
    keys first), then the lesser hash, is the earlier; rows equal in both are one
    text. A null text has no units, an empty table gives no rows.
    """
    cleaned = line_dedup.drop_repeated_lines(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, each with its place in a sequence.

    A null or empty text is a piece of its end alone; repeated rows and null keys
    are packed each on its own; an empty table gives no rows.
    """
    return packing.best_fit(packing.token_pieces(docs, tokenizer_file("word_bpe_49k.json")))


STAGES = [("quality", keep_quality), ("near_copies", drop_near_copies), ("repeats", drop_repeats), ("packing", pack)]

# The classifier and the packing have no SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
