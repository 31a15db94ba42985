"""Substring dedup: runs of lines and sentences that occur before are removed.

A unit is a line, or a sentence inside a line, with the white space after it.
Units are compared lower-cased, with white space (ASCII) made single and
trimmed. Of all equal units the first by (key, text's hash, place) stays. Any
other is repeated, and goes if it lies in an unbroken run of repeated units that
has MIN_WORDS words or more: a passage goes however short its lines are, a
sentence that many texts hold stays where it stands alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamframe.llm.common import fresh, shuffles_removed, slices, whole_text
from loamframe.session import scratch_path

MIN_WORDS = 30
COMMON = 1000  # a digest of 1/COMMON of all units is common; there are at most COMMON of them
# Where a unit ends: white space after a full stop, question or exclamation mark, or with a line feed.
UNIT_END = re.compile(r"[.!?][\t-\r ]+|\n[\t-\r ]*")


def cut_units(text: str) -> list[tuple[int, int, int, bytes]]:
    """(start, length, words, normalised text) of each unit; none of white space only."""
    ends = [m.end() for m in UNIT_END.finditer(text)]
    out, start = [], 0
    for end in [*ends, len(text)]:
        words = text[start:end].lower().encode().split()
        if words:
            out.append((start, end - start, len(words), b" ".join(words)))
        start = end
    return out


def text_units(documents: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per unit: _doc, _hash (of the whole text), start and length (code
    points in the original), words, and a 128-bit digest as two numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            rows = []
            for key, mark, said in zip(*(c.to_pylist() for c in b.columns)):
                for start, length, words, plain in cut_units(said):
                    digest = hashlib.blake2b(plain, digest_size=16).digest()
                    rows.append((key, mark, start, length, words, int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)))
            columns = list(zip(*rows)) or [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            names = ["_doc", "_hash", "start", "length", "words", "d1", "d2"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    texts = documents.select(F.col(doc).cast("long"), F.xxhash64(whole_text(text)), whole_text(text))
    return texts.mapInArrow(run, "_doc long, _hash long, start int, length int, words int, d1 long, d2 long")


def repeated_units(units: DataFrame, common: int = COMMON) -> DataFrame:
    """Units that are not the first of their digest, with the first one's place
    (kept_doc, kept_start).

    Counts are added up before the shuffle, so a unit in a third of all
    documents is one row per task. Every unit meets at most one first occurrence
    and stays one row throughout: those of the few common digests are sent to all
    tasks (at most ``common`` rows by their definition), the others, each a small
    share, come by a join on the digest, for which common units are dealt out evenly.
    """
    digest = ["d1", "d2"]
    first = units.groupBy(*digest).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_doc", "_hash", "start")).alias("first"))
    repeated = first.where("n > 1")
    total = units.count()
    # The floor keeps tiny tables off this path; at most ``common`` digests can reach the bound.
    often = F.col("n") >= max(1000, -(-total // common))
    hot = F.broadcast(repeated.where(often).select(*digest, F.col("first").alias("_often")))
    rare = repeated.where(~often).select(F.lit(False).alias("_common"), *digest, "first")
    place = F.struct("_doc", "_hash", "start")
    known = F.col("_often").isNotNull()
    dealt = units.join(hot, digest, "left").withColumn("_common", known).withColumn("d1", F.when(known, F.monotonically_increasing_id()).otherwise(F.col("d1")))
    both = dealt.join(rare, ["_common", *digest], "left").withColumn("first", F.coalesce("_often", "first"))
    # Repeated rows of the table give the same units again: they count once.
    names = ["_doc", "_hash", "start", "length", "words"]
    return both.where(place != F.col("first")).select(*names, F.col("first._doc").alias("kept_doc"), F.col("first.start").alias("kept_start")).distinct()


def long_runs(repeated: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The repeated units that lie in a run of at least ``min_words`` words.

    A run is units of one text without another unit between them; all that is
    gathered is a text's own repeated units.
    """
    text = Window.partitionBy("_doc", "_hash").orderBy("start")
    breaks = F.coalesce((F.lag(F.col("start") + F.col("length")).over(text) != F.col("start")).cast("int"), F.lit(0))
    runs = repeated.withColumn("_break", breaks).withColumn("_run", F.sum("_break").over(text.rowsBetween(Window.unboundedPreceding, 0)))
    words = F.sum("words").over(Window.partitionBy("_doc", "_hash", "_run"))
    return runs.withColumn("_words", words).where(F.col("_words") >= min_words).drop("_break", "_run", "_words")


def without_spans(texts: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.Series:
    """Texts without their spans (in ascending order); null without a text."""

    def cut(text, begin, size):
        if text is None:
            return None
        kept, at = [], 0
        for s, n in zip(begin.tolist(), size.tolist()):
            kept.append(text[at:s])
            at = s + n
        return "".join(kept) + text[at:]

    return pd.Series([cut(*row) for row in zip(texts, starts, lengths)], dtype=object)


def drop_repeated_lines(documents: DataFrame, doc: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``documents`` with ``text`` free of repeated runs of lines and sentences,
    and ``removed``: an array of (start, length, kept_doc, kept_start) in the
    original's offsets, a unit each, with the white space after it.

    A null text stays null with nothing removed; an empty one stays empty.
    Rows equal in key and text are one document and get the same decisions;
    rows with equal keys and other texts are told apart. Null keys come first.
    All other columns are kept (one named ``removed`` is replaced); an empty
    table gives no rows. What is gathered per document is its own units.
    """
    path = scratch_path(documents.sparkSession, "units")
    text_units(documents, doc, text).write.option("compression", "zstd").parquet(path)
    units = documents.sparkSession.read.parquet(path)
    whole = [F.col(c).cast("long").alias(c) for c in ("start", "length")]
    gone = (
        long_runs(repeated_units(units), min_words)
        .groupBy("_doc", "_hash")
        .agg(F.sort_array(F.collect_list(F.struct(*whole, "kept_doc", F.col("kept_start").cast("long").alias("kept_start")))).alias("_gone"))
    )
    # A step of its own: its shuffles are gone before the texts are shuffled.
    gone_path = scratch_path(documents.sparkSession, "spans")
    with shuffles_removed(documents.sparkSession):
        gone.write.parquet(gone_path)
    gone = documents.sparkSession.read.parquet(gone_path)
    rest = [c for c in documents.columns if c != "removed"]
    key, mark, spans = (fresh(documents, n) for n in ("_gone_doc", "_gone_hash", "_gone_spans"))
    gone = gone.withColumnsRenamed({"_doc": key, "_hash": mark, "_gone": spans})
    same = documents[doc].cast("long").eqNullSafe(F.col(key)) & (F.xxhash64(whole_text(text)) == F.col(mark))
    joined = documents.select(*rest).join(gone, same, "left")
    changed = F.col(spans).isNotNull()
    # Only texts with something to remove are sent to Python.
    left = F.pandas_udf(without_spans, "string")(F.when(changed, F.col(text)), F.col(spans)["start"], F.col(spans)["length"])
    return joined.select(
        *[F.when(changed, left).otherwise(F.col(text)).alias(text) if c == text else F.col(c) for c in rest],
        F.coalesce(spans, F.array().cast("array<struct<start:bigint,length:bigint,kept_doc:bigint,kept_start:bigint>>")).alias("removed"),
    )
