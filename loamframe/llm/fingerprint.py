"""Document fingerprints: MinHash signatures, band join, exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamframe.llm import jaccard_join
from loamframe.llm.common import fresh, shuffles_removed, tasks, whole_text
from loamframe.llm.shingles import MinHash, WordHashes, normal_words, shingle_hashes
from loamframe.session import scratch_path

FUNCTIONS = 128
DIGITS = 4  # hexadecimal digits kept of each minimum
BAND_ROWS = 4
LOOKUPS = 2  # passes over the texts to find those that meet another, each with as small a share of them on disk


def _sets(texts: list[str], hashes: WordHashes) -> list[np.ndarray]:
    return [shingle_hashes(normal_words(t), hashes) for t in texts]


def _sign(minima: MinHash, sets: list[np.ndarray]) -> np.ndarray:
    """16 well-mixed bits of every minimum, which differ with all but certainty
    where the minima do."""
    return ((minima.signatures(sets) * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def _shown(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def fingerprints(documents: DataFrame, text: str = "text", functions: int = FUNCTIONS, name: str = "fingerprint") -> DataFrame:
    """All columns of ``documents`` and the fingerprint of the whole text, in
    hexadecimal (DIGITS per hash function).

    Shingles are runs of five lower-cased words (all words if there are fewer);
    texts without words, and null ones, share one fingerprint. Equal texts have equal
    fingerprints; the share of equal places estimates the Jaccard similarity.
    An existing column of that name is replaced; nothing is shuffled.
    """
    rest = [c for c in documents.columns if c != name]
    schema = documents.select(*rest).schema.add(name, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, minima = WordHashes(), MinHash(functions)
        for b in batches:
            signed = _sign(minima, _sets(b.column(len(rest)).to_pylist(), hashes))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], pa.array([_shown(s) for s in signed], pa.string())], names=[*rest, name])

    return documents.select(*rest, whole_text(text).alias(fresh(documents, "_text"))).mapInArrow(run, schema)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Exact similarity of two shingle sets (0 if either is empty)."""
    a, b = np.unique(a), np.unique(b)
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common) if len(a) and len(b) else 0.0


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, jaccard_edited double"
MARKS = "_row long, _hash long, _digest binary, _size long"
KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "double": pa.float64(), "binary": pa.binary()}


def _fields(schema: str) -> tuple[list[str], list[pa.DataType]]:
    names, kinds = zip(*(f.split() for f in schema.split(", ")))
    return list(names), [KINDS[k] for k in kinds]


class _Editor:
    """Result rows of documents and their followers."""

    def __init__(self, functions: int):
        self.hashes, self.minima = WordHashes(), MinHash(functions)

    def rows(self, keys: list, texts: list[str], signed: np.ndarray, followers: list[str], follower_signed: np.ndarray, sets: list[np.ndarray]) -> list[tuple]:
        edited = [t[: len(t) - len(t) // 4] + f[: len(t) // 4] for t, f in zip(texts, followers)]
        edited_sets = _sets(edited, self.hashes)
        edited_signed = _sign(self.minima, edited_sets)
        return [
            (k, len(t), hashlib.sha256(e.encode()).hexdigest(), _shown(s), _shown(x), float((s == x).mean()), float((s == n).mean()), jaccard(a, b))
            for k, t, e, s, x, n, a, b in zip(keys, texts, edited, signed, edited_signed, follower_signed, sets, edited_sets)
        ]

    def sign(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, list[bytes]]:
        """Shingles, fingerprints and digests of the words."""
        words = [normal_words(t) for t in texts]
        sets = [shingle_hashes(w, self.hashes) for w in words]
        return sets, _sign(self.minima, sets), [hashlib.blake2b(b" ".join(w), digest_size=16).digest() for w in words]


def edited_fingerprints(documents: DataFrame, doc: str = "doc_id", text: str = "text", functions: int = FUNCTIONS) -> DataFrame:
    """Fingerprints of every text and of its edited form, with their likeness.

    The edited form's last quarter (rounded down, in code points) is replaced by
    as much of the beginning of the next document, or all of it if it is
    shorter; documents are ordered by (key, text's hash, text), null keys
    first, and the first follows the last. ``jaccard_edited`` is the exact
    similarity that ``near_edited`` estimates. A null text is empty; other
    columns are ignored; an empty table gives no rows.

    Texts are dealt once, by ranges of the key. A range works through its own
    rows in order; only the first and the last row of each range (two per task)
    are then joined across ranges.
    """
    return _edited(documents, doc, text, functions).select(*_fields(RESULT)[0]).withColumnRenamed("doc_id", doc)


def _edited(documents: DataFrame, doc: str, text: str, functions: int) -> DataFrame:
    """RESULT and MARKS of every row: its number, its text's hash, the digest of
    its words and how many shingles it has."""
    spark = documents.sparkSession
    order = [F.col("doc_id").asc_nulls_first(), F.col("_hash"), F.col("text")]
    rows = documents.select(F.col(doc).cast("long").alias("doc_id"), whole_text(text).alias("text")).withColumn("_hash", F.xxhash64("text"))
    dealt = rows.repartitionByRange(tasks(spark), *order[:2]).sortWithinPartitions(*order).select("doc_id", "text", "_hash")
    schema = f"part int, end int, said string, {MARKS}, {RESULT}"
    names, types = _fields(schema)
    done_names, done_types = _fields(f"{MARKS}, {RESULT}")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, editor = TaskContext.get().partitionId(), _Editor(functions)
        held, seen = None, 0

        def out(results: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*results)) or [()] * len(types)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        nothing = (None,) * (len(_fields(RESULT)[0]) - 1)
        for b in batches:
            if not b.num_rows:
                continue
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            sets, signed, digests = editor.sign(texts)
            marks = [((part << 40) + seen + n, h, d, len(s)) for n, (h, d, s) in enumerate(zip(b.column(2).to_pylist(), digests, sets))]
            if not seen:
                yield out([(part, 1, texts[0], *marks[0], keys[0], *nothing)])
            seen += len(keys)
            if held:
                keys, texts, sets, signed, marks = [held[0], *keys], [held[1], *texts], [held[2], *sets], np.vstack([held[3], signed]), [held[4], *marks]
            done = editor.rows(keys[:-1], texts[:-1], signed[:-1], texts[1:], signed[1:], sets[:-1])
            yield out([(part, 0, None, *m, *r) for m, r in zip(marks, done)])
            held = (keys[-1], texts[-1], sets[-1], signed[-1:], marks[-1])
        if held:
            yield out([(part, 2, held[1], *held[4], held[0], *nothing)])

    path = scratch_path(spark, "edited")
    with shuffles_removed(spark):
        dealt.mapInArrow(walk, schema).write.option("compression", "zstd").parquet(path)
    table = spark.read.parquet(path)
    # Two short rows per task: which ranges have rows, in order.
    parts = sorted(r["part"] for r in table.where("end = 2").select("part").collect())
    following = spark.createDataFrame([(p, parts[(n + 1) % len(parts)]) for n, p in enumerate(parts)], "part int, after int")
    firsts = table.where("end = 1").select(F.col("part").alias("after"), F.col("said").alias("follower"))
    marked = _fields(MARKS)[0]
    seams = table.where("end = 2").select("part", *marked, "doc_id", "said").join(following, "part").join(firsts, "after").select(*marked, "doc_id", "said", "follower")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        editor = _Editor(functions)
        for b in batches:
            *marks, keys, texts, followers = (c.to_pylist() for c in b.columns)
            sets, signed, _ = editor.sign(texts)
            done = editor.rows(keys, texts, signed, followers, editor.sign(followers)[1], sets)
            columns = list(zip(*((*m, *r) for m, r in zip(zip(*marks), done)))) or [()] * len(done_types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, done_types)], names=done_names)

    closed = scratch_path(spark, "seams")
    with shuffles_removed(spark):
        seams.mapInArrow(close, f"{MARKS}, {RESULT}").write.option("compression", "zstd").parquet(closed)
    return table.where("end = 0").select(*done_names).unionByName(spark.read.parquet(closed))


def linked_fingerprints(documents: DataFrame, similarity: float = 0.8, doc: str = "doc_id", text: str = "text", functions: int = FUNCTIONS, rows: int = BAND_ROWS) -> DataFrame:
    """``edited_fingerprints`` with ``class_id`` and ``n_links``, both as in
    ``jaccard_join.similar_classes``.

    Fingerprints that are equal in a band (``rows`` places) meet; all texts of
    a band are verified exactly on their shingles, in bounded blocks. Texts at
    ``similarity`` 0.8 share one of 32 bands of 4 with probability 1 - 5e-8.
    """
    spark = documents.sparkSession
    done = _edited(documents, doc, text, functions)
    width = DIGITS * rows
    bands = F.transform(F.sequence(F.lit(0), F.lit(functions // rows - 1)), lambda n: F.xxhash64(F.substring("fingerprint", n * width + 1, F.lit(width))))
    signed = done.select("_row", F.col("doc_id").alias("_doc"), "_digest", "_size", F.when(F.col("_size") > 0, bands).alias("_nodes"))

    def texts(members: DataFrame) -> DataFrame:
        """Only texts that meet another; equal rows are one.

        All texts travel to find those, by LOOKUPS shares of their hash one after
        the other, so that only one share is on disk at a time.
        """
        place = lambda key, mark: [F.coalesce(key, F.lit(0)).alias("_key"), key.isNull().alias("_none"), mark.alias("_mark")]
        parts = ["_key", "_none", "_mark"]
        wanted = done.join(members.select(F.col("rep").alias("_row")).distinct(), "_row").select(F.col("_row").alias("rep"), *place(F.col("doc_id"), F.col("_hash")))
        said = documents.select(*place(F.col(doc).cast("long"), F.xxhash64(whole_text(text))), whole_text(text).alias("_said"))
        path = scratch_path(spark, "met")
        for n in range(LOOKUPS):
            share = F.pmod(F.col("_mark"), F.lit(LOOKUPS)) == n
            # Grouped as joined, so what is found does not travel again.
            met = said.where(share).join(wanted.where(share), parts).groupBy(*parts, "rep").agg(F.min("_said").alias("text")).select("rep", "text")
            with shuffles_removed(spark):
                met.write.mode("append").option("compression", "zstd").parquet(path)
        return spark.read.parquet(path)

    linked = jaccard_join.linked_texts(signed, texts, similarity)
    names = _fields(RESULT)[0]
    return done.select("_digest", *names).join(linked, "_digest").select(*names, "class_id", "n_links").withColumnRenamed("doc_id", doc)
