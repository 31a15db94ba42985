"""What the operators move and keep on disk: rows meet once, shuffles stay small."""

from pyspark.sql import functions as F

from loamframe.llm import fingerprint, line_dedup, suffix_tree
from loamframe.session import scratch_path


def joins(df):
    """The kinds of join in the plan, after Spark has rewritten it."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line.split("Join ")[1].split(",")[0].split()[0] for line in plan.splitlines() if "Join " in line]


def test_common_units_stay_one_row(spark):
    said = "one two three four five six seven eight nine ten " * 3
    rows = [(n, f"own{n // 2} words. " + said.strip() + ".") for n in range(2400)] + [(7, "own3 words. " + said.strip() + ".")] * 3
    units = line_dedup.text_units(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).cache()
    found = line_dedup.repeated_units(units)
    # Units meet first occurrences in joins that keep each of them, so a common one makes no rows.
    assert joins(found) == ["LeftOuter", "LeftOuter"]
    got = {(r["_doc"], r["start"]): (r["kept_doc"], r["kept_start"]) for r in found.collect()}
    start = lambda n: len(f"own{n // 2} words. ")
    common = {(n, start(n)): (0, start(0)) for n in range(1, 2400)}
    assert got == common | {(n, 0): (n - 1, 0) for n in range(1, 2400, 2)}
    assert found.count() == len(got)
    units.unpersist()


def test_numbered_words_leave_the_disk(spark, monkeypatch):
    places = []
    monkeypatch.setattr(suffix_tree, "scratch_path", lambda s, name, made=suffix_tree.scratch_path: places.append(made(s, name)) or places[-1])
    rows = [(n, f"a b c d word{n % 7} word{n % 5} e f") for n in range(60)] + [(None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = suffix_tree.score_texts(frame, F.col("doc_id") % 10 == 0)
    assert out.count() == 61 and out.agg(F.sum("n_tokens")).first()[0] == 60 * 9 + 1
    stored = next(p for p in places if "/tokens-" in p)
    left = spark.read.option("recursiveFileLookup", "true").schema("batch long, words binary, codes binary").parquet(stored)
    assert left.where("codes is not null").count() > 0 and left.where("words is not null").count() == 0


def test_shares_of_the_lookup_give_the_same(spark, monkeypatch):
    base = " ".join(f"word{i}" for i in range(60))
    rows = [(n, f"start{n // 3} {base} end{n // 4}") for n in range(40)] + [(None, base), (None, base), (3, base), (3, base), (50, None), (51, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    read = []

    def shares(n):
        monkeypatch.setattr(fingerprint, "LOOKUPS", n)
        monkeypatch.setattr(fingerprint, "scratch_path", lambda s, name, made=scratch_path: read.append(made(s, name)) or read[-1])
        found = sorted(map(str, fingerprint.linked_fingerprints(frame).collect()))
        met = spark.read.parquet(next(p for p in reversed(read) if "/met-" in p))
        assert met.count() == met.select("rep").distinct().count() > 10
        return found

    one = shares(1)
    assert len(one) == 46 and one == shares(2) == shares(5)
