"""Operators over whole corpora, and the pipeline, against plain versions."""

import itertools
import random
import re

import numpy as np
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
import loamframe.llm.queries as q
from __spark_entry__ import oracle_sql, queries
from loamframe.llm import jaccard_join, line_dedup, topk

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(q.CHECKS))
def test_matches_check(spark, duck, name):
    assert difference(q.QUERIES[name](spark, SF), duck, q.CHECKS[name]) is None


def test_all_are_registered():
    assert set(q.QUERIES) | {"pipeline"} <= set(queries()) and set(q.CHECKS) <= set(oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in q.QUERIES) == list(range(1, 14))


# -- lines --------------------------------------------------------------------


def test_first_line_stays(spark):
    line = "one two three four five six seven eight nine ten " * 2 + "one two three four five six seven eight nine end"
    rows = [(2, f"Is.\n{line.upper()}  \nend"), (1, f"top\n{line}\n{line}"), (3, "Is.\nend"), (3, "Is.\nend")]
    out = {r["doc_id"]: r for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1]["text"] == f"top\n{line}\n" and out[2]["text"] == "Is.\nend" and out[3]["text"] == "Is.\nend"
    gone = out[2]["removed"][0]
    assert rows[0][1][gone["start"] : gone["start"] + gone["length"]] == line.upper() + "  \n" and (gone["kept_doc"], gone["kept_start"]) == (1, 4)


def test_common_line_takes_the_other_way(spark):
    line = " ".join(f"w{i}" for i in range(30))
    frame = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit(line + "\n"), F.col("id").cast("string")).alias("text"))
    out = line_dedup.drop_repeated_lines(frame)
    assert out.where(F.size("removed") == 1).count() == 2999 and out.where("doc_id = 0").first()["text"] == f"{line}\n0"


def plain_runs(rows, least=30):
    """Repeated runs removed, by hand: (key, text) rows with distinct keys."""
    seen, out = set(), {}
    for key, text in sorted(rows):
        pieces = [p for p in re.split(r"((?:[^.!?\n]|[.!?](?![\t-\r ]))*(?:[.!?][\t-\r ]+|\n[\t-\r ]*|$))", text) if p]
        plain = [" ".join(p.lower().split()) for p in pieces]
        again = []
        for p in plain:
            again.append(p in seen)
            seen.add(p)
        kept = []
        for repeated, group in itertools.groupby(range(len(pieces)), key=lambda i: again[i]):
            group = list(group)
            if not repeated or sum(len(plain[i].split()) for i in group) < least:
                kept += [pieces[i] for i in group]
        out[key] = "".join(kept)
    return out


def test_runs_of_short_lines_and_sentences(spark):
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(400))
    sentence = lambda n: " ".join(word() for _ in range(n)) + rng.choice([".", "!", "?", "", "..."])
    passages = [[sentence(rng.randint(2, 9)) for _ in range(rng.randint(3, 12))] for _ in range(12)]
    rows = []
    for key in range(150):
        parts = [sentence(rng.randint(2, 9)) for _ in range(rng.randint(0, 9))]
        at = rng.randint(0, len(parts))
        if rng.random() < 0.7:
            parts[at:at] = rng.choice(passages)
        rows.append((key, "".join(p + rng.choice([" ", "\n", "\n\n", "  "]) for p in parts)))
    found = {r["doc_id"]: r for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    expected = plain_runs(rows)
    assert {k: r["text"] for k, r in found.items()} == expected and sum(expected[k] != t for k, t in rows) > 20
    for key, text in rows:  # offsets are those of the original
        left, at = "", 0
        for g in found[key]["removed"]:
            left, at = left + text[at : g["start"]], g["start"] + g["length"]
            assert g["kept_doc"] <= key
        assert left + text[at:] == expected[key]


def test_odd_lines(spark, odd_documents, no_documents):
    out = line_dedup.drop_repeated_lines(odd_documents)
    assert out.count() == odd_documents.count() and out.columns == [*odd_documents.columns, "removed"]
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    assert kept[5] is None and kept[4] == "" and kept[9] == "short\nend" and kept[-3] is not None and kept[3] == ""
    assert line_dedup.drop_repeated_lines(no_documents).count() == 0


# -- similar texts ------------------------------------------------------------


def plain_classes(rows, similarity=0.8):
    words = [(d, tuple((t or "").lower().split())) for d, t in rows]
    sets = [{w[i : i + 5] for i in range(max(1, len(w) - 4))} if w else set() for _, w in words]
    linked = lambda i, j: words[i][1] == words[j][1] or bool(sets[i] and sets[j]) and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-6
    links = {i: [j for j in range(len(rows)) if j != i and linked(i, j)] for i in range(len(rows))}
    out, seen = [], {}
    for i in links:
        stack, group = [i], {i}
        while stack:
            for j in links[stack.pop()]:
                if j not in group:
                    group.add(j)
                    stack.append(j)
        keys = [rows[j][0] for j in group if rows[j][0] is not None]
        out.append((rows[i][0], min(keys) if keys else None, len(links[i])))
    return sorted(out, key=repr)


def made_texts():
    rng = random.Random(4)
    base = [[rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(400)) for _ in range(rng.randint(1, 120))] for _ in range(25)]
    rows = []
    for words in base:
        for _ in range(rng.randint(1, 9)):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = "new" + str(rng.randrange(50))
            rows.append((len(rows), " ".join(copy)))
    return rows


def test_classes_match_brute_force(spark):
    rows = made_texts()
    out = jaccard_join.similar_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in out), key=repr) == plain_classes(rows)


def test_large_group_is_cut_into_blocks(spark, monkeypatch):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for n in range(700):
        copy = list(words)
        copy[rng.randrange(200)] = f"x{n}"
        rows.append((n, " ".join(copy)))
    out = jaccard_join.similar_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["class_id"], r["n_links"]) for r in out} == {(0, 699)}


def test_few_long_texts_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 10_000)
    words = [f"w{i}" for i in range(300_000)]
    pairs = [(n, " ".join([f"{n // 2}x{w}" for w in words[: 20_000 * (1 + n // 2)]] + [f"end{n}"])) for n in range(8)]
    rows = [*pairs, (8, " ".join(words)), (9, " ".join([*words[:-1], "end"]))]
    out = jaccard_join.similar_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in out) == [(n, n // 2 * 2, 1) for n in range(10)]


def test_long_chain_is_one_class(spark):
    n = 300
    words = [f"w{i}" for i in range(4 * n + 100)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(n)]
    out = jaccard_join.similar_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["class_id"] for r in out} == {0} and max(r["n_links"] for r in out) >= 2


def test_odd_classes(spark, odd_documents, no_documents):
    out = jaccard_join.similar_classes(odd_documents).collect()
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    # White space outside ASCII is no word's end here.
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in out), key=repr) == plain_classes(rows)
    assert jaccard_join.similar_classes(no_documents).count() == 0


def test_texts_join_once_per_node(spark, monkeypatch):
    """However many blocks a node's texts are cut into, and the counts are the same."""
    words = [f"w{n}" for n in range(200)]
    rows = [(n, " ".join([*words, f"x{n}", f"y{n}"])) for n in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    whole, seen = sorted(map(tuple, jaccard_join.similar_classes(frame).collect())), []
    linked = jaccard_join.linked_texts

    def counted(signed, texts, similarity):
        def watched(members):
            seen.append((members.count(), members.select("tree", "node", "rep").distinct().count()))
            return texts(members)

        return linked(signed, watched, similarity)

    monkeypatch.setattr(jaccard_join, "linked_texts", counted)
    monkeypatch.setattr(jaccard_join, "BLOCK_TEXTS", 8)
    assert sorted(map(tuple, jaccard_join.similar_classes(frame).collect())) == whole == [(n, 0, 59) for n in range(60)]
    assert seen[0][0] == seen[0][1] > 0


def test_prefixes_shorten_until_the_recall_is_met():
    depth = jaccard_join.prefix_depth(0.8)
    assert 1 - (1 - 0.8**depth) ** jaccard_join.TREES >= jaccard_join.RECALL > 1 - (1 - 0.8 ** (depth + 1)) ** jaccard_join.TREES


# -- top k --------------------------------------------------------------------


def plain_top(rows, k=10):
    usable = {}
    for key, v in rows:
        if key is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        v = [int(np.floor(1024.0 * float(np.float32(x)))) for x in v]
        usable[key] = min(v, usable.get(key, v))
    width = max((len(v) for v in usable.values()), default=0)
    padded = {key: v + [0] * (width - len(v)) for key, v in usable.items()}
    out = []
    for key, v in padded.items():
        if key % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), other) for other, w in padded.items() if other != key)
            out += [(key, n + 1, other, -s) for n, (s, other) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("kind", ["spread", "copies", "odd", "few"])
def test_top_products(spark, kind):
    rng = np.random.default_rng(1)
    rows = [(int(n), [float(np.float32(x)) for x in rng.normal(size=6)]) for n in range(900)]
    if kind == "copies":
        rows = [(n, rows[n % 3][1]) for n in range(5000)]
    if kind == "odd":
        nan, inf = float("nan"), float("inf")
        rows += [(1000, None), (1001, []), (1002, [1.0, None]), (1003, [nan] * 6), (1004, [inf] * 6), (None, [1.0] * 6), (0, [-9.0] * 6), (-100, [1.0, 2.0]), (2000, [0.0] * 6), (5, rows[5][1])]
    if kind == "few":
        rows = rows[:4]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit("clash"))
    found = topk.top_products(topk.integer_vectors(frame), F.col("vec_id") % 100 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found) == plain_top(rows)
    assert topk.top_products(topk.integer_vectors(frame.limit(0)), F.col("vec_id") % 100 == 0).count() == 0


# -- pipeline -----------------------------------------------------------------


def test_pipeline_against_its_stages_by_hand(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good = {r["doc_id"] for r in q.quality_classifier(spark, SF).where("predicted = 1").collect()}
    rows = [(d, t) for d, t in sorted(docs.items()) if d in good]
    kept = [(d, t) for d, t in rows if (d, d) in {(a, b) for a, b, _ in plain_classes(rows)}]
    clean = plain_runs(kept)
    from loamframe.llm.wordbpe import WordBpe

    bpe = WordBpe.load(q.tokenizer_file("word_bpe_49k.json"))
    found = corpus_pipeline.run(spark, SF).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in found} == {d: len(bpe.encode(t)) // 4 + 1 for d, t in clean.items()}


def test_near_copies_tell_rows_of_a_key_apart(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(5, a), (5, b), (5, b), (3, b + " end"), (None, c), (None, c), (None, c + " end"), (None, a + " end"), (None, "alone here"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()]
    ends = [r for r in kept if r[1] and r[1].startswith("c0")]
    assert len(ends) == 1 and ends[0] in rows
    assert sorted(set(kept) - set(ends), key=repr) == sorted([(5, a), (3, b + " end"), (None, "alone here"), (None, None)], key=repr) and len(kept) == 5


def test_of_rows_equal_in_key_and_text_the_least_stays(spark):
    rows = [(1, "one two three", "z", 5), (1, "one two three", "b", 9), (1, "one two three", None, 7), (1, "one two three", None, 3), (2, "other words", "q", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n int").withColumn("tags", F.create_map(F.lit("k"), "n"))
    for parts in (1, 5):
        kept = corpus_pipeline.drop_near_copies(spark, docs.repartition(parts), SF)
        assert kept.columns == docs.columns
        assert sorted((r["doc_id"], r["source"], r["n"], r["tags"]["k"]) for r in kept.collect()) == [(1, None, 3, 3), (2, "q", 1, 1)]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_documents(spark, odd_documents, no_documents, name, stage):
    out = stage(spark, odd_documents, SF)
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert out.columns == odd_documents.columns
        assert out.where("held_out = 'h' AND score = 's' AND _doc = 1").count() == out.count() > 0
    assert out.count() > 0 and stage(spark, no_documents, SF).count() == 0
