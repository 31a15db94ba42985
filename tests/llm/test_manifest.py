"""The Merkle manifest against a plain version."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import Row

from loamframe.llm import manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def said(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(r, more=0):
    n = r["n_chars"] if r["n_chars"] is None else r["n_chars"] + more
    return h(*[said(x) for x in (r["doc_id"], r["source"], r["lang"], n, r["text"])])


def grow(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def climb(levels, pos, folded, proof):
    for level in levels[:-1]:
        other = level[pos ^ 1] if pos ^ 1 < len(level) else ""
        folded = h(other, folded) if pos % 2 else h(folded, other)
        proof, pos = proof + other, pos // 2
    return folded, proof


def plain(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row."""
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[g] = grow([leaf(r) for r in groups[g]])
    top = grow([trees[g][-1][0] for g in order]) if order else []
    out = []
    for at, g in enumerate(order):
        for pos, r in enumerate(groups[g]):
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            folded, proof = climb(top, at, *climb(trees[g], pos, leaf(r, int(tampered)), ""))
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], top[-1][0], h(proof), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def found(docs):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = manifest.document_manifest(docs)
    assert rows.columns == names
    return sorted([tuple(r) for r in rows.collect()], key=repr)


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_odd_documents(odd_documents, monkeypatch, levels):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    docs = odd_documents.withColumnRenamed("digest", "hash")
    assert found(docs) == plain(docs.select("doc_id", "source", "lang", "n_chars", "text").collect())


@pytest.mark.parametrize("levels", [3, 8])
def test_trees_of_many_sizes(spark, monkeypatch, levels):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    sizes = {"a": 1, "b": 2, "B": 3, None: 5, "é": 64, "zz": 65, "": 7, "hot": 700}
    rows = [Row(doc_id=i * 7 % 5000, source=None, lang=g, n_chars=i, text=f"text {g} {i % 5}") for g, n in sizes.items() for i in range(n)]
    rows += rows[:3] + [rows[-1]] * 5  # repeated rows
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    mine = found(docs)
    assert mine == plain(rows)
    changed = [r for r in mine if zlib.crc32(str(r[0]).encode()) % 7 == 0]
    assert changed and not any(r[-1] for r in changed) and all(r[-1] for r in mine if r not in changed)


def test_one_group_of_many_small_groups(spark):
    rows = [Row(doc_id=i, source="s", lang=f"l{i}", n_chars=i, text="t") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(docs) == plain(rows)


def test_no_documents(no_documents):
    assert found(no_documents) == []


def test_a_large_number_is_still_a_number(spark):
    rows = [Row(doc_id=i, source="s", lang="l", n_chars=2**63 - 1, text="t") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(docs) == plain(rows)
