"""Token files: library ids, exact round trips, reads of single documents."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import Row
from tokenizers import Tokenizer

from loamframe.llm import token_files
from loamframe.llm.bytebpe import ByteBpe
from loamframe.llm.queries import QUERIES

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_library(library):
    rng = random.Random(5)
    signs = ["a", "don't", "it's", "Où", "x²", "ªb", "µ", "×a", "ß.", "né,", "a-b", "(c)", "d...", "B9", " ", "  ", "\n", "\n\n", "\t", "é", "\xa0", " ", "\x1c", "\x85", "中文", "😀", ",", "...", "'s", "12", "<|endoftext|>", "​", "　", "x" * 90]
    texts = ["", " ", "\n", "a b\nc d\n\ne", "a b\n\n\nc", " a", "a ", "a \nb", "a\n b", "a  b   c", "tab\tbed words"]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(1, 14))) for _ in range(4000)]
    texts += [" ".join(rng.choice(signs) for _ in range(rng.randint(1, 9))) for _ in range(1000)]
    bpe = ByteBpe(FILE)
    for text in texts:
        assert np.frombuffer(bpe.encode(text), "<u4").tolist() == library(text), repr(text)


def test_many_texts_at_once_look_up_distinct_pieces_only(monkeypatch, library):
    """A chunk's equal words are looked up once, and cutting words at signs changes no id."""
    rng = random.Random(9)
    signs = ["a", "don't", "it's", "'s", "'.s", "x'll.", "a-b", "(c)", "d...", "B9", "9.b", "né,", "é.a", "…x", ".…", "'", "\"'s", "\n", "\n\n", " ", "  ", "\t", "\xa0", "中.文", "😀,", "x" * 90, ",", "Zz"]
    texts = ["", "a", "\n", "a\n\nb", "", " a", "a-b.c'd", ""]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    texts += [" ".join(rng.choice(signs) for _ in range(rng.randint(1, 9))) for _ in range(1000)]
    whole = [np.array([*library(t), 2], "<u4") for t in texts]
    for chunk, kind in ((8 << 20, "<u4"), (50, "<u2"), (5000, "<u4")):
        monkeypatch.setattr("loamframe.llm.bytebpe.CHUNK_BYTES", chunk)
        bpe = ByteBpe(FILE)
        assert bpe.encode_texts(texts, 2, kind).to_pylist() == [ids.astype(kind).tobytes() for ids in whole]
    assert bpe.encode_texts([], 2, "<u4").to_pylist() == []
    bpe = ByteBpe(FILE)
    bpe.encode_texts(["soil, soil soil. soil"] * 50, 2, "<u4")
    assert sorted(bpe.pieces) == [b" soil", b",", b".", b"soil"]
    spaces = [chr(c) for c in range(1 << 16) if chr(c).isspace()]
    texts = [f"a{x}b" for x in spaces] + ["a b"] + [f"{x}a" for x in spaces] + ["", "b\n\nc", "c\n\n\nd"]
    assert bpe._odd_ones(texts).tolist() == [bool(t) and bpe._odd(t) for t in texts]


def test_memory_of_words_starts_anew(monkeypatch, library):
    monkeypatch.setattr("loamframe.llm.bytebpe.REMEMBERED_BYTES", 6000)
    bpe = ByteBpe(FILE)
    for n in range(60):
        text = f"word{n} other{n} thing{n}"
        assert np.frombuffer(bpe.encode(text), "<u4").tolist() == library(text)
    assert bpe.later.bytes < 4000 and bpe.runs.bytes < 4000


@pytest.mark.parametrize("width, base", [(2, 300), (4, 300), (4, 70_000), (2, 65_500)])
def test_grammar_round_trip(width, base):
    rng = np.random.default_rng(base)
    for ids in (
        rng.integers(0, 6, 5000), np.zeros(1001, int), np.tile([1, 2, 3], 500), np.repeat(rng.integers(0, 9, 400), rng.integers(1, 9, 400)),
        np.array([7]), np.array([], int), rng.integers(0, base, 3000),
    ):
        symbols, rules, spans = token_files.build_grammar(ids, base, width, least=3, per_round=5)
        row = dict(base=base, width=width, symbols=symbols.tobytes(), rules=rules.astype("<u4").tobytes(), spans=spans.astype("<u4").tobytes())
        block = token_files.Block(row)
        assert (block.all_ids() == ids).all() and base + len(rules) <= (1 << 8 * width)
        for _ in range(30):
            a = int(rng.integers(0, len(ids) + 1))
            n = int(rng.integers(0, len(ids) - a + 1))
            assert block.ids(a, n).tolist() == ids[a : a + n].tolist()


def test_frequent_pairs_become_rules():
    ids = np.tile([1, 2, 1, 2, 3], 1000)
    symbols, rules, spans = token_files.build_grammar(ids, 10, 2)
    assert len(symbols) < 20 and rules[0].tolist() == [1, 2] and spans[0] == 2
    assert len(token_files.build_grammar(np.arange(500), 1000, 2)[1]) == 0  # nothing repeats


def plain(rows, library):
    out, start = [], 0
    for key, text in rows:
        ids = np.array(library(text or "") + [2], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("block_ids", [1, 200, 1 << 20])
def test_odd_documents(spark, odd_documents, library, tmp_path, block_ids):
    path = str(tmp_path / "files")
    token_files.write_token_files(odd_documents.repartition(5), FILE, 2, path, block_ids)
    rows = token_files.read_token_files(spark, path).collect()
    assert [r["start"] for r in sorted(rows, key=lambda r: r["start"])] == np.cumsum([0] + [r["n_tokens"] for r in sorted(rows, key=lambda r: r["start"])])[:-1].tolist()
    given = odd_documents.select("doc_id", "text").collect()
    ordered = [(r["key"], r) for r in sorted(rows, key=lambda r: r["start"])]
    assert [k for k, _ in ordered] == sorted((r["doc_id"] for r in given), key=lambda k: (k is not None, k or 0))
    whole = sorted((repr(r["doc_id"]), np.array(library(r["text"] or "") + [2], "<u4").tobytes()) for r in given)
    assert whole == sorted((repr(r["key"]), bytes(r["ids"])) for r in rows)
    asked = spark.createDataFrame([(2,), (5,), (None,), (99,), (2,)], "key long")
    some = token_files.read_token_files(spark, path, asked).collect()
    assert sorted(map(tuple, some)) == sorted(tuple(r) for r in rows if r["key"] in (2, 5))


def test_no_documents(spark, no_documents, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_token_files(no_documents, FILE, 2, path)
    assert token_files.read_token_files(spark, path).collect() == []


def test_whole_table(spark, library):
    sf = "/root/testdata/sf0.001"
    given = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    found = QUERIES["op12_token_files"](spark, sf)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, found.collect())) == sorted(plain(given, library))


def test_keys_in_many_shards(spark, library, tmp_path):
    rows = [Row(doc_id=i * 37 % 1000, text=f"row {i} " + "again and again " * (i % 7)) for i in range(900)]
    path = str(tmp_path / "files")
    token_files.write_token_files(spark.createDataFrame(rows).repartition(6), FILE, 2, path, 500)
    found = sorted(tuple(r)[:3] for r in token_files.read_token_files(spark, path).collect())
    expected = plain(sorted((r["doc_id"], r["text"]) for r in rows), library)
    assert found == sorted(e[:3] for e in expected)
