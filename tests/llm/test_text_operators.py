"""Operators on single texts against plain versions of themselves."""

import hashlib
import zlib
from collections import Counter
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import loamframe.llm.queries as q
from loamframe.llm import chat, fingerprint, html_text, jaccard_join, packing, quality, sentencepiece_codec, suffix_tree

SF = "/root/testdata/sf0.001"


def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


# -- chat ---------------------------------------------------------------------


def test_examples_hold_only_what_precedes(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "one"), (1, 3, "user", "v"), (1, 4, "assistant", "two <|im_end|>"), (2, 0, "user", "alone"), (None, 0, "assistant", None)]
    out = chat.prefix_examples(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    mine = sorted((r for r in out if r["conv_id"] == 1), key=lambda r: r["example"])
    assert [r["n_turns"] for r in mine] == [3, 5] and mine[1]["content"].startswith(mine[0]["content"])
    said = [r["content"][r["loss_start"] : r["loss_start"] + r["loss_chars"]] for r in mine]
    assert said == ["one", "two <\\|im_end|>"] and all(r["content"].endswith(s + chat.CLOSE) for r, s in zip(mine, said))
    assert [(r["loss_chars"], r["last"]) for r in out if r["conv_id"] == 2] == [(None, True)]
    assert [(r["loss_chars"], r["n_turns"]) for r in out if r["conv_id"] is None] == [(0, 1)]


def test_chat_is_reversible(spark):
    texts = ["", None, "\\s\\n\\|", "<|im_start|>x\n<|im_end|>\n", "a<", "<", "|", "\n\n", "\\"]
    rows = [(1, n, role, t) for n, (role, t) in enumerate(zip(["user", "assistant", "to\nol", None, "a\\b", "assistant", "x", "<|", "user"], texts))]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("_key", F.lit("clash"))
    found = chat.conversation_digests(chat.prefix_examples(frame)).first()
    whole = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in rows)
    loss = "".join(t or "" for _, _, r, t in rows if r == "assistant")
    assert (found["n_turns"], found["turns_sha256"]) == (9, hashlib.sha256(whole.encode()).hexdigest())
    assert (found["loss_chars"], found["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.prefix_examples(frame.limit(0)).count() == 0


# -- suffix tree --------------------------------------------------------------


def test_pairs_are_ordered_by_two_sorts():
    rng = np.random.default_rng(4)
    for n, width in ((0, 9), (1, 9), (5000, 40), (5000, 1 << 31)):
        shard, follow = rng.integers(0, 7, n), rng.integers(0, width, n)
        context = rng.integers(0, 50, n) << 40
        order, plain = suffix_tree._order(shard, context, follow), np.lexsort((follow, context, shard))
        assert all((x[order] == x[plain]).all() for x in (shard, context, follow))
    wide = rng.integers(0, 1 << 62, 3000)  # too many bits for one number
    assert (wide[suffix_tree._order(wide, wide, wide)] == np.sort(wide)).all()


def test_base_scores_and_gain(spark):
    rows = q.suffix_tree_scoring(spark, SF).collect()
    words = {d: t.encode().lower().split() + [b"\t"] for d, t in documents(spark).items()}
    out = lambda d: zlib.crc32(str(d).encode()) % 10 == 0
    seen = Counter(w for d, x in words.items() if not out(d) for w in x)
    n, v = sum(seen.values()), len(seen)
    assert {r["doc_id"] for r in rows} == set(words)
    for r in rows:
        x = words[r["doc_id"]]
        base = sum(math.log10((seen[w] + 0.1) / (n + 0.1 * (v + 1))) for w in x)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out(r["doc_id"]), len(x), sum(seen[w] > 0 for w in x), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and math.isfinite(r["score"])
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_states_sum_to_one(spark):
    """Every next token of a short history, scored as a text of its own."""
    learn = [(n, "a b c d " * 5) for n in range(40)] + [(100 + n, "b a a c") for n in range(30)]
    tries = [(1000 + n, f"a b {w}".strip()) for n, w in enumerate(["a", "b", "c", "d", "zzz"])]
    frame = spark.createDataFrame(learn + tries, "doc_id long, text string")
    rows = {r["doc_id"]: r for r in suffix_tree.score_texts(frame, F.col("doc_id") >= 1000).collect()}
    stem = suffix_tree.score_texts(frame.where("doc_id < 1000").unionByName(spark.createDataFrame([(1000, "a b")], "doc_id long, text string")), F.col("doc_id") >= 1000).where("doc_id = 1000").first()
    # P(a b w) over all w is at most P(a b) without its end.
    total = sum(10 ** rows[d]["score"] for d, _ in tries)
    assert 0 < total <= 1 and rows[1002]["score"] > rows[1000]["score"] and rows[1004]["score"] < rows[1002]["score"]
    assert stem["n_tokens"] == 3


def test_odd_texts_are_scored(spark, odd_documents, no_documents):
    rows = suffix_tree.score_texts(odd_documents, F.col("doc_id") == 6).collect()
    assert len(rows) == odd_documents.count() and {r["n_tokens"] for r in rows if r["doc_id"] in (4, 5)} == {1}
    assert suffix_tree.score_texts(no_documents, F.lit(False)).count() == 0


# -- fingerprints -------------------------------------------------------------


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def test_edited_fingerprints(spark):
    docs = sorted(documents(spark).items())
    rows = {r["doc_id"]: r for r in q.document_fingerprints(spark, SF).collect()}
    assert len(rows) == len(docs)
    for n, (d, t) in enumerate(docs):
        after = docs[(n + 1) % len(docs)]
        m = len(t) // 4
        edited = t[: len(t) - m] + after[1][:m]
        r = rows[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        exact = similarity(shingles(t), shingles(edited))
        assert abs(r["near_edited"] - exact) < 0.2 and r["jaccard_edited"] == pytest.approx(exact)
        assert abs(r["near_next"] - similarity(shingles(t), shingles(after[1]))) < 0.2
    texts = {}
    for d, t in docs:
        assert texts.setdefault(t, rows[d]["fingerprint"]) == rows[d]["fingerprint"]


def test_edited_fingerprints_of_odd_texts(spark, odd_documents, no_documents):
    assert fingerprint.edited_fingerprints(odd_documents).count() == odd_documents.count()
    assert fingerprint.edited_fingerprints(no_documents).count() == 0
    one = fingerprint.edited_fingerprints(spark.createDataFrame([(5, "a b c d e f g h")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0 and one["n_chars"] == 15


def test_query_links_more_than_the_first(spark, odd_documents, no_documents):
    """B and C are near copies; a smaller key shares bands with both but is near to B only."""
    w = [f"w{i}" for i in range(200)]
    a, b, c = w, w[:182] + [f"b{i}" for i in range(18)], w[:182] + [f"b{i}" for i in range(10)] + [f"c{i}" for i in range(8)]
    c = [f"c{i}" for i in range(14)] + c[14:]
    rows = [(n, " ".join(t)) for n, t in enumerate((a, b, c))]
    rows += [(None, " ".join(c)), (7, "many words here and there"), (7, ""), (8, None), (1, rows[1][1])]
    exact = {(x, y): similarity(shingles(rows[x][1]), shingles(rows[y][1])) for x, y in ((0, 1), (1, 2), (0, 2))}
    assert exact[0, 1] >= 0.8 and exact[1, 2] >= 0.8 > exact[0, 2]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = fingerprint.linked_fingerprints(frame).select("doc_id", "n_chars", "class_id", "n_links").collect()
    n = len(rows[2][1])
    assert sorted(map(tuple, out), key=repr) == sorted([(0, len(rows[0][1]), 0, 2), *[(1, len(rows[1][1]), 0, 4)] * 2, (2, n, 0, 3), (None, n, 0, 3), (7, 25, 7, 0), (7, 0, 7, 1), (8, 0, 7, 1)], key=repr)
    for docs in (odd_documents, spark.read.parquet(f"{SF}/documents.parquet")):
        ours = fingerprint.linked_fingerprints(docs).select("doc_id", "class_id", "n_links").collect()
        assert sorted(map(tuple, ours), key=repr) == sorted(map(tuple, jaccard_join.similar_classes(docs).collect()), key=repr)
    assert fingerprint.linked_fingerprints(no_documents).count() == 0
    assert {"class_id", "n_links"} <= set(q.document_fingerprints(spark, SF).columns)


# -- packing ------------------------------------------------------------------


def test_pieces_and_sequences(spark):
    from tokenizers import Tokenizer

    rows = q.best_fit_packing(spark, SF).toPandas()
    tokenizer = Tokenizer.from_file(q.tokenizer_file("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    texts = documents(spark)
    for d, group in rows.sort_values("piece").groupby("doc_id"):
        ids = np.array(tokenizer.encode(texts[d], add_special_tokens=False).ids + [0], "<u4")
        assert group["length"].sum() == len(ids) and list(group["start"]) == list(range(0, len(ids), 2048))
        assert [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(group["start"], group["length"])] == list(group["ids_crc32"])
    placed = rows.sort_values(["sequence_id", "offset"])
    sums = placed.groupby("sequence_id")["length"].sum()
    assert (placed.groupby("sequence_id")["length"].cumsum() - placed["length"] == placed["offset"]).all() and sums.max() <= 2048
    assert len(sums) <= math.ceil(rows["length"].sum() / 2048) * 1.03 + 2


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_bins_keep_every_capacity(rule):
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 100, 500)
    bins, offsets = packing.fit_bins(lengths, 100, 4, 6000, (1.0, 0.5, 0.5), rule)
    for b in np.unique(bins):
        mine = bins == b
        assert mine.sum() <= 4 and lengths[mine].sum() <= 100 and ((lengths[mine] ** 2).sum() <= 6000 or mine.sum() == 1)
        order = np.argsort(offsets[mine])
        assert (np.cumsum(lengths[mine][order]) - lengths[mine][order] == offsets[mine][order]).all()


def test_word_cache_agrees_with_the_tokenizer():
    from loamframe.llm.wordbpe import WordBpe

    bpe = WordBpe.load(q.tokenizer_file("word_bpe_49k.json"))
    rng = random.Random(5)
    letters = "abÀéßÿŒİΣσς'’,.!?<|>#1²½_ \t\n\r  ́日\U0001f600"
    for _ in range(400):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(30)))
        assert np.frombuffer(bpe.encode(text), "<u4").tolist() == bpe.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_odd_texts_are_packed(spark, odd_documents, no_documents):
    file = q.tokenizer_file("word_bpe_49k.json")
    rows = packing.best_fit(packing.token_pieces(odd_documents, file).withColumn("_row", F.lit("x"))).collect()
    assert sum(r["piece"] == 0 for r in rows) == odd_documents.count() and {r["length"] for r in rows if r["doc_id"] in (4, 5)} == {1}
    assert packing.best_fit(packing.token_pieces(no_documents, file)).count() == 0


# -- SentencePiece ------------------------------------------------------------


def best_score(text, pieces, unknown):
    best = [0.0] + [None] * len(text)
    for at in range(1, len(text) + 1):
        options = [best[at - n] + pieces[text[at - n : at]] for n in range(1, min(at, 16) + 1) if text[at - n : at] in pieces]
        if text[at - 1] not in pieces:
            options.append(best[at - 1] + unknown)
        best[at] = max(options)
    return best[-1]


def test_viterbi_is_best():
    rng = random.Random(2)
    for _ in range(30):
        words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(12)}
        pieces = {w: (n, -rng.random() * 5) for n, w in enumerate(sorted(words))}
        automaton = sentencepiece_codec.Automaton(pieces)
        by_number = {n: s for n, s in pieces.values()}
        for _ in range(20):
            text = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 14)))
            got = automaton.segment(text, -30.0)
            score = sum(by_number[n] if n >= 0 else -30.0 for n, _ in got)
            assert sum(size for _, size in got) == len(text)
            assert score == pytest.approx(best_score(text, {w: s for w, (_, s) in pieces.items()}, -30.0))


def test_codec_round_trip(spark, odd_documents, no_documents):
    import sentencepiece

    model = q.tokenizer_file("piece_bpe_32k.model")
    coded = sentencepiece_codec.encode_texts(odd_documents, model)
    back = sentencepiece_codec.decode_ids(coded, model).select("text", "decoded", "ids", "_text").collect()
    assert all((r["text"] or "") == r["decoded"] and r["_text"] == "t" for r in back)
    theirs = sentencepiece.SentencePieceProcessor(model_file=model)
    assert all(theirs.decode(r["ids"]) == r["decoded"] for r in back if r["ids"] and "▁" not in r["decoded"])
    assert sentencepiece_codec.encode_texts(no_documents, model).count() == 0
    rows = q.sentencepiece_round_trip(spark, SF)
    texts = documents(spark)
    found = {r["doc_id"]: r for r in rows.collect()}
    assert set(found) == set(texts) and all(r["exact"] and r["n_chars"] == len(texts[d]) for d, r in found.items())


# -- quality ------------------------------------------------------------------


def test_held_out_accuracy(spark):
    rows = q.quality_classifier(spark, "/root/testdata/sf0.1").where("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    both = rows.join(labels, "doc_id").collect()
    good = [r["predicted"] for r in both if r["quality"] == 1]
    bad = [r["predicted"] for r in both if r["quality"] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05 and all(0 <= r["score"] <= 1 for r in both)


def test_scores_of_odd_texts(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (6, None), (6, 0)], "doc_id long, quality int")
    model = quality.fit(odd_documents, labels, F.lit(True))
    rows = quality.score(odd_documents, model, name="p").collect()
    assert len(rows) == odd_documents.count() and all(0 <= r["p"] <= 1 and r["score"] == "s" for r in rows)
    assert len({r["p"] for r in rows if not r["text"]}) == 1
    assert quality.score(no_documents, model).count() == 0
    untrained = quality.fit(no_documents, labels.limit(0), F.lit(True))
    assert {r["p"] for r in quality.score(odd_documents, untrained, name="p").collect()} == {0.5}


# -- pages --------------------------------------------------------------------

PAGE = """<html><head><title>x</title></head><body><header id=top><h1>Site</h1></header><div class="wrap">
<div class="left sidebar"><p>Some long sidebar text, with commas, here it is really long.</p></div>
<div class="content"><h2>Title here</h2><p>First &lt;b&gt; with, some commas, and a length that is long enough.<p>Second &amp; one,
 also long   enough to count, it is.<ul><li>One</li><li>Two</ul><div class="ad-box">Buy now, it is cheap, really cheap, very much.</div>
<form>Name <input></form></div><div id="comments"><p>Reader says something, rather long, with many words indeed.</p></div></div>
<footer>foot</footer><script>var a='</div>';</script></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE) == (
        "Title here\n\nFirst <b> with, some commas, and a length that is long enough.\n\nSecond & one, also long enough to count, it is.\n\nOne\n\nTwo"
    )
    assert html_text.main_text("") == "" and html_text.main_text("a &amp;amp; b") == "a &amp; b"
    assert html_text.main_text("<nav><a href=x>menu</a></nav><script>x") == ""
    assert html_text.main_text("<p>one<p>two</p>") == "one\n\ntwo"


BODY = "<p>First, with some commas, and a length that is long enough.</p><p>Second one, also long enough to count, it is.</p>"
SAID = "First, with some commas, and a length that is long enough.\n\nSecond one, also long enough to count, it is."


@pytest.mark.parametrize("name", ["content has-sidebar", "layout no-sidebar", "job-search-results", "with-comments", "notice", "wrap--has-header"])
def test_wrappers_with_such_names_stay(name):
    assert html_text.main_text(f'<div class="{name}">{BODY}</div><footer>foot</footer>') == SAID
    side = '<div class="sidebar"><p>Some side text, long enough to count as one.</p></div>'
    assert html_text.main_text(f'<div id="{name}">{side}<div class="c">{BODY}</div></div>') == SAID


def test_own_header_and_inline_names_stay():
    page = f'<div class="entry-header"><h1>Title</h1></div><div class="text">{BODY}</div><div class="comments"><p>One reader says this, rather long.</p></div>'
    assert html_text.main_text(page) == html_text.main_text(f"<article>{page}</article>") == f"Title\n\n{SAID}"
    code = '<p>Code is <span class="c comment">not, as some think, a comment</span> here, in this block.</p>'
    assert html_text.main_text(f"<div>{BODY}{code}</div>") == f"{SAID}\n\nCode is not, as some think, a comment here, in this block."
    assert html_text.main_text('<div class="search">a b</div>') == "a b"
    assert html_text.main_text(f'<div>{BODY}<p>x <span hidden>secret</span> y</p></div>') == f"{SAID}\n\nx\n\ny"


def test_pages(spark):
    import html
    import re

    rows = {r["page_id"]: r for r in q.html_extraction(spark, SF).collect()}
    for page in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", page["html"], re.S)[1]
        blocks = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", " ", b))).strip() for b in re.split("</?(?:p|h1)>", inner))
        assert rows[page["page_id"]]["text"] == "\n\n".join(b for b in blocks if b)
    odd = spark.createDataFrame([(None, None, None, "t"), (1, "u", "<p>x" * 20_000, "t"), (1, "u", "", "t")], "page_id long, url string, html string, text string")
    assert [len(r["text"]) for r in html_text.extract_text(odd).collect()] == [0, 20_000 * 3 - 2, 0]
    assert html_text.extract_text(odd.limit(0)).count() == 0


def test_pair_counts_over_several_batches(monkeypatch):
    """What the shards tell several batches, against counting the pairs at once."""
    import pandas as pd
    import pyarrow as pa

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 3)

    monkeypatch.setattr("pyspark.TaskContext", Task)
    monkeypatch.setattr(suffix_tree, "BATCH_CHARS", 4000)
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefgh") + rng.choice(["", "x"]) for _ in range(rng.randint(0, 90))) for _ in range(300)]
    held = [n % 7 == 0 for n in range(300)]
    columns = [pa.array(range(300)), pa.array([t.encode() for t in texts]), pa.array(held)]
    shards = 3
    stored = pa.Table.from_batches(list(suffix_tree._batches(iter([pa.RecordBatch.from_arrays(columns, names=list("abc"))]), shards))).to_pandas()
    words = stored[stored["shard"] >= 0]
    told = pd.concat([suffix_tree._count_words(shards)(g) for _, g in words.groupby("shard")], ignore_index=True)
    batches = stored[stored["shard"] < 0]
    assert len(batches) > 5
    seen = Counter(w for t, h in zip(texts, held) if not h for w in [*t.split(), "\t"])
    tokens, distinct = sum(seen.values()), len(seen)
    made = lambda r: suffix_tree._Batch(r, told[told["batch"] == r.batch], shards, tokens, distinct, {2: {}})
    asked = pd.DataFrame([(r.batch, *k) for r in batches.itertuples() for k in made(r).ask()], columns=suffix_tree.KEYS)
    answers = pd.concat([suffix_tree._test_contexts(2, tokens, shards)(g) for _, g in asked.groupby("shard")], ignore_index=True)
    pairs = Counter()
    for text, out in zip(texts, held):
        if not out:
            run = ["^", *text.split(), "\t"]
            pairs.update(zip(run, run[1:]))
    told = pd.concat([told, answers], ignore_index=True)
    checked = 0
    for r in batches.itertuples():
        b = made(r)
        at = 0
        for text in (texts[n] for n in b.ids):
            run = ["^", *text.split(), "\t"]
            for n, pair in enumerate(zip(run, run[1:])):
                if n + 1 < len(run) - 1:  # the next context's count is this pair's
                    assert b.context_times[at + n + 1] == pairs[pair]
                    checked += 1
            at += len(run) - 1
    assert checked > 5000
