"""Queries of the training-data operators over the given tables, with their check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamframe.llm import chat, fingerprint, hard_negatives, html_text, jaccard_join, line_dedup, manifest, packing, quality, sentencepiece_codec, suffix_tree, token_files, topk
from loamframe.llm.common import table, whole_text
from loamframe.session import scratch_path

QUERIES: dict = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            CHECKS[name] = sql
        return run

    return add


CHAT_SQL = r"""
WITH talk AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
spoken AS (
    SELECT *, length(replace(replace(replace(role, '\', '\s'), '<|', '<\|'), chr(10), '\n'))
        + length(replace(replace(text, '\', '\s'), '<|', '<\|')) + 24 AS size,
        row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS turns
    FROM talk WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
sums AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY place) AS upto FROM spoken)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(upto) FILTER (role = 'assistant' OR place = turns)::BIGINT AS formatted_chars
FROM sums GROUP BY conv_id
"""


@query("op4_chat_formatting", CHAT_SQL)
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").cast("int").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(marks).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.conversation_digests(chat.prefix_examples(rows))


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file on this machine and on the workers."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op7_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return packing.best_fit(pieces)


TOP_SQL = """
WITH v AS (
    SELECT vec_id, min([floor(1024 * x::DOUBLE) FOR x IN embedding]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    GROUP BY vec_id),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op10_exact_top_k", TOP_SQL)
def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_products(vectors, F.col("vec_id") % 100 == 0)


@query("op2_suffix_tree_scoring")
def suffix_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    return suffix_tree.score_texts(table(spark, sf_dir, "documents"), held_out)


@query("op9_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract_text(table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


QUALITY_KEPT = 0.3


def quality_model(spark: SparkSession, sf_dir: str):
    """The classifier, learned from the labelled rows that aren't held out."""
    learn_from = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    return quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn_from)


@query("op8_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    scored = quality.score(docs, quality_model(spark, sf_dir))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= QUALITY_KEPT).cast("int").alias("predicted"))


LINES_SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
m AS (SELECT *, string_split(regexp_replace(text, '([.!?][\x09-\x0D ]+|\n[\x09-\x0D ]*)', '\1' || chr(57344), 'g'), chr(57344)) AS parts FROM d),
l AS (SELECT doc_id, text, generate_subscripts(parts, 1) AS unit, unnest(parts) AS said FROM m),
u AS (
    SELECT *, trim(regexp_replace(lower(said), '[\x09-\x0D ]+', ' ', 'g')) AS plain,
        sum(length(said)) OVER (PARTITION BY doc_id, text ORDER BY unit) - length(said) AS start
    FROM l),
r AS (SELECT *, row_number() OVER (PARTITION BY plain ORDER BY doc_id NULLS FIRST, unit) > 1 AS again FROM u WHERE plain <> ''),
g AS (SELECT *, unit - row_number() OVER (PARTITION BY doc_id, text, again ORDER BY unit) AS run FROM r),
x AS (SELECT *, again AND sum(len(string_split(plain, ' '))) OVER (PARTITION BY doc_id, text, again, run) >= 30 AS gone FROM g)
SELECT u.doc_id, coalesce(string_agg(u.said, '' ORDER BY u.unit) FILTER (gone IS NOT TRUE), '') AS text,
    count(*) FILTER (gone) AS n_removed, coalesce(sum(length(u.said)) FILTER (gone), 0)::BIGINT AS removed_chars,
    coalesce(string_agg(u.start || ':' || length(u.said), ',' ORDER BY u.unit) FILTER (gone), '') AS removed_spans
FROM u LEFT JOIN x ON x.doc_id IS NOT DISTINCT FROM u.doc_id AND x.text = u.text AND x.unit = u.unit
GROUP BY u.doc_id, u.text
"""


@query("op1_substring_dedup", LINES_SQL)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", whole_text().alias("text")))
    spans = F.array_join(F.transform("removed", lambda r: F.concat_ws(":", r["start"], r["length"])), ",")
    return docs.select(
        "doc_id",
        "text",
        F.size("removed").cast("long").alias("n_removed"),
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["length"]).alias("removed_chars"),
        spans.alias("removed_spans"),
    )


JOIN_SQL = """
WITH RECURSIVE d AS (
    SELECT doc_id, [x FOR x IN regexp_split_to_array(lower(coalesce(text, '')), '[\\x09-\\x0D ]+') IF x <> ''] AS w FROM documents),
k AS (SELECT min(doc_id) AS rep, count(*) AS copies, w FROM d GROUP BY w),
s AS (
    SELECT DISTINCT rep, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 4], ' ') END AS g
    FROM (SELECT rep, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM k WHERE len(w) > 0)),
z AS (SELECT rep, count(*) AS n FROM s GROUP BY rep),
c AS (SELECT a.rep AS a, b.rep AS b, count(*) AS n FROM s AS a JOIN s AS b USING (g) WHERE a.rep <> b.rep GROUP BY a.rep, b.rep),
l AS (
    SELECT c.a, c.b FROM c JOIN z AS x ON x.rep = c.a JOIN z AS y ON y.rep = c.b WHERE c.n >= 0.8 * (x.n + y.n - c.n) - 1e-6),
r AS (SELECT rep AS a, rep AS b FROM k UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
m AS (SELECT a AS rep, min(b) AS class_id FROM r GROUP BY a),
n AS (SELECT l.a AS rep, sum(k.copies) AS n FROM l JOIN k ON k.rep = l.b GROUP BY l.a)
SELECT d.doc_id, m.class_id, (coalesce(n.n, 0) + k.copies - 1)::BIGINT AS n_links
FROM d JOIN k USING (w) JOIN m USING (rep) LEFT JOIN n USING (rep)
"""


@query("op6_ngram_jaccard_join", JOIN_SQL)
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_classes(table(spark, sf_dir, "documents"))


@query("op5_sentencepiece_codec")
def sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_file("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = sentencepiece_codec.decode_ids(sentencepiece_codec.encode_texts(docs, model), model, checksum="ids_crc32")
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        "ids_crc32",
        F.length("decoded").cast("long").alias("n_chars"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("exact"),
    )


@query("op3_document_fingerprints")
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.linked_fingerprints(table(spark, sf_dir, "documents"))


_FOLD_SQL = "sha256(CASE WHEN {at} % 2 = 1 THEN s.hash ELSE '' END || {own} || CASE WHEN {at} % 2 = 0 THEN coalesce(s.hash, '') ELSE '' END)"


def _climb_sql(name: str, start: str, tree: str, levels: str) -> str:
    """A leaf's way up its tree, one level at a time."""
    return f"""{name} AS (
    {start}
    UNION ALL SELECT c.id, c.tree, c.pos // 2, c.level + 1, {_FOLD_SQL.format(at='c.pos', own='c.folded')}, c.proof || coalesce(s.hash, '')
    FROM {name} AS c JOIN {levels} AS o ON o.{tree} IS NOT DISTINCT FROM c.tree AND o.level = c.level AND o.pos = c.pos AND o.n > 1
    LEFT JOIN {levels} AS s ON s.{tree} IS NOT DISTINCT FROM c.tree AND s.level = c.level AND s.pos = xor(c.pos, 1))"""


def _levels_sql(name: str, start: str, tree: str) -> str:
    return f"""{name} AS (
    {start}
    UNION ALL SELECT {tree}, level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (any_value(n) + 1) // 2 FROM {name} WHERE n > 1 GROUP BY {tree}, level, pos // 2)"""


_FIELD_SQL = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF_SQL = "sha256(" + " || ".join(_FIELD_SQL.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"
MANIFEST_SQL = f"""
WITH RECURSIVE crcs AS (SELECT range::BIGINT AS b, range::BIGINT AS c, 0 AS k FROM range(256)
    UNION ALL SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crcs WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM crcs WHERE k = 8),
d AS (
    SELECT row_number() OVER () AS id, doc_id, lang, {_LEAF_SQL.format(n='n_chars')} AS leaf, {_LEAF_SQL.format(n='(n_chars + 1)')} AS changed,
        coalesce(xor(list_reduce(list_prepend(4294967295, [ascii(x) FOR x IN string_split(doc_id::VARCHAR, '')]),
            lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 7 = 0, false) AS tampered
    FROM documents, crc),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d),
{_levels_sql('low', 'SELECT lang, 0 AS level, pos, leaf AS hash, n FROM placed', 'lang')},
subroots AS (SELECT lang, hash, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
{_levels_sql('high', 'SELECT 0 AS top, 0 AS level, pos, hash, n FROM subroots', 'top')},
{_climb_sql('way', "SELECT id, lang AS tree, pos, 0 AS level, CASE WHEN tampered THEN changed ELSE leaf END AS folded, '' AS proof FROM placed", 'lang', 'low')},
arrived AS (SELECT id, tree, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof FROM way GROUP BY id, tree),
{_climb_sql('rest', "SELECT a.id, 0 AS tree, s.pos, 0 AS level, a.folded, a.proof FROM arrived AS a JOIN subroots AS s ON s.lang IS NOT DISTINCT FROM a.tree", 'top', 'high')},
ended AS (SELECT id, arg_max(folded, level) AS folded, arg_max(proof, level) AS proof FROM rest GROUP BY id),
top AS (SELECT hash AS root FROM high WHERE n = 1)
SELECT p.doc_id, p.leaf, s.hash AS subroot, root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root, e.folded = root AS verified
FROM placed AS p JOIN ended AS e USING (id) JOIN subroots AS s ON s.lang IS NOT DISTINCT FROM p.lang, top
"""


@query("op13_merkle_manifest", MANIFEST_SQL)
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.document_manifest(table(spark, sf_dir, "documents"))


@query("op12_token_files")
def token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), 2, path)
    return token_files.read_token_files(spark, path, checksum=True).withColumnsRenamed({"key": "doc_id", "ids": "ids_crc32"})


NEGATIVES_SQL = """
WITH v AS (
    SELECT vec_id, min({label: CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END, v: [floor(256 * x::DOUBLE) FOR x IN embedding]}) AS s FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    GROUP BY vec_id),
p AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.s.label = b.s.label AS same, list_inner_product(a.s.v, b.s.v)::BIGINT AS score
    FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
best AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
r AS (
    SELECT b.*, p.vec_id AS negative_id, p.score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY p.score DESC, p.vec_id)::INTEGER AS rank
    FROM best AS b JOIN p USING (anchor_id)
    WHERE NOT p.same AND 80 * positive_score <= 100 * p.score AND p.score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 5
"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = hard_negatives.labelled_vectors(table(spark, sf_dir, "embeddings"), label)
    return hard_negatives.mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0)
