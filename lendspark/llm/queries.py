"""The queries of this subpackage: one ``opN_<name>`` per operator, with DuckDB SQL where SQL can express it."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm.centroid_clustering import cluster_vectors
from lendspark.llm.chat_format import format_chats, loss_text, read_turns
from lendspark.llm.common import read
from lendspark.llm.conversation_trie import own_turns, prefix_trie, with_heads
from lendspark.llm.decontamination import benchmark_matches, with_verdict
from lendspark.llm.html_extract import extract_main_text
from lendspark.llm.language_model import score_documents
from lendspark.llm.line_dedup import EVERY_LINE, dedup_lines
from lendspark.llm.mixing import mix_sources
from lendspark.llm.ngram_join import jaccard_classes
from lendspark.llm.passage_dedup import dedup_passages
from lendspark.llm.quality_rules import quality_rules
from lendspark.llm.token_counts import count_tokens
from lendspark.llm.toxicity import fit, score_toxicity

#: Folder of the public vocabulary files; never copied.
TOKENIZERS = "/opt/tokenizers"

QUERIES: dict = {}
ORACLE: dict = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


#: A conversation that holds the template's own control strings.
PROBE = "\\### Assistant: </turn> ok"


@_query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one of control strings, formatted and read back from the output."""
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(probe)
    chats = format_chats(turns).withColumn("read", read_turns(F.col("formatted"))).withColumn(
        "loss", loss_text(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "n_blocks")


@_query
def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model learnt from those whose id's crc32 does not leave 2 by 7."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return score_documents(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


@_query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents under the public 32k-piece vocabulary."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return count_tokens(docs, f"{TOKENIZERS}/piece_bpe_32k.model", keep=["doc_id"]).select(
        "doc_id", "n_pretokens", "n_tokens", F.round("forward_score", 4).alias("forward_score"))


@_query
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copy classes of all documents."""
    return jaccard_classes(read(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "n_shingles", "component_id")


@_query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that an earlier line resembles."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return dedup_lines(docs, EVERY_LINE).select("doc_id", "n_lines", "n_removed", "text")


@_query
def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to target weights."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


@_query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from the labels whose id's crc32 leaves a remainder by 5."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = fit(docs.where(~held_out), read(spark, sf_dir, "labels", "doc_id", "toxic").where(~held_out))
    return score_toxicity(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted", "n_words", "best", "p_value",
        F.size("passages").cast("long").alias("n_passages"))


@_query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found = with_verdict(benchmark_matches(docs, read(spark, sf_dir, "benchmark", "item_id", "text"), keep=["doc_id"], slop=2))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated",
        F.size("near_items").cast("long").alias("n_near_items"))


@_query
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    texts = extract_main_text(read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


@_query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over all documents."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"))


@_query
def op11_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 20-word windows that start earlier."""
    return dedup_passages(read(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"), F.size("removed").cast("long").alias("n_spans"))


@_query
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors in 40 clusters after five rounds."""
    return cluster_vectors(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))[0]


@_query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of all conversations, each rebuilt with the head of the first conversation of its five."""
    own = own_turns(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    rebuilt = with_heads(own, F.col("conv_id") - F.col("conv_id") % 5, F.crc32(F.col("conv_id").cast("string")) % 9)
    return prefix_trie(rebuilt)


ORACLE["op1_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), o AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w IS DISTINCT FROM role AS opens FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), m AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '[\\#<]')) + length('</turn>') AS body,
    length('### ' || role || ': ') + len(regexp_extract_all(role, '[\\#<:]')) + 1 AS head FROM o
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(body + CASE WHEN opens THEN head ELSE 0 END)::BIGINT AS formatted_chars,
  count(*) FILTER (opens) AS n_blocks
FROM m GROUP BY conv_id
"""

ORACLE["op4_ngram_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 80 * (x.n + y.n - m)
), r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, e.b FROM r JOIN e ON e.a = r.y
), c AS (SELECT x, min(y) AS y FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.y, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.x = d.doc_id
"""

_SQUARES = "list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
ORACLE["op12_centroid_clustering"] = r"""
WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS i, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v FROM v QUALIFY c < 40
)""" + "".join(f""", a{k} AS MATERIALIZED (
  SELECT a.i, a.vec_id, a.v, min({_SQUARES}::HUGEINT * 64 + b.c) AS m FROM v a CROSS JOIN c{k} b GROUP BY ALL
)""" + (f""", s{k} AS (
  SELECT m % 64 AS c, j, sum(x)::HUGEINT AS s, count(*) AS n FROM (SELECT m, unnest(v) AS x, unnest(range(64)) AS j FROM a{k}) GROUP BY ALL
), m{k} AS (
  SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS v FROM s{k} GROUP BY c
), c{k + 1} AS MATERIALIZED (SELECT c, coalesce(m{k}.v, c{k}.v) AS v FROM c{k} LEFT JOIN m{k} USING (c)
)""" if k < 5 else "") for k in range(6)) + r"""
SELECT a5.vec_id, (m % 64)::INTEGER AS cluster, (m // 64)::BIGINT AS distance, (sum(m // 64) OVER (PARTITION BY m % 64))::BIGINT AS cluster_inertia,
  (sum(m // 64) OVER ())::BIGINT AS inertia, sha256(array_to_string(c5.v, ',')) AS centroid_sha256
FROM a5 JOIN c5 ON c5.c = m % 64
"""

ORACLE["op13_conversation_trie"] = r"""
WITH t AS (
  SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1
), k AS (
  SELECT c, ts, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, length(c::VARCHAR) + 1),
    lambda i: ascii((c::VARCHAR)[i])::UBIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), [1::UBIGINT, 2, 3, 4, 5, 6, 7, 8]),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END))) % 9 AS h FROM t
), p AS (
  SELECT k.c, list_concat(coalesce(b.ts[1:k.h::BIGINT], []), k.ts[k.h::BIGINT + 1:]) AS ts FROM k LEFT JOIN t b ON b.c = k.c - k.c % 5
), s AS (SELECT c, ts, unnest(range(len(ts) + 1)) AS d FROM p
), n AS (
  SELECT ts[1:d] AS node, d, min(c) AS c, count(*) AS n, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(ts) = d), '')) AS ends,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * strlen(any_value(ts[d]).t) END AS own FROM s GROUP BY 1, 2
), m AS (SELECT n.*, n.d > 0 AS inner_node, (SELECT count(*) FROM n x WHERE x.d = n.d + 1 AND x.node[1:n.d] = n.node) AS children FROM n
), u AS (SELECT node[1:a] AS node, a AS d, own, children FROM (SELECT *, unnest(range(d + 1)) AS a FROM m)
), w AS (SELECT node, d, sum(own) AS saved, count(*) FILTER (children = 0) AS leaves FROM u GROUP BY 1, 2)
SELECT m.c AS conv_id, m.d AS depth, b.c AS parent_conv_id, m.n AS n_convs, m.children AS n_children, w.leaves AS n_leaves,
  w.saved::BIGINT AS saved_tokens, m.ends AS ends_sha256
FROM m JOIN w ON w.d = m.d AND w.node = m.node LEFT JOIN m b ON m.d > 0 AND b.d = m.d - 1 AND b.node = m.node[1:m.d - 1]
"""
