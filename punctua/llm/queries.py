"""The numbered operators over the test tables, with their SQL twins where SQL can tell."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from punctua.llm import hnsw, infill, licences, linechunks, minhash, packing, pieces, quality, repair, topk, toxicity, twins, urls, warc
from punctua.llm.common import Workspace


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def labelled_urls(spark: SparkSession, folder: str) -> DataFrame:
    """A page's url names its document; a document of quality 0 makes the url bad."""
    number = F.regexp_extract("url", r"/(\d{1,18})(?:[/?#.]|$)", 1)
    pages = _table(spark, folder, "pages").select("url", number.alias("d")).select("url", F.expr("try_cast(d as bigint)").alias("doc_id"))
    labels = _table(spark, folder, "labels").where("quality in (0, 1)").select("doc_id", (1 - F.col("quality")).alias("bad"))
    return pages.join(labels, "doc_id").select("url", "bad")


def op1_url_filter(spark, folder):
    model = urls.fit_urls(labelled_urls(spark, folder), Workspace(spark, "op1"))
    return urls.judge_urls(_table(spark, folder, "pages"), model)


def op2_minhash_groups(spark, folder):
    return minhash.near_duplicates(_table(spark, folder, "documents"), Workspace(spark, "op2"), width=2)


def op3_embedding_groups(spark, folder):
    return hnsw.embedding_groups(_table(spark, folder, "embeddings"), Workspace(spark, "op3"))


def op4_line_chunks(spark, folder):
    out = linechunks.dedup_lines(_table(spark, folder, "documents"), Workspace(spark, "op4"))
    return out.select("doc_id", "n_chunks", "removed", F.length("text").alias("kept_chars"), F.md5("text").alias("kept_md5"))


def op5_sentencepiece(spark, folder):
    return pieces.digests(_table(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"))


def op6_warc(spark, folder):
    index = warc.write_bundles(_table(spark, folder, "pages"), Workspace(spark, "op6"))
    return warc.read_bundles(index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def held_out(doc_id) -> F.Column:
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def op7_toxicity(spark, folder):
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.fit_toxicity(docs, labels.where(~held_out("doc_id")), Workspace(spark, "op7"))
    return toxicity.toxicity(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op8_packing(spark, folder):
    return packing.pack(_table(spark, folder, "documents"), Workspace(spark, "op8"), tokenizer("word_bpe_49k.json"))


def op9_top_k(spark, folder):
    rows = _table(spark, folder, "embeddings")
    return topk.top_k(rows, rows.where("vec_id % 50 = 0"), 5)


def op10_licences(spark, folder):
    held = licences.usual_templates()
    lines = frozenset(n for n in held if "-line" in n)  # a version or a letter may be all that parts two short forms
    families = {n: "gnu" for n in held if n.startswith(("gpl-2", "gpl-3", "lgpl", "agpl")) and n not in lines}
    return licences.licences(_table(spark, folder, "documents"), held, families=families, whole=lines)


def op11_infill(spark, folder):
    out = infill.restored(infill.fill_in_middle(_table(spark, folder, "documents")))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2(F.col("infill").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


def op12_quality_rules(spark, folder):
    work = Workspace(spark, "op12")
    rows = work.store(quality.measured(_table(spark, folder, "documents").select("doc_id", "text")).drop("text"), "measured")
    out = quality.judged(rows, quality.fit_rules(rows))
    return out.select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op13_conversations(spark, folder):
    rows = repair.damaged(_table(spark, folder, "conversations"))
    return repair.repaired(rows, Workspace(spark, "op13"), every=_table(spark, folder, "conversations").select("conv_id"))


def pipeline(spark, folder):
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_minhash_groups, op3_embedding_groups, op4_line_chunks, op5_sentencepiece, op6_warc, op7_toxicity,
    op8_packing, op9_top_k, op10_licences, op11_infill, op12_quality_rules, op13_conversations, pipeline)}

# Reachability over links(a, b), smaller ends on both sides of every edge.
_CLOSURE = """
, both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, other) AS (SELECT a, b FROM both_ways UNION SELECT r.id, e.b FROM reach r JOIN both_ways e ON r.other = e.a),
least AS (SELECT id, min(other) AS m FROM reach GROUP BY id)
"""

ORACLE = {
    "op2_minhash_groups": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
classes AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM sets) WHERE len(s) > 0 GROUP BY s),
tokens AS (SELECT rep, n, unnest(s) AS t FROM classes),
freq AS (SELECT t, count(*) AS df FROM tokens GROUP BY t),
ranked AS (SELECT k.rep, k.n, k.t, row_number() OVER (PARTITION BY k.rep ORDER BY f.df, k.t) AS place FROM tokens k JOIN freq f USING (t)),
prefix AS (SELECT rep, n, t FROM ranked WHERE place <= n - ((4 * n + 4) // 5) + 1),
pairs AS (SELECT DISTINCT p.rep AS a, q.rep AS b FROM prefix p JOIN prefix q ON p.t = q.t AND p.rep < q.rep
  WHERE 5 * least(p.n, q.n) >= 4 * greatest(p.n, q.n)),
links AS (
  SELECT a, b FROM (SELECT p.a, p.b, len(list_intersect(x.s, y.s)) AS both_, x.n AS n1, y.n AS n2
    FROM pairs p JOIN classes x ON x.rep = p.a JOIN classes y ON y.rep = p.b)
  WHERE 100 * both_ >= 80 * (n1 + n2 - both_))
""" + _CLOSURE + """
SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(least(l.m, c.rep), c.rep, s.doc_id) AS component_id,
  coalesce(least(l.m, c.rep), c.rep, s.doc_id) = s.doc_id AS kept
FROM (SELECT doc_id, list_sort(s) AS s FROM sets) s LEFT JOIN classes c ON c.s = s.s LEFT JOIN least l ON l.id = c.rep
""",
    "op3_embedding_groups": """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id < q.vec_id AND list_cosine_similarity(p.e, q.e) >= 0.95)
""" + _CLOSURE + """
, n AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(least(l.m, vec_id), vec_id) AS component_id,
  coalesce(least(l.m, vec_id), vec_id) = vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN least l ON l.id = e.vec_id
""",
    "op4_line_chunks": """
WITH lines AS (
  SELECT doc_id, i, l, ('0x' || left(md5(l), 8))::BIGINT AS h, len(list_filter(string_split(l, ' '), lambda x: x <> '')) AS w
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
ended AS (
  SELECT *, lead(l) OVER (PARTITION BY doc_id ORDER BY i) IS NULL
    OR (h + 31 * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0)) % 4 = 0
    OR w >= 50 OR coalesce(lead(w) OVER (PARTITION BY doc_id ORDER BY i), 0) >= 50 AS e FROM lines),
placed AS (
  SELECT *, coalesce(sum(e::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM ended),
chunks AS (
  SELECT doc_id, k, string_agg(l, chr(10) ORDER BY i) AS t, count(*) AS n, sum(w) AS w FROM placed GROUP BY doc_id, k),
counted AS (
  SELECT *, (w >= 50 OR (n >= 2 AND w >= 20)) AND row_number() OVER (PARTITION BY t ORDER BY doc_id, k) > 1 AS gone FROM chunks),
kept AS (
  SELECT doc_id, count(*) AS n_chunks, sum(gone::INT) AS removed, coalesce(string_agg(t, chr(10) ORDER BY k) FILTER (NOT gone), '') AS t
  FROM counted GROUP BY doc_id)
SELECT k.doc_id, n_chunks, removed::INT AS removed, CASE WHEN d.text IS NOT NULL THEN length(t) END AS kept_chars,
  CASE WHEN d.text IS NOT NULL THEN md5(t) END AS kept_md5 FROM kept k JOIN documents d USING (doc_id)
""",
    "op6_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS d FROM pages),
bits AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
  substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (strpos('0123456789abcdef', substr(d, i, 1)) - 1)::INT + 1, 4)), '') AS b FROM p),
digest AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + 16 * substr(b, 5 * i + 1, 1)::INT + 8 * substr(b, 5 * i + 2, 1)::INT + 4 * substr(b, 5 * i + 3, 1)::INT + 2 * substr(b, 5 * i + 4, 1)::INT
  + substr(b, 5 * i + 5, 1)::INT, 1)), '') AS s, max(page_id) OVER (PARTITION BY d) AS top FROM bits)
SELECT page_id, strlen(html) AS payload_bytes, s AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to FROM digest
""",
    "op9_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
""",
    "op11_infill": twins.INFILL,
    "op12_quality_rules": twins.QUALITY,
    "op13_conversations": twins.REPAIR,
}
