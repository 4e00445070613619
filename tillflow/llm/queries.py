"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from tillflow.llm import langid, licenses, merkle, minhash, packing, periods, pieces, pii, quality, rules, suffixes, vectors, warc

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_best_fit_packing")
def op1_best_fit_packing(spark, sf_dir):
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op2_language_id")
def op2_language_id(spark, sf_dir):
    """The language of every document, learned from the labelled documents that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    got = langid.identify(docs, docs.filter(langid.fold() != 0))
    return got.select("doc_id", (langid.fold() == 0).alias("held_out"), "lang_pred", "score")


@query("op3_pii")
def op3_pii(spark, sf_dir):
    """Personal data of every document: base spans, and terms that reveal them."""
    found = pii.find(_table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in pii.KINDS])
    part = lambda kind, a, b: F.concat_ws(":", kind, a.cast("string"), b.cast("string"))
    base = F.transform(F.arrays_zip("kinds", "starts", "ends"), lambda x: part(F.get(names, x["kinds"]), x["starts"], x["ends"]))
    terms = F.transform("terms", lambda x: part(F.lit("term"), x["start"], x["end"]))
    count = lambda k: F.size(F.filter("kinds", lambda x: x == k)).cast("long").alias(f"n_{pii.KINDS[k]}")
    return found.select("doc_id", *[count(k) for k in range(4)], F.sha2(F.concat_ws(",", base), 256).alias("base_sha256"),
                        F.concat_ws(",", F.concat(base, terms)).alias("spans"))


@query("op4_license_scan")
def op4_license_scan(spark, sf_dir):
    """License notices of every document by patience alignment."""
    return licenses.scan_documents(_table(spark, sf_dir, "documents"))


OP5_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (SELECT hex, payload_bytes, max(page_id) AS newest FROM p GROUP BY ALL)
SELECT page_id, p.payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS BIGINT), 5))::BIGINT >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31)::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < newest THEN newest END AS refers_to
FROM p JOIN g USING (hex, payload_bytes)
"""


@query("op5_warc", OP5_SQL)
def op5_warc(spark, sf_dir):
    """A WARC record per page in seekable bundles, read back."""
    bundles = warc.write_bundles(_table(spark, sf_dir, "pages"))
    return warc.read_bundles(bundles).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_quality_classifier")
def op6_quality_classifier(spark, sf_dir):
    """Quality score of every document, learned from the labels that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"), quality.not_held_out())
    return quality.score_documents(docs.select("doc_id", "text"), model).select(
        "doc_id", (~quality.not_held_out()).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= model.cut_score).cast("int").alias("predicted"))


@query("op7_sentencepiece")
def op7_sentencepiece(spark, sf_dir):
    """Every document encoded with offsets and decoded again."""
    return pieces.digest_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
u AS (SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE a.norm > 0 AND b.norm > 0 AND isfinite(a.norm) AND isfinite(b.norm)
        AND list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON l.a = r.b),
comp AS (SELECT a, least(a, min(b)) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, vec_id)::BIGINT AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN comp ON comp.a = vec_id
"""


@query("op8_embedding_near_dedup", OP8_SQL)
def op8_embedding_near_dedup(spark, sf_dir):
    """Near-duplicate classes of all embeddings: cosine of 0.98 or more within a label."""
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


@query("op9_quality_rules")
def op9_quality_rules(spark, sf_dir):
    """Base measures and the line-frequency verdict of every document."""
    return rules.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
           ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS sh
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM i JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e2.b FROM reach r JOIN both_ways e2 ON e2.a = r.b),
comp AS (SELECT a AS doc_id, least(min(b), a) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, d.doc_id)::BIGINT AS component_id,
       coalesce(c.component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN comp c ON c.doc_id = d.doc_id
"""


@query("op10_minhash", OP10_SQL)
def op10_minhash(spark, sf_dir):
    """Near-duplicate classes of all documents: 4-word shingles, Jaccard of 0.8 or more."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


# unsigned CRC-32 of a number's decimal text
CRC32_SQL = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda s: ord(s)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))))"""

_LEAF_SQL = "sha256(" + " || ".join(
    f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"
_LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RUN_SQL = "list_transform(range(0, len(hs), 8), lambda i: sha256(array_to_string(hs[i + 1:i + 8], '')))"

OP11_SQL = f"""
WITH RECURSIVE d AS (SELECT *, {_LEAF_SQL.format("text")} AS leaf,
    CASE WHEN {CRC32_SQL.format("doc_id")} % 3 = 0 THEN {_LEAF_SQL.format(_LOWER_SQL)} END AS changed FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
             dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM d),
t AS (SELECT tree, 0 AS level, list(leaf ORDER BY pos) AS hs FROM l GROUP BY tree
      UNION ALL SELECT tree, level + 1, {_RUN_SQL} FROM t WHERE len(hs) > 1),
s AS (SELECT tree, hs[1] AS subroot FROM t WHERE len(hs) = 1),
u AS (SELECT 0 AS level, list(subroot ORDER BY tree) AS hs FROM s
      UNION ALL SELECT level + 1, {_RUN_SQL} FROM u WHERE len(hs) > 1),
up AS (SELECT tree, pos, 0 AS level, pos AS k, coalesce(changed, leaf) AS digest, '' AS sib FROM l
       UNION ALL
       SELECT up.tree, up.pos, up.level + 1, k // 8,
              sha256(array_to_string(hs[k // 8 * 8 + 1:k], '') || digest || array_to_string(hs[k + 2:k // 8 * 8 + 8], '')),
              sib || array_to_string(hs[k // 8 * 8 + 1:k], '') || array_to_string(hs[k + 2:k // 8 * 8 + 8], '')
       FROM up JOIN t ON t.tree = up.tree AND t.level = up.level WHERE len(hs) > 1),
sub AS (SELECT tree, pos, digest, sib FROM up JOIN t USING (tree, level) WHERE len(hs) = 1),
over AS (SELECT tree, pos, 0 AS level, tree AS k, digest, sib FROM sub
         UNION ALL
         SELECT tree, pos, over.level + 1, k // 8,
                sha256(array_to_string(hs[k // 8 * 8 + 1:k], '') || digest || array_to_string(hs[k + 2:k // 8 * 8 + 8], '')),
                sib || array_to_string(hs[k // 8 * 8 + 1:k], '') || array_to_string(hs[k + 2:k // 8 * 8 + 8], '')
         FROM over JOIN u ON u.level = over.level WHERE len(hs) > 1),
folded AS (SELECT tree, pos, digest, sib, hs[1] AS root FROM over JOIN u USING (level) WHERE len(hs) = 1)
SELECT doc_id, leaf, subroot, root, sha256(sib) AS proof_sha256, digest AS folded_root, digest = root AS verified
FROM l JOIN s USING (tree) JOIN folded USING (tree, pos)
"""


@query("op11_merkle_manifest", OP11_SQL)
def op11_merkle_manifest(spark, sf_dir):
    """Merkle manifest of all documents; every proof folded, those of tampered documents from the changed leaf."""
    return merkle.fold(merkle.manifest(_table(spark, sf_dir, "documents"), merkle.tampered()))


OP12_SQL = """
WITH d AS (SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS hx, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
u AS (SELECT k, hx, unnest(range(n - 399)) AS s FROM d WHERE n >= 400),
w AS (SELECT k, s, md5(substr(hx, (2 * s + 1)::BIGINT, 800)) AS h FROM u),
r AS (SELECT k, s FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
i AS (SELECT k, s, CASE WHEN s <= lag(s) OVER (PARTITION BY k ORDER BY s) + 400 THEN 0 ELSE 1 END AS new FROM r),
j AS (SELECT k, s, sum(new) OVER (PARTITION BY k ORDER BY s) AS part FROM i),
x AS (SELECT k, part, min(s) AS a, max(s) + 400 AS b FROM j GROUP BY k, part),
y AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY k ORDER BY a), 0) AS before FROM x),
z AS (SELECT k, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
             string_agg(substr(hx, (2 * before + 1)::BIGINT, (2 * (a - before))::BIGINT), '' ORDER BY a) AS front FROM y JOIN d USING (k) GROUP BY k)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(front || substr(hx, (2 * last + 1)::BIGINT), hx))) AS kept_sha256
FROM d LEFT JOIN z USING (k)
"""


@query("op12_suffix_dedup", OP12_SQL)
def op12_suffix_dedup(spark, sf_dir):
    """All documents without the bytes of 400-byte strings that occur anywhere else."""
    return suffixes.repeated_passages(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


OP13_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {CRC32_SQL.format("doc_id")} AS h,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS v FROM documents),
g AS (SELECT *, len(v) AS n, CASE WHEN h % 10 = 0 AND len(v) > 0 THEN (h // 10) % len(v) END AS a FROM d),
q AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM g),
w AS (SELECT k, doc_id, n, CASE WHEN a IS NULL THEN v ELSE list_transform(range(n), lambda i: v[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS v FROM q),
x AS (SELECT k, n, unnest(v) AS word, unnest(range(n)) AS i FROM w),
m AS (SELECT b.k, b.i, c.i - b.i AS p FROM x b JOIN x c ON b.k = c.k AND b.word = c.word AND c.i > b.i AND 4 * (c.i - b.i) <= b.n),
s AS (SELECT k, p, min(i) AS start, count(*) + p AS length
      FROM (SELECT *, i - row_number() OVER (PARTITION BY k, p ORDER BY i) AS part FROM m) GROUP BY k, p, part HAVING count(*) + p >= greatest(6, 4 * p)),
r AS (SELECT * FROM s WHERE NOT EXISTS (FROM s o WHERE o.k = s.k AND o.p < s.p AND o.start <= s.start AND o.start + o.length >= s.start + s.length)),
lead AS (SELECT k, count(*) AS n_runs, arg_min(struct_pack(start := start, length := length, p := p), (-length, start, p)) AS best,
                string_agg(start || ',' || length || ',' || p || chr(10), '' ORDER BY start, p) AS lines FROM r GROUP BY k),
cut AS (SELECT DISTINCT k, unnest(range(start + p, start + length)) AS i FROM r),
kept AS (SELECT k, string_agg(word, ' ' ORDER BY i) AS words FROM x ANTI JOIN cut USING (k, i) GROUP BY k)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length, best.p::BIGINT AS period,
       (1000 * best.length // best.p)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(words, '')) AS collapsed_sha256
FROM w LEFT JOIN lead USING (k) LEFT JOIN kept USING (k)
"""


@query("op13_periodic_runs", OP13_SQL)
def op13_periodic_runs(spark, sf_dir):
    """Runs of repeated words in all documents, after every tenth document's words were made periodic."""
    docs = _table(spark, sf_dir, "documents")
    return periods.digest_runs(docs.withColumn("text", periods.planted(F.col("text"), F.col("doc_id"))))


@query("pipeline")
def pipeline(spark, sf_dir):
    """The whole corpus pipeline: quality, rules, near duplicates, personal data, packing."""
    return corpus_pipeline.run(spark, sf_dir)
