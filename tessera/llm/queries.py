"""Registered queries of this subpackage, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.backoff import score_documents
from tessera.llm.importance import resample
from tessera.llm.jaccard_join import jaccard_components
from tessera.llm.labelled import fold, score_texts
from tessera.llm.line_dedup import dedup_lines
from tessera.llm.merkle import proofs
from tessera.llm.minhash import edited_fingerprints, near_duplicates
from tessera.llm.multi_index import nearest
from tessera.llm.packing import pack_documents
from tessera.llm.piece_codec import encode_pieces
from tessera.llm.quality import fit_quality
from tessera.llm.secrets import fit_secrets, scan_secrets
from tessera.llm.token_counts import count_tokens, tokenizer_path
from tessera.llm.toxicity import fit_toxicity
from tessera.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQLS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQLS[name] = sql
        return fn
    return register


def held_out(n: int, remainder: int):
    return F.coalesce(fold("doc_id", n) == remainder, F.lit(False))


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels.where(~held_out(5, 0)))
    return score_texts(docs, model, ["doc_id"]).select(
        "doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op5_quality")
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_quality(docs, labels.where(~held_out(4, 2)))
    return score_texts(docs, model, ["doc_id"]).select(
        "doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op3_secrets")
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan_secrets(docs, fit_secrets(docs), ["doc_id"])


@query("op6_minhash")
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op6_near_duplicates")
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_multi_index")
def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op10_jaccard_join", r"""
WITH RECURSIVE a AS (
  SELECT doc_id, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') AS ws FROM documents),
b AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM a),
t AS (SELECT doc_id, list(w ORDER BY i) AS ws, count(*) AS n FROM b WHERE w <> '' GROUP BY doc_id),
g AS (SELECT doc_id, ws, unnest(generate_series(1, greatest(n - 4, 1))) AS i FROM t),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle FROM g),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
      GROUP BY x.doc_id, y.doc_id),
l AS (SELECT a, b FROM c JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN z ON z.doc_id = d.doc_id LEFT JOIN m ON m.a = d.doc_id
""")
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


@query("op7_piece_codec")
def op7_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query("op9_backoff", r"""
WITH a AS (SELECT doc_id, string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') AS ws FROM documents),
b AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM a),
u AS (SELECT doc_id, w, i FROM b WHERE w <> ''),
p AS (SELECT doc_id, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS v FROM u),
c1 AS (SELECT w, count(*) AS c FROM u GROUP BY w),
c2 AS (SELECT v, w, count(*) AS c FROM p WHERE v IS NOT NULL GROUP BY v, w),
n AS (SELECT count(*) AS t FROM u),
s AS (SELECT p.doc_id, count(*) AS n_words,
             sum(CASE WHEN p.v IS NULL THEN ln(c1.c / n.t) WHEN c2.c >= 2 THEN ln(c2.c / cv.c)
                 ELSE ln(0.4 * c1.c / n.t) END) AS log_score
      FROM p CROSS JOIN n JOIN c1 ON c1.w = p.w LEFT JOIN c1 AS cv ON cv.w = p.v
      LEFT JOIN c2 ON c2.v = p.v AND c2.w = p.w GROUP BY p.doc_id)
SELECT d.doc_id, coalesce(s.n_words, 0) AS n_words, round(coalesce(s.log_score, 0.0), 4) AS log_score
FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id
""")
def op9_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents")).withColumn("log_score", F.round("log_score", 4))


#: DuckDB: crc32 of the UTF-8 bytes of a string, by a table of 256 made from the polynomial.
CRC32_SQL = """
crc_table AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
  lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc_of),
"""


def crc32_sql(text: str) -> str:
    """The crc32 of the string ``text``, in a query that has ``crc_of`` of ``crc_table`` in reach."""
    code = f"hex(encode({text}))"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, octet_length(encode({text})) + 1), "
            f"lambda i: ('0x' || substr({code}, 2 * i - 1, 2))::BIGINT)), "
            "lambda c, b: xor(crc_of[xor(c, b) % 256 + 1], c // 256)))")


@query("op12_merkle", rf"""
WITH RECURSIVE {CRC32_SQL.strip()}
d AS (SELECT row_number() OVER () AS rid, documents.*, {crc32_sql("doc_id::VARCHAR")} % 7 = 0 AS hit FROM documents, crc_table),
f AS (SELECT rid, doc_id, lang, hit,
  coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
  || coalesce(strlen(lang) || ':' || lang, '-') AS head,
  coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS chars,
  coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS other,
  coalesce(strlen(text) || ':' || text, '-') AS body FROM d),
h AS (SELECT rid, doc_id, lang, sha256(head || chars || body) AS leaf,
             CASE WHEN hit THEN sha256(head || other || body) ELSE sha256(head || chars || body) END AS changed FROM f),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
             count(*) OVER (PARTITION BY lang) AS n FROM h),
t AS (SELECT coalesce('=' || lang, '') AS tree, 0 AS lvl, pos AS idx, leaf AS digest, n FROM k
  UNION ALL
  SELECT tree, lvl + 1, idx // 2, sha256(digest || coalesce(lead(digest) OVER (PARTITION BY tree ORDER BY idx), '')), (n + 1) // 2
  FROM t WHERE n > 1 QUALIFY idx % 2 = 0),
s AS (SELECT tree, lvl AS tall, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
      FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, pos AS idx, subroot AS digest, n FROM s
  UNION ALL
  SELECT lvl + 1, idx // 2, sha256(digest || coalesce(lead(digest) OVER (ORDER BY idx), '')), (n + 1) // 2
  FROM u WHERE n > 1 QUALIFY idx % 2 = 0),
w AS (SELECT k.rid, k.doc_id, k.leaf, k.changed, k.pos, coalesce('=' || k.lang, '') AS tree, s.tall, s.subroot, s.pos AS own
      FROM k JOIN s ON s.tree = coalesce('=' || k.lang, '')),
p AS (SELECT w.rid, t.lvl AS step, t.digest, t.idx < w.pos >> t.lvl AS before
      FROM w JOIN t ON t.tree = w.tree AND t.lvl < w.tall AND t.idx = xor(w.pos >> t.lvl, 1)
  UNION ALL
  SELECT w.rid, w.tall + u.lvl, u.digest, u.idx < w.own >> u.lvl
  FROM w JOIN u ON u.n > 1 AND u.idx = xor(w.own >> u.lvl, 1)),
r AS (SELECT digest AS root, lvl AS top FROM u WHERE n = 1),
g AS (SELECT rid, 0 AS step, changed AS digest FROM w
  UNION ALL
  SELECT g.rid, g.step + 1, sha256(CASE WHEN p.before THEN p.digest || g.digest ELSE g.digest || coalesce(p.digest, '') END)
  FROM g JOIN w ON w.rid = g.rid JOIN r ON g.step < w.tall + r.top LEFT JOIN p ON p.rid = g.rid AND p.step = g.step),
z AS (SELECT w.rid, sha256(coalesce(string_agg(p.digest, '' ORDER BY p.step), '')) AS proof_sha256
      FROM w LEFT JOIN p ON p.rid = w.rid GROUP BY w.rid)
SELECT w.doc_id, w.leaf, w.subroot, r.root, z.proof_sha256, g.digest AS folded_root, g.digest = r.root AS verified
FROM w JOIN r ON true JOIN z ON z.rid = w.rid JOIN g ON g.rid = w.rid AND g.step = w.tall + r.top
""")
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return proofs(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id",
                  changed={"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})


@query("op13_line_dedup", r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
u AS (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM u),
g AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT rid) >= 3),
m AS (SELECT k.*, g.key IS NOT NULL AND g.last IS DISTINCT FROM k.doc_id AS goes FROM k LEFT JOIN g ON g.key = k.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT goes), '')) AS kept_sha256
FROM m GROUP BY rid
""")
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op11_importance", rf"""
WITH {CRC32_SQL.strip()}
a AS (SELECT 0 AS side, row_number() OVER () AS rid, doc_id, text FROM documents UNION ALL SELECT 1, item_id, item_id, text FROM benchmark),
b AS (SELECT side, rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM a),
c AS (SELECT side, rid, ws, unnest(generate_series(1, len(ws))) AS i FROM b),
e AS (SELECT side, rid, unnest([array_to_string(ws[i:i + k - 1], ' ') FOR k IN [1, 2, 3] IF i + k - 1 <= len(ws)]) AS feature FROM c),
q AS (SELECT side, rid, feature, count(*) AS n FROM e GROUP BY ALL),
v AS (SELECT DISTINCT feature FROM q),
x AS (SELECT feature, {crc32_sql("feature")} % 10000 AS bucket FROM v, crc_table),
y AS (SELECT side, bucket, sum(n) AS n FROM q JOIN x USING (feature) GROUP BY ALL),
n AS (SELECT coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s_all, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t_all FROM y),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(max(n) FILTER (side = 1), 0) + 1)::DOUBLE * (max(s_all) + 10000)
                / ((coalesce(max(n) FILTER (side = 0), 0) + 1)::DOUBLE * (max(t_all) + 10000))))::BIGINT AS g FROM y, n GROUP BY bucket),
w AS (SELECT rid, sum(q.n)::BIGINT AS n_features, sum(q.n * g)::BIGINT AS weight
      FROM q JOIN x USING (feature) JOIN gain USING (bucket) WHERE side = 0 GROUP BY rid),
d AS (SELECT a.rid, a.doc_id, len(b.ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             ('0x' || substr(sha256('42:' || a.doc_id), 1, 8))::BIGINT AS h
      FROM a JOIN b ON b.side = 0 AND b.rid = a.rid LEFT JOIN w ON w.rid = a.rid WHERE a.side = 0),
z AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score, n_words >= 20 AND doc_id IS NOT NULL AS able FROM d),
o AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS pos, count(*) OVER (PARTITION BY able) AS k FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND pos <= 5 * k // 100 THEN pos END AS rank FROM o
""")
def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
