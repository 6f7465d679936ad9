"""Queries: projection, filters, fills, mapping, strings, arrays, windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import text as T
from tessera.operators import clean as C
from tessera.operators import window as W
from tessera.plans import fixtures as fx
from tessera.plans.registry import query, r6
from tessera.sources.tables import table


@query("drop_columns", "SELECT p_partkey, p_brand, p_size, round(p_retailprice, 6) AS p_retailprice FROM part")
def q_drop_columns(spark, d):
    p = C.drop_columns(table(spark, d, "part"), ["p_name", "p_type"])
    return p.withColumn("p_retailprice", r6("p_retailprice"))


@query("project", "SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice FROM orders")
def q_project(spark, d):
    o = C.keep_columns(table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])
    return o.withColumn("o_totalprice", r6("o_totalprice"))


@query("short_long_values", """
SELECT p_partkey, p_name, CAST(length(p_name) AS INTEGER) AS len FROM part WHERE length(p_name) > 10
UNION ALL
SELECT p_partkey, p_brand, CAST(length(p_brand) AS INTEGER) FROM part WHERE length(p_brand) < 8
""")
def q_short_long(spark, d):
    p = table(spark, d, "part")
    long_ = C.filter_length(p, "p_name", min_len=10).select("p_partkey", "p_name", F.length("p_name").alias("len"))
    short = C.filter_length(p, "p_brand", max_len=8).select("p_partkey", F.col("p_brand").alias("p_name"),
                                                           F.length("p_brand").alias("len"))
    return long_.unionByName(short)


@query("drop_null_rows", fx.with_fixtures("orders_gaps") +
       "SELECT id, class, round(price, 6) AS price FROM orders_gaps WHERE class IS NOT NULL")
def q_drop_null_rows(spark, d):
    g = C.drop_null_rows(fx.orders_gaps(spark, d), ["class"])
    return g.withColumn("price", r6("price"))


@query("complete_cases", fx.with_fixtures("orders_gaps") +
       "SELECT id, class, round(price, 6) AS price FROM orders_gaps WHERE class IS NOT NULL AND price IS NOT NULL")
def q_complete_cases(spark, d):
    return C.drop_null_rows(fx.orders_gaps(spark, d)).withColumn("price", r6("price"))


@query("rows_with_null", fx.with_fixtures("orders_gaps") +
       "SELECT id, class, round(price, 6) AS price FROM orders_gaps WHERE class IS NULL OR price IS NULL")
def q_rows_with_null(spark, d):
    return C.rows_with_null(fx.orders_gaps(spark, d)).withColumn("price", r6("price"))


@query("patch_by_key", fx.with_fixtures("orders_gaps") + """,
patch AS (SELECT o_orderkey AS pid, 'URGENT' AS v FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT g.id, CASE WHEN p.pid IS NOT NULL THEN p.v ELSE g.class END AS class
FROM orders_gaps g LEFT JOIN patch p ON g.id = p.pid
""")
def q_patch_by_key(spark, d):
    o = table(spark, d, "orders")
    patches = o.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").alias("id"), F.lit("URGENT").alias("value"))
    return C.patch_by_key(fx.orders_gaps(spark, d).select("id", "class"), patches, "id", "class")


@query("map_values", """
SELECT p_partkey,
  CASE p_type WHEN 'ECONOMY' THEN 'ECO' WHEN 'SMALL' THEN 'SM' ELSE p_type END AS p_type,
  CASE WHEN p_brand = 'Brand#1' THEN 'Brand#01' ELSE p_brand END AS p_brand
FROM part
""")
def q_map_values(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_type", "p_brand")
    p = C.map_values(p, "p_type", {"ECONOMY": "ECO", "SMALL": "SM"})
    return p.withColumn("p_brand", F.when(F.col("p_brand") == "Brand#1", "Brand#01").otherwise(F.col("p_brand")))


@query("fill_constant", fx.with_fixtures("orders_gaps") + """
SELECT id, coalesce(nullif(class, ''), 'none') AS class, round(coalesce(price, 0), 6) AS price FROM orders_gaps
""")
def q_fill_constant(spark, d):
    g = C.fill_constant(fx.orders_gaps(spark, d), {"class": "none", "price": 0.0})
    return g.withColumn("price", r6("price"))


@query("top_n", "SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def q_top_n(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return W.top_n(o, [F.desc("o_totalprice"), F.asc("o_orderkey")], 10).withColumn("o_totalprice", r6("o_totalprice"))


@query("union_tagged", """
SELECT c_custkey AS id, c_name AS name, round(c_acctbal, 6) AS bal, 'customer' AS split FROM customer
UNION ALL SELECT s_suppkey, s_name, round(s_acctbal, 6), 'supplier' FROM supplier
UNION ALL SELECT n_nationkey, n_name, NULL, 'nation' FROM nation
""")
def q_union_tagged(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                           r6("c_acctbal").alias("bal"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                           r6("s_acctbal").alias("bal"))
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"))
    return W.union_tagged({"customer": c, "supplier": s, "nation": n})


@query("cap_per_class", fx.with_fixtures("events_skewed") + """
SELECT id, class FROM (
  SELECT id, class, row_number() OVER (PARTITION BY class ORDER BY md5(CAST(id AS VARCHAR)), id) AS rn
  FROM events_skewed) WHERE rn <= 900
""")
def q_cap_per_class(spark, d):
    return W.cap_per_class(fx.events_skewed(spark, d), "class", "id", 900).select("id", "class")


@query("cap_per_class_5000", fx.with_fixtures("events_skewed") + """
SELECT id, class FROM (
  SELECT id, class, row_number() OVER (PARTITION BY class ORDER BY md5(CAST(id AS VARCHAR)), id) AS rn
  FROM events_skewed) WHERE rn <= 5000
""")
def q_cap_per_class_5000(spark, d):
    return W.cap_per_class(fx.events_skewed(spark, d), "class", "id", 5000).select("id", "class")


@query("average_rank", fx.with_fixtures("events_skewed") + """
SELECT id, round(rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0, 6) AS rank
FROM events_skewed
""")
def q_average_rank(spark, d):
    r = W.average_rank(fx.events_skewed(spark, d).select("id", "value"), "value")
    return r.select("id", r6("rank").alias("rank"))


# ---- strings -------------------------------------------------------------

@query("normalize_text", """
SELECT c_custkey,
  lower(regexp_replace(c_name, '[^a-zA-Z0-9]', '', 'g')) AS name_norm,
  lower(regexp_replace(c_mktsegment || '/' || c_name, '[^a-zA-Z0-9/]', '', 'g')) AS seg_norm,
  lower(c_mktsegment) AS seg_lower
FROM customer
""")
def q_normalize_text(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey",
                    T.normalize_text("c_name").alias("name_norm"),
                    T.normalize_text(F.concat_ws("/", "c_mktsegment", "c_name"), keep="/").alias("seg_norm"),
                    F.lower("c_mktsegment").alias("seg_lower"))


_SUB_PAIRS = [("small", "sm"), ("all", "a"), ("or", "/"), ("sm", "S")]


@query("substitute_tokens", """
SELECT p_partkey,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(p_name, 'small', 'sm', 'g'), 'all', 'a', 'g'), 'or', '/', 'g'), 'sm', 'S', 'g') AS name_sub,
  regexp_replace(regexp_replace(lower(p_type), 'economy', 'eco', 'g'), 'eco', 'E', 'g') AS type_sub
FROM part
""")
def q_substitute_tokens(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", T.substitute_tokens("p_name", _SUB_PAIRS).alias("name_sub"),
                    T.substitute_tokens(F.lower("p_type"), [("economy", "eco"), ("eco", "E")]).alias("type_sub"))


_KEYWORDS = ["red", "blue", "hot", "small", "ring"]


@query("keyword_collapse", """
SELECT p_partkey,
  regexp_replace(p_name, '(?s).*(red|blue|hot|small|ring).*', '\\1') AS last_kw,
  regexp_replace(p_name, '(?s).*?(red|blue|hot|small|ring).*', '\\1') AS first_kw
FROM part
""")
def q_keyword_collapse(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", T.keyword_collapse("p_name", _KEYWORDS).alias("last_kw"),
                    T.keyword_collapse("p_name", _KEYWORDS, which="first").alias("first_kw"))


@query("split_parts", fx.with_fixtures("line_history") + """
SELECT history, CAST(len(string_split(history, ',')) AS INTEGER) AS n_parts,
  string_split(history, ',')[2] AS second_part, string_split(history, ' ')[1] AS first_word
FROM line_history
""")
def q_split_parts(spark, d):
    h = fx.line_history(spark, d)
    parts = T.split_parts("history", ",")
    return h.select("history", F.size(parts).alias("n_parts"), F.get(parts, 1).alias("second_part"),
                    F.get(T.split_parts("history", " "), 0).alias("first_word"))


@query("json_array", fx.with_fixtures("part_json") + """
SELECT id, CAST(len(CAST(json(feats) AS VARCHAR[])) AS INTEGER) AS n_items, CAST(json(feats) AS VARCHAR[])[2] AS second_item
FROM part_json
""")
def q_json_array(spark, d):
    j = fx.part_json(spark, d)
    arr = T.json_array("feats")
    return j.select("id", F.size(arr).alias("n_items"), F.get(arr, 1).alias("second_item"))


@query("array_tail", fx.with_fixtures("line_history") + """
SELECT history, array_to_string(list_transform(string_split(history, ',')[2:6], lambda e: trim(e)), '|') AS tail
FROM line_history
""")
def q_array_tail(spark, d):
    h = fx.line_history(spark, d)
    return h.select("history", F.array_join(A.array_tail(T.split_parts("history", ","), 2, 5), "|").alias("tail"))


@query("leading_number", fx.with_fixtures("line_history") + """
SELECT history, TRY_CAST(string_split(string_split(history, ',')[1], ' ')[1] AS INTEGER) AS num_owners
FROM line_history
""")
def q_leading_number(spark, d):
    h = fx.line_history(spark, d)
    return h.select("history", A.leading_number(T.split_parts("history", ",")).alias("num_owners"))


@query("tokenize_count", fx.with_fixtures("docs") + """
SELECT id, CAST(len(regexp_extract_all(lower(text), '(\\w+)', 1)) AS INTEGER) AS n_tokens,
  regexp_extract_all(lower(text), '(\\w+)', 1)[1] AS first_token
FROM docs
""")
def q_tokenize_count(spark, d):
    docs = fx.docs(spark, d)
    toks = T.tokens("text", r"\w+")
    return docs.select("id", F.size(toks).alias("n_tokens"), F.get(toks, 0).alias("first_token"))


def _stop_sql() -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(T.ENGLISH_STOP_WORDS))) + "]"


_PAT_SQL = T.TOKEN_PATTERN


@query("clean_tokens", fx.with_fixtures("docs") + f""",
toks AS (
  SELECT id, list_filter(list_transform(list_filter(
      regexp_extract_all(lower(CASE WHEN text IS NULL OR text = '' THEN 'none' ELSE text END), '({_PAT_SQL})', 1),
      lambda t: NOT list_contains({_stop_sql()}, t)),
    lambda t: regexp_replace(t, '[^a-z0-9]', '', 'g')), lambda t: t <> '') AS tokens
  FROM docs)
SELECT id, CAST(len(tokens) AS INTEGER) AS n_tokens, md5(array_to_string(tokens, ' ')) AS digest FROM toks
""")
def q_clean_tokens(spark, d):
    docs = fx.docs(spark, d)
    toks = T.clean_tokens("text")
    return docs.select("id", toks.alias("t")).select(
        "id", F.size("t").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("digest"))


@query("remove_stopwords", fx.with_fixtures("docs") + f"""
SELECT id, CAST(len(list_filter(regexp_extract_all(lower(text), '(\\w+)', 1),
                           lambda t: NOT list_contains({_stop_sql()}, t))) AS INTEGER) AS n_kept
FROM docs
""")
def q_remove_stopwords(spark, d):
    from tessera.operators.textvec import remove_stopwords
    docs = fx.docs(spark, d).select("id", T.tokens("text", r"\w+").alias("toks"))
    return remove_stopwords(docs, "toks", "kept").select("id", F.size("kept").alias("n_kept"))


@query("vocabulary", fx.with_fixtures("docs") + """
SELECT token, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(lower(text), '(\\w+)', 1)) AS token FROM docs)
GROUP BY token HAVING count(*) >= 3
""")
def q_vocabulary(spark, d):
    from tessera.operators.textvec import vocabulary
    docs = fx.docs(spark, d).select(T.tokens("text", r"\w+").alias("toks"))
    return vocabulary(docs, "toks", min_count=3).select("token", "n")


# ---- arrays / math --------------------------------------------------------

@query("embedding_norm", """
SELECT vec_id, round(sqrt(list_reduce(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)), lambda a, b: a + b)), 6) AS norm
FROM embeddings
""")
def q_embedding_norm(spark, d):
    e = table(spark, d, "embeddings")
    return e.select("vec_id", r6(A.l2_norm("embedding")).alias("norm"))


@query("softmax_argmax", """
WITH s AS (SELECT vec_id, embedding AS z FROM embeddings),
e AS (SELECT vec_id, z, list_transform(z, lambda x: exp(CAST(x AS DOUBLE) - list_max(z))) AS ex FROM s)
SELECT vec_id, CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS argmax,
  round(list_max(ex) / list_sum(ex), 6) AS p_max
FROM e
""")
def q_softmax_argmax(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("z"))
    zd = F.transform("z", lambda x: x.cast("double"))
    return e.select("vec_id", A.argmax("z").alias("argmax"), r6(F.array_max(A.softmax(zd))).alias("p_max"))


@query("log_values", """
SELECT event_id, round(ln(1 + value), 6) AS log1p_value, round(round_even(value, 1), 6) AS value_r1
FROM events
""")
def q_log_values(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", r6(A.log1p_safe("value")).alias("log1p_value"),
                    r6(A.half_even("value", 1)).alias("value_r1"))
