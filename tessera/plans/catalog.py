"""Registered queries over the test tables, each with its SQL counterpart where SQL can say it.

A query is a function ``(spark, sf_dir) -> DataFrame``; ``SQL`` holds text for the tables as views.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.ids import point_uuid
from tessera.functions.text import normalize_accents, plain_letters, term_frequencies, token_index, tokens
from tessera.functions.vectors import masked_mean
from tessera.operators import chunking, collections, documents, embedding, fusion, html, incremental, keyword, postprocess, rerank, search
from tessera.operators.filters import operator_filter, plain_filter
from tessera.session import table
from tessera.sources import checkpoints, ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TOP = 10


def query(sql: str | None = None):
    def wrap(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return wrap


# ---- text functions

_PATTERN = "[a-z0-9À-ž]+(?:[-_./][a-z0-9À-ž]+)*"


def _tok(name: str, source: str, key: str) -> str:
    """CTEs ``{name}_occ`` and ``{name}`` (id, p, token) over the texts of a table."""
    flat = "regexp_replace(o, '[-_./]', '', 'g')"
    return (
        f"{name}_ms AS (SELECT {key} AS id, regexp_extract_all(lower(coalesce(text, '')), '{_PATTERN}') AS ms FROM {source}), "
        f"{name}_occ AS (SELECT id, unnest(ms) AS o, generate_subscripts(ms, 1) AS p FROM {name}_ms), "
        f"{name} AS (SELECT id, p, unnest(list_distinct([o, {flat}, strip_accents(o), strip_accents({flat})])) AS token FROM {name}_occ)"
    )


def _idx(t: str) -> str:
    w = [f"('0x' || substr(md5({t}), {i}, 8))::BIGINT" for i in (1, 9, 17, 25)]
    return f"(8 * {w[0]} + 4 * {w[1]} + 2 * {w[2]} + {w[3]}) % 2147483647"


@query(f"WITH {_tok('t', 'documents', 'doc_id')} SELECT token, count(*) AS n FROM t GROUP BY token")
def tokenize_terms(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.explode(tokens("text")).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def _vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.explode(F.array_distinct(tokens("text"))).alias("token")).distinct()


@query(f"WITH {_tok('t', 'documents', 'doc_id')} SELECT DISTINCT token, strip_accents(token) AS plain FROM t")
def normalize_token_accents(spark: SparkSession, d: str) -> DataFrame:
    return _vocabulary(spark, d).select("token", plain_letters("token").alias("plain"))


@query("SELECT doc_id, strip_accents(text) AS plain FROM documents")
def normalize_text_accents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", normalize_accents("text").alias("plain"))


@query(f"WITH {_tok('t', 'documents', 'doc_id')} SELECT DISTINCT token, {_idx('token')} AS idx FROM t")
def token_hash_index(spark: SparkSession, d: str) -> DataFrame:
    return _vocabulary(spark, d).select("token", token_index("token").alias("idx"))


def _tf(name: str, toks: str) -> str:
    return (
        f"{name}_c AS (SELECT id, token, count(*) AS n, min(p) AS f FROM {toks} GROUP BY ALL), "
        f"{name} AS (SELECT id, idx, CAST(arg_max(n, f) AS DOUBLE) AS tf FROM (SELECT id, {_idx('token')} AS idx, n, f FROM {name}_c) GROUP BY ALL)"
    )


@query(f"WITH {_tok('t', 'documents', 'doc_id')}, {_tf('v', 't')} SELECT id, idx, tf FROM v")
def term_frequency_vector(spark: SparkSession, d: str) -> DataFrame:
    return term_frequencies(table(spark, d, "documents"), "doc_id", "text")


# ---- keyword search and fusion

_OKAPI = (
    "dl AS (SELECT m.id, count(t.token) AS dl FROM t_ms m LEFT JOIN t ON t.id = m.id GROUP BY m.id), sz AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl), "
    "df AS (SELECT token, count(DISTINCT id) AS df FROM t GROUP BY token), "
    "raw AS (SELECT token, ln(n - df + 0.5) - ln(df + 0.5) AS r FROM df, sz), "
    "idf AS (SELECT token, CASE WHEN r < 0 THEN 0.25 * (SELECT avg(r) FROM raw) ELSE r END AS idf FROM raw), "
    "tf AS (SELECT id, token, count(*) AS tf FROM t GROUP BY ALL), qtf AS (SELECT id AS query_id, token, count(*) AS qtf FROM q GROUP BY ALL), "
    "hit AS (SELECT query_id, tf.id, round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 6) AS score "
    "FROM qtf JOIN idf USING (token) JOIN tf USING (token) JOIN dl ON dl.id = tf.id, sz GROUP BY ALL), "
    "okapi_all AS (SELECT e.item_id AS query_id, dl.id, coalesce(h.score, 0.0) AS score FROM eval_items e CROSS JOIN dl LEFT JOIN hit h ON h.query_id = e.item_id AND h.id = dl.id), "
    "okapi AS (SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score FROM okapi_all) WHERE rank <= {k})"
)
_SPARSE = (
    "sn AS (SELECT count(DISTINCT id) AS n FROM v), sdf AS (SELECT idx, count(*) AS df FROM v GROUP BY idx), "
    "shit AS (SELECT w.id AS query_id, v.id, round(sum(w.tf * ln(1 + (n - df + 0.5) / (df + 0.5)) * v.tf), 6) AS score FROM w JOIN v USING (idx) JOIN sdf USING (idx), sn {where} GROUP BY ALL), "
    "sparse AS (SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score FROM shit) WHERE rank <= {k})"
)
_BASE = f"{_tok('t', 'documents', 'doc_id')}, {_tok('q', 'eval_items', 'item_id')}"
_SPARSE_BASE = f"{_tf('v', 't')}, {_tf('w', 'q')}"
_FILTER = "JOIN documents d ON d.doc_id = v.id WHERE d.lang IN ('en', 'pt') AND d.source = 'support-portal'"


def _eval_queries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "eval_items").select(F.col("item_id").alias("query_id"), "text")


@query(f"WITH {_BASE}, {_OKAPI.format(k=TOP)} SELECT * FROM okapi")
def okapi_bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    return keyword.okapi(table(spark, d, "documents"), _eval_queries(spark, d), TOP, id_col="doc_id", digits=6)


@query(f"WITH {_BASE}, {_SPARSE_BASE}, {_SPARSE.format(k=TOP, where='')} SELECT * FROM sparse")
def sparse_idf_topk(spark: SparkSession, d: str) -> DataFrame:
    return keyword.sparse_idf(table(spark, d, "documents"), _eval_queries(spark, d), TOP, id_col="doc_id", digits=6)


@query(f"WITH {_BASE}, {_SPARSE_BASE}, {_SPARSE.format(k=TOP, where=_FILTER)} SELECT * FROM sparse")
def sparse_idf_filtered(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return keyword.sparse_idf(docs, _eval_queries(spark, d), TOP, id_col="doc_id", digits=6, where=plain_filter(docs, {"lang": ["en", "pt"], "source": "support-portal"}))


_RRF = (
    "lanes AS (SELECT query_id, 0 AS lane, rank, id FROM okapi UNION ALL SELECT query_id, 1, rank, id FROM sparse), "
    "fused AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first) AS rank, id, score FROM "
    "(SELECT query_id, id, round(sum(1.0::DOUBLE / (60.0::DOUBLE + rank)), 9) AS score, min(lane * 100000 + rank) AS first FROM lanes GROUP BY ALL))"
)
_HYBRID = f"WITH {_BASE}, {_OKAPI.format(k=TOP)}, {_SPARSE_BASE}, {_SPARSE.format(k=TOP, where='')}, {_RRF}"


def hybrid(docs: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """Both keyword rankings of the documents, fused: ``(query_id, rank, id, score)``."""
    corpus = keyword.tokenized(docs, id_col="doc_id")
    a = keyword.okapi(docs, queries, k, digits=6, corpus=corpus)
    b = keyword.sparse_idf(docs, queries, k, digits=6, corpus=corpus)
    return fusion.rrf(fusion.as_lanes(a, b), digits=9).withColumn("id", F.col("id").cast("bigint"))


@query(f"{_HYBRID} SELECT * FROM fused")
def rrf_fusion(spark: SparkSession, d: str) -> DataFrame:
    return hybrid(table(spark, d, "documents"), _eval_queries(spark, d))


@query(
    f"{_HYBRID}, g AS (SELECT f.query_id, f.rank, f.id, f.score, row_number() OVER (PARTITION BY f.query_id, coalesce(nullif(d.source, ''), f.id::VARCHAR) ORDER BY f.rank) AS n FROM fused f JOIN documents d ON d.doc_id = f.id) "
    "SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS rank, id, score FROM g WHERE n = 1"
)
def hybrid_grouped(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    hits = hybrid(docs, _eval_queries(spark, d)).join(docs.select(F.col("doc_id").alias("id"), "source"), "id")
    grouped = postprocess.group_by_parent(hits, F.coalesce(F.nullif(F.col("source"), F.lit("")), F.col("id").cast("string")))
    return grouped.select("query_id", "rank", "id", "score")


@query(
    "WITH lanes AS (SELECT query_id, 0 AS lane, hit_rank AS rank, id FROM keyword_matches UNION ALL SELECT query_id, CASE metric WHEN 'cosine' THEN 1 ELSE 2 END, hit_rank, id FROM dense_hits), "
    "s AS (SELECT query_id, id, round(sum(1.0::DOUBLE / (60.0::DOUBLE + rank)), 9) AS score, min(lane * 100000 + rank) AS first FROM lanes WHERE id IS NOT NULL AND rank IS NOT NULL GROUP BY ALL) "
    "SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first, id) AS rank, id, score FROM s"
)
def rrf_lanes(spark: SparkSession, d: str) -> DataFrame:
    dense = table(spark, d, "dense_hits").select("query_id", F.when(F.col("metric") == "cosine", 1).otherwise(2).alias("lane"), F.col("hit_rank").alias("rank"), "id")
    lanes = table(spark, d, "keyword_matches").select("query_id", F.lit(0).alias("lane"), F.col("hit_rank").alias("rank"), "id").unionByName(dense)
    return fusion.rrf(lanes, digits=9)


# ---- dense search


def _vectors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"), "label")
    return e, e.filter("id % 100 = 0").select(F.col("id").alias("query_id"), "vector")


def _knn_sql(score: str, order: str, where: str = "") -> str:
    return (
        "WITH e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings), "
        f"s AS (SELECT q.id AS query_id, e.id, round({score}, 6) + 0.0 AS score FROM e AS q, e WHERE q.id % 100 = 0 {where}) "
        f"SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score {order}, id) AS rank, id, score FROM s) WHERE rank <= {TOP}"
    )


_COSINE = "list_dot_product(q.v, e.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(e.v, e.v)))"
_PAIR = "list_sum(list_transform(list_zip(q.v, e.v), lambda x: {}))"
_SQUARES = _PAIR.format("(x[1] - x[2]) * (x[1] - x[2])")
_KNN = {
    "cosine": _knn_sql(_COSINE, "DESC"),
    "dot": _knn_sql("list_dot_product(q.v, e.v)", "DESC"),
    "euclid": _knn_sql(f"sqrt({_SQUARES})", "ASC"),
    "manhattan": _knn_sql(_PAIR.format("abs(x[1] - x[2])"), "ASC"),
    "l2sq": _knn_sql(_SQUARES, "ASC"),
}


def _knn_query(metric: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        e, q = _vectors(spark, d)
        return search.knn(e, q, TOP, metric, digits=6)

    run.__name__ = f"knn_{metric}"
    query(_KNN[metric])(run)


for _m in _KNN:
    _knn_query(_m)


@query(_knn_sql(_COSINE, "DESC", "AND e.label IN (1, 3, 5)"))
def knn_filtered(spark: SparkSession, d: str) -> DataFrame:
    e, q = _vectors(spark, d)
    return search.knn(e.filter(plain_filter(e, {"label": [1, 3, 5]})), q, TOP, "cosine", digits=6)


@query(_KNN["cosine"])
def knn_by_expression(spark: SparkSession, d: str) -> DataFrame:
    e, q = _vectors(spark, d)
    return search.knn_expression(e, q, TOP, "cosine", digits=6)


@query("SELECT label, list(v ORDER BY i) AS vector FROM (SELECT label, i, round(sum(x * m) / greatest(sum(m), 1e-9), 6) AS v FROM (SELECT label, CASE WHEN embedding[1] > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS m, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY ALL) GROUP BY label")
def masked_mean_pool(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").withColumn("mask", (F.element_at("embedding", 1) > 0).cast("int"))
    return masked_mean(e, "label", "embedding", "mask", digits=6)


# ---- chunks, documents, HTML

_WIN = "list_filter(string_split_regex(coalesce(text, ''), '[ \\n\\t\\r]+'), lambda x: x <> '')"


@query(
    f"WITH w AS (SELECT doc_id::VARCHAR AS doc_id, {_WIN} AS w FROM documents), s AS (SELECT doc_id, w, unnest(generate_series(0, greatest(len(w) - 21, 0), 180)) AS st FROM w WHERE len(w) > 0), "
    "c AS (SELECT doc_id, (st // 180)::BIGINT AS o, w[st + 1:st + 200] AS x FROM s) "
    "SELECT doc_id || ':' || lpad(o::VARCHAR, 6, '0') AS id, doc_id, o AS \"order\", len(x) AS tok, array_to_string(x, ' ') AS text FROM c"
)
def chunk_token_window(spark: SparkSession, d: str) -> DataFrame:
    return chunking.token_windows(table(spark, d, "documents"))


@query()
def chunk_recursive(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumn("meta", F.map_filter(F.create_map(F.lit("lang"), F.col("lang")), lambda _, v: v.isNotNull()))
    return chunking.recursive_chunks(docs, metadata="meta").select("id", "text", F.map_entries("metadata").alias("metadata"))


@query(r"SELECT doc_key, trim(regexp_replace(regexp_replace(regexp_replace(text, '(?s)<!--.*?-->', ' ', 'g'), '<[^<>]+>', ' ', 'g'), '[ \n\t\r]+', ' ', 'g')) AS plain FROM preprocess_results")
def html_strip_tags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "preprocess_results").select("doc_key", html.strip_tags("text").alias("plain"))


@query()
def html_markdown(spark: SparkSession, d: str) -> DataFrame:
    return html.html_to_result(table(spark, d, "preprocess_results"), html_col="text").select("doc_key", "markdown", "text")


@query("SELECT doc_key, coalesce(nullif(i.caption, ''), nullif(i.alt, ''), nullif(i.title, '')) AS description, i.sha256 AS sha256 FROM (SELECT doc_key, unnest(images) AS i FROM preprocess_results)")
def image_descriptions(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "preprocess_results").select("doc_key", F.explode("images").alias("i"))
    return i.select("doc_key", html.image_description(F.col("i.caption"), F.col("i.alt"), F.col("i.title")).alias("description"), F.col("i.sha256").alias("sha256"))


@query("SELECT source_key, missing, count(*) AS n FROM (SELECT source_key, array_to_string(list_filter(['k', 'zone', 'batch'], lambda f: NOT list_contains(coalesce(json_keys(payload), []), f)), ',') AS missing FROM ingest_rows) GROUP BY ALL")
def required_fields(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "ingest_rows").withColumn("doc", documents.parse_documents("payload"))
    m = documents.require_fields(r, "doc", ["k", "zone", "batch"], strict=False)
    return m.groupBy("source_key", F.array_join("missing", ",").alias("missing")).agg(F.count("*").alias("n"))


@query("SELECT id, source_key, coalesce(payload->>'zone', 'none') AS zone FROM ingest_rows")
def document_fields(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "ingest_rows").withColumn("doc", documents.parse_documents("payload"))
    return r.select("id", "source_key", documents.field_or(F.col("doc"), "zone", "none").alias("zone"))


# ---- collections


@query("SELECT DISTINCT s.id, s.collection, s.document, s.updated_at FROM stored_records s JOIN (SELECT id, max(updated_at) AS u FROM stored_records GROUP BY id) m ON m.id = s.id AND m.u = s.updated_at")
def stored_live(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "stored_records").select("id", "collection", "document", "updated_at")
    return collections.latest_per_id(r, F.col("updated_at"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    meta = F.map_filter(F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")), lambda _, v: v.isNotNull())
    return table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.lit(None).cast("array<double>").alias("vector"), F.col("text").alias("document"), meta.alias("metadata"))


@query("SELECT doc_id::VARCHAR AS id, CASE WHEN lang = 'pt' THEN '[rev] ' || text ELSE text END AS document FROM documents WHERE NOT coalesce(source = 'faq-desk', false) AND doc_id NOT IN (SELECT min(doc_id) FROM documents)")
def collection_changes(spark: SparkSession, d: str) -> DataFrame:
    """Upsert all documents, replace those in one language, delete by filter and by id."""
    pages = _pages(spark, d)
    store = collections.open_store(spark, "memory")
    name = f"pages-{uuid.uuid4().hex}"
    store.upsert(name, pages)
    store.upsert(name, pages.filter(plain_filter(pages, {"lang": "pt"})).withColumn("document", F.concat(F.lit("[rev] "), F.col("document"))))
    store.delete(name, where={"source": "faq-desk"})
    store.delete(name, ids=[str(table(spark, d, "documents").agg(F.min("doc_id")).first()[0])])
    return store.get_collection(name).select("id", "document")


@query("SELECT count(*) AS n FROM stored_records WHERE collection IN ('helpdesk', 'valve_lab') AND score >= 0.5 AND score < 0.9 AND collection <> 'helpdesk' AND contains(document, 'contract')")
def collection_operator_filter(spark: SparkSession, d: str) -> DataFrame:
    from tessera.operators.filters import document_filter

    r = table(spark, d, "stored_records")
    w = operator_filter(r, {"$and": [{"collection": {"$in": ["helpdesk", "valve_lab"]}}, {"score": {"$gte": 0.5, "$lt": 0.9}}, {"collection": {"$ne": "helpdesk"}}]})
    return r.filter(w & document_filter({"$contains": "contract"})).agg(F.count("*").alias("n"))


_UUID = "sha1(unhex('b3c9d7e84f2a5b6c8d9e0a1b2c3d4e5f') || encode(doc_id::VARCHAR))"
_UUID_SQL = f"substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', (instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)"


@query(f"SELECT doc_id, {_UUID_SQL} AS point_id FROM (SELECT doc_id, {_UUID} AS h FROM documents)")
def point_uuid5(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", point_uuid(F.col("doc_id").cast("string")).alias("point_id"))


@query(f"SELECT doc_id, text FROM (SELECT doc_id, text, lang, {_UUID_SQL} AS p FROM (SELECT *, {_UUID} AS h FROM documents)) WHERE lang = 'de' ORDER BY p LIMIT 100")
def get_where_limit(spark: SparkSession, d: str) -> DataFrame:
    pages = _pages(spark, d)
    got = collections.first_by_point(pages.filter(plain_filter(pages, {"lang": "de"})), collections.DEFAULT_LIMIT)
    return got.select(F.col("id").cast("bigint").alias("doc_id"), F.col("document").alias("text"))


# ---- sources and sinks

def _sql(spark: SparkSession, d: str, text: str, names: str, params: dict) -> DataFrame:
    for n in names.split():
        table(spark, d, n).createOrReplaceTempView(n)
    return ingest.SqlIngestor(spark).ingest(text, params)


_PRICING = (
    "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS n "
    "FROM lineitem WHERE l_discount >= {low} AND l_discount <= {high} GROUP BY l_returnflag, l_linestatus"
)
_REVENUE = (
    "SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey "
    "JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE l_returnflag = {flag} AND l_quantity < {qty} GROUP BY n_name"
)


@query(_PRICING.format(low="0.03", high="0.07"))
def ingest_pricing(spark: SparkSession, d: str) -> DataFrame:
    return _sql(spark, d, _PRICING.format(low=":low", high=":high"), "lineitem", {"low": 0.03, "high": 0.07})


@query(_REVENUE.format(flag="'R'", qty="24"))
def ingest_revenue(spark: SparkSession, d: str) -> DataFrame:
    return _sql(spark, d, _REVENUE.format(flag=":flag", qty=":qty"), "customer orders lineitem nation region", {"flag": "R", "qty": 24.0})


_SHIPPED = "SELECT p_brand, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal > {low} GROUP BY p_brand"


@query(_SHIPPED.format(low="0"))
def ingest_suppliers(spark: SparkSession, d: str) -> DataFrame:
    return _sql(spark, d, _SHIPPED.format(low=":low"), "lineitem part supplier", {"low": 0.0})


_MARK = (dt.datetime(2024, 1, 15, 12, 0, 0), 500)


@query("SELECT event_id, ts, event_type FROM events WHERE (ts, event_id) > (TIMESTAMP '2024-01-15 12:00:00', 500)")
def checkpoint_incremental(spark: SparkSession, d: str) -> DataFrame:
    mark = (F.lit(_MARK[0].isoformat(" ")).cast("timestamp_ntz"), F.lit(_MARK[1]).cast("bigint"))
    return checkpoints.read_after(table(spark, d, "events"), "ts", "event_id", mark).select("event_id", "ts", "event_type")


# ---- presentation


def _context_hits(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    meta = F.create_map(F.lit("title"), F.coalesce("title", F.lit("")))
    hits = keyword.sparse_idf(docs, _eval_queries(spark, d), 5, id_col="doc_id", digits=6).withColumn("score", F.round("score", 3))
    return hits.join(docs.select(F.col("doc_id").alias("id"), F.col("text").alias("document"), meta.alias("metadata")), "id")


@query(
    f"WITH {_BASE}, {_SPARSE_BASE}, {_SPARSE.format(k=5, where='')}, "
    "b AS (SELECT s.query_id, s.rank, '[' || s.rank || '] id=' || s.id || CASE WHEN coalesce(d.title, '') = '' THEN '' ELSE '  title=' || d.title END || '  score=' || printf('%.4f', round(s.score, 3)) || chr(10) || coalesce(d.text, '') || chr(10) AS x FROM sparse s JOIN documents d ON d.doc_id = s.id) "
    "SELECT query_id, '=== RETRIEVED CONTEXT (top ' || count(*) || ') ===' || chr(10) || chr(10) || string_agg(x, chr(10) ORDER BY rank) AS context FROM b GROUP BY query_id"
)
def context_window(spark: SparkSession, d: str) -> DataFrame:
    return postprocess.context_window(_context_hits(spark, d))


@query(
    "WITH p AS (SELECT 'parents/' || doc_key || '.md' AS path, any_value(text) AS text FROM preprocess_results GROUP BY doc_key) "
    "SELECT c.id AS chunk, coalesce(nullif(c.metadata['doc_id'], ''), c.id) AS id, md5(p.text) AS digest FROM (SELECT DISTINCT * FROM chunks) c LEFT JOIN p ON p.path = c.metadata['source_path']"
)
def resolve_parents(spark: SparkSession, d: str) -> DataFrame:
    hits = table(spark, d, "chunks").select("id", F.col("id").alias("chunk"), F.array_sort(F.map_entries("metadata")).alias("e")).distinct().select("id", "chunk", F.map_from_entries("e").alias("metadata"))
    parents = table(spark, d, "preprocess_results").groupBy("doc_key").agg(F.any_value("text").alias("text"))
    parents = parents.select(F.concat(F.lit("parents/"), F.col("doc_key"), F.lit(".md")).alias("source_path"), "text")
    return postprocess.resolve_parents(hits, parents).select("chunk", "id", F.md5(F.col("document").cast("binary")).alias("digest"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return hybrid_grouped(spark, d)



query(incremental.P4_SQL)(incremental.p4_found)

from tessera.plans import components  # noqa: E402, F401  its queries join those above
