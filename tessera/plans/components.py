"""Queries of further operators, on inputs made from the test tables so that SQL can say what has to come out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import chunking, collections, html, keyword, postprocess, rerank, search
from tessera.operators.embedding import embed_table, hashing_embedder, resolve_vectors
from tessera.operators.filters import plain_filter
from tessera.plans.catalog import _BASE, _OKAPI, _SPARSE, _SPARSE_BASE, TOP, _eval_queries, _pages, _tok, _vectors, query
from tessera.session import table
from tessera.sources import ingest

# ---- HTML made of plain fields

_FIELDS = "SELECT doc_id, coalesce(nullif(regexp_replace(lang, '[^a-z]', '', 'g'), ''), 'xx') AS l, regexp_replace(coalesce(source, 'none'), '[^A-Za-z0-9]', '', 'g') || 's' AS s FROM documents"


def _fields(spark: SparkSession, d: str) -> DataFrame:
    lang = F.coalesce(F.nullif(F.regexp_replace("lang", "[^a-z]", ""), F.lit("")), F.lit("xx"))
    source = F.concat(F.regexp_replace(F.coalesce("source", F.lit("none")), "[^A-Za-z0-9]", ""), F.lit("s"))
    return table(spark, d, "documents").select("doc_id", lang.alias("l"), source.alias("s"))


def _html(*parts: str) -> F.Column:
    """Text and, in braces, fields."""
    return F.concat(*[F.col(p[1:-1]).cast("string") if p[:1] == "{" and p[-1:] == "}" else F.lit(p) for p in parts])


@query(
    f"SELECT doc_id, '# Page ' || doc_id || chr(10) || chr(10) || 'Text **' || l || '** and [link](https://x.invalid/' || s || ') end' || chr(10) || chr(10) || '* one ' || l || chr(10) || '* two' || chr(10) || chr(10) || '1. first' "
    f"|| chr(10) || chr(10) || 'call and file and [tel](tel:' || doc_id || ')' || chr(10) || chr(10) || '```' || chr(10) || 'x = ' || doc_id || chr(10) || '```' AS markdown, "
    f"'Page ' || doc_id || ' Text ' || l || ' and link end one ' || l || ' two first call and file and tel x = ' || doc_id AS text FROM ({_FIELDS})"
)
def html_page_parts(spark: SparkSession, d: str) -> DataFrame:
    """Headings, emphasis, links of all kinds, lists and code as Markdown and as plain text."""
    page = _html(
        "<h1>Page ", "{doc_id}", "</h1><p>Text <b>", "{l}", "</b> and <a href='https://x.invalid/", "{s}", "'>link</a> end</p><ul><li>one ", "{l}", "</li><li>two</li></ul><ol><li>first</li></ol>",
        "<p><a href='javascript:x()'>call</a> and <a href='file:///etc/x'>file</a> and <a href='tel:", "{doc_id}", "'>tel</a></p><pre>x = ", "{doc_id}", "</pre>",
    )
    return html.html_to_result(_fields(spark, d).withColumn("html", page), id_col="doc_id").select(F.col("doc_key").alias("doc_id"), "markdown", "text")


_EXT = "CASE kind WHEN 0 THEN '.png' WHEN 1 THEN '.jpg' ELSE '.webp' END"
_MIME = "CASE kind WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' ELSE 'image/webp' END"
_PATH = f"'images/' || doc_id || '-' || substr(sha256(doc_id || s), 1, 12) || {_EXT}"


def _illustrated(spark: SparkSession, d: str) -> DataFrame:
    f = _fields(spark, d).withColumn("kind", F.col("doc_id") % 3).withColumn("mime", F.element_at(F.array(F.lit("image/png"), F.lit("image/jpeg"), F.lit("image/webp")), (F.col("kind") + 1).cast("int")))
    f = f.withColumn("b64", F.base64(F.concat(F.col("doc_id").cast("string"), "s").cast("binary")))
    page = _html("<figure><img src='data:", "{mime}", ";base64,", "{b64}", "' alt='", "{l}", "' title='", "{s}", "'><figcaption>Figure ", "{doc_id}", "</figcaption></figure><p>after <img src='data:broken'> <img src='https://x.invalid/", "{s}", "' title='t'></p>")
    return html.html_to_result(f.withColumn("html", page), id_col="doc_id")


@query(f"SELECT doc_id, {_PATH} AS path, {_MIME} AS mime, sha256(doc_id || s) AS sha256, l AS alt, s AS title, 'Figure ' || doc_id AS caption FROM (SELECT *, doc_id % 3 AS kind FROM ({_FIELDS}))")
def html_images(spark: SparkSession, d: str) -> DataFrame:
    """Embedded images: bytes, type, extension, content address, caption."""
    i = _illustrated(spark, d).select(F.col("doc_key").alias("doc_id"), F.explode("images").alias("i"))
    return i.select("doc_id", *[f"i.{c}" for c in ("path", "mime", "sha256", "alt", "title", "caption")])


@query(f"SELECT doc_id, '![' || l || '](' || {_PATH} || ') _Figure ' || doc_id || '_' || chr(10) || chr(10) || 'after [image: invalid-data-uri] ![t](https://x.invalid/' || s || ')' AS markdown FROM (SELECT *, doc_id % 3 AS kind FROM ({_FIELDS}))")
def html_image_markdown(spark: SparkSession, d: str) -> DataFrame:
    """Images and placeholders within the Markdown; the figure's caption is taken once."""
    r = _illustrated(spark, d)
    return r.select(F.col("doc_key").alias("doc_id"), F.regexp_replace("markdown", "\n\nFigure \\d+\n\n", "\n\n").alias("markdown"))


# ---- chunks: nothing is lost, sizes hold

_WORDS_SQL = "len(list_filter(string_split_regex(coalesce(text, ''), '[ \\n\\t\\r]+'), lambda x: x <> ''))"


@query("SELECT doc_id::VARCHAR AS doc_id, text, true AS fits, true AS numbered FROM documents WHERE text IS NOT NULL")
def chunk_recursive_whole(spark: SparkSession, d: str) -> DataFrame:
    """Chunks without overlap, joined in order, give the document again; all are within the size and numbered through."""
    c = chunking.recursive_chunks(table(spark, d, "documents"), 60, 0)
    m = c.select(F.col("metadata")["doc_id"].alias("doc_id"), F.col("metadata")["order"].cast("int").alias("o"), F.col("metadata")["tok"].cast("int").alias("tok"), "text", "id")
    g = m.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("o", "text", "id"))).alias("x"), F.max("tok").alias("most"))
    numbered = F.forall(F.transform("x", lambda v, i: (v["o"] == i) & (v["id"] == F.concat(F.col("doc_id"), F.lit(":"), F.lpad(i.cast("string"), 6, "0")))), lambda v: v)
    return g.select("doc_id", F.array_join(F.transform("x", lambda v: v["text"]), "").alias("text"), (F.col("most") <= 60).alias("fits"), numbered.alias("numbered"))


#: Rank file of a public byte-level tokenizer, on every worker.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@query("SELECT doc_id::VARCHAR AS doc_id, text FROM documents WHERE text IS NOT NULL")
def chunk_recursive_bytes(spark: SparkSession, d: str) -> DataFrame:
    """The same with lengths in byte-pair tokens, which hold for the sum of the pieces of a chunk."""
    c = chunking.RecursiveChunker(80, 0, vocabulary=VOCABULARY).chunk(table(spark, d, "documents"))
    m = c.select(F.col("metadata")["doc_id"].alias("doc_id"), F.col("metadata")["order"].cast("int").alias("o"), "text")
    g = m.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("o", "text"))).alias("x"))
    return g.select("doc_id", F.array_join(F.transform("x", lambda v: v["text"]), "").alias("text"))


@query("SELECT doc_id::VARCHAR AS doc_id, 'first part of ' || doc_id AS a, 'second one' AS b, lang AS own, doc_id::VARCHAR AS doc FROM documents")
def chunk_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """The coarsest separator that suffices cuts; the document's own metadata stays, but for the chunker's three fields."""
    page = _html("first part of ", "{doc_id}", "\n\nsecond one")
    meta = F.map_filter(F.create_map(F.lit("lang"), F.col("lang"), F.lit("doc_id"), F.lit("other")), lambda _, v: v.isNotNull())
    c = chunking.recursive_chunks(table(spark, d, "documents").withColumn("text", page).withColumn("m", meta), 8, 0, metadata="m")
    g = c.groupBy(F.col("metadata")["doc_id"].alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("id", "text"))).alias("x"), F.max(F.try_element_at("metadata", F.lit("lang"))).alias("own"), F.max(F.col("metadata")["doc_id"]).alias("doc"))
    return g.select("doc_id", F.trim(F.regexp_replace(F.col("x")[0]["text"], "\n", " ")).alias("a"), F.trim(F.regexp_replace(F.col("x")[1]["text"], "\n", " ")).alias("b"), "own", "doc")


# ---- embedding

_EMBED = (
    "{n}_w AS (SELECT id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]+')) AS w FROM {src}), "
    "{n}_s AS (SELECT id, ('0x' || substr(md5(w), 1, 8))::BIGINT % 64 AS k, sum(CASE WHEN ('0x' || substr(md5(w), 9, 1))::BIGINT % 2 = 1 THEN 1.0 ELSE -1.0 END)::DOUBLE AS v FROM {n}_w GROUP BY ALL), "
    "{n}_n AS (SELECT id, sqrt(sum(v * v)) AS n FROM {n}_s GROUP BY id), "
    "{n} AS (SELECT id, list(coalesce(v / nullif(n, 0), 0.0) ORDER BY i) AS v FROM (SELECT id, i FROM {src}, range(64) r(i)) g LEFT JOIN {n}_s s USING (id) JOIN_ON LEFT JOIN {n}_n USING (id) GROUP BY id)"
)


def _embed_sql(n: str, src: str) -> str:
    s = _EMBED.format(n=n, src=src)
    return s.replace(f"LEFT JOIN {n}_s s USING (id) JOIN_ON", f"LEFT JOIN {n}_s s ON s.id = g.id AND s.k = g.i").replace(f"LEFT JOIN {n}_n USING (id) GROUP BY id", f"LEFT JOIN {n}_n z ON z.id = g.id GROUP BY g.id").replace(
        f"{n} AS (SELECT id, list", f"{n} AS (SELECT g.id, list"
    )


_DOCS = "docs AS (SELECT doc_id AS id, text FROM documents WHERE text IS NOT NULL), items AS (SELECT item_id AS id, text FROM eval_items)"


@query(f"WITH {_DOCS}, {_embed_sql('e', 'docs')} SELECT id, list_transform(v, lambda x: x::FLOAT::DOUBLE) AS vector FROM e")
def embed_resolved(spark: SparkSession, d: str) -> DataFrame:
    """Texts without given vectors are embedded by the stand-in, a batch at a time."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("document")).filter("document is not null")
    return resolve_vectors(docs, hashing_embedder()).select("id", F.col("vector").cast("array<double>").alias("vector"))


@query(f"WITH {_DOCS}, {_embed_sql('e', 'docs')} SELECT id, list_transform(v, lambda x: x::FLOAT::DOUBLE) AS vector FROM e")
def hash_embed(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").filter("text is not null")
    return embed_table(hashing_embedder(), docs, "doc_id", "text").select("id", F.col("vector").cast("array<double>").alias("vector"))


_FLOATS = "list_transform({t}.v, lambda x: x::FLOAT::DOUBLE)"


@query(
    f"WITH {_DOCS}, {_embed_sql('e', 'docs')}, {_embed_sql('f', 'items')}, a AS (SELECT id, {_FLOATS.format(t='e')} AS v FROM e), b AS (SELECT id, {_FLOATS.format(t='f')} AS v FROM f), "
    "s AS (SELECT b.id AS query_id, a.id, round(list_dot_product(a.v, b.v) / coalesce(nullif(sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v)), 0), 1), 5) + 0.0 AS score FROM a, b) "
    "SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score FROM s) WHERE rank <= 5"
)
def dense_text_search(spark: SparkSession, d: str) -> DataFrame:
    """Documents and items embedded by the stand-in, then searched by cosine."""
    docs = embed_table(hashing_embedder(), table(spark, d, "documents").filter("text is not null"), "doc_id", "text")
    items = embed_table(hashing_embedder(), table(spark, d, "eval_items"), "item_id", "text")
    return search.knn(docs, items.select(F.col("id").alias("query_id"), "vector"), 5, "cosine", digits=5)


# ---- collections and their keyword search


@query("SELECT count(*) AS n, (SELECT count(*) FROM documents WHERE lang = 'pt') AS pt FROM documents")
def collection_count(spark: SparkSession, d: str) -> DataFrame:
    store, name = collections.open_store(spark, "memory"), f"count-{uuid.uuid4().hex}"
    pages = _pages(spark, d)
    store.upsert(name, pages)
    n = store.count(name)
    store.delete(name, where={"lang": "pt"})
    return spark.createDataFrame([(n, n - store.count(name))], "n BIGINT, pt BIGINT")


@query("SELECT doc_id::VARCHAR AS id, text AS document, NULL::DOUBLE AS score FROM documents WHERE doc_id IN (SELECT doc_id FROM review_labels)")
def get_ids(spark: SparkSession, d: str) -> DataFrame:
    """``get`` by a list of ids, without the vectors."""
    store, name = collections.open_store(spark, "memory"), f"ids-{uuid.uuid4().hex}"
    store.upsert(name, _pages(spark, d))
    ids = [str(r[0]) for r in table(spark, d, "review_labels").select("doc_id").distinct().limit(100_000).collect()]  # a stated list
    return store.get(name, ids=ids, include_vectors=False).select("id", "document", "score")


_SAME_IDS = "SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id::VARCHAR) AS rank, id::VARCHAR AS id, score FROM"


@query(f"WITH {_BASE}, {_SPARSE_BASE}, {_SPARSE.format(k=1_000_000, where='')} SELECT * FROM ({_SAME_IDS} sparse) WHERE rank <= {TOP}")
def native_keyword_search(spark: SparkSession, d: str) -> DataFrame:
    """The store's own sparse index behind the common interface: vectors are stored at upsert, a search reads no text."""
    store, name = collections.open_store(spark, "memory", keyword=True), f"native-{uuid.uuid4().hex}"
    store.upsert(name, _pages(spark, d))
    hits = keyword.NativeKeywordIndex(store, name).search(_eval_queries(spark, d), TOP)
    return hits.withColumn("score", F.round("score", 6))


_CHANGED = (
    "docs AS (SELECT doc_id AS item, doc_id::VARCHAR AS key, CASE WHEN lang = 'pt' THEN title ELSE text END AS text, 0 AS batch FROM documents WHERE NOT coalesce(doc_id % 7 = 3, false)), "
)


@query(
    f"WITH {_CHANGED} {_tok('t', 'docs', 'item')}, {_tok('q', 'eval_items', 'item_id')}, {_OKAPI.format(k=1_000_000)} SELECT * FROM ({_SAME_IDS} okapi_all) WHERE rank <= {TOP}"
)
def keyword_index_changes(spark: SparkSession, d: str) -> DataFrame:
    """The in-memory style index after an upsert, replacements that keep their places, and deletions."""
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "text", "lang", "title")
    index = keyword.KeywordIndex(docs)
    index.upsert(docs.filter("lang = 'pt'").select("id", F.col("title").alias("text")))
    index.delete([str(r[0]) for r in table(spark, d, "documents").filter("doc_id % 7 = 3").select("doc_id").toLocalIterator()])  # a stated list
    return index.search(_eval_queries(spark, d), TOP).withColumn("score", F.round("score", 6))


# ---- reranking

_SIM = "list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v)))"
_HITS20 = (
    "WITH RECURSIVE e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings), "
    "h AS (SELECT * FROM (SELECT q.id AS query_id, row_number() OVER (PARTITION BY q.id ORDER BY round(list_dot_product(q.v, e.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(e.v, e.v))), 6) DESC, e.id) AS rank, e.id, "
    "round(list_dot_product(q.v, e.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(e.v, e.v))), 6) AS score, e.v FROM e AS q, e WHERE q.id % 100 = 0) WHERE rank <= 20), "
    f"s AS (SELECT a.query_id, a.rank AS x, b.rank AS y, CASE WHEN a.rank = b.rank THEN 1.0 ELSE {_SIM} END AS sim FROM h a JOIN h b USING (query_id)), "
)
_MMR = _HITS20 + (
    "p AS (SELECT query_id, 1 AS n, [arg_max(rank, {{'s': {rel}, 'r': -rank}})] AS picked FROM h GROUP BY query_id "
    "UNION ALL SELECT p.query_id, p.n + 1, list_append(p.picked, (SELECT arg_max(c.rank, {{'s': c.value, 'r': -c.rank}}) FROM ("
    "SELECT h.query_id, h.rank, 0.5 * ({rel}) - 0.5 * (SELECT max(s.sim) FROM s WHERE s.query_id = h.query_id AND s.x = h.rank AND list_contains(p.picked, s.y)) AS value FROM h WHERE h.query_id = p.query_id AND NOT list_contains(p.picked, h.rank)) c)) "
    "FROM p WHERE p.n < 8) "
    "SELECT query_id, unnest(generate_series(1, 8)) AS new_rank, unnest(picked) AS old_rank FROM p WHERE n = 8"
)


def _hits20(spark: SparkSession, d: str) -> DataFrame:
    e, q = _vectors(spark, d)
    return search.knn(e, q, 20, "cosine", digits=6).join(e.select("id", "vector"), "id")


@query(_MMR.format(rel="score"))
def mmr_rerank(spark: SparkSession, d: str) -> DataFrame:
    return rerank.MmrReranker().rerank(_hits20(spark, d))


@query(_MMR.format(rel="1.0 - (1.0 - score)"))
def mmr_rerank_distances(spark: SparkSession, d: str) -> DataFrame:
    """The same from distances, which are turned into ``1 - distance``."""
    return rerank.MmrReranker(higher_is_better=False).rerank(_hits20(spark, d).withColumn("score", 1.0 - F.col("score")))


_BLANK = "[\\s\\x{b}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"


def _bag(c: str) -> str:
    return f"list_distinct(list_filter(string_split_regex(lower(coalesce({c}, '')), '{_BLANK}'), lambda x: x <> ''))"


@query(
    f"WITH {_BASE}, {_OKAPI.format(k=TOP)}, w AS (SELECT o.query_id, o.rank AS old_rank, {_bag('i.text')} AS a, {_bag('d.text')} AS b FROM okapi o JOIN documents d ON d.doc_id = o.id JOIN eval_items i ON i.item_id = o.query_id), "
    "s AS (SELECT query_id, old_rank, round(coalesce(len(list_intersect(a, b))::DOUBLE / nullif(len(a), 0), 0.0), 6) AS score FROM w) "
    "SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, old_rank) AS new_rank, old_rank, score FROM s) WHERE new_rank <= 5"
)
def pair_rerank(spark: SparkSession, d: str) -> DataFrame:
    """By the share of query words in a hit's document, or its metadata where it has none."""
    docs, qs = table(spark, d, "documents"), _eval_queries(spark, d)
    even = F.col("doc_id") % 2 == 0
    own = docs.select(F.col("doc_id").alias("id"), F.when(even, F.col("text")).alias("document"), F.when(~even & F.col("text").isNotNull(), F.create_map(F.lit("document"), F.col("text"))).alias("metadata"))
    hits = keyword.okapi(docs, qs, TOP, id_col="doc_id", digits=6).join(own, "id").join(qs.select("query_id", F.col("text").alias("query")), "query_id")
    return rerank.PairReranker(rerank.overlap_scorer).rerank(hits, 5).withColumn("score", F.round("score", 6))


# ---- payloads, sinks, ingest


@query(
    "WITH r AS (SELECT id, document, map_entries(metadata) AS m FROM stored_records), "
    "p AS (SELECT id, unnest(list_concat(list_filter(coalesce(m, []), lambda e: e.key <> '_kb_id' AND (e.key <> 'document' OR document IS NULL)), CASE WHEN document IS NULL THEN [] ELSE [{'key': 'document', 'value': document}] END, [{'key': '_kb_id', 'value': id}])) AS e FROM r) "
    "SELECT id, e.key AS key, e.value AS value, e.key <> '_kb_id' AS kept FROM p"
)
def payload_fields(spark: SparkSession, d: str) -> DataFrame:
    """The payload of every record, and which of its fields come back as metadata."""
    r = table(spark, d, "stored_records").select("id", collections.payload(F.col("metadata"), F.col("document"), F.col("id")).alias("p"))
    r = r.select("id", collections.record_metadata(F.col("p")).alias("m"), F.explode("p").alias("key", "value"))
    return r.select("id", "key", "value", F.coalesce(F.map_contains_key("m", F.col("key")), F.lit(False)).alias("kept"))


@query(
    "SELECT '{\"o_orderkey\":' || o_orderkey || ',\"o_orderstatus\":\"' || o_orderstatus || '\",\"o_orderdate\":\"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '\",\"day\":\"' || strftime(o_orderdate, '%Y-%m-%d') || '\",\"price\":\"' || (o_totalprice::DECIMAL(18,2))::VARCHAR || '\",\"gone\":null}' AS json FROM orders"
)
def json_sink_lines(spark: SparkSession, d: str) -> DataFrame:
    """Times as ISO text, decimals as text, nulls written out."""
    o = table(spark, d, "orders")
    return ingest.json_lines(o.select("o_orderkey", "o_orderstatus", "o_orderdate", F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"), F.lit(None).cast("string").alias("gone")))


@query("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_regionkey >= 1")
def ingest_streamed(spark: SparkSession, d: str) -> DataFrame:
    """Rows one after the other through the driver, as a streamed read of a small table gives them."""
    for n in ("nation", "region"):
        table(spark, d, n).createOrReplaceTempView(n)
    with ingest.SqlIngestor(spark, stream=True) as i:
        rows = i.ingest("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_regionkey >= :low", {"low": 1})
        return spark.createDataFrame(list(rows), "n_nationkey BIGINT, n_name STRING, r_name STRING")


@query("SELECT c_nationkey, count(*) AS n FROM customer WHERE c_custkey > 10 GROUP BY c_nationkey")
def ingest_waiting(spark: SparkSession, d: str) -> DataFrame:
    """The asynchronous read."""
    table(spark, d, "customer").createOrReplaceTempView("customer")
    with ingest.SqlIngestor(spark) as i:
        return i.a_ingest("SELECT c_nationkey, count(*) AS n FROM customer WHERE c_custkey > :low GROUP BY c_nationkey", {"low": 10}).result()


@query("SELECT count(*) AS inserted, count(*) FILTER (WHERE n_regionkey = 2) AS changed, sum(CASE WHEN n_regionkey = 2 THEN 0 ELSE n_nationkey END)::BIGINT AS total FROM nation")
def ingest_jdbc(spark: SparkSession, d: str) -> DataFrame:
    """A database behind JDBC: statements with row counts, then a read with bound values. Its 25 rows are a fixed table.

    The database is one that runs inside the driver, which reads it itself where executors are other processes.
    """
    from tessera.session import checkpoint_dir

    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    path = checkpoint_dir(spark).removeprefix("file:") if checkpoint_dir(spark).startswith("file:") else f"memory:{uuid.uuid4().hex}"
    with ingest.SqlIngestor(spark, f"jdbc:derby:{path}{'/' if '/' in path else ''}db{uuid.uuid4().hex};create=true") as i:
        i.ingest("CREATE TABLE nations (k BIGINT, name CLOB, region BIGINT)")
        rows = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey").toLocalIterator()
        put = sum(i.ingest("INSERT INTO nations VALUES (:k, :n, :r)", {"k": r[0], "n": r[1], "r": r[2]})["rowcount"] for r in rows)
        changed = i.ingest("UPDATE nations SET k = 0 WHERE region = :r", {"r": 2})["rowcount"]
        got = i.ingest("SELECT SUM(k) AS total FROM nations WHERE k >= :low OR k < :low", {"low": 0})  # every region counts, none too
        return got.select(F.lit(put).cast("bigint").alias("inserted"), F.lit(changed).cast("bigint").alias("changed"), F.col(got.columns[0]).cast("bigint").alias("total"))


@query("SELECT doc_id, CASE WHEN length(f) <= 40 THEN f ELSE rtrim(regexp_extract(substr(f, 1, 40), '(?s)^(.{0,39})(?: |$)', 1)) || '…' END AS snippet FROM (SELECT doc_id, trim(regexp_replace(coalesce(title, ''), '\\s+', ' ', 'g')) AS f FROM documents)")
def result_snippets(spark: SparkSession, d: str) -> DataFrame:
    """The shortened texts of a printed result list."""
    return table(spark, d, "documents").select("doc_id", postprocess.snippet("title", 40).alias("snippet"))
