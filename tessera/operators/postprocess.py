"""From ranked chunks to parents and to a context text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.ids import parent_of


def group_by_parent(hits: DataFrame, parent: Column | None = None) -> DataFrame:
    """The best-ranked hit of each parent, in the old order, renumbered.

    hits: ``query_id, rank, id`` and, without ``parent``, ``metadata``. All other columns are kept.
    """
    p = parent if parent is not None else parent_of(F.col("metadata"), F.col("id"))
    w = Window.partitionBy("query_id", "__parent").orderBy("rank")
    h = hits.withColumn("__parent", p).withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n", "__parent")
    return h.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("rank")).cast("bigint"))


def resolve_parents(hits: DataFrame, parents: DataFrame) -> DataFrame:
    """Hits with the parent's id and full text in place of the chunk's.

    parents: ``source_path STRING, text STRING``, one row per path. A hit without path or without such a parent has a
    null document. Vectors are dropped and null metadata becomes an empty map.
    """
    h = hits.withColumn("metadata", F.coalesce("metadata", F.create_map().cast("map<string,string>"))).drop("document", "vector")
    h = h.withColumn("id", parent_of(F.col("metadata"), F.col("id"))).withColumn("__path", F.try_element_at("metadata", F.lit("source_path")))
    p = parents.select(F.col("source_path").alias("__path"), F.col("text").alias("document"))
    return h.join(p, "__path", "left").drop("__path")


def context_window(hits: DataFrame, title_field: str = "title") -> DataFrame:
    """``(query_id, context)``: the hits of each query as one text, best first.

    hits: ``query_id, rank, id, score, document, metadata``. Without a score the header says ``n/a``; a null document
    gives an empty body. A query's hits are bounded by its top-k.
    """
    title = F.nullif(F.try_element_at("metadata", F.lit(title_field)), F.lit(""))
    h = hits.select("query_id", "rank", F.col("id").cast("string").alias("id"), F.when(F.col("score").isNull(), F.lit("n/a")).otherwise(F.format_string("%.4f", F.col("score"))).alias("s"), title.alias("t"), F.coalesce("document", F.lit("")).alias("d"))
    g = h.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "s", "t", "d"))).alias("r"))
    block = F.transform("r", lambda x, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] id="), x["id"], F.coalesce(F.concat(F.lit("  title="), x["t"]), F.lit("")), F.lit("  score="), x["s"], F.lit("\n"), x["d"], F.lit("\n")))
    head = F.concat(F.lit("=== RETRIEVED CONTEXT (top "), F.size("r").cast("string"), F.lit(") ===\n"))
    return g.select("query_id", F.concat_ws("\n", F.concat(F.array(head), block)).alias("context"))


def snippet(col: str = "document", width: int = 88) -> Column:
    """The text with runs of blanks as one, cut at a word end and marked with an ellipsis when too wide."""
    flat = F.trim(F.regexp_replace(F.coalesce(F.col(col), F.lit("")), "\\s+", " "))
    cut = F.regexp_extract(F.substring(flat, 1, width), f"^(.{{0,{width - 1}}})(?: |$)", 1)
    return F.when(F.length(flat) <= width, flat).otherwise(F.concat(F.rtrim(cut), F.lit("…")))


def results_text(hits: DataFrame, label: str = "RESULTS", width: int = 88) -> str:
    """A printable listing of a bounded result."""
    rows = hits.orderBy("query_id", "rank").select("rank", "id", "score", snippet("document", width).alias("snippet")).collect()
    line = "═" * 70
    out = [f"\n{line}", f"  {label} — {len(rows)} result(s)", line]
    out += [f"  [{r['rank']}] id={r['id']!s:<20} score={'n/a' if r['score'] is None else format(r['score'], '.4f'):<10} {r['snippet']}" for r in rows]
    return "\n".join([*out, line + "\n"])
