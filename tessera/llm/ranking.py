"""One ranking from several differently scaled scores.

Each score becomes its percentile within its query and lane (ties averaged), then a normal score; an item is ordered by
the weighted mean over the lanes that the query has. Ranks are counted without putting a query into one task: scores are
range-partitioned, ranked inside a partition, and shifted by the counts of the partitions before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import stored, table

#: Coefficients of a rational approximation of the inverse normal distribution (relative error under 1.2e-9).
_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0)
_LOW = 0.02425


def _poly(c: tuple, x: Column) -> Column:
    out = F.lit(c[0])
    for k in c[1:]:
        out = out * x + k
    return out


def inverse_normal(p: Column) -> Column:
    """Quantile of the standard normal distribution for 0 < p < 1."""
    tail = F.least(p, 1 - p)
    q = F.sqrt(-2 * F.log(F.greatest(tail, F.lit(1e-300))))
    low = _poly(_C, q) / _poly(_D, q)
    r = p - 0.5
    mid = _poly(_A, r * r) * r / _poly(_B, r * r)
    return F.when(tail >= _LOW, mid).otherwise(F.when(p < 0.5, low).otherwise(-low))


def best_hits(hits: DataFrame) -> DataFrame:
    """``query_id, lane, id, s``: each hit once with its best score; ``s`` is higher for better. Null and NaN scores are left out.

    hits: ``query_id, lane, id, score, higher_is_better``.
    """
    h = hits.filter("id is not null and score is not null and not isnan(score)")
    return h.select("query_id", "lane", "id", F.when(F.col("higher_is_better"), F.col("score")).otherwise(-F.col("score")).alias("s")).groupBy("query_id", "lane", "id").agg(F.max("s").alias("s"))


def percentiles(best: DataFrame) -> DataFrame:
    """``query_id, lane, id, better, equal, n, p``: how many of the lane are better, how many equal (itself included), and the percentile."""
    g = ["query_id", "lane"]
    counted = best.groupBy(*g, "s").agg(F.count("*").alias("equal"))
    placed = stored(counted.repartitionByRange(*g, "s").withColumn("part", F.spark_partition_id()))
    totals = placed.groupBy(*g, "part").agg(F.sum("equal").alias("m"))
    w = Window.partitionBy(*g).orderBy("part")  # at most one row per partition
    before = totals.select(*g, "part", (F.sum("m").over(w) - F.col("m")).alias("before"), F.sum("m").over(Window.partitionBy(*g)).alias("n"))
    inside = placed.withColumn("run", F.sum("equal").over(Window.partitionBy("part", *g).orderBy("s")))
    j = inside.join(before, [*g, "part"])
    below = F.col("before") + F.col("run") - F.col("equal")
    r = j.select(*g, "s", "equal", "n", (F.col("n") - below - F.col("equal")).alias("better"), ((below + F.col("equal") / 2) / F.col("n")).alias("p"))
    return best.join(r, [*g, "s"]).select(*g, "id", "better", "equal", "n", "p")


def combined_ranking(hits: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``query_id, rank, id, score, lanes, query_lanes, wins, ceiling``.

    score: weighted mean of the normal scores over the lanes of the query; in a lane without the item it counts with the
    lane's least normal score. wins: lanes in which the item is strictly the best. ceiling: the score of an item that is
    among the best in every lane. Ties of the score go by smaller id. A
    lane without usable scores does not exist; a query without one gives no row. Extra columns are ignored.
    """
    p = percentiles(best_hits(hits)).withColumn("z", inverse_normal(F.col("p")))
    weight = F.lit(1.0)
    for lane, x in (weights or {}).items():
        weight = F.when(F.col("lane") == lane, F.lit(float(x))).otherwise(weight)
    p = stored(p)
    lanes = p.groupBy("query_id", "lane").agg(F.min("z").alias("least"), F.max("z").alias("most")).withColumn("w", weight)
    per = lanes.groupBy("query_id").agg(F.count("*").alias("query_lanes"), F.sum("w").alias("all"), F.sum(F.col("w") * F.col("least")).alias("floor"), F.sum(F.col("w") * F.col("most")).alias("top"))
    j = p.join(lanes, ["query_id", "lane"])
    i = j.groupBy("query_id", "id").agg(F.count("*").alias("lanes"), F.sum(F.col("w") * (F.col("z") - F.col("least"))).alias("above"), F.sum(((F.col("better") == 0) & (F.col("equal") == 1)).cast("int")).alias("wins"))
    s = i.join(per, "query_id").select("query_id", "id", F.round((F.col("floor") + F.col("above")) / F.col("all"), 9).alias("score"), "lanes", "query_lanes", "wins", (F.col("top") / F.col("all")).alias("ceiling"))
    return _ranked(s)


def _ranked(s: DataFrame) -> DataFrame:
    """``rank`` within the query by score, then id, counted over range partitions."""
    placed = stored(s.withColumn("down", -F.col("score")).repartitionByRange("query_id", "down", "id").withColumn("part", F.spark_partition_id()))
    totals = placed.groupBy("query_id", "part").agg(F.count("*").alias("own"))
    before = totals.select("query_id", "part", (F.sum("own").over(Window.partitionBy("query_id").orderBy("part")) - F.col("own")).alias("before"))
    inside = placed.withColumn("r", F.row_number().over(Window.partitionBy("part", "query_id").orderBy("down", "id")))
    j = inside.join(before, ["query_id", "part"])
    return j.select("query_id", (F.col("before") + F.col("r")).cast("bigint").alias("rank"), "id", "score", "lanes", "query_lanes", "wins", "ceiling")


def all_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = table(spark, sf_dir, "keyword_matches").select("query_id", F.lit("keyword").alias("lane"), "id", "score", F.lit(True).alias("higher_is_better"))
    d = table(spark, sf_dir, "dense_hits").select("query_id", F.col("metric").alias("lane"), "id", "score", (F.col("metric") != "l2").alias("higher_is_better"))
    return k.unionByName(d)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First of the ranking with the greatest score that its query allows, and shared with nobody in any lane."""
    r = combined_ranking(all_hits(spark, sf_dir))
    return r.filter("rank = 1 and abs(score - ceiling) < 1e-8 and wins = query_lanes").select("query_id", "id")


def p5_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combined_ranking(all_hits(spark, sf_dir)).select("query_id", "rank", "id", (F.round("score", 6) + 0.0).alias("score"))


P5_SQL = """
WITH h AS (SELECT query_id, 'keyword' AS lane, id, score AS s FROM keyword_matches UNION ALL SELECT query_id, metric, id, CASE WHEN metric = 'l2' THEN -score ELSE score END FROM dense_hits),
b AS (SELECT query_id, lane, id, max(s) AS s FROM h WHERE s IS NOT NULL AND NOT isnan(s) AND id IS NOT NULL GROUP BY ALL),
r AS (SELECT query_id, id, rank() OVER (PARTITION BY query_id, lane ORDER BY s DESC) AS r, count(*) OVER (PARTITION BY query_id, lane, s) AS e FROM b),
n AS (SELECT query_id, count(DISTINCT lane) AS n FROM b GROUP BY 1)
SELECT r.query_id, r.id FROM r JOIN n USING (query_id) GROUP BY r.query_id, r.id, n.n HAVING sum(CASE WHEN r = 1 AND e = 1 THEN 1 ELSE 0 END) = n.n
"""
