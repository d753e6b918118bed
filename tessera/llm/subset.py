"""Choosing a varied subset.

Records are counted by category combinations: a region of the vector space (centroids fitted on a bounded sample) and a
collection. A minimum-cost flow gives each combination its quota: regions and collections have balanced targets, and each further step
above a target costs more (convex). Within a combination records are taken by a fixed rank in which the second and later
records of a group of almost equal vectors come after all first ones, and higher scores come first.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import vectors as V
from tessera.session import cut, table

#: Production parameters: records to choose; records to choose per region of the vector space, fewest and most regions.
SIZE, PER_REGION, LEAST_REGIONS, MOST_REGIONS = 1000, 20, 8, 1024
#: Collections that are categories of their own, or as many as records are chosen if that is more. Further ones share a
#: category: so many records cannot show more collections anyway.
KINDS = 256
SALTS = 32
_STEPS = 8


def _pieces(target: float, room: int) -> list[tuple[int, float]]:
    """Capacity and cost of the steps of a category: free up to the target, then ever dearer."""
    out, base, used, k = [], max(1, int(np.ceil(target))), 0, 0
    while used < room:
        m = min(room - used, base if k == 0 else max(1, base // _STEPS * 2 ** max(0, k - _STEPS)))
        out.append((m, float(k * k)))
        used, k = used + m, k + 1
    return out


def balanced_quotas(counts: dict[tuple[str, str], int], size: int) -> dict[tuple[str, str], int]:
    """How many records of each combination ``(a, b)`` to take: a minimum-cost flow of ``min(size, all)``.

    source -> a (steps) -> (a, b) up to its count -> b (steps) -> sink. Successive cheapest paths with potentials; all orders
    are fixed, so equal input gives equal quotas.
    """
    total = min(size, sum(counts.values()))
    left, right = sorted({a for a, _ in counts}), sorted({b for _, b in counts})
    node = {("s",): 0, ("t",): 1} | {("a", a): 2 + i for i, a in enumerate(left)} | {("b", b): 2 + len(left) + i for i, b in enumerate(right)}
    graph: list[list[int]] = [[] for _ in node]
    to, cap, cost = [], [], []

    def edge(u: int, v: int, c: int, w: float) -> int:
        for x, y, k, z in ((u, v, c, w), (v, u, 0, -w)):
            graph[x].append(len(to))
            to.append(y)
            cap.append(k)
            cost.append(z)
        return len(to) - 2

    for kind, names, pick in (("a", left, 0), ("b", right, 1)):
        room: dict[str, int] = {}
        for k, n in counts.items():
            room[k[pick]] = room.get(k[pick], 0) + n
        for x in names:
            for m, w in _pieces(total / max(1, len(names)), room[x]):
                edge(*((0, node["a", x]) if kind == "a" else (node["b", x], 1)), m, w)
    inner = {k: edge(node["a", k[0]], node["b", k[1]], counts[k], 0.0) for k in sorted(counts)}
    potential = [0.0] * len(node)
    flow = 0
    while flow < total:
        dist, came = [float("inf")] * len(node), [-1] * len(node)
        dist[0], heap = 0.0, [(0.0, 0)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            for e in graph[u]:
                if cap[e] > 0:
                    n = d + cost[e] + potential[u] - potential[to[e]]
                    if n < dist[to[e]] - 1e-12:
                        dist[to[e]], came[to[e]] = n, e
                        heapq.heappush(heap, (n, to[e]))
        if came[1] < 0:
            break
        potential = [p + (d if d < float("inf") else 0.0) for p, d in zip(potential, dist, strict=True)]
        push, v = total - flow, 1
        while v != 0:
            push, v = min(push, cap[came[v]]), to[came[v] ^ 1]
        v = 1
        while v != 0:
            cap[came[v]] -= push
            cap[came[v] ^ 1] += push
            v = to[came[v] ^ 1]
        flow += push
    return {k: cap[e ^ 1] for k, e in inner.items() if cap[e ^ 1] > 0}


def varied_subset(records: DataFrame, size: int = SIZE) -> DataFrame:
    """``id, region, kind, score`` of ``min(size, all)`` records with usable vectors.

    records: ``id, o, vector, collection, score``; the live version of an id counts, identical versions once. A null score
    ranks below all others; a null collection is a kind. Ties go by smaller id.
    """
    c = V.Lists(records.select("id", "o", "vector"), V.CROWD, V.LEAST)
    seen = V.counted(c)
    # almost equal records go by the least hash in sight of each; equal ones have one hash
    leader = seen.groupBy("h").agg(F.min("low").alias("low")).select("h", F.least("h", "low").alias("leader"))
    regions = V.centroids(c.sample, max(LEAST_REGIONS, min(MOST_REGIONS, size // PER_REGION))) if len(c.sample) else c.centroids
    r = records.withColumn("vector", F.col("vector").cast("array<double>")).withColumn("ok", V.usable("vector"))
    r = r.withColumn("h", F.when(F.col("ok"), F.xxhash64("vector"))).select("id", F.struct("o", "collection", "score").alias("o"), "h", "vector")
    kinds = {f.name: f.dataType.simpleString() for f in records.schema}
    r = r.mapInArrow(V.placed(regions), f"id STRING, o STRUCT<o: {kinds['o']}, collection: {kinds['collection']}, score: {kinds['score']}>, h BIGINT, home INT")
    r = V.live(r.select("id", "o.o", "h", F.col("home").cast("string").alias("region"), "o.collection", "o.score"), ["h", "region", "collection", "score"]).filter("h is not null").dropDuplicates(["key", "id"])
    r = r.select("h", "id", "region", F.coalesce("collection", F.lit("-")).alias("kind"), F.when(~F.isnan("score"), F.col("score")).alias("score"))
    r = r.join(leader, "h", "left")
    group = F.coalesce("leader", "h")
    first = F.col("score").desc_nulls_last()
    # best of a crowd first: the single best is found by partial aggregation, the rest are only marked as later ones
    r = cut(r.withColumn("group", group).select("id", "region", "kind", "score", "group"))
    best = r.groupBy("group").agg(F.max(F.struct(F.coalesce("score", F.lit(float("-inf"))).alias("s"), F.lit(0).alias("z"))).alias("m"))
    lead = r.join(best, "group").filter(F.coalesce("score", F.lit(float("-inf"))) == F.col("m.s")).groupBy("group").agg(F.min("id").alias("lead"))
    r = r.join(lead, "group").select("id", "region", "kind", "score", (F.col("id") != F.col("lead")).cast("int").alias("later"))
    names = [x["kind"] for x in r.groupBy("kind").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "kind").limit(max(KINDS, size)).collect()]
    known = F.when(F.col("kind").isin(names), F.col("kind")).otherwise(F.lit("other")) if names else F.col("kind")
    r = r.withColumn("kind", known)
    counts = {(x["region"], x["kind"], x["later"]): x["n"] for x in r.groupBy("region", "kind", "later").agg(F.count("*").alias("n")).collect()}
    want = balanced_quotas({(a, b): n for (a, b, later), n in counts.items() if not later}, size)
    if sum(want.values()) < min(size, sum(counts.values())):  # only then are further records of crowds needed
        both: dict = {}
        for (a, b, _), n in counts.items():
            both[a, b] = both.get((a, b), 0) + n
        want = balanced_quotas(both, size)
    spark = records.sparkSession
    q = spark.createDataFrame([(a, b, n) for (a, b), n in want.items()], "region STRING, kind STRING, quota BIGINT")
    # first within salted shares of a combination, so that none is ranked in one task, then among the few that are left
    few = r.join(F.broadcast(q), ["region", "kind"]).withColumn("salt", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(SALTS)))
    for by in (["region", "kind", "salt"], ["region", "kind"]):
        few = few.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy("later", first, "id"))).filter("n <= quota")
    return few.select("id", "region", "kind", "score")


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "stored_records").filter("id is not null")
    o = F.struct(F.lit(1).alias("s"), F.col("updated_at").alias("u")).alias("o")
    return s.select("id", o, "vector", "collection", "score")


def p7_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return varied_subset(stored(spark, sf_dir))
