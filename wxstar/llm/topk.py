"""Exact top-k neighbours of binary codes by incremental multi-index hashing.

Vectors become 64-bit sign codes. The code is cut into m segments of 64/m bits, about log2 of the number of
codes (16 at most), and every distinct code is indexed under each of its segments. Queries
search their segments at radius 0, 1, 2, ...: after radius r, every code within distance m(r + 1) - 1 has been met (one
of its segments differs in at most r bits), so a query is finished once its kth
verified distance is at most that. Only unfinished queries go on.

Every query starts with an upper bound of its kth distance, taken against ``SEED`` sampled
codes; a probed code further away is dropped inside the join. The bound only shortens
the work: each verified result tightens it, and the stop rule above rests on verified
distances alone. Rows that share a code are indexed once, with their k smallest ids: ties
are broken by id, so no later id can enter. That keeps a code held by a third of
all rows small before any candidate is made.

Defined results: null ids or vectors, and vectors whose length isn't 64, are not indexed and not asked; zeros, NaN and null
elements give bit 0. A repeated id counts once for each different code. Fewer than k rows: all are returned. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxstar.llm.common import discard, materialize

BITS = 64
SEED = 4096  # sampled codes for the first bound of the kth distance
LEAST_SEGMENTS, MOST_SEGMENTS = 4, 8
SEED = 4096


def sign_codes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, code): bit i is 1 where element i is above 0."""
    v = F.col(vector_col)
    bit = lambda i: F.when((v[i] > 0) & ~F.isnan(v[i]), F.lit(1 << i if i < 63 else -(1 << 63))).otherwise(F.lit(0)).cast("bigint")
    code = bit(0)
    for i in range(1, BITS):
        code = code.bitwiseOR(bit(i))
    return vectors.where(F.col(id_col).isNotNull() & (F.size(v) == BITS)).select(
        F.col(id_col).alias("id"), code.alias("code"))


def segment_bounds(rows: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment, for an index of so many codes."""
    m = max(LEAST_SEGMENTS, min(MOST_SEGMENTS, math.ceil(BITS / math.log2(max(rows, 2)))))
    cut = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def by_segment(df: DataFrame, code: str, bounds: list[tuple[int, int]]) -> DataFrame:
    """A row for each segment of ``code``: (the columns of df, seg, value)."""
    value = lambda at, width: F.shiftrightunsigned(code, at).bitwiseAND(F.lit((1 << width) - 1)).cast("int")
    parts = F.array(*(F.struct(F.lit(s).alias("seg"), value(*b).alias("value")) for s, b in enumerate(bounds)))
    return df.select("*", F.explode(parts).alias("__part")).select(*df.columns, "__part.seg", "__part.value")


def numbers(values: list[int], kind: str) -> Column:
    """A literal array, made of one string (a literal for each element is slow to plan)."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def flips(radius: int, bounds: list[tuple[int, int]]) -> Column:
    """All masks with ``radius`` bits set, for the width of the row's segment."""
    by_width = {w: numbers([m for m in range(1 << w) if m.bit_count() == radius], "int") if radius <= w else F.array().cast("array<int>")
                for w in {w for _, w in bounds}}
    out = None
    for s, (_, w) in enumerate(bounds):
        out = F.when(F.col("seg") == s, by_width[w]) if out is None else out.when(F.col("seg") == s, by_width[w])
    return out


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k rows nearest to each query, ties by id."""
    by_id = Window.partitionBy("code").orderBy("id")
    index = materialize(
        codes.distinct().withColumn("__n", F.row_number().over(by_id)).where(F.col("__n") <= k)
        .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "mih-index")
    bounds = segment_bounds(index.count())
    posted = by_segment(index.select("code"), "code", bounds).withColumnRenamed("code", "found").withColumnRenamed("value", "near")
    seed = [r[0] for r in index.select("code").orderBy(F.xxhash64("code"), "code").limit(SEED).collect()]
    if not seed:
        return codes.sparkSession.createDataFrame([], "query_id bigint, rank int, neighbor_id bigint, distance int")
    k_here = min(k, sum(len(r[0]) for r in index.select("ids").limit(k).collect()))  # fewer rows than k
    apart = lambda a, b: F.bit_count(a.bitwiseXOR(b))
    if len(seed) >= k_here:
        to_seed = F.sort_array(F.transform(numbers(seed, "bigint"), lambda c: apart(F.col("code"), c)))
        bound = F.element_at(to_seed, k_here)
    else:
        bound = F.lit(BITS)
    asked = materialize(queries.select("code").distinct().withColumn("bound", bound), "mih-queries")
    waiting, best = asked, None
    for radius in range(max(w for _, w in bounds) + 1):
        probes = by_segment(waiting, "code", bounds).withColumn("__flip", F.explode(flips(radius, bounds))).select(
            "seg", F.col("value").bitwiseXOR(F.col("__flip")).alias("near"), "code", "bound")
        # exploded sides look small to the planner: without the hint it may broadcast them
        met = probes.hint("merge").join(posted.hint("merge"), ["seg", "near"]).where(apart(F.col("code"), F.col("found")) <= F.col("bound")).select(
            "code", "found").distinct()
        rows = met.join(index.withColumnRenamed("code", "found"), "found").select(
            "code", apart(F.col("code"), F.col("found")).alias("distance"), F.explode("ids").alias("id"))
        rows = rows if best is None else rows.unionByName(best).distinct()
        nearest = Window.partitionBy("code").orderBy("distance", "id")
        now = materialize(rows.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).drop("rank"), "mih-best")
        if best is not None:
            discard(best)
        best = now
        kth = best.groupBy("code").agg(F.count(F.lit(1)).alias("__held"), F.max("distance").alias("__last"))
        proven = (F.coalesce("__held", F.lit(0)) >= k_here) & (F.col("__last") <= len(bounds) * (radius + 1) - 1)
        waiting = asked.join(kth, "code", "left").where(~F.coalesce(proven, F.lit(False))).select(
            "code", F.when(F.col("__held") >= k_here, F.least("bound", "__last")).otherwise(F.col("bound")).alias("bound"))
        if waiting.isEmpty():
            break
    place = Window.partitionBy("code").orderBy("distance", "id")
    answers = best.withColumn("rank", F.row_number().over(place))
    return queries.select(F.col("id").alias("query_id"), "code").join(answers, "code").select(
        "query_id", "rank", F.col("id").alias("neighbor_id"), "distance")


def search(vectors: DataFrame, every: int = 20, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The rows whose id is divisible by ``every`` are the queries; all rows answer (a query finds itself too)."""
    codes = sign_codes(vectors, id_col, vector_col).withColumn("id", F.col("id").cast("bigint"))
    return top_k(codes, codes.where(F.col("id") % every == 0), k)
