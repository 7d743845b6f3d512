"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into segments; of each, mean and deviation are kept. For segments x, y of length l,
<x, y> <= l * mean(x) * mean(y) + dev(x) * dev(y) with dev the root of summed squared differences from the mean, which is
the same as the lower bound l * (difference of means)^2 + (difference of devs)^2 of their squared distance. Bounds over few,
then more segments drop candidates that cannot reach a query's floor, the k-th best score known; exact scores are computed
for the survivors alone. Floors come from a first block of candidates and rise from there.

Queries and candidates are packed into blocks of bounded size, in the narrowest integers that hold them; each pair of blocks is
one row that any executor can work on, and yields at most k rows for each query. Vectors that are null, empty or hold
null or non-finite components take no part, nor do rows without an id. Only vectors of equal length meet. Every row is
a candidate of every query but itself: repeated rows count as often as they stand there, and repeated queries are answered each.
Equal scores go to the smaller id; scores beyond 64 bits are set to the nearest that fits. Extra columns are ignored, whatever their names. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.llm.common import dropped, small_batches, staged

QUERY_ROWS, CANDIDATE_ROWS, CHUNK = 2048, 8192, 1024
SEGMENTS = (4, 16, 32)
#: Survivors whose vectors are gathered at once.
GATHERED = 1 << 18


def valid(v: Column) -> Column:
    """Not null or empty, all components finite."""
    v = v.cast("array<double>")
    return F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def bounds(x: np.ndarray, segments: int) -> np.ndarray:
    """Segment statistics, such that the inner product of two rows bounds that of the vectors from above."""
    n, d = x.shape
    edges = np.linspace(0, d, min(segments, d) + 1).astype(int)
    size = np.diff(edges)
    mean = np.add.reduceat(x, edges[:-1], 1) / size
    dev = np.sqrt(np.add.reduceat((x - np.repeat(mean, size, 1)) ** 2, edges[:-1], 1))
    return np.concatenate([mean * np.sqrt(size), dev], 1)


def best(q_rows: np.ndarray, q: np.ndarray, c_rows: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int, floor: np.ndarray | None = None, alive: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, candidate place, score) of the k best candidates of each query that reach its ``floor``.

    ``alive`` gathers the pairs met and those left after each level.
    """
    largest = int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) * q.shape[1]
    kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**52 else object
    qx, cx, qf, cf = q.astype(kind), c.astype(kind), q.astype(float), c.astype(float)
    levels = [(bounds(qf, s), bounds(cf, s)) for s in sorted({min(s, q.shape[1]) for s in SEGMENTS})]
    slack = 1e-9 * np.linalg.norm(qf, axis=1)[:, None] * np.linalg.norm(cf, axis=1)[None]  # far above what rounding can take from a bound
    who, at = np.zeros(0, np.int64), np.zeros(0, np.int64)
    score = np.zeros(0, object if kind is object else np.int64)
    floor = np.full(len(q), -np.inf) if floor is None else floor.astype(float)
    for i in range(0, len(c), CHUNK):
        part = slice(i, i + CHUNK)
        live = q_rows[:, None] != c_rows[None, part]
        counts = [live.sum()]
        for a, b in levels:
            some = np.flatnonzero(live.any(1))
            live[some] &= a[some] @ b[part].T + slack[some, part] >= floor[some, None]
            counts.append(live.sum())
        if alive is not None:
            alive.append(counts)
        r, j = np.nonzero(live)
        found = [(qx[r[s : s + GATHERED]] * cx[i + j[s : s + GATHERED]]).sum(1) if kind is object else np.einsum("ij,ij->i", qx[r[s : s + GATHERED]], cx[i + j[s : s + GATHERED]]) for s in range(0, len(r), GATHERED)]
        exact = np.concatenate([np.zeros(0, kind), *found])
        keep = exact >= floor[r]
        r, j, exact = r[keep], j[keep], exact[keep]
        who, at, score = np.concatenate([who, r]), np.concatenate([at, i + j]), np.concatenate([score, exact if kind is object else exact.astype(np.int64)])
        order = np.lexsort((c_rows[at], c_ids[at], -score, who)) if kind is not object else np.array(sorted(range(len(who)), key=lambda x: (who[x], -score[x], c_ids[at[x]], c_rows[at[x]])), int)
        who, at, score = who[order], at[order], score[order]
        rank = np.arange(len(who)) - np.searchsorted(who, np.arange(len(q)))[who]
        kth = np.flatnonzero(rank == k - 1)
        floor[who[kth]] = np.maximum(floor[who[kth]], score[kth].astype(float))
        who, at, score = who[rank < k], at[rank < k], score[rank < k]
    return who, at, score


def packed(v: np.ndarray) -> np.ndarray:
    """In the narrowest integers that hold all values."""
    return v.astype(next(t for t in ("<i1", "<i2", "<i4", "<i8") if v.size == 0 or (np.iinfo(t).min <= v.min() and v.max() <= np.iinfo(t).max)))


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``vectors`` has ``vec_id`` and integer array ``v``. Returns ``query_id, rank, vec_id, score``."""
    small_batches(vectors.sparkSession)
    rows = vectors.where("vec_id is not null and size(v) > 0").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<long>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = staged(rows.withColumns({"d": F.size("v"), "row": F.monotonically_increasing_id()}))
    n, n_queries = rows.agg(F.count("*"), F.count_if("is_query")).first()
    n_q, n_c = max(1, -(-n_queries // QUERY_ROWS)), max(1, -(-n // CANDIDATE_ROWS))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["vec_id", "row"])
        vs = packed(np.stack(pdf["v"].to_numpy()))
        raw = lambda c, t: [pdf[c].to_numpy(t).tobytes()]
        return pd.DataFrame({"d": pdf["d"].iloc[:1], "block": pdf["block"].iloc[:1], "rows": raw("row", "<i8"), "ids": raw("vec_id", "<i8"), "floors": raw("floor", "<f8"), "width": [vs.itemsize], "vs": [vs.tobytes()]})

    def blocks(df: DataFrame, count: int) -> DataFrame:
        keyed = df.select("d", F.pmod(F.xxhash64(F.lit(2), "row"), F.lit(count)).cast("int").alias("block"), "row", "vec_id", "floor", "v")
        return keyed.groupBy("d", "block").applyInPandas(pack, "d int, block int, rows binary, ids binary, floors binary, width int, vs binary")

    def run(batches):
        for batch in batches:
            for b in batch.to_pylist():
                q_rows, c_rows, c_ids = (np.frombuffer(b[x], "<i8") for x in ("q_rows", "c_rows", "c_ids"))
                q, c = (np.frombuffer(b[f"{s}_vs"], f"<i{b[f'{s}_width']}").reshape(-1, b["d"]) for s in ("q", "c"))
                who, at, score = best(q_rows, q.astype(np.int64), c_rows, c_ids, c.astype(np.int64), k, np.frombuffer(b["q_floors"]))
                yield pa.RecordBatch.from_arrays([pa.array(q_rows[who]), pa.array(np.frombuffer(b["q_ids"], "<i8")[who]), pa.array(c_ids[at]), pa.array(c_rows[at]), pa.array(np.clip(score, -(2**63), 2**63 - 1).astype(np.int64) if score.dtype == object else score)], ["row", "query_id", "vec_id", "other", "score"])

    def met(queries: DataFrame, candidates: DataFrame, low: int, high: int) -> DataFrame:
        """Best candidates in the blocks ``low`` to ``high`` (exclusive)."""
        fields = ("rows", "ids", "floors", "width", "vs")
        q = blocks(queries, n_q).select("d", F.col("block").alias("qb"), F.explode(F.sequence(F.lit(low), F.lit(high - 1))).alias("cb"), *(F.col(c).alias(f"q_{c}") for c in fields))
        c = candidates.where(F.col("block").between(low, high - 1)).select("d", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("qb"), F.col("block").alias("cb"), *(F.col(c).alias(f"c_{c}") for c in fields))
        return q.join(c, ["d", "qb", "cb"]).mapInArrow(run, "row long, query_id long, vec_id long, other long, score long")

    none = F.lit(float("-inf")).alias("floor")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "other"))
    top = lambda df: df.withColumn("rank", rank).where(F.col("rank") <= k)
    candidates = staged(blocks(rows.select("*", none), n_c))
    first = staged(met(rows.where("is_query").select("*", none), candidates, 0, 1))
    found = first
    if n_c > 1:
        floors = first.groupBy("row").agg(F.count("*").alias("m"), F.min("score").alias("least")).where(F.col("m") == k).select("row", F.col("least").cast("double").alias("floor"))
        queries = rows.where("is_query").join(floors, "row", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        found = staged(first.unionAll(met(queries, candidates, 1, n_c)), first)
    dropped(rows, candidates)
    return top(found).select("query_id", "rank", "vec_id", "score")


def quantised(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """``vec_id, v`` with floor(scale * x) of each component; only vectors that can take part."""
    v = F.transform(F.col("embedding"), lambda x: F.floor(x.cast("double") * scale))
    return embeddings.where(valid(F.col("embedding"))).select("vec_id", v.alias("v"))
