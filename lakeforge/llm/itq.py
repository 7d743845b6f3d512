"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

Rotations are learned on a bounded sample (``SAMPLE`` distinct vectors by hash): from a random start, codes are the
signs of the rotated, centred vectors, and the rotation is refitted to the codes. Several rotations give enough bits for
``T`` tables of ``b`` bits each. Both numbers are measured on vectors that the rotations were not fitted to: for each ``b``, tables
are added until partners made at the threshold, and likewise the sample's own links, share one but for ``MISS`` of them, and of these layouts that is taken
which costs least to send and to compare at the largest label's size, by the share of the sample's pairs that meet. As
centring widens the angle of vectors that share a direction, partners are made for the vectors nearest to the mean, and
where there is such a direction, codes without centring are tried too. A large label (1 / ``LABELS`` of all rows or more)
that lies apart from the common mean gets a mean, rotations and layout of its own, from at most ``OWN`` of its vectors.

Every vector is indexed in all tables. Keys alone are counted and joined first; vectors follow to the entries that have
more than one. Those that share an entry are compared by exact cosine of the original vectors, in the first table that they share only.

Equal vectors are merged first, with their number. Large entries are cut into blocks, and pairs of blocks are worked on
apart. Pairs never leave a task: it returns sums of links and one edge for each vector to its local component.

Vectors that are null, empty, zero or non-finite, or whose label or id is null, link with nothing and form their own component.
Repeated rows link with each other. Vectors of unequal length do not link. Extra columns are ignored, whatever their names; long
vectors take more room and time in proportion. Empty tables give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import components, small_batches, staged
from lakeforge.llm.topk import valid

SAMPLE, OWN, LABELS, MISS = 20_000, 4_000, 32, 0.02
#: Bits that an entry may have, most tables, and comparisons that cost as much as sending a vector to one more table.
BITS, MOST, SENT = range(4, 30, 2), 400, 16
#: Squared distance from the common mean, of unit vectors, from which on a mean matters.
APART = 0.05
#: Rows of a table entry that are compared in one piece, and rows of one task's group of entries.
BLOCK, GROUP = 512, 20_000


def rotation(x: np.ndarray, seed: int, rounds: int = 25) -> np.ndarray:
    """Alternates codes = sign(x R) and the orthogonal R nearest to mapping x to its codes."""
    d = x.shape[1]
    r = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0]
    for _ in range(rounds):
        u, _, v = np.linalg.svd(x.T @ np.where(x @ r >= 0, 1.0, -1.0))
        r = u @ v
    return r


def codes(x: np.ndarray, mean: np.ndarray, r: np.ndarray, bits: int) -> np.ndarray:
    """Entry of each unit vector in each table."""
    return (((x - mean) @ r >= 0).reshape(len(x), -1, bits) @ (1 << np.arange(bits))).astype("<i4")


def meeting(code: np.ndarray, group: np.ndarray) -> float:
    """Share of the pairs within a group that have one code."""
    pairs = lambda c: float((c * (c - 1.0)).sum())
    key = (group.astype(np.int64) << 32) + code
    return pairs(np.unique(key, return_counts=True)[1]) / max(1.0, pairs(np.unique(group, return_counts=True)[1]))


def learn(x: np.ndarray, group: np.ndarray, n: int, threshold: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Mean to subtract, columns of all tables, and bits of a table, from unit vectors ``x``; ``n``: rows of the largest group."""
    d, best = x.shape[1], None
    fit, held = (x[::2], x[1::2]) if len(x) >= 2000 else (x, x)
    # linked pairs among the held vectors: dense places have many, and there they are not like made partners
    few = np.arange(0, len(held), max(1, len(held) // 500))
    i, j = np.nonzero((held[few] @ held.T >= threshold) & (few[:, None] != np.arange(len(held))))
    drawn = np.random.default_rng(1).permutation(len(i))[:5000] if len(i) >= 50 else np.zeros(0, int)
    links = held[few[i[drawn]]], held[j[drawn]]
    for mean in (x.mean(0), np.zeros(d)):
        near = held[np.argsort(np.linalg.norm(held - mean, axis=1), kind="stable")[: max(1000, len(held) // 4)]]
        near = near[np.arange(max(1000, len(near))) % len(near)]  # few vectors get several partners each
        w = np.random.default_rng(0).normal(size=near.shape)
        w -= (w * near).sum(1, keepdims=True) * near
        w /= np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-12)
        made = len(near)
        left = np.concatenate([near, links[0]])
        right = np.concatenate([threshold * near + math.sqrt(1 - threshold**2) * w, links[1]])
        reach = lambda hit: min(hit[:made].mean(), hit[made:].mean() if len(hit) > made else 1.0)
        r = np.zeros((d, 0))
        for bits in BITS:
            shared, met, t = np.zeros(len(left), bool), [], 0
            while reach(shared) < 1 - MISS and t < MOST and (best is None or t * SENT < best[0]):
                while r.shape[1] < (t + 1) * bits:
                    r = np.concatenate([r, rotation(fit - mean, r.shape[1] // d)], 1)
                part = r[:, t * bits : (t + 1) * bits]
                shared |= (codes(left, mean, part, bits) == codes(right, mean, part, bits))[:, 0]
                if t < 8:
                    met.append(meeting(codes(x, mean, part, bits)[:, 0], group))
                t += 1
            cost = t * (SENT + n * float(np.mean(met)))
            if reach(shared) >= 1 - MISS and (best is None or cost < best[0]):
                best = cost, mean, r[:, : t * bits], bits
        if best and (mean**2).sum() < APART:
            break
    return best[1:]


def min_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest place in the component of each of ``n`` places under pairs (i, j)."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def run_pairs(key: np.ndarray):
    """Places (i, j) of all pairs with equal keys in a sorted array, in pieces of bounded size."""
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.concatenate([start, [len(key)]]))
    for gap in range(1, min(int(size.max(initial=0)), 33)):
        i = np.arange(len(key) - gap)
        i = i[key[i] == key[i + gap]]
        yield i, i + gap
    for s, m in zip(start[size > 33].tolist(), size[size > 33].tolist(), strict=True):
        i, j = np.triu_indices(m, 33)
        yield s + i, s + j


def near_duplicates(embeddings: DataFrame, threshold: float = 0.93) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    spark = embeddings.sparkSession
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & valid(F.col("embedding")) & F.exists("embedding", lambda x: x != 0)
    single = "float" in embeddings.schema["embedding"].dataType.simpleString()
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), F.when(ok, F.transform("embedding", lambda x: x + F.lit(0.0).cast("float") if single else x + 0.0)).alias("v"))
    distinct = rows.where(F.col("v").isNotNull()).groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("w")).withColumn("d", F.size("v"))
    distinct = staged(distinct.withColumn("space", F.xxhash64("label", "d")))
    sizes = distinct.groupBy("space", "d").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0]
    if total is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.coalesce(F.lit(True) & F.col("vec_id").isNotNull()).alias("kept"))
    large = sizes.where((F.col("n") >= 2000) & (F.col("n") * LABELS >= total)).collect()  # LABELS rows at most

    def sample(part: DataFrame, most: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """About ``most`` of ``n`` rows: unit vectors and spaces."""
        drawn = part.where(F.pmod(F.xxhash64(F.lit(3), "rep"), F.lit(1_000_000)) < int(1e6 * min(1.0, most / n))).select("space", "v").toArrow()
        x = drawn.column("v").combine_chunks().flatten().to_numpy().astype(float).reshape(len(drawn), -1) if len(drawn) else np.zeros((0, 1))
        return x / np.linalg.norm(x, axis=1, keepdims=True), drawn.column("space").to_numpy()

    # (length of vector, space of a label apart or None): what is learned
    learned: dict[tuple, tuple[np.ndarray, np.ndarray, int]] = {}
    for d, n in sizes.groupBy("d").agg(F.max("n")).collect():
        x, space = sample(distinct.where(F.col("d") == d), SAMPLE, total)
        if not len(x):
            x, space = np.eye(d), np.zeros(d, np.int64)
        learned[d, None] = learn(x, np.unique(space, return_inverse=True)[1], n, threshold)
        for own in large:
            if own.d == d and (space == own.space).any() and ((x[space == own.space].mean(0) - x.mean(0)) ** 2).sum() >= APART:
                y, _ = sample(distinct.where(F.col("space") == own.space), OWN, own.n)
                learned[d, own.space] = learn(y, np.zeros(len(y), np.int64), own.n, threshold)
    tables = max(r.shape[1] // bits for _, r, bits in learned.values())
    sent = spark.sparkContext.broadcast(learned)  # at most LABELS sets more than lengths

    kind = "<f4" if single else "<f8"  # as stored; all arithmetic is in double precision

    def index(batches):
        for batch in batches:
            pdf = batch.to_pandas()
            apart = pdf["space"].where([k in sent.value for k in zip(pdf["d"], pdf["space"], strict=True)], 0)
            for _, part in pdf.groupby([pdf["d"], apart]):
                stored = np.stack(part["v"].to_numpy()).astype(kind)
                x = stored.astype(float)
                d, space = int(part["d"].iloc[0]), int(part["space"].iloc[0])
                code = codes(x / np.linalg.norm(x, axis=1, keepdims=True), *sent.value.get((d, space), sent.value[d, None]))
                own = code.shape[1]
                padded = np.pad(code, ((0, 0), (0, tables - own)))  # sets may differ in tables
                listed = pa.ListArray.from_arrays(pa.array(np.arange(0, code.size + 1, own), pa.int32()), pa.array(code.reshape(-1)))
                raw = lambda a: pa.array([y.tobytes() for y in a], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(part["rep"].to_numpy()), pa.array(part["w"].to_numpy()), pa.array(part["space"].to_numpy()), listed, raw(padded), raw(stored)], ["rep", "w", "space", "list", "codes", "x"])

    small_batches(spark)
    coded = distinct.select("rep", "w", "space", "d", "v").mapInArrow(index, "rep long, w long, space long, list array<int>, codes binary, x binary")
    coded = staged(coded)
    keyed = coded.select("rep", "space", F.posexplode("list").alias("t", "code")).select("rep", "t", F.xxhash64("space", "t", "code").alias("key"))
    # an entry of one row has no pair and stays behind; a large one is cut into nb blocks, and each pair of blocks meets once
    crowded = staged(keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key", F.ceil(F.col("m") / BLOCK).cast("int").alias("nb")))
    own = F.pmod(F.xxhash64(F.lit(5), "rep"), F.col("nb")).cast("int")
    met = keyed.join(crowded, "key").withColumn("blk", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    met = staged(met.select("rep", "t", "blk", (F.col("blk") == F.col("other")).alias("within"), F.xxhash64("key", F.least("blk", "other"), F.greatest("blk", "other")).alias("run")), crowded)
    groups = max(1, -(-met.count() // GROUP))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("run", kind="stable")
        run, blk, within, t = (pdf[c].to_numpy() for c in ("run", "blk", "within", "t"))
        code = np.frombuffer(b"".join(pdf["codes"]), "<i4").reshape(len(pdf), -1)
        sizes_ = pdf["x"].map(len).to_numpy()
        size = np.dtype(kind).itemsize
        x = np.zeros((len(pdf), sizes_.max() // size))
        for i, raw in enumerate(pdf["x"]):
            x[i, : len(raw) // size] = np.frombuffer(raw, kind)
        norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        ids, place = np.unique(pdf["rep"].to_numpy(), return_inverse=True)
        w, links, edges = pdf["w"].to_numpy(), np.zeros(len(ids), np.int64), []
        for i, j in run_pairs(run):
            for a in range(0, len(i), 200_000):
                p, q = i[a : a + 200_000], j[a : a + 200_000]
                may = within[p] | (blk[p] != blk[q])
                p, q = p[may], q[may]
                first = (code[p] == code[q]).argmax(1) == t[p]
                p, q = p[first], q[first]
                linked = np.einsum("ij,ij->i", x[p], x[q]) / (norm[p] * norm[q]) >= threshold
                p, q = p[linked], q[linked]
                edges.append((place[p], place[q]))
                np.add.at(links, place[p], w[q])
                np.add.at(links, place[q], w[p])
        i, j = (np.concatenate([e[k] for e in edges] or [np.zeros(0, int)]) for k in (0, 1))
        label = min_labels(len(ids), i, j)
        hit = np.unique(np.concatenate([i, j])).astype(int)
        return pd.DataFrame({"a": ids[hit], "b": ids[label[hit]], "links": links[hit]})

    whole = met.join(coded.select("rep", "w", "codes", "x"), "rep").withColumn("g", F.pmod("run", F.lit(groups)))
    found = staged(whole.groupBy("g").applyInPandas(compare, "a long, b long, links long"), met, coded)
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    parts = components(found.select("a", "b"))
    known = distinct.join(links, distinct.rep == links.a, "left").join(parts, distinct.rep == parts.id, "left").select(F.col("label").alias("l"), F.col("v").alias("u"), "w", "rep", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component_id", "rep").alias("c"))
    joined = rows.join(known, (rows.label == known.l) & (rows.v == known.u), "left")
    component = F.coalesce("c", "vec_id")
    return joined.select("vec_id", F.coalesce(F.col("links") + F.col("w") - 1, F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
