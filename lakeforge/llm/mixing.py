"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length (words). Each source's target is met first by whole repeats, then a rest
budget by picking documents: every length gives its share of documents, the longest that fit fill up what
rounding left, and a bounded-knapsack dynamic program runs over the lengths unused and given back. Ever more are
given back until the budget is hit, or enough that no choice of lengths comes nearer. Only where that program's sets of
sums would take more than ``BITS`` bits are lengths counted in larger units than a word, and a gap can stay. Which documents
of a length are taken is decided by a seeded hash of id and text, so reruns agree; of rows that agree in both, as many as are needed.

Null or blank texts have size 0 and are never taken. A null source is a source of its own, sorted last. A null
``doc_id`` is a document like any other. Repeated rows are documents of their own. All sizes 0, or an empty table: nothing
is taken. Extra columns may have any names.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.llm.common import dropped, n_words, staged

#: No document is taken more often.
MOST = 3
#: Smaller budgets go to the dynamic program whole; others from a quarter of this many words on.
DP_WORDS = 1 << 14
#: Bits of all the sets of sums that the dynamic program keeps (128 MB).
BITS = 1 << 30


def with_targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``s, source_size`` with ``target``: by weight of all sizes together, none above ``MOST`` times its source; excess is reshared by weight.

    Sources are numbered in code-point order, null last, within ranges. A source is full where the words due to each unit of weight
    fill it; that number only grows as full sources leave, and one row of sums for each step reaches the driver.
    """
    order = F.asc_nulls_last("s")
    ranged = staged(sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()))
    before = ranged.groupBy("part").agg(F.count("*").alias("m")).select("part", (F.sum("m").over(Window.orderBy("part")) - F.col("m")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1 + F.col("before")
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights)).cast("int") + 1)
    placed = staged(ranged.join(before, "part").select("s", "source_size", weight.cast("long").alias("w")), ranged)
    full = lambda unit: unit * F.col("w") >= MOST * F.col("source_size")
    unit, count = 0.0, -1
    while True:
        is_full = full(F.lit(unit)) if count >= 0 else F.lit(False)
        t = placed.agg(F.sum("source_size").alias("n"), F.sum(F.when(is_full, F.col("source_size"))).alias("fixed"), F.sum(F.when(~is_full, F.col("w"))).alias("w"), F.count_if(is_full).alias("full")).first()
        if not t.w or t.full == count:
            break
        unit, count = float(t.n - MOST * (t.fixed or 0)) / t.w, t.full
    return placed.select("s", "source_size", F.when(full(F.lit(unit)), MOST * F.col("source_size")).otherwise(F.lit(unit) * F.col("w")).cast("double").alias("target"))


def subset(counts: list[tuple[int, int]], budget: int) -> dict[int, int] | None:
    """Documents by length whose lengths sum as near below ``budget`` as can be; bits of an integer are reachable sums.

    None where that would take more than ``BITS``.
    """
    mask, reach, steps, bits = (1 << (budget + 1)) - 1, 1, [], 0
    for length, count in counts:
        count, k = min(count, budget // length), 1
        while count > 0 and not reach >> budget & 1:
            k = min(k, count)
            steps.append((length, k, reach))
            bits += reach.bit_length()
            if bits > BITS:
                return None
            reach |= (reach << (length * k)) & mask
            count, k = count - k, 2 * k
    at, taken = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> at & 1:
            taken[length] = taken.get(length, 0) + k
            at -= length * k
    return taken


def coarse(counts: list[tuple[int, int]], budget: int) -> dict[int, int]:
    """``subset`` with lengths rounded up to a unit, the smallest power of two for which it fits ``BITS``."""
    unit = 2
    while True:
        alike: dict[int, list[tuple[int, int]]] = {}
        for n, c in counts:
            alike.setdefault(-(-n // unit), []).append((n, c))
        found = subset([(u, sum(c for _, c in same)) for u, same in alike.items()], budget // unit)
        if found is not None:
            break
        unit *= 2
    taken: dict[int, int] = {}
    for u, k in found.items():
        for n, c in reversed(alike[u]):
            taken[n] = min(c, k)
            k -= taken[n]
    left = budget - sum(n * c for n, c in taken.items())
    for n, c in reversed(counts):
        more = min(c - taken.get(n, 0), left // n)
        taken[n], left = taken.get(n, 0) + more, left - more * n
    return taken


def fit(counts: list[tuple[int, int]], budget: int) -> dict[int, int]:
    """How many documents of each length to take so that their words come to ``budget``, or as near below as can be.

    A best choice differs from the greedy one in at most 2 L documents, L being the greatest length: put in a fitting
    order, exchanges keep the sum within L of the budget, so of more than 2 L some in a row would cancel out.
    So no more than 2 L of a length need be given back.
    """
    counts = sorted((n, c) for n, c in counts if n > 0)
    total = sum(n * c for n, c in counts)
    if not total or budget <= 0:
        return {}
    if budget >= total:
        return dict(counts)
    unit = math.gcd(*(n for n, _ in counts))
    if unit > 1:
        return {n * unit: c for n, c in fit([(n // unit, c) for n, c in counts], budget // unit).items()}
    if budget <= DP_WORDS and (found := subset(counts, budget)) is not None:
        return found
    greedy = {n: c * budget // total for n, c in counts}
    gap = budget - sum(n * c for n, c in greedy.items())
    for n, c in reversed(counts):
        more = min(c - greedy[n], gap // n)
        greedy[n], gap = greedy[n] + more, gap - more * n
    best, room = (gap, greedy), DP_WORDS // 4
    while best[0]:
        taken, left, whole = dict(greedy), gap, True
        for n, _ in counts:  # short ones go back first, long ones too where the room is not filled
            most = min(greedy[n], 2 * counts[-1][0])
            back = min(most, max(0, -(-(room - left) // n)))
            taken[n], left, whole = taken[n] - back, left + back * n, whole and back == most
        free = [(n, c - taken[n]) for n, c in counts if n <= left and c > taken[n]]
        found = subset([x for ends in zip(free, reversed(free), strict=True) for x in ends][: len(free)], left)  # unlike lengths hit soonest
        exact = found is not None
        for n, c in (found if exact else coarse(free, left)).items():
            taken[n] += c
        best = min(best, (budget - sum(n * c for n, c in taken.items()), taken), key=lambda x: x[0])
        if whole or not exact:
            break
        room *= 4
    return best[1]


def budgets(keyed: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """For each source and length: whole repeats, and the hash ``cut`` below which a document is taken once more.

    ``keyed`` has ``src, size`` and a 63-bit hash ``u``. Of the ``ties`` documents at the cut itself, ``spare`` are taken. All that
    moves is counts and, for the bucket in which a cut lies, counts of hashes.
    """
    histogram = staged(keyed.groupBy("src", "size").agg(F.count("*").alias("c")))
    sources = histogram.groupBy(F.col("src").alias("s")).agg(F.sum(F.col("size") * F.col("c")).alias("source_size"))

    def quota(pdf: pd.DataFrame) -> pd.DataFrame:
        n, t = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        repeats = min(MOST, int(t // n)) if n else 0
        taken = fit(list(zip(pdf["size"].tolist(), pdf["c"].tolist(), strict=True)), round(t) - repeats * n) if repeats < MOST else {}
        return pdf.assign(repeats=repeats, k=[taken.get(x, 0) for x in pdf["size"]])

    schema = "src string, size long, c long, source_size long, target double, repeats int, k long"
    quotas = staged(histogram.join(with_targets(sources, weights), F.col("src").eqNullSafe(F.col("s"))).drop("s").groupBy("src").applyInPandas(quota, schema), histogram)
    # the k-th hash of a length: about sqrt(c) buckets in hash order are counted, then the hashes in the bucket of the cut
    partly = quotas.where("k > 0 and k < c").select(F.col("src").alias("qs"), F.col("size").alias("qz"), "c", "k")
    same = F.col("src").eqNullSafe(F.col("qs")) & (F.col("size") == F.col("qz"))
    slots = keyed.join(partly, same).select("src", "size", "k", "u", F.shiftright(F.shiftright("u", 32) * F.ceil(F.sqrt("c")), 31).alias("slot"))
    counted = slots.groupBy("src", "size", "k", "slot").agg(F.count("*").alias("m"))
    upto = F.sum("m").over(Window.partitionBy("src", "size").orderBy("slot"))
    last = counted.withColumn("left", F.col("k") - upto + F.col("m")).where("left > 0 and left <= m")
    last = last.select(F.col("src").alias("qs"), F.col("size").alias("qz"), F.col("slot").alias("at"), "left")
    hashes = slots.join(last, same & (F.col("slot") == F.col("at"))).groupBy("src", "size", "left", "u").agg(F.count("*").alias("ties"))
    spare = F.col("left") - F.sum("ties").over(Window.partitionBy("src", "size").orderBy("u")) + F.col("ties")
    cuts = hashes.withColumn("spare", spare).where("spare > 0 and spare <= ties").select(F.col("src").alias("qs"), F.col("size").alias("qz"), F.col("u").alias("cut"), "spare", "ties")
    whole = F.when((F.col("k") == F.col("c")) & (F.col("k") > 0), F.lit((1 << 63) - 1))
    plan = quotas.join(cuts, same, "left").select("src", "size", "source_size", "target", "repeats", F.coalesce(whole, "cut", F.lit(-1)).alias("cut"), "spare", "ties")
    return staged(plan, quotas)


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), seed: int = 7) -> DataFrame:
    """``row`` (all columns of ``docs``), ``did, size, source_size, target, copies, taken`` (words) of each document."""
    text = F.col("text").cast("string")
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), text), 1)
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").alias("did"), F.col("source").cast("string").alias("src"), n_words(text).alias("size"), u.alias("u"))
    narrow = staged(keyed.select("src", "size", "u"))
    plan = budgets(narrow, weights)
    dropped(narrow)
    placed = keyed.join(plan.select(F.col("src").alias("qs"), F.col("size").alias("qz"), "source_size", "target", "repeats", "cut", "spare", "ties"), F.col("src").eqNullSafe(F.col("qs")) & (F.col("size") == F.col("qz")))
    tied = (F.col("u") == F.col("cut")) & F.coalesce(F.col("spare") < F.col("ties"), F.lit(False))

    def result(rows: DataFrame, once_more: Column) -> DataFrame:
        copies = F.when(F.col("size") > 0, F.col("repeats") + once_more.cast("int")).otherwise(0)
        return rows.select("row", "did", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).cast("long").alias("taken"))

    clear = result(placed.where(~tied), F.col("u") <= F.col("cut"))
    if not plan.where("spare < ties").take(1):
        return clear
    # equal documents at a cut are numbered, partition by partition
    rows = staged(placed.where(tied).select("*", F.monotonically_increasing_id().alias("mid")))
    ids = rows.select("src", "size", "mid", F.shiftright("mid", 33).alias("part"))
    n = ids.groupBy("src", "size", "part").agg(F.count("*").alias("m"))
    n = n.select(F.col("src").alias("ns"), F.col("size").alias("nz"), F.col("part").alias("np"), (F.sum("m").over(Window.partitionBy("src", "size").orderBy("part")) - F.col("m")).alias("before"))
    place = F.row_number().over(Window.partitionBy("src", "size", "part").orderBy("mid")) + F.col("before")
    numbered = ids.join(n, F.col("src").eqNullSafe(F.col("ns")) & (F.col("size") == F.col("nz")) & (F.col("part") == F.col("np"))).select("mid", place.alias("place"))
    return clear.unionAll(result(rows.join(numbered, "mid"), F.col("place") <= F.col("spare")))
