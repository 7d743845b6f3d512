"""Phrase collocation mining by dynamic itemset counting.

Texts are dealt to ``SHARDS`` shards, which are scanned in a cycle. Words are counted from the first scan on; a longer phrase is
counted as soon as both phrases that it has with its last or first word left out have reached the threshold, at the next
scan, whatever its length. It is counted for one full cycle, so each shard counts once, wherever the cycle began. Phrases of all lengths
are counted side by side; the scans end when nothing is open.

A scan counts 64-bit keys of (lang, phrase). Which phrases have reached the threshold, and from which scan on, is told
by a table of ``SLOTS`` bytes, the only thing that is sent to tasks: phrases that share a slot are at worst counted in vain, and a
phrase's cycle begins only when both parts are seen themselves. A last
pass counts the words themselves of what has reached the threshold, so collisions of keys and slots never change a result.

Null texts are empty, null languages ``und``. Repeated rows and ids each count; ids and extra columns, whatever their names,
are not read. Texts of any length are worked on in pieces of about 1 MB, cut at ends of pieces; a piece without an end is taken
whole. Empty tables give no rows. Ties are settled by the order given. Scores are exact while 1000 * a * n is below 10^38.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeforge.llm.common import dropped, shuffles_freed, small_batches, staged
from lakeforge.llm.grams import STEP, Words, agree, cuts, folded, mixed, seed_of

SHARDS, LONGEST = 4, 5
#: Bytes of the table of phrases that have reached the threshold.
SLOTS = 1 << 24
FOLD = folded(b"\t", b".,;:!?\n\x0b\x0c\r")
BLANKS = re.compile(b"  +")


def chunks(batch: pa.RecordBatch):
    """(lang, words, number of the piece of each word) of the texts, in chunks of one language."""
    texts: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
        if text:
            texts.setdefault(lang, []).append(text.encode("utf-8", "surrogatepass").translate(FOLD))
    for lang, parts in texts.items():
        for data in cuts(b"\n".join(parts), b"\n"):
            w = Words(BLANKS.sub(b" ", data))
            if len(w.keys):
                w.keys = mixed(w.keys ^ seed_of(lang))
                yield lang, w, np.cumsum(w.x == 10, dtype=np.int32)[w.starts]


def levels(w: Words, piece: np.ndarray, reached: np.ndarray):
    """For each length: starts of the phrases whose parts have reached the threshold, their keys, and since which scan they count.

    The words are those of a chunk; ``reached`` has the scan from which on a phrase is known as frequent, 0 if it is not.
    """
    n, mask = len(w.keys), np.uint64(len(reached) - 1)
    at, key, since = np.arange(n), w.keys, np.ones(n, np.uint8)
    for k in range(1, LONGEST + 1):
        known = np.zeros(n + 1, np.uint8)
        known[at] = reached[(key & mask).astype(np.int64)]
        yield k, at, key, since, known[at]
        if k == LONGEST:
            return
        go = (known[at] > 0) & (known[at + 1] > 0) & (at + k < n)
        go[go] = piece[at[go]] == piece[at[go] + k]
        before, at, key = at, at[go], key[go]
        # a part that shares a slot may count as known before it is seen itself
        seen, key = np.zeros(n + 1, np.uint8), mixed(key * STEP + w.keys[at + k])
        seen[before] = since
        since = np.maximum.reduce([known[at], known[at + 1], seen[at], seen[at + 1]])


def sent(spark: SparkSession, reached: np.ndarray):
    """The table for tasks, compressed, as it is mostly empty."""
    return spark.sparkContext.broadcast(zlib.compress(reached.tobytes(), 1))


def unpacked(table) -> np.ndarray:
    return np.frombuffer(zlib.decompress(table.value), np.uint8)


def counted(shard: DataFrame, table, scan: int, cycle: int) -> DataFrame:
    """``h, k, since, n``: what a scan counts of the phrases that are open."""
    def run(batches):
        reached = unpacked(table)
        for batch in batches:
            for _, w, piece in chunks(batch):
                for k, at, key, since, _ in levels(w, piece, reached):
                    now = since.astype(int) + cycle > scan
                    if now.any():
                        h, first, m = np.unique(key[now], return_index=True, return_counts=True)
                        columns = (h.view(np.int64), np.full(len(h), k, np.int16), since[now][first].astype(np.int16), m)
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "k", "since", "n"])

    return shard.mapInArrow(run, "h long, k short, since short, n long")


def frequent_keys(texts: DataFrame, threshold: int, cycle: int, slots: int) -> np.ndarray:
    """The table of phrases of all lengths that reach the threshold, found by cyclic scans of the shards of ``texts``."""
    if not 0 < cycle <= 50:  # no phrase is open after LONGEST cycles, and scans are numbered in a byte
        raise ValueError(f"from 1 to 50 shards, not {cycle}")
    spark, reached, state = texts.sparkSession, np.zeros(slots, np.uint8), None
    scan = last = 1
    while scan < max(cycle + 1, last + cycle):
        table = sent(spark, reached)
        shard = texts.where(F.col("shard") == (scan - 1) % cycle).select("lang", "text")
        none = F.lit(None).cast("int")
        rows = counted(shard, table, scan, cycle).select("h", "k", "since", none.alias("reached"), F.lit(0).cast("long").alias("old"), F.col("n").alias("new"))
        if state is not None:
            rows = rows.unionAll(state.select("h", "k", "since", "reached", F.col("n").alias("old"), F.lit(0).cast("long")))
        sums = rows.groupBy("h").agg(F.min("k").alias("k"), F.min("since").alias("since"), F.min("reached").alias("reached"), F.sum("old").alias("old"), F.sum("new").alias("new"))
        n = F.col("old") + F.when(F.col("since") + cycle > scan, F.col("new")).otherwise(0)
        merged = sums.withColumn("n", n).withColumn("reached", F.coalesce("reached", F.when(F.col("n") >= threshold, F.lit(scan + 1))))
        merged = staged(merged.select("h", "k", "since", "reached", "n"), *([state] if state is not None else []))
        slot = F.col("h").bitwiseAND(slots - 1).cast("int").alias("slot")
        got = merged.where(F.col("reached") == scan + 1).groupBy(slot).agg(F.min("k").alias("k")).toArrow()  # one row for each slot at most
        table.destroy()
        slot, k = got.column("slot").to_numpy(), got.column("k").to_numpy()
        fresh = reached[slot] == 0  # a slot stays as first set, so the cycle in which a phrase counts never changes
        reached[slot[fresh]] = scan + 1
        last = max(last, int(reached[slot[k < LONGEST]].max(initial=0)))  # the slot may have been set by another, even of the longest
        state, before = merged.where(F.col("since") + cycle > scan + 1), merged  # the rest have completed their cycle
        state.staged_path = before.staged_path
        scan += 1
    dropped(state)
    return reached


def tallied(table):
    """A function of batches of texts: their counts of the phrases in ``table``, and of all words as phrase of no word (k = 0)."""
    def run(batches):
        reached = unpacked(table)
        for batch in batches:
            for lang, w, piece in chunks(batch):
                lengths, phrases, numbers = [0], [b""], [len(w.keys)]
                for k, at, key, _, known in levels(w, piece, reached):
                    at, key = at[known > 0], key[known > 0]
                    _, first, which, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
                    a, b = w.starts[at], w.ends[at + k - 1]
                    one = first[which]
                    ok = agree(w.x, a, b, w.x, a[one], b[one])
                    if not ok.all():  # another phrase with the same key
                        n = np.bincount(which[ok], minlength=len(first))
                        more = Counter(w.data[i:j] for i, j in zip(a[~ok].tolist(), b[~ok].tolist(), strict=True))
                        phrases += more
                        numbers += more.values()
                        lengths += [k] * len(more)
                    phrases += [w.data[i:j] for i, j in zip(a[first].tolist(), b[first].tolist(), strict=True)]
                    numbers += n.tolist()
                    lengths += [k] * len(first)
                text = pa.array(phrases, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(text)), pa.array(lengths, pa.int16()), text, pa.array(numbers, pa.int64())], ["lang", "k", "phrase", "n"])

    return run


def occurrences(texts: DataFrame, table) -> DataFrame:
    """``lang, k, phrase, n`` over all texts."""
    rows = texts.select("lang", "text").mapInArrow(tallied(table), "lang string, k short, phrase string, n long")
    return rows.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))


def scored(frequent: DataFrame, total: DataFrame) -> DataFrame:
    """Candidates with the lowest-scoring cut: ``lang, k, phrase, a, l, r, n, score``."""
    words = F.split("phrase", " ")
    cut = frequent.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"), words.alias("w")).withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cut = cut.select("lang", "k", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("left"), F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("right"))
    part = lambda name, n: frequent.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    both = cut.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(total, "lang")
    score = F.expr("""1000 * cast(a as decimal(16, 0)) * cast(n as decimal(17, 0)) div (cast(l as decimal(17, 0)) * cast(r as decimal(17, 0)))""")
    best = F.min(F.struct(score.alias("score"), F.col("cut"), F.col("l"), F.col("r"))).alias("best")
    return both.groupBy("lang", "k", "phrase").agg(F.max("a").alias("a"), F.max("n").alias("n"), best).select("lang", "k", "phrase", "a", "best.l", "best.r", "n", "best.score")


def mine(docs: DataFrame, threshold: int = 100, top: int = 2000, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``docs`` has ``text`` and ``lang``. Returns each language's best phrases: ``lang, rank, phrase, a, l, r, n, score``."""
    spark = docs.sparkSession
    small_batches(spark)
    shard = F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int")  # by row: copies of a text spread evenly
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"), shard.alias("shard"))
    texts = staged(texts, by="shard")
    table = sent(spark, frequent_keys(texts, threshold, shards, slots))
    counts = occurrences(texts, table)
    frequent = staged(counts.where((F.col("n") >= threshold) | (F.col("k") == 0)), texts)
    table.destroy()
    total = frequent.where("k = 0").select("lang", "n")
    frequent = frequent.where("k > 0")
    found = scored(frequent, total)
    # a phrase goes if a longer one holds it as often; then one with a single word more does, too
    w = F.split("phrase", " ")
    inner = F.explode(F.array(F.array_join(F.slice(w, F.lit(1), F.col("k") - 1), " "), F.array_join(F.slice(w, F.lit(2), F.col("k") - 1), " ")))
    held = frequent.where("k > 2").select("lang", inner.alias("phrase"), F.col("n").alias("a"))
    found = found.join(held, ["lang", "phrase", "a"], "left_anti")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    with shuffles_freed(spark):
        return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
