"""MinHash near-duplicates with tensored banding.

Words are runs without ASCII white space, A-Z lower-cased; a document's set is its distinct word shingles (the whole
sequence if it is shorter). Two collections of ``M`` minhash pairs are computed, and every pair of them, one from each
collection, keys a table: M * M tables from 4 * M minhashes. Documents with equal sets are merged first. Table entries that hold
the same documents are one entry. In each entry, pairs whose sizes and sketches (a byte of each minhash) allow the threshold
form a graph; only a spanning forest of it, of the pairs that agree most, leaves the task. Its edges are verified on full
sets. Where an edge fails, links may hide behind it; the documents of its entries are then joined exactly: in one order of all
shingles, rare ones first, two sets that reach the threshold share one of their first ones (prefix filter) early enough for
what follows to suffice (positional filter). Of the pairs that do and lie in different components, each component's best
are verified and components merged, then more of each, until none is left. Entries with many documents are cut into
blocks, and pairs of blocks are worked on apart.

Sets are 64-bit hashes of shingles; equal sets are told by 128 bits of the SHA-256 of the whole sorted set, and their size.
Null texts and texts without words have empty sets and link with nothing. Rows are told apart by id and text, not by id
alone: rows that share an id, or have none, are documents of their own. A component's id is the smallest there is in it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.bpe import pieces
from lakeforge.llm.common import WORD, components, dropped, small_batches, staged
from lakeforge.llm.itq import min_labels, run_pairs

M, ROWS = 7, 2
HASHES = 2 * M * ROWS
#: Of ``HASHES`` bytes, so many must agree. A pair with similarity 0.8 has fewer with a chance of 0.0003.
AGREE = 15
BLOCK, GROUP = 1024, 20_000
#: Slots of the table that orders shingles.
BINS = 1 << 20
#: Slots of the bitmap of documents whose sets are needed.
SLOTS = 1 << 24

rng = np.random.default_rng(20)
_BYTES = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_BASE = 0x9E3779B97F4A7C15
_MULT = rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = rng.integers(1, 2**63, HASHES, dtype=np.uint64)
_WORD = rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Sorted distinct shingle hashes of texts, many at once."""

    def __init__(self, k: int):
        self.k, self.up, self.down = k, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def powers(self, n: int) -> None:
        if len(self.up) < n:
            grow = lambda b: np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(2 * n, b, np.uint64)]))
            self.up, self.down = grow(_BASE), grow(pow(_BASE, -1, 2**64))

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        coded = [t.encode("utf-8", "replace") for t in texts]
        x = np.frombuffer(b" ".join(coded) + b" ", np.uint8)
        self.powers(len(x) + 1)
        blank = _SPACE[x]
        start = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
        end = np.flatnonzero(blank & np.concatenate([[False], ~blank[:-1]]))
        total = np.concatenate([[np.uint64(0)], np.cumsum(_BYTES[x] * self.up[: len(x)], dtype=np.uint64)])
        word = mixed((total[end] - total[start]) * self.down[start])
        first = np.searchsorted(start, np.cumsum([0, *(len(c) + 1 for c in coded)]))
        k, out = self.k, []
        whole = sum((word[i : max(i, len(word) - k + 1 + i)] * _WORD[i] for i in range(k)), np.zeros(max(0, len(word) - k + 1), np.uint64))
        whole = mixed(whole)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= k:
                out.append(np.unique(whole[a : b - k + 1]))
            else:
                w = word[a:b]
                out.append(mixed((w * _WORD[32 : 32 + len(w)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(w))) if len(w) else w)
        return out


def key_columns(docs: DataFrame) -> tuple[Column, Column, Column]:
    """id, hash of the text, hash of the other columns: rows that agree in them are the same document."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")), F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0).cast("long")


def keyed_rows(docs: DataFrame) -> DataFrame:
    """``id, h, o, text``."""
    return docs.select(*(e.alias(n) for e, n in zip(key_columns(docs), ("id", "h", "o"), strict=True)), F.col("text").cast("string").alias("text"))


def signatures(rows: DataFrame, k: int) -> DataFrame:
    """``id, h, o``, ``n`` (set size), a digest of the set, the two collections of hash pairs, the sketch."""
    def run(batches):
        shingler = Shingler(k)
        for batch in batches:
            at = 0
            for part in pieces(batch.column("text").to_pylist()):
                sets = shingler.sets(part)
                n = np.array([len(s) for s in sets])
                full = np.flatnonzero(n)
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
                begin = np.cumsum(n[full]) - n[full]
                low = np.zeros((HASHES, len(part)), np.uint64)
                if len(full):
                    for h in range(HASHES):
                        low[h, full] = np.minimum.reduceat((flat ^ _XOR[h]) * _MULT[h], begin)
                digest = np.frombuffer(b"".join([hashlib.sha256(s.astype("<u8")).digest()[:16] for s in sets]), "<i8").reshape(-1, 2)
                low = mixed(low)
                pair = mixed(low[::2] * np.uint64(3) + low[1::2]).astype(np.int64)
                sketch = np.ascontiguousarray((low & np.uint64(255)).astype(np.uint8).T)
                listed = lambda rows: pa.ListArray.from_arrays(pa.array(np.arange(0, M * len(part) + 1, M), pa.int32()), pa.array(np.ascontiguousarray(rows.T).reshape(-1)))
                same = [batch.column(c).slice(at, len(part)) for c in ("id", "h", "o")]
                yield pa.RecordBatch.from_arrays([*same, pa.array(n.astype(np.int64)), pa.array(digest[:, 0]), pa.array(digest[:, 1]), listed(pair[:M]), listed(pair[M:]), pa.array([s.tobytes() for s in sketch], pa.binary())], ["id", "h", "o", "n", "f", "g", "a", "b", "sketch"])
                at += len(part)

    small_batches(rows.sparkSession)
    return rows.mapInArrow(run, "id long, h long, o long, n long, f long, g long, a array<long>, b array<long>, sketch binary")


def forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the graph of pairs (i, j), best first: of each tree its best pair to another, until none is left."""
    label, e, out = np.arange(n), np.arange(len(i)), [np.zeros(0, int)]
    while True:
        a, b = label[i[e]], label[j[e]]
        e, a, b = (x[a != b] for x in (e, a, b))
        if not len(e):
            break
        best = np.full(n, len(i))
        np.minimum.at(best, a, e)
        np.minimum.at(best, b, e)
        roots = np.flatnonzero(best < len(i))
        pick = best[roots]
        out.append(np.unique(pick))
        up = np.arange(n)
        up[roots] = label[i[pick]] + label[j[pick]] - roots
        mutual = roots[(up[up[roots]] == roots) & (roots < up[roots])]
        up[mutual] = mutual
        while (up[up] != up).any():
            up = up[up]
        label = up[label]
    chosen = np.concatenate(out)
    return i[chosen], j[chosen]


def dense_forest(alike: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that hold a spanning forest of the best pairs of a square matrix (0: no pair): each tree's best to another, round by round."""
    rows = np.arange(len(alike))
    label, out = rows, ([], [])
    while True:
        other = alike * (label[:, None] != label[None])
        j = other.argmax(1)
        w = other[rows, j].astype(int)
        live = np.flatnonzero(w)
        if not len(live):
            return tuple(np.concatenate([np.zeros(0, int), *x]) for x in out)
        order = live[np.lexsort((np.maximum(live, j[live]), np.minimum(live, j[live]), -w[live], label[live]))]
        i = order[np.unique(label[order], return_index=True)[1]]
        out[0].append(i)
        out[1].append(j[i])
        label = min_labels(len(rows), label[i], label[j[i]])[label]


def alike_pairs(run: np.ndarray, sketch: np.ndarray, allowed, spanning: bool):
    """Places (p, q) of ``allowed`` pairs in one run (sorted) whose sketches agree in ``AGREE`` bytes or more, and in how many; piece by piece.

    ``spanning``: of large runs only pairs that hold a spanning forest.
    """
    start = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    size = np.diff(np.append(start, len(run)))
    few = np.flatnonzero(np.repeat(size <= 32, size))
    for p, q in run_pairs(run[few]):
        for a in range(0, len(p), 500_000):
            i, j = few[p[a : a + 500_000]], few[q[a : a + 500_000]]
            alike = (sketch[i] == sketch[j]).sum(1)
            near = (alike >= AGREE) & allowed(i, j)
            yield i[near], j[near], alike[near]
    for s, m in zip(start[size > 32].tolist(), size[size > 32].tolist(), strict=True):
        columns, at = np.ascontiguousarray(sketch[s : s + m].T), np.arange(s, s + m)
        alike = np.zeros((m, m), np.uint8)
        for col in columns:
            alike += col[:, None] == col[None]
        alike[alike < AGREE] = 0
        if spanning:
            alike *= allowed(at[:, None], at[None])
            i, j = dense_forest(alike)
            yield s + i, s + j, alike[i, j]
            continue
        for a in range(0, m, 512):
            i, j = np.nonzero(np.triu(alike[a : a + 512], a + 1))
            ok = allowed(s + a + i, s + j)
            yield s + a + i[ok], s + j[ok], alike[a + i[ok], j[ok]]


def best_of_each(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """Flags of the pairs (a, b), best first, that are among the first ``k`` of one of their ends."""
    ends, at = np.concatenate([a, b]), np.tile(np.arange(len(a)), 2)
    order = np.lexsort((at, ends))
    new = np.flatnonzero(np.diff(ends[order], prepend=-1))
    rank = np.arange(len(ends)) - np.repeat(new, np.diff(np.append(new, len(ends))))
    out = np.zeros(len(a), bool)
    out[at[order[rank < k]]] = True
    return out


def compare(percent: int, k: int = 0):
    """Edges of a group of entries: a spanning forest; or the ``k`` best pairs of each component with others, and whether
    there are ``more``."""
    spanning = k == 0

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["run", "id"], kind="stable")
        run_, blk, within, n = (pdf[c].to_numpy() for c in ("run", "blk", "within", "n"))
        ids, place = np.unique(pdf["id"].to_numpy(), return_inverse=True)
        sketch = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(-1, HASHES)
        c, pos = pdf["c"].to_numpy(), pdf["pos"].to_numpy()
        found = []
        def allowed(p, q):
            may = (within[p] | (blk[p] != blk[q])) & (100 * np.minimum(n[p], n[q]) >= percent * np.maximum(n[p], n[q])) & (place[p] != place[q])
            if not spanning:
                # at the first shingle that two sets share, no more than what follows it in each can be common
                least = -(-percent * (n[p] + n[q]) // (100 + percent))
                may &= (c[p] != c[q]) & (np.minimum(n[p] - pos[p], n[q] - pos[q]) >= least)
            return may

        for p, q, alike in alike_pairs(run_, sketch, allowed, spanning):
            low, high = np.minimum(place[p], place[q]), np.maximum(place[p], place[q])
            found.append(np.unique((HASHES - alike.astype(np.int64)) * len(ids) ** 2 + low * len(ids) + high))
        # those whose sketches agree most come first
        pairs = np.unique(np.concatenate([*found, np.zeros(0, int)])).astype(int) % max(1, len(ids) ** 2)
        i, j = pairs // len(ids), pairs % len(ids)
        if spanning:
            i, j = forest(len(ids), i, j)
            more = False
        else:
            part = np.zeros(len(ids), np.int64)
            part[place] = np.unique(c, return_inverse=True)[1]
            some = best_of_each(part[i], part[j], k)
            more = not some.all()
            i, j = i[some], j[some]
        return pd.DataFrame({"a": ids[np.maximum(i, j)], "b": ids[np.minimum(i, j)], "more": more})

    return run


def meetings(members: DataFrame, *more: str) -> DataFrame:
    """Members of entries (``key``, of ``m`` rows), once for each pair of blocks in which they meet others."""
    met = members.withColumn("nb", F.ceil(F.col("m") / BLOCK).cast("int"))
    met = met.withColumn("blk", F.pmod(F.xxhash64(F.lit(5), "id"), F.col("nb")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    return met.select("id", "n", "sketch", *more, "blk", (F.col("blk") == F.col("other")).alias("within"), F.xxhash64("key", F.least("blk", "other"), F.greatest("blk", "other")).alias("run"))


def prefixes(docs: DataFrame, percent: int) -> DataFrame:
    """``key, pos, id`` for the first shingles of each set: all but the last ceil(threshold * size), plus one.

    The order is by how many of ``docs`` hold a shingle, counted in a table of ``BINS`` slots, then by hash. Any
    order is exact; this one makes rare shingles come first. A slot counted once holds a shingle that no other set has.
    """
    def count(batches):
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            for x in batch.column("set"):
                np.add.at(total, (np.frombuffer(x.as_buffer(), "<u8") & np.uint64(BINS - 1)).astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "m"])

    counted = docs.select("set").mapInArrow(count, "slot long, m long").groupBy("slot").agg(F.sum("m").alias("m")).toArrow()
    often = np.zeros(BINS, np.int32)
    often[counted.column("slot").to_numpy()] = np.minimum(counted.column("m").to_numpy(), 2**31 - 1)
    sent = docs.sparkSession.sparkContext.broadcast(often)  # BINS numbers, whatever the input

    def run(batches):
        for batch in batches:
            keys, places = [], []
            for x in batch.column("set"):
                x = np.frombuffer(x.as_buffer(), "<u8")
                m = sent.value[(x & np.uint64(BINS - 1)).astype(np.int64)]
                first = np.lexsort((x, m))[: len(x) - -(-len(x) * percent // 100) + 1]
                place = np.flatnonzero(m[first] > 1)
                keys.append(x[first[place]].astype(np.int64))
                places.append(place)
            take = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(places).astype(np.int64)), batch.column("id").take(take)], ["key", "pos", "id"])

    return docs.select("id", "set").mapInArrow(run, "key long, pos long, id long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` with 100 * intersection >= percent * union of their full sets."""
    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(good)) for c in ("a", "b")], ["a", "b"])

    x, y = sets.select(F.col("id").alias("a"), F.col("set").alias("x")), sets.select(F.col("id").alias("b"), F.col("set").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def marked(bits: DataFrame) -> np.ndarray:
    """Bits of all slots from Spark's bitmap buckets (at most ``SLOTS`` / 32768 rows of 4 KB)."""
    out = np.zeros(SLOTS // 8, np.uint8)
    for bucket, x in zip(*(c.to_pylist() for c in bits.select("bucket", "bits").toArrow().columns), strict=True):  # in one job, not one for each partition
        at = (bucket - 1) * 4096
        out[at : at + 4096] |= np.frombuffer(x, np.uint8)
    return out


def full_sets(rows: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """``id`` (node) and ``set`` of the rows ``wanted`` (``node, id, h, o``).

    A bitmap of fixed size tells most others apart where texts are read, so that few texts are shuffled. Others that share a
    slot are left to the join.
    """
    slot = F.pmod(F.xxhash64("id", "h", "o"), F.lit(SLOTS))
    at = F.col("slot") + 1
    bits = wanted.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    sent = rows.sparkSession.sparkContext.broadcast(marked(bits))

    def some(batches):
        for batch in batches:
            at = batch.column("slot").to_numpy()
            yield batch.filter(pa.array((sent.value[at >> 3] >> (at & 7).astype(np.uint8) & 1) == 1))

    def run(batches):
        shingler = Shingler(k)
        for batch in batches:
            at = 0
            for part in pieces(batch.column("text").to_pylist()):
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(at, len(part)), pa.array([s.astype("<u8").tobytes() for s in shingler.sets(part)], pa.binary())], ["id", "set"])
                at += len(part)

    few = rows.withColumn("slot", slot).mapInArrow(some, "id long, h long, o long, text string, slot long")
    w = wanted.select("node", *(F.col(c).alias(f"w{c}") for c in ("id", "h", "o")))
    found = few.join(w, F.col("id").eqNullSafe(F.col("wid")) & (F.col("h") == F.col("wh")) & (F.col("o") == F.col("wo")))
    return found.groupBy("node").agg(F.first("text").alias("text")).mapInArrow(run, "id long, set binary")


def in_parts(df: DataFrame, parts: DataFrame, col: str, new: str) -> DataFrame:
    """``df`` with the component of ``col`` in ``parts`` (``id, component_id``) as ``new``: itself, if it is not there."""
    return df.join(parts.select(F.col("id").alias(col), F.col("component_id").alias(new)), col, "left").withColumn(new, F.coalesce(new, col))


def joined(parts: DataFrame, edges: DataFrame) -> DataFrame:
    """The components ``parts`` (staged, deleted then) with the ``edges`` between them: only components with an edge are worked on."""
    edges = staged(edges)
    if not edges.take(1):
        dropped(edges)
        return parts
    up = components(in_parts(in_parts(edges, parts, "a", "ca"), parts, "b", "cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")), roots=False)
    moved = parts.join(up.select(F.col("id").alias("component_id"), F.col("component_id").alias("top")), "component_id", "left")
    single = up.join(parts.select("id"), "id", "left_anti").select("id", "component_id")
    return staged(moved.select("id", F.coalesce("top", "component_id").alias("component_id")).unionAll(single), parts, edges, up)


def linked_sets(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Two staged tables: ``id, h, o, n, f, g`` of each row, and ``n, f, g, c, row`` of each different set that is not empty.

    ``c`` is the component; ``row`` the first of the set's rows: with id before without, then by ``id, h, o``.
    """
    rows = keyed_rows(docs)
    signed = staged(signatures(rows, k))
    first_row = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "h", "o")).alias("row")
    same = signed.where("n > 0").groupBy("n", "f", "g").agg(first_row, F.first(F.struct("a", "b", "sketch")).alias("s"))
    # numbered in the order of rows, as copies tend to come after what they are made from
    same = same.repartitionByRange("row").sortWithinPartitions("row")
    same = staged(same.select(F.monotonically_increasing_id().alias("node"), "n", "f", "g", "row", "s.*"))
    narrow = staged(signed.select("id", "h", "o", "n", "f", "g"), signed)
    i = same.select(F.col("node").alias("id"), F.posexplode("a").alias("i", "x"), "b")
    keyed = i.select("id", "i", "x", F.posexplode("b").alias("j", "y")).select("id", F.xxhash64("i", "j", "x", "y").alias("key"))
    # entries with the same documents are one
    entries = keyed.groupBy("key").agg(F.count("*").alias("m"), F.min("id").alias("low"), F.bit_xor(F.xxhash64("id")).alias("all")).where("m > 1")
    entries = staged(entries.groupBy("m", "low", "all").agg(F.min("key").alias("key")).select("key", "m"))
    members = staged(keyed.join(entries, "key"))
    met = members.select("id", "key", "m").join(same.select(F.col("node").alias("id"), "n", "sketch"), "id")
    met = staged(meetings(met), entries, members)
    groups = max(1, -(-met.count() // GROUP))
    grouped = lambda df, fn: df.withColumn("g", F.pmod("run", F.lit(groups))).groupBy("g").applyInPandas(fn, "a long, b long, more boolean")
    pairs = staged(grouped(met.withColumns({"c": F.lit(0).cast("long"), "pos": F.lit(0).cast("long")}), compare(percent)).select("a", "b").distinct())
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(same.select("node", "row.id", "row.h", "row.o"), "node")
    wanted = staged(wanted)
    sets = staged(full_sets(rows, wanted, k), wanted)
    # one edge for each document first; then those that still join different components; then what failed edges hid
    first = pairs.groupBy("a").agg(F.min("b").alias("b"))
    linked = staged(verified(first, sets, percent))
    parts = components(linked, roots=False)
    dropped(linked)
    between = lambda df: in_parts(in_parts(df, parts, "a", "ca"), parts, "b", "cb").where("ca <> cb").select("a", "b")
    parts = joined(parts, verified(between(pairs.join(first, ["a", "b"], "left_anti")), sets, percent))
    open_ = between(pairs)
    hidden = staged(open_.select(F.col("a").alias("id")).union(open_.select("b")).distinct())
    if hidden.take(1):
        runs = met.join(hidden, "id", "left_semi").select("run").distinct()
        around = staged(met.join(runs, "run", "left_semi").groupBy("id").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")))
        firsts = staged(prefixes(sets.join(around.select("id"), "id", "left_semi"), percent))
        tried, k, more = pairs, 16, True
        while more:
            now = staged(in_parts(around, parts, "id", "c"))
            kept = firsts.join(now.select("id", "c"), "id").groupBy("key").agg(F.count("*").alias("m"), F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("key", "m")
            shared = staged(kept)
            found = staged(grouped(meetings(firsts.join(shared, "key").join(now, "id"), "c", "pos"), compare(percent, k)), shared, now)
            more = bool(found.where("more").take(1))
            fresh = staged(found.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), found)
            if fresh.take(1):
                parts = joined(parts, verified(fresh, sets, percent))
            if more:
                tried, old, k = staged(tried.union(fresh)), tried, 16 * k
                dropped(*(x for x in (old,) if x is not pairs))
            dropped(fresh)
        dropped(firsts, around, *(x for x in (tried,) if x is not pairs))
    component = F.coalesce("component_id", "node").alias("c")
    out = staged(same.join(parts.withColumnRenamed("id", "node"), "node", "left").select("n", "f", "g", component, "row"), same, met, pairs, sets, parts, hidden)
    return narrow, out


def near_duplicates(docs: DataFrame, k: int = 4, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row; rows without id are never kept."""
    signed, found = linked_sets(docs, k, percent)
    least = found.groupBy("c").agg(F.min("row.id").alias("component"))
    rows = signed.select("id", "n", "f", "g").join(found.join(least, "c").select("n", "f", "g", "component"), ["n", "f", "g"], "left")
    component = F.coalesce(F.when(F.col("n") > 0, F.col("component")), F.col("id"))
    return staged(rows.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept")), signed, found)


def deduplicated(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The columns of ``docs``; one row of each group of near duplicates stays: the smallest by id (null last), text hash, hash of the rest.

    Rows that share an id but not a group all stay, and so do all rows whose text is null or has no word.
    """
    signed, found = linked_sets(docs, k, percent)
    key = ["id", "h", "o"]
    stay = found.groupBy("c").agg(F.min("row").alias("row")).select("row.id", "row.h", "row.o")
    repeated = signed.groupBy(*key).agg(F.count("*").alias("m")).where("m > 1")
    same = lambda a, b: a.id.eqNullSafe(b.id) & (a.h == b.h) & (a.o == b.o)
    stay = staged(stay.alias("a").join(repeated.alias("b"), F.expr("a.id <=> b.id and a.h = b.h and a.o = b.o"), "left").select("a.*", F.col("m").isNotNull().alias("many")), signed, found)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    keyed = docs.select(row.alias("row"), *(e.alias(n) for e, n in zip(key_columns(docs), key, strict=True)))
    has_words = F.coalesce(F.regexp_like(F.col("row.text").cast("string"), F.lit(WORD)), F.lit(False))
    full = keyed.where(has_words)
    once, many = stay.where("not many"), stay.where("many")
    kept = full.join(once, same(full, once), "left_semi").unionAll(full.join(many, same(full, many), "left_semi").dropDuplicates(key))
    return kept.unionAll(keyed.where(~has_words)).select("row.*")
