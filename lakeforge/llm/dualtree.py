"""Ranked lexical search by dual trees.

Items and documents are sparse vectors over the items' terms: of an item, the weights of its terms; of a document, what each
term's occurrences are worth. Both sides are put into trees whose nodes hold the maximum of each coordinate, so the
product of two nodes bounds the score of every item in the one with every document in the other. Pairs of nodes are taken apart
from the roots down; a pair goes as a whole where its bound is below the weakest k-th best score of the node's items, so
nothing that could be among the k best is lost. What is left at the bottom are exact scores.

Documents are scored in the tasks that hold them: one pass cuts texts into terms and keeps counts of the items' terms (staged),
a second one runs the trees over blocks of rows, with k-th best scores of a share of the documents as floors to start from.
Items are taken in blocks of at most ``CELLS`` (item, term) cells, each of which is one such search; they alone come to the driver.

Null texts have no terms. Every row is a document and every row of ``items`` an item of its own, so repeated rows count as often as they
stand there; null ids are ids, the last of equal scores. Texts of any length are cut at gaps between terms into stretches of about 1 MB.
Empty tables and items without terms give no rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.llm.common import dropped, small_batches, staged
from lakeforge.llm.grams import BASE, Words, agree, cuts, folded, gathered

#: Everything but digits, ASCII letters and bytes of other characters is a gap.
FOLD = folded(bytes(b for b in range(128) if not chr(b).isalnum()))
#: Cells of a block of items or of documents, as doubles 32 MB.
CELLS = 1 << 22
FAN, DOC_ROWS = 8, 512
#: One of so many documents, by row, gives the first floors.
SHARE = 64


class Terms:
    """Different terms, found in texts by key and compared byte by byte."""

    def __init__(self, terms: list[bytes]):
        data = b" ".join(terms)
        for self.base in range(BASE, BASE + 64, 2):  # another base where two terms share a key
            w = Words(data, self.base)
            if len(np.unique(w.keys)) == len(terms):
                break
        self.order = np.argsort(w.keys)
        self.keys, self.data, self.starts, self.ends = w.keys[self.order], data, w.starts, w.ends

    def find(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Places of words that are terms, and the terms' numbers."""
        if not len(self.keys):
            return np.zeros(0, int), np.zeros(0, int)
        near = np.minimum(np.searchsorted(self.keys, w.keys), len(self.keys) - 1)
        at = np.flatnonzero(self.keys[near] == w.keys)
        term = self.order[near[at]]
        same = agree(w.x, w.starts[at], w.ends[at], np.frombuffer(self.data, np.uint8), self.starts[term], self.ends[term])
        return at[same], term[same]


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def counts(texts: list[str | None], terms: Terms) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of all terms of each text; and text, term, occurrences of ``terms``, ordered."""
    total, cells, width = np.zeros(len(texts), np.int64), [], max(1, len(terms.keys))
    parts = ((i, part) for i, text in enumerate(texts) if text for part in cuts(text.encode("utf-8", "surrogatepass").translate(FOLD), b" "))
    for numbers, held in gathered(parts):
        w = Words(b" ".join(held), terms.base)
        begins = np.cumsum([0] + [len(p) + 1 for p in held[:-1]])
        of = np.asarray(numbers)[np.searchsorted(begins, w.starts, "right") - 1]
        total += np.bincount(of, minlength=len(texts))
        at, term = terms.find(w)
        cells.append(np.unique(of[at] * width + term, return_counts=True))
    cell, where = np.unique(np.concatenate([np.zeros(0, np.int64), *(c for c, _ in cells)]), return_inverse=True)
    n = np.bincount(where, np.concatenate([np.zeros(0), *(m for _, m in cells)]), len(cell)).astype(np.int64)
    return total, cell // width, cell % width, n


def vectors(docs: DataFrame, terms: Terms) -> DataFrame:
    """``doc_id, n`` (all terms), ``q`` (numbers of the items' terms), ``tf`` (their occurrences)."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        for batch in batches:
            total, doc, term, tf = counts(batch.column("text").to_pylist(), sent.value)
            offsets = pa.array(np.searchsorted(doc, np.arange(len(total) + 1)).astype(np.int32))
            lists = (pa.ListArray.from_arrays(offsets, pa.array(v.astype(t))) for v, t in ((term, np.int32), (tf, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(total), *lists], ["doc_id", "n", "q", "tf"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n long, q array<int>, tf array<long>")


def tree(rows: np.ndarray) -> list[np.ndarray]:
    """``rows``, then the maxima of each ``FAN`` nodes of the level before, up to the root."""
    out = [rows]
    while len(out[-1]) > 1:
        out.append(np.maximum.reduceat(out[-1], np.arange(0, len(out[-1]), FAN), 0))
    return out


def similar(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """An order in which rows that share their weightiest term stand together."""
    x = (rows > 0) * weights
    top = x.argmax(1)
    x[np.arange(len(x)), top] = 0
    return np.lexsort((x.argmax(1), top))


class Search:
    """Best documents of a block of items, gathered from blocks of documents."""

    def __init__(self, held: list[list[int]], weights: np.ndarray, k: int, floors: np.ndarray | None = None):
        """``held``: the terms' numbers of each item; ``floors``: scores that the k-th best document reaches at least."""
        self.k, self.weights = k, weights
        self.kind = float if int(weights.sum()) * 10**6 < 2**53 else np.int64  # whole numbers either way
        rows = np.zeros((len(held), len(weights)), bool)
        for i, terms in enumerate(held):
            rows[i, terms] = True
        self.order = similar(rows, weights)
        self.items = tree(rows[self.order] * weights.astype(self.kind))
        floors = np.zeros(len(held), np.int64) if floors is None else floors
        self.floors = np.maximum(floors[self.order], 1)
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(held)
        self.met = self.scored = 0

    def alive(self, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Items, documents and scores of the pairs that no bound rules out."""
        floors = [self.floors]
        while len(floors) < len(self.items):
            floors.append(np.minimum.reduceat(floors[-1], np.arange(0, len(floors[-1]), FAN)))
        a, b = len(self.items) - 1, len(docs) - 1
        live = np.ones((len(self.items[a]), len(docs[b])), bool)
        while a or b:
            i, j = np.flatnonzero(live.any(1)), np.flatnonzero(live.any(0))
            x, y = self.items[a][i], docs[b][j]
            held = y.any(0)  # of terms that these documents hold at all
            ok = live[np.ix_(i, j)] & (x[:, held] @ y[:, held].T >= floors[a][i][:, None])
            live = np.zeros_like(live)
            live[np.ix_(i, j)] = ok
            for side in (0, 1):
                if (a, b)[side]:
                    live = np.repeat(live, FAN, side)
            a, b = max(0, a - 1), max(0, b - 1)
            live = live[: len(self.items[a]), : len(docs[b])]
        out = [(np.zeros(0, np.int64),) * 3]
        for g in range(0, live.shape[1], FAN):  # what is left of each lowest node is scored together
            i = np.flatnonzero(live[:, g : g + FAN].any(1))
            if len(i):
                y = docs[0][g : g + FAN]
                held = np.flatnonzero(y.any(0))
                score = self.items[0][np.ix_(i, held)] @ y[:, held].T
                r, c = np.nonzero(score >= floors[0][i][:, None])
                out.append((i[r], c + g, score[r, c].astype(np.int64)))
                self.scored += score.size
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        """Documents with what their terms' occurrences are worth, as many as a block may have."""
        order = similar(rows, self.weights)
        self.met += len(self.order) * len(rows)
        i, j, score = self.alive(tree(rows[order].astype(self.kind)))
        for item in np.unique(i):
            here = i == item
            have = np.concatenate([self.best[item][0], score[here]]), np.concatenate([self.best[item][1], ids[order][j[here]]])
            top = np.lexsort((have[1], -have[0]))[: self.k]
            self.best[item] = have[0][top], have[1][top]
            if len(top) == self.k:
                self.floors[item] = max(self.floors[item], self.best[item][0][-1])

    def found(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Item, scores and ids of the best."""
        for place, item in enumerate(self.order):
            if len(self.best[place][0]):
                yield int(item), *self.best[place]


#: Stands for a null id, after all ids.
NO_ID = np.iinfo(np.int64).max


def searched(rows: DataFrame, held: list[list[int]], weights: np.ndarray, documents: int, words: int, k: int, floors: np.ndarray | None) -> DataFrame:
    """``item, doc_id, score``: the best of each task."""
    sent = rows.sparkSession.sparkContext.broadcast((held, weights, floors))
    size = max(FAN * FAN, min(DOC_ROWS, CELLS // max(1, len(weights))))

    def run(batches):
        search = Search(sent.value[0], sent.value[1], k, sent.value[2])
        for batch in batches:
            q, tf = batch.column("q"), batch.column("tf")
            ends, n = q.offsets.to_numpy(), batch.column("n").to_numpy()
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            m = 50 + (50 * n * documents) // words
            worth = tf.values.to_numpy()
            worth = (10**9 * worth) // (1000 * worth + 20 * np.repeat(m, np.diff(ends)))
            q = q.values.to_numpy()
            for i in range(0, len(n), size):
                j = min(len(n), i + size)
                block = np.zeros((j - i, len(weights)), np.int32)
                block[np.repeat(np.arange(j - i), np.diff(ends[i : j + 1])), q[ends[i] : ends[j]]] = worth[ends[i] : ends[j]]
                search.add(ids[i:j], block)
        for item, score, ids in search.found():
            ids = pa.array(ids, mask=ids == NO_ID)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), item, np.int32)), ids, pa.array(score)], ["item", "doc_id", "score"])

    return rows.mapInArrow(run, "item int, doc_id long, score long")


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item, those of each of 64 groups of tasks first."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = found.withColumn("part", F.spark_partition_id() % 64)
    some = part.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).drop("part")


def search_block(docs: DataFrame, items: list[tuple[int | None, list[bytes]]], k: int, share: int) -> DataFrame:
    """Best documents of items with their different terms."""
    spark = docs.sparkSession
    terms = sorted({t for _, held in items for t in held})
    number = {t: i for i, t in enumerate(terms)}
    stored = rows = staged(vectors(docs, Terms(terms)))
    documents, words = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(terms), np.int64)
    seen = rows.select(F.explode("q").alias("q")).groupBy("q").count().toArrow()  # one row for each term of the block
    df[seen.column("q").to_numpy()] = seen.column("count").to_numpy()
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    held = [[number[t] for t in ts] for _, ts in items]
    rows = rows.where("size(q) > 0")
    floors = np.zeros(len(items), np.int64)
    if documents:
        some = searched(rows.where(F.pmod(F.xxhash64(F.lit(11), "doc_id", "n", "q"), F.lit(share)) == 0), held, weights, documents, words, k, None)
        for r in best_of(some, k).where(F.col("rank") == k).select("item", "score").toLocalIterator():  # one row for each item of the block
            floors[r["item"]] = r["score"]
    out = best_of(searched(rows, held, weights, documents, max(1, words), k, floors), k)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item int, item_id long")
    out = staged(out.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    dropped(stored)
    return out


def search(docs: DataFrame, items: DataFrame, k: int = 50, share: int = SHARE) -> DataFrame:
    """``docs`` has ``doc_id, text``; ``items`` has ``item_id, text``. Returns ``item_id, rank, doc_id, score``."""
    small_batches(docs.sparkSession)
    out, block, terms = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long"), [], set()
    for row in items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).toLocalIterator():
        held = sorted(set(terms_of(row["text"])))
        if not held:
            continue
        if block and (len(block) + 1) * len(terms.union(held)) > CELLS:
            out = out.unionAll(search_block(docs, block, k, share))
            block, terms = [], set()
        block.append((row["item_id"], held))
        terms.update(held)
    return out.unionAll(search_block(docs, block, k, share)) if block else out
