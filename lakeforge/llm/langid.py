"""Language ID with language-bitmask n-gram filters.

Character trigrams (with word ends, hashed to ``BINS``) are counted for each language over all teaching documents.
Those with at least ``SHARE`` of a language's trigrams go into its Bloom filter. The filters are bit-sliced: one
table of positions whose words hold a bit for each language, so that one lookup (the AND of a few positions) returns
all languages that contain a trigram. A text's popcounts by language, corrected for each filter's false positives,
decide; ties go to the smaller language. Sizes are fixed by ``BINS`` and the number of languages.

Texts that are null or have no letter are ``und`` with score 0. Without teaching rows everything is ``und``. Long texts are read
whole; repeated rows teach and are answered as often as they stand there. Extra columns are ignored, whatever their names. Empty
tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.bpe import pieces
from lakeforge.llm.common import crc32_of_id, dropped, small_batches, staged

BINS = 1 << 20
POSITIONS = 1 << 19
PROBES = 3
SHARE = 1e-5
LATIN = np.array([c if chr(c).isalpha() else 0 for c in range(0x250)], np.uint64)


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text, 0 for all but letters."""
    x = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    low = LATIN[np.minimum(x, 0x24F).astype(np.int64)]
    far = x >= 0x250
    if far.any():
        kinds, at = np.unique(x[far], return_inverse=True)
        low[far] = np.array([c if chr(c).isalpha() else 0 for c in kinds.tolist()], np.uint64)[at]
    return low


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all trigrams whose middle is a letter, and the text that each is from."""
    parts = [letters(f" {t} ") for t in texts]
    x = np.concatenate(parts)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    at = np.flatnonzero(x[1:-1]) + 1
    gram = (x[at - 1] << np.uint64(42)) | (x[at] << np.uint64(21)) | x[at + 1]
    return (mixed(gram) & np.uint64(BINS - 1)).astype(np.int64), owner[at]


def positions(bins: np.ndarray) -> list[np.ndarray]:
    return [(mixed(bins.astype(np.uint64) + np.uint64(BINS * (i + 1))) & np.uint64(POSITIONS - 1)).astype(np.int64) for i in range(PROBES)]


@dataclass
class Filters:
    languages: list[str]
    table: np.ndarray  # POSITIONS x words of 64 languages
    wrong: np.ndarray  # false-positive rate by language
    common: int  # the language with most trigrams


def teaches(doc_id: Column) -> Column:
    return F.coalesce(crc32_of_id(doc_id) % 3 != 1, F.lit(False))


def learn(docs: DataFrame) -> Filters:
    """Filters from ``text`` and ``lang`` of all rows that are not held out."""
    small_batches(docs.sparkSession)

    def count(batches):
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            texts: dict[str, list[str]] = {}
            for t, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                texts.setdefault(lang, []).append(t)
            for lang, all_ in texts.items():
                n = seen.setdefault(lang, np.zeros(BINS, np.int32))
                for part in pieces(all_):
                    bins, _ = trigrams(part)
                    if len(bins) * 8 > BINS:
                        n += np.bincount(bins, minlength=BINS).astype(np.int32)
                    else:
                        np.add.at(n, bins, 1)
        for lang, n in seen.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at].astype(np.int64))], ["lang", "bin", "n"])

    taught = docs.where(teaches(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", F.col("lang").cast("string"))
    sums = taught.mapInArrow(count, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    sums = staged(sums)
    totals = {r.lang: r.n for r in sums.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    kept = sums.join(F.broadcast(docs.sparkSession.createDataFrame([(k, int(v)) for k, v in totals.items()], "lang string, total long")), "lang").where(F.col("n") >= F.greatest(F.lit(2.0), F.col("total") * SHARE)).select("lang", "bin").toArrow()
    dropped(sums)
    table = np.zeros((POSITIONS, max(1, -(-len(languages) // 64))), np.uint64)
    which, bins = np.array([languages.index(x) for x in kept.column("lang").to_pylist()], np.int64), kept.column("bin").to_numpy()
    wrong = np.zeros(len(languages))
    for i in range(len(languages)):
        mark = np.zeros(POSITIONS, bool)
        for p in positions(bins[which == i]):
            mark[p] = True
        table[mark, i // 64] |= np.uint64(1) << np.uint64(i % 64)
        wrong[i] = mark.mean() ** PROBES
    return Filters(languages, table, wrong, int(np.argmax([totals[x] for x in languages])) if languages else 0)


def decide(f: Filters, texts: list[str]) -> tuple[list[str], np.ndarray]:
    bins, owner = trigrams(texts)
    n = np.bincount(owner, minlength=len(texts))
    p = positions(bins)
    masks = f.table[p[0]]
    for q in p[1:]:
        masks &= f.table[q]
    hits = np.zeros((len(texts), len(f.languages)))
    for i in range(len(f.languages)):
        bit = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
        hits[:, i] = np.bincount(owner, bit.astype(np.float64), minlength=len(texts))
    true = np.maximum(0, hits - n[:, None] * f.wrong) / (1 - np.minimum(f.wrong, 0.999))
    best, total = true.argmax(1), true.sum(1)
    best = np.where(total > 0, best, f.common)
    score = np.where(total > 0, true[np.arange(len(texts)), best] / np.maximum(total, 1e-9), 0.0)
    return ["und" if not k else f.languages[b] for k, b in zip(n.tolist(), best.tolist(), strict=True)], np.where(n > 0, score, 0.0)


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        for batch in batches:
            said, scores = [], [np.zeros(0)]
            for part in pieces(batch.column("text").to_pylist()):
                if sent.value.languages:
                    a, b = decide(sent.value, part)
                else:
                    a, b = ["und"] * len(part), np.zeros(len(part))
                said, scores = said + a, [*scores, b]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(said, pa.string()), pa.array(np.concatenate(scores))], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double")
