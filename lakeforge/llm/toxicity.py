"""Toxicity by noisy-channel deobfuscation.

A character 4-gram model is counted over all documents. Tokens of any length that look disguised (signs or digits in
words or at their ends, letters three times in a row, letters set apart by blanks) become lattices: each character stands for itself, for
letters it imitates, or for nothing (separators, repeats); Viterbi decoding picks the likeliest reading under
channel and language model. Restored texts are scored by words that go with toxic labels and a logistic fit.

Word statistics and the fit use a bounded sample of labelled rows (``SAMPLE`` by hash of the id). Null and empty
texts have no words and get the score of texts without toxic words. Without usable labels all score the smoothed
base rate. Rows with a null id are not held out and never teach. Repeated rows are scored alike; rows of ``docs`` that share a
labelled id all teach, and a larger number of them is sampled once more by text. Extra columns may have any names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lakeforge.llm.bpe import pieces
from lakeforge.llm.common import crc32_of_id, small_batches

#: Labelled rows, about, from which words and weights are learned.
SAMPLE = 20_000
A = 28  # characters of the language model: boundary, a to z, any other letter
CODES = np.array([b - 96 if 97 <= b <= 122 else 27 if b >= 128 else 0 for b in range(256)], np.int64)
LETTERS_ONLY = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
# Letters that signs and digits imitate.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
ANY = "*#%?"
SIGN = "[" + re.escape("".join(LEET)) + "]"
ODD = f"[{re.escape(''.join(LEET))}{re.escape(ANY)}._~-]"
PART = ODD.replace("[", "[a-z", 1)
ALONE = SIGN.replace("[", "[a-z", 1)
#: What a token in disguise holds: a sign beside a letter, letters with signs or separators between, a letter three times.
CORE = rf"[a-z]{SIGN}|{SIGN}[a-z]|[a-z]{ODD}+[a-z]|([a-z])\1\1"
CLOSING = r"""(?=[.,;:!?)\]}"'…»”]*(?!\S))"""
#: Disguised tokens, with all signs at their ends, and single letters set apart, closing punctuation or not.
DISGUISED = re.compile(rf"""(?<!{PART})(?!\([a-z]\s){PART}*?(?:{CORE}){PART}*|(?<![^\s"'\[{{(«“]){ALONE}(?:\s+{ALONE}(?!\S))+\s+{ALONE}{CLOSING}""")
QUICK = re.compile(rf"{CORE}|(?<![^\W\d_]){ALONE}\s+{ALONE}\s+{ALONE}{CLOSING}")
RUN = re.compile(r"(.)\1{3,}", re.S)
#: Longer tokens (after runs are cut to three) are decoded like others, but not cached.
LONGEST = 64
#: From so many (state, reading) pairs on, the rest of the lattice is worked on as arrays of all states, with the same result.
WIDE = 2000
#: Characters of which such a lattice keeps back pointers (22 KB each).
BLOCK, STAY = 2048, 255
LM_KEEP = 4.0
#: Bytes of a word's beginning.
STEM = 6


@dataclass
class Model:
    lm: bytes
    words: dict[bytes, float] = field(default_factory=dict)
    weights: tuple[float, ...] = (-3.0, 0.0, 0.0, 0.0)


def language_model(docs: DataFrame) -> bytes:
    """Log-probabilities (float32, 28^4) of a character after three others, from counts over all of ``docs``."""
    def count(batches):
        total = np.zeros(A**4, np.int64)
        for batch in batches:
            for part in pieces(batch.column("text").to_pylist()):
                x = CODES[np.frombuffer((" " + " ".join(part).lower() + " ").encode(), np.uint8)]
                x = x[np.concatenate([[True], (x[1:] != 0) | (x[:-1] != 0)])]
                if len(x) > 3:
                    total += np.bincount(((x[:-3] * A + x[1:-2]) * A + x[2:-1]) * A + x[3:], minlength=A**4)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    rows = docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(A**4)
    n[rows.column("gram").to_numpy()] = rows.column("n").to_numpy()
    n, p = n.reshape(A, A, A, A), np.full(A, 1 / A)
    for order in range(4):
        c = n.sum(tuple(range(3 - order))) if order < 3 else n
        p = (c + LM_KEEP * p) / (c.sum(-1, keepdims=True) + LM_KEEP)
    return np.log(p).astype(np.float32).tobytes()


class Restorer:
    """Viterbi decoding of disguised tokens, with a cache."""

    def __init__(self, lm: bytes):
        self.probs = np.frombuffer(lm, np.float32).astype(float)
        self.lm, self.cache = self.probs.tolist(), {}
        self.turned = self.probs.reshape(A, A, A, A).transpose(1, 2, 3, 0).reshape(A * A, A, A)

    def options(self, c: str, before: str, run: bool) -> list[tuple[int, float]]:
        """Readings of one character: a code, or -1 for nothing, and its log-cost. run: it stands in a run of three."""
        if "a" <= c <= "z":
            return [(ord(c) - 96, 0.0), *([(-1, -0.5 if run else -8.0)] if c == before else [])]
        if c.isspace():
            return [(-1, -0.5), (0, -3.0)]
        out = [(0, -4.0), (-1, -2.0 if c not in LEET else -5.0)]
        out += [(ord(x) - 96, -0.7) for x in LEET.get(c, "")]
        if c in ANY:
            out += [(x, -3.0) for x in range(1, 27)]
        return out if c.isascii() or c in LEET else [(27, 0.0)]

    def restore(self, token: str) -> list[bytes]:
        """The words of the likeliest reading."""
        token = RUN.sub(r"\1\1\1", token)
        if token in self.cache:
            return self.cache[token]
        out = self.decode(token)
        if len(token) <= LONGEST:
            if len(self.cache) > 200_000:
                self.cache.clear()
            self.cache[token] = out
        return out

    def step(self, score: np.ndarray, options: list[tuple[int, float]]) -> tuple[np.ndarray, np.ndarray]:
        """A step of ``decode`` over all states at once: scores, and for each state the first character of the one before it
        (``STAY`` where the character was read as nothing)."""
        codes, cost = [c for c, _ in options if c >= 0], np.array([x for c, x in options if c >= 0])
        before = score.reshape(A, A * A)
        live = np.flatnonzero((before > -np.inf).any(0))  # pairs of last characters that occur
        x = self.turned[live[:, None], codes] + before[:, live].T[:, None]
        first = x.argmax(-1)
        after, back = np.full((A * A, A), -np.inf), np.full((A * A, A), STAY, np.uint8)
        after[live[:, None], codes] = x.reshape(-1, A)[np.arange(first.size), first.ravel()].reshape(first.shape) + cost
        back[live[:, None], codes] = first
        after, back = after.ravel(), back.ravel()
        for stay in (score + x for c, x in options if c < 0):
            better = stay > after
            after[better], back[better] = stay[better], STAY
        return after, back

    def dense(self, options: list[list[tuple[int, float]]], states: dict) -> tuple:
        """The likeliest path from ``states`` on; back pointers are kept for ``BLOCK`` characters, and made again from there for more."""
        score, marks, back = np.full(A**3, -np.inf), [], []
        score[list(states)] = [x for x, _ in states.values()]
        for i, o in enumerate(options):
            if i % BLOCK == 0:
                marks.append(score)
                back = []
            score, way = self.step(score, o)
            back.append(way)
        s, codes = int((score + self.probs.reshape(-1, A)[:, 0]).argmax()), []
        for b in reversed(range(len(marks))):
            if b < len(marks) - 1:
                score, back = marks[b], []
                for o in options[b * BLOCK : (b + 1) * BLOCK]:
                    score, way = self.step(score, o)
                    back.append(way)
            for way in reversed(back):
                if way[s] != STAY:
                    codes.append(s % A)
                    s = int(way[s]) * A * A + s // A
        path = states[s][1]
        for c in reversed(codes):
            path = (path, c)
        return path

    def decode(self, token: str) -> list[bytes]:
        lm = self.lm
        states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        options = lambda i: self.options(token[i], token[i - 1] if i else "", token[i] * 3 in token[max(0, i - 2) : i + 3])
        path = None
        for i in range(len(token)):
            after: dict[int, tuple[float, tuple | None]] = {}
            read = options(i)
            if len(states) * len(read) > WIDE:
                path = self.dense([options(j) for j in range(i, len(token))], states)
                break
            for s, (score, way) in states.items():
                for code, cost in read:
                    if code < 0:
                        t, x, new = s, score + cost, way
                    else:
                        t = (s * A + code) % A**3
                        x, new = score + cost + lm[s * A + code], (way, code)
                    if t not in after or after[t][0] < x:
                        after[t] = (x, new)
            states = after
        else:
            path = max(((x + lm[s * A], str(s), p) for s, (x, p) in states.items()), key=lambda y: y[:2])[2]
        codes = []
        while path:
            path, code = path
            codes.append(code)
        return "".join(chr(96 + c) if 0 < c < 27 else " " for c in reversed(codes)).encode().split()

    def words(self, text: str) -> list[bytes]:
        """Letter words of the text, and those of what its disguised tokens stand for."""
        text = text.lower()
        words = text.encode().translate(LETTERS_ONLY).split()
        if QUICK.search(text):
            for m in DISGUISED.finditer(text):
                plain = Counter(m[0].encode().translate(LETTERS_ONLY).split())  # these are in ``words`` already
                words += (Counter(self.restore(m[0])) - plain).elements()
        return words


def stems(words) -> list[bytes]:
    """Marked beginnings of longer words, which stand for all words that start so."""
    return [b"^" + w[:STEM] for w in words if len(w) > STEM]


def features(words: list[bytes], known: dict[bytes, float]) -> tuple[float, float, float]:
    """Highest weight of a known word or stem, log of known ones, different ones."""
    hits = [w for w in words if w in known] + [w for w in stems(words) if w in known]
    return (max(known[w] for w in hits), math.log1p(len(hits)), float(len(set(hits)))) if hits else (0.0, 0.0, 0.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(crc32_of_id(doc_id) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Language model over all ``docs``; words and weights from about ``sample`` labelled rows that are not held out."""
    spark = docs.sparkSession
    small_batches(spark)
    lm = language_model(docs)
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").cast("int")).distinct()
    n = usable.count()
    if not n:
        return Model(lm)
    share = lambda rows, *by: F.pmod(F.xxhash64(F.lit(8), *by), F.lit(1_000_000)) < int(1e6 * min(1.0, sample / max(1, rows)))
    drawn = usable.where(share(n, "doc_id"))  # about ``sample`` ids, with two labels at most
    n = docs.select("doc_id").join(F.broadcast(drawn), "doc_id").count()  # more, where ids repeat in ``docs``
    taught = docs.select("doc_id", "text").where(share(n / 2, "doc_id", F.xxhash64("text"))).join(F.broadcast(drawn), "doc_id")
    lm_sent = spark.sparkContext.broadcast(lm)

    def count(batches):
        r, seen = Restorer(lm_sent.value), {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = set(r.words(text or ""))
                seen[y].update(words)
                seen[y].update(set(stems(words)))
                seen[y][b""] += 1
        rows = [(w.decode("utf-8", "replace"), y, k) for y in seen for w, k in seen[y].items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int64()))], ["word", "toxic", "n"])

    sums = taught.select("text", "toxic").mapInArrow(count, "word string, toxic int, n long").groupBy("word").agg(F.sum(F.col("n") * F.col("toxic")).alias("bad"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("good"))
    total = sums.where("word = ''").first()
    if total is None or not total.bad or not total.good:
        return Model(lm, {}, (math.log((1 + (total.bad if total else 0)) / (9 + (total.good if total else 0))), 0.0, 0.0, 0.0))
    odds = F.log((F.col("bad") + 0.5) / (total.bad + 1)) - F.log((F.col("good") + 0.5) / (total.good + 1))
    error = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    strong = sums.where("word <> '' and bad >= 4").withColumn("odds", odds).where((F.col("odds") > 1.2) & (F.col("odds") > 3.5 * error))
    words = {r.word.encode(): r.odds for r in strong.select("word", "odds").toLocalIterator()}  # of a bounded sample

    def measure(batches):
        r = Restorer(lm_sent.value)
        for batch in batches:
            x = [features(r.words(t or ""), words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *(pa.array([v[i] for v in x], pa.float64()) for i in range(3))], ["toxic", "a", "b", "c"])

    rows = taught.select("text", "toxic").mapInArrow(measure, "toxic int, a double, b double, c double").groupBy("toxic", "a", "b", "c").count().toPandas().sort_values(["toxic", "a", "b", "c"])
    x = np.column_stack([np.ones(len(rows)), rows[["a", "b", "c"]].to_numpy()])
    y, m, w = rows["toxic"].to_numpy(float), rows["count"].to_numpy(float), np.zeros(4)
    for _ in range(30):  # Newton steps of a ridge logistic fit
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (m * (y - p)) - 0.1 * w
        w = w + np.linalg.solve((x.T * (m * p * (1 - p))) @ x + 0.1 * np.eye(4), g)
    return Model(lm, words, tuple(w.tolist()))


def scored(docs: DataFrame, model: Model, threshold: float = 0.3, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``row`` (the columns ``keep`` of ``docs``, all by default, as a struct), ``score``, ``predicted``."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        r = Restorer(m.lm)
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                x = features(r.words(text or ""), m.words)
                z = m.weights[0] + sum(w * v for w, v in zip(m.weights[1:], x, strict=True))
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.float64())], ["row", "score"])

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep or docs.columns)).alias("row"), F.col("text").cast("string").alias("text"))
    got = rows.mapInArrow(run, StructType([rows.schema["row"], StructField("score", DoubleType())]))
    return got.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def score(docs: DataFrame, model: Model, threshold: float = 0.3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` with ``score`` and ``predicted``, which replace columns of these names."""
    rest = [f"row.`{c}`" for c in keep if c not in ("score", "predicted")]
    return scored(docs, model, threshold, keep).select(*rest, "score", "predicted")
