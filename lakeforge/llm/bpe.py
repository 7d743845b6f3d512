"""BPE encoding and decoding with a minimal acyclic transducer for frequent words and exact merges for the rest.

Texts are cut into white-space chunks and those into the tokenizer's words; where characters are not plain, the tokenizers
library's own normaliser and pre-tokenizer do it. Frequent words (counted over all documents) are compiled into a minimal
acyclic automaton whose arcs carry additive outputs: the sum along a word is its ordinal, which indexes its token ids.
The automaton is a flat file that workers memory-map. Words outside it are merged by rank, many words at once. Results equal the tokenizers library's.

Null texts count as empty and give no ids. Extra columns are ignored. Repeated rows give repeated results.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import mmap
import re
import tempfile
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import small_batches

#: Characters for which lower-casing, NFC and character classes need no tables: all below U+0250 but file separators.
UNUSUAL = regex.compile("[^\x00-\x1b\x20-ɏ]")
UNUSUAL_ASCII = re.compile("[\x1c-\x1f]")
PIECE_CHARS = 500_000
LONG_WORD = 48


def byte_chars() -> list[str]:
    """The usual byte-level alphabet: printable Latin-1 stands for itself, the rest is moved above U+0100."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return [chr(b) if b in keep else chr(256 + sum(x not in keep for x in range(b))) for b in range(256)]


class Vocabulary:
    """What the tokenizer file says, as arrays: start symbols, merge ranks, token texts."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model, self.suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab = model["vocab"]
        self.chars = byte_chars()
        self.n = 1 + max(vocab.values())
        self.first = np.array([[vocab[c], vocab[c + self.suffix]] for c in self.chars], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        code = np.array([vocab[a] * self.n + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(code, kind="stable")
        self.code, self.rank = code[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.texts = [""] * (1 + max([self.n - 1, *special.values()]))
        for text, i in [*vocab.items(), *special.items()]:
            self.texts[i] = text
        self.none = np.int32(2**31 - 1)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code = a * self.n + b
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where((self.code[at] == code) & (a >= 0) & (b >= 0), self.rank[at], self.none)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian uint32) of each word: the leftmost pair of lowest rank is merged until none is left."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(sizes > LONG_WORD):
            out[i] = self._merge_long(words[i])
        for low, high in ((0, 8), (8, 16), (16, LONG_WORD)):
            at = np.flatnonzero((sizes > low) & (sizes <= high))
            for i in range(0, len(at), 20_000):
                self._merge_many(words, at[i : i + 20_000], sizes, high, out)
        return out

    def _merge_many(self, words: list[bytes], at: np.ndarray, sizes: np.ndarray, width: int, out: list[bytes]) -> None:
        if not len(at):
            return
        grid = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in at), np.uint8).reshape(-1, width)
        n, col = sizes[at], np.arange(width)
        sym = np.where(col < n[:, None], self.first[grid, 0], -1)
        rows = np.arange(len(at))
        sym[rows, n - 1] = self.first[grid[rows, n - 1], 1]
        after = np.tile(np.arange(1, width + 2), (len(at), 1))
        before = np.tile(np.arange(-1, width), (len(at), 1))
        sym = np.concatenate([sym, np.full((len(at), 2), -1)], 1)
        rank = np.full((len(at), width), self.none, np.int32)
        rank[:, :-1] = self.ranks(sym[:, : width - 1], sym[:, 1:width])
        live = rows
        while len(live):
            i = rank[live].argmin(1)
            r = rank[live, i]
            live, i, r = live[r < self.none], i[r < self.none], r[r < self.none]
            if not len(live):
                break
            j = after[live, i]
            k = after[live, j]
            new = self.made[r]
            sym[live, i], sym[live, j] = new, -1
            after[live, i] = k
            inside = k < width
            before[live[inside], k[inside]] = i[inside]
            rank[live, j] = self.none
            rank[live, i] = np.where(inside, self.ranks(new, sym[live, np.minimum(k, width)]), self.none)
            p = before[live, i]
            has = p >= 0
            rank[live[has], p[has]] = self.ranks(sym[live[has], p[has]], new[has])
        kept = sym >= 0
        flat, ends = sym[kept].astype("<u4").tobytes(), np.cumsum(kept.sum(1)) * 4
        start = 0
        for i, end in zip(at.tolist(), ends.tolist(), strict=True):
            out[i] = flat[start:end]
            start = end

    def _merge_long(self, word: bytes) -> bytes:
        """One long word by a heap of (rank, place)."""
        sym = [int(self.first[b, 0]) for b in word]
        sym[-1] = int(self.first[word[-1], 1])
        n, known = len(sym), dict(zip(self.code.tolist(), self.rank.tolist(), strict=True)) if not hasattr(self, "_known") else self._known
        self._known = known
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(known[c], i, sym[i], sym[i + 1]) for i in range(n - 1) if (c := sym[i] * self.n + sym[i + 1]) in known]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if sym[i] == a else n
            if j >= n or sym[j] != b:
                continue
            sym[i], sym[j] = int(self.made[r]), -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (c := sym[x] * self.n + sym[y]) in known:
                    heapq.heappush(heap, (known[c], x, sym[x], sym[y]))
        return np.array([s for s in sym if s >= 0], "<u4").tobytes()


def compile_transducer(words: dict[bytes, bytes]) -> bytes:
    """The flat file of a minimal acyclic transducer from words to ids: equal suffix automata are shared."""
    register: dict[tuple, int] = {}
    arcs: list[tuple[tuple[int, int], ...]] = []
    below: list[int] = []
    final: list[bool] = []

    def close(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(arcs)
            arcs.append(key[1])
            final.append(node[0])
            below.append(node[0] + sum(below[t] for _, t in key[1]))
        return register[key]

    path: list[list] = [[False, []]]
    last, ordered = b"", sorted(w for w in words if w)
    for word in [*ordered, b""]:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        while len(path) > same + 1:
            done = path.pop()
            path[-1][1].append((last[len(path) - 1], close(done)))
        path += [[False, []] for _ in word[same:]]
        if word:
            path[-1][0] = True
        last = word
    root = close(path[0])
    keys, targets, outputs = [], [], []
    for state, out in enumerate(arcs):
        passed = int(final[state])
        for byte, target in out:
            keys.append(state * 256 + byte)
            targets.append(target)
            outputs.append(passed)
            passed += below[target]
    ids = [words[w] for w in ordered]
    ends = np.cumsum([0, *map(len, ids)]) // 4
    head = np.array([root, len(keys), len(arcs), len(ids)], "<i8")
    order = np.argsort(keys, kind="stable") if keys else np.zeros(0, int)
    column = lambda x, kind: np.asarray(x, kind)[order].tobytes()
    return b"".join([head.tobytes(), column(keys, "<i8"), column(targets, "<i8"), column(outputs, "<i8"), np.array(final, "<i8").tobytes(), ends.astype("<i8").tobytes(), *ids])


class Transducer:
    """A compiled transducer, memory-mapped; looks up many words at once."""

    def __init__(self, blob: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(blob)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        root, n_arcs, n_states, n_words = np.frombuffer(self.map, "<i8", 4)
        self.root, at = int(root), 32
        take = lambda n: (np.frombuffer(self.map, "<i8", int(n), at), at + 8 * int(n))
        self.key, at = take(n_arcs)
        self.target, at = take(n_arcs)
        self.output, at = take(n_arcs)
        self.final, at = take(n_states)
        self.ends, self.ids_at = take(n_words + 1)

    def lookup(self, words: list[bytes]) -> list[bytes | None]:
        if not words or not len(self.key):
            return [None] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        state, total = np.where(sizes <= LONG_WORD, self.root, -1), np.zeros(len(words), np.int64)
        grid = np.frombuffer(b"".join(w[:LONG_WORD].ljust(LONG_WORD, b"\0") for w in words), np.uint8).reshape(-1, LONG_WORD)
        for i in range(LONG_WORD):
            live = np.flatnonzero((sizes > i) & (state >= 0))
            if not len(live):
                break
            key = state[live] * 256 + grid[live, i]
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = self.key[at] == key
            state[live] = np.where(hit, self.target[at], -1)
            total[live] += np.where(hit, self.output[at], 0)
        found = (state >= 0) & (sizes > 0)
        found[found] = self.final[state[found]] == 1
        starts, ends = self.ids_at + 4 * self.ends[:-1], self.ids_at + 4 * self.ends[1:]
        return [self.map[starts[t] : ends[t]] if f else None for f, t in zip(found.tolist(), total.tolist(), strict=True)]


class Cutter:
    """A text's chunks and their words, as the tokenizer file has it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.normalise, self.pre_tokenise = self.library.normalizer.normalize_str, self.library.pre_tokenizer.pre_tokenize_str
        self.fixed = {t.content: np.array([i], "<u4").tobytes() for i, t in self.library.get_added_tokens_decoder().items()}
        self.split_fixed = regex.compile("(" + "|".join(map(regex.escape, sorted(self.fixed, key=len, reverse=True))) + ")") if self.fixed else None
        parts = json.loads(self.library.pre_tokenizer.__getstate__())["pretokenizers"]
        self.words = regex.compile(parts[0]["pattern"]["Regex"])
        self.chars = "".join(byte_chars())
        self.bytes = {c: bytes([b]) for b, c in enumerate(self.chars)}

    def chunks(self, text: str) -> list[str]:
        """White-space chunks of the normalised text."""
        if UNUSUAL_ASCII.search(text) if text.isascii() else UNUSUAL.search(text):
            return [c for c in self.normalise(text).split(" ") if c]
        return text.lower().split()

    def parts(self, text: str) -> list[tuple[bool, list[str]]]:
        """Chunks between special tokens, and those (True)."""
        if not self.fixed or "<|" not in text:
            return [(False, self.chunks(text))]
        return [(True, [p]) if i % 2 else (False, self.chunks(p)) for i, p in enumerate(self.split_fixed.split(text))]

    def cut(self, chunk: str) -> list[str | bytes]:
        """Words of a chunk: text, or UTF-8 bytes (a word need not be whole characters for the library)."""
        if chunk.isalpha() and chunk.isascii():
            return [chunk]
        if UNUSUAL.search(chunk):
            return [b"".join([self.bytes[c] for c in w]) for w, _ in self.pre_tokenise(chunk)]
        return [chunk] if chunk.isalpha() else self.words.findall(chunk)


class Encoder(Cutter):
    """Texts to ids; ``resolve`` gives the ids of words (UTF-8) that the caches of chunks lack.

    There are two caches: what the young one lacks is moved over from the old one or resolved, and a full young one
    becomes the old one. So memory is bounded and chunks in use stay.
    """

    def __init__(self, path: str, vocabulary: Vocabulary, resolve: Callable[[list[bytes]], list[bytes]], cached: int = 300_000):
        super().__init__(path)
        self.v, self.resolve, self.cached, self.young, self.old = vocabulary, resolve, cached, {}, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [self.parts(text) for text in texts]
        if len(self.young) > self.cached:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        lacking = [w for w in set().union(*(c for p in parts for special, c in p if not special)) if w not in young]
        new = []
        for w in lacking:
            if w in old:
                young[w] = old[w]
            else:
                new.append(w)
        if new:
            self._learn(new)
        return [b"".join([(self.fixed if special else young)[w] for special, c in p for w in c]) for p in parts]

    def _learn(self, new: list[str]) -> None:
        young, old = self.young, self.old
        cut = {w: self.cut(w) for w in new}
        ids = {}
        for p in cut.values():
            for x in p:
                if x not in ids:
                    ids[x] = young.get(x) or old.get(x)
        missing = [x for x, known in ids.items() if known is None]
        ids.update(zip(missing, self.resolve([x.encode() if isinstance(x, str) else x for x in missing]), strict=True))
        for w, p in cut.items():
            young[w] = ids[p[0]] if len(p) == 1 else b"".join([ids[x] for x in p])


#: Encoders outlive a task where Spark reuses its Python workers, so that caches stay warm.
_KEPT: dict[tuple, Cutter] = {}


def kept(key: tuple, make: Callable[[], Cutter]) -> Cutter:
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def pieces(texts: list[str | None]) -> Iterator[list[str]]:
    """Runs of texts of about ``PIECE_CHARS`` characters together; a null text is empty."""
    part, n = [], 0
    for text in texts:
        part.append(text or "")
        n += len(part[-1])
        if n >= PIECE_CHARS:
            yield part
            part, n = [], 0
    if part:
        yield part


def own_encoder(path: str, blob: bytes) -> Encoder:
    return kept((path, hashlib.md5(blob).digest()), lambda: _own_encoder(path, blob))


class LibraryEncoder(Cutter):
    """Words go through the tokenizers library's own model; the ids of chunks that are met again are cached."""

    #: Slots that tell whether a chunk (or one that shares the slot) has been met.
    MET = 1 << 20

    class Cache(dict):
        def __init__(self, encoder: LibraryEncoder):
            super().__init__()
            self.encoder = encoder

        def __missing__(self, chunk: str) -> bytes:
            e = self.encoder
            ids = e.old.get(chunk)
            if ids is None:
                if chunk.isalpha() and (e.plain or not UNUSUAL.search(chunk)):
                    ids = e.model_ids(chunk)
                elif e.plain and (letters := chunk[:-1]).isalpha():  # a word and one sign
                    ids = self[letters] + self[chunk[-1]]
                else:
                    ids = e.composed(chunk)
                slot = hash(chunk) % e.MET
                if not e.met[slot]:
                    e.met[slot] = 1
                    return ids
            self[chunk] = ids
            return ids

    def __init__(self, path: str, cached: int = 160_000):
        super().__init__(path)
        self.cached, self.old, self.met, self.plain = cached, {}, bytearray(self.MET), True
        self.tokenise, self.young = self.library.model.tokenize, self.Cache(self)
        self.four = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size())]

    def model_ids(self, word: str | bytes) -> bytes:
        if isinstance(word, bytes) or not (word.isascii() and word.isprintable()):
            word = codecs.charmap_decode(word if isinstance(word, bytes) else word.encode(), "strict", self.chars)[0]
        four = self.four
        return b"".join([four[t.id] for t in self.tokenise(word)])

    def composed(self, chunk: str) -> bytes:
        words = self.cut(chunk)
        return b"".join([self.young[w] if w != chunk and isinstance(w, str) else self.model_ids(w) for w in words])

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.young) > self.cached:
            self.old, self.young, self.met = dict(self.young), self.Cache(self), bytearray(self.MET)
        known, fixed, out = self.young.__getitem__, self.fixed.__getitem__, []
        for text in texts:
            self.plain = not (UNUSUAL_ASCII.search(text) if text.isascii() else UNUSUAL.search(text))
            if self.plain and "<|" not in text:
                out.append(b"".join(map(known, text.lower().split())))
            else:
                out.append(b"".join([x for special, chunks in self.parts(text) for x in map(fixed if special else known, chunks)]))
        return out


def library_encoder(path: str) -> LibraryEncoder:
    return kept((path,), lambda: LibraryEncoder(path))


def _own_encoder(path: str, blob: bytes) -> Encoder:
    v, t = Vocabulary(path), Transducer(blob)

    def resolve(words: list[bytes]) -> list[bytes]:
        ids = t.lookup(words)
        missing = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(missing, v.merge([words[i] for i in missing]), strict=True):
            ids[i] = x
        return ids

    return Encoder(path, v, resolve)


def decode(v: Vocabulary, ids: bytes) -> str:
    """As the library without a decoder: token texts joined by blanks."""
    texts = v.texts
    return " ".join([texts[i] for i in np.frombuffer(ids, "<u4").tolist()])


def frequent_words(docs: DataFrame, share: float = 2e-6, most: int = 32_768) -> list[str]:
    """The ``most`` commonest letter words, counted over all of ``docs`` by lossy counting.

    Each partition counts all its words exactly and reports those that reach ``share`` of them; a word's sum
    is short of its true count by at most ``share`` of all words. Ties go to the smaller word.
    """
    def count(batches):
        seen: Counter = Counter()
        total = floor = 0
        for batch in batches:
            for texts in pieces(batch.column("text").to_pylist()):
                words = [w for t in texts for w in t.lower().split()]
                total += len(words)
                seen.update(words)
                if len(seen) > 400_000:  # lossy counting: what stayed below the share goes
                    floor = share * total
                    seen = Counter({w: n for w, n in seen.items() if n > floor})
        kept = [(w, n) for w, n in seen.items() if n >= share * total and w.isalpha()]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

    counted = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r.word for r in counted.orderBy(F.desc("n"), "word").limit(most).collect()]


def build_lexicon(docs: DataFrame, path: str, share: float = 2e-6, most: int = 32_768) -> bytes:
    """Transducer file of the frequent words of ``docs``; its size is bounded by ``most``."""
    words = [w.encode() for w in frequent_words(docs, share, most)]
    return compile_transducer(dict(zip(words, Vocabulary(path).merge(words), strict=True)))


def round_trip(docs: DataFrame, path: str, lexicon: bytes | None = None) -> DataFrame:
    """``doc_id, ids`` (little-endian uint32), ``decoded`` of every whole text."""
    small_batches(docs.sparkSession)
    blob = docs.sparkSession.sparkContext.broadcast(build_lexicon(docs, path) if lexicon is None else lexicon)

    def run(batches):
        coder = own_encoder(path, blob.value)
        for batch in batches:
            ids = [x for part in pieces(batch.column("text").to_pylist()) for x in coder.encode(part)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array([decode(coder.v, x) for x in ids], pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary, decoded string")


def digest(coded: DataFrame) -> DataFrame:
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
