"""Token ids as patched frame-of-reference blocks.

A shard is a Parquet directory that Spark commits; each row is one self-contained segment of whole documents
in ascending ``doc_id`` order (nulls first): ids of documents and their lengths, and ``payload``. A payload
holds blocks of 128 ids. From each block its minimum is subtracted; the rest is packed at the width that holds
the 90th percentile, and larger values keep their low bits there while place and whole value go to the block's
exception list. An index gives each block's start in words, so that any block is read alone.

Null texts give a document of the end id only. Repeated rows are kept; rows with equal or null ids are ordered, and dealt
to tasks, by a hash of their text. Extra columns are ignored, whatever their names. Empty tables give no segments.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeforge.llm.bpe import library_encoder, pieces
from lakeforge.llm.common import shuffles_freed, small_batches

BLOCK = 128
#: A segment ends with the document that reaches so many ids; so many segments are packed at once.
SEGMENT_IDS, TOGETHER = 1 << 16, 8
#: In each block so many of the 128 values must fit the packed width.
FITTING = 115


def widths(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.int64)


INDEX = np.dtype([("start", "<u4"), ("base", "<u4"), ("exceptions", "<u4"), ("width", "u1"), ("count", "u1")])


def lanes_of(width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word and shift of each of the 128 values packed at ``width``, and which of them reach into the next word."""
    word, shift = np.divmod(np.arange(BLOCK) * width, 64)
    return word, shift.astype(np.uint64), np.flatnonzero(shift + width > 64)


def pack(segments: list[np.ndarray]) -> list[bytes]:
    """For each segment: header (ids, blocks, words, exceptions), index, packed words, exceptions."""
    blocks = [-(-len(s) // BLOCK) for s in segments]
    padded = [x for s, n in zip(segments, blocks, strict=True) for x in (s, np.full(n * BLOCK - len(s), s[-1] if len(s) else 0))]
    grid = np.concatenate([np.zeros(0, np.uint32), *padded]).astype(np.uint32).reshape(-1, BLOCK)
    index = np.zeros(len(grid), INDEX)
    if len(grid):
        index["base"] = grid.min(1)
    rest = grid - index["base"][:, None]
    if len(grid):
        index["width"] = widths(np.partition(rest, FITTING - 1, axis=1)[:, FITTING - 1])
    width = index["width"].astype(np.int64)
    limit = ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
    out_at = rest > limit[:, None]
    index["count"] = out_at.sum(1)
    starts, exceptions = np.cumsum([0, *(2 * width)]), np.cumsum([0, *index["count"].astype(np.int64)])
    words = np.zeros(int(starts[-1]), np.uint64)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        x = (rest[rows] & limit[rows][:, None]).astype(np.uint64)
        word, shift, over = lanes_of(w)
        lanes = np.bitwise_or.reduceat(x << shift, np.flatnonzero(np.diff(word, prepend=-1)), axis=1)
        lanes[:, word[over] + 1] |= x[:, over] >> (np.uint64(64) - shift[over])
        words[starts[rows][:, None] + np.arange(2 * w)] = lanes
    block, place = np.nonzero(out_at)
    values, places, words = rest[block, place].astype("<u4"), place.astype("u1"), words.astype("<u8")
    out, a = [], 0
    for s, n in zip(segments, blocks, strict=True):
        b = a + n
        part, w, e = index[a:b].copy(), slice(starts[a], starts[b]), slice(exceptions[a], exceptions[b])
        part["start"], part["exceptions"] = starts[a:b] - starts[a], exceptions[a:b] - exceptions[a]
        head = np.array([len(s), n, w.stop - w.start, e.stop - e.start], "<u4")
        out.append(b"".join([head.tobytes(), part.tobytes(), words[w].tobytes(), values[e].tobytes(), places[e].tobytes()]))
        a = b
    return out


def unpack(payloads: list[bytes], first: int = 0, last: int | None = None) -> list[np.ndarray]:
    """The ids of blocks ``first`` to ``last`` (exclusive; all by default) of each payload."""
    sizes, indexes, words, values, places, n_word, n_value = [], [np.zeros(0, INDEX)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.uint8)], 0, 0
    for p in payloads:
        n, n_blocks, n_words, n_out = (int(x) for x in np.frombuffer(p, "<u4", 4))
        at = 16 + INDEX.itemsize * n_blocks
        end = n_blocks if last is None else min(last, n_blocks)
        index = np.frombuffer(p, INDEX, n_blocks, 16)[first:end].astype([(k, np.int64) for k in INDEX.names])
        index["start"] += n_word
        index["exceptions"] += n_value
        sizes.append((len(index), min(n, end * BLOCK) - first * BLOCK))
        indexes.append(index)
        words.append(np.frombuffer(p, "<u8", n_words, at))
        values.append(np.frombuffer(p, "<u4", n_out, at + 8 * n_words))
        places.append(np.frombuffer(p, "u1", n_out, at + 8 * n_words + 4 * n_out))
        n_word, n_value = n_word + n_words, n_value + n_out
    index, words, values, places = (np.concatenate(x) for x in (indexes, words, values, places))
    grid = np.zeros((len(index), BLOCK), np.uint64)
    for w in np.unique(index["width"]).tolist():
        if not w:
            continue
        rows = np.flatnonzero(index["width"] == w)
        lanes = words[index["start"][rows].astype(np.int64)[:, None] + np.arange(2 * w)]
        word, shift, over = lanes_of(w)
        x = lanes[:, word] >> shift
        x[:, over] |= lanes[:, word[over] + 1] << (np.uint64(64) - shift[over])
        grid[rows] = x & np.uint64((1 << w) - 1)
    count = index["count"].astype(np.int64)
    if count.sum():
        before = np.repeat(index["exceptions"].astype(np.int64) - (np.cumsum(count) - count), count)
        at = before + np.arange(len(before))
        grid[np.repeat(np.arange(len(index)), count), places[at]] = values[at]
    flat = (grid + index["base"].astype(np.uint64)[:, None]).astype(np.uint32).reshape(-1)
    ends = np.cumsum([0, *(BLOCK * n for n, _ in sizes)])
    return [flat[a : a + max(0, n)] for a, (_, n) in zip(ends.tolist(), sizes, strict=False)]


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encodes every text with the tokenizers library and writes the shard directory ``path``."""
    small_batches(docs.sparkSession)

    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())
    names = ["part", "seg", "before", "n_tokens", "doc_ids", "lengths", "payload"]

    def run(batches):
        coder, part, end = library_encoder(tokenizer), TaskContext.get().partitionId(), end_id.to_bytes(4, "little")
        ready, doc_ids, coded, n, seg, before = [], [], [], 0, 0, 0

        def flush():
            rows = [(part, *row, payload) for (*row, _), payload in zip(ready, pack([r[-1] for r in ready]), strict=True)]
            ready.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        def close():
            nonlocal doc_ids, coded, n, seg, before
            ready.append((seg, before, n, doc_ids, [len(x) // 4 for x in coded], np.frombuffer(b"".join(coded), "<u4")))
            doc_ids, coded, n, seg, before = [], [], 0, seg + 1, before + n

        for batch in batches:
            at = 0
            ids = batch.column("doc_id").to_pylist()
            for texts in pieces(batch.column("text").to_pylist()):
                for x in coder.encode(texts):
                    doc_ids.append(ids[at])
                    coded.append(x + end)
                    n, at = n + len(x) // 4 + 1, at + 1
                    if n >= SEGMENT_IDS:
                        close()
                        if len(ready) == TOGETHER:
                            yield flush()
        if coded:
            close()
        if ready:
            yield flush()

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    with shuffles_freed(docs.sparkSession):
        rows.select("doc_id", "text").mapInArrow(run, "part int, seg int, before long, n_tokens long, doc_ids array<long>, lengths array<int>, payload binary").write.mode("overwrite").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of each document, decoded from the files.

    ``start`` counts the ids of all documents before it: a segment knows those of its part, and the parts before are
    summed from one row each (as many as the writing stage had tasks).
    """
    segs = spark.read.parquet(path)
    parts = segs.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))

    def run(batches):
        for batch in batches:
            decoded = unpack([p.as_py() for p in batch.column("payload")])
            for start, doc_ids, lengths, x in zip(*(batch.column(c).to_pylist() for c in ("start", "doc_ids", "lengths")), decoded, strict=True):
                n, raw = np.array(lengths, np.int64), pa.py_buffer(x.astype("<u4").tobytes())
                at = np.cumsum(n) - n
                ids = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.append(4 * at, len(raw)).astype("<i4").tobytes()), raw])
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(start + at), pa.array(n), ids], ["doc_id", "start", "n_tokens", "ids"])

    small_batches(spark)
    return segs.join(F.broadcast(parts), "part").select((F.col("part_start") + F.col("before")).alias("start"), "doc_ids", "lengths", "payload").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
