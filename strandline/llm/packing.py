"""9. Cost-balanced packing of token sequences.

A document's tokens are its ids by a public tokenizer and a closing id.  Full
sequences are cut off first; what is left of each document is packed within
groups of documents: sequences are as many as the group's tokens need, and
documents, longest first, go to the sequence of the lowest estimated cost
(linear + quadratic attention cost of the pieces in it) that has room.  Those
that fit nowhere are cut over the roomiest sequences, so a group leaves at
most one sequence short.

Edge cases.  Null or empty text: only the closing id.  Null id: a document.
Repeated rows: documents each.  Empty table: empty result.  Very long texts
are tokenized whole; pieces are cut at multiples of the capacity.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import tidy

from ._bpe import encoder

CAPACITY, CLOSING = 2048, 1
TOKENIZER = "word_bpe_49k.json"
#: Documents a group, on average: bounds a packing task (about 1.5 KB of left-over ids each).
GROUP = 5_000
#: Cost of a piece of n tokens: LINEAR * n + n * n.
LINEAR = 4096
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cost(n: int) -> int:
    return LINEAR * n + n * n


class Cheapest:
    """Bins by room; the cheapest with at least so much room, in steps of the logarithm of the capacity."""

    def __init__(self, capacity: int, bins: int):
        self.n = 1 << capacity.bit_length()
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(self.n)]
        self.best: list[tuple[int, int] | None] = [None] * (2 * self.n)
        self.heaps[capacity] = [(0, b) for b in range(bins)]
        self._up(capacity)

    def _up(self, room: int) -> None:
        k = room + self.n
        self.best[k] = self.heaps[room][0] if self.heaps[room] else None
        while k > 1:
            k >>= 1
            a, b = self.best[2 * k], self.best[2 * k + 1]
            self.best[k] = a if b is None or (a is not None and a < b) else b

    def put(self, room: int, cost: int, b: int) -> None:
        heapq.heappush(self.heaps[room], (cost, b))
        self._up(room)

    def take(self, least: int, room: list[int]) -> tuple[int, int] | None:
        """Cost and number of the cheapest bin with ``least`` room, taken out."""
        found, a, z = None, least + self.n, 2 * self.n
        while a < z:
            for k in ([a] if a & 1 else []) + ([z - 1] if z & 1 else []):
                if self.best[k] is not None and (found is None or self.best[k] < found):
                    found = self.best[k]
            a, z = (a + 1) >> 1, z >> 1
        if found is not None:
            heapq.heappop(self.heaps[room[found[1]]])
            self._up(room[found[1]])
        return found


def assign(lengths: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (item, start in item, length); every item is shorter than ``capacity``."""
    total = sum(lengths)
    bins: list[list[tuple[int, int, int]]] = [[] for _ in range(-(-total // capacity))]
    room = [capacity] * len(bins)
    by_room = Cheapest(capacity, len(bins))
    late: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        found = by_room.take(n, room)
        if found is None:
            late.append(i)
            continue
        c, b = found
        bins[b].append((i, 0, n))
        room[b] -= n
        if room[b]:
            by_room.put(room[b], c + cost(n), b)
    roomy = [(-room[b], b) for b in range(len(bins)) if room[b]]
    heapq.heapify(roomy)
    for i in late:
        at = 0
        while at < lengths[i]:
            r, b = heapq.heappop(roomy)
            n = min(-r, lengths[i] - at)
            bins[b].append((i, at, n))
            at += n
            if n < -r:
                heapq.heappush(roomy, (r + n, b))
    return [b for b in bins if b]


def tokenized(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, closing: int = CLOSING) -> DataFrame:
    """doc_id, th, start, ids (little-endian uint32) and doc_tokens of every full sequence and of what is left."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            ids_col, texts = b.column("doc_id"), b.column("text")
            for a, z in enc.slices(texts):
                flat, off = enc.encode([x.as_py() for x in texts[a:z]])
                doc, start, blob, total = [], [], [], []
                for i in range(z - a):
                    own = np.append(flat[off[i] : off[i + 1]], closing).astype("<u4")
                    for s in range(0, len(own), capacity):
                        doc.append(a + i)
                        start.append(s)
                        blob.append(own[s : s + capacity].tobytes())
                        total.append(len(own))
                yield pa.RecordBatch.from_arrays([ids_col.take(pa.array(doc, pa.int64())), pa.array(start, pa.int64()), pa.array(blob, pa.binary()), pa.array(total, pa.int64())], names=["doc_id", "start", "ids", "doc_tokens"])

    return rows.mapInArrow(tidy(run), "doc_id long, start long, ids binary, doc_tokens long")


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, closing: int = CLOSING, group: int = GROUP) -> DataFrame:
    """One row a piece (PIECES).  sequence_id is the group's number times 2**40 and a number in the group."""
    n = docs.count()
    groups = max(1, -(-n // group))
    parts = tokenized(docs, tokenizer, capacity, closing)
    # full pieces need no ids beyond their checksum, so those do not travel
    crc = F.crc32("ids")
    parts = parts.withColumn("crc", crc).withColumn("n", (F.octet_length("ids") / 4).cast("long")).withColumn("ids", F.when(F.col("n") < capacity, F.col("ids")))
    parts = parts.withColumn("g", F.pmod(F.xxhash64("doc_id", "crc", "start"), F.lit(groups)).cast("long"))
    dealt = parts.repartitionById(groups, F.col("g").cast("int")).sortWithinPartitions("g", "doc_id", "start", "crc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, seq, tails = None, 0, []

        def close() -> Iterator[pa.RecordBatch]:
            out = []
            for k, pieces in enumerate(assign([len(t[2]) // 4 for t in tails], capacity)):
                at = 0
                for i, s, n in pieces:
                    doc, start, ids, total = tails[i]
                    out.append((doc, start + s, n, zlib.crc32(ids[4 * s : 4 * (s + n)]), total, (g << 40) + seq + k, at))
                    at += n
            tails.clear()
            if out:
                yield table(zip(*out, strict=True))

        def table(columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for b in batches:
            full = []
            for gg, doc, start, ids, total, crc, n in zip(*[b.column(c).to_pylist() for c in ("g", "doc_id", "start", "ids", "doc_tokens", "crc", "n")], strict=True):
                if gg != g:
                    yield from close()
                    g, seq = gg, 0
                if ids is None:
                    full.append((doc, start, n, crc, total, (g << 40) + seq, 0))
                    seq += 1
                else:
                    tails.append((doc, start, ids, total))
            if full:
                yield table(zip(*full, strict=True))
        yield from close()

    return dealt.select("g", "doc_id", "start", "ids", "doc_tokens", "crc", "n").mapInArrow(tidy(run), PIECES)


def op9(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return packed(docs, public_tokenizers.path(TOKENIZER))
