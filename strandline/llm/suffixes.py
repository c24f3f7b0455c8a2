"""1. Suffix-array dedup by prefix-free parsing, on bytes.

Dealing out.  The trigger of a 200-byte string is the leftmost smallest rolling
hash of its 32-byte grams; consecutive strings that share one make a stretch,
so stretches overlap by 199 bytes and each 200-byte string of the corpus lies
in exactly one.  Equal strings have equal triggers, so stretches are grouped
by trigger.  Stretches that repeat as a whole (equal trigger and 64-bit BLAKE2b digest
of their bytes) repeat in every string; of them one takes part in what follows, beside all
others whose trigger repeats.

Prefix-free parsing, inside a group (of some thousand groups, a task takes a
few at a time): a second, finer trigger, WIDTH bytes whose hash is divisible by MOD, cuts
each stretch into phrases that overlap by WIDTH bytes, so none of their
suffixes longer than that is a proper prefix of another.  The dictionary holds each distinct phrase once; its suffix
array and that of the parse (the sequence of phrases) are made by prefix
doubling; a suffix of the text is a suffix of a phrase followed by a suffix of the parse, and the
ranks of both give the corpus order.  Strings that agree in 200 bytes
with a neighbour in that order, compared byte by byte, repeat.

A trigger with more than HOT distinct stretches is split by what its strings
have in common around it (SLICES of trigger offsets), so no group grows with
the corpus unless its members agree on nearly all of a string.

Edge cases.  Null text: empty.  Texts under 200 bytes: nothing is removed.
Repeats inside one document count, overlapping ones too.  Repeated rows repeat
each other.  Null ids are documents.  Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import flat, join_keyed, keyed, settle, tidy
from ._rolling import _BYTE, Prefix, mix, seeds
from ._spans import covered, phrases, sha256, with_spans

SPAN, GRAM = 200, 32
HOT, SLICES = 4_000, 24
#: Stretches ordered in one pass, if no group is larger.
CHUNK = 2_000
#: The finer triggers.
WIDTH, MOD = 6, 12
_VALUES = seeds(256, 99)


def _tokens(data: np.ndarray, off: np.ndarray) -> tuple[Prefix, np.ndarray, np.ndarray, np.ndarray]:
    return Prefix(_BYTE[data]), off, data, np.arange(len(data) + 1)


def _dense(key: np.ndarray) -> np.ndarray:
    """Ranks of keys, equal ones alike, from 0."""
    order = np.argsort(key)
    key = key[order]
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]).astype(np.int64)])) if len(key) else 0
    return out


def suffix_ranks(symbols: np.ndarray, left: np.ndarray, h: int) -> np.ndarray:
    """Ranks of the suffixes of sequences that lie one after the other, equal suffixes alike, by prefix doubling.

    symbols: keys that order the suffixes by their first ``h`` symbols; left: symbols of the suffix.
    """
    rank, longest = _dense(symbols), int(left.max(initial=0))
    while h < longest:
        top = int(rank.max()) + 1
        if top == len(rank):
            break
        at = np.flatnonzero(left > h)
        behind = np.zeros(len(rank), np.int64)
        behind[at] = rank[at + h] + 1
        rank = _dense(rank * (top + 1) + behind)
        h *= 2
    return rank


def phrases_of(raw: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix-free parse of texts: where phrases start and end, and their texts.

    A phrase runs from a trigger (or its text's start) to the end of the next trigger (or of the text).
    """
    end = begin + length
    g = Prefix(_VALUES[raw]).grams(WIDTH)
    at = np.flatnonzero(g % np.uint64(MOD) == 0)
    text = np.searchsorted(begin, at, "right") - 1
    at = at[(at > begin[text]) & (at + WIDTH < end[text])]
    start = np.union1d(at, begin[length > 0])
    text = np.searchsorted(begin, start, "right") - 1
    last = np.append(text[1:] != text[:-1], True) if len(text) else np.zeros(0, bool)
    stop = np.where(last, end[text], np.append(start[1:], 0) + WIDTH) if len(start) else start
    return start, stop, text


def corpus_order(raw: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two keys for each byte of texts that lie one after the other; by both the suffixes of all texts are in order, a text's end before all bytes.

    The first is the rank of the suffix of its phrase in the dictionary's suffix array, the
    second the rank of the parse's suffix behind that phrase.
    """
    start, stop, text = phrases_of(raw, begin, length)
    n = stop - start
    off = np.concatenate([[0], np.cumsum(n)])
    flat_at = np.arange(int(off[-1])) + np.repeat(start - off[:-1], n)
    blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw[flat_at]))])
    coded = blobs.dictionary_encode()
    which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # the dictionary, its phrases one after the other, and the suffix array of all their suffixes
    words, at = flat(coded.dictionary)
    size = np.diff(at)
    left = np.repeat(at[1:], size) - np.arange(len(words))
    # a phrase that ends its text ends before all bytes; one that ends in a trigger is followed by the parse
    symbol = words.astype(np.int64) + 1
    key = np.zeros(len(words), np.int64)
    for k in range(7):  # seven symbols of nine bits
        here = np.zeros(len(words), np.int64)
        here[: len(words) - k] = symbol[k:]
        key = key << 9 | np.where(left > k, here, 0)
    ranks = suffix_ranks(key, left, 7)
    # the parse over the phrases' ranks, and its suffix array
    last = np.append(text[1:] != text[:-1], True) if len(text) else np.zeros(0, bool)
    parse = ranks[at[which]] + 1
    ends = np.flatnonzero(last)
    remain = np.repeat(ends, np.diff(np.concatenate([[-1], ends]))) - np.arange(len(parse)) + 1
    parse_ranks = suffix_ranks(parse, remain, 1)
    behind = np.where(last, 0, np.append(parse_ranks[1:], 0) + 1)
    # each byte in the last phrase that starts at it or before
    phrase = np.searchsorted(start, np.arange(len(raw)), "right") - 1
    return ranks[at[which[phrase]] + np.arange(len(raw)) - start[phrase]], behind[phrase]


def agree(raw: np.ndarray, a: np.ndarray, b: np.ndarray, span: int) -> np.ndarray:
    """Whether raw[a:a+span] equals raw[b:b+span], elementwise, eight bytes at a time."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = sum(padded[k : k + len(raw)].astype(np.uint64) << np.uint64(8 * k) for k in range(8))
    alive = np.arange(len(a))
    for k in [*range(0, span - 8, 8), span - 8]:
        alive = alive[eight[a[alive] + k] == eight[b[alive] + k]]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def repeated_windows(blobs: pa.Array, n: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(stretch, window) pairs of the windows that equal another one; n: windows of each stretch, span - 1 bytes less than it is long."""
    raw, off = flat(blobs)
    first, second = corpus_order(raw, off[:-1], np.diff(off))
    who = np.repeat(np.arange(len(n)), n)
    where = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
    at = off[:-1][who] + where
    order = np.lexsort((second[at], first[at]))
    at = at[order]
    same = agree(raw, at[1:], at[:-1], span)
    hit = np.zeros(len(at), bool)
    hit[1:] |= same
    hit[:-1] |= same
    hit = order[hit]
    return who[hit], where[hit]


def _fetch(span: int, hot: int, slices: int):
    """Phrases' bytes out of the documents' texts; those of hot triggers in slices with keys of their own."""
    width = -(-span // slices)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = flat(b.column("text"))
            rows: list[tuple] = []
            size = 0
            for i, runs in enumerate(b.column("runs").to_pylist()):
                text = data[off[i] : off[i + 1]].tobytes()
                for r in runs:
                    first, n, o = r["first"], r["n"], r["o"]
                    if r["kinds"] <= hot:
                        rows.append((i, r["trigger"], first, n, o, r["c"], text[first : first + n - 1 + span]))
                        size += n + span
                        continue
                    t = first + o
                    for s in range((o - n + 1) // width, o // width + 1):
                        high, low = min(o, s * width + width - 1), max(o - n + 1, s * width)
                        core = np.frombuffer(text, np.uint8)[t - s * width : t + span - (s * width + width - 1)]
                        key = int(mix(Prefix(_VALUES[core]).of(np.array([0]), np.array([len(core)])) + np.uint64(s))[0].view(np.int64)) ^ r["trigger"]
                        rows.append((i, key, t - high, high - low + 1, high, r["c"], text[t - high : t - low + span]))
                        size += high - low + span
                if size > 8 << 20:
                    yield _rows(b, rows)
                    rows, size = [], 0
            if rows:
                yield _rows(b, rows)

    return run


def _rows(b: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
    i, key, first, n, o, c, blob = zip(*rows, strict=True)
    take = pa.array(i, pa.int64())
    return pa.RecordBatch.from_arrays([b.column("doc_id").take(take), b.column("th").take(take), pa.array(key, pa.int64()), pa.array(first, pa.int32()), pa.array(n, pa.int32()), pa.array(o, pa.int32()), pa.array(c, pa.int64()), pa.array(blob, pa.binary())], names=["doc_id", "th", "key", "first", "n", "o", "c", "bytes"])


def _compare(span: int):
    """Streams groups of equal key, sorted; yields the repeated windows of stretches that occur once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def close(upto: int | None) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks()
            part = t if upto is None else t.slice(0, upto)
            held[:] = [] if upto is None else t.slice(upto).to_batches()
            key = part.column("key").to_numpy()
            edge = np.concatenate([[True], key[1:] != key[:-1], [True]])
            alone = edge[:-1] & edge[1:]
            keep = np.flatnonzero(~alone)
            if not len(keep):
                return
            part = part.take(pa.array(keep))
            n, c = (part.column(x).to_numpy().astype(np.int64) for x in ("n", "c"))
            who, where = repeated_windows(part.column("bytes").combine_chunks(), n, span)
            once = c[who] == 1
            who, where = who[once], where[once]
            order = np.lexsort((where, who))
            who, where = who[order], where[order]
            if not len(who):
                return
            new = np.concatenate([[True], (who[1:] != who[:-1]) | (where[1:] != where[:-1] + 1)])
            at = np.flatnonzero(new)
            count = np.diff(np.append(at, len(who)))
            p = who[at]
            take = pa.array(p)
            first = part.column("first").to_numpy()[p] + where[at]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").combine_chunks().take(take), part.column("th").combine_chunks().take(take), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))], names=["doc_id", "th", "first", "n"])

        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= CHUNK:
                key = pa.Table.from_batches(held).column("key").to_numpy()
                cut = np.flatnonzero(key[1:] != key[:-1])
                if len(cut):
                    yield from close(int(cut[-1]) + 1)
                    rows = sum(x.num_rows for x in held)
        if held and rows:
            yield from close(None)

    return run


def repeated(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot: int = HOT, slices: int = SLICES) -> DataFrame:
    """doc_id, th, first, n: runs of ``span``-byte strings that also start elsewhere."""
    found = phrases(docs, _tokens, span, gram)
    twice = settle(found.groupBy("trigger").agg(F.count("*").alias("c"), F.min("phrase").alias("p"), F.max("phrase").alias("q")).where("c > 1").select("trigger", (F.col("p") != F.col("q")).alias("mixed")))
    hits = settle(found.join(twice, "trigger").select("doc_id", "th", "first", "n", "o", "trigger", "phrase", "mixed"))
    alike = hits.where("not mixed").select("doc_id", "th", "first", "n")
    mixed = hits.where("mixed").drop("mixed")
    per = settle(mixed.groupBy("trigger", "phrase").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "th", "first", "n", "o")).alias("r")))
    whole = alike.unionByName(mixed.join(per.where("c > 1").select("trigger", "phrase"), ["trigger", "phrase"]).select("doc_id", "th", "first", "n"))
    one = per.join(per.groupBy("trigger").agg(F.count("*").alias("kinds")), "trigger").select("r.*", "trigger", "c", "kinds")
    lists = one.groupBy("doc_id", "th").agg(F.collect_list(F.struct("first", "n", "o", "trigger", "c", "kinds")).alias("runs"))
    texts = join_keyed(keyed(docs), lists)
    rows = texts.select("doc_id", "th", "text", "runs").mapInArrow(tidy(_fetch(span, hot, slices)), "doc_id long, th long, key long, first int, n int, o int, c long, bytes binary")
    more = rows.repartition("key").sortWithinPartitions("key").mapInArrow(tidy(_compare(span)), "doc_id long, th long, first int, n int")
    return whole.unionByName(more)


def dedup(docs: DataFrame, span: int = SPAN, gram: int = GRAM, **how) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes), spans (start, end) of every document."""
    return _applied(docs, span, gram, True, **how)


def _applied(docs: DataFrame, span: int, gram: int, texts: bool, **how) -> DataFrame:
    rows = with_spans(docs, settle(repeated(docs, span, gram, **how))).select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = flat(b.column("text"))
            out = []
            for i, s in enumerate(b.column("spans").to_pylist()):
                own = data[off[i] : off[i + 1]]
                gone = covered(len(own), s, span) if s else np.zeros(len(own), bool)
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))) if s else np.zeros(0, np.int64)
                kept = (own[~gone] if s else own).tobytes()
                cut = [{"start": int(x), "end": int(y)} for x, y in zip(edge[0::2], edge[1::2], strict=True)]
                out.append((len(own), int(gone.sum()), len(cut), kept if texts else None, sha256(kept), cut))
            c = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c[k], pa.int64()) for k in range(3)], pa.array(c[3], pa.binary()), pa.array(c[4], pa.string()), pa.array(c[5], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256", "spans"])

    return rows.mapInArrow(tidy(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string, spans array<struct<start: long, end: long>>")


def op1(docs: DataFrame) -> DataFrame:
    return _applied(docs, SPAN, GRAM, False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
