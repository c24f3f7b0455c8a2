"""4. Substring dedup on token windows.

Rabin-Karp hashes roll over the words, and Spark counts windows by them.  So that
not every 50-word window has to be shuffled, windows are grouped first into
phrases (runs of windows that share a trigger, see ``_rolling``): a window can
only repeat where its trigger, the smallest hash in it, does.  A phrase that a
smaller document holds too repeats as a whole; where distinct phrases share a
trigger, their windows are counted one by one.  Rolling hashes only propose:
phrases and windows are one if their triggers and the 64-bit BLAKE2b digests of their very
words agree.  Repeated windows merge into maximal removal intervals.

Edge cases.  Null text: no words.  Fewer words than a window: nothing is
removed.  A null id is neither smaller nor larger than another.  Repeats inside
one document, and in rows of the same id, remove nothing.  Repeated rows:
equal results.  Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import flat, join_keyed, keyed, pieces, settle, tidy
from ._rolling import Prefix, digests, mix, spaced, words
from ._spans import SLICE, covered, phrases, sha256, with_spans

SPAN, GRAM = 50, 16


def _tokens(data: np.ndarray, off: np.ndarray) -> tuple[Prefix, np.ndarray, np.ndarray, np.ndarray]:
    start, end, h, at = words(data, off)
    return Prefix(h), at, *spaced(data, start, end)


def repeated(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, th, first, n: runs of windows that also start in a document with a smaller id."""
    found = phrases(docs, _tokens, span, gram)
    twice = found.groupBy("trigger").agg(F.min("doc_id").alias("td"), F.max("doc_id").alias("te"), F.min("phrase").alias("p"), F.max("phrase").alias("q")).where("td < te")
    twice = settle(twice.select("trigger", "td", (F.col("p") != F.col("q")).alias("mixed")))
    hits = settle(found.join(twice, "trigger").where("mixed or td < doc_id").select("doc_id", "th", "first", "n", "trigger", "phrase", "mixed"))
    mixed = hits.where("mixed").drop("mixed")
    mixed = settle(mixed.join(mixed.groupBy("trigger", "phrase").agg(F.min("doc_id").alias("d")), ["trigger", "phrase"]).select("doc_id", "th", "first", "n", "trigger", "d"))
    whole = hits.where("not mixed").select("doc_id", "th", "first", "n").unionByName(mixed.where("d < doc_id").select("doc_id", "th", "first", "n"))
    # of a phrase, its first document alone has windows to compare: in the others they are gone already
    lists = mixed.where("doc_id = d").groupBy("doc_id", "th").agg(F.collect_list(F.struct("first", "n", "trigger")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = flat(b.column("text"))
            for a, z in pieces(off, SLICE):
                _, at, raw, place = _tokens(data[off[a] : off[z]], off[a : z + 1] - off[a])
                runs = b.column("runs").slice(a, z - a).to_pylist()
                doc = np.repeat(np.arange(z - a), [len(r) for r in runs])
                first = np.array([x["first"] for r in runs for x in r], np.int64)
                n = np.array([x["n"] for r in runs for x in r], np.int64)
                trigger = np.array([x["trigger"] for r in runs for x in r], np.int64)
                local = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                doc = np.repeat(doc, n)
                start = at[doc] + local
                h = mix(digests(raw, place[start], place[start + span]).view(np.uint64) ^ np.repeat(trigger, n).view(np.uint64))
                take = pa.array(doc + a)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(take), b.column("th").take(take), pa.array(local.astype(np.int32)), pa.array(h.view(np.int64))], names=["doc_id", "th", "first", "window"])

    windows = settle(join_keyed(keyed(docs), lists).select("doc_id", "th", "text", "runs").mapInArrow(tidy(run), "doc_id long, th long, first int, window long"))
    smallest = windows.groupBy("window").agg(F.min("doc_id").alias("d"), F.max("doc_id").alias("e")).where("d < e").drop("e")
    more = windows.join(smallest, "window").where("d < doc_id").select("doc_id", "th", "first", F.lit(1).alias("n"))
    return whole.unionByName(more)


def dedup(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept (words joined by a blank), intervals (maximal runs of removed words: first, last)."""
    return _applied(docs, span, gram, True)


def _applied(docs: DataFrame, span: int, gram: int, texts: bool) -> DataFrame:
    rows = with_spans(docs, settle(repeated(docs, span, gram))).select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = flat(b.column("text"))
            spans = b.column("spans").to_pylist()
            out = []
            for i, s in enumerate(spans):
                raw = data[off[i] : off[i + 1]].tobytes()
                own = raw.split()  # of bytes: at the six ASCII white-space characters only
                gone = covered(len(own), s, span) if s else np.zeros(len(own), bool)
                kept = b" ".join(w for w, g in zip(own, gone.tolist(), strict=True) if not g) if s else b" ".join(own)
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))) if s else np.zeros(0, np.int64)
                cut = [{"first": int(x), "last": int(y) - 1} for x, y in zip(edge[0::2], edge[1::2], strict=True)]
                out.append((len(own), int(gone.sum()), kept.decode("utf-8", "replace") if texts else None, sha256(kept), cut))
            c = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.string()), pa.array(c[3], pa.string()), pa.array(c[4], pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))], names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256", "intervals"])

    return rows.mapInArrow(tidy(run), "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string, intervals array<struct<first: long, last: long>>")


def op4(docs: DataFrame) -> DataFrame:
    return _applied(docs, SPAN, GRAM, False).select("doc_id", "n_words", "n_removed", "kept_sha256")
