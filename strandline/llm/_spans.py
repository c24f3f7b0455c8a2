"""Phrases of a corpus and removal spans: what both substring operators share."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import flat, join_keyed, keyed, pieces, tidy
from ._rolling import anchors, digests

#: Text bytes a numpy pass holds at once (some 100 bytes of arrays for each).
SLICE = 1 << 19
PHRASES = "doc_id long, th long, first int, n int, o int, trigger long, phrase long"


def phrases(docs: DataFrame, tokens: Callable, span: int, gram: int) -> DataFrame:
    """PHRASES of every document: runs of ``span``-token windows with a common trigger.

    tokens(data, offsets) gives the slice's Prefix, the rows' offsets in tokens, bytes, and
    where in them each token begins.  phrase is the BLAKE2b digest of a run's bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = flat(b.column("text"))
            for a, z in pieces(off, SLICE):
                prefix, at, raw, place = tokens(data[off[a] : off[z]], off[a : z + 1] - off[a])
                got = anchors(prefix, at, span, gram)
                if got is None:
                    continue
                doc = pa.array(got["doc"] + a)
                got["phrase"] = digests(raw, place[got["start"]], place[got["end"]])
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(doc), b.column("th").take(doc), *[pa.array(got[c].astype(np.int32)) for c in ("first", "n", "o")], pa.array(got["trigger"]), pa.array(got["phrase"])], names=["doc_id", "th", "first", "n", "o", "trigger", "phrase"])

    return keyed(docs).mapInArrow(tidy(run), PHRASES)


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, th, text of keyed ``docs`` with its spans: a list of (first, n), null if none.

    A document's list is bounded by the document.
    """
    lists = spans.groupBy("doc_id", "th").agg(F.collect_list(F.struct("first", "n")).alias("spans"))
    return join_keyed(keyed(docs), lists, "left")


def covered(length: int, spans: list[dict] | None, span: int) -> np.ndarray:
    """Mask of the tokens that windows first .. first+n-1 cover."""
    edge = np.zeros(length + 1, np.int32)
    for s in spans or ():
        edge[s["first"]] += 1
        edge[s["first"] + s["n"] - 1 + span] -= 1
    return np.cumsum(edge[:-1]) > 0


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
