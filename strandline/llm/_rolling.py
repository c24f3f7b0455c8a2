"""Polynomial rolling hashes over token sequences, and window anchors.

``Prefix`` hashes any stretch of a token array in O(1) (Rabin-Karp, modulo
2**64, then mixed).  It is quick, but sequences with structure (the
Thue-Morse word and its complement) collide in it for any base, so it only
proposes: triggers, grams, candidates.  ``Exact`` is the same modulo the prime
2**61 - 1: two given sequences of n tokens agree for at most n of the 2**61
bases.  Where equality of long stretches decides alone, ``digests`` of the bytes do
(BLAKE2b).  ``anchors`` picks for each window of ``span`` tokens its
trigger: the leftmost smallest hash among the window's grams.  Equal windows
have equal triggers at equal offsets, and consecutive windows mostly share
one, so the windows of a document fall into few runs ("phrases").
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np

_B = 0x9E3779B97F4A7C15 | 1
_BINV = pow(_B, -1, 1 << 64)
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _U(31))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


def seeds(n: int, seed: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=_U) * _U(_B)) + _U(seed))


@functools.lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (_B, _BINV):
        p = np.full(n, b, _U)
        p[:1] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(20, int(n).bit_length())
    p, q = _powers(size)
    return p[:n], q[:n]


class Prefix:
    def __init__(self, values: np.ndarray):
        n = len(values)
        p, self.inv = powers(n + 1)
        self.sum = np.zeros(n + 1, _U)
        np.cumsum(values * p[:n], out=self.sum[1:])

    def of(self, start, end) -> np.ndarray:
        """Hash of values[start:end], elementwise."""
        return mix((self.sum[end] - self.sum[start]) * self.inv[start])

    def grams(self, w: int) -> np.ndarray:
        n = len(self.sum) - 1 - w + 1
        return mix((self.sum[w:] - self.sum[:n]) * self.inv[:n]) if n > 0 else np.zeros(0, _U)


_P = _U((1 << 61) - 1)
_LOW31, _LOW30 = _U((1 << 31) - 1), _U((1 << 30) - 1)
_BASE = 0x1234567F89ABCDE % ((1 << 61) - 1)


def _fold(x: np.ndarray) -> np.ndarray:
    """x modulo the prime."""
    x = (x & _P) + (x >> _U(61))
    return np.where(x >= _P, x - _P, x)


def mulmod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2**61 - 1, of residues: halves of 31 bits, since 2**61 is 1."""
    ah, al, bh, bl = a >> _U(31), a & _LOW31, b >> _U(31), b & _LOW31
    mid = ah * bl + al * bh
    return _fold((ah * bh << _U(1)) + (mid >> _U(30)) + ((mid & _LOW30) << _U(31)) + _fold(al * bl))


@functools.lru_cache(1)
def _residues(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, int(_P))):
        p = np.ones(1, _U)
        while len(p) < n:
            p = np.concatenate([p, mulmod(p, np.full(1, pow(base, len(p), int(_P)), _U))])
        out.append(p)
    return out[0], out[1]


class Exact:
    """Hashes of stretches modulo 2**61 - 1."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        p, self.inv = _residues(1 << max(20, int(n).bit_length()))
        x = mulmod(_fold(values), p[:n])
        self.sum = np.zeros(n + 1, _U)
        high = np.cumsum(x >> _U(31))
        self.sum[1:] = _fold((high >> _U(30)) + ((high & _LOW30) << _U(31)) + np.cumsum(x & _LOW31))

    def of(self, start, end) -> np.ndarray:
        """Hash of values[start:end], elementwise."""
        return mix(mulmod(_fold(self.sum[end] + _P - self.sum[start]), self.inv[start]))


def digests(data: np.ndarray, start, end) -> np.ndarray:
    """64-bit BLAKE2b digests of data[start:end] (bytes), elementwise."""
    view, new = memoryview(np.ascontiguousarray(data)), hashlib.blake2b
    return np.frombuffer(b"".join([new(view[a:b], digest_size=8).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)]), np.int64)


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    k = 1
    while 2 * k <= w:
        a = np.minimum(a[:-k], a[k:])
        k *= 2
    return np.minimum(a[: -(w - k)], a[w - k :]) if k < w else a


def anchors(prefix: Prefix, off: np.ndarray, span: int, gram: int) -> dict[str, np.ndarray] | None:
    """Runs of windows that share a trigger, for documents at token offsets ``off``.

    doc: row; first: the run's first window (from its document's start);
    n: windows; o: tokens from that window's start to the trigger; trigger:
    hash of the gram; start, end: the run's tokens.  None: no window.
    """
    g = prefix.grams(gram)
    if len(g) < span - gram + 1:
        return None
    bits = max(1, int(len(g) - 1).bit_length())
    low = _U((1 << bits) - 1)
    m = sliding_min((g & ~low) | np.arange(len(g), dtype=_U), span - gram + 1)
    pos = (m & low).astype(np.int64)
    new = np.ones(len(pos) + 1, bool)
    np.not_equal(pos[1:], pos[:-1], out=new[1:-1])
    length = np.diff(off)
    has = length >= span
    if not has.any():
        return None
    new[off[:-1][has]] = True
    new[off[1:][has] - span + 1] = True
    at = np.flatnonzero(new)
    first, last = at[:-1], at[1:]
    doc = np.searchsorted(off, first, "right") - 1
    keep = first + span <= off[doc + 1]
    first, last, doc = first[keep], last[keep], doc[keep]
    o = pos[first] - first
    n = last - first
    return {"doc": doc, "first": first - off[doc], "n": n, "o": o, "trigger": g[pos[first]].view(np.int64), "start": first, "end": last - 1 + span}


def spaced(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words one after the other, a blank behind each, and where each begins (one more: the end)."""
    at = np.concatenate([[0], np.cumsum(end - start + 1)])
    out = np.full(int(at[-1]), 32, np.uint8)
    n = end - start
    place = np.arange(int(n.sum()))
    before = np.cumsum(n) - n
    out[place + np.repeat(np.arange(len(n)), n)] = data[place + np.repeat(start - before, n)]
    return out, at


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = seeds(256, 17)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes, so all of UTF-8's multi-byte sequences, stay."""
    return _LOWER[data]


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each row: byte start, byte end, 64-bit hash, and the rows' offsets in words."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    if len(data):
        edge[0] = inside[0]
        edge[-1] = inside[-1]
        np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
        cut = off[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        cut = cut[inside[cut] & inside[cut - 1]]  # a word ends with its row
    else:
        cut = np.zeros(0, np.int64)
    at = np.flatnonzero(edge)
    if len(cut):
        at = np.sort(np.concatenate([at, cut, cut]), kind="stable")
        # rows may be empty, so the same cut may come twice: keep one pair of each
        pairs = at.reshape(-1, 2)
        at = pairs[pairs[:, 0] < pairs[:, 1]].reshape(-1)
    start, end = at[0::2], at[1::2]
    h = Exact(_BYTE[data]).of(start, end) if len(start) else np.zeros(0, _U)
    return start, end, h, np.searchsorted(start, off, "left")
