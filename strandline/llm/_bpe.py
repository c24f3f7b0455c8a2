"""A vectorised encoder for byte-level BPE files with a word-end suffix.

Gives exactly the ids of ``tokenizers`` (``encode(text, add_special_tokens=False)``)
several times faster on running text: words are split and told apart by numpy,
each distinct word is merged once, all words of a batch side by side, and
frequent words are remembered.  Words are found by hash and then compared letter by
letter, with their like in the batch and with what is remembered.  Texts that hold an added token's string, and
words over LONG bytes, go to the library itself.
"""

from __future__ import annotations

import functools
import json
import os
import unicodedata

import numpy as np

from ._rolling import Prefix, mix

#: Bytes of text encoded at a time; words remembered; bytes of a word merged here.
SLICE, MEMO, LONG = 3 << 18, 250_000, 48
SPACE, LETTER, NUMBER, OTHER = range(4)
_NONE = np.int64(1) << np.int64(62)
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")  # fixed values: the file's pattern


@functools.lru_cache(1)
def classes() -> np.ndarray:
    out = np.full(0x110000, OTHER, np.uint8)
    for i in range(0x110000):
        c = unicodedata.category(chr(i))[0]
        if c == "L":
            out[i] = LETTER
        elif c == "N":
            out[i] = NUMBER
    for i in [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]:
        out[i] = SPACE
    return out


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself if printable Latin-1, else the next code point from 256 on."""
    plain, out, extra = {*range(33, 127), *range(161, 173), *range(174, 256)}, [], 256
    for b in range(256):
        out.append(chr(b if b in plain else extra))
        extra += b not in plain
    return out


class Pairs:
    """Merge rank and result of a symbol pair, by two hash tables without collisions."""

    def __init__(self, keys: np.ndarray, rank: np.ndarray, out: np.ndarray):
        self.keys, self.rank, self.out = np.append(keys, -1), np.append(rank, _NONE), np.append(out, -1)
        self.tables: list[tuple[np.uint64, np.ndarray]] = []
        left, salt = np.arange(len(keys)), 0
        while len(left):
            salt += 1
            by = mix(np.full(1, salt, np.uint64))[0] | np.uint64(1)
            t = np.full(1 << 18, len(keys), np.int32)
            h = self._slot(keys[left], by)
            t[h] = left
            self.tables.append((by, t))
            left = left[t[h] != left]

    @staticmethod
    def _slot(keys: np.ndarray, by: np.uint64) -> np.ndarray:
        return ((keys.view(np.uint64) * by) >> np.uint64(46)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each pair, len(keys) of the table where there is none."""
        none = len(self.keys) - 1
        out = np.full(len(keys), none, np.int32)
        todo = np.arange(len(keys))
        for by, t in self.tables:
            i = t[self._slot(keys[todo], by)]
            hit = self.keys[i] == keys[todo]
            out[todo[hit]] = i[hit]
            todo = todo[~hit & (i != none)]  # an empty slot: in no table
            if not len(todo):
                break
        return out


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = tuple(t["content"] for t in spec["added_tokens"])
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], np.int64)
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in merges], np.int64)
        self.pairs = Pairs(keys, np.arange(len(merges), dtype=np.int64), np.array([vocab[a + b] for a, b in merges], np.int64))
        self.hash, self.at, self.ids = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64), np.zeros(0, np.uint32)
        self.texts = np.zeros(0, object)
        self.classes = classes()
        self.values = mix(np.arange(0x3000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(5))

    def slices(self, texts) -> list[tuple[int, int]]:
        """Ranges of an Arrow text column of about SLICE bytes."""
        from ._common import flat, pieces

        return pieces(flat(texts)[1], SLICE)

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and each word's number of ids."""
        n = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(n)
        sym = self.inner[raw]
        sym[ends - 1] = self.last[raw[ends - 1]]
        word = np.repeat(np.arange(len(words)), n)
        done_word, done_sym = [], []
        while len(sym):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            key = (sym[:-1] << 20) | sym[1:]
            rank = np.full(len(sym), _NONE, np.int64)
            rank[:-1] = self.pairs.rank[self.pairs.find(key)]
            rank[first[1:] - 1] = _NONE  # a pair over two words
            best = np.minimum.reduceat(np.where(rank < _NONE, rank << 32 | np.arange(len(sym)), _NONE), first)
            idle = best == _NONE
            count = np.diff(np.append(first, len(sym)))
            out = np.repeat(idle, count)
            done_word.append(word[out])
            done_sym.append(sym[out])
            at = best[~idle] & 0xFFFFFFFF
            sym[at] = self.pairs.out[best[~idle] >> 32]
            keep = ~out
            keep[at + 1] = False
            sym, word = sym[keep], word[keep]
        word, sym = np.concatenate(done_word), np.concatenate(done_sym)
        order = np.argsort(word, kind="stable")
        return sym[order].astype(np.uint32), np.bincount(word, minlength=len(words))

    def _boundaries(self, cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind = self.classes[cp]
        new = np.ones(len(cp) + 1, bool)
        np.not_equal(kind[1:], kind[:-1], out=new[1:-1])
        new[:-1] |= kind == NUMBER
        quotes = np.flatnonzero((cp == 39) & new[:-1])
        for p in quotes.tolist():
            after = cp[p + 1 : p + 3]
            for c in CONTRACTIONS:
                if len(after) >= len(c) and all(int(after[i]) == ord(x) for i, x in enumerate(c)):
                    new[p + 1 : p + 1 + len(c)] = False
                    new[p + 1 + len(c)] = True
                    break
        at = np.flatnonzero(new)
        start, end = at[:-1], at[1:]
        real = kind[start] != SPACE
        return start[real], end[real]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the texts' offsets in them."""
        texts = [t or "" for t in texts]
        odd = {i: self.library.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts) if any(a in t for a in self.added)}
        norm = []
        for i, t in enumerate(texts):
            if i in odd:
                t = ""
            elif not t.isascii():
                if not unicodedata.is_normalized("NFC", t):
                    t = unicodedata.normalize("NFC", t)
                t = t.replace("Σ", "σ")  # lower() looks at the context of this letter, the library does not
            norm.append(t.lower())
        joined = "\n".join(norm)
        cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.cumsum([0, *[len(t) + 1 for t in norm]])
        start, end = self._boundaries(cp) if len(cp) else (np.zeros(0, np.int64),) * 2
        low = cp < len(self.values)
        v = self.values[np.where(low, cp, 0)]
        if not low.all():
            v = np.where(low, v, mix(cp.astype(np.uint64) + np.uint64(1 << 40)))
        h = Prefix(v).of(start, end) + (end - start).astype(np.uint64)
        uniq, where, inverse = np.unique(h, return_index=True, return_inverse=True)
        if not _alike(cp, start, end, where[inverse]):  # two words of one hash: the library knows better
            parts = [np.array(self.library.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts]
            return np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        ids, at = self._words(joined, uniq, start[where], end[where])
        at = at[inverse]
        lengths = at[:, 1]
        total = np.concatenate([[0], np.cumsum(lengths)])
        flat = ids[np.repeat(at[:, 0] - total[:-1], lengths) + np.arange(total[-1])]
        off = total[np.searchsorted(start, first)]
        if odd:
            parts = [np.array(odd[i], np.uint32) if i in odd else flat[off[i] : off[i + 1]] for i in range(len(texts))]
            return np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        return flat, off

    def _words(self, joined: str, h: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words and each word's place and length in them."""
        at = np.zeros((len(h), 2), np.int64)
        i = np.searchsorted(self.hash, h)
        known = np.zeros(len(h), bool)
        inside = i < len(self.hash)
        known[inside] = self.hash[i[inside]] == h[inside]
        every = np.empty(len(h), object)
        every[:] = [joined[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        same = every[known] == self.texts[i[known]]
        fresh = ~known
        known[known] = same.astype(bool)
        at[known] = self.at[i[known]]
        new = np.flatnonzero(~known)
        if not len(new):
            return self.ids, at
        fresh = fresh[new]  # a word whose hash another one holds is not remembered
        texts = every[new].tolist()
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        long = np.array([len(w) > LONG for w in raw])
        ids, n = self.merged([w for w in raw if len(w) <= LONG]) if not long.all() else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        counts = np.zeros(len(new), np.int64)
        counts[~long] = n
        place = np.zeros(len(new), np.int64)
        place[~long] = np.cumsum(n) - n
        if long.any():
            more = [self.library.encode(texts[k], add_special_tokens=False).ids for k in np.flatnonzero(long)]
            counts[long] = [len(m) for m in more]
            place[long] = len(ids) + np.cumsum([0, *map(len, more)])[:-1]
            ids = np.concatenate([ids, *[np.array(m, np.uint32) for m in more]])
        at[new, 0], at[new, 1] = place + len(self.ids), counts
        ids = np.concatenate([self.ids, ids])
        if len(self.hash) < MEMO:
            some = new[fresh]
            self.hash, self.at, self.ids = np.concatenate([self.hash, h[some]]), np.concatenate([self.at, at[some]]), ids
            self.texts = np.concatenate([self.texts, every[some]])
            order = np.argsort(self.hash)
            self.hash, self.at, self.texts = self.hash[order], self.at[order], self.texts[order]
        return ids, at


def _alike(cp: np.ndarray, start: np.ndarray, end: np.ndarray, like: np.ndarray) -> bool:
    """Whether each stretch of ``cp`` equals the one whose number ``like`` gives."""
    n = (end - start).astype(np.int32)
    if (n != n[like]).any():
        return False
    other = np.flatnonzero(like != np.arange(len(like)))
    a, b, n = start[other].astype(np.int32), start[like[other]].astype(np.int32), n[other]
    k = 0
    while len(a):  # letter by letter, all words side by side
        if (cp[a + k] != cp[b + k]).any():
            return False
        k += 1
        more = n > k
        a, b, n = a[more], b[more], n[more]
    return True


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
