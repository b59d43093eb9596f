"""Whole texts to token ids by a public vocabulary file, each distinct word merged once.

The vocabulary lower-cases, drops white space, splits into runs of letters, single digits and runs of other
characters, and merges within those alone; so a word's ids are the same wherever it stands. For texts of Latin-1
characters the split is done here on the bytes of many texts at once; each distinct word of a slice is looked up in a
bounded cache or merged by the library, and the ids are gathered. Texts with other characters, or that spell a special
token, and vocabularies of another kind go through the library's whole encoder.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa

from .common import _BYTE, U, _powers, mix, slices, text_buffers

WORDS, LONG, SLICE = 150_000, 64, 1 << 20
#: Fixed value: the pattern of the vocabularies whose split is done here.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)


def _class(c: str) -> int:
    return _SPACE if c in " \t\n\x0b\x0c\r\x85\xa0" else _LETTER if c.isalpha() else _DIGIT if c.isnumeric() else _OTHER


_KIND = np.array([_class(chr(i)) for i in range(256)], np.uint8)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_names() -> list[str]:
    """Byte-level vocabularies write a byte as itself if it prints in Latin-1, else as the next code point from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def _spans(data: np.ndarray, off: np.ndarray):
    """The vocabulary's words in the texts data[off[i]:off[i+1]] of Latin-1 characters, in lower-cased UTF-8.

    (lower-cased bytes, starts, ends), white space left out; a text's end ends a word.
    """
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return data, none, none
    low = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    kind = _KIND[data]
    head = np.ones(n, bool)
    if (two := np.flatnonzero(data >= 0xC2)).size:
        code = ((data[two].astype(np.int64) & 3) << 6) | (data[two + 1] & 63)
        kind[two] = kind[two + 1] = _KIND[code]
        head[two + 1] = False
        capital = (code >= 0xC0) & (code <= 0xDE) & (code != 0xD7)
        low[two[capital] + 1] += np.uint8(32)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    fresh = edge[:-1].copy()
    fresh[0] = True
    fresh[1:] |= (kind[1:] != kind[:-1]) | ((kind[1:] == _DIGIT) & head[1:])
    at = np.flatnonzero(fresh)
    end = np.append(at[1:], n)
    word = kind[at] != _SPACE
    s, e = at[word], end[word]
    mark = np.flatnonzero((low[s] == 39) & (e - s == 1))  # a lone apostrophe before s, t, m, d, re, ve or ll takes them along
    mark = mark[mark + 1 < len(s)]
    if mark.size:
        nxt = mark + 1
        mark = mark[(s[nxt] == e[mark]) & (kind[s[nxt]] == _LETTER) & ~edge[s[nxt]]]
        nxt = mark + 1
        a = low[s[nxt]]
        b = low[np.minimum(s[nxt] + 1, n - 1)] * (e[nxt] - s[nxt] > 1)
        takes = np.where(np.isin(a, [115, 116, 109, 100]), 1, np.where(((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108), 2, 0))
        e[mark] += takes
        s[nxt] += takes
        left = s < e
        s, e = s[left], e[left]
    return low, s, e


class Encoder:
    """Texts to ids, as little-endian unsigned 16- or 32-bit integers."""

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path or default_path())
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 65536 else "<u4")
        self.code, self.names, self.merge = "H" if self.dtype.itemsize == 2 else "I", _byte_names(), self.tok.model.tokenize
        self.words: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        spec = json.loads(self.tok.to_str())
        kinds = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.fast = kinds == ["NFC", "Replace", "Lowercase"] and pre[0].get("pattern", {}).get("Regex") == _PATTERN and [x["type"] for x in pre] == ["Split", "ByteLevel"]
        self.special = re.compile("|".join(re.escape(x["content"]) for x in spec["added_tokens"]).encode() or rb"(?!)")

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype)

    def _word(self, word: bytes) -> bytes:
        found = self.words.get(word)
        if found is None:
            found = self.old.get(word)
            if found is None:
                name = word.decode() if word.isalpha() else "".join([self.names[b] for b in word])
                found = array(self.code, [t.id for t in self.merge(name)]).tobytes()
            if len(word) <= LONG:
                if len(self.words) >= WORDS // 2:
                    self.old, self.words = self.words, {}
                self.words[word] = found
        return found

    def _many(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, where each text's begin) of Latin-1 texts."""
        low, s, e = _spans(data, off)
        if not len(s):
            return np.zeros(0, self.dtype), np.zeros(len(off), np.int64)
        pw, inv = _powers(len(low) + 1)
        total = np.zeros(len(low) + 1, np.uint64)
        np.cumsum(_BYTE[low] * pw[:-1], out=total[1:])
        key = mix((total[e] - total[s]) * inv[s] + (e - s).astype(np.uint64) * U(0xD6E8FEB86659FD93))
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        raw = low.tobytes()
        coded = [self._word(raw[i:j]) for i, j in zip(s[first].tolist(), e[first].tolist())]
        flat = np.frombuffer(b"".join(coded), self.dtype)
        size = np.fromiter(map(len, coded), np.int64, len(coded)) // self.dtype.itemsize
        n = size[which]
        begin = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat((np.cumsum(size) - size)[which] - begin[:-1], n) + np.arange(begin[-1])]
        return ids, begin[np.searchsorted(s, off)]

    def column(self, col: pa.Array):
        """The ids of each text in turn; null is as empty."""
        data, off = text_buffers(col)
        for i, j in slices(off, SLICE):
            part, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
            if self.fast and not (part >= 0xC4).any() and not self.special.search(part):
                ids, at = self._many(part, o)
                for r in range(j - i):
                    yield ids[at[r] : at[r + 1]]
            else:
                for r in range(j - i):
                    one = part[o[r] : o[r + 1]]
                    if self.fast and not (one >= 0xC4).any() and not self.special.search(one):
                        yield self._many(one, np.array([0, len(one)], np.int64))[0]
                    else:
                        yield self._whole(one.tobytes().decode())

    def ids(self, text: str | None) -> np.ndarray:
        return next(self.column(pa.array([text], pa.string())))


@lru_cache(1)
def encoder(path: str | None = None) -> Encoder:
    """The worker's encoder: it is loaded, and its words are looked up, once for all its tasks."""
    return Encoder(path)
