"""Token ids of whole texts by a public tokenizer, one call for many distinct words.

The tokenizer never joins across white space, so a text's ids are its words' ids one after
the other. Words are cut at ASCII white space and, as this tokenizer's runs of letters end
there, between a letter (ASCII or Latin-1) and an ASCII mark other than the apostrophe, so
that a word has one entry in the memo whatever follows it. Texts with a special token's opening
are cut at white space only. The tokenizer's file must exist on every node.
"""

from __future__ import annotations

import os
import re
import sys
import types
from itertools import chain

import numpy as np
import pyarrow as pa

from statweave.llm.base import WordTable, per_text

MARK = "\x01"  # stands between words that are encoded in one call
_LATIN = rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]"
LETTERS = re.compile(rb"(?:[A-Za-z]|" + _LATIN + rb")+")
OPENING = b"<|"
# kinds of bytes: 1 letter, 2 mark, 3 first and 4 second byte of a Latin-1 letter, 5 white space
KINDS = bytes(
    1 if chr(b).isalpha() and b < 128 else 2 if 33 <= b < 127 and b != 39 and not chr(b).isalnum() else 3 if b == 0xC3
    else 4 if 0x80 <= b <= 0xBF and b not in (0x97, 0xB7) else 5 if b == 32 or 9 <= b <= 13 else 0 for b in range(256)
)


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for 256, 257, …"""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


ALPHABET = byte_alphabet()


def cut_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after the other, and the number of words of each text."""
    text = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    kind = np.frombuffer(text.tobytes().translate(KINDS), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1)
    first = kind == 2
    first[1:] &= (kind[:-1] == 1) | (kind[:-1] == 4) & np.concatenate([[False], kind[:-2] == 3])[: len(kind) - 1]
    first[:1] = False
    for i in [i for i, t in enumerate(texts) if OPENING in t]:
        first[ends[i] - sizes[i] - 1 : ends[i]] = False
    inside = kind != 5
    first[:1] |= inside[:1]
    first[1:] |= inside[1:] & ~inside[:-1]
    start = np.flatnonzero(first)
    # white space goes, so that a word's bytes end where the next word's begin
    offsets = np.append(start, len(text)) - np.searchsorted(np.flatnonzero(~inside), np.append(start, len(text)))
    data = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(text[inside])]
    many = np.diff(np.searchsorted(start, ends), prepend=0)
    return pa.Array.from_buffers(pa.binary(), len(start), data), many


def cut_all(texts: list[bytes]) -> list[list[bytes]]:
    """The words of every text."""
    words, many = cut_words(texts)
    flat, ends = words.to_pylist(), np.cumsum(many).tolist()
    return [flat[e - n : e] for e, n in zip(ends, many.tolist())]


def cut(text: bytes) -> list[bytes]:
    """The words of a text."""
    return cut_all([text])[0]


def gather(values: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values`` with the given numbers one after the other, and their sizes."""
    many = sizes[numbers]
    start = (np.cumsum(sizes) - sizes)[numbers]
    at = np.repeat(start - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    return values[at], many


def process_encoder(path: str) -> WordEncoder:
    """One encoder per worker process, whose memo later tasks of the process go on using."""
    home = sys.modules.setdefault("_process_encoders", types.ModuleType("_process_encoders"))
    if path not in home.__dict__:
        home.__dict__[path] = WordEncoder(path)
    return home.__dict__[path]


class WordEncoder:
    """Ids of texts; holds a bounded memo of words, from which the rarely used ones go first."""

    def __init__(self, path: str, limit: int = 400_000):
        # Spark runs one task per core; threads of a task's own cost CPU time and memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.words = Tokenizer.from_file(path), WordTable(limit)
        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self.ids, self.sizes, self.uses = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _trim(self) -> None:
        """Keep the words used often, half of the limit at most, when the memo is over its limit."""
        if len(self.words) <= self.words.limit:
            return
        least = max(2, int(np.partition(self.uses, -(self.words.limit // 2))[-(self.words.limit // 2)]) + 1)
        kept = np.flatnonzero(self.uses >= least)
        names = list(self.words)
        self.ids, self.sizes = gather(self.ids, self.sizes, kept)
        self.uses = self.uses[kept] // 2
        self.words.clear()
        self.words.update((names[w], i) for i, w in enumerate(kept.tolist()))

    def _numbered(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        self._trim()
        words, sizes = cut_words(texts)
        numbers = self.words.number_array(words)
        raw = self.words.take_fresh()
        if raw:
            plain = np.array([w.isalpha() or LETTERS.fullmatch(w) is not None for w in raw])
            fresh = [w.decode("utf-8", "replace") for w in raw]
            parts = [self._letters([w for w, p in zip(fresh, plain) if p]), self._encoded([w for w, p in zip(fresh, plain) if not p])]
            place = np.empty(len(fresh), np.int64)  # where each word's ids are among the two parts
            place[np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])] = np.arange(len(fresh))
            ids, many = gather(*(np.concatenate([p[i] for p in parts]) for i in (0, 1)), place)
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, many])
        uses = np.bincount(numbers, minlength=len(self.sizes))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        return numbers, sizes

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letters are one token run, which only lower-casing and the byte alphabet change: the merges alone are left to do."""
        tokenize = self.tokenizer.model.tokenize
        spelt = [w if (w := v.lower()).isascii() else w.encode().decode("latin-1").translate(ALPHABET) for v in words]
        found = [[t.id for t in tokenize(w)] for w in spelt]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has."""
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(self.mark) != 1 or any(MARK in w or "<|" in w for w in words):
            found = [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum())), sizes
        lines = [f" {MARK} ".join(words[i : i + 500]) for i in range(0, len(words), 500)]
        encoded = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        flat = np.concatenate([np.array(e.ids + self.mark, np.uint32) for e in encoded])
        ends = flat == self.mark[0]
        return flat[~ends], np.diff(np.flatnonzero(ends), prepend=-1) - 1

    def count(self, texts: list[bytes]) -> np.ndarray:
        """Number of ids of each text."""
        numbers, sizes = self._numbered(texts)
        return per_text(self.sizes[numbers], sizes)

    def encode(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each text ended by ``end``, and their numbers."""
        numbers, sizes = self._numbered(texts)
        ids, many = gather(self.ids, self.sizes, numbers)
        lengths = per_text(many, sizes)
        result = np.full(int(lengths.sum()) + len(texts), end, np.uint32)
        inside = np.ones(len(result), bool)
        inside[np.cumsum(lengths + 1) - 1] = False
        result[inside] = ids
        return result, lengths + 1
