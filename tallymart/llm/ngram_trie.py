"""A compact trie of words and the contexts before them, in levels that are mapped from a file.

First level: hashes of words, an Elias-Fano sequence, with one value each.  Second level: for each
word the sorted ids of its contexts, found through monotone Elias-Fano pointers; a context is
searched among its word's own contexts only.  Values are quantised.
"""

from __future__ import annotations

import json
from functools import cached_property
from pathlib import Path

import numpy as np

CONTEXT_BITS = 40  # of a context's hash; two contexts of one word share an id once in 10**12
LEVELS = 1 << 16  # steps of a quantised value


class EliasFano:
    """A sorted sequence of unsigned numbers: low bytes as they are, high parts as counts in unary."""

    def __init__(self, low: np.ndarray, high: np.ndarray, size: int):
        self.low, self.high, self.size = low, high, size

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        size = len(values)
        bits = int(values[-1]).bit_length() if size else 0
        spare = max(0, bits - max(size, 1).bit_length())
        width = -(-spare // 8)  # whole bytes of each number
        planes = values.astype("<u8").view(np.uint8).reshape(size, 8)[:, :width]
        above = (values >> np.uint64(8 * width)) if width < 8 else np.zeros(size, np.uint64)
        places = above.astype(np.int64) + np.arange(size)
        unary = np.zeros(int(places[-1]) + 1 if size else 0, np.uint8)
        unary[places] = 1
        return cls(np.ascontiguousarray(planes), np.packbits(unary), size)

    def decode(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(np.asarray(self.high)))
        values = np.zeros((self.size, 8), np.uint8)
        values[:, : self.low.shape[1]] = self.low
        out = values.reshape(-1).view("<u8").astype(np.uint64) if self.size else np.zeros(0, np.uint64)
        width = self.low.shape[1]
        if width < 8:
            out |= (places - np.arange(self.size)).astype(np.uint64) << np.uint64(8 * width)
        return out


def quantised(values: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(codes, least, step) of values in equal steps."""
    least = float(values.min(initial=0.0)) if len(values) else 0.0
    step = (float(values.max()) - least) / (LEVELS - 1) if len(values) else 0.0
    codes = np.round((values - least) / step) if step else np.zeros(len(values))
    return codes.astype(np.uint16), least, step


class Trie:
    """Words, their values, their contexts and the contexts' values."""

    def __init__(self, arrays: dict[str, np.ndarray], head: dict):
        self.head = head
        sequence = {
            n: EliasFano(arrays[f"{n}_low"].reshape(head[f"{n}_size"], -1), arrays[f"{n}_high"], head[f"{n}_size"])
            for n in ("words", "ends")
        }
        self.words, self.ends = sequence["words"], sequence["ends"]
        self.contexts, self.codes, self.values = arrays["contexts"], arrays["codes"], arrays["values"]

    @staticmethod
    def write(path: Path, words: np.ndarray, values: np.ndarray, ends: np.ndarray, contexts: np.ndarray, logs: np.ndarray) -> None:
        """`ends`: where each word's contexts end; `contexts` sorted within each word; `values` of words."""
        codes, least, step = quantised(logs)
        parts = {"words": EliasFano.encode(words), "ends": EliasFano.encode(ends)}
        arrays = {f"{n}_{k}": getattr(p, k) for n, p in parts.items() for k in ("low", "high")}
        low = contexts.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : CONTEXT_BITS // 8]
        arrays |= {"contexts": np.ascontiguousarray(low), "codes": codes, "values": values.astype("<f8")}
        head = {"least": least, "step": step, **{f"{n}_size": p.size for n, p in parts.items()}}
        head["arrays"] = [(n, str(a.dtype), list(a.shape)) for n, a in arrays.items()]
        text = json.dumps(head).encode()
        with path.open("wb") as file:
            file.write(len(text).to_bytes(8, "little") + text)
            for array in arrays.values():
                file.write(array.tobytes())

    @classmethod
    def open(cls, path: Path) -> Trie:
        with path.open("rb") as file:
            size = int.from_bytes(file.read(8), "little")
            head = json.loads(file.read(size))
        arrays, at = {}, 8 + size
        for name, kind, shape in head["arrays"]:
            count = int(np.prod(shape))
            mapped = np.memmap(path, np.dtype(kind), "r", at, (count,)) if count else np.zeros(0, kind)
            arrays[name] = mapped.reshape(shape)
            at += count * np.dtype(kind).itemsize
        return cls(arrays, head)

    def find_words(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each word, -1 if unknown: successor search in the first level."""
        words = self.words.decode()
        places = np.searchsorted(words, hashes)
        if not len(words):
            return np.full(len(hashes), -1)
        return np.where(words[np.minimum(places, len(words) - 1)] == hashes, places, -1)

    @cached_property
    def _keys(self) -> np.ndarray:
        """Each context's id under its word's place, as the pointers have it."""
        ends = self.ends.decode().astype(np.int64)
        own = np.zeros((len(self.contexts), 8), np.uint8)
        own[:, : self.contexts.shape[1]] = self.contexts
        owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)).astype(np.uint64)
        return owner << np.uint64(CONTEXT_BITS) | own.reshape(-1).view("<u8")

    def find(self, words: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, value) of each pair of a word's place and a context: successor search among the word's own."""
        keys = self._keys
        asked = words.astype(np.uint64) << np.uint64(CONTEXT_BITS) | contexts
        places = np.searchsorted(keys, asked)
        inside = np.minimum(places, max(len(keys) - 1, 0))
        found = (words >= 0) & (keys[inside] == asked) if len(keys) else np.zeros(len(asked), bool)
        values = np.zeros(len(asked))
        values[found] = self.head["least"] + self.head["step"] * self.codes[inside[found]]
        return found, values
