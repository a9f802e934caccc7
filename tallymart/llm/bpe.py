"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word exactly one token can be the last of its encoding.  Candidates are the
tokens that end there, found by an automaton that follows suffix links; a candidate stands if it is
compatible with the last token of the prefix before it, that is if the merges of the pair never
cross their border.  The back-pointers from the whole word give its ids.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallymart.llm.shared import map_batches, whole_text

MEMO = 600_000  # words whose ids a worker remembers
PAIRS = 1_000_000  # pairs of tokens whose compatibility it remembers
MEMO_CHARS = 64  # longest word that it remembers
END = 256  # added to the last byte of a word: the word-end form of that byte

#: The stand-ins of the byte-level alphabet (printable bytes stand for themselves).
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_letters() -> list[str]:
    """The letter of each byte 0..255."""
    letters, spare = [""] * 256, 256
    for b in range(256):
        if b in PRINTABLE:
            letters[b] = chr(b)
        else:
            letters[b], spare = chr(spare), spare + 1
    return letters


class WordSplitter:
    """The normalised words of a text, as the tokenizer file defines them, and its special tokens."""

    def __init__(self, spec: dict, path: str):
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if steps != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or not split["invert"]:
            raise ValueError("a tokenizer file of another kind")
        pattern = split["pattern"]["Regex"]
        self.find = regex.compile(pattern, regex.V1).findall
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        choices = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.library = Tokenizer.from_file(path)
        self.byte = {c: b for b, c in enumerate(byte_letters())}
        self.new_from = new_letters()[:1] or chr(0x10FFFF)
        self.new = regex.compile(f"[{new_letters()}]").search if new_letters() else lambda text: False
        self.parts = regex.compile(f"({choices})").split if choices else lambda text: [text]

    @staticmethod
    def normal(text: str) -> str:
        """NFC and lower case letter by letter (a capital sigma never becomes a final one).

        Runs of white space need no change: words never contain any.
        """
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")
        return text.lower()

    def has_new_letters(self, text: str) -> bool:
        """Whether it holds letters that Unicode got lately, and not in the same year in every library."""
        if text.isascii():
            return False
        try:
            text.encode("latin-1")  # the quickest way to see that all letters are old ones
        except UnicodeEncodeError:
            return max(text) >= self.new_from and bool(self.new(text))
        return False

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if self.has_new_letters(text):
            pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return [bytes(self.byte[c] for c in piece).decode() for piece, _ in pieces]
        return self.find(self.normal(text))


@lru_cache(maxsize=1)
def new_letters() -> str:
    """Letters and digits that the pattern library knows and the character database does not."""
    known = regex.compile(r"[\p{L}\p{N}]").match
    points = (c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn" and known(c))
    return "".join(points)


class PrefixEncoder:
    """Ids of a word by the table of last tokens."""

    def __init__(self, spec: dict):
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        letter = {c: chr(b) for b, c in enumerate(byte_letters())}
        self.vocab: dict[str, int] = model["vocab"]

        def symbols(token: str) -> str:
            ends = token.endswith(suffix)
            out = [letter[c] for c in token.removesuffix(suffix)]
            return "".join([*out[:-1], chr(ord(out[-1]) + END)] if ends else out)

        self.symbols = {i: symbols(t) for t, i in self.vocab.items()}
        ranks = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            made = self.vocab[left + right]
            pair = self.vocab[left], self.vocab[right]
            ranks[pair] = rank
            if made in self.halves:
                raise ValueError(f"two merges make token {made}")
            self.halves[made] = pair
        # A token's time is the rank of the merge that makes it; single symbols exist from the start.
        self.time = {i: ranks[self.halves[i]] if i in self.halves else -1 for i in self.symbols}
        self.merged = ranks
        self.memo: dict[int, bool] = {}
        self.suffixes = ahocorasick.Automaton()
        for i, s in self.symbols.items():
            if self.whole(i):
                self.suffixes.add_word(s, (i, len(s)))
        self.suffixes.make_automaton()

    def whole(self, token: int) -> bool:
        """Whether a token is what its own symbols encode to: every half is, and the halves are compatible
        up to the merge that joins them."""
        if token not in self.halves:
            return True
        left, right = self.halves[token]
        return self.compatible(left, right, self.time[token])

    def compatible(self, left: int, right: int, until: int | None = None) -> bool:
        """Whether no merge crosses the border of two tokens, or none before the merge of rank `until`.

        The two are unmade step by step, the latest made first; at each step the pieces that touch
        the border are those present before that merge.  A merge of theirs would have come first if
        its rank is lower than that of the piece unmade next to it.
        """
        limit = until if until is not None else len(self.merged)
        a, b = left, right
        while True:
            rank = self.merged.get((a, b))
            if rank is not None and rank < limit:
                return False
            time_a, time_b = self.time[a], self.time[b]
            if time_a < 0 and time_b < 0:
                return True
            # Of two pieces made by merges of equal rank the left one is made first.
            if time_a > time_b:
                a, limit = self.halves[a][1], time_a
            else:
                # A crossing merge of the same rank would still come first: it lies to the left of b's.
                b, limit = self.halves[b][0], time_b + 1

    def encode(self, word: str) -> list[int]:
        """The ids of one word (whole, of any length)."""
        data = word.encode().decode("latin-1")
        text = data[:-1] + chr(ord(data[-1]) + END)
        last, size = [-1] * (len(text) + 1), [0] * (len(text) + 1)
        memo = self.memo
        for end, (token, length) in self.suffixes.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            if length < end:
                before = last[end - length]
                key = before << 32 | token
                fits = memo.get(key)
                if fits is None:
                    if len(memo) >= PAIRS:
                        memo.clear()
                    fits = memo[key] = before >= 0 and self.compatible(before, token)
                if not fits:
                    continue
            last[end], size[end] = token, length
        ids, at = [], len(text)
        while at:
            ids.append(last[at])
            at -= size[at]
        ids.reverse()
        return ids


class Memo(dict):
    """Remembers what `make` gives for short words; emptied when it holds `MEMO` of them."""

    def __init__(self, make: Callable[[str], str]):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> str:
        found = self.make(word)
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.clear()
            self[word] = found
        return found


class Codec:
    """Encodes and decodes whole texts; remembers frequent words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec.get("decoder") or spec.get("post_processor") or spec["model"]["unk_token"]:
            raise ValueError("a tokenizer file of another kind")
        self.split = WordSplitter(spec, path)
        self.encoder = PrefixEncoder(spec)
        self.tokens = {str(i): t for t, i in spec["model"]["vocab"].items()} | {
            str(t["id"]): t["content"] for t in spec["added_tokens"]
        }
        self.known = Memo(lambda word: " ".join(map(str, self.encoder.encode(word))))

    def pieces(self, text: str) -> Iterator[str]:
        """Ids in decimal, joined by one space, of each word and special token."""
        for i, part in enumerate(self.split.parts(text)):
            if i % 2:
                yield str(self.split.special[part])
            else:
                yield from map(self.known.__getitem__, self.split.words(part))

    def encode(self, text: str) -> str:
        """The ids of a whole text in decimal, joined by one space."""
        return " ".join(self.pieces(text))

    def decode(self, ids: str) -> str:
        """Ids in decimal to text as the tokenizer file has it: it names no decoder, so tokens are joined by spaces."""
        return " ".join(map(self.tokens.__getitem__, ids.split(" "))) if ids else ""


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def round_trip(docs: DataFrame, path: str, with_ids: bool = False, carried: tuple[str, ...] = ()) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256), one per row of `docs`, the ids if asked for, columns `carried`.

    Every whole text is encoded and its ids are decoded again; a null text counts as empty, an
    empty one has no ids.  The tokenizer file must lie at `path` on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, decode = codec(path).encode, codec(path).decode
        for batch in batches:
            rows = []
            for text in batch.column(1):
                ids = encode(text.as_py())
                count = ids.count(" ") + 1 if ids else 0
                row = [count, digest(ids), digest(decode(ids))]
                rows.append([*row, np.fromstring(ids, np.int32, sep=" ")] if with_ids else row)
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, *batch.columns[2:]], [*names, *carried])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())][: len(names) - 1]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), *carried)
    schema += "".join(f", {name} {kind}" for name, kind in docs.dtypes[2:])
    return map_batches(docs, run, schema)


def encode(docs: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """Rows (doc_id, ids), the ids of every row's whole text as an array of int."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path).encode
        for batch in batches:
            ids = [[int(i) for i in encode(t.as_py()).split()] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", column])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return map_batches(docs, run, f"doc_id long, {column} array<int>")


def decode(rows: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """Rows (doc_id, text) of ids; a null array decodes to a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = codec(path).decode
        for batch in batches:
            texts = [None if v is None else back(" ".join(map(str, v))) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_batches(rows.select("doc_id", column), run, "doc_id long, text string")
