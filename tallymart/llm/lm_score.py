"""Language-model scores of all texts from a bigram model whose trie is sharded by word.

``P(w | v) = (c(v w) + m P(w)) / (c(v) + m)`` with ``P(w) = (c(w) + 1) / (N + V + 1)``, which leaves
one share to unknown words.  Every token goes once to the shard of its word, packed with the word
before it; the shard has all that the word's terms need: its count, its contexts' counts, and the
normaliser of the next token's term, which depends on this word alone.  Shards build their part of
the trie from the training tokens, write and map it, and look up the tokens of all texts.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.ngram_trie import CONTEXT_BITS, Trie
from tallymart.llm.shared import map_batches, settle, ship, whole_text

FOLDS, HELD = 7, 2  # held out: crc32 of the doc_id's text, modulo FOLDS, is HELD
MASS = 500.0  # m: weight of the word's own probability against its contexts
SHARD_TOKENS = 3_000_000
BLOCK_TOKENS, BLOCK_DOCS = 1 << 20, 60_000  # of a packed block
HOT_WORDS = 1 << 16  # most words that are dealt by their contexts
LOOKUPS = 1 << 19  # tokens looked up at once
MEMO = 300_000
END_WORD, BEGIN_WORD = b" ", b"  "  # no word holds a space

PACKED = (
    "shard int, block long, words binary, counts binary, before binary, doc binary, texts binary, train binary,"
    " ended binary, doc_id binary, flags binary"
)
SUMS = (
    "block long, texts binary, n_tokens binary, n_known binary, base binary, score binary, ended binary, doc_id binary,"
    " flags binary"
)
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"


class Hashes(dict):
    """64-bit hashes of words; emptied when it holds `MEMO` of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def held_out() -> Column:
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(name, "UTF-8")), F.lit(FOLDS)) == HELD


def _rows(docs: DataFrame) -> DataFrame:
    text = whole_text()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (~held_out()).alias("train"), text.alias("text")
    )


def _tokens(known: Hashes, text: str) -> np.ndarray:
    """Hashes of a text's words and the end."""
    words = text.encode().lower().split()
    words.append(END_WORD)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def word_counts(docs: DataFrame) -> DataFrame:
    """Rows (word, n): hash and count of every token of the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for batch in batches:
            held, size = [], 0
            for i, text in enumerate(batch.column(0), 1):
                held.append(_tokens(known, text.as_py()))
                size += len(held[-1])
                if i == batch.num_rows or size >= BLOCK_TOKENS:
                    words, n = np.unique(np.concatenate(held), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(words.view("<i8")), pa.array(n)], ["word", "n"])
                    held, size = [], 0

    train = _rows(docs).where("train").select("text")
    return map_batches(train, run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes."""
    x = a * np.uint64(0x9E3779B97F4A7C15) ^ b
    x ^= x >> np.uint64(29)
    return x * np.uint64(0xBF58476D1CE4E5B9)


def _pack(docs: list[tuple], block: int, shards: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A block's tokens, a row a shard: its words and their counts, for each token the context and the text, and
    who the texts are that end there."""
    sizes = np.array([len(d[2]) for d in docs])
    words = np.concatenate([d[2] for d in docs])
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[np.cumsum(sizes) - sizes] = np.uint64(xxhash.xxh64_intdigest(BEGIN_WORD))
    doc = np.repeat(np.arange(len(docs)), sizes)
    place = np.minimum(np.searchsorted(hot, words), max(len(hot) - 1, 0))
    by_context = hot[place] == words if len(hot) else np.zeros(len(words), bool)
    shard = (np.where(by_context, _mixed(words, before), _mixed(words, words)) >> np.uint64(20)) % np.uint64(shards)
    order = np.lexsort((words, shard))
    shard, words, before, doc = shard[order], words[order], before[order], doc[order]
    edges = np.flatnonzero(np.diff(shard)) + 1
    ids = np.array([d[0] if d[0] is not None else 0 for d in docs], "<i8")
    flags = np.array([2 * (d[0] is None) + bool(d[1]) for d in docs], np.uint8)
    end = np.uint64(xxhash.xxh64_intdigest(END_WORD))
    names = [c.split()[0] for c in PACKED.split(", ")]
    for i, j in zip([0, *edges], [*edges, len(words)], strict=True):
        own, counts = np.unique(words[i:j], return_counts=True)
        texts, at = np.unique(doc[i:j], return_inverse=True)
        context = before[i:j].astype("<u8").view(np.uint8).reshape(-1, 8)[:, : CONTEXT_BITS // 8]
        ended = doc[i:j][words[i:j] == end]
        blobs = (
            own.astype("<u8"), counts.astype("<u4"), np.ascontiguousarray(context), at.astype("<u2"), texts.astype("<u2"),
            flags[texts] & 1, ended.astype("<u2"), ids[ended], flags[ended],
        )
        arrays = [pa.array([int(shard[i])], pa.int32()), pa.array([block], pa.int64())]
        yield pa.RecordBatch.from_arrays([*arrays, *(pa.array([b.tobytes()], pa.binary()) for b in blobs)], names)


def packed_tokens(docs: DataFrame, shards: int, hot: np.ndarray) -> DataFrame:
    """Every token of every text, packed by block and shard; `hot` words are dealt by their contexts too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size = Hashes(), [], 0
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, train = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, trained, text in zip(ids, train, batch.column(2), strict=True):
                held.append((doc_id, trained, _tokens(known, text.as_py())))
                size += len(held[-1][2])
                if size >= BLOCK_TOKENS or len(held) >= BLOCK_DOCS:
                    yield from _pack(held, block, shards, hot)
                    held, size, block = [], 0, block + 1
        if held:
            yield from _pack(held, block, shards, hot)

    return map_batches(_rows(docs), run, PACKED)


def _unpacked(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """(distinct words, place of each token's word, context, text, is each text trained on, texts of each row)."""
    out: list[list[np.ndarray]] = [[] for _ in range(5)]
    sizes = [0]
    for row in rows.itertuples(index=False):
        counts = np.frombuffer(row.counts, "<u4")
        context = np.zeros((int(counts.sum()), 8), np.uint8)
        context[:, : CONTEXT_BITS // 8] = np.frombuffer(row.before, np.uint8).reshape(-1, CONTEXT_BITS // 8)
        parts = (
            np.frombuffer(row.words, "<u8"), counts, context.reshape(-1).view("<u8"),
            np.frombuffer(row.doc, "<u2").astype(np.int32) + np.int32(sizes[-1]), np.frombuffer(row.train, np.uint8),
        )
        for kept, part in zip(out, parts, strict=True):
            kept.append(part)
        sizes.append(sizes[-1] + len(row.train))
    own, counts, *rest = (np.concatenate(x) for x in out)
    words, place = np.unique(own, return_inverse=True)
    return words, np.repeat(place.astype(np.int32), counts), *rest, np.array(sizes)


def shard_sums(rows: pd.DataFrame, total: int, distinct: int, texts: int, hot: np.ndarray, hot_counts: np.ndarray) -> pd.DataFrame:
    """Sums of one shard's terms for each of its texts, packed in a row a block."""
    words, at, contexts, doc, trained, sizes = _unpacked(rows)
    train = np.flatnonzero(trained[doc])
    counts = np.bincount(at[train], minlength=len(words)).astype(np.int64)
    if len(hot):
        place = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
        counts = np.where(hot[place] == words, hot_counts[place], counts)
    own = np.log10((counts + 1) / (total + distinct + 1))
    end = words == np.uint64(xxhash.xxh64_intdigest(END_WORD))
    # a word's count normalises the next token's term; the end normalises the first token's, after the beginning
    below = np.log10(np.where(end, texts, counts) + MASS)
    known, size = counts > 0, len(trained)
    sums = {name: np.zeros(size) for name in ("n_tokens", "n_known", "base", "score")}
    with tempfile.TemporaryDirectory() as folder:
        path = Path(folder) / "trie"
        rank = (np.cumsum(known) - 1).astype(np.uint64)
        keys = rank[at[train]] << np.uint64(CONTEXT_BITS) | contexts[train]
        del train
        keys, n = np.unique(keys, return_counts=True)
        parent = (keys >> np.uint64(CONTEXT_BITS)).astype(np.int64)
        ends = np.cumsum(np.bincount(parent, minlength=int(known.sum())))
        logs = np.log10(n + MASS * 10 ** own[known][parent])
        Trie.write(path, words[known], own[known], ends, keys & np.uint64((1 << CONTEXT_BITS) - 1), logs)
        del keys, n, parent, logs
        trie = Trie.open(path)
        place = trie.find_words(words)
        unigram = np.where(place >= 0, np.asarray(trie.values)[place] if len(trie.values) else own, own)
        for i in range(0, len(at), LOOKUPS):
            word, text = at[i : i + LOOKUPS], doc[i : i + LOOKUPS]
            found, value = trie.find(place[word], contexts[i : i + LOOKUPS])
            term = np.where(found, value, np.log10(MASS) + unigram[word]) - below[word]
            for name, weights in (
                ("n_tokens", None), ("n_known", known[word]), ("base", np.log10(counts[word] + 1)), ("score", term),
            ):
                sums[name] += np.bincount(text, weights, minlength=size)
        del trie
    kinds = {"n_tokens": "<u4", "n_known": "<u4", "base": "<f8", "score": "<f8"}
    packed = {n: [sums[n][i:j].astype(k).tobytes() for i, j in zip(sizes, sizes[1:], strict=False)] for n, k in kinds.items()}
    same = ["block", "texts", "ended", "doc_id", "flags"]
    return rows[same].assign(**packed)[[c.split()[0] for c in SUMS.split(", ")]]


def block_scores(rows: pd.DataFrame) -> pd.DataFrame:
    """The sums of all shards for each text of a block."""
    ended = np.concatenate([np.frombuffer(b, "<u2") for b in rows["ended"]])
    ids = np.concatenate([np.frombuffer(b, "<i8") for b in rows["doc_id"]])
    flags = np.concatenate([np.frombuffer(b, np.uint8) for b in rows["flags"]])
    kinds = {"n_tokens": "<u4", "n_known": "<u4", "base": "<f8", "score": "<f8"}
    sums = {n: np.zeros(len(ended), "<i8" if k == "<u4" else k) for n, k in kinds.items()}
    for row in rows.itertuples(index=False):
        texts = np.frombuffer(row.texts, "<u2")
        for n, k in kinds.items():
            sums[n][texts] += np.frombuffer(getattr(row, n), k)
    order = np.argsort(ended)  # every text of a block ends once
    doc_id = pd.Series(ids[order], dtype="Int64").mask((flags[order] & 2) > 0)
    return pd.DataFrame({"doc_id": doc_id, "held_out": (flags[order] & 1) == 0, **sums})


def score(docs: DataFrame, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one per row of `docs`.

    Null texts count as empty (the end alone), a null doc_id as the empty name.  Repeated rows
    are texts like any other.  Without training texts every token is
    unknown.  An empty table has no rows.
    """
    ship(docs.sparkSession)
    counts = settle(word_counts(docs), "word-counts")
    sums = counts.agg(F.sum("n").alias("total"), F.count("*").alias("distinct")).first()
    total, distinct = int(sums["total"] or 0), int(sums["distinct"])
    end = xxhash.xxh64_intdigest(END_WORD)
    ends = counts.where(F.col("word") == end - (1 << 64) * (end >> 63)).first()
    texts = int(ends["n"]) if ends else 0
    shards = max(1, -(-total * FOLDS // ((FOLDS - 1) * shard_tokens)))
    # at most HOT_WORDS words have so large a share
    least = max(shard_tokens // 4, total // HOT_WORDS + 1)
    rows = counts.where(F.col("n") >= least).collect()
    pairs = sorted((r["word"] % (1 << 64), r["n"]) for r in rows)
    hot = np.array([w for w, _ in pairs], np.uint64)
    hot_counts = np.array([n for _, n in pairs], np.int64)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return shard_sums(rows, total, distinct, texts, hot, hot_counts)

    parts = packed_tokens(docs, shards, hot).groupBy("shard").applyInPandas(run, SUMS)
    whole = parts.groupBy("block").applyInPandas(block_scores, SCORES)
    classes = F.log10(F.lit(float(total + distinct + 1)))
    return whole.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * classes).alias("base_score"), "score",
    )
