"""Near duplicates by SimHash fingerprints, compared around the anchors of a covering code.

A fingerprint is cut into pieces.  If two fingerprints differ in at most `distance` bits, some
piece differs in at most ``near = distance // pieces`` bits.  Each piece's values are covered by
a code: a product of perfect Hamming codes and free bits, so every value lies within the covering
radius `R` of an anchor (code word).  A fingerprint is at home at its nearest anchor and is copied
to every anchor within ``R + near``; two values within `near` of each other therefore meet at the
home of either.  Each anchor compares its home fingerprints with all its copies and passes on a
spanning forest of the links found, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.components import components
from tallymart.llm.shared import map_batches, settle, whole_text

BITS = 64
SEED = 42
CHUNK = 1 << 15  # shingles hashed at once
BLOCK = 1 << 22  # comparisons held at once
CROWD = 4096  # home fingerprints of an anchor that one group compares
NO_ID = (1 << 63) - 1  # where rows without a doc_id stand among the others


def fingerprint(text: str, words: int) -> int:
    """The SimHash of a text: bit set if set in over half the shingles' XXH64 (seed 42); 0 without words."""
    parts = text.encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    starts, ends = starts[:n], ends[min(words, len(parts)) - 1 :]
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, CHUNK):
        pairs = zip(starts[i : i + CHUNK].tolist(), ends[i : i + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """Rows (doc_id, text_hash, fp): the signed 64-bit fingerprint of every row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in batch.column(2)], "<u8")
            columns = [*batch.columns[:2], pa.array(fps.view("<i8"))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp"])

    text = whole_text()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return map_batches(docs, run, "doc_id long, text_hash long, fp long")


@dataclass(frozen=True)
class Cover:
    """Pieces of the fingerprint, each with its code as (kind, bits) parts; kind "hamming" or "free"."""

    pieces: tuple[tuple[tuple[str, int], ...], ...]

    def near(self, distance: int) -> int:
        return distance // len(self.pieces)


#: Two codes: short pieces make few copies, long ones few fingerprints at an anchor.
SHORT = Cover(
    (
        (("hamming", 15), ("hamming", 7)),
        (("hamming", 15), ("hamming", 7)),
        (("hamming", 15), ("free", 5)),
    )
)
LONG = Cover(((("hamming", 31), ("free", 1)), (("hamming", 31), ("free", 1))))
LONG_FROM = 1 << 27  # fingerprints from which the long pieces are the cheaper choice


def _syndrome(values: np.ndarray, bits: int) -> np.ndarray:
    """Of a Hamming code whose check columns are 1..bits: 0 for code words, else the place of the flipped bit."""
    out = np.zeros(len(values), np.int64)
    for i in range(bits):
        out ^= ((values >> np.uint64(i)) & np.uint64(1)).astype(np.int64) * (i + 1)
    return out


@lru_cache(maxsize=16)
def _part_patterns(kind: str, bits: int, reach: int) -> dict[int, list[tuple[int, int]]]:
    """Syndrome -> (pattern, weight) of all flips of up to `reach` bits that end in a code word."""
    rows, found = [(0, 0, -1)], [(0, 0, 0)]
    for weight in range(1, reach + 1):
        rows = [(p | 1 << i, s ^ (i + 1), i) for p, s, last in rows for i in range(last + 1, bits)]
        found += [(p, s, weight) for p, s, _ in rows]
    out: dict[int, list[tuple[int, int]]] = {}
    for pattern, syndrome, weight in found:
        out.setdefault(syndrome if kind == "hamming" else 0, []).append((pattern, weight))
    return out


@lru_cache(maxsize=16)
def _piece_patterns(parts: tuple[tuple[str, int], ...], near: int) -> dict[int, tuple[np.ndarray, int]]:
    """Joint syndrome -> (patterns within covering radius plus `near`, place of the one that leads home)."""
    reach = near + sum(kind == "hamming" for kind, _ in parts)
    joint, at, place = {0: [(0, 0)]}, 0, 0
    for kind, bits in parts:
        joint = {
            s | t << place: [(p | q << at, v + w) for p, v in left for q, w in right if v + w <= reach]
            for s, left in joint.items()
            for t, right in _part_patterns(kind, bits, reach).items()
        }
        at, place = at + bits, place + 6
    return {
        s: (np.array([p for p, _ in found], np.uint64), min(range(len(found)), key=lambda i, f=found: f[i][1]))
        for s, found in joint.items()
    }


def anchors(fps: np.ndarray, cover: Cover, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) for each fingerprint and each anchor within covering radius plus threshold.

    `anchor` holds the piece's number in its top bits and the code word below; exactly one
    anchor of a piece is a fingerprint's home.
    """
    fps, shift = fps.astype(np.uint64), 0
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for number, parts in enumerate(cover.pieces):
        width = sum(bits for _, bits in parts)
        values = (fps >> np.uint64(shift)) & np.uint64((1 << width) - 1)
        joint, at, place = np.zeros(len(fps), np.int64), 0, 0
        for kind, bits in parts:
            if kind == "hamming":
                joint |= _syndrome(values >> np.uint64(at), bits) << place
            at, place = at + bits, place + 6
        order = np.argsort(joint, kind="stable")
        found, firsts = np.unique(joint[order], return_index=True)
        for s, i, j in zip(found.tolist(), firsts, [*firsts[1:], len(order)], strict=True):
            patterns, home = _piece_patterns(parts, cover.near(distance))[s]
            words = values[order[i:j], None] ^ patterns[None, :]
            flags = np.zeros(words.shape, bool)
            flags[:, home] = True
            rows = np.repeat(order[i:j], len(patterns))
            out.append((rows, words.ravel() | np.uint64(number << 60), flags.ravel()))
        shift += width
    if not out:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none.astype(bool)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def forest(home: np.ndarray, other: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest over all pairs (home, other) within `distance` bits."""
    rows, cols = [], []
    step = max(1, BLOCK // max(1, len(other)))
    for i in range(0, len(home), step):
        a, b = np.nonzero(np.bitwise_count(home[i : i + step, None] ^ other[None, :]) <= distance)
        left, right = home[a + i], other[b]
        linked = left != right
        left, right = left[linked], right[linked]
        if len(left) > len(home) + len(other):
            left, right = _span(left, right)
        rows.append(left)
        cols.append(right)
    left, right = np.concatenate(rows), np.concatenate(cols)
    return _span(left, right) if len(left) else (left, right)


def _span(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most one link per node, from it to its smallest reachable node: minima spread until they rest."""
    nodes, flat = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = flat[: len(left)], flat[len(left) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _spread(fps: DataFrame, cover: Cover, distance: int, home_only: bool = False) -> DataFrame:
    """Rows (anchor, fp, home): each fingerprint at its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8").view("<u8")
            for i in range(0, len(values), CHUNK):
                part = values[i : i + CHUNK]
                rows, anchor, home = anchors(part, cover, distance)
                if home_only:
                    rows, anchor, home = rows[home], anchor[home], home[home]
                columns = [pa.array(anchor.view("<i8")), pa.array(part[rows].view("<i8")), pa.array(home)]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "fp", "home"])

    return map_batches(fps.select("fp"), run, "anchor long, fp long, home boolean")


def links(fps: DataFrame, distance: int = 4, cover: Cover | None = None) -> DataFrame:
    """Rows (a, b): links that connect all distinct fingerprints `fp` within `distance` bits of each other.

    Which links stand for a connected set is open; the sets they connect are exact.
    """
    if cover is None:
        cover = LONG if fps.count() >= LONG_FROM else SHORT
    # A crowded anchor is dealt to several groups: each takes a share of its home fingerprints and all its copies.
    crowded = (
        _spread(fps, cover, distance, home_only=True).groupBy("anchor").count().where(F.col("count") > CROWD)
        .select("anchor", F.ceil(F.col("count") / CROWD).cast("int").alias("shares"))
    )
    shares = F.coalesce("shares", F.lit(1))
    dealt = (
        _spread(fps, cover, distance).join(crowded, "anchor", "left")
        .select(
            "anchor", "fp", "home", F.pmod(F.xxhash64("fp"), shares).cast("int").alias("own"),
            F.explode(F.sequence(F.lit(0), shares - 1)).alias("share"),
        )
        .select("anchor", "share", "fp", (F.col("home") & (F.col("own") == F.col("share"))).alias("home"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for fps, home in _runs(batches):
            if home.any() and len(fps) > 1:
                left, right = forest(fps[home], fps, distance)
                if len(left):
                    held.append((left, right))
            if sum(len(x) for x, _ in held) >= CHUNK:
                yield _batch(held)
                held = []
        yield _batch(held)

    ordered = dealt.repartition("anchor", "share").sortWithinPartitions("anchor", "share")
    return map_batches(ordered, run, "a long, b long").distinct()


def _batch(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    sides = [np.concatenate([np.zeros(0, "<u8"), *(x[i] for x in held)]).view("<i8") for i in (0, 1)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in sides], ["a", "b"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(fingerprints, home flags) of each run of one anchor and share."""
    kept: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        edges = np.flatnonzero((np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0)) + 1
        edges = [0, *edges.tolist(), batch.num_rows]
        for i, j in zip(edges, edges[1:], strict=False):
            run = tuple(c[i:j] for c in columns)
            if kept and (kept[-1][0][0], kept[-1][1][0]) != (run[0][0], run[1][0]):
                yield _joined(kept)
                kept = []
            kept.append(run)
    if kept:
        yield _joined(kept)


def _joined(runs: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray]:
    fps, home = (np.concatenate([r[i] for r in runs]) for i in (2, 3))
    return fps.astype("<i8").view("<u8"), home.astype(bool)


def _grouped(docs: DataFrame, words: int, distance: int, cover: Cover | None) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, fp) of every row, and (fp, first) of every fingerprint: of the rows that it
    reaches the one with the smallest doc_id, then the smallest text hash; rows without a doc_id come last."""
    rows = settle(fingerprints(docs, words), "fingerprints")
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("place"), "doc_id", "text_hash")).alias("first")
    classes = settle(rows.groupBy("fp").agg(first), "classes")
    roots = components(links(classes, distance, cover))
    linked = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    firsts = linked.groupBy("root").agg(F.min("first").alias("first"))
    return rows, settle(linked.drop("first").join(firsts, "root").select("fp", "first"), "members")


def near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4, cover: Cover | None = None) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id), one per row of `docs`.

    A null text counts as empty; texts without words have fingerprint zero and link like any
    other.  Repeated rows are rows of one class.  `component_id` is the smallest doc_id that is
    reachable, null if none of the rows reached has a doc_id.  Other columns are not read.
    """
    rows, members = _grouped(docs, words, distance, cover)
    return rows.join(members, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first.doc_id").alias("component_id")
    )


def keepers(docs: DataFrame, words: int = 4, distance: int = 4, cover: Cover | None = None) -> DataFrame:
    """The rows of `docs` that stay, with their columns: of each component of `near_duplicates` the smallest doc_id.

    Of several texts with that doc_id the one with the smallest hash stays, and each row that repeats it; a
    component without doc_ids keeps the text with the smallest hash.
    """
    _, members = _grouped(docs, words, distance, cover)
    stay = members.select(F.col("first.doc_id").alias("stay_id"), F.col("first.text_hash").alias("stay_hash")).distinct()
    match = docs["doc_id"].cast("long").eqNullSafe(stay["stay_id"]) & (F.xxhash64(whole_text()) == stay["stay_hash"])
    return docs.join(stay, match, "left_semi")
