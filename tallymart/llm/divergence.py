"""Divergence of sources within a language, over count-level bitmaps.

A language keeps the terms of at least `least_docs` of its documents.  Its kept terms are dealt to
chunks of words of 64 terms, terms of like frequency together.  A level is the set of a word's terms
that a source has equally often, stored as a bitmap; two sources' joint cells are the AND of their
levels, their sizes its popcount.  Terms that one or both sources lack are counted by complement,
from the sizes of the levels alone.  Sources meet in tiles, so no task holds all of a language.

Divergence of two shares p and q of one term: floor((p - q)^2 / (p + q)), shares being
1 + floor(SCALE * (count + 2) / (N + 2 * V)); all in exact integers, sums of counts below 9 * 10^15.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.shared import map_batches, settle, ship, whole_text

SCALE = 1_000_000_000
TERMS = 300_000  # (group, term) entries that a task adds up before it passes them on
CHUNK = 4096  # kept terms of a chunk, about
TILE = 64  # sources of a tile

#: Bytes of a term, A-Z in lower case; all others separate terms.
LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

COUNTED = "lang string, source string, term string, n long, d long"


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order: runs of A-Z, a-z and of all that is beyond ASCII."""
    return text.encode().translate(LETTERS).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of COUNTED: occurrences of a term in a group and the documents that hold it, added up in part."""
    found: dict[tuple[str, str], dict[bytes, int]] = {}
    held = 0

    def passed() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in found.items():
            size = len(terms)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
                    pa.array(terms.keys(), pa.binary()).cast(pa.string()),
                    pa.array([n & (1 << 40) - 1 for n in terms.values()], pa.int64()),
                    pa.array([n >> 40 for n in terms.values()], pa.int64()),
                ],
                ["lang", "source", "term", "n", "d"],
            )
        found.clear()

    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = found.setdefault((lang, source), {})
            before = len(own)
            for term, n in Counter(terms_of(text)).items():
                own[term] = own.get(term, 0) + n + (1 << 40)  # documents above 40 bits of occurrences
            held += len(own) - before
            if held >= TERMS:
                yield from passed()
                held = 0
    yield from passed()


def share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / total) in longs, by long division in three digits of 1000; 0 without terms."""
    rest, digits = count + 2, F.lit(0).cast("long")
    for _ in range(3):
        digits = digits * 1000 + F.call_function("div", rest * 1000, total)
        rest = (rest * 1000) % total
    return F.when(total > 0, 1 + digits).otherwise(F.lit(0).cast("long"))


def divergence(p: Column, q: Column) -> Column:
    return F.when(p + q > 0, F.call_function("div", (p - q) * (p - q), p + q)).otherwise(F.lit(0).cast("long"))


def _div(p, q):
    """`divergence` of arrays; shares are at most SCALE + 1, so the square fits."""
    return (p - q) ** 2 // np.maximum(p + q, 1)


def term_counts(docs: DataFrame) -> DataFrame:
    """Rows (lang, source, term, n, d): occurrences and documents of every term of every group."""
    groups = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")), whole_text().alias("text"))
    found = map_batches(groups, _count, COUNTED)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def _placed(kept: DataFrame, chunk: int) -> DataFrame:
    """`kept` (lang, term, lang_n) with band, chunk, word and bit: terms of like frequency share a band."""
    kept = kept.withColumn("band", F.floor(F.log2(F.col("lang_n").cast("double"))).cast("int"))
    bands = kept.groupBy("lang", "band").agg(F.ceil(F.count("*") / chunk).cast("long").alias("chunks"))
    dealt = kept.join(bands, ["lang", "band"]).withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")))
    # else a join's partitions by band would serve the window, and a band's terms stay in one task
    dealt = dealt.repartition("lang", "band", "chunk")
    place = F.row_number().over(Window.partitionBy("lang", "band", "chunk").orderBy("term")) - 1
    return dealt.withColumn("place", place).select(
        "lang", "term", "lang_n", "band", "chunk",
        F.shiftright("place", 6).alias("word"), F.col("place").bitwiseAND(63).alias("bit"),
    )


PARTS = "lang string, a int, b int, value long"


def _joint(table: pa.Table) -> pa.Table:
    """Sums over terms that both sources have, less what `_lacking` counts for these terms.

    One chunk of one pair of tiles: rows (left, word, id, p, p0, bits), left for the first tile.
    """
    table = table.sort_by([("word", "ascending"), ("id", "ascending")])
    col = {c: table[c].to_numpy() for c in ("left", "right", "word", "id", "p", "p0", "bits")}
    bits = col["bits"].view(np.uint64)
    first, second = (np.unique(col["id"][col[side]]) for side in ("left", "right"))
    sums = np.zeros((len(first), len(second)), np.int64)
    edges = np.flatnonzero(np.diff(col["word"], prepend=-1))
    for start, end in zip(edges, [*edges[1:], len(bits)], strict=True):
        rows = np.arange(start, end)
        left, right = rows[col["left"][start:end]], rows[col["right"][start:end]]
        if not len(left) or not len(right):
            continue
        place = np.searchsorted(second, col["id"][right])
        own = np.flatnonzero(np.diff(col["id"][left], prepend=-1))
        for lo, hi in zip(own, [*own[1:], len(left)], strict=True):  # the levels of one source
            cells = np.bitwise_count(bits[left[lo:hi], None] & bits[None, right])
            i, j = np.nonzero(cells)
            a, b = left[lo:hi][i], right[j]
            p, q, p0, q0 = col["p"][a], col["p"][b], col["p0"][a], col["p0"][b]
            f = _div(p, q) - _div(p, q0) - _div(p0, q) + _div(p0, q0)
            np.add.at(sums[np.searchsorted(first, col["id"][left[lo]])], place[j], cells[i, j] * f)
    i, j = np.nonzero((first[:, None] < second[None, :]) & (sums != 0))
    lang = table["lang"][0].as_py()
    return pa.table(
        {
            "lang": pa.array([lang] * len(i), pa.string()), "a": pa.array(first[i], pa.int32()),
            "b": pa.array(second[j], pa.int32()), "value": sums[i, j],
        }
    )


def _lacking(table: pa.Table) -> pa.Table:
    """For each pair of sources of a pair of tiles the sum over all terms as if no term were in both.

    Rows (id, p, p0, size): a source's levels with their sizes, level 0 (all other terms) with p = p0.
    """
    table = table.sort_by([("id", "ascending")])
    ids, p, p0, sizes = (table[c].to_numpy() for c in ("id", "p", "p0", "size"))
    sides = []
    for side in ("left", "right"):
        own, starts, counts = np.unique(ids[rows := np.flatnonzero(table[side].to_numpy())], return_index=True, return_counts=True)
        sides.append((own, [rows[s : s + n] for s, n in zip(starts, counts, strict=True)]))
    (first, left), (second, right) = sides
    zero = {i: p0[rows[0]] for own, parts in sides for i, rows in zip(own, parts, strict=True)}
    terms = {i: sizes[rows].sum() for own, parts in sides for i, rows in zip(own, parts, strict=True)}

    def alone(parts, other) -> np.ndarray:
        """Per source and other source: over the source's levels, f against the other's level 0, less f of both zeros."""
        q0 = np.array([zero[i] for i in other], np.int64)
        out = np.zeros((len(parts), len(other)), np.int64)
        for place, rows in enumerate(parts):
            for some in np.array_split(rows, -(-len(rows) // 4096)):
                f = _div(p[some, None], q0[None, :]) - _div(p0[some, None], q0[None, :])
                out[place] += (sizes[some, None] * f).sum(0)
        return out

    both = _div(np.array([zero[i] for i in first])[:, None], np.array([zero[i] for i in second])[None, :])
    sums = alone(left, second) + alone(right, first).T + both * np.array([terms[i] for i in first])[:, None]
    i, j = np.nonzero(first[:, None] < second[None, :])
    return pa.table(
        {
            "lang": pa.array([table["lang"][0].as_py()] * len(i), pa.string()), "a": pa.array(first[i], pa.int32()),
            "b": pa.array(second[j], pa.int32()), "value": sums[i, j],
        }
    )


def _tiled(rows: DataFrame, tile: int) -> DataFrame:
    """Each row once for every pair of tiles (x <= y) of its language that its source's tile is in."""
    own, last = F.floor(F.col("id") / tile).cast("int"), F.floor((F.col("sources") - 1) / tile).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return rows.select(
        "*", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        (F.col("own") <= F.col("other")).alias("left"), (F.col("own") >= F.col("other")).alias("right"),
    ).drop("own", "other", "sources")


def levels(counts: DataFrame) -> DataFrame:
    """Rows (lang, band, chunk, word, source, n, bits): the terms of a word that a source has n times, as a bitmap."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    return counts.groupBy("lang", "band", "chunk", "word", "source", "n").agg(F.bit_or(bit).alias("bits"))


def audit(docs: DataFrame, least_docs: int = 10, top: int = 10, chunk: int = CHUNK, tile: int = TILE) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of every group (lang, source) of `docs`.

    Part `pair`: every other source of the language with its divergence over all kept terms.  Part `term`:
    the `top` terms that a group has more of than its language.  Ranks go from 1 per group and part by value,
    largest first, then by item in the order of its UTF-8 bytes.

    Null text, lang and source count as empty; repeated rows each count as a document.  A group without kept
    terms has its pairs all the same; a language without kept terms has pairs of value 0.  No rows: no rows.
    Doc ids and other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    every = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    counted = settle(term_counts(docs), "terms")
    kept = (
        counted.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("d").alias("docs"))
        .where(F.col("docs") >= least_docs).drop("docs")
    )
    placed = settle(_placed(kept, chunk), "placed")
    counts = settle(counted.drop("d").join(placed, ["lang", "term"]), "kept")

    totals = placed.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("terms"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_name = Window.partitionBy("lang").orderBy("source")  # a row a source
    none = F.lit(0).cast("long")
    groups = every.join(sums, ["lang", "source"], "left").join(totals, "lang", "left")
    terms = F.coalesce("terms", none)
    groups = settle(
        groups.select(
            "lang", "source", (F.row_number().over(by_name) - 1).alias("id"),
            F.count("*").over(Window.partitionBy("lang")).alias("sources"), terms.alias("terms"),
            (F.coalesce("total", none) + 2 * terms).alias("total"),
            (F.coalesce("lang_total", none) + 2 * terms).alias("lang_total"),
        ).withColumn("p0", share(none, F.col("total"))),
        "groups",
    )

    known = settle(levels(counts), "levels").join(groups, ["lang", "source"])
    known = known.withColumn("p", share(F.col("n"), F.col("total")))
    joint = (
        _tiled(known.select("lang", "band", "chunk", "word", "id", "sources", "p", "p0", "bits"), tile)
        .groupBy("lang", "band", "chunk", "x", "y").applyInArrow(_joint, PARTS)
    )
    sizes = known.groupBy("lang", "source", "n").agg(F.sum(F.bit_count("bits")).cast("long").alias("size"))
    sizes = sizes.unionByName(
        # what no level holds: all terms less those that the source has
        groups.join(sizes.groupBy("lang", "source").agg(F.sum("size").alias("had")), ["lang", "source"], "left")
        .select("lang", "source", none.alias("n"), (F.col("terms") - F.coalesce("had", none)).alias("size"))
    ).join(groups, ["lang", "source"])
    sizes = sizes.select("lang", "id", "sources", share(F.col("n"), F.col("total")).alias("p"), "p0", "size")
    lacking = _tiled(sizes, tile).groupBy("lang", "x", "y").applyInArrow(_lacking, PARTS)

    pairs = joint.unionByName(lacking).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("to")), F.struct(F.col("b").alias("id"), F.col("a").alias("to"))))
    names = groups.select("lang", "id", "source")
    pairs = (
        pairs.select("lang", sides.alias("side"), "value").select("lang", "side.id", "side.to", "value")
        .join(names, ["lang", "id"])
        .join(names.select("lang", F.col("id").alias("to"), F.col("source").alias("item")), ["lang", "to"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    )
    of_group = counts.join(groups.select("lang", "source", "total", "lang_total"), ["lang", "source"])
    p, q = share(F.col("n"), F.col("total")), share(F.col("lang_n"), F.col("lang_total"))
    more = (
        of_group.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), "item", divergence(F.col("p"), F.col("q")).alias("value"))
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(ranked).alias("rank")
    best = more.select("*", rank).where(F.col("rank") <= top)
    return pairs.select("*", rank).unionByName(best)
