"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in a hashed order, are cut into blocks of equal volume.  With weight ``w``, an
exact share of all blocks, block ``j = 0, 1, ...`` is released at slot ``floor(j / w)`` and due before slot
``ceil((j + 1) / w)``; each slot takes the released block with the earliest deadline.  Then every source is
less than one block off its target at any slot.  When a source ends, a new phase begins: the others
share its slots in proportion, and their windows count from there.

The schedule is made of the sources' numbers of blocks alone, by one task that streams it out; it holds a
few numbers a source.  Blocks grow with the input, so that there are at most some millions of them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from math import lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.shared import free_name, map_batches, settle, whole_text

BLOCK_CHARS = 1 << 16  # least volume of a block
BLOCKS = 1 << 22  # blocks of a mix, about; beyond it blocks grow, not their number
CELL_ROWS = 1024  # rows of a cell, about: the unit that one window orders
OUT = ("block", "release", "deadline", "slot", "at")
BATCH = 50_000  # rows of the schedule passed on at once


def exact(weights: list[float]) -> list[int]:
    """Whole numbers in exactly the proportions of the weights, which must be finite and above 0."""
    shares = [Fraction(w) for w in weights]
    if any(w <= 0 for w in shares):
        raise ValueError("weights must be above 0")
    whole = lcm(*(w.denominator for w in shares))
    return [int(w * whole) for w in shares]


def window(j: int, weight: int, total: int) -> tuple[int, int]:
    """Release and deadline of block `j` (from 0) of a source with `weight` of `total`."""
    return j * total // weight, -(-(j + 1) * total // weight)


def schedule(blocks: list[int], weights: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """(source, block, release, deadline, slot) in the order of slots, sources by their place in the lists.

    Each block has one slot; of blocks with one deadline that of the first source comes first.
    """
    left, start, base = {s: n for s, n in enumerate(blocks) if n}, [0] * len(blocks), 0
    while left:
        total = sum(weights[s] for s in left)
        waiting = [(0, s, 0) for s in left]  # release, source, block of the phase
        ready: list[tuple[int, int, int, int]] = []
        slot, ended = 0, None
        while ended is None:
            while waiting and waiting[0][0] <= slot:
                release, s, j = heapq.heappop(waiting)
                heapq.heappush(ready, (window(j, weights[s], total)[1], s, j, release))
            due, s, j, release = heapq.heappop(ready)  # some block is released and left: shares add up to 1
            yield s, start[s] + j, base + release, base + due, base + slot
            slot += 1
            if j + 1 == left[s]:
                ended = s
            else:
                heapq.heappush(waiting, (window(j + 1, weights[s], total)[0], s, j + 1))
        # the next block of each other source waits, or was released and is ready
        following = {s: j for _, s, j in waiting} | {s: j for _, s, j, _ in ready}
        left = {s: left[s] - j for s, j in following.items() if left[s] > j}
        for s, j in following.items():
            start[s] += j
        base += slot


def _plan(totals: DataFrame, weights: dict | None, temperature: float) -> DataFrame:
    """Rows (source, block, release, deadline, slot) of the sources (source, blocks); one task, a row a source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        if not known:
            return
        known.sort(key=lambda r: (r[0] is not None, r[0]))
        if weights is None:
            targets = [float(n) ** temperature for _, n in known]
        else:
            targets = [weights.get(s, min(weights.values())) for s, _ in known]
        rows: list[tuple] = []

        def packed() -> pa.RecordBatch:
            s, *numbers = zip(*rows, strict=True)
            names = pa.array([known[i][0] for i in s], batch_type)
            return pa.RecordBatch.from_arrays([names, *(pa.array(n, pa.int64()) for n in numbers)], ["source", *OUT[:4]])

        for row in schedule([n for _, n in known], exact(targets)):
            rows.append(row)
            if len(rows) >= BATCH:
                yield packed()
                rows.clear()
        if rows:
            yield packed()

    kind = dict(totals.dtypes)["source"]
    batch_type = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[kind]
    return map_batches(totals.coalesce(1), run, f"source {kind}, block long, release long, deadline long, slot long")


def _bits(cells: int) -> int:
    return max(1, (cells - 1).bit_length())


def _ahead(sums: DataFrame, bits: int) -> DataFrame:
    """Rows (source, cell, before): volume of the source's cells ahead, in two levels, so that no window holds all cells."""
    coarse = F.shiftright("cell", bits // 2)
    sums = sums.withColumn("part", coarse)
    within = Window.partitionBy("source", "part").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sums.groupBy("source", "part").agg(F.sum("n").alias("n"))
    parts = parts.select(F.col("source").alias("of"), F.col("part").alias("there"), F.sum("n").over(over).alias("ahead"))
    near = sums.withColumn("near", F.sum("n").over(within))
    none = F.lit(0).cast("long")
    return near.join(parts, near["source"].eqNullSafe(parts["of"]) & (near["part"] == parts["there"])).select(
        "source", "cell", (F.coalesce("near", none) + F.coalesce("ahead", none)).alias("before")
    )


def mix(
    docs: DataFrame,
    weights: dict | None = None,
    temperature: float = 0.5,
    block_chars: int = BLOCK_CHARS,
    blocks: int = BLOCKS,
) -> DataFrame:
    """`docs` with columns block, release, deadline, slot, at (clashing ones are replaced); every row stays.

    `weights` names the target of each source (others weigh as much as the least), taken exactly; without
    them a source weighs its number of blocks to the power `temperature`.  Volume is the number of
    characters, at least one a row; a document belongs to the block in which it begins, `at` is the
    volume of its source before it.  A block has `block_chars`, or more where that would make more than about
    `blocks` of them.  A null source is a source of its own, a null text is empty, repeated rows are rows
    like any other; no rows: no rows.  Sorted by (slot, at) the rows are the mix.
    """
    docs = docs.drop(*OUT)
    own = {c: free_name(docs, f"mix_{c}") for c in ("size", "place", "cell", "there", "before", "key")}
    bits = _bits(max(1, -(-docs.count() // CELL_ROWS)))
    size = F.greatest(F.length(whole_text()), F.lit(1)).cast("long")
    place = F.xxhash64("doc_id", whole_text())
    cell: Column = F.shiftrightunsigned(place, 64 - bits)

    sums = settle(docs.groupBy("source", cell.alias("cell")).agg(F.sum(size).alias("n")), "volumes")
    volume = sums.agg(F.sum("n")).first()[0] or 0
    block_size = max(block_chars, -(-volume // blocks))
    totals = sums.groupBy("source").agg(F.sum("n").alias("n")).selectExpr("source", f"(n + {block_size - 1}) div {block_size} AS blocks")
    plan = settle(_plan(totals, weights, temperature), "schedule").withColumnRenamed("source", own["key"])
    offsets = _ahead(sums, bits).withColumnsRenamed({"source": own["key"], "cell": own["there"], "before": own["before"]})

    rows = docs.withColumns({own["size"]: size, own["place"]: place}).withColumn(
        own["cell"], F.shiftrightunsigned(F.col(own["place"]), 64 - bits)
    )
    within = (
        Window.partitionBy("source", own["cell"]).orderBy(own["place"], "doc_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.withColumn("at", F.coalesce(F.sum(own["size"]).over(within), F.lit(0)))
    joined = placed.join(
        offsets, placed["source"].eqNullSafe(offsets[own["key"]]) & (placed[own["cell"]] == offsets[own["there"]])
    ).select(*docs.columns, (F.col("at") + F.col(own["before"])).alias("at"))
    found = joined.withColumn(own["there"], F.expr(f"at div {block_size}"))
    known = found.join(plan, found["source"].eqNullSafe(plan[own["key"]]) & (found[own["there"]] == plan["block"]))
    return known.select(*docs.columns, *OUT)


def placed(docs: DataFrame, **options) -> DataFrame:
    """The rows and columns of `docs` with slot and at of `mix`, written in that order from the first file to the last."""
    mixed = mix(docs, **options).drop("block", "release", "deadline")
    return mixed.repartitionByRange("slot", "at").sortWithinPartitions("slot", "at")


def interleaved(docs: DataFrame, **options) -> DataFrame:
    """The rows and columns of `docs` in the order of the mix, from the first written file to the last."""
    names = {c: free_name(docs, f"own_{c}") for c in docs.columns if c.lower() in ("block", "release", "deadline", "slot", "at")}
    mixed = mix(docs.withColumnsRenamed(names), **options)
    back = {v: k for k, v in names.items()}
    ordered = mixed.repartitionByRange("slot", "at").sortWithinPartitions("slot", "at")
    return ordered.select(*(names.get(c, c) for c in docs.columns)).withColumnsRenamed(back)
