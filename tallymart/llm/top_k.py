"""Exact top-k inner products by aggregation of sorted lists without random access.

Candidates are dealt into blocks.  A block keeps one sorted list a component; a query reads each
list from the end that its own component favours.  After each round of reading, what was not yet
read of a candidate lies between the list's far end and its frontier, which bounds every score from
below and above.  A candidate whose upper bound is under the k-th lower bound can no longer qualify;
reading stops when few enough are left, and their scores are resolved.  The blocks' results merge
to the query's k highest.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.shared import ship

BLOCK = 1 << 14  # candidates of a block
QUERIES = 1 << 11  # queries that meet a block at once
CHUNK = 128  # of them, whose bounds are held at once
DEPTHS = (0.25, 0.5, 0.75)  # shares of the lists read before bounds are looked at
FEW = 4  # times k: candidates left at which reading stops


def _kind(queries: np.ndarray, rows: np.ndarray) -> np.dtype:
    """The narrowest kind of number that holds every score, and every sum on the way to it, exactly."""
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if largest < 2**24:
        return np.dtype(np.float32)
    if largest < 2**53:
        return np.dtype(np.float64)
    if largest < 2**63:
        return np.dtype(np.int64)
    return np.dtype(object)  # Python's integers have no bound


def _long(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers; one beyond them as the nearest."""
    if scores.dtype != object:
        return scores.astype(np.int64)
    ends = np.iinfo(np.int64)
    return np.array([min(max(int(s), ends.min), ends.max) for s in scores], np.int64)


class SortedLists:
    """One list a component over a block's rows."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        order = np.argsort(-rows, axis=0, kind="stable")
        self.sorted = np.take_along_axis(rows, order, axis=0)
        self.rank = np.empty_like(order)
        np.put_along_axis(self.rank, order, np.arange(len(rows))[:, None], axis=0)

    def read(self, depth: int) -> tuple[np.ndarray, ...]:
        """What is known after `depth` rows of each list: (upper, lower) from the top and from the bottom."""
        n = len(self.rows)
        top, bottom = self.rank < depth, self.rank >= n - depth
        return (
            np.where(top, self.rows, self.sorted[depth]),
            np.where(top, self.rows, self.sorted[-1]),
            np.where(bottom, self.rows, self.sorted[n - 1 - depth]),
            np.where(bottom, self.rows, self.sorted[0]),
        )


def block_top_k(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> list[np.ndarray]:
    """For each query the places of its k highest rows: by score, then by id; rows of its own id are left out."""
    kind = _kind(queries, rows)
    queries, rows = queries.astype(kind), rows.astype(kind)
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    n = len(rows)
    depths = sorted({int(n * d) for d in DEPTHS} - {0}) if n > FEW * k else []
    lists = SortedLists(rows) if depths else None
    known = [(d, lists.read(d)) for d in depths]
    out: list[np.ndarray] = []
    for i in range(0, len(queries), CHUNK):
        part, names = queries[i : i + CHUNK], own[i : i + CHUNK]
        up, down = np.maximum(part, 0), np.minimum(part, 0)
        left: list[np.ndarray | None] = [None] * len(part)
        open_ = np.arange(len(part))
        for _, (top_high, top_low, bottom_low, bottom_high) in known:
            if not len(open_):
                break
            upper = up[open_] @ top_high.T + down[open_] @ bottom_low.T
            lower = up[open_] @ top_low.T + down[open_] @ bottom_high.T
            # a row of the query's own id may hold one of the k places: one more is kept for each
            spare = (ids[None, :] == names[open_, None]).sum(axis=1)
            still = []
            for at, q in enumerate(open_):
                reach = min(n, k + int(spare[at]))
                least = np.partition(lower[at], n - reach)[n - reach]
                alive = np.flatnonzero(upper[at] >= least)
                if len(alive) <= FEW * k:
                    left[q] = alive
                else:
                    still.append(q)
            open_ = np.array(still, np.int64)
        scores = dict(zip(open_.tolist(), part[open_] @ rows.T, strict=True)) if len(open_) else {}
        for q in range(len(part)):
            alive = left[q]
            if alive is None:
                value = scores[q]
                reach = min(n, k + int((ids == names[q]).sum()))
                alive = np.flatnonzero(value >= np.partition(value, n - reach)[n - reach])
                value = value[alive]
            else:
                value = rows[alive] @ part[q]
            mine = ids[alive] != names[q]
            alive, value = alive[mine], value[mine]
            best = np.lexsort((ids[alive], -value))[:k]
            out.append(np.stack([order[alive[best]], _long(value[best])]))
    return out


def integers(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """Rows (vec_id, ints): floor(scale * x) of each component; unusable vectors and rows without id are left out."""
    usable = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return vectors.where(usable & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), ints.alias("ints")
    )


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, block: int = BLOCK) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k best of all other rows for each row whose id `every` divides.

    Ties go to the smaller vec_id.  Vectors of another length than the query's take no part for it.
    A row that repeats is a candidate each time; queries that share an id and differ are ranked each.
    Rows with the query's id count as its own.  An empty table has no rows.
    A component or a score that a 64-bit integer cannot hold becomes the nearest that it can; a block compares
    such scores exactly, the merge of blocks sees them as ties.
    """
    rows = integers(vectors, scale).withColumn("dim", F.size("ints"))
    asked = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "ints"])
    blocks = max(1, -(-rows.count() // block))
    turns = max(1, -(-asked.count() // QUERIES))
    part = F.pmod(F.xxhash64("vec_id", "ints"), F.lit(blocks)).cast("int")
    turn = F.pmod(F.xxhash64("vec_id", "ints", F.lit(1)), F.lit(turns)).cast("int")
    candidates = rows.withColumn("block", part).withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    queries = asked.withColumn("turn", turn).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "query": [], "vec_id": [], "score": []})
        asked, held = np.stack(left["ints"]), np.stack(right["ints"])
        names, ids = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        found = block_top_k(asked, names, held, ids, k)
        sizes = [f.shape[1] for f in found]
        places, scores = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return pd.DataFrame({
            "query_id": np.repeat(names, sizes),
            "query": np.repeat(left["query"].to_numpy(), sizes),
            "vec_id": ids[places],
            "score": scores,
        })

    ship(vectors.sparkSession)
    keys = ("dim", "block", "turn")
    met = (
        queries.withColumn("query", F.xxhash64("ints")).groupBy(*keys)
        .cogroup(candidates.groupBy(*keys))
        .applyInPandas(meet, "query_id long, query long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
