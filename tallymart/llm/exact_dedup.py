"""Exact duplicates through an extendible-hash index kept in the shared folder.

The index has one entry per distinct text: its 64-bit hash, its SHA-256, the row that stays and
the number of rows.  The directory starts at depth zero and doubles: a bucket with more than
`capacity` entries splits on the next bit of the hash, down to `max_depth`; what does not fit
there (equal hashes) stays as a chain.  Buckets are dealt to owner tasks as ranges of keys of
about equal size.  Entries come from comparing whole texts, so texts with equal hashes stay apart.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.shared import free_name, settle, whole_text

CAPACITY = 1 << 16  # entries of a bucket
MAX_DEPTH = 16  # the directory has at most 2**16 rows, so it may be broadcast
OWNED = 1 << 16  # entries of an owner task


def _hash(text: Column) -> Column:
    return F.xxhash64(text)


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


@dataclass(frozen=True)
class Index:
    """`directory`: cell, bucket, owner.  `entries`: bucket, hash, digest, chain, keep_id, group_size.

    `collided` is true if different texts share hash and digest; lookups then compare texts again.
    """

    directory: DataFrame
    entries: DataFrame
    collided: bool
    max_depth: int
    hash_of: Callable[[Column], Column]
    digest_of: Callable[[Column], Column]
    groups: DataFrame


def _cell(hash_column: str, max_depth: int) -> Column:
    """The top `max_depth` bits of a hash."""
    return F.shiftrightunsigned(F.col(hash_column), 64 - max_depth).cast("int")


def directory(entries: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH, owned: int = OWNED) -> DataFrame:
    """Rows (cell, bucket, depth, owner) of the doubled directory, one per used cell of `max_depth` bits.

    A bucket is named by its first cell; its depth is the first at which it fits `capacity`.
    """
    cells = entries.groupBy(_cell("hash", max_depth).alias("cell")).agg(F.count("*").alias("n"))
    levels = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth")).withColumn(
        "prefix", F.expr(f"shiftright(cell, {max_depth} - depth)")
    )
    load = F.sum("n").over(Window.partitionBy("depth", "prefix"))
    fits = (load <= capacity) | (F.col("depth") == max_depth)
    cells = (
        levels.withColumn("fits", fits).where("fits").groupBy("cell").agg(F.min("depth").alias("depth"), F.first("n").alias("n"))
        .withColumn("bucket", F.expr(f"shiftleft(shiftright(cell, {max_depth} - depth), {max_depth} - depth)"))
    )
    before = F.sum("n").over(Window.orderBy("bucket").rangeBetween(Window.unboundedPreceding, -1))
    return cells.select(
        "cell", "bucket", "depth", F.floor(F.coalesce(before, F.lit(0)) / owned).cast("int").alias("owner")
    )


def build_index(
    docs: DataFrame,
    capacity: int = CAPACITY,
    max_depth: int = MAX_DEPTH,
    hash_of: Callable[[Column], Column] = _hash,
    digest_of: Callable[[Column], Column] = _digest,
) -> Index:
    """The index of all rows of `docs` (doc_id, text).

    Copies are combined before they are shuffled, so a text that a third of all rows hold costs
    one entry a task.  Null texts count as empty.  A null doc_id never stays beside another.
    """
    text = whole_text()
    groups = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .groupBy(hash_of(F.col("text")).alias("hash"), "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    found = settle(
        groups.select("hash", digest_of(F.col("text")).alias("digest"), "keep_id", "group_size"), "texts"
    )
    plan = settle(directory(found, capacity, max_depth).coalesce(1), "directory")
    dealt = found.join(F.broadcast(plan), _cell("hash", max_depth) == F.col("cell"))
    chain = F.row_number().over(Window.partitionBy("owner", "bucket", "hash").orderBy("digest", "keep_id"))
    entries = settle(
        dealt.repartition("owner")
        .select("owner", "bucket", "hash", "digest", chain.cast("int").alias("chain"), "keep_id", "group_size")
        .sortWithinPartitions("owner", "bucket", "hash", "chain"),
        "index",
    )
    chained = entries.where("chain > 1").select("hash").distinct()
    same = entries.join(chained, "hash").groupBy("hash", "digest").count().where("count > 1")
    return Index(plan, entries, not same.isEmpty(), max_depth, hash_of, digest_of, groups)


def lookup(docs: DataFrame, index: Index) -> DataFrame:
    """`docs` with keep_id, group_size, kept and text_sha256 of each row (the class columns replace clashing ones).

    Rows that repeat a doc_id and a text cannot be told apart and share their `kept`.
    """
    names = ("keep_id", "group_size", "kept", "text_sha256")
    docs = docs.drop(*names)
    hash_name, digest_name = free_name(docs, "text_hash"), free_name(docs, "text_digest")
    own = docs.withColumns({
        hash_name: index.hash_of(whole_text()),
        digest_name: index.digest_of(whole_text()),
        "text_sha256": F.sha2(whole_text(), 256),
    })
    if index.collided:
        entries = index.groups.select("hash", F.col("text").alias("entry_text"), "keep_id", "group_size")
        match = (F.col(hash_name) == entries["hash"]) & (whole_text() == entries["entry_text"])
    else:
        entries = index.entries.select("hash", "digest", "keep_id", "group_size")
        match = (F.col(hash_name) == entries["hash"]) & (F.col(digest_name) == entries["digest"])
    kept = F.col("doc_id").cast("long").eqNullSafe(entries["keep_id"])
    return own.join(entries, match).select(
        *docs.columns, entries["keep_id"], entries["group_size"], kept.alias("kept"), "text_sha256"
    )


def classes(docs: DataFrame, **options) -> DataFrame:
    """Rows (doc_id, keep_id, group_size, kept, text_sha256), one per row of `docs`; an empty table gives none."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return lookup(docs, build_index(docs, **options)).drop("text")


def keepers(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that stay, with their columns: of equal texts the one with the largest doc_id.

    Of rows that repeat doc_id and text one stays, whichever; null doc_ids stay only alone.
    """
    index = build_index(docs, **options)
    own = {c: free_name(docs, f"row_{c}") for c in ("id", "hash", "digest")}
    rows = docs.withColumns({
        own["id"]: F.col("doc_id").cast("long"),
        own["hash"]: index.hash_of(whole_text()),
        own["digest"]: index.digest_of(whole_text()),
    })
    if index.collided:
        groups = index.groups.select("hash", F.col("text").alias("digest"), "keep_id")
        rows = rows.withColumn(own["digest"], whole_text())
    else:
        groups = index.entries.select("hash", "digest", "keep_id")
    same = (rows[own["hash"]] == groups["hash"]) & (rows[own["digest"]] == groups["digest"])
    known = rows.join(groups, same & (rows[own["id"]] == groups["keep_id"]), "left_semi")
    unknown = rows.where(F.col(own["id"]).isNull()).join(groups.where("keep_id is null"), same, "left_semi")
    return (
        known.dropDuplicates([own["hash"], own["digest"], own["id"]])
        .unionByName(unknown.dropDuplicates([own["hash"], own["digest"]]))
        .select(*docs.columns)
    )
