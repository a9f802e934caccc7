"""Releases of a set of tables: written aside, published by one manifest, read as they were published.

A table is a list of parts, each a folder that is written once and never changed; the parts of a
monthly table hold a folder per month.  A release names the parts, and the months of each, that make up
every table.  It becomes the current one when its manifest takes the next free number, which happens
at once or not at all: a load that stops half-way, or loses a race, leaves the former release as it was,
and a reader keeps the release that it opened.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MONTH = "layout_month"
#: Rows without a month of their own.
NO_MONTH = date(1000, 1, 1)
PART = "layout_part"
WRITERS = 6  # tables written at a time, of those that are not monthly
CODEC = "zstd"  # keys of lines and bitmaps of few ids take half the room that they take in the default codec
#: Shuffle files of a write go when it ends, not when the driver next collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


Rows = DataFrame | Sequence[DataFrame]


class ReleaseConflict(RuntimeError):
    """Another writer published first."""


@dataclass(frozen=True)
class Release:
    """What a manifest says: per table its parts with their months (None: not by month), per date column of a
    monthly table the first and last day in each (part, month), and notes of the writer."""

    number: int
    tables: dict[str, dict[str, list[str] | None]]
    bounds: dict[str, dict[str, dict[str, dict[str, list[str] | None]]]] = field(default_factory=dict)
    notes: dict[str, object] = field(default_factory=dict)

    def months(self, *tables: str) -> set[str]:
        return {m for t in tables or self.tables for months in self.tables[t].values() for m in months or ()}


class ReleaseStore:
    """Tables with the given schemas under ``path``, which may be on any file system that Spark can write.

    ``monthly`` tables are written with a column ``layout_month``; ``dated`` names the date columns of
    these whose bounds the manifest keeps, so that a read between two days opens only folders that can hold some.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schemas: Mapping[str, StructType],
        monthly: Iterable[str] = (),
        dated: Mapping[str, Iterable[str]] | None = None,
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self.schemas, self.monthly = dict(schemas), frozenset(monthly)
        self.dated = {t: tuple(c) for t, c in (dated or {}).items()}

    # -- files ---------------------------------------------------------------

    def _hadoop(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _names(self, path: str) -> list[str]:
        """Names in a folder; none if there is no such folder."""
        fs, where = self._hadoop(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def _manifest(self, number: int) -> str:
        return f"{self.path}/releases/{number:08d}.json"

    def _part(self, table: str, part: str) -> str:
        return f"{self.path}/data/{table}/{PART}={part}"

    # -- releases ------------------------------------------------------------

    def numbers(self) -> list[int]:
        """Numbers of the published releases that were not removed, in order."""
        return [int(n.removesuffix(".json")) for n in self._names(f"{self.path}/releases") if n[0].isdigit()]

    def release(self, number: int | None = None) -> Release | None:
        """A release, by default the current one; None if nothing was published."""
        numbers = self.numbers()
        if number is None:
            if not numbers:
                return None
            number = numbers[-1]
        if number not in numbers:
            raise LookupError(f"there is no release {number}")
        text = self.spark.read.option("wholetext", True).text(self._manifest(number)).first()[0]
        return Release(**json.loads(text))

    def _publish(self, release: Release) -> Release:
        """Gives the release its number; the manifest is written aside and renamed, which fails if the number is taken."""
        jvm = self.spark._jvm
        aside = f"{self.path}/releases/_{uuid.uuid4().hex}"
        fs, where = self._hadoop(aside)
        out = fs.create(where, False)
        out.write(bytearray(json.dumps(release.__dict__, sort_keys=True).encode()))
        out.close()
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        modes = self.spark.sparkContext._gateway.new_array(rename, 1)
        modes[0] = rename.NONE
        target = jvm.org.apache.hadoop.fs.Path(self._manifest(release.number))
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            files.rename(fs.makeQualified(where), fs.makeQualified(target), modes)
        except Exception as error:  # the bridge wraps the file system's own error
            fs.delete(where, False)
            if release.number in self.numbers():
                raise ReleaseConflict(f"release {release.number} was published by another writer") from error
            raise
        return release

    # -- writing -------------------------------------------------------------

    @contextmanager
    def _tidy(self):
        """Shuffle files of queries that end meanwhile are removed."""
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            yield
        finally:
            self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)

    def _write(self, table: str, df: DataFrame) -> tuple[str, list[str] | None, dict]:
        """A new part with the rows of ``df``: its name, months, and bounds per month."""
        part = uuid.uuid4().hex
        folder = self._part(table, part)
        columns = self.schemas[table].fieldNames()
        if table not in self.monthly:
            df.select(*columns).write.parquet(folder, compression=CODEC)
            return part, None, {}
        month = F.coalesce(F.col(MONTH), F.lit(NO_MONTH)).alias(MONTH)
        # files of about the advised size, whatever the size of a month
        df.select(*columns, month).hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(folder, compression=CODEC)
        months = [n.split("=", 1)[1] for n in self._names(folder) if n.startswith(f"{MONTH}=")]
        return part, months, self._bounds(table, part, months)

    def _bounds(self, table: str, part: str, months: list[str]) -> dict:
        """First and last day of the dated columns per month, None where there is no day; one row a month."""
        columns = self.dated.get(table, ())
        if not columns or not months:
            return {}
        ends = [f(c).cast("string").alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
        rows = self._read(table, {part: months}).groupBy(F.col(MONTH).cast("string").alias(MONTH)).agg(*ends).collect()
        return {r[MONTH]: {c: [r[f"min_{c}"], r[f"max_{c}"]] if r[f"min_{c}"] else None for c in columns} for r in rows}

    def sizes(self, release: Release, *tables: str) -> dict[str, int]:
        """Bytes per month of monthly tables."""
        found: dict[str, int] = {}
        for t in tables:
            for p, own in release.tables[t].items():
                for m in own or ():
                    fs, where = self._hadoop(f"{self._part(t, p)}/{MONTH}={m}")
                    found[m] = found.get(m, 0) + fs.getContentSummary(where).getLength()
        return found

    def publish(self, tables: Mapping[str, Rows], notes: Mapping | None = None) -> Release:
        """A release of exactly these rows; takes the place of all that was there.

        Rows of a table may come as several DataFrames, which are written one after the other, each as a part.
        """
        return self._next({}, {}, tables, notes)

    def append(self, tables: Mapping[str, Rows], notes: Mapping | None = None) -> Release:
        """The current release with rows added to some tables."""
        now = self._current()
        return self._next(now.tables, now.bounds, tables, notes, now.number)

    def replace_months(
        self, tables: Mapping[str, Rows], months: Iterable[str], notes: Mapping | None = None
    ) -> Release:
        """The current release with the given months of some monthly tables written anew; other months stay as they are."""
        now, gone = self._current(), set(months)
        kept = {
            t: {p: left for p, own in parts.items() if (left := [m for m in own if m not in gone])} if t in tables else parts
            for t, parts in now.tables.items()
        }
        return self._next(kept, now.bounds, tables, notes, now.number)

    def _current(self) -> Release:
        now = self.release()
        if now is None:
            raise LookupError("nothing was published yet")
        return now

    def _next(
        self, kept: Mapping, bounds: Mapping, tables: Mapping[str, Rows], notes: Mapping | None, after: int | None = None
    ) -> Release:
        unknown = set(tables) - set(self.schemas)
        if unknown:
            raise ValueError(f"no such tables: {', '.join(sorted(unknown))}")
        after = max(self.numbers(), default=0) if after is None else after
        found = {t: dict(kept.get(t, {})) for t in self.schemas}
        ends = {t: {p: dict(own) for p, own in bounds.get(t, {}).items()} for t in self.dated}
        # small tables do not wait for each other; of the monthly ones only one at a time has its shuffle files on disk
        with self._tidy(), ThreadPoolExecutor(WRITERS) as pool, ThreadPoolExecutor(1) as one:
            each = [(t, df) for t, rows in tables.items() for df in ([rows] if isinstance(rows, DataFrame) else rows)]
            jobs = [(one if t in self.monthly else pool).submit(self._write, t, df) for t, df in each]
            written = [(t, *job.result()) for (t, _), job in zip(each, jobs, strict=True)]
        for table, part, months, days in written:
            if months is None or months:
                found[table][part] = months
            if days:
                ends[table][part] = days
        return self._publish(Release(after + 1, found, ends, dict(notes or {})))

    # -- reading -------------------------------------------------------------

    def _read(self, table: str, parts: Mapping[str, list[str] | None]) -> DataFrame:
        declared = self.schemas[table]
        if table in self.monthly:
            declared = StructType([*declared.fields]).add(MONTH, "date")
        paths = [
            f"{self._part(table, p)}/{MONTH}={m}" if months is not None else self._part(table, p)
            for p, months in parts.items() for m in (months if months is not None else [None])
        ]
        if not paths:
            return self.spark.createDataFrame([], declared)
        read = self.spark.read.schema(declared).option("basePath", f"{self.path}/data/{table}")
        return read.parquet(*paths).select(*declared.fieldNames())

    def read(
        self,
        table: str,
        release: Release | None = None,
        months: Iterable[str] | None = None,
        column: str | None = None,
        since: date | None = None,
        until: date | None = None,
    ) -> DataFrame:
        """A table of a release (the current one); a monthly one with its ``layout_month``, of some months if they are given.

        With ``column`` only folders are opened whose days can lie between ``since`` and ``until``; rows
        without a day may be left out, the other rows are not filtered.
        """
        release = release or self._current()
        parts = release.tables[table]
        if months is not None:
            wanted = set(months)
            parts = {p: [m for m in own if m in wanted] for p, own in parts.items()}
        if column is not None and table in self.dated:
            parts = {p: [m for m in own if self._may_hold(release, table, p, m, column, since, until)] for p, own in parts.items()}
        return self._read(table, parts)

    @staticmethod
    def _may_hold(release: Release, table: str, part: str, month: str, column: str, since, until) -> bool:
        known = release.bounds.get(table, {}).get(part, {}).get(month, {})
        if known.get(column) is None:
            return column not in known
        first, last = (date.fromisoformat(d) for d in known[column])
        return (since is None or last >= since) and (until is None or first <= until)

    def changed_months(self, old: Release, new: Release, *tables: str) -> set[str]:
        """Months of which a part came or went between two releases."""
        def held(r: Release) -> set[tuple[str, str, str]]:
            return {(t, p, m) for t in tables or self.monthly for p, own in r.tables[t].items() for m in own or ()}

        return {m for _, _, m in held(old) ^ held(new)}

    # -- removal -------------------------------------------------------------

    def remove(self, keep: int = 2) -> list[int]:
        """Removes all releases but the last ``keep``, and the parts that only they name; returns their numbers.

        Not while another writer is at work: parts that no manifest names yet count as left over.
        """
        numbers = self.numbers()
        old, kept = numbers[: max(len(numbers) - max(keep, 1), 0)], [self.release(n) for n in numbers[-max(keep, 1) :]]
        for number in old:  # manifests first: a reader must not find one whose parts are gone
            fs, where = self._hadoop(self._manifest(number))
            fs.delete(where, False)
        for table in self.schemas:
            named = {f"{PART}={p}" for r in kept for p in r.tables[table]}
            for name in set(self._names(f"{self.path}/data/{table}")) - named:
                fs, where = self._hadoop(f"{self.path}/data/{table}/{name}")
                fs.delete(where, True)
        return old
