"""Views that last: a set of definitions, published beside a mart and opened by any session.

A definition is a view of the library by its name, or SQL over the tables and views that it needs.
Sets are releases: one is checked as a whole, tier by tier, before it becomes the current one, and a
former one can be brought back.  Rows are not kept: a view that is opened reads the mart's current release.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass, fields
from datetime import date
from string import Formatter

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from tallymart.params import ProfileLadder, RecencyLadder, ReportParams
from tallymart.plans.views import TIERS, VIEWS
from tallymart.schema import TABLES
from tallymart.sinks.releases import Release, ReleaseStore
from tallymart.sources.mart import open_mart
from tallymart.sources.star import Star

#: The views that a view of the library is made of; others read tables only.
NEEDS = {
    "vw_base_return_detail": ("vw_base_order_line_detail",),
    "vw_country_category_sales_summary": ("vw_base_country_category_sales",),
    "vw_sales_executive_summary": ("vw_summary_sales_executive",),
    "vw_customer_360": ("vw_summary_customer_360",),
    "vw_product_performance": ("vw_summary_product_performance",),
    "vw_rep_performance_scorecard": ("vw_summary_rep_performance",),
    "vw_monthly_trend": ("vw_summary_monthly_trend",),
    "vw_returns_analysis": ("vw_summary_returns_analysis",),
    "vw_sales_channel_analysis": ("vw_channel_summary",),
    "vw_order_efficiency": ("vw_order_summary",),
    "vw_country_category_sales": ("vw_country_category_sales_summary",),
    "vw_inventory_risk_report": ("vw_inventory_risk_summary",),
}


class BrokenView(ValueError):
    """A set of views that cannot be published: one lacks what it needs, or fails over the mart."""


@dataclass(frozen=True)
class View:
    """A definition.  ``sql`` names tables and other views in braces (``FROM {fact_returns}``); without it the
    view is the library's of that name.  A tier is dropped after all later ones."""

    name: str
    tier: int
    sql: str | None = None

    def needs(self) -> set[str]:
        """Tables and views that it is made of; a view of the library: views only."""
        if self.sql is None:
            return set(NEEDS.get(self.name, ()))
        return {f for _, f, _, _ in Formatter().parse(self.sql) if f}


def library(names: Iterable[str] = VIEWS) -> list[View]:
    """Definitions of views of the library and of all that these need."""
    tier_of = {v.__name__: t for t, views in enumerate(TIERS, 1) for v in views}
    wanted, left = set(), list(names)
    while left:
        name = left.pop()
        if name not in wanted:
            wanted.add(name)
            left += NEEDS.get(name, ())
    return [View(n, tier_of[n]) for n in VIEWS if n in wanted]


def in_order(views: Iterable[View]) -> list[View]:
    """The views, each after those that it needs and after earlier tiers.

    None may share a name with another or with a table, need what is not there, or need a view of a later
    tier; within a tier there is no circle.
    """
    views = sorted(views, key=lambda v: (v.tier, v.name))
    tier_of = {v.name: v.tier for v in views}
    if len(tier_of) < len(views) or tier_of.keys() & set(TABLES):
        raise BrokenView("a name is used twice")
    for view in views:
        if view.sql is None and view.name not in VIEWS:
            raise BrokenView(f"{view.name} is no view of the library and has no SQL")
        for need in sorted(view.needs() - set(TABLES)):
            if tier_of.get(need, view.tier + 1) > view.tier:
                raise BrokenView(f"{view.name} needs {need}, which is not there or in a later tier")
    done: list[View] = []
    while views:
        ready = {v.name for v in done} | set(TABLES)
        following = next((v for v in views if v.needs() <= ready), None)
        if following is None:
            raise BrokenView(f"in a circle: {', '.join(v.name for v in views)}")
        views.remove(following)
        done.append(following)
    return done


def _as_json(p: ReportParams) -> dict:
    return asdict(p) | {"as_of": p.as_of.isoformat()}


def _from_json(values: dict) -> ReportParams:
    known = {f.name for f in fields(ReportParams)}
    found = {k: tuple(v) if isinstance(v, list) else v for k, v in values.items() if k in known}
    ladders = {"recency": RecencyLadder(**values["recency"]), "profile": ProfileLadder(**values["profile"])}
    return ReportParams(**found | ladders | {"as_of": date.fromisoformat(values["as_of"])})


class ViewStore:
    """Releases of views under ``path`` over the mart under ``mart``."""

    def __init__(self, spark: SparkSession, path: str, mart: str):
        self.spark, self.mart = spark, mart
        self.releases = ReleaseStore(spark, path, {})

    def definitions(self, number: int | None = None) -> tuple[list[View], ReportParams]:
        """Views of a release (the current one), in order, and the parameters they are opened with."""
        release = self.releases.release(number)
        if release is None:
            raise LookupError(f"no views under {self.releases.path}")
        return [View(**v) for v in release.notes["views"]], _from_json(release.notes["params"])

    def publish(self, views: Iterable[View], p: ReportParams, smoke: bool = True) -> Release:
        """The views take the place of all that were there, if every one of them stands.

        All are analysed over the mart's current release; with ``smoke`` those that no other view needs are
        also run to their first row, and the others with them.  The former release stays if one is broken.
        """
        return self._put(in_order(views), p, smoke, self.releases.publish)

    def drop_tier(self, tier: int) -> list[str]:
        """A release without the views of a tier; names of these, the one first that was last.

        Refused while a view that stays needs one of them.
        """
        views, p = self.definitions()
        kept = [v for v in views if v.tier != tier]
        self._put(in_order(kept), p, False, self.releases.append)
        return [v.name for v in reversed(views) if v.tier == tier]

    def roll_back(self, number: int, smoke: bool = True) -> Release:
        """The views of a former release as a new one, checked over the mart as it is now."""
        views, p = self.definitions(number)
        return self._put(in_order(views), p, smoke, self.releases.append)

    def _put(self, views: list[View], p: ReportParams, smoke: bool, put: Callable) -> Release:
        needed = set().union(*(v.needs() for v in views))
        for name, df in self._open(views, p).items():
            if smoke and name not in needed:
                try:
                    df.limit(1).collect()
                except Exception as error:  # whatever ends a query
                    raise BrokenView(f"{name} fails over the mart") from error
        return put({}, {"views": [asdict(v) for v in views], "params": _as_json(p)})

    def _open(self, views: list[View], p: ReportParams) -> dict[str, DataFrame]:
        star: Star = open_mart(self.spark, self.mart)
        found: dict[str, DataFrame] = {}
        for view in views:
            try:
                if view.sql is None:
                    found[view.name] = VIEWS[view.name](star, p)
                else:
                    made_of = {n: found[n] if n in found else star[n] for n in view.needs()}
                    found[view.name] = self.spark.sql(view.sql, **made_of)
            except (PySparkException, LookupError) as error:
                raise BrokenView(f"{view.name} cannot be read from the mart") from error
        return found

    def open(self, number: int | None = None) -> dict[str, DataFrame]:
        """The views of a release by name, over the mart's current release."""
        return self._open(*self.definitions(number))

    def register(self, number: int | None = None) -> list[str]:
        """Temporary views of this session for all views of a release; their names in order."""
        found = self.open(number)
        for name, df in found.items():
            df.createOrReplaceTempView(name)
        return list(found)
