"""tallymart: a sales-analytics mart and its report library on Spark."""

from tallymart.params import ReportParams
from tallymart.session import build_session, tune
from tallymart.sources.conform import conform
from tallymart.sources.star import Star, load_star

__all__ = ["ReportParams", "Star", "build_session", "conform", "load_star", "tune"]
