"""All reports, views and checks by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tallymart.params import ReportParams
from tallymart.plans import advanced, aggregates, basic, joins, quality, views
from tallymart.sources.star import Star

Report = Callable[[Star, ReportParams], DataFrame]

BASIC: tuple[Report, ...] = (
    basic.gold_customers_in_country,
    basic.open_orders_q3,
    basic.high_margin_products,
    basic.reps_without_recent_assignment,
    basic.late_shipments_country,
    basic.products_name_contains,
    basic.customers_per_country,
    basic.sales_per_rep,
    basic.orders_per_month_last_year,
    basic.top_products_by_quantity,
    basic.active_products_never_ordered,
    basic.avg_line_value_per_customer,
)
AGGREGATES: tuple[Report, ...] = (
    aggregates.gross_revenue_month_country,
    aggregates.net_revenue_quarter_category,
    aggregates.gross_margin_by_category,
    aggregates.aov_region_month,
    aggregates.return_rate_product_quarter,
    aggregates.quota_attainment_rep_month,
    aggregates.order_frequency_by_tier,
    aggregates.top_products_per_country,
    aggregates.customer_retention_by_year,
    aggregates.avg_products_per_order_month,
    aggregates.discount_impact_month,
    aggregates.top_rep_per_country,
    aggregates.avg_discount_by_category,
    aggregates.yoy_growth_by_country,
    aggregates.reps_high_revenue_low_attainment,
    aggregates.low_margin_high_return_categories,
    aggregates.frequent_low_value_customers,
)
JOINS: tuple[Report, ...] = (
    joins.full_order_summary,
    joins.orphan_customers,
    joins.rep_customer_mismatch,
    joins.rep_customer_mismatch_top,
    joins.revenue_rollup_geography,
    joins.line_margin_detail,
    joins.unordered_products_12m,
    joins.delivery_exceptions,
    joins.returns_detail,
    joins.customer_revenue_assigned_rep,
    joins.multi_product_orders,
    joins.revenue_category_country,
    joins.high_spend_customers,
)
ADVANCED: tuple[Report, ...] = (
    advanced.rfm_segmentation,
    advanced.mom_revenue_by_country,
    advanced.running_total_by_quarter,
    advanced.rep_attainment_rank,
    advanced.top_customer_per_country,
    advanced.products_not_ordered_high_rev_regions,
    advanced.customer_lifetime_rank,
    advanced.days_between_orders,
    advanced.top3_customers_country_quarter,
    advanced.monthly_product_running_total,
    advanced.customer_360_candidate,
    advanced.monthly_country_trend,
)
QUALITY: tuple[Report, ...] = (
    quality.table_row_counts,
    quality.dq_primary_key,
    quality.dq_unique,
    quality.dq_foreign_key,
    quality.dq_keys,
    quality.dq_check,
    quality.dq_orders_without_lines,
    quality.dq_over_returned_lines,
    quality.dq_overlapping_assignments,
    quality.dq_date_coverage,
    quality.dq_date_gaps,
    quality.dq_orphan_facts,
    quality.dq_cancelled_exclusion,
    quality.dq_customer_name_shape,
    quality.dq_product_name_shape,
    quality.promotion_on_line,
    quality.promotion_per_line,
    views.view_smoke_counts,
)

REPORTS: dict[str, Report] = {f.__name__: f for group in (BASIC, AGGREGATES, JOINS, ADVANCED, QUALITY) for f in group}
REPORTS.update(views.VIEWS)
