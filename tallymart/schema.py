"""The mart's tables: columns, keys and value rules, all as data.

Facts hold dates, not date ids.  Line and return keys are strings, made from a
line's own columns: a dense counter would need all lines in one place.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

_MONEY = "decimal(18,2)"
_RATE = "decimal(5,4)"

DDL: dict[str, str] = {
    "dim_regions": "region_id int, country_name string, region_name string, territory_name string",
    "dim_categories": "category_id bigint, category_name string, segment_name string, parent_category_id bigint",
    "dim_date": "date_id int, full_date date, year int, quarter int, month int, month_name string, "
    "week_number int, day_of_week int, day_name string, is_business_day boolean",
    "dim_sales_reps": "sales_rep_id bigint, employee_code string, rep_name string, hire_date date, "
    "job_title string, sales_rep_status string, is_active boolean, valid_from date, valid_to date, "
    "region_id int",
    "dim_customers": "customer_id bigint, customer_code string, customer_name string, "
    f"customer_type string, customer_group string, customer_status string, account_tier string, "
    f"credit_limit {_MONEY}, billing_address string, is_active boolean, created_at timestamp_ntz, "
    "region_id int",
    "dim_products": "product_id bigint, product_sku string, product_name string, stock_level int, "
    "product_status string, product_type string, brand string, is_active boolean, "
    f"unit_cost {_MONEY}, list_price {_MONEY}, valid_from date, valid_to date, category_id bigint",
    "fact_sales_orders": "order_id bigint, order_status string, payment_terms string, "
    "document_type string, sales_org string, distribution_channel string, created_at timestamp_ntz, "
    "customer_id bigint, sales_rep_id bigint, order_date date, ship_date date",
    "fact_order_line_items": f"line_item_id string, quantity int, unit_price {_MONEY}, "
    f"discount {_RATE}, gross_amount {_MONEY}, net_amount {_MONEY}, order_id bigint, "
    "product_id bigint, line_date date",
    "fact_returns": f"return_id string, return_status string, return_quantity int, "
    f"credit_amount {_MONEY}, return_reason string, line_item_id string, return_date date",
    "fact_quotas": f"quota_id bigint, quota_amount {_MONEY}, sales_rep_id bigint, quota_date date, "
    "quota_period string",
    "rep_customer_assignments": "assignment_id bigint, sales_rep_id bigint, customer_id bigint, "
    "valid_from date, valid_to date, is_active boolean",
    "product_promotions": f"promotion_id bigint, valid_from date, valid_to date, "
    f"discount_rate {_RATE}, product_id bigint",
}

TABLES = tuple(DDL)


def schema_of(table: str) -> StructType:
    return StructType.fromDDL(DDL[table])


def columns_of(table: str) -> list[str]:
    return schema_of(table).fieldNames()


PRIMARY_KEYS: dict[str, str] = {
    "dim_regions": "region_id",
    "dim_categories": "category_id",
    "dim_date": "date_id",
    "dim_sales_reps": "sales_rep_id",
    "dim_customers": "customer_id",
    "dim_products": "product_id",
    "fact_sales_orders": "order_id",
    "fact_order_line_items": "line_item_id",
    "fact_returns": "return_id",
    "fact_quotas": "quota_id",
    "rep_customer_assignments": "assignment_id",
    "product_promotions": "promotion_id",
}

UNIQUE: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("dim_regions", ("country_name", "region_name", "territory_name")),
    ("dim_date", ("full_date",)),
    ("dim_sales_reps", ("employee_code",)),
    ("dim_customers", ("customer_code",)),
    ("dim_products", ("product_sku",)),
    ("rep_customer_assignments", ("sales_rep_id", "customer_id", "valid_from")),
)

# child table, child column, parent table, parent column
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("dim_categories", "parent_category_id", "dim_categories", "category_id"),
    ("dim_sales_reps", "region_id", "dim_regions", "region_id"),
    ("dim_customers", "region_id", "dim_regions", "region_id"),
    ("dim_products", "category_id", "dim_categories", "category_id"),
    ("fact_sales_orders", "customer_id", "dim_customers", "customer_id"),
    ("fact_sales_orders", "sales_rep_id", "dim_sales_reps", "sales_rep_id"),
    ("fact_sales_orders", "order_date", "dim_date", "full_date"),
    ("fact_sales_orders", "ship_date", "dim_date", "full_date"),
    ("fact_order_line_items", "order_id", "fact_sales_orders", "order_id"),
    ("fact_order_line_items", "product_id", "dim_products", "product_id"),
    ("fact_order_line_items", "line_date", "dim_date", "full_date"),
    ("fact_returns", "line_item_id", "fact_order_line_items", "line_item_id"),
    ("fact_returns", "return_date", "dim_date", "full_date"),
    ("fact_quotas", "sales_rep_id", "dim_sales_reps", "sales_rep_id"),
    ("fact_quotas", "quota_date", "dim_date", "full_date"),
    ("rep_customer_assignments", "sales_rep_id", "dim_sales_reps", "sales_rep_id"),
    ("rep_customer_assignments", "customer_id", "dim_customers", "customer_id"),
    ("product_promotions", "product_id", "dim_products", "product_id"),
)

# The order states, account tiers and quota periods a row may have.
ORDER_STATUSES = ("Pending", "Confirmed", "Partially Delivered", "Delivered", "Cancelled")
ACCOUNT_TIERS = ("Gold", "Silver", "Bronze")
QUOTA_PERIODS = ("Monthly", "Quarterly")


def _one_of(column: str, values: tuple[str, ...]) -> str:
    return f"{column} in ({', '.join(repr(v) for v in values)})"


# table, rule name, predicate a row must meet; a NULL outcome passes
CHECKS: tuple[tuple[str, str, str], ...] = (
    ("dim_date", "quarter_range", "quarter between 1 and 4"),
    ("dim_date", "month_range", "month between 1 and 12"),
    ("dim_date", "weekday_range", "day_of_week between 1 and 7"),
    ("dim_sales_reps", "window_order", "valid_to >= valid_from"),
    ("dim_customers", "credit_not_negative", "credit_limit >= 0"),
    ("dim_customers", "tier_known", _one_of("account_tier", ACCOUNT_TIERS)),
    ("dim_products", "stock_not_negative", "stock_level >= 0"),
    ("dim_products", "cost_positive", "unit_cost > 0"),
    ("dim_products", "price_positive", "list_price > 0"),
    ("dim_products", "window_order", "valid_to >= valid_from"),
    ("dim_products", "price_covers_cost", "list_price >= unit_cost"),
    ("fact_sales_orders", "status_known", _one_of("order_status", ORDER_STATUSES)),
    ("fact_sales_orders", "ship_after_order", "ship_date >= order_date"),
    ("fact_order_line_items", "quantity_positive", "quantity > 0"),
    ("fact_order_line_items", "price_positive", "unit_price > 0"),
    ("fact_order_line_items", "discount_range", "discount between 0 and 1"),
    ("fact_order_line_items", "gross_not_negative", "gross_amount >= 0"),
    ("fact_order_line_items", "net_not_negative", "net_amount >= 0"),
    ("fact_returns", "quantity_positive", "return_quantity > 0"),
    ("fact_returns", "credit_not_negative", "credit_amount >= 0"),
    ("fact_quotas", "amount_not_negative", "quota_amount >= 0"),
    ("fact_quotas", "period_known", _one_of("quota_period", QUOTA_PERIODS)),
    ("rep_customer_assignments", "window_order", "valid_to >= valid_from"),
    ("product_promotions", "rate_range", "discount_rate between 0 and 1"),
    ("product_promotions", "window_order", "valid_to >= valid_from"),
)
