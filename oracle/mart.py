"""The mart as DuckDB common table expressions, money in integer cents.

Ratios are divided as integers with one half-up rounding, because DuckDB
divides decimals as doubles.
"""

from __future__ import annotations

import re


def half_up(n: str, d: str) -> str:
    """n / d rounded half away from zero, as an integer; d must be positive."""
    n, d = f"CAST({n} AS HUGEINT)", f"CAST({d} AS HUGEINT)"
    return f"(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})))"


def money(cents: str, digits: int = 28) -> str:
    return f"CAST(({cents}) / 100.0 AS DECIMAL({digits},2))"


def frac(n: str, d: str, scale: int = 2, times: int = 1) -> str:
    """times * n / d as a decimal; NULL where d is zero."""
    whole = half_up(f"({n}) * {times * 10**scale}", f"({d})")
    return f"CASE WHEN ({d}) <> 0 THEN CAST({whole} / {10**scale}.0 AS DECIMAL(18,{scale})) END"


def percent(n: str, d: str, scale: int = 2) -> str:
    return frac(n, d, scale, 100)


def per(cents: str, count: str, scale: int = 2) -> str:
    """Money in cents per count."""
    return frac(cents, f"({count}) * 100", scale)


def _choice(index: str, values: list[str]) -> str:
    return f"list_extract([{', '.join(repr(v) for v in values)}], ({index})::INT + 1)"


def _digest(factor: int) -> str:
    """Digest of a line's columns other than its order."""
    parts = (
        "l_partkey",
        "l_suppkey",
        "round(l_extendedprice * 100)::BIGINT",
        "l_linenumber::BIGINT",
        "round(l_quantity * 100)::BIGINT",
        "round(l_discount * 10000)::BIGINT",
        "round(l_tax * 10000)::BIGINT",
        "ascii(l_returnflag)",
        "ascii(l_linestatus)",
        "(l_shipdate::DATE - DATE '1970-01-01')",
    )
    digest = "0::BIGINT"
    for part in parts:
        digest = f"(({digest} * {factor} + {part} % 2147483647) % 2147483647)"
    return digest


_REP = "{0} % (SELECT n * 9 // 10 FROM rep_count) + 1"

CTES: dict[str, str] = {
    "rep_count": "SELECT count(*) AS n FROM supplier",
    "years": """
        SELECT make_date(year(min(o_orderdate)), 1, 1) AS first_day, make_date(year(max(o_orderdate)), 12, 31) AS last_day
        FROM orders""",
    "dim_regions": """
        SELECT n_nationkey + 1 AS region_id, r_name AS country_name, n_name AS region_name,
               n_name || ' Territory' AS territory_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "dim_categories": """
        SELECT DISTINCT ('0x' || substr(md5(p_type), 1, 15))::BIGINT AS category_id, p_type AS category_name,
               CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'Core' ELSE 'Extended' END AS segment_name,
               NULL::BIGINT AS parent_category_id
        FROM part""",
    "dim_date": """
        SELECT strftime(d, '%Y%m%d')::INT AS date_id, d AS full_date, year(d)::INT AS year,
               quarter(d)::INT AS quarter, month(d)::INT AS month, monthname(d) AS month_name,
               weekofyear(d)::INT AS week_number, isodow(d)::INT AS day_of_week, dayname(d) AS day_name,
               isodow(d) < 6 AS is_business_day
        FROM (SELECT unnest(generate_series((SELECT first_day FROM years), (SELECT last_day FROM years), INTERVAL 1 DAY))::DATE AS d)""",
    "dim_sales_reps": f"""
        SELECT s_suppkey + 1 AS sales_rep_id, 'REP' || lpad((s_suppkey + 1)::VARCHAR, 6, '0') AS employee_code,
               s_name AS rep_name, (DATE '1995-01-01' - (s_suppkey % 365)::INT) AS hire_date,
               {_choice("s_suppkey % 4", ["Rep grade 1", "Rep grade 2", "Rep grade 3", "Rep grade 4"])} AS job_title,
               'Active' AS sales_rep_status, s_suppkey % 20 <> 19 AS is_active,
               (DATE '1995-01-01' - (s_suppkey % 365)::INT) AS valid_from, NULL::DATE AS valid_to,
               s_nationkey + 1 AS region_id
        FROM supplier""",
    "dim_customers": f"""
        SELECT c_custkey + 1 AS customer_id, 'CUST' || lpad((c_custkey + 1)::VARCHAR, 8, '0') AS customer_code,
               c_name AS customer_name, c_mktsegment AS customer_type,
               {_choice("c_custkey % 4", ["A", "B", "C", "D"])} AS customer_group,
               {_choice("c_custkey % 3", ["Active", "Inactive", "Prospect"])} AS customer_status,
               {_choice("c_custkey % 3", ["Gold", "Silver", "Bronze"])} AS account_tier,
               CAST(round(greatest(c_acctbal, 0) * 1000) / 100.0 AS DECIMAL(18,2)) AS credit_limit,
               format('Street {{}}, City {{}}', c_custkey + 1, c_custkey + 1) AS billing_address, true AS is_active,
               TIMESTAMP '1995-01-01 00:00:00' AS created_at, c_nationkey + 1 AS region_id
        FROM customer""",
    "product_cost": f"""
        SELECT *, {half_up("round(p_retailprice * 100) * CASE p_type WHEN 'PROMO' THEN 24 WHEN 'LARGE' THEN 22 ELSE 15 END", "10")}::BIGINT AS cost_c
        FROM part""",
    "product": f"""
        SELECT p_partkey + 1 AS product_id, 'SKU' || lpad((p_partkey + 1)::VARCHAR, 8, '0') AS product_sku,
               p_name AS product_name, p_size AS stock_level, 'Active' AS product_status, p_type AS product_type,
               p_brand AS brand, p_partkey % 50 <> 48 AS is_active, cost_c,
               {half_up("cost_c * CASE WHEN p_partkey % 8 IN (0, 2) THEN 35 ELSE 17 END", "10")}::BIGINT AS list_c,
               DATE '1995-01-01' AS valid_from, NULL::DATE AS valid_to,
               ('0x' || substr(md5(p_type), 1, 15))::BIGINT AS category_id, p_type AS category_name
        FROM product_cost""",
    "dim_products": f"""
        SELECT product_id, product_sku, product_name, stock_level, product_status, product_type, brand, is_active,
               {money("cost_c", 18)} AS unit_cost, {money("list_c", 18)} AS list_price, valid_from, valid_to, category_id
        FROM product""",
    "rep_customer_assignments": f"""
        SELECT 2 * (c_custkey + 1) AS assignment_id, {_REP.format("c_custkey")} AS sales_rep_id,
               c_custkey + 1 AS customer_id,
               CASE WHEN (c_custkey + 1) % 10 < 3 THEN DATE '1998-01-01' ELSE DATE '1995-01-01' END AS valid_from,
               NULL::DATE AS valid_to, true AS is_active
        FROM customer
        UNION ALL
        SELECT 2 * (c_custkey + 1) + 1, (c_custkey + 6) % (SELECT n FROM rep_count) + 1, c_custkey + 1,
               DATE '1995-01-01',
               CASE WHEN (c_custkey + 1) % 50 = 2 THEN DATE '1998-01-31' ELSE DATE '1997-12-31' END, false
        FROM customer WHERE (c_custkey + 1) % 10 < 3""",
    "promotion_month": """
        SELECT product_id, product_id % 5 AS slot,
               make_date(1996 + product_id % 5, product_id % 12 + 1, 1) AS first_day
        FROM (SELECT p_partkey + 1 AS product_id FROM part)""",
    "product_promotions": f"""
        SELECT 2 * product_id AS promotion_id, first_day AS valid_from, last_day(first_day) AS valid_to,
               CAST({_choice("slot", ["0.05", "0.07", "0.10", "0.12", "0.15"])} AS DECIMAL(5,4)) AS discount_rate, product_id
        FROM promotion_month WHERE slot < 3
        UNION ALL
        SELECT 2 * product_id + 1, first_day + 10, NULL, 0.20, product_id
        FROM promotion_month WHERE product_id % 10 = 0""",
    "order_head": """
        SELECT o_orderkey + 1 AS order_id, o_custkey - (o_custkey % 100 = 99)::INT AS account,
               o_orderstatus, o_orderkey, o_orderdate, o_orderdate::DATE AS order_date
        FROM orders""",
    "order_state": f"""
        SELECT *, CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'P' THEN 'Partially Delivered'
                  ELSE {_choice("o_orderkey % 3", ["Pending", "Confirmed", "Cancelled"])} END AS order_status,
               {_REP.format("account")} AS own_rep
        FROM order_head""",
    "fact_sales_orders": f"""
        SELECT order_id, order_status,
               {_choice("order_id % 4", ["30 days", "45 days", "60 days", "In advance"])} AS payment_terms,
               'Sales Order' AS document_type, 'Main' AS sales_org,
               CASE WHEN order_id % 2 = 0 THEN 'Dealer' ELSE 'Direct' END AS distribution_channel,
               o_orderdate AS created_at, account + 1 AS customer_id,
               CASE WHEN order_id % 12 = 0 THEN own_rep % (SELECT n FROM rep_count) + 1 ELSE own_rep END AS sales_rep_id,
               order_date,
               CASE WHEN order_status NOT IN ('Pending', 'Cancelled')
                    THEN order_date + (5 + order_id % 20)::INT END AS ship_date
        FROM order_state""",
    "line_raw": f"""
        SELECT (l_orderkey + 1) || '-' || ({_digest(1000003)} * 2147483647 + {_digest(998244)}) AS line_item_id,
               floor(l_quantity + 0.5)::INT AS quantity, round(l_quantity * 100)::BIGINT AS quantity_h, round(l_extendedprice * 100)::BIGINT AS gross_c,
               round(l_discount * 10000)::BIGINT AS rate_bp, l_orderkey + 1 AS order_id,
               l_partkey - (l_partkey % 100 = 99)::INT + 1 AS product_id, l_linenumber, l_returnflag
        FROM lineitem""",
    "line": f"""
        SELECT r.*, {half_up("gross_c * (10000 - rate_bp)", "10000")}::BIGINT AS net_c,
               {half_up("gross_c * 100", "nullif(quantity_h, 0)")}::BIGINT AS price_c, o.order_date AS line_date
        FROM line_raw r LEFT JOIN fact_sales_orders o USING (order_id)""",
    "fact_order_line_items": f"""
        SELECT line_item_id, quantity, {money("price_c", 18)} AS unit_price,
               CAST(rate_bp / 10000.0 AS DECIMAL(5,4)) AS discount, {money("gross_c", 18)} AS gross_amount,
               {money("net_c", 18)} AS net_amount, order_id, product_id, line_date
        FROM line""",
    "ret_raw": """
        SELECT *, CASE WHEN quantity = 1 AND l_linenumber = 1 THEN 2
                       WHEN l_linenumber % 2 = 0 AND quantity >= 2 THEN quantity // 2 ELSE 1 END::INT AS return_quantity
        FROM line WHERE l_returnflag = 'R'""",
    "ret": f"""
        SELECT line_item_id AS return_id, 'Open' AS return_status, return_quantity,
               {half_up("return_quantity * price_c * (10000 - rate_bp)", "10000")}::BIGINT AS credit_c,
               {_choice("(order_id + l_linenumber) % 5", ["Broken", "Late", "Other item", "Not wanted", "Faulty"])} AS return_reason,
               line_item_id, line_date AS return_date
        FROM ret_raw""",
    "fact_returns": f"""
        SELECT return_id, return_status, return_quantity, {money("credit_c", 18)} AS credit_amount, return_reason,
               line_item_id, return_date
        FROM ret""",
    "quota": """
        SELECT sales_rep_id * 1000 + (year(quota_date) - (SELECT year(first_day) FROM years)) * 12 + month(quota_date) AS quota_id,
               (18000 + sales_rep_id % 100 * 120 + month(quota_date) * 150 + (year(quota_date) - 1995) * 500) * 2500 AS quota_c,
               sales_rep_id, quota_date, 'Monthly' AS quota_period
        FROM (SELECT s_suppkey + 1 AS sales_rep_id,
                     unnest(generate_series((SELECT first_day FROM years), (SELECT last_day FROM years), INTERVAL 1 MONTH))::DATE AS quota_date
              FROM supplier)""",
    "fact_quotas": f"""
        SELECT quota_id, {money("quota_c", 18)} AS quota_amount, sales_rep_id, quota_date, quota_period FROM quota""",
    "sale": """
        SELECT l.*, o.* EXCLUDE (order_id), c.customer_code, c.customer_type, c.customer_group, c.account_tier,
               g.country_name, g.region_name, g.territory_name, s.employee_code, s.rep_name, s.job_title,
               h.country_name AS rep_country, h.region_name AS rep_region, p.product_sku, p.product_name, p.brand,
               p.product_type, p.category_name, p.cost_c, l.quantity * p.cost_c AS line_cost_c
        FROM line l
        JOIN fact_sales_orders o USING (order_id)
        JOIN dim_customers c USING (customer_id)
        JOIN dim_regions g ON c.region_id = g.region_id
        JOIN dim_sales_reps s USING (sales_rep_id)
        JOIN dim_regions h ON s.region_id = h.region_id
        JOIN product p USING (product_id)""",
    "valid_sale": "SELECT * FROM sale WHERE order_status <> 'Cancelled'",
    "returned": """
        SELECT line_item_id, sum(return_quantity) AS returned FROM ret GROUP BY line_item_id""",
}

_ORDER = list(CTES)
_WORD = re.compile(r"\b\w+\b")


# What moves the rows of every hundredth account and part to the one before.
SPARE_KEYS = (" - (o_custkey % 100 = 99)::INT", " - (l_partkey % 100 = 99)::INT")


def with_mart(body: str, spare_keys: bool = False) -> str:
    """``body`` with the mart tables it needs in front of it.

    ``body`` may begin with its own WITH list.
    """
    needed: set[str] = set()
    queue = [body]
    while queue:
        for name in set(_WORD.findall(queue.pop())) & set(CTES):
            if name not in needed:
                needed.add(name)
                queue.append(CTES[name])
    ctes = ",\n".join(f"{name} AS ({CTES[name]})" for name in _ORDER if name in needed)
    if not spare_keys:
        for moved in SPARE_KEYS:
            ctes = ctes.replace(moved, "")
    body = body.strip()
    if not ctes:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
