"""Oracle statements of the reports, views and checks.

``sale`` is every line with its order, customer, geography, rep and product.
"""

from __future__ import annotations

from oracle.mart import frac, half_up, money, per, percent, with_mart

AS_OF = "DATE '2001-05-17'"
YM = "year({0})::INT AS year, month({0})::INT AS month"
YMN = YM + ", monthname({0}) AS month_name"
YQ = "year({0})::INT AS year, quarter({0})::INT AS quarter"
OD_YM, OD_YMN, OD_YQ = (t.format("order_date") for t in (YM, YMN, YQ))
LD_YM, LD_YMN, LD_YQ = (t.format("line_date") for t in (YM, YMN, YQ))
PERIOD = "date_trunc('month', {0})::DATE AS period_start_date"
NET = money("sum(net_c)")
ORDERS = "count(DISTINCT order_id)"
REVENUE_PER_ORDER = per("sum(net_c)", ORDERS)


def _calendar(column: str, quarter: bool = False) -> str:
    q = f"quarter({column})::INT AS calendar_quarter, " if quarter else ""
    return f"{column}, year({column})::INT AS calendar_year, {q}month({column})::INT AS calendar_month, monthname({column}) AS month_name"


BASIC = {
    "gold_customers_in_country": """
        SELECT customer_id, customer_code, customer_type, customer_group, account_tier, credit_limit,
               country_name, region_name, territory_name
        FROM dim_customers JOIN dim_regions USING (region_id)
        WHERE country_name = 'EUROPE' AND account_tier = 'Gold' AND credit_limit > 50000""",
    "open_orders_q3": f"""
        SELECT order_id, any_value(customer_code) AS customer_code, any_value(order_date) AS order_date,
               any_value(order_status) AS order_status, {NET} AS total_order_value
        FROM sale
        WHERE year(order_date) = 2000 AND quarter(order_date) = 3
          AND order_status IN ('Pending', 'Partially Delivered')
        GROUP BY order_id""",
    "high_margin_products": f"""
        SELECT product_id, product_sku, product_name, brand, product_type, {money("cost_c", 18)} AS unit_cost,
               {money("list_c", 18)} AS list_price, {money("list_c - cost_c", 18)} AS margin_amount,
               {percent("list_c - cost_c", "list_c", 6)} AS margin_percent
        FROM product WHERE list_c > 3 * cost_c""",
    "reps_without_recent_assignment": f"""
        SELECT sales_rep_id, employee_code, rep_name, job_title
        FROM dim_sales_reps
        WHERE sales_rep_id NOT IN (
            SELECT sales_rep_id FROM rep_customer_assignments
            WHERE valid_from <= {AS_OF} AND coalesce(valid_to, DATE '9999-12-31') >= {AS_OF} - INTERVAL 6 MONTH)""",
    "late_shipments_country": """
        SELECT order_id, customer_code, country_name, order_date, ship_date,
               (ship_date - order_date)::INT AS delay_days, order_status
        FROM fact_sales_orders JOIN dim_customers USING (customer_id) JOIN dim_regions USING (region_id)
        WHERE country_name = 'EUROPE' AND ship_date - order_date > 14""",
    "products_name_contains": f"""
        SELECT product_id, product_sku, product_name, brand, product_type, {money("cost_c", 18)} AS unit_cost,
               {money("list_c", 18)} AS list_price
        FROM product WHERE product_name ILIKE '%ring%'""",
    "customers_per_country": """
        SELECT country_name, count(*) AS total_customers
        FROM dim_customers JOIN dim_regions USING (region_id) GROUP BY country_name""",
    "sales_per_rep": f"""
        SELECT sales_rep_id, any_value(rep_name) AS rep_name, {NET} AS total_sales FROM sale GROUP BY sales_rep_id""",
    "orders_per_month_last_year": f"""
        SELECT {OD_YM}, count(*) AS total_orders FROM fact_sales_orders WHERE year(order_date) = 2000 GROUP BY 1, 2""",
    "top_products_by_quantity": """
        SELECT product_id, any_value(product_name) AS product_name, sum(quantity)::BIGINT AS total_quantity_sold
        FROM sale GROUP BY product_id ORDER BY 3 DESC, 1 LIMIT 10""",
    "active_products_never_ordered": f"""
        SELECT product_id, product_sku, product_name, brand, {money("list_c", 18)} AS list_price, stock_level
        FROM product WHERE is_active AND product_id NOT IN (SELECT product_id FROM line)""",
    "avg_line_value_per_customer": f"""
        SELECT customer_id, {per("sum(net_c)", "count(*)", 6)} AS avg_order_value FROM sale GROUP BY customer_id""",
}

_MARGIN_BY_CATEGORY = """
    SELECT category_name, sum(net_c) AS n, sum(line_cost_c) AS k, sum(quantity) AS u, coalesce(sum(returned), 0) AS r
    FROM sale LEFT JOIN returned USING (line_item_id) GROUP BY category_name"""
_QUOTA = "SELECT sales_rep_id, {0}, sum(quota_c) AS q FROM quota WHERE quota_period = 'Monthly' GROUP BY ALL"

AGGREGATES = {
    "gross_revenue_month_country": f"""
        SELECT {LD_YMN}, country_name, {money("sum(gross_c)")} AS gross_revenue FROM sale GROUP BY ALL""",
    "net_revenue_quarter_category": f"""
        SELECT {LD_YQ}, category_name, {NET} AS net_revenue FROM sale GROUP BY ALL""",
    "gross_margin_by_category": f"""
        SELECT category_name, {money("n")} AS net_revenue, {money("k")} AS total_cost,
               {money("n - k")} AS gross_profit, {percent("n - k", "n", 6)} AS gross_margin_percent
        FROM ({_MARGIN_BY_CATEGORY})""",
    "aov_region_month": f"""
        SELECT {OD_YMN}, region_name, {NET} AS total_revenue, {ORDERS} AS total_orders,
               {REVENUE_PER_ORDER} AS average_order_value
        FROM sale GROUP BY ALL""",
    "return_rate_product_quarter": f"""
        SELECT {LD_YQ}, product_id, product_sku, product_name, sum(quantity)::BIGINT AS units_sold,
               coalesce(sum(returned), 0)::BIGINT AS units_returned,
               {percent("coalesce(sum(returned), 0)", "sum(quantity)")} AS return_rate_percent
        FROM sale LEFT JOIN returned USING (line_item_id) GROUP BY ALL""",
    "quota_attainment_rep_month": f"""
        WITH actual AS (SELECT sales_rep_id, employee_code, rep_name, {OD_YMN}, sum(net_c) AS n FROM sale GROUP BY ALL),
        target AS ({_QUOTA.format(YM.format("quota_date"))})
        SELECT year, month, month_name, sales_rep_id, employee_code, rep_name, {money("n")} AS actual_revenue,
               {money("q")} AS quota_target, {percent("n", "q")} AS quota_attainment_percent
        FROM actual JOIN target USING (sales_rep_id, year, month)""",
    "order_frequency_by_tier": f"""
        WITH seen AS (SELECT customer_id, account_tier, {OD_YQ}, count(*) AS n
                      FROM fact_sales_orders JOIN dim_customers USING (customer_id) GROUP BY ALL)
        SELECT account_tier, year, quarter, count(*) AS customers_in_tier, sum(n)::BIGINT AS total_orders,
               {frac("sum(n)", "count(*)")} AS average_order_frequency
        FROM seen GROUP BY ALL""",
    "top_products_per_country": f"""
        WITH sold AS (SELECT country_name, product_id, product_sku, product_name, sum(net_c) AS n
                      FROM sale WHERE year(line_date) = 2000 GROUP BY ALL),
        placed AS (SELECT *, row_number() OVER (PARTITION BY country_name ORDER BY n DESC, product_id) AS place FROM sold)
        SELECT country_name, product_id, product_sku, product_name, {money("n")} AS net_revenue, place::INT AS product_rank
        FROM placed WHERE place <= 10""",
    "customer_retention_by_year": f"""
        WITH marked AS (
            SELECT year(a.order_date)::INT AS year, a.customer_id, bool_or(b.order_id IS NOT NULL) AS seen_before
            FROM fact_sales_orders a LEFT JOIN fact_sales_orders b
              ON a.customer_id = b.customer_id AND b.order_date < a.order_date
            GROUP BY ALL)
        SELECT year, count(*) AS total_customers, count_if(seen_before)::BIGINT AS returning_customers,
               {percent("count_if(seen_before)", "count(*)")} AS retention_rate_percent
        FROM marked GROUP BY year""",
    "avg_products_per_order_month": f"""
        SELECT {OD_YM}, {frac("count(*)", ORDERS, 6)} AS avg_products_per_order FROM sale GROUP BY 1, 2""",
    "discount_impact_month": f"""
        SELECT {LD_YM}, {money("sum(gross_c)")} AS total_gross, {NET} AS total_net,
               {money("sum(gross_c - net_c)")} AS total_discount_value
        FROM line GROUP BY 1, 2""",
    "top_rep_per_country": f"""
        SELECT country_name, sales_rep_id, rep_name, {money("n")} AS total_revenue
        FROM (SELECT country_name, sales_rep_id, rep_name, sum(net_c) AS n FROM sale GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY country_name ORDER BY n DESC, sales_rep_id) = 1""",
    "avg_discount_by_category": f"""
        SELECT category_name, {frac("sum(rate_bp)", "count(*) * 100", 6)} AS avg_discount_percent
        FROM sale GROUP BY category_name""",
    "yoy_growth_by_country": f"""
        WITH yearly AS (SELECT country_name, year(line_date)::INT AS year, sum(net_c) AS n FROM sale GROUP BY ALL),
        paired AS (SELECT *, lag(n) OVER (PARTITION BY country_name ORDER BY year) AS b FROM yearly)
        SELECT country_name, year, {money("n")} AS total_revenue, {money("b")} AS previous_year_revenue,
               {money("n - b")} AS revenue_growth
        FROM paired""",
    "reps_high_revenue_low_attainment": f"""
        WITH actual AS (SELECT sales_rep_id, employee_code, rep_name, {OD_YQ}, sum(net_c) AS n FROM sale GROUP BY ALL),
        target AS ({_QUOTA.format(YQ.format("quota_date"))})
        SELECT year, quarter, sales_rep_id, employee_code, rep_name, {money("n")} AS net_revenue,
               {money("q")} AS quota_target, {percent("n", "q")} AS quota_attainment_percent
        FROM actual JOIN target USING (sales_rep_id, year, quarter)
        WHERE n > 50000000 AND n * 100 < q * 80""",
    "low_margin_high_return_categories": f"""
        SELECT category_name, {money("n")} AS net_revenue, {money("k")} AS total_cost,
               {percent("n - k", "n")} AS gross_margin_percent, u::BIGINT AS units_sold, r::BIGINT AS units_returned,
               {percent("r", "u")} AS return_rate_percent
        FROM ({_MARGIN_BY_CATEGORY}) WHERE (n - k) * 100 < n * 25 AND r * 100 > u * 7""",
    "frequent_low_value_customers": f"""
        SELECT customer_id, any_value(customer_code) AS customer_code, any_value(account_tier) AS account_tier,
               {ORDERS} AS total_orders, {NET} AS total_revenue, {REVENUE_PER_ORDER} AS average_order_value
        FROM sale WHERE order_date >= {AS_OF} - INTERVAL 1 YEAR AND order_date < {AS_OF}
        GROUP BY customer_id HAVING {ORDERS} > 2 AND sum(net_c) < {ORDERS} * 25000000""",
}

_MISMATCH = """
    SELECT order_id, customer_id, customer_code, account_tier, o.sales_rep_id AS processing_sales_rep_id,
           a.employee_code AS processing_employee_code, a.rep_name AS processing_rep_name,
           w.sales_rep_id AS assigned_sales_rep_id, b.employee_code AS assigned_employee_code,
           b.rep_name AS assigned_rep_name, order_date, order_status
    FROM fact_sales_orders o
    JOIN dim_customers USING (customer_id)
    JOIN rep_customer_assignments w USING (customer_id)
    JOIN dim_sales_reps a ON a.sales_rep_id = o.sales_rep_id
    JOIN dim_sales_reps b ON b.sales_rep_id = w.sales_rep_id
    WHERE order_date BETWEEN w.valid_from AND coalesce(w.valid_to, DATE '9999-12-31')
      AND o.sales_rep_id <> w.sales_rep_id"""

JOINS = {
    "full_order_summary": f"""
        SELECT order_id, line_item_id, order_date, ship_date, order_status, payment_terms, document_type, sales_org,
               distribution_channel, customer_id, customer_code, customer_type, customer_group, account_tier,
               country_name, region_name, territory_name, sales_rep_id, employee_code, rep_name, job_title,
               product_id, product_sku, product_name, brand, product_type, quantity,
               {money("price_c", 18)} AS unit_price, CAST(rate_bp / 10000.0 AS DECIMAL(5,4)) AS discount,
               {money("gross_c", 18)} AS gross_amount, {money("net_c", 18)} AS net_amount
        FROM sale""",
    "orphan_customers": """
        SELECT customer_id, customer_code, customer_type, customer_group, customer_status, account_tier,
               credit_limit, is_active, created_at, country_name, region_name, territory_name
        FROM dim_customers JOIN dim_regions USING (region_id)
        WHERE customer_id NOT IN (SELECT customer_id FROM fact_sales_orders)""",
    "rep_customer_mismatch": _MISMATCH,
    "rep_customer_mismatch_top": f"{_MISMATCH} ORDER BY order_date DESC, customer_code, order_id, assigned_sales_rep_id LIMIT 100",
    "revenue_rollup_geography": f"""
        SELECT CASE WHEN grouping(country_name) = 1 THEN 'GRAND TOTAL' ELSE country_name END AS country_name,
               CASE WHEN grouping(region_name) = 1 THEN 'ALL REGIONS' ELSE region_name END AS region_name,
               CASE WHEN grouping(territory_name) = 1 THEN 'ALL TERRITORIES' ELSE territory_name END AS territory_name,
               {NET} AS total_revenue
        FROM (SELECT s.country_name, s.region_name, s.territory_name, net_c FROM sale s) AS s
        GROUP BY ROLLUP (s.country_name, s.region_name, s.territory_name)""",
    "line_margin_detail": f"""
        SELECT line_item_id, order_id, product_id, product_sku, product_name, brand, quantity,
               {money("cost_c", 18)} AS unit_cost, {money("price_c", 18)} AS unit_price,
               CAST(rate_bp / 10000.0 AS DECIMAL(5,4)) AS discount,
               {per("net_c", "quantity")} AS actual_sell_price_per_unit,
               {per("net_c - line_cost_c", "quantity")} AS margin_per_unit,
               {money("net_c - line_cost_c", 18)} AS total_margin,
               {percent("net_c - line_cost_c", "net_c")} AS margin_percent
        FROM sale""",
    "unordered_products_12m": f"""
        SELECT product_id, product_sku, product_name, brand, product_type, product_status, stock_level,
               {money("list_c", 18)} AS list_price, {money("cost_c", 18)} AS unit_cost, is_active
        FROM product
        WHERE is_active AND product_id NOT IN (
            SELECT product_id FROM line WHERE line_date >= {AS_OF} - INTERVAL 12 MONTH)""",
    "delivery_exceptions": f"""
        SELECT order_id, customer_code, country_name, rep_name, order_date, ship_date,
               (ship_date - order_date)::INT AS shipping_delay_days, {NET} AS order_net_value
        FROM sale WHERE order_status <> 'Cancelled' AND ship_date - order_date > 14 GROUP BY ALL""",
    "returns_detail": f"""
        SELECT return_id, return_date, order_id, customer_code, product_name, category_name, return_quantity,
               {money("credit_c", 18)} AS credit_amount, return_reason
        FROM ret JOIN sale USING (line_item_id)""",
    "customer_revenue_assigned_rep": f"""
        WITH spent AS (SELECT customer_id, customer_code, sum(net_c) AS n FROM sale GROUP BY ALL)
        SELECT customer_id, customer_code, {money("n")} AS total_revenue, rep_name AS assigned_sales_rep
        FROM spent LEFT JOIN (SELECT * FROM rep_customer_assignments WHERE is_active) USING (customer_id)
        LEFT JOIN dim_sales_reps USING (sales_rep_id)""",
    "multi_product_orders": f"""
        SELECT order_id, customer_code, count(DISTINCT product_id) AS number_of_products, {NET} AS total_order_value
        FROM sale GROUP BY ALL HAVING count(DISTINCT product_id) > 1""",
    "revenue_category_country": f"""
        SELECT category_name, country_name, {NET} AS total_revenue FROM sale GROUP BY ALL""",
    "high_spend_customers": f"""
        SELECT customer_id, customer_code, country_name, {NET} AS total_spent
        FROM sale GROUP BY ALL HAVING sum(net_c) > 250000000""",
}

_CUSTOMER_REVENUE = "SELECT customer_id, country_name, sum(net_c) AS n FROM sale GROUP BY ALL"

ADVANCED = {
    "rfm_segmentation": f"""
        WITH spent AS (
            SELECT customer_id, ({AS_OF} - max(order_date))::INT AS recency, {ORDERS} AS frequency, sum(net_c) AS n
            FROM sale WHERE order_date > {AS_OF} - INTERVAL 1 YEAR GROUP BY customer_id)
        SELECT customer_id, recency, frequency, {money("n")} AS monetary,
               CASE WHEN recency <= 30 AND frequency >= 3 AND n >= 1000000 THEN 'Champions'
                    WHEN recency <= 60 AND frequency >= 2 THEN 'Loyal'
                    WHEN recency > 90 AND frequency < 3 THEN 'At Risk'
                    WHEN recency > 180 THEN 'Lost' ELSE 'New' END AS customer_segment
        FROM spent""",
    "mom_revenue_by_country": f"""
        WITH monthly AS (SELECT country_name, {LD_YM}, sum(net_c) AS n FROM sale GROUP BY ALL),
        paired AS (SELECT *, lag(n) OVER (PARTITION BY country_name ORDER BY year, month) AS b FROM monthly)
        SELECT country_name, year, month, {money("n")} AS current_revenue, {money("b")} AS previous_revenue,
               {money("n - b")} AS revenue_change, {percent("n - b", "b", 6)} AS percentage_change
        FROM paired""",
    "running_total_by_quarter": f"""
        WITH valued AS (SELECT region_name, {OD_YQ}, order_id, sum(net_c) AS n FROM sale GROUP BY ALL)
        SELECT region_name, year, quarter, order_id, {money("n")} AS order_revenue,
               {money("sum(n) OVER (PARTITION BY region_name, year, quarter ORDER BY order_id ROWS UNBOUNDED PRECEDING)")} AS running_total
        FROM valued""",
    "rep_attainment_rank": f"""
        WITH crossed AS (
            SELECT rep_region AS region_name, s.sales_rep_id, rep_name, sum(net_c) AS n, sum(quota_c) AS q
            FROM sale s JOIN quota k ON k.sales_rep_id = s.sales_rep_id AND year(quota_date) = 2000 GROUP BY ALL),
        rated AS (SELECT *, {half_up("n * 100000000", "q")} AS micro FROM crossed)
        SELECT region_name, sales_rep_id, rep_name, {money("n")} AS actual_revenue, {money("q")} AS quota,
               CAST(micro / 1000000.0 AS DECIMAL(18,6)) AS attainment,
               rank() OVER (PARTITION BY region_name ORDER BY micro DESC) AS rank_in_region,
               CAST({half_up("sum(micro) OVER (PARTITION BY region_name)", "count(*) OVER (PARTITION BY region_name)")} / 1000000.0 AS DECIMAL(18,6)) AS region_avg
        FROM rated""",
    "top_customer_per_country": f"""
        WITH spent AS (SELECT country_name, customer_id, customer_code, account_tier, sum(net_c) AS n
                       FROM sale WHERE year(order_date) = 2001 GROUP BY ALL)
        SELECT country_name, customer_id, customer_code, account_tier, {money("n")} AS total_revenue
        FROM spent QUALIFY row_number() OVER (PARTITION BY country_name ORDER BY n DESC, customer_id) = 1""",
    "products_not_ordered_high_rev_regions": """
        WITH strong AS (SELECT region_name FROM sale WHERE year(line_date) = 2000
                        GROUP BY region_name HAVING sum(net_c) > 100000000)
        SELECT product_id, product_name FROM product
        WHERE product_id NOT IN (SELECT product_id FROM sale WHERE region_name IN (SELECT region_name FROM strong))""",
    "customer_lifetime_rank": f"""
        SELECT customer_id, country_name, {money("n")} AS lifetime_revenue,
               rank() OVER (PARTITION BY country_name ORDER BY n DESC) AS rank_in_country
        FROM ({_CUSTOMER_REVENUE})""",
    "days_between_orders": """
        WITH paired AS (
            SELECT customer_id, order_date,
                   lag(order_date) OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS previous_order_date
            FROM fact_sales_orders)
        SELECT *, (order_date - previous_order_date)::INT AS days_between_orders
        FROM paired WHERE previous_order_date IS NOT NULL""",
    "top3_customers_country_quarter": f"""
        WITH spent AS (SELECT country_name, {OD_YQ}, customer_id, customer_code, account_tier, sum(net_c) AS n
                       FROM sale GROUP BY ALL),
        ranked AS (SELECT *, dense_rank() OVER (PARTITION BY country_name, year, quarter ORDER BY n DESC) AS place FROM spent)
        SELECT country_name, year, quarter, customer_id, customer_code, account_tier, {money("n")} AS total_revenue,
               place::INT AS revenue_rank
        FROM ranked WHERE place <= 3""",
    "monthly_product_running_total": f"""
        WITH monthly AS (SELECT category_name, product_id, product_sku, product_name, {LD_YMN}, sum(net_c) AS n
                         FROM sale GROUP BY ALL)
        SELECT category_name, product_id, product_sku, product_name, year, month, month_name,
               {money("n")} AS monthly_revenue,
               {money("sum(n) OVER (PARTITION BY product_id, year ORDER BY month ROWS UNBOUNDED PRECEDING)")} AS running_year_total
        FROM monthly""",
    "customer_360_candidate": f"""
        WITH bought AS (
            SELECT customer_id, {ORDERS} AS order_count, sum(net_c) AS n, max(order_date) AS last_order_date
            FROM valid_sale GROUP BY customer_id),
        sent_back AS (
            SELECT customer_id, count(*) AS cases, sum(credit_c) AS credit_c FROM ret JOIN sale USING (line_item_id) GROUP BY customer_id),
        owner AS (
            SELECT customer_id, rep_name FROM rep_customer_assignments w JOIN dim_sales_reps USING (sales_rep_id)
            WHERE w.is_active AND w.valid_from <= {AS_OF} AND coalesce(w.valid_to, {AS_OF}) >= {AS_OF}
            QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY w.valid_from DESC, assignment_id DESC) = 1)
        SELECT customer_id, customer_code, customer_name, account_tier, country_name, rep_name AS assigned_rep_name,
               order_count, {money("n")} AS lifetime_revenue, {per("n", "order_count")} AS average_order_value,
               last_order_date, ({AS_OF} - last_order_date)::INT AS days_since_last_order,
               coalesce(cases, 0) AS return_count, {money("coalesce(credit_c, 0)")} AS total_credit_amount,
               dense_rank() OVER (PARTITION BY country_name ORDER BY n DESC) AS lifetime_revenue_rank_in_country
        FROM bought JOIN dim_customers USING (customer_id) JOIN dim_regions USING (region_id)
        LEFT JOIN sent_back USING (customer_id) LEFT JOIN owner USING (customer_id)""",
    "monthly_country_trend": f"""
        WITH monthly AS (SELECT {OD_YMN}, country_name, {ORDERS} AS order_volume, sum(net_c) AS n
                         FROM valid_sale GROUP BY ALL),
        paired AS (SELECT *, lag(n) OVER (PARTITION BY country_name ORDER BY year, month) AS b,
                          sum(n) OVER (PARTITION BY country_name, year ORDER BY month ROWS UNBOUNDED PRECEDING) AS t
                   FROM monthly)
        SELECT year, month, month_name, country_name, order_volume, {money("n")} AS net_revenue,
               {per("n", "order_volume")} AS average_order_value, {money("b")} AS previous_month_revenue,
               {money("n - b")} AS revenue_change, {percent("n - b", "b")} AS revenue_change_percent,
               {money("t")} AS running_year_revenue
        FROM paired""",
}

_BASE_LINE = f"""
    SELECT line_item_id, order_id, order_status, customer_id, country_name AS customer_country_name, sales_rep_id,
           rep_country AS sales_country_name, rep_region AS sales_region_name, product_id, product_sku, product_name,
           category_name, line_date AS order_date, year(line_date)::INT AS order_year,
           quarter(line_date)::INT AS order_quarter, month(line_date)::INT AS order_month,
           monthname(line_date) AS order_month_name, quantity, {money("net_c", 18)} AS net_amount,
           {money("net_c - line_cost_c", 18)} AS gross_profit
    FROM sale"""
_EXECUTIVE = f"""
    WITH metrics AS (
        SELECT {PERIOD.format("line_date")}, rep_country AS country_name, rep_region AS region_name,
               {ORDERS} AS orders, sum(net_c) AS n, sum(net_c - line_cost_c) AS g, 0 AS q
        FROM valid_sale GROUP BY ALL
        UNION ALL
        SELECT {PERIOD.format("quota_date")}, country_name, region_name, 0, 0, 0, sum(quota_c)
        FROM quota JOIN dim_sales_reps USING (sales_rep_id) JOIN dim_regions USING (region_id)
        WHERE quota_period = 'Monthly' GROUP BY ALL),
    summed AS (SELECT period_start_date, country_name, region_name, sum(orders) AS o, sum(n) AS n, sum(g) AS g, sum(q) AS q
               FROM metrics GROUP BY ALL)
    SELECT {_calendar("period_start_date", True)}, country_name, region_name, o::BIGINT AS order_count,
           {money("n")} AS total_revenue, {money("g")} AS gross_profit, {percent("g", "n")} AS gross_margin_percent,
           {per("n", "o")} AS average_order_value, {money("q")} AS quota_amount,
           {percent("n", "q")} AS quota_attainment_percent
    FROM summed"""
_CUSTOMER_360 = f"""
    WITH bought AS (
        SELECT customer_id, sum(net_c) AS n, {ORDERS} AS orders, max(line_date) AS last_day, sum(quantity) AS u,
               count(DISTINCT order_id) FILTER (line_date >= {AS_OF} - INTERVAL 1 YEAR) AS f,
               coalesce(sum(net_c) FILTER (line_date >= {AS_OF} - INTERVAL 1 YEAR), 0) AS m
        FROM valid_sale GROUP BY customer_id),
    sent_back AS (
        SELECT customer_id, sum(return_quantity) AS r FROM ret JOIN valid_sale USING (line_item_id) GROUP BY customer_id),
    owner AS (
        SELECT customer_id, rep_name FROM rep_customer_assignments w JOIN dim_sales_reps USING (sales_rep_id)
        WHERE w.valid_from <= {AS_OF} AND coalesce(w.valid_to, {AS_OF}) >= {AS_OF}
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY w.is_active DESC, w.valid_from DESC, assignment_id DESC) = 1),
    joined AS (
        SELECT customer_id, customer_code, customer_name, account_tier, rep_name, coalesce(n, 0) AS n, orders, last_day,
               coalesce(u, 0) AS u, coalesce(f, 0) AS f, coalesce(m, 0) AS m, coalesce(r, 0) AS r,
               {AS_OF} - last_day AS idle
        FROM dim_customers LEFT JOIN bought USING (customer_id) LEFT JOIN sent_back USING (customer_id)
        LEFT JOIN owner USING (customer_id))
    SELECT customer_id, customer_code, customer_name, account_tier, rep_name AS assigned_rep_name,
           {money("n")} AS lifetime_revenue, f AS order_frequency_last_12_months, last_day AS last_order_date,
           coalesce({per("n", "orders")}, 0) AS average_order_value, {percent("r", "u")} AS return_rate_percent,
           CASE WHEN last_day IS NULL THEN 'Lost'
                WHEN idle <= 30 AND f <= 2 THEN 'New'
                WHEN idle <= 60 AND f >= 3 AND m >= 1500000 THEN 'Champions'
                WHEN idle <= 90 AND f >= 2 AND m >= 800000 THEN 'Loyal'
                WHEN idle > 90 AND (f >= 2 OR m >= 800000) THEN 'At Risk'
                ELSE 'Lost' END AS rfm_segment
    FROM joined"""
_PRODUCT = f"""
    WITH sold AS (
        SELECT product_id, product_sku, product_name, category_name, sum(quantity) AS u, sum(net_c) AS n,
               sum(line_cost_c) AS k, coalesce(sum(returned), 0) AS r
        FROM valid_sale LEFT JOIN returned USING (line_item_id) GROUP BY ALL)
    SELECT product_id, product_sku, product_name, category_name, u::BIGINT AS total_units_sold,
           {money("n")} AS net_revenue, {percent("n - k", "n")} AS gross_margin_percent,
           {percent("r", "u")} AS return_rate_percent,
           dense_rank() OVER (PARTITION BY category_name ORDER BY n DESC, product_id) AS category_revenue_rank
    FROM sold"""
_REP = f"""
    WITH done AS (
        SELECT sales_rep_id,
               coalesce(sum(net_c) FILTER (quarter(line_date) = quarter({AS_OF})), 0) AS qn,
               count(DISTINCT customer_id) FILTER (quarter(line_date) = quarter({AS_OF})) AS qc,
               sum(net_c) AS yn, count(DISTINCT customer_id) AS yc
        FROM valid_sale WHERE year(line_date) = 2001 AND line_date <= {AS_OF} GROUP BY sales_rep_id),
    due AS (
        SELECT sales_rep_id, coalesce(sum(quota_c) FILTER (quarter(quota_date) = quarter({AS_OF})), 0) AS qq, sum(quota_c) AS yq
        FROM quota WHERE quota_period = 'Monthly' AND year(quota_date) = 2001 AND quota_date <= {AS_OF}
        GROUP BY sales_rep_id),
    card AS (
        SELECT sales_rep_id, employee_code, rep_name, region_name, coalesce(qn, 0) AS qn, coalesce(qq, 0) AS qq,
               coalesce(qc, 0) AS qc, coalesce(yn, 0) AS yn, coalesce(yq, 0) AS yq, coalesce(yc, 0) AS yc
        FROM dim_sales_reps JOIN dim_regions USING (region_id)
        LEFT JOIN done USING (sales_rep_id) LEFT JOIN due USING (sales_rep_id) WHERE is_active),
    rated AS (SELECT *, {percent("qn", "qq")} AS qa, {percent("yn", "yq")} AS ya FROM card)
    SELECT sales_rep_id, employee_code, rep_name, region_name, {money("qn")} AS quarter_to_date_actual_revenue,
           {money("qq")} AS quarter_to_date_quota, qa AS quarter_to_date_attainment_percent,
           qc AS quarter_to_date_customer_count,
           rank() OVER (PARTITION BY region_name ORDER BY qa DESC NULLS LAST, qn DESC, sales_rep_id) AS quarter_rank_in_region,
           {money("yn")} AS year_to_date_actual_revenue, {money("yq")} AS year_to_date_quota,
           ya AS year_to_date_attainment_percent, yc AS year_to_date_customer_count
    FROM rated"""
_TREND = f"""
    WITH monthly AS (SELECT {PERIOD.format("line_date")}, country_name, {ORDERS} AS o, sum(net_c) AS n
                     FROM valid_sale GROUP BY ALL),
    paired AS (SELECT *, lag(n) OVER (PARTITION BY country_name ORDER BY period_start_date) AS b FROM monthly)
    SELECT {_calendar("period_start_date")}, country_name, o AS order_volume, {money("n")} AS net_revenue,
           {per("n", "o")} AS average_order_value, {percent("n - b", "b")} AS revenue_change_percent
    FROM paired"""
_RETURNS = f"""
    WITH sold AS (
        SELECT {PERIOD.format("line_date")}, country_name, category_name, sum(quantity) AS u FROM valid_sale GROUP BY ALL),
    back AS (
        SELECT {PERIOD.format("line_date")}, country_name, category_name, return_reason,
               sum(return_quantity) AS r, sum(credit_c) AS credit_c
        FROM ret JOIN valid_sale USING (line_item_id) GROUP BY ALL)
    SELECT {_calendar("period_start_date")}, country_name, category_name, return_reason,
           {percent("r", "u")} AS return_rate_percent, {money("credit_c")} AS total_credit_note_value
    FROM back LEFT JOIN sold USING (period_start_date, country_name, category_name)"""
_CHANNEL = f"""
    SELECT region_name, country_name, account_tier, {OD_YM}, sum(net_c) AS n, sum(quantity) AS u,
           count(DISTINCT customer_id) AS customer_count
    FROM sale GROUP BY ALL"""
_CHANNEL_COLUMNS = f"""region_name, country_name, account_tier, year, month, {money("n")} AS total_revenue,
    u::BIGINT AS total_units, customer_count"""
_ORDER_SUMMARY = f"SELECT sales_rep_id, rep_name, {OD_YM}, {ORDERS} AS o, sum(quantity) AS u, sum(net_c) AS n FROM sale GROUP BY ALL"
_ORDER_COLUMNS = f"year, month, o AS total_orders, u::BIGINT AS total_units, {money('n')} AS total_revenue"
_COUNTRY_CATEGORY = f"""
    SELECT country_name, category_name, {OD_YM}, {ORDERS} AS total_orders, sum(quantity)::BIGINT AS total_units_sold,
           {NET} AS total_revenue
    FROM sale GROUP BY ALL"""
_INVENTORY = f"""
    SELECT p.product_id, p.product_sku, p.product_name, p.brand, p.stock_level, {ORDERS} AS total_orders,
           coalesce(sum(quantity), 0)::BIGINT AS total_units_sold, {money("coalesce(sum(net_c), 0)")} AS total_revenue
    FROM product p LEFT JOIN line ON line.product_id = p.product_id GROUP BY ALL"""

VIEWS = {
    "vw_base_order_line_detail": _BASE_LINE,
    "vw_base_quota_detail": f"""
        SELECT sales_rep_id, country_name AS sales_country_name, region_name AS sales_region_name, quota_date,
               year(quota_date)::INT AS quota_year, quarter(quota_date)::INT AS quota_quarter,
               month(quota_date)::INT AS quota_month, monthname(quota_date) AS quota_month_name, quota_period,
               {money("quota_c", 18)} AS quota_amount
        FROM quota JOIN dim_sales_reps USING (sales_rep_id) JOIN dim_regions USING (region_id)""",
    "vw_base_return_detail": f"""
        SELECT line_item_id, return_quantity, {money("credit_c", 18)} AS credit_amount, return_reason, return_date,
               year(return_date)::INT AS return_year, month(return_date)::INT AS return_month,
               monthname(return_date) AS return_month_name, line_date AS sale_date, year(line_date)::INT AS sale_year,
               month(line_date)::INT AS sale_month, monthname(line_date) AS sale_month_name, order_status, customer_id,
               country_name AS customer_country_name, product_id, category_name, quantity AS sold_quantity
        FROM ret JOIN sale USING (line_item_id)""",
    "vw_base_channel": f"""
        SELECT order_id, customer_id, account_tier, region_name, country_name, {OD_YM}, quantity,
               {money("net_c", 18)} AS net_amount
        FROM sale""",
    "vw_base_orders": f"SELECT order_id, sales_rep_id, {OD_YM}, quantity, {money('net_c', 18)} AS net_amount FROM sale",
    "vw_base_country_category_sales": f"""
        SELECT order_id, {OD_YM}, country_name, category_name, quantity, {money("net_c", 18)} AS net_amount FROM sale""",
    "vw_base_inventory_risk": f"""
        SELECT p.product_id, p.product_sku, p.product_name, p.brand, p.stock_level, order_id, {OD_YM}, quantity,
               {money("net_c", 18)} AS net_amount
        FROM product p LEFT JOIN (SELECT product_id, order_id, line_date AS order_date, quantity, net_c FROM line) l
          ON l.product_id = p.product_id""",
    "vw_summary_sales_executive": _EXECUTIVE,
    "vw_summary_customer_360": _CUSTOMER_360,
    "vw_summary_product_performance": _PRODUCT,
    "vw_summary_rep_performance": _REP,
    "vw_summary_monthly_trend": _TREND,
    "vw_summary_returns_analysis": _RETURNS,
    "vw_channel_summary": f"SELECT {_CHANNEL_COLUMNS} FROM ({_CHANNEL})",
    "vw_order_summary": f"SELECT sales_rep_id, {_ORDER_COLUMNS} FROM ({_ORDER_SUMMARY})",
    "vw_dm_country_month_kpi_trend": f"""
        SELECT country_name, {LD_YM}, {NET} AS total_revenue, {ORDERS} AS total_orders,
               {REVENUE_PER_ORDER} AS avg_order_value
        FROM valid_sale GROUP BY ALL""",
    "vw_dm_rep_portfolio_quality": f"""
        WITH crossed AS (
            SELECT s.sales_rep_id, s.rep_name, rep_country AS country_name, rep_region AS region_name, sum(net_c) AS n,
                   count(DISTINCT customer_id) AS customer_count, coalesce(sum(quota_c), 0) AS q
            FROM valid_sale s LEFT JOIN quota k ON k.sales_rep_id = s.sales_rep_id
            WHERE year(quota_date) = 2001 OR quota_date IS NULL
            GROUP BY ALL)
        SELECT sales_rep_id, rep_name, country_name, region_name, {money("n")} AS actual_revenue, customer_count,
               {money("q")} AS quota_amount, CAST({percent("n", "q")} AS DECIMAL(10,2)) AS attainment_percentage,
               dense_rank() OVER (PARTITION BY region_name ORDER BY n DESC) AS rank_within_region
        FROM crossed""",
    "vw_country_category_sales_summary": _COUNTRY_CATEGORY,
    "vw_inventory_risk_summary": _INVENTORY,
    "vw_sales_executive_summary": _EXECUTIVE,
    "vw_customer_360": _CUSTOMER_360,
    "vw_product_performance": _PRODUCT,
    "vw_rep_performance_scorecard": _REP,
    "vw_monthly_trend": _TREND,
    "vw_returns_analysis": _RETURNS,
    "vw_sales_channel_analysis": f"SELECT {_CHANNEL_COLUMNS}, {per('n', 'customer_count', 6)} AS revenue_per_customer FROM ({_CHANNEL})",
    "vw_order_efficiency": f"""
        SELECT sales_rep_id, rep_name, {_ORDER_COLUMNS}, {frac("u", "o", 6)} AS avg_units_per_order,
               {per("n", "o", 6)} AS avg_order_value
        FROM ({_ORDER_SUMMARY})""",
    "vw_country_category_sales": _COUNTRY_CATEGORY,
    "vw_inventory_risk_report": _INVENTORY,
}


def _nest(statement: str, outer: str) -> str:
    """``outer`` over a statement that may have its own WITH list."""
    return outer.format(f"({statement})")


PREVIEWS = {
    f"preview_{view}": _nest(VIEWS[view], f"SELECT {columns} FROM {{0}} ORDER BY {order} LIMIT 10")
    for view, columns, order in (
        (
            "vw_sales_executive_summary",
            "period_start_date, country_name, region_name, total_revenue, gross_margin_percent, quota_attainment_percent",
            "period_start_date DESC, country_name, region_name",
        ),
        (
            "vw_customer_360",
            "customer_code, customer_name, assigned_rep_name, lifetime_revenue, order_frequency_last_12_months, rfm_segment",
            "lifetime_revenue DESC, customer_code",
        ),
        (
            "vw_product_performance",
            "product_sku, product_name, category_name, total_units_sold, net_revenue, category_revenue_rank",
            "net_revenue DESC, product_sku",
        ),
        (
            "vw_rep_performance_scorecard",
            "employee_code, rep_name, region_name, quarter_to_date_actual_revenue, quarter_to_date_attainment_percent, quarter_rank_in_region",
            "quarter_rank_in_region, rep_name, employee_code",
        ),
        (
            "vw_monthly_trend",
            "period_start_date, country_name, net_revenue, order_volume, average_order_value, revenue_change_percent",
            "country_name, period_start_date DESC",
        ),
        (
            "vw_returns_analysis",
            "period_start_date, country_name, category_name, return_reason, return_rate_percent, total_credit_note_value",
            "period_start_date DESC, total_credit_note_value DESC, country_name, category_name, return_reason",
        ),
    )
}

_TABLES = {
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
_UNIQUE = (
    ("dim_regions", "country_name, region_name, territory_name"),
    ("dim_date", "full_date"),
    ("dim_sales_reps", "employee_code"),
    ("dim_customers", "customer_code"),
    ("dim_products", "product_sku"),
    ("rep_customer_assignments", "sales_rep_id, customer_id, valid_from"),
)
_REFERENCES = (
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
# table, rule name, condition that breaks it
_BROKEN = (
    ("dim_date", "quarter_range", "quarter < 1 OR quarter > 4"),
    ("dim_date", "month_range", "month < 1 OR month > 12"),
    ("dim_date", "weekday_range", "day_of_week < 1 OR day_of_week > 7"),
    ("dim_sales_reps", "window_order", "valid_to < valid_from"),
    ("dim_customers", "credit_not_negative", "credit_limit < 0"),
    ("dim_customers", "tier_known", "account_tier NOT IN ('Gold', 'Silver', 'Bronze')"),
    ("dim_products", "stock_not_negative", "stock_level < 0"),
    ("dim_products", "cost_positive", "unit_cost <= 0"),
    ("dim_products", "price_positive", "list_price <= 0"),
    ("dim_products", "window_order", "valid_to < valid_from"),
    ("dim_products", "price_covers_cost", "list_price < unit_cost"),
    (
        "fact_sales_orders",
        "status_known",
        "order_status NOT IN ('Pending', 'Confirmed', 'Partially Delivered', 'Delivered', 'Cancelled')",
    ),
    ("fact_sales_orders", "ship_after_order", "ship_date < order_date"),
    ("fact_order_line_items", "quantity_positive", "quantity <= 0"),
    ("fact_order_line_items", "price_positive", "unit_price <= 0"),
    ("fact_order_line_items", "discount_range", "discount < 0 OR discount > 1"),
    ("fact_order_line_items", "gross_not_negative", "gross_amount < 0"),
    ("fact_order_line_items", "net_not_negative", "net_amount < 0"),
    ("fact_returns", "quantity_positive", "return_quantity <= 0"),
    ("fact_returns", "credit_not_negative", "credit_amount < 0"),
    ("fact_quotas", "amount_not_negative", "quota_amount < 0"),
    ("fact_quotas", "period_known", "quota_period NOT IN ('Monthly', 'Quarterly')"),
    ("rep_customer_assignments", "window_order", "valid_to < valid_from"),
    ("product_promotions", "rate_range", "discount_rate < 0 OR discount_rate > 1"),
    ("product_promotions", "window_order", "valid_to < valid_from"),
)
_DATED = (
    ("fact_sales_orders", "order_date"),
    ("fact_sales_orders", "ship_date"),
    ("fact_order_line_items", "line_date"),
    ("fact_returns", "return_date"),
    ("fact_quotas", "quota_date"),
)
_REVENUE_COLUMNS = {
    "vw_sales_executive_summary": "total_revenue",
    "vw_customer_360": "lifetime_revenue",
    "vw_product_performance": "net_revenue",
    "vw_monthly_trend": "net_revenue",
}
_TWO_WORDS = "regexp_full_match({0}, '[^ ]+ [^ ]+')"


def _all(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _orphans(child: str, column: str, parent: str, key: str) -> str:
    return f"(SELECT count(*) FROM {child} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent}))"


def _duplicates(table: str, columns: str) -> str:
    return f"(SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {table}))"


QUALITY = {
    "table_row_counts": _all(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _TABLES),
    "dq_primary_key": _all(
        f"SELECT '{t}' AS table_name, '{k}' AS key, {_duplicates(t, k)} AS violations" for t, k in _TABLES.items()
    ),
    "dq_unique": _all(
        f"SELECT '{t}' AS table_name, '{c}' AS \"constraint\", {_duplicates(t, c)} AS violations" for t, c in _UNIQUE
    ),
    "dq_foreign_key": _all(
        f"SELECT '{c}' AS table_name, '{f} -> {p}.{k}' AS \"constraint\", {_orphans(c, f, p, k)} AS violations"
        for c, f, p, k in _REFERENCES
    ),
    "dq_keys": _all(
        [f"SELECT 'primary key' AS rule, '{t}' AS table_name, '{k}' AS \"constraint\", {_duplicates(t, k)} AS violations" for t, k in _TABLES.items()]
        + [f"SELECT 'unique', '{t}', '{c}', {_duplicates(t, c)}" for t, c in _UNIQUE]
        + [f"SELECT 'reference', '{c}', '{f} -> {p}.{k}', {_orphans(c, f, p, k)}" for c, f, p, k in _REFERENCES]
    ),
    "dq_check": _all(
        f"SELECT '{t}' AS table_name, '{n}' AS \"constraint\", count(*) AS violations FROM {t} WHERE {b}"
        for t, n, b in _BROKEN
    ),
    "dq_orders_without_lines": """
        SELECT order_id FROM fact_sales_orders WHERE order_id NOT IN (SELECT order_id FROM line_raw)""",
    "dq_over_returned_lines": """
        SELECT line_item_id, quantity, returned::BIGINT AS returned
        FROM line JOIN returned USING (line_item_id) WHERE returned > quantity""",
    "dq_overlapping_assignments": """
        WITH w AS (SELECT *, coalesce(valid_to, DATE '9999-12-31') AS last_day FROM rep_customer_assignments)
        SELECT b.customer_id, b.assignment_id, a.assignment_id AS earlier_assignment_id
        FROM w b JOIN w a ON a.customer_id = b.customer_id AND a.last_day >= b.valid_from
         AND (a.valid_from < b.valid_from OR (a.valid_from = b.valid_from AND a.assignment_id < b.assignment_id))
        QUALIFY row_number() OVER (
            PARTITION BY b.assignment_id
            ORDER BY a.valid_from < b.valid_from DESC,
                     CASE WHEN a.valid_from < b.valid_from THEN a.last_day END DESC NULLS LAST,
                     CASE WHEN a.valid_from < b.valid_from THEN -a.assignment_id ELSE a.assignment_id END) = 1""",
    "dq_date_coverage": _all(
        [
            f"""SELECT '{t}.{c}' AS source, count(DISTINCT {c}) AS days_used,
                count(DISTINCT {c}) FILTER ({c} NOT IN (SELECT full_date FROM dim_date)) AS days_missing FROM {t}"""
            for t, c in _DATED
        ]
        + [
            "SELECT 'dim_date', count(DISTINCT full_date), max(full_date) - min(full_date) + 1 - count(DISTINCT full_date) FROM dim_date"
        ]
    ),
    "dq_date_gaps": _all(
        [
            f"""SELECT '{t}.{c}' AS source, min(d) AS first_day, max(d) AS last_day, count(*) AS days
                FROM (SELECT d, d - row_number() OVER (ORDER BY d)::INT AS run
                      FROM (SELECT DISTINCT {c} AS d FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT full_date FROM dim_date)))
                GROUP BY run"""
            for t, c in _DATED
        ]
        + [
            """SELECT 'dim_date', a + 1, b - 1, b - a - 1
               FROM (SELECT full_date AS b, lag(full_date) OVER (ORDER BY full_date) AS a FROM (SELECT DISTINCT full_date FROM dim_date))
               WHERE b - a > 1"""
        ]
    ),
    "dq_orphan_facts": "SELECT table_name, sum(v)::BIGINT AS violations FROM ("
    + _all(f"SELECT '{c}' AS table_name, {_orphans(c, f, p, k)} AS v" for c, f, p, k in _REFERENCES if c.startswith("fact_"))
    + ") GROUP BY table_name",
    "dq_cancelled_exclusion": "SELECT view_name, view_total, base_total, CAST(view_total - base_total AS DECIMAL(28,2)) AS diff FROM ("
    + _all(
        f"SELECT '{v}' AS view_name, CAST(sum({c}) AS DECIMAL(28,2)) AS view_total FROM ({VIEWS[v]})"
        for v, c in _REVENUE_COLUMNS.items()
    )
    + f") CROSS JOIN (SELECT {NET} AS base_total FROM valid_sale)",
    "dq_customer_name_shape": f"SELECT * FROM dim_customers WHERE NOT {_TWO_WORDS.format('customer_name')}",
    "dq_product_name_shape": f"SELECT * FROM dim_products WHERE {_TWO_WORDS.format('product_name')}",
    "promotion_on_line": """
        SELECT line_item_id, product_id, line_date, promotion_id, discount_rate
        FROM line JOIN product_promotions m USING (product_id)
        WHERE line_date BETWEEN m.valid_from AND coalesce(m.valid_to, DATE '9999-12-31')
        QUALIFY row_number() OVER (
            PARTITION BY line_item_id
            ORDER BY m.valid_from DESC, coalesce(m.valid_to, DATE '9999-12-31') DESC, promotion_id DESC) = 1""",
    "promotion_per_line": """
        SELECT line_item_id, line.product_id, line_date, promotion_id, discount_rate
        FROM line LEFT JOIN product_promotions m
          ON m.product_id = line.product_id
         AND line_date BETWEEN m.valid_from AND coalesce(m.valid_to, DATE '9999-12-31')
        QUALIFY row_number() OVER (
            PARTITION BY line_item_id
            ORDER BY m.valid_from DESC NULLS LAST, coalesce(m.valid_to, DATE '9999-12-31') DESC, promotion_id DESC) = 1""",
    "view_smoke_counts": _all(
        f"SELECT '{v}' AS view_name, count(*) AS row_count FROM ({VIEWS[v]})"
        for v in (
            "vw_sales_executive_summary",
            "vw_customer_360",
            "vw_product_performance",
            "vw_rep_performance_scorecard",
            "vw_monthly_trend",
            "vw_returns_analysis",
        )
    ),
}
QUALITY.update({f"star_{t}": f"SELECT * FROM {t}" for t in _TABLES})

# Anti joins, which would find nothing under the true keys.
SPARE_KEYS = ("orphan_customers", "active_products_never_ordered", "unordered_products_12m", "products_not_ordered_high_rev_regions")

STATEMENTS = {
    name: with_mart(body, name in SPARE_KEYS)
    for group in (BASIC, AGGREGATES, JOINS, ADVANCED, VIEWS, PREVIEWS, QUALITY)
    for name, body in group.items()
}
