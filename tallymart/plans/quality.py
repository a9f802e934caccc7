"""Data-quality jobs: the mart's declared rules, each as a query for its violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart import schema
from tallymart.functions.money import TOTAL, total, units, zero
from tallymart.operators.validity import newest_valid, overlapping
from tallymart.params import ReportParams
from tallymart.plans import views
from tallymart.plans.advanced import NOT_CANCELLED
from tallymart.sources.star import Star


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _column(star: Star, table: str, *cols: str) -> DataFrame:
    """Columns of a table, without work for columns that are not asked for."""
    if table == "fact_order_line_items":
        return star.lines(*cols)
    if table == "fact_returns":
        return star.returns(*cols)
    return star[table].select(*cols)


def table_row_counts(star: Star, p: ReportParams) -> DataFrame:
    """Row count of every table."""
    keys = schema.PRIMARY_KEYS
    return _union(
        [
            _column(star, t, keys[t]).select(F.lit(t).alias("table_name")).groupBy("table_name").agg(
                F.count(F.lit(1)).alias("row_count")
            )
            for t in schema.TABLES
        ]
    )


Columns = tuple[str, ...]
Reference = tuple[str, str, str, str]
PRIMARY: tuple[tuple[str, Columns], ...] = tuple((t, (k,)) for t, k in schema.PRIMARY_KEYS.items())


def _as_text(cols: Columns) -> Column:
    """A key as text, NULL if one of its columns is."""
    texts = [F.col(c).cast("string") for c in cols]
    if len(texts) == 1:
        return texts[0]
    return F.when(reduce(lambda a, b: a & b, [t.isNotNull() for t in texts]), F.to_json(F.array(*texts)))


def key_audit(star: Star, unique: Sequence[tuple[str, Columns]], references: Sequence[Reference]) -> DataFrame:
    """Violations of every given rule: rows (rule, violations), the unique rules first, then the references.

    Every table is scanned once: its row becomes one entry per rule it takes part in, of the key's domain (the
    table and columns whose values it is), the key as text, and the part: own, or the reference that uses it.
    Entries of all rules share one shuffle by domain and key, summed per task first; what repeats and what is
    not there shows in the sums.  A NULL unique key is a violation, a NULL reference refers to nothing.
    """
    domains = list(dict.fromkeys([*unique, *((parent, (key,)) for _, _, parent, key in references)]))
    users: dict[int, list[Reference]] = {i: [] for i in range(len(domains))}
    for ref in references:
        users[domains.index((ref[2], (ref[3],)))].append(ref)
    entries: dict[str, list[tuple[Columns, int, int]]] = {}
    for i, (table, cols) in enumerate(domains):
        entries.setdefault(table, []).append((cols, i, 0))
        for part, (child, column, _, _) in enumerate(users[i], 1):
            entries.setdefault(child, []).append(((column,), i, part))

    def entry(cols: Columns, domain: int, part: int) -> Column:
        return F.struct(F.lit(domain).alias("domain"), F.lit(part).alias("part"), _as_text(cols).alias("key"))

    tables = []
    for table, own in entries.items():
        rows = _column(star, table, *dict.fromkeys(c for cols, _, _ in own for c in cols))
        used = F.filter(F.array(*(entry(*e) for e in own)), lambda e: (e["part"] == 0) | e["key"].isNotNull())
        tables.append(rows.select(F.inline(used)))
    most = max((len(refs) for refs in users.values()), default=0)
    summed = _union(tables).groupBy("domain", "key").agg(
        *(F.count(F.when(F.col("part") == part, True)).alias(f"n{part}") for part in range(most + 1))
    )
    extra = F.when(F.col("key").isNull(), F.col("n0")).otherwise(F.greatest(F.col("n0") - 1, F.lit(0)))
    rules = [F.when(F.col("domain") == domains.index(rule), extra) for rule in unique]
    for ref in references:
        domain = domains.index((ref[2], (ref[3],)))
        part = users[domain].index(ref) + 1
        rules.append(F.when((F.col("domain") == domain) & (F.col("n0") == 0), F.col(f"n{part}")))
    found = summed.agg(*(zero(units(rule), "bigint").alias(f"r{i}") for i, rule in enumerate(rules)))
    return found.select(
        F.inline(F.array(*(F.struct(F.lit(i).alias("rule"), F.col(f"r{i}").alias("violations")) for i in range(len(rules)))))
    )


def _named(audit: DataFrame, rules: Sequence[Columns], *columns: str) -> DataFrame:
    """The audit with a rule's number replaced by what names it."""
    names = F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in zip(columns, rule, strict=True))) for rule in rules))
    return audit.withColumn("name", F.get(names, F.col("rule"))).select("name.*", "violations")


def _reference(ref: Reference) -> Columns:
    child, column, parent, key = ref
    return child, f"{column} -> {parent}.{key}"


def dq_primary_key(star: Star, p: ReportParams) -> DataFrame:
    """Rows with a missing or repeated primary key, per table."""
    return _named(key_audit(star, PRIMARY, ()), [(t, k) for t, (k,) in PRIMARY], "table_name", "key")


def dq_unique(star: Star, p: ReportParams) -> DataFrame:
    """Rows that repeat a unique column set."""
    rules = [(t, ", ".join(cols)) for t, cols in schema.UNIQUE]
    return _named(key_audit(star, schema.UNIQUE, ()), rules, "table_name", "constraint")


def dq_foreign_key(star: Star, p: ReportParams) -> DataFrame:
    """Child rows without a parent, per reference; a NULL key refers to nothing."""
    rules = [_reference(r) for r in schema.FOREIGN_KEYS]
    return _named(key_audit(star, (), schema.FOREIGN_KEYS), rules, "table_name", "constraint")


def dq_keys(star: Star, p: ReportParams) -> DataFrame:
    """Violations of all primary keys, unique sets and references, every table read once."""
    rules = [("primary key", t, k) for t, (k,) in PRIMARY]
    rules += [("unique", t, ", ".join(cols)) for t, cols in schema.UNIQUE]
    rules += [("reference", *_reference(r)) for r in schema.FOREIGN_KEYS]
    audit = key_audit(star, (*PRIMARY, *schema.UNIQUE), schema.FOREIGN_KEYS)
    return _named(audit, rules, "rule", "table_name", "constraint")


def dq_check(star: Star, p: ReportParams) -> DataFrame:
    """Rows that break a value rule; all rules of a table in one pass."""
    parts = []
    for table in dict.fromkeys(t for t, _, _ in schema.CHECKS):
        rules = [(name, rule) for t, name, rule in schema.CHECKS if t == table]
        broken = star[table].agg(
            *[zero(units(F.when(~F.expr(rule), 1)), "bigint").alias(name) for name, rule in rules]
        )
        wide = F.array(*[F.struct(F.lit(n).alias("constraint"), F.col(n).alias("violations")) for n, _ in rules])
        parts.append(broken.select(F.inline(wide)).select(F.lit(table).alias("table_name"), "constraint", "violations"))
    return _union(parts)


def dq_orders_without_lines(star: Star, p: ReportParams) -> DataFrame:
    """Order headers that have no line."""
    filled = star.lines("order_id").distinct()
    return star["fact_sales_orders"].select("order_id").join(filled, "order_id", "left_anti")


def dq_over_returned_lines(star: Star, p: ReportParams) -> DataFrame:
    """Lines of which more was returned than sold."""
    returned = (
        star.returns("line_item_id", "return_quantity")
        .groupBy("line_item_id")
        .agg(units("return_quantity").alias("returned"))
    )
    return (
        star.lines("line_item_id", "quantity")
        .join(returned, "line_item_id")
        .filter(F.col("returned") > F.col("quantity"))
        .select("line_item_id", "quantity", "returned")
    )


def dq_overlapping_assignments(star: Star, p: ReportParams) -> DataFrame:
    """Assignments of a customer that begin while an earlier one is still open."""
    return overlapping(star["rep_customer_assignments"], "customer_id", "assignment_id")


FACT_DATES = (
    ("fact_sales_orders", "order_date"),
    ("fact_sales_orders", "ship_date"),
    ("fact_order_line_items", "line_date"),
    ("fact_returns", "return_date"),
    ("fact_quotas", "quota_date"),
)


def dq_date_coverage(star: Star, p: ReportParams) -> DataFrame:
    """Days that facts use and days the calendar lacks, and holes in the calendar itself."""
    calendar = star["dim_date"].select("full_date")
    parts = []
    for table, column in FACT_DATES:
        used = _column(star, table, column).filter(F.col(column).isNotNull()).select(F.col(column).alias("day"))
        known = calendar.select(F.col("full_date").alias("day"), F.lit(True).alias("known"))
        used = used.distinct().join(known, "day", "left")
        parts.append(
            used.agg(
                F.count(F.lit(1)).alias("days_used"), F.count(F.when(F.col("known").isNull(), True)).alias("days_missing")
            ).select(F.lit(f"{table}.{column}").alias("source"), "days_used", "days_missing")
        )
    days = F.datediff(F.max("full_date"), F.min("full_date")) + 1
    holes = calendar.agg(F.countDistinct("full_date").alias("days_used"), days.alias("span")).select(
        F.lit("dim_date").alias("source"),
        "days_used",
        (F.col("span") - F.col("days_used")).cast("bigint").alias("days_missing"),
    )
    return _union([*parts, holes])


def _runs(days: DataFrame) -> DataFrame:
    """Days (source, day), distinct, as runs of days that follow each other: first_day, last_day."""
    place = F.row_number().over(Window.partitionBy("source").orderBy("day"))
    runs = days.withColumn("place", place).groupBy("source", F.date_sub("day", F.col("place")).alias("run"))
    return runs.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day")).drop("run")


def dq_date_gaps(star: Star, p: ReportParams) -> DataFrame:
    """Every stretch of days that the calendar lacks: days a fact uses, per date column, and holes in the calendar.

    Dates are reduced to distinct days per column in one pass over a table; all that follows works on days.
    """
    used = []
    for table in dict.fromkeys(t for t, _ in FACT_DATES):
        columns = [c for t, c in FACT_DATES if t == table]
        days = F.array(*(F.struct(F.lit(f"{table}.{c}").alias("source"), F.col(c).alias("day")) for c in columns))
        used.append(_column(star, table, *columns).select(F.inline(days)).distinct())
    calendar = star["dim_date"].select(F.col("full_date").alias("day")).distinct()
    missing = _union(used).filter(F.col("day").isNotNull()).join(calendar, "day", "left_anti")
    known = calendar.filter(F.col("day").isNotNull()).select(F.lit("dim_date").alias("source"), "day")
    runs = _runs(missing.select("source", "day").unionByName(known))
    # a run of days that are missing is a gap; so is what lies between two runs of the calendar
    following = F.lead("first_day").over(Window.partitionBy("source").orderBy("first_day"))
    between = F.col("source") == "dim_date"
    gaps = runs.withColumn("following", following).select(
        "source",
        F.when(between, F.date_add("last_day", 1)).otherwise(F.col("first_day")).alias("first_day"),
        F.when(between, F.date_sub("following", 1)).otherwise(F.col("last_day")).alias("last_day"),
    )
    days = (F.datediff("last_day", "first_day") + 1).cast("bigint")
    return gaps.filter(F.col("last_day").isNotNull()).withColumn("days", days)


def dq_orphan_facts(star: Star, p: ReportParams) -> DataFrame:
    """Fact rows with a missing parent, summed per fact table."""
    refs = tuple(r for r in schema.FOREIGN_KEYS if r[0].startswith("fact_"))
    each = _named(key_audit(star, (), refs), [(r[0],) for r in refs], "table_name")
    return each.groupBy("table_name").agg(units("violations").alias("violations"))


def dq_cancelled_exclusion(star: Star, p: ReportParams, answers: Mapping[str, views.View] = views.VIEWS) -> DataFrame:
    """Revenue of each revenue view against the revenue of non-cancelled orders.

    With ``answers`` from stored sums it checks the sums, and only the base reads lines.
    """
    revenue = {
        "vw_sales_executive_summary": "total_revenue",
        "vw_customer_360": "lifetime_revenue",
        "vw_product_performance": "net_revenue",
        "vw_monthly_trend": "net_revenue",
    }
    base = (
        star.order_values(net=total("net_amount"))
        .filter(NOT_CANCELLED)
        .agg(zero(total("net")).alias("base_total"))
        .select("base_total")
        .scalar()
    )
    parts = [
        answers[name](star, p).agg(zero(total(column)).alias("view_total")).select(F.lit(name).alias("view_name"), "view_total")
        for name, column in revenue.items()
    ]
    return _union(parts).withColumn("base_total", base.cast(TOTAL)).withColumn(
        "diff", (F.col("view_total") - F.col("base_total")).cast(TOTAL)
    )


def two_word_name(column: str) -> Column:
    """The name is exactly two words: one inner space and none at the edges."""
    name = F.col(column)
    inner = F.length(F.trim(name)) - F.length(F.replace(F.trim(name), F.lit(" "), F.lit("")))
    return (F.trim(name) == name) & (inner == 1)


def dq_customer_name_shape(star: Star, p: ReportParams, violations: bool = False) -> DataFrame:
    """Customers whose name is exactly two words, or with ``violations`` the others."""
    ok = two_word_name("customer_name")
    return star["dim_customers"].filter(~ok if violations else ok)


def dq_product_name_shape(star: Star, p: ReportParams) -> DataFrame:
    """Products whose name is exactly two words."""
    return star["dim_products"].filter(two_word_name("product_name"))


def promotion_per_line(star: Star, p: ReportParams) -> DataFrame:
    """Every line with the newest promotion of its product that was valid on its day, NULL where none was."""
    lines = star.lines("line_item_id", "product_id", "line_date")
    found = newest_valid(lines, star["product_promotions"], "product_id", "line_date", "discount_rate")
    return found.select("line_item_id", "product_id", "line_date", "promotion_id", "discount_rate")


def promotion_on_line(star: Star, p: ReportParams) -> DataFrame:
    """Lines sold while a promotion of their product was valid, with the newest such promotion."""
    return promotion_per_line(star, p).filter(F.col("promotion_id").isNotNull())
