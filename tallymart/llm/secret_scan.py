"""Secret scan over a trigram inverted index.

Each rule's regex is turned into a Boolean query over trigrams that every match must contain.  The
index has, per block of documents and trigram, the list of documents that hold it; it covers the
trigrams that the rules ask for.  Lists are intersected and united as the query says, and the rule's
regex then verifies its candidates.  A rule without a mandatory trigram scans every text.
All work on rows is done by SQL functions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as ops
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import whole_text

BLOCK_ROWS = 4096  # documents of a block, about
CHOICES = 64  # literal strings kept apart in one stretch of a regex
CLASS = 8  # largest character class that is spelled out
SPAN = "array<struct<start:int,place:int,kind:string,end:int>>"


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` count if `group` has at least `least` characters; `base` rules make the contract's spans."""

    kind: str
    pattern: str
    group: int
    least: int
    base: bool


#: The kinds in the order in which they are listed.
RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
        True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    # runs of 16 and more; the same matches as of any run, less those that are too short
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, False),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}", 0, 39, False),
    # a run without the other two parts is matched and dropped, so that no run is tried from each of its places
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+(\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)?", 1, 20, False),
)

Query = frozenset[frozenset[str]]  # any of: all of
ANY: Query = frozenset([frozenset()])


def _absorbed(query: Query) -> Query:
    return frozenset(q for q in query if not any(o < q for o in query))


def _literals(nodes) -> set[str] | None:
    """All strings that a stretch of a regex can match, lower-cased, or None if they are too many."""
    out = {""}
    for op, arg in nodes:
        if op is ops.LITERAL:
            found = {chr(arg).lower()}
        elif op is ops.IN and all(kind is ops.LITERAL for kind, _ in arg) and len(arg) <= CLASS:
            found = {chr(code).lower() for _, code in arg}
        elif op is ops.SUBPATTERN:
            found = _literals(arg[-1])
        elif op is ops.BRANCH:
            parts = [_literals(branch) for branch in arg[1]]
            found = None if None in parts else set().union(*parts)
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT) and arg[1] <= 1:
            found = _literals(arg[2])
            if found is not None and arg[0] == 0:
                found = found | {""}
        else:
            found = None
        if found is None or len(found) * len(out) > CHOICES:
            return None
        out = {a + b for a in out for b in found}
    return out


def _trigrams(strings: set[str]) -> Query:
    return _absorbed(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def _all_of(queries: list[Query]) -> Query:
    out = ANY
    for query in sorted(queries, key=len):
        if len(out) * len(query) <= CHOICES:  # leaving a part out only lets more candidates through
            out = _absorbed(frozenset(a | b for a in out for b in query))
    return out


def _query(nodes) -> Query:
    parts: list[Query] = []
    held: set[str] = {""}
    for node in nodes:
        op, arg = node
        more = _literals([node])
        if more is not None and len(more) * len(held) <= CHOICES:
            held = {a + b for a, b in product(held, more)}
            continue
        parts.append(_trigrams(held))
        held = more if more is not None else {""}
        if more is None:
            if op is ops.SUBPATTERN:
                parts.append(_query(arg[-1]))
            elif op is ops.BRANCH:
                parts.append(_absorbed(frozenset().union(*(_query(branch) for branch in arg[1]))))
            elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT) and arg[0] >= 1:
                parts.append(_query(arg[2]))
    return _all_of([*parts, _trigrams(held)])


def trigram_query(pattern: str) -> Query:
    """Sets of trigrams (lower case); any text with a match holds all of one set.  An empty set: no filter."""
    return _query(parser.parse(pattern, re.ASCII))


def _hits(text: Column, trigrams: list[str]) -> Column:
    """Those of `trigrams` that the lower-cased text holds."""
    every = F.array(*(F.lit(t) for t in trigrams))
    return F.transform(F.array(F.lower(text)), lambda low: F.filter(every, lambda t: F.contains(low, t)))[0]


def _key() -> Column:
    """Of a row; equal only for rows with equal results, or by accident, which verification settles."""
    return F.xxhash64("doc_id", whole_text())


def build_index(docs: DataFrame, trigrams: list[str], blocks: int) -> DataFrame:
    """Rows (block, trigram, keys): sorted posting lists of the keys of rows, at most one list a block and trigram."""
    return (
        docs.select(_key().alias("key"), F.explode(_hits(whole_text(), trigrams)).alias("trigram"))
        .groupBy(F.pmod("key", F.lit(blocks)).alias("block"), "trigram")
        .agg(F.sort_array(F.collect_set("key")).alias("keys"))
    )


def candidates(index: DataFrame, rules: dict[str, Query]) -> DataFrame:
    """Rows (key, kinds): the rules whose trigram query a row fulfils."""
    lists = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("lists"))
    none = F.array().cast("array<bigint>")

    def rows_of(kind: str, query: Query) -> Column:
        every = [
            reduce(F.array_intersect, [F.coalesce(F.col("lists")[t], none) for t in sorted(part)])
            for part in sorted(query, key=sorted)
        ]
        return F.transform(
            reduce(F.array_union, every), lambda key: F.struct(F.lit(kind).alias("kind"), key.alias("key"))
        )

    found = [rows_of(kind, query) for kind, query in rules.items()]
    rows = lists.select(F.explode(F.concat(*found)).alias("hit"))
    return rows.groupBy("hit.key").agg(F.collect_set("hit.kind").alias("kinds"))


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """The spans of a rule in a text, in order; places count code points, the end is exclusive."""
    parts = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("value"),
    )

    def add(done: Column, part: Column) -> Column:
        start = done["at"] + F.length(part["gap"])
        end = start + F.coalesce(F.length(part["hit"]), F.lit(0))
        span = F.struct(
            start.alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), end.alias("end")
        )
        spans = F.when(F.length(part["value"]) >= rule.least, F.concat(done["spans"], F.array(span)))
        return F.struct(end.alias("at"), F.coalesce(spans, done["spans"]).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))
    return F.aggregate(parts, start, add, lambda done: done["spans"])


def _joined(spans: Column) -> Column:
    words = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(words, ",")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows (doc_id, spans), one per row of `docs`: spans sorted by start, then by the rule's place.

    Null texts count as empty and have no spans.  Repeated rows each get their spans.  Texts
    meet no other row: only those that hold some trigrams are shuffled, to meet their candidate rules.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    asked = {kind: q for kind, q in queries.items() if all(q)}
    trigrams = sorted(set().union(*(part for q in asked.values() for part in q)))
    fewest = min((len(part) for q in asked.values() for part in q), default=0)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))

    def spans(known: Column | None) -> Column:
        found = []
        for place, rule in enumerate(rules):
            own = _spans(F.col("text"), rule, place)
            if rule.kind not in asked:
                found.append(own)
            elif known is not None:
                found.append(F.when(F.array_contains(known, rule.kind), own).otherwise(F.array().cast(SPAN)))
        return F.array_sort(F.concat(*found)) if found else F.array().cast(SPAN)

    if not asked:
        return docs.select("doc_id", spans(None).alias("spans"))
    blocks = max(1, -(-docs.count() // block_rows))
    found = candidates(build_index(docs, trigrams, blocks), asked)
    possible = F.size(_hits(F.col("text"), trigrams)) >= fewest
    without = docs.where(~possible).select("doc_id", spans(None).alias("spans"))
    within = docs.where(possible).withColumn("key", _key()).join(found, "key", "left")
    return within.select("doc_id", spans(F.col("kinds")).alias("spans")).unionByName(without)


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows (doc_id, n_assign, n_access, n_hex, base_sha256, spans) with the spans of `scan` as text."""
    base = {r.kind for r in rules if r.base}
    own = F.filter("spans", lambda s: s["kind"].isin(*base))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scan(docs, rules).select(
        "doc_id", *(count(r.kind) for r in rules if r.base),
        F.sha2(_joined(own), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
    )
