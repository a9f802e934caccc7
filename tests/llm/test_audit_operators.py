"""Source divergence, conversation repair and language identification."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import duckdb
import pytest
from pyspark.sql import functions as F

from tallymart.llm import conversations, divergence, language_id
from tallymart.llm.queries import QUERIES, STATEMENTS
from tests.compare import differences
from tests.llm.samples import documents, nothing, order, plain, rows

QUERY_NAMES = ("op11_source_divergence", "op12_conversation_repair", "op13_language_id")


@pytest.mark.parametrize("name", QUERY_NAMES)
def test_query_equals_statement(spark, sf_dir, name):
    db = duckdb.connect()
    for table in ("documents", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    assert differences(QUERIES[name](spark, sf_dir), db, STATEMENTS[name]) == []


# -- divergence of sources -----------------------------------------------------


def slow_audit(table: list[tuple], least: int, top: int) -> list[tuple]:
    """`table` has (text, lang, source)."""
    table = [tuple(plain(v) for v in row) for row in table]
    table = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)), a, b) for t, a, b in table]
    out = []
    for lang in {row[1] for row in table}:
        own = [(t, s) for t, a, s in table if a == lang]
        held = Counter(t for words, _ in own for t in set(words))
        kept = sorted(t for t, n in held.items() if n >= least)
        count = {s: Counter(t for words, source in own if source == s for t in words if t in kept) for _, s in own}
        count[None] = sum(count.values(), Counter())
        share = {
            s: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept} for s, c in count.items()
        }
        for s in set(count) - {None}:
            pairs = [
                (sum((share[s][t] - share[o][t]) ** 2 // (share[s][t] + share[o][t]) for t in kept), o)
                for o in set(count) - {None, s}
            ]
            terms = [
                ((share[s][t] - share[None][t]) ** 2 // (share[s][t] + share[None][t]), t)
                for t in kept if count[s][t] > 0 and share[s][t] > share[None][t]
            ]
            for part, items, last in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, o, v, r) for r, (v, o) in enumerate(items[:last], 1)]
    return out


def _texts() -> list[tuple]:
    """(text, lang, source): frequent and rare terms, sources without terms, a language without kept terms."""
    rng = random.Random(2)
    words = [f"{a}{b}" for a in ("Ba", "ce", "dî", "fo") for b in ("n", "rt", "ST", "x", "日本")] + ["ß", "Ünï", "z"]
    out = []
    for i in range(240):
        lang, source = rng.choice(("en", "de", None)), f"s{rng.randint(0, 6)}" if i % 3 else "hot"
        size = rng.choice((1, 5, 40, 300))
        out.append((" ".join(rng.choice(words[: rng.randint(1, len(words))]) + rng.choice(("", "-1", "?")) for _ in range(size)), lang, source))
    out += [(None, "en", "empty"), ("", "en", None), ("12 34", "en", "digits"), ("alone", "xx", "a"), ("alone", "xx", "b"), (None, None, None)]
    out += [("only one source", "yy", "a")] * 12
    return out


@pytest.mark.parametrize(("chunk", "tile"), [(4096, 64), (8, 2), (100, 1)])
def test_divergence(spark, chunk, tile):
    table = _texts()
    df = spark.createDataFrame(table, "text string, lang string, source string").repartition(5)
    df = df.selectExpr("*", "1 AS id", "'x' AS term", "2 AS word", "3L AS bits", "4 AS n", "5 AS total")
    got = divergence.audit(df, least_docs=10, top=10, chunk=chunk, tile=tile).collect()
    assert sorted(map(tuple, got)) == sorted(slow_audit(table, 10, 10))


def test_divergence_at_the_edges(spark):
    got = divergence.audit(documents(spark), least_docs=2, top=3).collect()
    want = slow_audit([(t, a, s) for _, t, a, s in rows()], 2, 3)
    assert sorted(map(tuple, got)) == sorted(want)
    assert divergence.audit(nothing(spark)).count() == 0


def test_shares_of_large_counts(spark):
    count, total = 9 * 10**14 + 7, 9 * 10**15 - 1
    df = spark.range(1).select(divergence.share(F.lit(count), F.lit(total)), divergence.share(F.lit(total - 2), F.lit(total)))
    assert tuple(df.first()) == (1 + 10**9 * (count + 2) // total, 1 + 10**9)


def test_levels_of_word_blocks(spark):
    """One bitmap per source, word of terms and count; joint cells are never pairs of documents or terms."""
    rows_ = [("en", 0, 0, 0, s, 1 + t % 2, t) for s in ("a", "b") for t in range(64)]
    df = spark.createDataFrame(rows_, "lang string, band int, chunk long, word int, source string, n long, bit int")
    got = {(r["source"], r["n"]): r["bits"] & (1 << 64) - 1 for r in divergence.levels(df).collect()}
    even = sum(1 << t for t in range(0, 64, 2))
    assert got == {(s, n): even if n == 1 else even << 1 for s in ("a", "b") for n in (1, 2)}


# -- conversations ---------------------------------------------------------------


def slow_damage(turns: list[tuple]) -> dict:
    """Turns by conversation, in order."""
    found = {conv: [] for conv, *_ in turns}
    for conv, turn, role, text in turns:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        found[conv] += [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in found.items()}


def slow_repair(turns: list[tuple]) -> tuple:
    """All lists of edits, cheapest first, until one gives a conversation of the right form."""
    seen, faults = set(), []
    for _, role, text in turns:
        inked = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append(1 if not inked else 2 if (role, text) in seen else 3 if inked[-1] not in ".!?" else 0)
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, at, said, lines = heapq.heappop(heap)
        if at == len(turns) and re.fullmatch("(s?(ua)+)?", said):
            break
        if (at, said[-1:], said == "s") in done or not re.fullmatch("(s?(ua)*u?)?", said):
            continue
        done.add((at, said[-1:], said == "s"))
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 5, audit + "I", at, said + role[0], (*lines, f"{role}:")))
        if at < len(turns):
            _, own, text = turns[at]
            extra = 5 if faults[at] == 3 else 0
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, said, lines))
            if faults[at] not in (1, 2):
                heapq.heappush(heap, (cost + extra, audit + "K", at + 1, said + (own[:1] or " "), (*lines, f"{own}:{text}")))
                for role in ("user", "assistant"):
                    heapq.heappush(heap, (cost + extra + 1, audit + "R", at + 1, said + role[0], (*lines, f"{role}:{text}")))
    numbers = [t for t, *_ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairwise(turns))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in (1, 2, 3)), illegal, cost, audit, digest)


def _turns() -> list[tuple]:
    rng = random.Random(4)
    roles, texts = ("user", "assistant", "system", "tool", "", None, "agent"), ("Yes.", "No?\n", "open", "", " \t", None, "Ünd!", "a.b", "same.")
    out = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Ho."), (None, 3, "user", "x."), (None, None, "assistant", "y."), (2, None, None, None)]
    for conv in range(3, 160):
        weights = (8, 8, 2, 1, 1, 1, 1) if conv % 2 else (1,) * 7
        for turn in range(rng.choice((1, 2, 3, 5, 9, 14))):
            number = None if rng.random() < 0.05 else turn + (turn > 3) * rng.randint(0, 2)
            out.append((conv, number, rng.choices(roles, weights)[0], f"{rng.choice(texts) or ''}" if rng.random() < 0.5 else f"Turn {turn}{rng.choice('.!?x')}"))
    out += [(500 + i, 2**62 * (1 if i else -1), "user", "far.") for i in range(2)] + [(503, t, "user", "far.") for t in (-(2**62), 2**62)]
    return out


TURNS = "conv_id long, turn long, role string, text string"


def test_repair_equals_search(spark):
    turns = _turns()
    df = spark.createDataFrame(turns, TURNS).repartition(4).selectExpr("*", "1 AS fault", "'x' AS edit", "2 AS mark", "3 AS who", "4 AS fate")
    got = {r[0]: tuple(r)[1:] for r in conversations.audit(conversations.damage(df)).collect()}
    want = {conv: slow_repair(own) for conv, own in slow_damage(turns).items()}
    assert got == want
    assert any("R" in w[6] for w in want.values()) and any("K" in w[6] and "D" in w[6] for w in want.values())
    assert conversations.audit(conversations.damage(df.limit(0))).count() == 0
    assert conversations.repair(df.limit(0)).count() == 0


@pytest.mark.parametrize("costs", [conversations.Costs(1, 9, 1, 1), conversations.Costs(4, 7, 2, 9)])
def test_insertions_when_they_are_cheap(costs):
    """The passes alone, over every conversation of up to four turns and dear deletions, against a search."""
    rng = random.Random(3)
    for _ in range(300):
        kinds = [(rng.choice((0, 1, 2, 3)), rng.choice((0, 0, 1, 2, 3))) for _ in range(rng.randint(0, 4))]
        to_go, _ = conversations.at_end(costs)
        edits = []
        for who, fault in reversed(kinds):
            to_go, own = conversations.before(to_go, who, fault, costs)
            edits.append(own)
        state, letters, at = 0, "", 0
        moves = [*reversed(edits), conversations.at_end(costs)[1]]
        while at < len(kinds) or state not in conversations.FINAL:
            edit = moves[at] >> 2 * state & 3
            letters += conversations.LETTERS[edit]
            if edit == conversations.INSERT:
                state = conversations.AFTER[state]
                continue
            if edit == conversations.KEEP:
                state = conversations.STEP[state, kinds[at][0]]
            elif edit == conversations.REROLE:
                state = conversations.AFTER[state]
            at += 1
        best = _searched(kinds, costs)
        assert (to_go[0], letters) == best


def _searched(kinds, costs) -> tuple[int, str]:
    heap, done = [(0, "", 0, 0)], set()
    while True:
        cost, letters, at, state = heapq.heappop(heap)
        if at == len(kinds) and state in conversations.FINAL:
            return cost, letters
        if (at, state) in done:
            continue
        done.add((at, state))
        heapq.heappush(heap, (cost + costs.insert, letters + "I", at, conversations.AFTER[state]))
        if at < len(kinds):
            who, fault = kinds[at]
            extra = costs.truncated if fault == 3 else 0
            heapq.heappush(heap, (cost + costs.delete, letters + "D", at + 1, state))
            if fault not in (1, 2):
                if (state, who) in conversations.STEP:
                    heapq.heappush(heap, (cost + extra, letters + "K", at + 1, conversations.STEP[state, who]))
                heapq.heappush(heap, (cost + extra + costs.rerole, letters + "R", at + 1, conversations.AFTER[state]))


def test_giant_conversation_over_many_batches(spark):
    turns = [(7, t, ("user", "assistant")[t % 2], f"Turn {t // 3}.") for t in range(3000)] + [(8, 0, "user", "Hm.")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = {r[0]: tuple(r)[1:] for r in conversations.audit(spark.createDataFrame(turns, TURNS)).collect()}
        edits = conversations.repair(spark.createDataFrame(turns, TURNS)).where("conv_id = 7").orderBy("place").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    own = [(t, r, x) for _, t, r, x in turns if _ == 7]
    assert got == {7: slow_repair(own), 8: slow_repair([(0, "user", "Hm.")])}
    assert "".join(r["edit"] for r in edits) == got[7][6] and [r["place"] for r in edits] == list(range(len(edits)))
    lines = "\n".join(f"{r['role']}:{r['text']}" for r in edits if r["role"] is not None)
    assert hashlib.sha256(lines.encode()).hexdigest() == got[7][7] and sum(r["cost"] for r in edits) == got[7][5]


# -- languages -------------------------------------------------------------------


def slow_grams(text: str) -> list[str]:
    out = []
    for word in "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text).split():
        own = f" {word} "
        out += [own[i : i + k] for k in (1, 2, 3) for i in range(len(own) - k + 1) if own[i : i + k] != " "]
    return out


def ranked(counts: Counter, length: int) -> list[str]:
    return sorted(counts, key=lambda g: (-counts[g], len(g), g))[:length]


def slow_identify(table: list[tuple], length: int) -> list[tuple]:
    """`table` has (doc_id, text, lang)."""
    found = defaultdict(Counter)
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 3 == 1 for i, *_ in table]
    for (_, text, lang), out in zip(table, held, strict=True):
        if not out and lang is not None:
            found[lang].update(slow_grams(plain(text)))
    places = {lang: {g: r for r, g in enumerate(ranked(c, length))} for lang, c in found.items()}
    result = []
    for (i, text, _), out in zip(table, held, strict=True):
        own = ranked(Counter(slow_grams(plain(text))), length)
        best = min(
            ((sum(abs(p[g] - r) if g in p else length for r, g in enumerate(own)), lang) for lang, p in places.items()),
            default=None, key=lambda x: (x[0], x[1].encode()),
        )
        result.append((i, out, "und", 0.0) if best is None or not own else (i, out, best[1], 1 - best[0] / (len(own) * length)))
    return result


@pytest.mark.parametrize(("length", "languages", "piece"), [(400, 128, 1 << 20), (20, 1, 7), (5, 2, 2)])
def test_language_of_edge_rows(spark, monkeypatch, length, languages, piece):
    monkeypatch.setattr(language_id, "LANGUAGES", languages)
    monkeypatch.setattr(language_id.predict, "__defaults__", (length, languages))
    table = [(i, t, lang) for i, t, lang, _ in rows() if t is None or len(t) < 10_000] + [(70, "ÀÉÎ İstanbul ŒUVRE 東京 ﬀ", ""), (71, "1234", "zz")]
    df = spark.createDataFrame(table, "doc_id long, text string, lang string").repartition(3)
    df = df.selectExpr("*", "1 AS rank", "'x' AS lang_pred", "2 AS gram", "3 AS n", "4 AS held_out")
    got = language_id.identify(df, length).collect()
    assert sorted(map(tuple, got), key=order) == sorted(slow_identify(table, length), key=order)
    for text in ("", " ", "a", "ab  c", "Ab1c dÉ", "abcdefg hi", "x" * 30):
        monkeypatch.setattr(language_id, "PIECE", piece)
        codes, counts = language_id.grams(text)
        assert {language_id.spelled(int(c)): int(n) for c, n in zip(codes, counts, strict=True)} == Counter(slow_grams(text))


def test_no_documents_no_languages(spark):
    assert language_id.identify(nothing(spark)).count() == 0
    df = spark.createDataFrame([(1, "some text", None), (3, None, None)], "doc_id long, text string, lang string")
    assert {tuple(r)[2:] for r in language_id.identify(df).collect()} == {("und", 0.0)}


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = language_id.identify(docs).where("held_out").join(docs.select("doc_id", "lang", "text"), "doc_id").where("length(text) > 40")
    right, every = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert every > 30 and right >= 0.95 * every
