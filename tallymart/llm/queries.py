"""The operators' queries over the given tables, and DuckDB statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import (
    bpe,
    conversations,
    divergence,
    exact_dedup,
    language_id,
    lm_score,
    mixing,
    quality,
    secret_scan,
    simhash,
    token_store,
    top_k,
    toxicity,
)
from tallymart.llm.shared import read, tokenizer_path


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(read(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classes(read(spark, sf_dir, "documents"))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), tokenizer_path())


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(read(spark, sf_dir, "embeddings"), k=20, every=20, scale=64)


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(read(spark, sf_dir, "documents"))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.round_trip(read(spark, sf_dir, "documents"), tokenizer_path())


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).drop("text")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), words=4, distance=4)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"), least_docs=10, top=10)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit(conversations.damage(read(spark, sf_dir, "conversations")))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_exact_dedup,
        op3_bpe_round_trip,
        op4_top_k,
        op5_lm_score,
        op6_token_store,
        op7_mixing,
        op8_quality,
        op9_toxicity,
        op10_simhash_near_dedup,
        op11_source_divergence,
        op12_conversation_repair,
        op13_language_id,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run



def _secret_statement() -> str:
    """Spans of every rule: what a regex finds, between what it leaves."""
    parts = []
    for place, rule in enumerate(secret_scan.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
            SELECT doc_id, id, {place} AS place, '{rule.kind}' AS kind, {rule.base} AS base, {rule.least} AS least,
                   string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS hits,
                   regexp_extract_all(t, '{pattern}', {rule.group}) AS vals
            FROM docs""")
    counts = ", ".join(
        f"count(*) FILTER (kind = '{rule.kind}') AS n_{rule.kind}" for rule in secret_scan.RULES if rule.base
    )
    return f"""
        WITH docs AS (SELECT doc_id, row_number() OVER () AS id, coalesce(text, '') AS t FROM documents),
        found AS ({" UNION ALL ".join(parts)}),
        each AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM found WHERE len(hits) > 0),
        spans AS (
            SELECT doc_id, id, place, kind, base, length(hits[i]) AS size,
                   list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                   + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start
            FROM each WHERE length(vals[i]) >= least
        ),
        texts AS (
            SELECT id, {counts},
                   string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, place) AS spans,
                   string_agg(kind || ':' || start || ':' || (start + size), ',' ORDER BY start, place) FILTER (base) AS own
            FROM spans GROUP BY id
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN texts USING (id)
    """


#: What each byte adds to a CRC-32.
CRC_PARTS = """crc AS (
            SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
                   lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS part
        )"""


def _crc(name: str) -> str:
    """The CRC-32 of an ASCII text, over `crc`."""
    codes = f"list_concat([4294967295], list_transform(string_split({name}, ''), lambda x: ascii(x)::BIGINT))"
    return f"(xor(list_reduce({codes}, lambda c, b: xor(c // 256, part[1 + xor(c, b) % 256])), 4294967295))"


def _repair_statement() -> str:
    """Cost-to-go of the four states from a conversation's last row to its first, with the edits and the repaired lines."""
    after = [2, 2, 3, 2]  # state after an inserted or renamed turn, states from 0
    line = ["user:", "user:", "assistant:", "user:"]

    def inserted(states: list[str]) -> list[str]:
        """Each state's best, once up to two insertions before it are allowed."""
        def put(state: int, then: str) -> str:
            return f"{{c: 5 + ({then}).c, a: 'I' || ({then}).a, t: '\n{line[state]}' || ({then}).t}}"

        return [f"list_min([{s}, {put(i, states[after[i]])}, {put(i, put(after[i], states[after[after[i]]]))}])" for i, s in enumerate(states)]

    ends = inserted([f"{{c: {0 if s in (0, 3) else 1000000000}::BIGINT, a: '', t: ''}}" for s in range(4)])
    moves = []
    for state in range(4):
        keep = {0: [("s", 1), ("u", 2)], 1: [("u", 2)], 2: [("a", 3)], 3: [("u", 2)]}[state]
        kept = " ".join(f"WHEN who = '{w}' THEN s{t}" for w, t in keep)
        best = f"(CASE {kept} END)"
        moves.append(f"""list_min(list_filter([
            {{c: 2 + s{state}.c, a: 'D' || s{state}.a, t: s{state}.t}},
            CASE WHEN fault NOT IN (1, 2) AND {best} IS NOT NULL
                 THEN {{c: extra + {best}.c, a: 'K' || {best}.a, t: '\n' || role || ':' || text || {best}.t}} END,
            CASE WHEN fault NOT IN (1, 2)
                 THEN {{c: 1 + extra + s{after[state]}.c, a: 'R' || s{after[state]}.a, t: '\n{line[state]}' || text || s{after[state]}.t}} END
        ], lambda x: x IS NOT NULL))""")
    plain = ", ".join(f"{m} AS b{i}" for i, m in enumerate(moves))
    closed = ", ".join(f"{e} AS s{i}" for i, e in enumerate(inserted(["b0", "b1", "b2", "b3"])))
    space = r"[^\x20\x09-\x0D]"
    return rf"""
        WITH RECURSIVE {CRC_PARTS}, named AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
            FROM conversations
        ), fates AS (
            SELECT conv_id, turn, role, text, {_crc("name")} % 20 AS fate
            FROM named, crc
        ), damaged AS (
            SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
                   CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM (SELECT *, unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy FROM fates) WHERE fate <> 0
        ), marked AS (
            SELECT *, left(role, 1) AS who,
                   CASE WHEN NOT regexp_matches(text, '{space}') THEN 1
                        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 THEN 2
                        WHEN right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?') THEN 3
                        ELSE 0 END AS fault
            FROM damaged
        ), placed AS (
            SELECT *, CASE fault WHEN 3 THEN 5 ELSE 0 END AS extra,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC, fault = 2 DESC) AS i,
                   count(*) OVER (PARTITION BY conv_id) AS size,
                   lag(who) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, fault = 2) || who AS pair
            FROM marked
        ), walk AS (
            SELECT conv_id, 0::BIGINT AS i, {", ".join(f"{e} AS s{i}" for i, e in enumerate(ends))}
            FROM (SELECT DISTINCT conv_id FROM placed)
            UNION ALL
            SELECT conv_id, i, {closed}
            FROM (SELECT p.conv_id, p.i, {plain} FROM walk w JOIN placed p ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.i = w.i + 1)
        ), counts AS (
            SELECT conv_id, count(*) AS size, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
                   count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM placed GROUP BY conv_id
        )
        SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s0.c, 0)::BIGINT AS cost,
               coalesce(s0.a, '') AS audit, sha256(coalesce(s0.t[2:], '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN walk w ON w.conv_id IS NOT DISTINCT FROM o.conv_id AND w.i = c.size
    """


STATEMENTS: dict[str, str] = {
    "op1_secret_scan": _secret_statement(),
    "op4_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS ints
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.ints, c.ints)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.ints) = len(q.ints)
        )
        SELECT query_id, rank::INT AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
        WHERE rank <= 20
    """,
    "op11_source_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ), terms AS (
            SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
        ), kept AS (
            SELECT lang, term, count(*) AS n FROM terms GROUP BY ALL HAVING count(DISTINCT id) >= 10
        ), totals AS (
            SELECT lang, count(*) AS v, sum(n)::BIGINT + 2 * count(*) AS total FROM kept GROUP BY lang
        ), counts AS (
            SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ), sources AS (
            SELECT lang, source, coalesce(any_value(v), 0) AS v, coalesce(sum(n), 0)::BIGINT + 2 * coalesce(any_value(v), 0) AS total
            FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN totals USING (lang) LEFT JOIN counts USING (lang, source)
            GROUP BY lang, source
        ), cells AS (
            SELECT lang, term, s.source, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 2) // s.total AS p
            FROM kept k JOIN sources s USING (lang) LEFT JOIN counts c USING (lang, source, term)
        ), pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                   (SELECT coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT
                    FROM cells x JOIN cells y USING (lang, term)
                    WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source) AS value
            FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
        ), shares AS (
            SELECT c.lang, c.source, c.term, c.p, 1 + 1000000000 * (k.n + 2) // t.total AS q
            FROM cells c JOIN kept k USING (lang, term) JOIN totals t USING (lang) WHERE c.n > 0
        ), items AS (
            SELECT * FROM pairs
            UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE p > q
        )
        SELECT lang, source, part, item, value, rank::INT AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM items)
        WHERE part = 'pair' OR rank <= 10
    """,
    "op12_conversation_repair": _repair_statement(),
    "op13_language_id": rf"""
        WITH {CRC_PARTS}, docs AS (
            SELECT row_number() OVER () AS id, doc_id, lang, text, {_crc("coalesce(doc_id::VARCHAR, '')")} % 3 = 1 AS held_out
            FROM documents, crc
        ), words AS (
            SELECT id, ' ' || word || ' ' AS word, count(*) AS n
            FROM (SELECT id, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM docs) GROUP BY ALL
        ), cut AS (
            SELECT id, n, unnest(list_filter(flatten(list_transform([1, 2, 3], lambda k:
                   list_transform(range(1, length(word) - k + 2), lambda i: substr(word, i, k)))), lambda g: g <> ' ')) AS gram
            FROM words
        ), grams AS (
            SELECT id, gram, sum(n) AS n FROM cut GROUP BY ALL
        ), lists AS (
            SELECT * FROM (SELECT id, gram, row_number() OVER (PARTITION BY id ORDER BY n DESC, length(gram), gram) AS place FROM grams)
            WHERE place <= 400
        ), profiles AS (
            SELECT * FROM (
                SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY sum(n) DESC, length(gram), gram) AS place
                FROM grams JOIN docs USING (id) WHERE NOT held_out AND lang IS NOT NULL GROUP BY lang, gram
            ) WHERE place <= 400
        ), distances AS (
            SELECT l.id, a.lang, sum(coalesce(abs(p.place - l.place), 400))::BIGINT AS distance, count(*) AS size
            FROM lists l CROSS JOIN (SELECT DISTINCT lang FROM docs WHERE NOT held_out AND lang IS NOT NULL) a
            LEFT JOIN profiles p ON p.lang = a.lang AND p.gram = l.gram
            GROUP BY l.id, a.lang
        ), nearest AS (
            SELECT id, arg_min(lang, {{d: distance, l: lang}}) AS lang, min(distance) AS distance, any_value(size) AS size
            FROM distances GROUP BY id
        )
        SELECT doc_id, held_out, coalesce(n.lang, 'und') AS lang_pred, coalesce(1 - distance / (size * 400), 0)::DOUBLE AS score
        FROM docs LEFT JOIN nearest n USING (id)
    """,
    "op2_exact_dedup": """
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM (
            SELECT doc_id,
                   max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
                   count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
                   sha256(coalesce(text, '')) AS text_sha256
            FROM documents
        )
    """,
}
if corpus_pipeline.ORACLE_SQL:
    STATEMENTS["pipeline"] = corpus_pipeline.ORACLE_SQL
