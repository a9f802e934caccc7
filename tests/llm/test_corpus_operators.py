"""Near duplicates, top-k, mixing, quality, toxicity and the pipeline."""

from __future__ import annotations

import random
import re
from collections import defaultdict
from fractions import Fraction
from itertools import product
from math import ceil, floor

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tallymart.llm import mixing, quality, simhash, top_k, toxicity
from tallymart.llm.components import components
from tests.llm.samples import documents, low, nothing, order, plain, rows


def slow_fingerprint(text: str | None, words: int) -> int:
    own = re.findall(rb"[^\x20\x09-\x0D]+", low(text))
    if not own:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(own[i : i + words]), seed=42) for i in range(max(1, len(own) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def sets_of(links, nodes) -> dict:
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return {n: root(n) for n in nodes}


def test_simhash_near_duplicates(spark):
    got = simhash.near_duplicates(documents(spark), words=4, distance=4).collect()
    fps = [slow_fingerprint(t, 4) for _, t, *_ in rows()]
    every = sorted(set(fps))
    near = [(a, b) for a in every for b in every if a < b and (a ^ b).bit_count() <= 4]
    roots, first = sets_of(near, every), defaultdict(list)
    for (i, *_), fp in zip(rows(), fps, strict=True):
        if i is not None:
            first[roots[fp]].append(i)
    want = [(i, f"{fp:016x}", min(first[roots[fp]], default=None)) for (i, *_), fp in zip(rows(), fps, strict=True)]
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    assert simhash.near_duplicates(nothing(spark)).count() == 0


@pytest.mark.parametrize(("cover", "distance"), [(simhash.SHORT, 4), (simhash.LONG, 4), (simhash.SHORT, 7)])
def test_every_close_pair_meets_at_an_anchor(cover, distance):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 300, dtype=np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, rng.integers(0, distance + 1), replace=False):
            y[i] ^= np.uint64(1) << np.uint64(b)
    rows_x, anchors_x, home = simhash.anchors(x, cover, distance)
    rows_y, anchors_y, _ = simhash.anchors(y, cover, distance)
    assert home.sum() == len(x) * len(cover.pieces)
    homes = set(zip(rows_x[home].tolist(), anchors_x[home].tolist(), strict=True))
    met = {i for i, _ in homes & set(zip(rows_y.tolist(), anchors_y.tolist(), strict=True))}
    assert met == set(range(len(x)))


@pytest.mark.parametrize("crowd", [2, 4096])
def test_links_on_a_crowded_anchor(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(4)
    fps = sorted({0b1011 ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(150)})
    df = spark.createDataFrame([(f - (1 << 64) * (f >> 63),) for f in fps], "fp long")

    def signed(f: int) -> int:
        return f - (1 << 64) * (f >> 63)

    near = {tuple(sorted((signed(a), signed(b)))) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4}
    found = [tuple(r) for r in simhash.links(df, 4, simhash.SHORT).collect()]
    nodes = [signed(f) for f in fps]
    assert sets_of(found, nodes) == sets_of(near, nodes)


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(201, 200), (202, 201), (200, 202), (300, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = sets_of(links, {n for link in links for n in link})
    assert got == {n: r for n, r in want.items() if n != r}


def kept_by_brute_force(texts: dict[int, str]) -> set[int]:
    """The smallest doc_id of each set of texts that links of at most 4 bits connect."""
    fps = {i: slow_fingerprint(t, 4) for i, t in texts.items()}
    links = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 4]
    return set(sets_of(links, list(fps)).values())


def test_near_copies_keep_one_row_a_group(spark):
    docs = documents(spark)
    kept = simhash.keepers(docs)
    assert kept.dtypes == docs.dtypes
    ids = [r["doc_id"] for r in kept.collect()]
    assert 6 in ids and not {7, 8} & set(ids)  # the smallest doc_id stays, a copy and a near copy go
    assert ids.count(11) == 2 and 100 in ids and 101 not in ids
    assert {1, 4, 9, 14} <= set(ids) and 2 not in ids
    assert simhash.keepers(nothing(spark)).count() == 0


def test_near_copies_by_brute_force(spark):
    """Near copies of one to many words apart, chains among them; no texts but those of a component's first doc_id stay."""
    rng, texts = random.Random(9), {}
    for i in range(80):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(60, 400))]
        for k in range(rng.randint(1, 6)):
            texts[10 * i + k] = " ".join(base)
            base[rng.randrange(len(base))] = f"x{rng.randrange(10**6)}"
    want = kept_by_brute_force(texts)
    assert 80 <= len(want) < len(texts) - 60
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert sorted(r["doc_id"] for r in simhash.keepers(docs).collect()) == sorted(want)


def vectors(spark, n: int, dim: int, scale: float = 1.0):
    rng = np.random.default_rng(n)
    held = rng.normal(0, scale, (n, dim)).round(2).tolist()
    held[3], held[5] = held[2], [0.0] * dim
    bad = [(n + 1, None), (n + 20, [float("nan")] * dim), (n + 2, [None] * dim), (n + 3, [float("inf")] * dim), (None, held[0])]
    rows = [(i, v) for i, v in enumerate(held)] + bad + [(7, held[7]), (40, [1.0, 2.0])]
    return rows, spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, score int")


@pytest.mark.parametrize(("n", "dim", "scale", "block"), [(200, 8, 1.0, 1 << 14), (700, 4, 1.0, 97), (90, 3, 1e7, 30)])
def test_top_k(spark, n, dim, scale, block):
    rows, df = vectors(spark, n, dim, scale)
    usable = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, v in {(i, tuple(v)) for i, v in usable if i % 20 == 0}:
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in usable if i != q and len(w) == len(v)]
        want += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:20], 1)]
    assert sorted(map(tuple, top_k.top_k(df, block=block).collect())) == sorted(want)


def test_top_k_of_huge_components(spark):
    rng, ends = random.Random(11), (-(1 << 63), (1 << 63) - 1)
    rows = [(i, [rng.choice([-1.0, 1.0]) * rng.random() * 10.0 ** rng.randint(0, 18) for _ in range(6)]) for i in range(300)]
    ints = [(i, [min(max(floor(64 * x), ends[0]), ends[1]) for x in v]) for i, v in rows]
    want = []
    for q, v in ints[::20]:
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in ints if i != q)[:20]
        places = {i: r for r, (_, i) in enumerate(scored, 1)}
        want.append((q, set(places), [min(max(-s, ends[0]), ends[1]) for s, _ in scored]))
    got = defaultdict(list)
    for r in sorted(top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert [(q, {i for i, _ in found}, [s for _, s in found]) for q, found in sorted(got.items())] == want


def test_top_k_of_nothing(spark):
    assert top_k.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def slow_schedule(blocks: list[int], weights: list[float]) -> list[tuple]:
    """Slot by slot, all released blocks looked at."""
    done, out, base = [0] * len(blocks), [], 0
    while any(n > d for n, d in zip(blocks, done, strict=True)):
        live = [s for s, n in enumerate(blocks) if n > done[s]]
        whole, start = sum(Fraction(weights[s]) for s in live), list(done)
        share = {s: Fraction(weights[s]) / whole for s in live}
        slot = 0
        while all(blocks[s] > done[s] for s in live):
            found = []
            for s in live:
                j = done[s] - start[s]
                release, due = floor(j / share[s]), ceil((j + 1) / share[s])
                if release <= slot:
                    found.append((due, s, release))
            due, s, release = min(found)
            out.append((s, done[s], base + release, base + due, base + slot))
            done[s] += 1
            slot += 1
        base += slot
    return out


def test_schedule_equals_brute_force():
    rng = random.Random(6)
    for trial in range(60):
        blocks = [rng.randint(0, 60) for _ in range(rng.randint(1, 9))] + ([300] if trial % 3 else [])
        weights = [rng.random() + 0.001 if trial % 2 else float(rng.choice((1, 1, 2, 5))) for _ in blocks]
        got = list(mixing.schedule(blocks, mixing.exact(weights)))
        assert got == slow_schedule(blocks, weights)
        assert [r[4] for r in got] == list(range(sum(blocks)))


@pytest.mark.parametrize(("sources", "hot", "slots"), [(20, 0.3404, 150_000), (1000, 0.5, 60_000), (256, 0.1396, 60_000)])
def test_every_source_stays_within_a_block_of_the_weights_asked_for(sources, hot, slots):
    weights = [hot] + [(1 - hot) / (sources - 1)] * (sources - 1)
    whole = sum(map(Fraction, weights))
    done, shares = [0] * sources, [Fraction(w) / whole for w in weights]
    plan = mixing.schedule([slots] * sources, mixing.exact(weights))
    for s, block, release, due, slot in plan:
        assert release <= slot < due and block == done[s]
        done[s] += 1
        # only the source that was served can be ahead by more than before, the others fall behind until they are due
        assert abs(done[s] - shares[s] * (slot + 1)) < 1
        if slot % 997 == 0:
            assert all(abs(n - w * (slot + 1)) < 1 for n, w in zip(done, shares, strict=True))
        if slot + 1 == slots:
            break


def test_weights_must_be_above_zero():
    for wrong in (0.0, -1.0, float("nan"), float("inf")):
        with pytest.raises((ValueError, OverflowError)):
            mixing.exact([1.0, wrong])


@pytest.mark.parametrize("weights", [None, {"hot": 0.2, "a": 0.5}])
def test_mix(spark, weights):
    docs = documents(spark)
    size = 500
    got = mixing.mix(docs, weights=weights, block_chars=size).collect()
    assert sorted((r["doc_id"] or 0, plain(r["text"])) for r in got) == sorted((i or 0, plain(t)) for i, t, *_ in rows())
    at = defaultdict(list)
    for r in got:
        at[r["source"]].append((r["at"], max(1, len(plain(r["text"]))), r["block"], r["slot"]))
        assert r["release"] <= r["slot"] < r["deadline"] and r["block"] == r["at"] // size
    for own in at.values():
        own.sort()
        assert all(a + n == b for (a, n, *_), (b, *_) in zip(own, own[1:], strict=False))
        assert [x[3] for x in own] == sorted(x[3] for x in own)
    assert len({(r["source"], r["block"]) for r in got}) == len({r["slot"] for r in got})
    few = mixing.mix(docs, weights=weights, block_chars=size, blocks=40)
    assert few.count() == len(got) and few.agg(F.max("block")).first()[0] < 40 < max(r["block"] for r in got)
    assert mixing.mix(nothing(spark)).count() == 0
    assert mixing.interleaved(docs).dtypes == docs.dtypes


def labelled(spark, texts: list[tuple[str, int, int]]):
    docs = spark.createDataFrame([(i, t, "en", "a", -1.0) for i, (t, *_) in enumerate(texts)], "doc_id long, text string, lang string, source string, p_toxic double")
    labels = [(i, q, x) for i, (_, q, x) in enumerate(texts) if i % 4] + [(None, 1, 1), (10**9, None, None)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def sentences(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "house", "river", "stone", "green", "walks", "over"]
    return [" ".join(rng.choice(words) for _ in range(30)) + "." for _ in range(n)]


def test_quality_tells_junk_from_clean(spark):
    clean = [(t, 1, 0) for t in sentences(400, 1)]
    junk = [(" ".join(f"{w}%%&" for w in t.split()), 0, 0) for t in sentences(20, 2)]
    junk += [(" ".join([t.split()[0]] * 30), 0, 0) for t in sentences(20, 3)]
    docs, labels = labelled(spark, clean + junk + [("", 1, 0), (None, 0, 0)])
    kept = {r["doc_id"]: r["kept"] for r in quality.classify(docs, labels).collect()}
    assert len(kept) == len(clean) + len(junk) + 2
    assert sum(kept[i] for i in range(len(clean))) >= 0.97 * len(clean)
    assert not any(kept[i] for i in range(len(clean), len(kept)))
    assert quality.classify(nothing(spark), labels).count() == 0
    unlabelled = {(r["perplexity"] is not None, r["kept"]) for r in quality.classify(documents(spark), labels.limit(0)).collect()}
    assert unlabelled == {(True, True), (False, False)}


def test_quality_probabilities_add_up(spark):
    docs, labels = labelled(spark, [(t, 1, 0) for t in sentences(60, 4)])
    model = quality.fit(docs, labels)
    symbols = [g for g in model.grams if len(g) == 1]
    for context in ("", "a", quality.START, "gamm", "never"):
        total = 0.0
        for symbol in [*symbols, "￿"]:
            gram, p = (context + symbol)[-quality.ORDER :], 0.0
            while gram not in model.grams and len(gram) > 1:
                p += model.backoff.get(gram[:-1], 0.0)
                gram = gram[1:]
            total += 10 ** (p + model.grams.get(gram, model.unknown))
        assert total == pytest.approx(1.0, abs=1e-9)


def slow_model(texts: list[str], order: int):
    """Interpolated modified Kneser-Ney by definition: the probability of a symbol after a context."""
    seen = defaultdict(int)
    for text in texts:
        for padded in slow_padded(text):
            for end in range(2, len(padded) + 1):
                for size in range(1, min(order, end) + 1):
                    seen[padded[end - size : end]] += 1
    before = defaultdict(set)
    for gram in seen:
        before[gram[1:]].add(gram[0])
    a = {g: n if len(g) == order or g[0] == quality.START else len(before[g]) for g, n in seen.items()}
    after, discounts = defaultdict(list), {}
    for gram in a:
        after[gram[:-1]].append(gram)
    for size in range(1, order + 1):
        t = [sum(1 for g, n in a.items() if len(g) == size and n == i) for i in range(1, 5)]
        y = t[0] / (t[0] + 2 * t[1]) if t[0] and t[1] else None
        raw = [(i + 1) - (i + 2) * y * t[i + 1] / t[i] if t[i] else 0.0 for i in range(3)] if y else [0.5, 1.0, 1.5]
        discounts[size] = [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)] if y else raw
    symbols = sum(1 for g in a if len(g) == 1)

    def probability(context: str, symbol: str) -> float:
        below = probability(context[1:], symbol) if context else 1.0 / (symbols + 1)
        if not after[context]:
            return below
        d = discounts[len(context) + 1]
        whole = sum(a[g] for g in after[context])
        rest = sum(d[min(a[g], 3) - 1] for g in after[context]) / whole
        n = a.get(context + symbol, 0)
        return (n - d[min(n, 3) - 1] if n else 0.0) / whole + rest * below

    return probability


def slow_padded(text: str) -> list[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    ends = [quality.AGAIN if w == n else quality.END for w, n in zip(words, [*words[1:], ""], strict=False)]
    return [quality.START + w + e for w, e in zip(words, ends, strict=True)]


def test_quality_by_brute_force(spark):
    rng = random.Random(21)
    unbroken = "".join(rng.choices("语言模型没有空格é🎉", k=3 * quality.PIECE + 7))
    exact = "".join(rng.choices("abc", k=2 * quality.PIECE - 1))  # with its end a whole number of pieces
    clean = [*sentences(25, 9), unbroken, exact, "again again again", "not labelled", "x" * 200]
    other = [unbroken[5:90], "Zebra house%% again again", "x", "", None, f"{exact} {exact}"]
    docs, labels = labelled(spark, [(t, 1, 0) for t in clean] + [(t, 0, 0) for t in other])
    probability = slow_model([t for i, t in enumerate(clean) if i % 4], quality.ORDER)  # the others have no label
    got = {r["doc_id"]: r["perplexity"] for r in quality.classify(docs, labels).collect()}
    for i, text in enumerate(clean + other):
        logs = [
            np.log10(probability(padded[max(0, end - quality.ORDER) : end - 1], padded[end - 1]))
            for padded in slow_padded(text or "") for end in range(2, len(padded) + 1)
        ]
        want = 10 ** (-sum(logs) / len(logs)) if logs else None
        assert got[i] == (want if want is None else pytest.approx(want, rel=1e-9))


def test_quality_learns_a_very_long_text_without_spaces(spark):
    text = "".join(random.Random(2).choices("αβγδε", k=400_000))
    docs, labels = labelled(spark, [("", 0, 0), (text, 1, 0), (text[:50_000], 0, 0)])
    got = {r["doc_id"]: r["perplexity"] for r in quality.classify(docs, labels).collect()}
    assert got[0] is None and 4.5 < got[1] < 5.5 and 4.5 < got[2] < 5.5


def test_quality_has_a_threshold_for_every_language(spark):
    texts = sentences(60, 3)
    docs = spark.createDataFrame([(i, t, f"lang{i % 1500}") for i, t in enumerate(texts * 50)], "doc_id long, text string, lang string")
    labels = docs.selectExpr("doc_id", "1 AS quality")
    got = quality.classify(docs, labels).where("threshold is not null").groupBy("lang").agg(F.max("perplexity").alias("p"), F.max("threshold").alias("t"))
    assert got.count() == 1500 and got.where("p > t").count() == 0


def test_quality_learns_from_every_trusted_row(spark, monkeypatch):
    words = ["".join(p) for p in product("aeiou", "bdglmnrst", "aeo", "kprst")]
    texts = [f"{words[i % 675]} {words[i * 7 % 675]}" for i in range(22_000)] + [f"{c}y{c}" for c in "cfhjqvwxz" for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = docs.selectExpr("doc_id", "1 AS quality")
    probability = slow_model(texts, quality.ORDER)
    want = {}
    for text in (*texts[:40], *texts[-540::60]):
        logs = [
            np.log10(probability(padded[max(0, end - quality.ORDER) : end - 1], padded[end - 1]))
            for padded in slow_padded(text) for end in range(2, len(padded) + 1)
        ]
        want[text] = pytest.approx(10 ** (-sum(logs) / len(logs)), rel=1e-9)

    def got():
        return {texts[r["doc_id"]]: r["perplexity"] for r in quality.classify(docs, labels).collect()}

    once = got()
    assert {t: once[t] for t in want} == want
    # several broadcasts of trusted rows and of n-grams
    monkeypatch.setattr(quality, "IDS", 9_000)
    monkeypatch.setattr(quality, "SHARD", 1_500)
    assert got() == {t: pytest.approx(p, rel=1e-12) for t, p in once.items()}


def test_quality_of_repeated_rows_and_of_marks_in_texts(spark, monkeypatch):
    texts = ["a\x00b \x02c\x03 \x05", "a\x00", "ab", "\x02ab", *["same row"] * 3]
    docs = spark.createDataFrame([(min(i, 4), t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = docs.selectExpr("doc_id", "1 AS quality")
    renamed = {t: t.translate({0: 0xFDD0, 2: 0xFDD2, 3: 0xFDD3, 5: 0xFDD5}) for t in texts}
    probability = slow_model([renamed[t] for t in texts], quality.ORDER)
    monkeypatch.setattr(quality, "SHARD", 20)
    got = quality.classify(docs, labels).collect()
    assert sorted(r["doc_id"] for r in got) == [0, 1, 2, 3, 4, 4, 4]
    for r in got:
        logs = [
            np.log10(probability(padded[max(0, end - quality.ORDER) : end - 1], padded[end - 1]))
            for padded in slow_padded(renamed[texts[r["doc_id"]]]) for end in range(2, len(padded) + 1)
        ]
        assert r["perplexity"] == pytest.approx(10 ** (-sum(logs) / len(logs)), rel=1e-9)


def test_quality_windows_do_not_depend_on_blocks(monkeypatch):
    letters = [chr(0x4E00 + i) for i in range(9_000)]  # more than five of which fill 64 bits
    texts = pa.array(["one two  two\tthree", "", " ", "".join(letters), " ".join(letters[:300]), "one 🎉"])
    words = quality.Words.of(texts)

    def flat():
        return [tuple(grams[i]) for _, which, grams in words.windows(quality.ORDER) for i in which]

    whole = flat()
    assert sorted("".join(map(chr, filter(None, g))) for g in whole) == sorted(
        padded[max(0, end - quality.ORDER) : end]
        for padded in {p for t in texts.to_pylist() for p in slow_padded(t)} for end in range(2, len(padded) + 1)
    )
    monkeypatch.setattr(quality, "BLOCK", 1)
    assert flat() == whole


def test_quality_thresholds_are_exact(spark):
    scores = spark.range(150_000).repartition(13).selectExpr(
        "id AS doc_id", "if(id % 50000 < 3, null, if(id % 3 = 0, 'a', if(id % 1000 = 1, 'few', 'b'))) AS lang",
        "if(id % 7 = 0, 5.5, abs(xxhash64(id)) / 1e17) AS perplexity",
    )
    labels = scores.selectExpr("doc_id", "int(doc_id % 4 > 0) AS quality")
    held = defaultdict(list)
    for r in scores.where("doc_id % 4 > 0").collect():
        held[r["lang"]].append(r["perplexity"])
    held["every"] = [p for own in held.values() for p in own]
    for quantile in (0.995, 0.5, 0.06, 0.0, 1.0):
        own, every = quality.thresholds(scores, labels, quantile)
        want = {lang: sorted(p)[max(0, ceil(quantile * len(p)) - 1)] for lang, p in held.items()}
        assert dict(own.collect()) | {"every": every, None: want[None]} == want


def test_toxicity_finds_held_out_rows(spark):
    clean = [(t, 1, 0) for t in sentences(400, 5)]
    rng = random.Random(7)
    toxic = []
    for t in sentences(80, 8):
        words = t.split()
        for _ in range(rng.randint(1, 8)):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scumbag", "scumlord"]))
        toxic.append((" ".join(words), 1, 1))
    docs, labels = labelled(spark, clean + toxic + [(None, 1, 0), ("", 1, 0)])
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    rejected = {i for i, r in got.items() if r["rejected"]}
    assert rejected == set(range(len(clean), len(clean) + len(toxic)))
    few = [got[i]["severity"] for i in rejected if len(toxic[i - len(clean)][0].split()) <= 32]
    many = [got[i]["severity"] for i in rejected if len(toxic[i - len(clean)][0].split()) >= 37]
    assert max(few) < min(many)
    assert model.cuts == tuple(sorted(model.cuts))
    kept = toxicity.accepted(docs, model)
    assert kept.dtypes == docs.dtypes and {r["doc_id"] for r in kept.collect()} == set(got) - rejected


def test_toxicity_of_a_short_passage_in_a_long_text(spark):
    rng = random.Random(14)
    known = ["".join(rng.choices("abcdefghijklm", k=6)) for _ in range(5000)]
    clean = [(" ".join(rng.choices(known, k=rng.randint(30, 900))), 1, 0) for _ in range(300)]
    toxic = []
    for _ in range(80):
        words = rng.choices(known, k=rng.randint(30, 200))
        for _ in range(rng.randint(2, 5)):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scumbag", "scumlord"]))
        toxic.append((" ".join(words), 1, 1))
    docs, labels = labelled(spark, clean + toxic)
    model = toxicity.fit(docs, labels)
    long = rng.choices(known, k=20_000)
    passage = [*long[:9000], "idiot", "and", "scumbag", "scumlord", "idiot", "scumbag", *long[9000:]]
    at_end = [*long, "idiot", "scumbag", "scumlord", "idiot", "scumbag"]
    texts = [(i, " ".join(w)) for i, w in enumerate([passage, at_end, long])]
    got = toxicity.score(spark.createDataFrame(texts, "doc_id long, text string"), model)
    assert {r["doc_id"]: r["rejected"] for r in got.collect()} == {0: True, 1: True, 2: False}


@pytest.mark.parametrize("n", [50, 200, 201, 900])
def test_worst_window_of_all_windows(n):
    rng = random.Random(n)
    held = [(i, rng.choice([["a"], ["b", "c"], ["a", "c"]])) for i in range(n) if rng.random() < 0.05]
    weights = {"a": 1.0, "b": 0.3, "c": 2.5}
    score = lambda counts: sum(weights[f] * toxicity.value(k, n) for f, k in counts.items())
    every = []
    for start in range(max(1, n - toxicity.WINDOW + 1)):
        counts = defaultdict(int)
        for place, own in held:
            if start <= place < start + toxicity.WINDOW:
                for f in own:
                    counts[f] += 1
        every.append(score(counts))
    assert toxicity.worst_window(held, score)[0] == pytest.approx(max(every))


def test_toxicity_without_labels_rejects_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents(spark), empty)
    assert toxicity.score(documents(spark), model).where("rejected").count() == 0
    assert toxicity.accepted(documents(spark), model).count() == len(rows())
    assert toxicity.score(nothing(spark), model).count() == 0


def test_the_last_stage_keeps_the_order_of_the_mix_over_many_files(spark, sf_dir, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    docs = documents(spark, clashing=False).where("doc_id < 100 and doc_id <> 11 and doc_id <> 10")
    want = {r["doc_id"]: (r["slot"], r["at"]) for r in mixing.mix(docs).collect()}
    stages["mixing"](spark, docs, sf_dir).repartition(7).write.parquet(f"{tmp_path}/mixed")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stages["bpe"](spark, spark.read.parquet(f"{tmp_path}/mixed"), sf_dir).write.parquet(f"{tmp_path}/out")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(str(f) for f in (tmp_path / "out").glob("part-*"))
    assert len(files) > 1
    got = [tuple(r) for f in files for r in spark.read.parquet(f).select("doc_id", "slot", "at").collect()]
    assert {i: place for i, *place in got} == {i: list(place) for i, place in want.items()}
    assert len(got) == len(want) and [r[1:] for r in got] == sorted(r[1:] for r in got)


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    mixed = stages["mixing"](spark, docs, sf_dir)
    assert mixed.dtypes == docs.dtypes and mixed.count() == docs.count()
    out = corpus_pipeline.run(spark, sf_dir)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = [r["doc_id"] for r in out.collect()]
    assert len(ids) == len(set(ids)) and len({texts[i] for i in ids}) == len(ids)
    twice = docs.groupBy("text").agg(F.count("*").alias("n"), F.max("doc_id").alias("last")).where("n > 1").collect()
    assert all(i not in ids for r in twice for i in (d for d, t in texts.items() if t == r["text"] and d != r["last"]))
