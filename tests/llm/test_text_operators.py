"""Secret scan, exact dedup, encoding, token store and LM scores against plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import struct
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallymart.llm import bpe, exact_dedup, lm_score, secret_scan, token_store
from tallymart.llm.shared import settle, shared_folder, tokenizer_path
from tests.llm.samples import documents, low, nothing, order, plain, rows

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def base_spans(text: str) -> list[tuple]:
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


@pytest.mark.parametrize("block_rows", [3, 4096])
def test_secret_scan(spark, block_rows):
    scanned = secret_scan.scan(documents(spark), block_rows=block_rows)
    got = sorted(((r["doc_id"], [tuple(s) for s in r["spans"] if s["place"] < 3]) for r in scanned.collect()), key=str)
    assert got == sorted(((i, base_spans(plain(t))) for i, t, *_ in rows()), key=str)


def test_secret_report_and_added_rules(spark):
    text = "x ghp_" + "a" * 38 + " AIza" + "B" * 35 + " eyJhbGci.eyJzdWIi.c2lnbmF0dXJlLXBhcnQtaXM"
    report = secret_scan.report(spark.createDataFrame([(1, text), (2, None)], "doc_id int, text string"))
    one, two = sorted(report.collect(), key=lambda r: r["doc_id"])
    assert [k.split(":")[0] for k in one["spans"].split(",")] == ["github", "hex", "google", "jwt"]
    assert (one["n_hex"], one["base_sha256"]) == (1, sha("hex:6:44"))
    assert (two["spans"], two["base_sha256"]) == ("", sha(""))
    assert secret_scan.report(nothing(spark)).count() == 0


def test_a_crafted_text_is_scanned_in_seconds(spark):
    """Runs that every place of could begin a match, 1 MB and more."""
    token = "eyJhbGci.eyJzdWIi.c2lnbmF0dXJlLXBhcnQtaXM"
    texts = [".eyJ" + "eyJ" * 350_000, "eyJ-" * 250_000 + f" {token} x{token}", "password" + " " * 1_000_000, "AKIA" * 250_000]
    start = time.monotonic()
    got = secret_scan.report(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    assert time.monotonic() - start < 60
    spans = {r["doc_id"]: r["spans"] for r in got}
    at, size = 1_000_001, len(token)
    assert spans[1] == f"jwt:{at}:{at + size},jwt:{at + size + 2}:{at + 2 * size + 2}"
    assert (spans[0], spans[2], spans[3]) == ("", "", "access:0:1000000")


def test_trigram_queries_let_no_match_through_unseen():
    for rule in secret_scan.RULES:
        query = secret_scan.trigram_query(rule.pattern)
        for text in ('Api_Key="AAAABBBBCCCC"', "PASSWD:xxxxxxxxxxxx", "AKIA" + "Z" * 20, "f" * 20, "ghr_" + "0" * 36):
            if re.search(rule.pattern, text, re.A):
                assert any(all(t in text.lower() for t in part) for part in query)
    assert secret_scan.trigram_query("[0-9a-f]{16,}") == secret_scan.ANY
    assert secret_scan.trigram_query("(abc|xyz)+q") == {frozenset({"abc"}), frozenset({"xyz"})}


def expected_classes() -> list[tuple]:
    groups: dict[str, list] = {}
    for i, t, *_ in rows():
        groups.setdefault(plain(t), []).append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(
        ((i, keep[plain(t)], len(groups[plain(t)]), i == keep[plain(t)], sha(plain(t))) for i, t, *_ in rows()), key=order
    )


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"capacity": 2, "max_depth": 5},
        {"hash_of": lambda t: F.length(t).cast("long") % 4},
        {"hash_of": lambda t: F.length(t).cast("long") % 4, "digest_of": lambda t: F.substring(t, 1, 1)},
    ],
    ids=["usual", "small buckets", "hashes collide", "hashes and digests collide"],
)
def test_exact_dedup(spark, options):
    got = exact_dedup.classes(documents(spark), **options).collect()
    assert sorted(map(tuple, got), key=order) == expected_classes()


def test_directory_splits_only_what_is_overfull(spark):
    hashes = [(h << 56) - (1 << 64) * (h >> 7) for h in [0] * 9 + [1] + list(range(128, 256, 8))]
    entries = spark.createDataFrame([(h,) for h in hashes], "hash long")
    rows = {r["cell"]: r for r in exact_dedup.directory(entries, capacity=4, max_depth=8).collect()}
    assert rows[0]["depth"] == 8 and rows[1]["depth"] == 8  # nine equal hashes stay together
    assert {r["depth"] for c, r in rows.items() if c >= 128} == {3}


def test_exact_keepers_keep_columns_and_one_row_a_text(spark):
    docs = documents(spark)
    kept = exact_dedup.keepers(docs)
    assert kept.dtypes == docs.dtypes
    want = sorted({(k, t) for (_, k, _, _, t) in expected_classes()}, key=order)
    got = [(r["doc_id"], sha(plain(r["text"]))) for r in kept.collect()]
    assert sorted(got, key=order) == want
    assert exact_dedup.keepers(nothing(spark)).count() == 0 == exact_dedup.classes(nothing(spark)).count()


def library() -> Tokenizer:
    return Tokenizer.from_file(tokenizer_path())


def test_bpe_equals_the_library(spark):
    t = library()
    got = sorted(map(tuple, bpe.round_trip(documents(spark), tokenizer_path()).collect()), key=order)
    want = []
    for i, text, *_ in rows():
        ids = t.encode(plain(text), add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=order)
    assert bpe.round_trip(nothing(spark), tokenizer_path()).count() == 0


def test_bpe_of_odd_words():
    t, codec, writer = library(), bpe.codec(tokenizer_path()), token_store.id_writer(tokenizer_path())
    texts = ["x" * 5000, "Σς ΑΣ", "İstanbul", "é T̈", "don't 's ''re", "漢字かな", "\x1c\x85​", "<|startoftext|>a<|end"]
    texts += [f"a{chr(c)}b {chr(c)} x" for c in [*range(0x00, 0x100), *range(0x100, 0x3000, 7), 0x2028, 0x3000, 0xFEFF]] + ["Ᲊx \U00010d50"]
    for text in texts:
        ids = t.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == " ".join(map(str, ids))
        assert codec.decode(codec.encode(text)) == t.decode(ids, skip_special_tokens=False)
        assert writer.encode(text) == struct.pack(f"<{len(ids) + 1}I", *ids, token_store.END_ID)


def test_bpe_arrays_decode_again(spark):
    docs = documents(spark)
    ids = settle(bpe.encode(docs, tokenizer_path()), "ids")
    texts = sorted((plain(r["text"]) for r in bpe.decode(ids, tokenizer_path()).collect()))
    t = library()
    assert texts == sorted(t.decode(t.encode(plain(x), add_special_tokens=False).ids, skip_special_tokens=False) for _, x, *_ in rows())


def ids_of(t: Tokenizer, text: str | None) -> list[int]:
    return [*t.encode(plain(text), add_special_tokens=False).ids, token_store.END_ID]


def test_token_store(spark):
    t, at = library(), 0
    got = sorted(token_store.round_trip(documents(spark), tokenizer_path()).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, *_ in rows()), key=lambda i: (i is not None, i))
    want = Counter()
    for i, text, *_ in rows():
        ids = ids_of(t, text)
        want[i, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert token_store.round_trip(nothing(spark), tokenizer_path()).count() == 0


def test_token_store_gives_single_documents(spark):
    folder = f"{shared_folder(spark)}/single"
    token_store.write(documents(spark), tokenizer_path(), folder)
    t = library()
    assert token_store.fetch(spark, folder, 9) == [ids_of(t, rows()[8][1])]
    assert sorted(map(len, token_store.fetch(spark, folder, 11))) == [len(ids_of(t, "repeated row"))] * 2
    assert token_store.fetch(spark, folder, 12345) == []


def tokens(text: str | None) -> list[bytes]:
    return [*re.findall(rb"[^\x20\x09-\x0D]+", low(text)), lm_score.END_WORD]


@pytest.mark.parametrize("shard_tokens", [2000, 4_000_000])
def test_lm_scores(spark, shard_tokens):
    def trained(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2

    words, pairs = Counter(), Counter()
    for i, text, *_ in rows():
        if trained(i):
            own = tokens(text)
            words.update(own)
            pairs.update(zip([lm_score.BEGIN_WORD, *own[:-1]], own, strict=True))
    total, distinct, m = sum(words.values()), len(words), lm_score.MASS
    heads = {**words, lm_score.BEGIN_WORD: words[lm_score.END_WORD]}
    want = []
    for i, text, *_ in rows():
        own = tokens(text)
        p = [(words[w] + 1) / (total + distinct + 1) for w in own]
        score = sum(
            math.log10((pairs[v, w] + m * q) / (heads.get(v, 0) + m))
            for v, w, q in zip([lm_score.BEGIN_WORD, *own[:-1]], own, p, strict=True)
        )
        want.append((i, not trained(i), len(own), sum(words[w] > 0 for w in own), total, sum(map(math.log10, p)), score))
    got = sorted(map(tuple, lm_score.score(documents(spark), shard_tokens).collect()), key=lambda r: order(r[:4]))
    for a, b in zip(got, sorted(want, key=lambda r: order(r[:4])), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9)
        assert a[6] == pytest.approx(b[6], rel=1e-4)
    assert lm_score.score(nothing(spark)).count() == 0
