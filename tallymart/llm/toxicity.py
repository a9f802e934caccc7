"""Toxicity by cumulative-link ordinal regression on sparse counts of words.

Grades: 0 clean, 1 mild, 2 severe.  The labels know toxic or not; a toxic row is severe if it holds
more of the chosen words than the median toxic row.  One weight vector serves all thresholds:
``P(grade <= g) = 1 / (1 + exp(x . w - cut_g))``.

A text is as severe as its worst window of `WINDOW` words, so a toxic passage does not fade in a long text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import map_batches, whole_text

SAMPLE = 20_000  # labelled rows that the model is fitted on, those with the lowest hash of doc_id
WORDS = 1000  # most features that the model weighs
LEAST_ROWS = 5  # sample rows that must hold a feature
LEAST_Z = 6.0  # deviations by which its share among toxic rows must exceed that among clean ones
GRADES = 3
MARGIN = 0.25
PER_WORDS, FEW_WORDS = 200, 20  # features count per so many words; a short text counts as so many more
WINDOW = 200  # words of a window; a shorter text is one window
STEPS, RATE, SHRINK = 600, 0.05, 3e-4

STEMS = (5, 6, 7, 8)  # lengths of word beginnings that are features beside the whole words
MEMO = 500_000  # words whose features a worker remembers

WORD = regex.compile(r"\p{L}+")


def features(word: str) -> list[str]:
    """A word and its beginnings, which are marked by a star."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


class Weighed(dict):
    """The weighed features of each word seen; emptied when it holds `MEMO` words."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> list[str]:
        if len(self) >= MEMO:
            self.clear()
        found = self[word] = [f for f in features(word) if f in self.weights]
        return found


@dataclass(frozen=True)
class Model:
    """Weights of features, the increasing cuts between grades, and the probability of any grade above
    clean from which a document is rejected."""

    weights: dict[str, float]
    cuts: tuple[float, ...]
    reject: float = 0.5

    def scorer(self, words: int) -> Callable[[dict[str, int]], float]:
        """The score of a window's counts in a text of so many words."""
        return lambda counts: sum(self.weights[f] * value(n, words) for f, n in counts.items())

    def grades(self, texts: list[str]) -> np.ndarray:
        """Probabilities of the grades, a row a text."""
        find, known = WORD.findall, Weighed(self.weights)
        scores = np.zeros(len(texts))
        for i, text in enumerate(texts):
            words = find(text.lower())
            held = [(place, own) for place, own in enumerate(map(known.__getitem__, words)) if own]
            scores[i] = worst_window(held, self.scorer(len(words)))[0]
        return probabilities(scores, np.array(self.cuts))


def value(count: int, words: int) -> float:
    """Of a feature that occurs `count` times in a window of a text of `words` words."""
    return float(np.log1p(PER_WORDS * count / (min(words, WINDOW) + FEW_WORDS)))


def worst_window(held: list[tuple[int, list]], score: Callable[[dict], float]) -> tuple[float, dict]:
    """The highest score of all windows and the counts there, of the places and features of a text's weighed words.

    With weights of at least 0 only windows that begin with a weighed word and reach one more than
    the window before can be the worst.
    """
    best, worst, counts, end = 0.0, {}, {}, 0
    for place, own in held:
        before = end
        while end < len(held) and held[end][0] < place + WINDOW:
            for f in held[end][1]:
                counts[f] = counts.get(f, 0) + 1
            end += 1
        if end > before and (now := score(counts)) > best:
            best, worst = now, dict(counts)
        if end == len(held):
            break
        for f in own:
            counts[f] -= 1
            if not counts[f]:
                del counts[f]
    return best, worst


def probabilities(scores: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    below = 1 / (1 + np.exp(np.clip(scores[:, None] - cuts[None, :], -500, 500)))
    edge = np.ones((len(scores), 1))
    return np.diff(np.hstack([0 * edge, below, edge]), axis=1)


def fit_cuts(features: list[dict[int, float]], grades: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, cuts) of the greatest penalised likelihood, by Adam over the whole sample."""
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    col = np.array([w for f in features for w in f], np.int64)
    value = np.array([x for f in features for x in f.values()])
    share = np.cumsum(np.bincount(grades, minlength=GRADES) + 1)[:-1] / (len(grades) + GRADES)
    first = np.log(share / (1 - share))
    # cuts are a first one and logarithms of the steps between, so they stay in order
    point = np.concatenate([np.zeros(words), first[:1], np.log(np.maximum(np.diff(first), 1e-3))])
    mean, spread = np.zeros_like(point), np.zeros_like(point)
    for step in range(1, STEPS + 1):
        cuts = np.cumsum(np.concatenate([point[words : words + 1], np.exp(point[words + 1 :])]))
        scores = np.bincount(row, value * point[col], minlength=len(features)) if words else np.zeros(len(features))
        below = np.hstack([
            np.zeros((len(scores), 1)),
            1 / (1 + np.exp(np.clip(scores[:, None] - cuts, -500, 500))),
            np.ones((len(scores), 1)),
        ])
        at = np.arange(len(scores))
        slope = below * (1 - below)
        p = np.maximum(below[at, grades + 1] - below[at, grades], 1e-12)
        pull = -(slope[at, grades + 1] - slope[at, grades]) / p  # of the log-likelihood by the score
        by_cut = np.zeros(GRADES - 1)
        for g in range(GRADES - 1):
            by_cut[g] = (slope[grades == g, g + 1] / p[grades == g]).sum() - (
                slope[grades == g + 1, g + 1] / p[grades == g + 1]
            ).sum()
        later = np.cumsum(by_cut[::-1])[::-1]
        up = np.concatenate([
            np.bincount(col, value * pull[row], minlength=words)[:words] if words else np.zeros(0),
            later[:1],
            later[1:] * np.exp(point[words + 1 :]),
        ]) / len(features)
        up[:words] -= SHRINK * point[:words]
        mean = 0.9 * mean + 0.1 * up
        spread = 0.999 * spread + 0.001 * up**2
        point = point + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
        point[:words] = np.maximum(point[:words], 0)  # chosen for their toxic rows, features only raise severity
    cuts = np.cumsum(np.concatenate([point[words : words + 1], np.exp(point[words + 1 :])]))
    return point[:words], cuts


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def _features(words: Column) -> Column:
    def stem(n: int) -> Column:
        long = F.filter(words, lambda w: F.length(w) > n)
        return F.transform(long, lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))

    return F.concat(words, *(stem(n) for n in STEMS))


HELD = "toxic int, size int, places array<int>, found array<string>"


def _holder(chosen: frozenset) -> Callable:
    """Of rows (toxic, words): how many words, and those that have a chosen feature, with their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Weighed(dict.fromkeys(chosen, 0.0))
        for batch in batches:
            sizes, places, found = [], [], []
            for words in batch.column(1):
                own = words.as_py()
                at = [i for i, w in enumerate(own) if known[w]]
                sizes.append(len(own))
                places.append(at)
                found.append([own[i] for i in at])
            columns = [
                batch.column(0), pa.array(sizes, pa.int32()), pa.array(places, pa.list_(pa.int32())),
                pa.array(found, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "size", "places", "found"])

    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of a bounded sample of labelled rows.

    Null labels are left out; a doc_id labelled twice counts as toxic if any label says so.  Copies
    and near copies (equal smallest and largest hash of two words in a row) count once, so that one mislabelled text
    cannot teach its words.  Without toxic or without clean rows no word is weighed and nothing
    is rejected.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    chosen = (
        known.agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )  # at most `sample` rows of two numbers, so it may be broadcast
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
        .join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", _words(F.col("text")).alias("words"))
    )
    hashes = F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1)))
    rows = (
        rows.groupBy(F.array_min(hashes).alias("low"), F.array_max(hashes).alias("high"))
        .agg(F.min_by(F.struct("toxic", "words"), F.struct("doc_id", "words")).alias("row")).select("row.*")
        .persist()
    )
    try:
        totals = dict(rows.groupBy("toxic").count().collect())
        clean, toxic = totals.get(0, 0), totals.get(1, 0)
        if not clean or not toxic:
            return Model({}, tuple(50.0 + g for g in range(GRADES - 1)))
        share = (F.col("bad") + F.col("good")) / (clean + toxic)
        z = (F.col("bad") / toxic - F.col("good") / clean) / F.sqrt(share * (1 - share) * (1 / toxic + 1 / clean))
        best = (
            rows.select("toxic", F.explode(F.array_distinct(_features(F.col("words")))).alias("word"))
            .groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
            .where((F.col("bad") + F.col("good") >= LEAST_ROWS) & (share < 1) & (z >= LEAST_Z))
            .orderBy(F.desc(z), "word").limit(WORDS).collect()
        )
        words = [r["word"] for r in best]
        held = map_batches(rows.select("toxic", "words"), _holder(frozenset(words)), HELD).collect()
    finally:
        rows.unpersist()
    place = {w: i for i, w in enumerate(words)}
    kept, values, counts = [], [], []
    for r in held:
        own = [(at, [f for f in features(w) if f in place]) for at, w in zip(r["places"], r["found"], strict=True)]
        # before there are weights, the worst window is the one that holds most features
        most = worst_window(own, lambda c: sum(c.values()))[1]
        values.append({place[f]: value(n, r["size"]) for f, n in most.items()})
        counts.append(sum(len(f) for _, f in own))
        kept.append((own, r["size"]))
    bad = np.array([r["toxic"] for r in held]) > 0
    counts = np.array(counts)
    severe = bad & (counts > np.median(counts[bad & (counts > 0)] if (bad & (counts > 0)).any() else [0]))
    weights, cuts = fit_cuts(values, bad.astype(int) + severe, len(words))
    model = Model(dict(zip(words, weights.tolist(), strict=True)), tuple(cuts.tolist()))
    scores = np.array([worst_window(own, model.scorer(n))[0] for own, n in kept])
    return replace(model, reject=best_threshold(1 - probabilities(scores, cuts)[:, 0], bad))


def best_threshold(p: np.ndarray, bad: np.ndarray) -> float:
    """The cut that parts the sample best (greatest F1): `MARGIN` of the way, in log odds, from the
    highest probability that it lets pass to the lowest that it catches."""
    levels = np.unique(p)
    order = np.argsort(p)
    ahead = np.searchsorted(p[order], levels)
    caught = bad.sum() - np.concatenate([[0], np.cumsum(bad[order])])[ahead]
    f1 = 2 * caught / np.maximum(len(p) - ahead + bad.sum(), 1)
    at = int(f1.argmax())
    if not at:
        return float(levels[-1] + 1)
    low, high = np.clip(levels[at - 1 : at + 1], 1e-12, 1 - 1e-12)
    odds = (1 - MARGIN) * np.log(low / (1 - low)) + MARGIN * np.log(high / (1 - high))
    return float(1 / (1 + np.exp(-odds)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, p_toxic, severity, grade, rejected), one per row of `docs`.

    `severity` is the expected grade of the whole text.  A null or empty text holds no weighed word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.grades(batch.column(1).to_pylist())
            toxic = 1 - p[:, 0]
            columns = [
                batch.column(0), pa.array(toxic), pa.array(p @ np.arange(p.shape[1])),
                pa.array(p.argmax(axis=1).astype(np.int32)), pa.array(toxic >= model.reject),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "p_toxic", "severity", "grade", "rejected"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return map_batches(docs, run, "doc_id long, p_toxic double, severity double, grade int, rejected boolean")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` that are not rejected, with their columns."""
    place = [c.lower() for c in docs.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.grades([t or "" for t in batch.column(place).to_pylist()])
            yield batch.filter(pa.array(1 - p[:, 0] < model.reject))

    return map_batches(docs, run, docs.schema)
