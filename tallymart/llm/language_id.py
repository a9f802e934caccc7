"""Language of a text by rank-order profiles.

A profile is the list of a language's most frequent n-grams of letters, most frequent first.  A text's
own list is compared with each: every n-gram adds by how many places it is out of place, one that the
profile lacks adds the profile's length.  The nearest profile names the language.

Letters are those of Unicode, in lower case; everything else parts words.  N-grams have 1 to 3
characters of a word with a blank before and behind it, except the blank alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.shared import free_name, map_batches, settle, whole_text

FOLDS, HELD = 3, 1  # held out: crc32 of the doc_id's text, modulo FOLDS, is HELD
LENGTH = 400  # n-grams of a profile, and of a text's own list
LANGUAGES = 128  # languages compared in one pass, about; more take more passes
UNKNOWN = "und"
PIECE = 1 << 20  # characters of a text taken at once
GRAMS = 1_000_000  # distinct n-grams that a task adds up before it passes them on
BITS = 21  # of a character in an n-gram's code
BLANK = 0x20

COUNTED = "lang string, gram long, n long"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Per code point its lower case if it is a letter, else 0.  Letters whose lower case is longer stay as they are."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        letter = chr(code)
        if letter.isalpha():
            low = letter.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The codes of a text's n-grams, in order, and how often each occurs; long texts are taken in pieces."""
    table, parts = _letters(), []
    tail = np.full(1, BLANK, np.uint32)  # holds no two blanks
    for start in range(0, len(text), PIECE):
        piece = text[start : start + PIECE]
        codes = table[np.frombuffer(piece.encode("utf-32-le"), np.uint32)]
        if start + PIECE >= len(text):
            codes = np.append(codes, np.uint32(0))
        codes[codes == 0] = BLANK
        codes = np.concatenate([tail, codes])
        blank = codes == BLANK
        codes = codes[~(blank & np.concatenate([[False], blank[:-1]]))].astype(np.int64)  # one blank where there are several
        parts.append(_counted(codes, len(tail)))
        tail = codes[-2:].astype(np.uint32)
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return parts[0] if len(parts) == 1 else merged(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _counted(codes: np.ndarray, fresh: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams that end at place `fresh` or later."""
    blank, found = codes == BLANK, [codes[fresh:][codes[fresh:] != BLANK]]
    if len(codes) >= 2:
        two = (codes[:-1] << BITS) | codes[1:]
        found.append(two[max(fresh - 1, 0) :])
    if len(codes) >= 3:
        three = (codes[:-2] << 2 * BITS) | (codes[1:-1] << BITS) | codes[2:]
        found.append(three[max(fresh - 2, 0) :][~blank[1:-1][max(fresh - 2, 0) :]])
    return np.unique(np.concatenate(found), return_counts=True)


def merged(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes that occur several times added up."""
    every, place = np.unique(codes, return_inverse=True)
    sums = np.zeros(len(every), np.int64)
    np.add.at(sums, place, counts)
    return every, sums


def spelled(code: int) -> str:
    """The characters of an n-gram's code."""
    found = ""
    while code:
        found, code = chr(code & (1 << BITS) - 1) + found, code >> BITS
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of COUNTED, added up in part."""
    found: dict[str, list] = {}
    held = 0

    def passed() -> Iterator[pa.RecordBatch]:
        for lang, parts in found.items():
            codes, counts = merged(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), codes, counts], ["lang", "gram", "n"])

    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            part = grams(text)
            found.setdefault(lang, []).append(part)
            held += len(part[0])
            if held >= 4 * GRAMS:
                found = {own: [merged(*(np.concatenate(x) for x in zip(*parts, strict=True)))] for own, parts in found.items()}
                held = sum(len(parts[0][0]) for parts in found.values())
                if held >= GRAMS:
                    yield from passed()
                    found, held = {}, 0
    yield from passed()


def profiles(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Rows (lang, gram, n, rank): the `length` most frequent n-grams of each language; ties to the lower code.

    Learnt from all rows with a language.  A language without letters has no rows.
    """
    rows = docs.where("lang is not null").select("lang", whole_text().alias("text"))
    counts = map_batches(rows, _count, COUNTED).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= length)


def _nearest(batches: Iterator[pa.RecordBatch], model, length: int, places: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    """Batches with columns text, best, distance, size at `places`; the model's languages compete with the best so far."""
    names, known, ranks = model.value
    for batch in batches:
        texts, best, distances, sizes = (batch.column(p).to_pylist() for p in places)
        for row, text in enumerate(texts):
            codes, counts = grams(text or "")
            if not len(codes):
                continue
            own = codes[np.lexsort((codes, -counts))[:length]]
            out = np.full((len(names), len(own)), length, np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                held = np.flatnonzero(known[at] == own)
                there = ranks[:, at[held]]
                out[:, held] = np.where(there < length, np.abs(there - held), length)
            sums = out.sum(1)
            nearest = int(sums.argmin())  # names are in order: ties to the first
            sizes[row] = len(own)
            here = int(sums[nearest]), names[nearest].encode()
            if best[row] is None or here < (distances[row], best[row].encode()):
                best[row], distances[row] = names[nearest], here[0]
        columns = list(batch.columns)
        for place, values, kind in zip(places[1:], (best, distances, sizes), (pa.string(), pa.int64(), pa.int64()), strict=True):
            columns[place] = pa.array(values, kind)
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def _model(rows: list, names: list[str], length: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, all n-grams of their profiles in order, and each one's place per language (`length`: none)."""
    known = np.unique(np.array([r["gram"] for r in rows], np.int64))
    ranks = np.full((len(names), len(known)), length, np.int32)
    at = {name: i for i, name in enumerate(names)}
    for r in rows:
        ranks[at[r["lang"]], np.searchsorted(known, r["gram"])] = r["rank"] - 1
    return names, known, ranks


def predict(docs: DataFrame, learned: DataFrame, known: DataFrame, length: int = LENGTH, languages: int = LANGUAGES) -> DataFrame:
    """`docs` with lang_pred and score, by the profiles `known` of the languages (column lang) in `learned`.

    The score is 1 less the distance's share of the largest possible one.  Ties go to the language that is
    first in the order of its UTF-8 bytes.  A text that is null or has no letter is `und`, with score 0, and so is
    every text if nothing was learnt.  Languages are compared about `languages` at a time: a pass sends the
    profiles of so many to the executors, later passes keep the nearest so far; no text is shuffled.
    """
    spark = docs.sparkSession
    best, distance, size = (free_name(docs, c) for c in ("_best", "_distance", "_size"))
    none = F.lit(None)
    rows = docs.select("*", none.cast("string").alias(best), none.cast("long").alias(distance), none.cast("long").alias(size))
    places = tuple(rows.columns.index(c) for c in ("text", best, distance, size))
    learned = settle(learned.select("lang").distinct(), "languages")
    known = settle(known, "profiles")
    blocks = -(-learned.count() // languages)
    for block in range(blocks):
        own = learned.where(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == block)
        names = sorted((r["lang"] for r in own.collect()), key=str.encode)
        if not names:
            continue
        profile = known.join(own, "lang").select("lang", "gram", "rank").collect()  # at most `length` rows a name
        model = spark.sparkContext.broadcast(_model(profile, names, length))
        rows = map_batches(rows, partial(_nearest, model=model, length=length, places=places), rows.schema)
    score = 1 - F.col(distance) / (F.col(size) * length)
    return rows.select(
        *docs.columns, F.coalesce(F.col(best), F.lit(UNKNOWN)).alias("lang_pred"), F.coalesce(score, F.lit(0.0)).alias("score")
    )


def held_out() -> Column:
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(name, "UTF-8")), F.lit(FOLDS)) == HELD


def identify(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), one per row of `docs`; learnt from the rows not held out.

    Texts are predicted from the text alone.  A null doc_id counts as the empty text; repeated rows each
    count; without rows to learn from all is `und`.  Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", held_out().alias("held_out"))
    train = docs.where("not held_out")
    learned = train.where("lang is not null").select("lang").distinct()
    found = predict(docs.select("doc_id", "held_out", "text"), learned, profiles(train, length), length)
    return found.select("doc_id", "held_out", "lang_pred", "score")
