"""Token ids in binary packs: one zstandard frame a document, under a dictionary that all frames share.

A store has two tables.  ``dictionary``: its hash and bytes, trained on the ids of a bounded sample
of short documents.  ``packs``, in ascending order of doc_id: shard, first_token (ids of the shard
before the pack), dictionary hash, and for each document its doc_id, number of ids and the place of
its frame in ``payload`` (the offset index); a document is read by its offset alone.  A frame holds
the ids as little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.bpe import Memo, WordSplitter, byte_letters
from tallymart.llm.shared import map_batches, shared_folder, whole_text

SAMPLE = 2000  # documents that the dictionary is trained on
SAMPLE_CHARS = 4096  # longest of them
DICTIONARY = 32 << 10  # bytes
LEVEL = 3
PACK_DOCS = 256
PACK_BYTES = 1 << 20  # of ids; a longer document fills a pack alone
END_ID = 1
UNLIKE = "\x1c\x1d\x1e\x1f"  # characters that part strings here, but words not
PACK = (
    "shard int, first_token long, tokens long, dictionary string, doc_ids array<long>, counts array<long>,"
    " offsets array<long>, payload binary"
)


class IdWriter:
    """Ids of whole texts as bytes.

    Words never reach across white space, so the stretches between it are remembered, and the words that new
    stretches are made of; a new word is encoded by the tokenizers library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self.split = WordSplitter(json.load(file), path)
        letters, model = byte_letters(), self.split.library.model

        def make(word: str) -> bytes:
            piece = "".join([letters[b] for b in word.encode()])
            return array("I", [t.id for t in model.tokenize(piece)]).tobytes()

        words = Memo(make)
        self.words = lambda text: b"".join(map(words.__getitem__, self.split.words(text)))
        find = self.split.find
        self.stretches = Memo(lambda part: b"".join(map(words.__getitem__, find(part))))

    def encode(self, text: str) -> bytes:
        """The ids of a text and the end id."""
        out = []
        for i, part in enumerate(self.split.parts(text)):
            if i % 2:
                out.append(self.split.special[part].to_bytes(4, "little"))
            elif any(c in part for c in UNLIKE) or self.split.has_new_letters(part):
                out.append(self.words(part))
            else:
                out += map(self.stretches.__getitem__, self.split.normal(part).split())
        out.append(END_ID.to_bytes(4, "little"))
        return b"".join(out)


@lru_cache(maxsize=2)
def id_writer(path: str) -> IdWriter:
    return IdWriter(path)


def train(docs: DataFrame, path: str, sample: int = SAMPLE) -> bytes:
    """The shared dictionary, trained on the `sample` short documents with the lowest hash of doc_id.

    Too few or too uniform documents give raw content instead; none give an empty dictionary.
    """
    short = docs.select(F.xxhash64("doc_id").alias("place"), whole_text().alias("text"))
    short = short.where(F.length("text") <= SAMPLE_CHARS)
    hashed = short.select("place", F.xxhash64("text").alias("tie"))
    chosen = hashed.orderBy("place", "tie").limit(sample).distinct()  # numbers only, at most `sample` rows
    picked = short.withColumn("tie", F.xxhash64("text")).join(F.broadcast(chosen), ["place", "tie"])
    rows = picked.dropDuplicates(["place", "tie"]).orderBy("place", "tie").select("text").collect()
    ids = [id_writer(path).encode(r["text"]) for r in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY, ids).as_bytes()
    except zstandard.ZstdError:
        return b"".join(ids)[:DICTIONARY]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def write(docs: DataFrame, path: str, folder: str) -> None:
    """Writes the ids of every row of `docs` to a store in `folder`.

    A null text counts as empty (the end id alone).  Rows with one doc_id are ordered by the hash of
    their text; null doc_ids come first.
    """
    spark = docs.sparkSession
    shared = train(docs, path)
    rows = [(digest(shared), bytearray(shared))]
    spark.createDataFrame(rows, "hash string, data binary").coalesce(1).write.parquet(f"{folder}/dictionary")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = id_writer(path).encode
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared)).compress
        shard, name, first = TaskContext.get().partitionId(), digest(shared), 0
        ids: list[int | None] = []
        counts: list[int] = []
        frames: list[bytes] = []

        def full() -> pa.RecordBatch:
            offsets = [0]
            for frame in frames:
                offsets.append(offsets[-1] + len(frame))
            row = [shard, first, sum(counts), name, ids, counts, offsets, b"".join(frames)]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string(), *[pa.list_(pa.int64())] * 3, pa.binary()]
            fields = [pa.array([v], k) for v, k in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(fields, [c.split()[0] for c in PACK.split(", ")])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = encode(text.as_py())
                if ids and (len(ids) >= PACK_DOCS or 4 * sum(counts) + len(data) > PACK_BYTES):
                    yield full()
                    first += sum(counts)
                    ids, counts, frames = [], [], []
                ids.append(doc_id)
                counts.append(len(data) // 4)
                frames.append(press(data))
        if ids:
            yield full()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
        .withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    )
    map_batches(ordered, pack, PACK).write.option("compression", "none").parquet(f"{folder}/packs")


def _dictionary_of(spark: SparkSession, folder: str) -> bytes:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    data = bytes(row["data"])
    if digest(data) != row["hash"]:
        raise ValueError("the dictionary is not the one that was written")
    return data


def _documents(spark: SparkSession, folder: str, column: str, kind: pa.DataType, of: Callable[[bytes], object]) -> DataFrame:
    """Rows (doc_id, start, n_tokens, `column`): `of` the ids of each document, `start` the ids of all before."""
    shared = _dictionary_of(spark, folder)
    name = digest(shared)
    packs = spark.read.parquet(f"{folder}/packs")
    totals = packs.groupBy("shard").agg(F.sum("tokens").alias("n"))  # a row a writing task
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select("shard", F.coalesce(before, F.lit(0)).alias("base"))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor(dict_data=_dictionary(shared)).decompress
        for batch in batches:
            for i in range(batch.num_rows):
                at, written, doc_ids, counts, offsets = (batch.column(c)[i].as_py() for c in range(5))
                payload = batch.column(5)[i].as_buffer()
                if written != name:
                    raise ValueError("a pack of another dictionary")
                starts, found = [], []
                for count, i0, i1 in zip(counts, offsets, offsets[1:], strict=False):
                    starts.append(at)
                    at += count
                    found.append(of(expand(payload[i0:i1])))
                columns = [pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(found, kind)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", column])

    placed = packs.join(totals, "shard").select(
        (F.col("base") + F.col("first_token")).alias("at"), "dictionary", "doc_ids", "counts", "offsets", "payload"
    )
    kinds = {pa.binary(): "binary", pa.int64(): "long"}
    return map_batches(placed, unpack, f"doc_id long, start long, n_tokens long, {column} {kinds[kind]}")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of a store: `ids` as written, `start` the ids of all documents before."""
    return _documents(spark, folder, "ids", pa.binary(), bytes)


def fetch(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """The ids of the documents with one doc_id, reading only their frames' packs."""
    expand = zstandard.ZstdDecompressor(dict_data=_dictionary(_dictionary_of(spark, folder))).decompress
    found = spark.read.parquet(f"{folder}/packs").where(F.array_contains("doc_ids", F.lit(doc_id)))
    place = F.explode(F.filter(F.sequence(F.lit(1), F.size("doc_ids")), lambda i: F.element_at("doc_ids", i) == doc_id))
    frames = found.select("payload", "offsets", place.alias("i")).selectExpr(
        "substring(payload, int(offsets[i - 1]) + 1, int(offsets[i] - offsets[i - 1])) AS frame"
    )
    out = []
    for row in frames.collect():
        ids = array("I")
        ids.frombytes(expand(bytes(row["frame"])))
        out.append(ids.tolist())
    return out


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) of every row of `docs`, from files written and read back."""
    folder = f"{shared_folder(docs.sparkSession)}/token-store-{uuid.uuid4().hex}"
    write(docs, path, folder)
    return _documents(docs.sparkSession, folder, "ids_crc32", pa.int64(), zlib.crc32)
