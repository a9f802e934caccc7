"""What the operators share: reading tables, settled tables in the shared folder, packing of texts."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT = "spark.checkpoint.dir"
TOKENIZER = "word_bpe_49k.json"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local session without one gets a temporary folder."""
    folder = spark.conf.get(CHECKPOINT, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set(CHECKPOINT, folder)
    return folder.rstrip("/")


def settle(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: cuts lineage, survives lost executors, runs once."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once an application: they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        folder = tempfile.mkdtemp(prefix="package-")  # the driver serves the file from there
        root = Path(__file__).resolve().parents[2]
        context.addPyFile(shutil.make_archive(f"{folder}/tallymart", "zip", root, "tallymart"))
        _shipped.add(context.applicationId)


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """`df.mapInArrow(run, schema)` with this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def whole_text(column: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that `df` does not use (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the installed package of public tokenizers keeps a file, the same on every executor."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
