"""Helpers that several operators share."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table of a folder, with these columns only."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Only a local session without one gets a folder of its own, as in tests.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    import tempfile

    folder = f"file://{tempfile.mkdtemp(prefix='llm-')}"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Stored:
    """Intermediate tables of one call, written below the shared folder and reread.

    Writing cuts the lineage: what an executor loses later is read again, not computed again.
    ``drop`` deletes tables that are no longer used.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
        self.count = 0

    def put(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stored_at = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def fold(column: str, modulus: int):
    """crc32 of a column as text, modulo ``modulus``; a null counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every input bit over the output."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bounded number of them."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.array([self[w] for w in words], dtype=np.uint64)
