"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import gc
import pickle
import sys
import types
import uuid
from collections.abc import Callable

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabline.session import checkpoint_dir, table_path

#: rows of a batch where rows are whole texts or sets: a worker holds few of them
TEXT_BATCH = ("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
#: of a :func:`cut` that holds whole rows until its readers are done: smaller than snappy
TEXT_COMPRESSION = "zstd"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                binary: bool = True) -> DataFrame:
    """Only ``(doc_id long, text)``: other columns never reach the operators."""
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     (text.cast("binary") if binary else text).alias("text"))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint folder."""
    return checkpoint_dir(spark, f"{name}-{uuid.uuid4().hex}")


def cut(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again.

    A lost executor costs the tasks it ran, never a recomputation of what
    stands before the cut; shuffle files from before the cut can go."""
    spark = df.sparkSession
    path, schema = scratch(spark, name), df.schema
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.scratch_path = path
    return out


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the jobs run inside, put back afterwards."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def discard(df: DataFrame) -> None:
    """Drop the table of a :func:`cut` that no later plan reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that nothing refers to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def per_process(key: str, make):
    """A cache that the Python worker process keeps over its tasks: the two asked for
    last, so that a worker doesn't hold those of earlier stages."""
    home = sys.modules.setdefault("_cabline_llm_worker", types.ModuleType("_cabline_llm_worker"))
    kept = home.__dict__.setdefault("kept", {})
    found = kept.pop(key, None)
    if found is None:
        found = make()
        while len(kept) > 1:
            del kept[next(iter(kept))]
    kept[key] = found
    return found


def shared(spark: SparkSession, value) -> Callable:
    """A broadcast of ``value``, of bounded size; call the result inside a task.

    A plain broadcast pickles objects of this package's classes by reference, which
    needs the package in the workers; these bytes are pickled by value."""
    sent, key = spark.sparkContext.broadcast(cloudpickle.dumps(value)), uuid.uuid4().hex

    def get():
        return per_process(f"shared:{key}", lambda: pickle.loads(sent.value))

    return get


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits (murmur3)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class WordHashes(dict):
    """word (bytes) -> 64-bit hash; emptied when it has ``limit`` words."""

    limit = 100_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of the words of one text, in order."""
    cache = per_process("word_hashes", WordHashes)
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
