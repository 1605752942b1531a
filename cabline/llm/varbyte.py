"""Token files: frequency-ranked ids in a byte-aligned variable-length code.

Layout.  Every id of the corpus is replaced by its rank by frequency (ties: the
smaller id first), so frequent ids take one byte.  A block holds whole
documents: per four ranks one *control* byte (2 bits each: data bytes minus
one), the *data* bytes apart from them, little-endian.  A shard is the blocks
of one range of document ids in order; Spark's committer writes the shards, so
a lost or repeated task leaves no part of a file.  ``ranks`` holds the ids by
rank.  Decoding looks the control bytes up in a 256-row table and gathers all
ranks of a block with numpy.

Cases: a null or empty text is one end id; a null doc_id sorts first; rows that
repeat a doc_id are kept, ordered by the hash of their text; an empty table
gives files without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cabline.llm._common import cut, id_and_text, release
from cabline.llm.tokens import encode_texts

BLOCK_IDS = 1 << 18

_BLOCKS = ("shard int, start long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, "
           "control binary, data binary")


def length_table() -> np.ndarray:
    """Row c: the data bytes of the four ranks under control byte c."""
    c = np.arange(256, dtype=np.uint8)
    return np.stack([((c >> (2 * i)) & 3) + 1 for i in range(4)], 1).astype(np.uint8)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit ranks."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    n = ((ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).astype(np.uint8)
    quads = np.zeros(-(-len(n) // 4) * 4, np.uint8)
    quads[:len(n)] = n
    quads = quads.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(4, dtype=np.uint8)[None, :] <= n[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks of :func:`pack`'s output."""
    sizes = length_table()[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(sizes, dtype=np.int64)
    at = ends - sizes
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(sizes > k)
        out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _raw_blocks(docs: DataFrame, tokenizer: str, end_id: int, shards: int) -> DataFrame:
    """The blocks with their ids as they are, in ascending doc_id order."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, start = TaskContext.get().partitionId(), 0
        doc_ids, lengths, parts, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            small = ids.max() <= 0xFFFF
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([start], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
                 pa.array([lengths], pa.list_(pa.int64())),
                 pa.array([(ids.astype("<u2") if small else ids).tobytes()], pa.binary())],
                ["shard", "start", "n_ids", "doc_ids", "lengths", "ids"])

        for b in batches:
            texts = encode_texts(tokenizer, b.column("text").to_pylist(), end_id)
            for doc_id, found in zip(b.column("doc_id").to_pylist(), texts):
                doc_ids.append(doc_id)
                lengths.append(len(found) // 4)
                parts.append(found)
                size += lengths[-1]
                if size >= BLOCK_IDS:
                    yield block()
                    start += size
                    doc_ids, lengths, parts, size = [], [], [], 0
        if doc_ids:
            yield block()

    return (docs.withColumn("tie", F.xxhash64("text"))
            .repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
            .drop("tie").mapInArrow(blocks, "shard int, start long, n_ids long, "
                                    "doc_ids array<bigint>, lengths array<bigint>, ids binary"))


def _ids(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")


def id_counts(blocks: DataFrame) -> DataFrame:
    """(id, n): each task sends at most one row per id of the vocabulary."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            for raw, n in zip(b.column("ids").to_pylist(), b.column("n_ids").to_pylist()):
                part = np.bincount(_ids(raw, n), minlength=len(total))
                part[:len(total)] += total
                total = part
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()),
                                          pa.array(total[found], pa.int64())], ["id", "n"])

    return (blocks.select("ids", "n_ids").mapInArrow(count, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")))


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text",
                      shards: int | None = None) -> None:
    """Write the token files of ``docs`` to folder ``path`` in ascending doc_id order."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # texts are sorted and tokenised once; ranks need all counts first
    blocks = cut(_raw_blocks(id_and_text(docs, id_col, text_col), tokenizer, end_id, shards),
                 "token-blocks", compression="zstd")
    release(spark)
    ranked = id_counts(blocks).orderBy(F.desc("n"), "id").toPandas()    # at most the vocabulary
    ids = ranked["id"].to_numpy(np.int64)
    (spark.createDataFrame([(ids.astype("<u4").tobytes(),)], "ids binary").coalesce(1)
     .write.parquet(f"{path}/ranks"))
    rank_of = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
    rank_of[ids] = np.arange(len(ids), dtype=np.uint32)
    ranks = spark.sparkContext.broadcast(rank_of)                       # at most the vocabulary

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                one = b.slice(i, 1)
                raw, n = one.column("ids")[0].as_py(), one.column("n_ids")[0].as_py()
                control, data = pack(ranks.value[_ids(raw, n)])
                yield pa.RecordBatch.from_arrays(
                    [*(one.column(c) for c in ("shard", "start", "n_ids", "doc_ids", "lengths")),
                     pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                    ["shard", "start", "n_ids", "doc_ids", "lengths", "control", "data"])

    (blocks.mapInArrow(coded, _BLOCKS).write.option("compression", "zstd")
     .parquet(f"{path}/shards"))


def read_token_files(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Per document ``doc_id, start, n_tokens`` and its ids: ``ids`` (little-endian
    32-bit integers) or, with ``digest``, ``ids_crc32`` of those bytes."""
    ids = np.frombuffer(spark.read.parquet(f"{path}/ranks").first()["ids"], "<u4")
    by_rank = spark.sparkContext.broadcast(ids)                 # at most the vocabulary
    shards = spark.read.schema(_BLOCKS).parquet(f"{path}/shards")
    # one row per shard, whose number is set by the writer
    sums = shards.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    last, kind = ("ids_crc32", "long") if digest else ("ids", "binary")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(c)[i].as_py() for c in b.schema.names}
                raw = by_rank.value[unpack(row["control"], row["data"], row["n_ids"])].tobytes()
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                cuts = [raw[4 * s:4 * e] for s, e in zip((ends - lengths).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()),
                     pa.array(ends - lengths + (row["base"] + row["start"]), pa.int64()),
                     pa.array(lengths, pa.int64()),
                     pa.array([zlib.crc32(c) for c in cuts], pa.int64()) if digest
                     else pa.array(cuts, pa.binary())],
                    ["doc_id", "start", "n_tokens", last])

    return (shards.join(F.broadcast(base), "shard")
            .mapInArrow(documents, f"doc_id long, start long, n_tokens long, {last} {kind}"))
