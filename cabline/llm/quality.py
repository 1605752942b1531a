"""Quality rules: base statistics and a hashed n-gram log-likelihood ratio.

Words are ``[^\\x20\\x09-\\x0D]+``; features are the hashes of single words and of
pairs of neighbours, in ``buckets`` buckets.  Two multinomials over the buckets,
smoothed by ``smoothing`` per bucket, are counted over *all* rows: the target
over the documents that are labelled trusted, the raw one over every document.
A text's score is the mean over its features of log p_target - log p_raw, so
long and short texts are on one scale.  Every document with a score under
the threshold is rejected: no draw is made.  The threshold separates the two
labels best: over a histogram of the scores of labelled documents that pass the base
rules it is the edge
that has the largest sum of the two labels' shares on their right side (the
middle of a range of equal edges); without both labels it is 0.

Cases: null and empty texts have no words and fail the base rules; labels that
name no document are ignored; a repeated label row counts once, and a document
labelled both ways isn't trusted; repeated documents are judged alike; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.llm._common import (TEXT_BATCH, TEXT_COMPRESSION, cut, id_and_text, mix64, setting,
                                 word_hashes)

BUCKETS = 1 << 16
SMOOTHING = 1.0
#: scores are cut to this range in the histogram, with so many cells
SCORE_RANGE, CELLS = 16.0, 4096
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_NOT_SYMBOLS = bytes(c for c in range(256) if c not in SYMBOLS)
_CONTINUATION = bytes(range(0x80, 0xC0))
_SPACES = b" \t\n\v\f\r"


def features(words: list[bytes], buckets: int) -> np.ndarray:
    """Buckets of the single words and neighbouring pairs (a power of two of them)."""
    h = word_hashes(words)
    pairs = mix64(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
    return (np.concatenate([h, pairs]) & np.uint64(buckets - 1)).astype(np.int64)


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more (exactly compared)."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) < 1 << 21:
        windows = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:                       # number the pairs first, so that the key still fits
        _, pair = np.unique((ids[:-1] << 31) | ids[1:], return_inverse=True)
        windows = (pair[:-1].astype(np.int64) << 31) | ids[2:]
    order = np.argsort(windows, kind="stable")
    same = np.diff(windows[order]) == 0
    again = np.zeros(n - 2, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= again
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x.strip(_SPACES)]
    return len(lines) - len(set(lines))


def base_statistics(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    inside = b"".join(words)
    return (len(words), len(inside.translate(None, _CONTINUATION)),
            len(text.translate(None, _NOT_SYMBOLS)), duplicate_lines(text),
            repeated_words(words))


def feature_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """(trusted, bucket, n) of ``docs(text, trusted)``: at most two rows per bucket
    and task leave a task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets), np.int64)
        for b in batches:
            for text, trusted in zip(b.column("text").to_pylist(), b.column("trusted").to_pylist()):
                if words := (text or b"").split():
                    found = features(words, buckets)
                    if len(found) * 8 < buckets:
                        np.add.at(total[int(trusted)], found, 1)
                    else:
                        total[int(trusted)] += np.bincount(found, minlength=buckets)
        kind, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind == 1), pa.array(bucket, pa.int32()), pa.array(total[kind, bucket])],
            ["trusted", "bucket", "n"])

    return (docs.select("text", "trusted")
            .mapInArrow(count, "trusted boolean, bucket int, n long")
            .groupBy("trusted", "bucket").agg(F.sum("n").alias("n")))


def log_ratio(counts: DataFrame, buckets: int, smoothing: float) -> np.ndarray:
    """Per bucket log p_target - log p_raw; ``counts`` has two rows per bucket at most."""
    found = counts.toPandas()
    total = np.zeros((2, buckets))
    total[found["trusted"].astype(int), found["bucket"]] = found["n"]
    target, raw = total[1] + smoothing, total.sum(0) + smoothing
    return (np.log(target / target.sum()) - np.log(raw / raw.sum())).astype(np.float64)


def best_threshold(cells: list[tuple[bool, int, int]]) -> float:
    """From (good, cell, n) rows, CELLS a label at most."""
    n = np.zeros((2, CELLS))
    for good, cell, count in cells:
        n[int(good), cell] += count
    if not n.sum(1).all():
        return 0.0
    share = np.cumsum(n, 1) / n.sum(1, keepdims=True)
    gain = np.concatenate([[0.0], share[0] - share[1]])     # edge i: cells under i rejected
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float((best[0] + best[-1]) / 2 / CELLS * 2 * SCORE_RANGE - SCORE_RANGE)


def quality_rules(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
                  smoothing: float = SMOOTHING, id_col: str = "doc_id", text_col: str = "text",
                  label_id_col: str = "doc_id", label_col: str = "quality",
                  carry: str | None = None) -> DataFrame:
    """Per document: doc_id, the base statistics, ``score``, ``base_failed``, ``kept``.

    ``labels``: label 1 marks a trusted document, 0 a bad one.  ``carry``: also
    a struct of this name with the row's own columns, so that a filter needs no join.
    """
    spark = docs.sparkSession
    rows = docs
    docs = id_and_text(docs, id_col, text_col)
    trust = (labels.select(F.col(label_id_col).cast("long").alias("doc_id"),
                           F.col(label_col).cast("int").alias("good"))
             .where("doc_id is not null and good in (0, 1)")
             .groupBy("doc_id").agg(F.min("good").alias("good"))
             .hint("merge"))        # labels grow with the documents: one plan at every size
    marked = docs.join(trust, "doc_id", "left")
    counts = feature_counts(
        marked.select("text", F.coalesce(F.col("good") == 1, F.lit(False)).alias("trusted")),
        buckets)
    with setting(spark, *TEXT_BATCH):
        ratio = spark.sparkContext.broadcast(log_ratio(counts, buckets, smoothing))

    carried = [carry] if carry else []

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column("text").to_pylist():
                text = text or b""
                words = text.split()
                score = float(ratio.value[features(words, buckets)].mean()) if words else 0.0
                rows.append((*base_statistics(text, words), score))
            found = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in found[:5]),
                 pa.array(found[5], pa.float64()), *(b.column(c) for c in carried)],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                 "score", *carried])

    kinds = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
             "n_repeat_words long, score double")
    if carry:
        whole = F.struct(*rows.columns).alias(carry)
        judged = rows.select(F.col(id_col).cast("long").alias("doc_id"),
                             F.col(text_col).cast("string").cast("binary").alias("text"), whole)
        kinds += f", `{carry}` {judged.schema[carry].dataType.simpleString()}"
    scored = (judged if carry else docs).mapInArrow(judge, kinds)
    cell = F.least(F.lit(CELLS - 1), F.greatest(F.lit(0), F.floor(
        (F.col("score") + SCORE_RANGE) / (2 * SCORE_RANGE) * CELLS))).cast("int")
    with setting(spark, *TEXT_BATCH):
        scored = cut(scored, "quality-scores", TEXT_COMPRESSION if carry else "snappy")
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    cells = (scored.where(~failed).join(trust, "doc_id")
             .groupBy((F.col("good") == 1).alias("good"), cell.alias("cell")).count())
    threshold = best_threshold([tuple(r) for r in cells.collect()])     # 2 * CELLS rows at most
    return (scored.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold)))
