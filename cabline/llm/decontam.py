"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``window`` consecutive words (a shorter item
is one window).  A text that holds a window holds all its shingles (``shingle``
neighbouring words, or the whole window if that is shorter), so one of them is
a sufficient prefix: the rarest, by its count over *all* documents (first
pass).  The second pass looks up only these shingles in each text; a hit at
word i proposes the window at i minus the shingle's place in it (positional
bound), dropped where the window would leave the text (length bound), and
proposals are verified word by word.

The benchmark side is broadcast in blocks of at most ``block_words`` words;
documents are passed over once per block, so any benchmark size is whole and
bounded in memory, and no document is shuffled.

Cases: null and empty texts have no words and aren't contaminated; items
without words match nothing; a null item_id counts as the empty string; equal
items under several ids count each; repeated documents are judged alike; empty
tables give no hits or no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.llm._common import cut, id_and_text, mix64, shared

WINDOW = 13
SHINGLE = 5
BLOCK_WORDS = 1 << 20

_SEPARATORS = {*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)}
#: A-Z to a-z, then everything that is no word sign to a space
TO_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else 0x20 if c in _SEPARATORS else c
                 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TO_WORDS).split()


class Windows:
    """The distinct windows of a block of items, as rows of word numbers."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int, shingle: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if ids:
                size = min(window, len(ids))
                for i in range(len(ids) - size + 1):
                    owners.setdefault(tuple(ids[i:i + size]), set()).add(item)
        self.owners = [sorted(x) for x in owners.values()]
        self.words = [np.array(w, np.int64) for w in owners]
        self.spread = mix64(np.arange(len(self.vocabulary) + 1, dtype=np.uint64))
        #: shingle length -> (window numbers, sorted distinct keys, keys per window)
        self.by_length: dict[int, tuple] = {}
        for k in sorted({min(shingle, len(w)) for w in self.words}):
            of = [n for n, w in enumerate(self.words) if min(shingle, len(w)) == k]
            keys = [self.keys(self.words[n], k) for n in of]
            self.by_length[k] = (of, np.unique(np.concatenate(keys)), keys)

    def keys(self, ids: np.ndarray, k: int) -> np.ndarray:
        """A 64-bit key of the k words from each position."""
        h, n = self.spread[ids], len(ids) - k + 1
        key = np.zeros(max(n, 0), np.uint64)
        for j in range(k):
            key = key * np.uint64(0x9E3779B97F4A7C15) + h[j:n + j]
        return key

    def numbered(self, text: bytes | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.vocabulary.get, words, itertools.repeat(0)), np.int64,
                           len(words))

    def known(self, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, places in the sorted keys) of the text's k-word shingles that
        are shingles of windows."""
        if len(ids) < k:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        inside = np.concatenate([[0], np.cumsum(ids > 0)])
        at = np.flatnonzero(inside[k:] - inside[:-k] == k)
        if not len(at):
            return at, at
        h = self.spread[ids]
        key = np.zeros(len(at), np.uint64)
        for j in range(k):
            key = key * np.uint64(0x9E3779B97F4A7C15) + h[at + j]
        sorted_keys = self.by_length[k][1]
        place = np.minimum(np.searchsorted(sorted_keys, key), len(sorted_keys) - 1)
        found = sorted_keys[place] == key
        return at[found], place[found]

    def order(self, counts: dict[int, np.ndarray]) -> None:
        """Keep each window's rarest shingle (ties: the first) as its prefix."""
        self.prefix = {}
        for k, (of, sorted_keys, keys) in self.by_length.items():
            place = [np.searchsorted(sorted_keys, x) for x in keys]
            offset = np.array([int(np.argmin(counts[k][p])) for p in place])
            chosen = np.array([p[o] for p, o in zip(place, offset)])
            order = np.argsort(chosen, kind="stable")
            starts = np.searchsorted(chosen[order], np.arange(len(sorted_keys) + 1))
            self.prefix[k] = (starts, np.array(of)[order], offset[order])

    def search(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """(start, window number) of every occurrence in a text."""
        out = []
        for k, (starts, windows, offsets) in self.prefix.items():
            at, place = self.known(ids, k)
            n = starts[place + 1] - starts[place] if len(place) else place
            at, first, n = at[n > 0], starts[place[n > 0]] if len(place) else place, n[n > 0]
            for i, f, m in zip(at.tolist(), first.tolist(), n.tolist()):
                for w, o in zip(windows[f:f + m].tolist(), offsets[f:f + m].tolist()):
                    word = self.words[w]
                    if i >= o and i - o + len(word) <= len(ids) and np.array_equal(
                            ids[i - o:i - o + len(word)], word):
                        out.append((i - o, w))
        return out


def _counts(docs: DataFrame, block) -> dict[int, np.ndarray]:
    """Per shingle length the corpus counts of the block's shingles."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = block()
        total = {k: np.zeros(len(x[1]), np.int64) for k, x in windows.by_length.items()}
        for b in batches:
            for text in b.column("text").to_pylist():
                ids = windows.numbered(text)
                for k in total:
                    np.add.at(total[k], windows.known(ids, k)[1], 1)
        for k, n in total.items():
            place = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(place), k), pa.int32()), pa.array(place, pa.int64()),
                 pa.array(n[place], pa.int64())], ["k", "place", "n"])

    rows = (docs.select("text").mapInArrow(count, "k int, place long, n long")
            .groupBy("k", "place").agg(F.sum("n").alias("n")).toPandas())   # one per shingle
    out = {k: np.zeros(len(x[1]), np.int64) for k, x in block().by_length.items()}
    for k in out:
        of = rows[rows["k"] == k]
        out[k][of["place"].to_numpy()] = of["n"].to_numpy()
    return out


def _search(found: DataFrame, block, last: bool, carry: str | None = None) -> DataFrame:
    """Adds a block's hits to ``found(doc_id, text, spans, items[, carry])``; the last
    block's pass gives doc_id, n_words, n_hit, items[, carry]."""
    names = ["doc_id", *(["n_words", "n_hit"] if last else ["text", "spans"]), "items"]
    schema = "doc_id long, n_words long, n_hit long, items array<string>" if last else \
        "doc_id long, text binary, spans array<bigint>, items array<string>"
    carried = [carry] if carry else []
    if carry:
        schema += f", `{carry}` {found.schema[carry].dataType.simpleString()}"

    def judged(ids: np.ndarray, spans: list[int]) -> tuple[int, int]:
        hit = np.zeros(len(ids), bool)
        for start, end in zip(spans[::2], spans[1::2]):
            hit[start:end] = True
        return len(ids), int(hit.sum())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = block()
        for b in batches:
            spans, items, counts = [], [], []
            for text, s, i in zip(*(b.column(c).to_pylist() for c in ("text", "spans", "items"))):
                ids = windows.numbered(text)
                hits = windows.search(ids)
                for start, w in hits:
                    s += [start, start + len(windows.words[w])]
                spans.append(s)
                items.append(sorted({*i, *(x for _, w in hits for x in windows.owners[w])}))
                if last:
                    counts.append(judged(ids, s))
            if last:
                middle = [pa.array([c[j] for c in counts], pa.int64()) for j in (0, 1)]
            else:
                middle = [b.column("text"), pa.array(spans, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *middle, pa.array(items, pa.list_(pa.string())),
                 *(b.column(c) for c in carried)], [*names, *carried])

    return found.mapInArrow(search, schema)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       shingle: int = SHINGLE, block_words: int = BLOCK_WORDS,
                       id_col: str = "doc_id", text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text",
                       carry: str | None = None) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (sorted ids), contaminated.

    ``carry``: also a struct of this name with the row's own columns, so that a filter
    needs no join."""
    spark = docs.sparkSession
    rows, docs = docs, id_and_text(docs, id_col, text_col)
    judged = docs
    if carry:
        judged = rows.select(F.col(id_col).cast("long").alias("doc_id"),
                             F.col(text_col).cast("string").cast("binary").alias("text"),
                             F.struct(*rows.columns).alias(carry))
    items = benchmark.select(
        F.coalesce(F.col(item_id_col).cast("string"), F.lit("")).alias("item"),
        F.col(item_text_col).cast("string").cast("binary").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // (2 * block_words)))      # a word takes two bytes at least
    found = judged.withColumns({"spans": F.array().cast("array<bigint>"),
                              "items": F.array().cast("array<string>")})
    for n in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == n).collect()
        windows = Windows([(r["item"], r["text"]) for r in rows], window, shingle)
        sent = shared(spark, windows)
        windows.order(_counts(docs, sent))
        last = n == blocks - 1
        found = _search(found, shared(spark, windows), last, carry)
        if not last:
            found = cut(found, "decontamination")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      "items", ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
                      .alias("contaminated"), *([carry] if carry else []))


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
