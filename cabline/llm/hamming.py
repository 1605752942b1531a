"""MinHash near-duplicates by a multi-index Hamming join of b-bit signatures.

A document's set is its distinct ``shingle``-word shingles (64-bit hashes;
A-Z lower-cased).  Equal sets are one *representative* from here on.  Its
signature has ``chunks * lanes`` b-bit minima of 16 bits; the signature distance
of two documents is the number of lanes that differ.  By the pigeonhole
principle, two signatures at distance ``chunks * (errors + 1) - 1`` or less have
a chunk with at most ``errors`` (1) differing lanes, so both own the key made
of that chunk without some lane: each representative enumerates its chunks
without each lane, ``chunks * lanes`` keys, and *every* pair under the distance
threshold meets in a bucket.  At similarity s a lane differs with probability
1 - s; chunks and lanes follow from ``percent`` so that a pair just similar enough
is over the threshold at most once in 12,000 (``shape_of``: 23 of 72 lanes at
0.85, 29 of 75 at 0.80); more similar pairs practically never.

Links are wanted up to connectivity, so buckets needn't be expanded into pairs:
1. every member of a bucket has the bucket's smallest one as its leader (a
   combinable minimum, joined back: a hot bucket is split by the skew join);
   each document is compared with the leader it shares most buckets with.  Candidates
   over the signature distance or whose set sizes rule the similarity out are
   dropped, the others confirmed on the full sets;
2. the confirmed links are a forest (a leader is smaller), whose roots are found
   by pointer doubling.  Trees that meet in a bucket, through its leader, form a
   *cluster*; a cluster of one tree is done;
3. members outside a cluster's largest tree are compared with ``REPRESENTATIVES`` members
   of it, which joins nearly all that belong together with a number of comparisons
   in proportion to the members;
4. only what is still outside is compared with all members of its cluster: in blocks of
   bounded size, as products of the blocks' set matrices inside a task.  These
   tests are exact on the full sets, in particular for all pairs under the signature
   distance.  Pairs are never rows: a task returns the trees it found linked.
Step 4 takes (members outside) x (members) products: for a large family whose members
are all similar but under the threshold there is no cheaper proof; its tasks are small.
The links found join the trees to components.

Cases: null or empty texts have empty sets, are linked with nothing and are
kept; a text of fewer words is one shingle; rows of a null doc_id have no
component but are kept; rows that repeat a doc_id are one document; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.llm._common import (TEXT_BATCH, cut, discard, id_and_text, mix64, release, setting,
                                 word_hashes)
from cabline.llm.graph import components, joined, roots

SHINGLE = 5
PERCENT = 80            # of five-word shingles; op8's contract has 85
ERRORS = 1
MISS = 1 / 12_000       # of the pairs that are just similar enough, at most
MAX_LANES, MAX_KEYS = 6, 80     # of a chunk; of a representative
_ONE_PASS = 2048        # shingles whose minima are computed at once
REPRESENTATIVES = 8
#: of a block of step 4: members outside the largest tree, members, shingles of either
BLOCK_OUT, BLOCK_ALL, BLOCK_SHINGLES = 256, 512, 400_000
_COLUMNS = 1 << 12      # shingles of a matrix at once


class Shape(NamedTuple):
    """Of a signature: chunks, and lanes of a chunk."""

    chunks: int
    lanes: int

    @property
    def size(self) -> int:
        return self.chunks * self.lanes

    @property
    def distance(self) -> int:
        return self.chunks * (ERRORS + 1) - 1

    def miss(self, percent: int) -> float:
        """The probability that a pair of this similarity is over the distance."""
        n, s = self.size, percent / 100
        return sum(comb(n, k) * (1 - s) ** k * s ** (n - k)
                   for k in range(self.distance + 1, n + 1))


@lru_cache
def shape_of(percent: int) -> Shape:
    """The shape with the longest (most selective) keys, then the fewest, that misses few
    enough pairs; with two lanes a chunk there may be any number of keys."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be over 0 and at most 100")
    for lanes in range(MAX_LANES, 1, -1):
        chunks = 1
        while lanes == 2 or chunks * lanes <= MAX_KEYS:
            if Shape(chunks, lanes).miss(percent) <= MISS:
                return Shape(chunks, lanes)
            chunks += 1


CHUNKS, LANES = shape_of(PERCENT)
MAX_DISTANCE = shape_of(PERCENT).distance


def shingle_set(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 64-bit shingle hashes of a text."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    size = min(shingle, len(h))
    key = np.full(len(h) - size + 1, size, np.uint64)
    for j in range(size):
        key = key * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - size + 1 + j]
    return np.unique(mix64(key))


def _factors(size: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix64(np.arange(1, 2 * size + 1, dtype=np.uint64))
    return seeds[:size] | np.uint64(1), seeds[size:]


def signature(found: np.ndarray, size: int = CHUNKS * LANES, factors=None) -> bytes:
    """The 16-bit minima of a set that isn't empty."""
    multiply, add = factors or _factors(size)
    least = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(found), _ONE_PASS):
        part = found[i:i + _ONE_PASS, None] * multiply + add
        np.minimum(least, part.min(0), out=least)
    return (mix64(least) >> np.uint64(48)).astype("<u2").tobytes()


def bucket_keys(signatures: np.ndarray, shape: Shape = shape_of(PERCENT)) -> np.ndarray:
    """(n, shape.size) keys: each chunk without each of its lanes."""
    lanes = signatures.reshape(-1, *shape).astype(np.uint64)
    place = np.arange(shape.lanes, dtype=np.uint64) << np.uint64(16)
    mixed = mix64(lanes + place + np.uint64(1 << 32))
    salt = mix64(np.arange(shape.size, dtype=np.uint64) + np.uint64(1 << 40))
    whole = mixed.sum(2, keepdims=True, dtype=np.uint64)
    return mix64((whole - mixed).reshape(len(lanes), -1) + salt).view(np.int64)


def _summaries(docs: DataFrame, shingle: int, shape: Shape) -> DataFrame:
    """doc_id, n_shingles, set_hash (null for empty sets), signature."""
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        factors = _factors(shape.size)
        for b in batches:
            n, hashes, signatures = [], [], []
            for text in b.column("text").to_pylist():
                found = shingle_set(text, shingle)
                n.append(len(found))
                hashes.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signatures.append(signature(found, shape.size, factors) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(hashes, pa.binary()),
                 pa.array(signatures, pa.binary())],
                ["doc_id", "n_shingles", "set_hash", "signature"])

    return docs.mapInArrow(summarise, "doc_id long, n_shingles long, set_hash binary, "
                                      "signature binary")


def _bucket_rows(reps: DataFrame, shape: Shape) -> DataFrame:
    """(key, id): a row for each key of each representative."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                part = b.slice(i, 2048)
                raw = b"".join(part.column("signature").to_pylist())
                keys = bucket_keys(np.frombuffer(raw, "<u2"), shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.reshape(-1)),
                     pa.array(np.repeat(part.column("id").to_numpy(), shape.size))],
                    ["key", "id"])

    return reps.select("id", "signature").mapInArrow(rows, "key long, id long")


def _close(pairs: DataFrame, reps: DataFrame, percent: int, shape: Shape) -> DataFrame:
    """The ``pairs(a, b)`` under the signature distance whose set sizes allow a link."""
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sides = [np.frombuffer(b"".join(b.column(c).to_pylist()), "<u2")
                         .reshape(-1, shape.size) for c in ("sig_a", "sig_b")]
                keep = pa.array((sides[0] != sides[1]).sum(1) <= shape.distance)
                yield b.select(["a", "b"]).filter(keep)

    a, b = (reps.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"),
                        F.col("signature").alias(f"sig_{x}")) for x in "ab")
    sized = pairs.join(a, "a").join(b, "b").where(
        100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return sized.select("a", "b", "sig_a", "sig_b").mapInArrow(near, "a long, b long")


def _sets(ids: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(id, found): the full sets of the documents ``ids(id)``."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([shingle_set(x, shingle).tobytes() for x in
                                               b.column("text").to_pylist()], pa.binary())],
                ["id", "found"])

    # ids grow with the documents: one plan at every size
    ids = ids.withColumnRenamed("id", "doc_id").hint("merge")
    of = docs.join(ids, "doc_id", "left_semi").mapInArrow(sets, "id long, found binary")
    with setting(docs.sparkSession, *TEXT_BATCH):
        return cut(of, "shingle-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs(a, b)`` of ids whose full sets are similar enough."""
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("set_a").to_pylist(), b.column("set_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return (pairs.join(sets.select(F.col("id").alias("a"), F.col("found").alias("set_a")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("found").alias("set_b")), "b")
            .select("a", "b", "set_a", "set_b").mapInArrow(linked, "a long, b long"))


def common_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """(len(x), len(y)) sizes of the intersections of sorted sets, exactly (below 2 ** 24)."""
    out = np.zeros((len(x), len(y)), np.float32)
    shared = np.intersect1d(np.unique(np.concatenate(x)), np.unique(np.concatenate(y)),
                            assume_unique=True)
    for i in range(0, len(shared), _COLUMNS):
        columns = shared[i:i + _COLUMNS]
        sides = []
        for side in (x, y):
            m = np.zeros((len(side), len(columns)), np.float32)
            for row, found in zip(m, side):
                part = found[np.searchsorted(found, columns[0]):
                             np.searchsorted(found, columns[-1], "right")]
                at = np.searchsorted(columns, part)
                row[at[columns[at] == part]] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def _dealt(out: DataFrame, every: DataFrame) -> DataFrame:
    """(cluster, id, tree, outside, i, j): block ``i`` of the members outside meets block ``j`` of
    all members; a row goes to as many tasks as the other side has blocks."""
    def blocks(side: DataFrame, name: str, rows: int) -> DataFrame:
        need = F.greatest(F.ceil(F.count("*") / rows), F.ceil(F.sum("n") / BLOCK_SHINGLES))
        return side.groupBy("cluster").agg(need.cast("int").alias(name))

    size = blocks(out, "rows", BLOCK_OUT).join(blocks(every, "columns", BLOCK_ALL), "cluster")
    counts = {"i": "rows", "j": "columns"}

    def side(members: DataFrame, own: str, other: str, outside: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.col(counts[own])).cast("int").alias(own)
        return members.join(size, "cluster").select(
            "cluster", "id", "tree", F.lit(outside).alias("outside"), block,
            F.explode(F.sequence(F.lit(0), F.col(counts[other]) - 1)).alias(other))

    return side(out, "i", "j", True).unionByName(side(every, "j", "i", False))


def _block_links(out: DataFrame, every: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs of trees that a member of ``out`` and one of ``every`` link, both
    ``(cluster, id, tree, n)``; all pairs of one cluster are tested."""
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        outside = table["outside"].to_numpy()
        tree = table["tree"].to_numpy()
        found = [np.frombuffer(x, np.uint64) for x in table["found"].to_pylist()]
        x, y = np.flatnonzero(outside), np.flatnonzero(~outside)
        links = np.zeros((0, 2), np.int64)
        if len(x) and len(y):
            n = np.array([len(s) for s in found])
            both = common_counts([found[i] for i in x], [found[i] for i in y])
            either = n[x][:, None] + n[y][None, :] - both
            i, j = np.nonzero((100 * both >= percent * either)
                              & (tree[x][:, None] != tree[y][None, :]))
            pairs = np.sort(np.stack([tree[x[i]], tree[y[j]]], 1), 1)
            links = np.unique(pairs, axis=0) if len(pairs) else links
        yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])

    return (_dealt(out, every).join(sets, "id").groupBy("cluster", "i", "j")
            .applyInArrow(test, "a long, b long").distinct())


def _joined_clusters(star: DataFrame, part: DataFrame, reps: DataFrame, sets: DataFrame,
                     percent: int) -> DataFrame:
    """``part(id, component)`` after steps 3 and 4."""
    a, b = (part.select(F.col("id").alias(x), F.col("component").alias(f"part_{x}")) for x in "ab")
    meeting = cut(star.select(F.col("leader").alias("a"), F.col("id").alias("b"))
                  .join(a, "a", "left").join(b, "b", "left")
                  .select(F.coalesce("part_a", "a").alias("a"), F.coalesce("part_b", "b").alias("b"))
                  .where("a <> b").distinct(), "meeting-trees")
    cluster = components(meeting).select(F.col("id").alias("tree"), F.col("component").alias("cluster"))
    ids = star.select("id").unionByName(star.select(F.col("leader").alias("id"))).distinct()
    members = cut(ids.join(part, "id", "left").withColumn("tree", F.coalesce("component", "id"))
                  .join(cluster, "tree").join(reps.select("id", "n"), "id")
                  .select("cluster", "id", "tree", "n"), "cluster-members")

    def outside(members: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(members outside their cluster's largest tree, (cluster, main))."""
        trees = members.groupBy("cluster", "tree").count()
        main = trees.groupBy("cluster").agg(
            F.max_by("tree", F.struct("count", "tree")).alias("main"), F.count("*").alias("trees"))
        main = main.where("trees > 1").select("cluster", "main")
        return members.join(main, "cluster").where("tree <> main").drop("main"), main

    out, main = outside(members)
    of_main = members.join(main, "cluster").where("tree = main")
    chosen = of_main.groupBy("cluster", "tree").agg(*[
        F.min_by("id", F.xxhash64("id", F.lit(k))).alias(f"r{k}") for k in range(REPRESENTATIVES)])
    chosen = (chosen.select("cluster", "tree", F.explode(F.array_distinct(F.array(*[
        f"r{k}" for k in range(REPRESENTATIVES)]))).alias("id"))
        .join(reps.select("id", "n"), "id").select("cluster", "id", "tree", "n"))
    with setting(star.sparkSession, *TEXT_BATCH):
        found = cut(_block_links(out, chosen, sets, percent), "links-of-representatives")
    joined_trees = components(found)
    top = joined_trees.select(F.col("id").alias("tree"), F.col("component").alias("top"))
    members = cut(members.join(top, "tree", "left").select(
        "cluster", "id", F.coalesce("top", "tree").alias("tree"), "n"), "cluster-members")
    part = joined(part, joined_trees)
    out, main = outside(members)
    every = members.join(main.select("cluster"), "cluster")
    with setting(star.sparkSession, *TEXT_BATCH):
        found = cut(_block_links(out, every, sets, percent), "links-of-blocks")
    return joined(part, components(found))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    Linked: ``100 * |A & B| >= percent * |A | B|``; component_id is the smallest
    doc_id reachable; kept where that is the document itself."""
    docs, shape = id_and_text(docs, id_col, text_col), shape_of(percent)
    with setting(docs.sparkSession, *TEXT_BATCH):
        found = cut(_summaries(docs, shingle, shape), "signatures")
    # one representative a set; equal sets are linked without comparison
    reps = cut(found.where("set_hash is not null").groupBy("set_hash", "signature")
               .agg(F.min("doc_id").alias("id"), F.max("n_shingles").alias("n"))
               .where("id is not null"), "representatives")

    rows = _bucket_rows(reps, shape)
    least = (rows.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last"))
             .where("last > leader").select("key", "leader"))
    star = cut(rows.join(least, "key").where("id <> leader").groupBy("leader", "id").count(),
               "stars")
    release(docs.sparkSession)
    best = star.groupBy("id").agg(F.max_by("leader", F.struct("count", -F.col("leader"))).alias("a"))
    near = cut(_close(best.select("a", F.col("id").alias("b")), reps, percent, shape), "pairs")
    ids = star.select("id").unionByName(star.select(F.col("leader").alias("id"))).distinct()
    sets = _sets(ids, docs, shingle)
    release(docs.sparkSession)
    # each links to one smaller id at most: a forest, whose roots are its components
    with setting(docs.sparkSession, *TEXT_BATCH):
        links = cut(_confirmed(near, sets, percent), "links")
    part = roots(links.select(F.col("b").alias("id"), F.col("a").alias("component")))
    part = _joined_clusters(star, part, reps, sets, percent)
    discard(sets)
    release(docs.sparkSession)

    of_set = reps.join(part, "id", "left").select(
        "set_hash", F.coalesce("component", "id").alias("component_id"))
    out = found.select("doc_id", "n_shingles", "set_hash").join(of_set, "set_hash", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"),
                      F.col("doc_id").eqNullSafe(own).alias("kept"))
