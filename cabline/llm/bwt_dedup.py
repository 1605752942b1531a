"""Repeated passages by a column-wise multi-document Burrows-Wheeler construction.

Every byte covered by a ``length``-byte string that starts anywhere else too is
removed.  The collection is first cut into *segments* so that equal strings
can meet without sorting the corpus: each ``length``-byte window is anchored at
its leftmost smallest hash of ``ANCHOR`` bytes, and neighbouring windows with one
anchor form a segment.  Equal windows have equal anchors at equal places, so
they lie in segments of one key (the anchor's hash), aligned at the anchor.

A key that occurs once can't hold a repeat and is dropped by a combinable count.
Equal texts are one text from there on, with as many copies, and equal segments of a key
one string with a multiplicity.  The other keys'
strings are dealt to tasks by key and read in key order from Spark's sorted
shuffle files, a bounded batch of whole groups at a time.  For a batch the
construction goes over the aligned columns from the last to the first and
inserts one symbol of every string a round: the strings' suffix order at a
column follows from the order one column later by a stable sort of the column's
symbols (which, in that order, are the column's part of the collection's
transform), and the common-prefix lengths follow by range minima over the former ones.  A
window is repeated where its suffix has a neighbour with a common prefix of
``length`` or more, or its string a multiplicity of two or more.

A round costs O(strings); inserting symbols of *unaligned* documents instead
costs a pass over the whole transform for each of as many rounds as the longest
document has bytes (README).  A key with more than ``max_group`` different
strings (a passage in very many surroundings) is split by the 128-bit hash of
each window, under which only equal windows meet.

Cases: a null text is empty; texts under ``length`` bytes lose nothing; matches
never cross documents; repeated rows repeat each other, at a cost in proportion to
their number; a null or repeated doc_id is ordinary, as spans belong to texts (80 bits of
hashes), whatever their ids; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.llm._common import cut, discard, id_and_text, mix64, release

LENGTH = 200
ANCHOR = 32             # bytes, a power of two
PIECE = 1 << 20         # windows of a text that are hashed at once
MAX_GROUP = 50_000
BATCH_STRINGS = 16_384
SALTS = 16              # parts of a key, where rows meet the keys that occur twice

_BYTES = mix64(np.arange(1, 257, dtype=np.uint64))


def anchor_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ANCHOR bytes from each position, by doubling."""
    h, power, size = _BYTES[data], np.uint64(0x9E3779B97F4A7C15), 1
    with np.errstate(over="ignore"):
        while size < ANCHOR:
            h = h[:-size] * power + h[size:]
            power, size = power * power, 2 * size
    return mix64(h)


def sliding_minimum(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from running minima within blocks."""
    n = len(v) - width + 1
    padded = np.full(-(-len(v) // width) * width, np.iinfo(v.dtype).max, v.dtype)
    padded[:len(v)] = v
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def segments(text: bytes, length: int = LENGTH) -> Iterator[tuple[np.ndarray, ...]]:
    """Per piece: (key, first window, windows, anchor minus first window)."""
    data = np.frombuffer(text, np.uint8)
    low = np.uint64((1 << 21) - 1)
    for base in range(0, max(0, len(data) - length + 1), PIECE):
        h = anchor_hashes(data[base:base + PIECE + length - 1])
        marked = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        at = (sliding_minimum(marked, length - ANCHOR + 1) & low).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
        windows = np.diff(np.concatenate([first, [len(at)]]))
        yield h[at[first]].view(np.int64), first + base, windows, at[first] - first


def _segment_rows(docs: DataFrame, length: int) -> DataFrame:
    """(key, content, row, place): ``content`` is a hash of the segment's bytes; place
    packs the row's ``more`` bits, first window, windows and anchor distance."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            for row, more, text in zip(*(b.column(c).to_pylist() for c in
                                         ("row", "more", "text"))):
                for key, first, windows, before in segments(text or b"", length):
                    content = [xxhash.xxh3_64_intdigest(text[i:j]) for i, j in zip(
                        first.tolist(), (first + windows + length - 1).tolist())]
                    place = (np.int64(more) << 48) | (first << 16) | (windows << 8) | before
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(np.array(content, np.uint64).view(np.int64)),
                         pa.array([row] * len(key), pa.int64()),
                         pa.array(place.astype(np.int64))],
                        ["key", "content", "row", "place"])

    return docs.mapInArrow(_gathered(rows), "key long, content long, row long, place long")


def _gathered(rows, size: int = 20_000):
    """``rows`` with its small batches put together."""
    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0
        for b in rows(batches):
            kept.append(b)
            n += b.num_rows
            if n >= size:
                yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
                kept, n = [], 0
        if kept:
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches()

    return gathered


def _unpacked(place: str = "place") -> list:
    p = F.col(place)
    return [F.shiftright(p, 48).bitwiseAND(0xFFFF).cast("int").alias("more"),
            F.shiftright(p, 16).bitwiseAND(0xFFFFFFFF).alias("first"),
            F.shiftright(p, 8).bitwiseAND(0xFF).cast("int").alias("windows"),
            p.bitwiseAND(0xFF).cast("int").alias("before")]


def repeated_windows(group: np.ndarray, strings: list[bytes], before: np.ndarray,
                     length: int = LENGTH) -> np.ndarray:
    """(strings, columns) flags of the windows that another string of the same group
    holds at the same distance from its anchor.

    ``group`` ascends; column ``length - ANCHOR`` is the anchor's, and a string
    begins ``before`` columns ahead of it.
    """
    anchor, n = length - ANCHOR, len(strings)
    sizes = np.fromiter(map(len, strings), np.int64, n)
    start = anchor - before
    end = start + sizes
    columns = int(end.max())
    symbols = np.zeros((columns, n), np.int16)      # 0: no symbol here, else byte + 1
    raw = np.frombuffer(b"".join(strings), np.uint8)
    of = np.repeat(np.arange(n), sizes)
    column = np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + start[of]
    symbols[column, of] = raw.astype(np.int16) + 1
    order = np.arange(n)
    common = np.zeros(n + 1, np.int32)              # with the one before; [n] is a sentinel
    found = np.zeros((anchor + 1, n), bool)
    grouped = group.astype(np.int64) * 257
    for c in range(columns - 1, -1, -1):
        symbol = symbols[c][order]
        key = grouped + symbol                      # groups keep their places in the order
        if (key[1:] >= key[:-1]).all():
            moved = None
            least = common[:n]
        else:
            moved = np.argsort(key, kind="stable")
            order, key, symbol = order[moved], key[moved], symbol[moved]
            least = common[moved]
            far = np.flatnonzero((moved[1:] - moved[:-1] > 1) & (key[1:] == key[:-1])) + 1
            if len(far):
                cuts = np.empty(2 * len(far), np.int64)
                cuts[0::2], cuts[1::2] = moved[far - 1] + 1, moved[far] + 1
                least[far] = np.minimum.reduceat(common, cuts)[0::2]
        same = np.zeros(n, bool)
        same[1:] = (key[1:] == key[:-1]) & (symbol[1:] > 0)
        common = np.zeros(n + 1, np.int32)
        common[:n][same] = least[same] + 1
        if c <= anchor:
            long = common >= length
            found[c][order[long[:n] | long[1:]]] = True
    return found


def _ranges(flags: np.ndarray) -> list[int]:
    """[from, to, from, to, ...] of the runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges.tolist()


def _judge_groups(length: int):
    """Sorted (key, content, many, before, string) rows -> (key, content, ranges)."""
    def judged(keys, contents, many, before, strings) -> pa.RecordBatch:
        keys = np.array(keys, np.int64)
        group = np.concatenate([[0], np.cumsum(keys[1:] != keys[:-1])])
        before = np.array(before, np.int64)
        flags = np.zeros((length - ANCHOR + 1, len(keys)), bool)
        # a string alone in its group repeats only itself
        shared = np.flatnonzero(np.bincount(group)[group] > 1)
        if len(shared):
            flags[:, shared] = repeated_windows(group[shared], [strings[i] for i in shared],
                                                before[shared], length)
        out = []
        for i, text in enumerate(strings):
            n, at = len(text) - length + 1, length - ANCHOR - before[i]
            out.append([0, n] if many[i] else _ranges(flags[at:at + n, i]))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(contents, pa.int64()), pa.array(out, pa.list_(pa.int32()))],
            ["key", "content", "ranges"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], []]
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in
                             ("key", "content", "many", "before", "string"))):
                if not held[0] or row[0] != held[0][-1] or row[1] != held[1][-1]:
                    for x, value in zip(held, row):
                        x.append(value)
            while len(held[0]) >= BATCH_STRINGS:
                n = BATCH_STRINGS           # up to the end of the group that crosses the edge
                while n < len(held[0]) and held[0][n] == held[0][n - 1]:
                    n += 1
                if n == len(held[0]):
                    break
                yield judged(*(x[:n] for x in held))
                held = [x[n:] for x in held]
        if held[0]:
            yield judged(*held)

    return judge


def _split_groups(strings: DataFrame, length: int) -> DataFrame:
    """(key, content, ranges) of the groups that are too large: windows by their hash."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            for key, content, many, text in zip(*(b.column(c).to_pylist() for c in
                                                  ("key", "content", "many", "string"))):
                n = len(text) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * n), pa.array([content] * n), pa.array(range(n), pa.int32()),
                     pa.array([many] * n), pa.array([xxhash.xxh3_128_digest(text[i:i + length])
                                                     for i in range(n)], pa.binary())],
                    ["key", "content", "at", "many", "window"])

    rows = strings.mapInArrow(_gathered(windows), "key long, content long, at int, many boolean, "
                                                  "window binary")
    again = (rows.groupBy("window").agg(F.count("*").alias("n"), F.max("many").alias("any"))
             .where("n > 1 or any").select("window"))
    return (rows.join(again, "window").groupBy("key", "content").agg(F.collect_list("at").alias("at"))
            .select("key", "content", F.flatten(F.transform(
                "at", lambda i: F.array(i, i + 1))).alias("ranges")))


def _strings(docs: DataFrame, distinct: DataFrame, length: int) -> DataFrame:
    """The ``distinct`` segments with their bytes, read from one of their texts.  Copies of a
    text follow each other after the join: the first gives them (in another plan some of
    them more than once, which the sorted reading skips)."""
    wanted = distinct.groupBy("row", "more").agg(F.collect_list(F.struct(
        "key", "content", "many", "first", "windows", "before")).alias("of"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for b in batches:
            for row, more, of, text in zip(b.column("row").to_pylist(), b.column("more").to_pylist(),
                                           b.column("of"), b.column("text").to_pylist()):
                if (row, more) == last:
                    continue
                last = row, more
                part = pa.RecordBatch.from_struct_array(of.values)
                spans = zip(part.column("first").to_pylist(), part.column("windows").to_pylist())
                strings = [text[i:i + n + length - 1] for i, n in spans]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("key", "content", "many", "before")),
                     pa.array(strings, pa.binary())],
                    ["key", "content", "many", "before", "string"])

    return docs.join(wanted, ["row", "more"]).select("row", "more", "text", "of").mapInArrow(
        _gathered(extract), "key long, content long, many boolean, before int, string binary")


def repeated_spans(docs: DataFrame, length: int = LENGTH, max_group: int = MAX_GROUP) -> DataFrame:
    """(row, more, spans) of ``docs(row, more, text)`` rows with repeats; spans is
    [from, to, ...] of covered bytes, neither ordered nor merged."""
    spark = docs.sparkSession
    every = cut(_segment_rows(docs, length), "segments")
    several = every.groupBy("key").count().where("count > 1").select(
        "key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    # a passage in a third of the texts is one key: its rows are dealt by text as well
    rows = every.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(
        several, ["key", "salt"])
    rows = cut(rows.groupBy("key", "content", "row", "place").agg(F.count("*").alias("copies")),
               "shared-segments")
    discard(every)
    release(spark)
    distinct = (rows.groupBy("key", "content")
                .agg(F.sum("copies").alias("n"), F.min(F.struct("row", "place")).alias("at")))
    group = distinct.groupBy("key").agg(F.count("*").alias("strings"))
    distinct = (distinct.join(group, "key")
                .select("key", "content", (F.col("n") > 1).alias("many"), "at.row",
                        *_unpacked("at.place"), (F.col("strings") > max_group).alias("large")))
    distinct = cut(distinct, "distinct-segments")
    release(spark)
    strings = _strings(docs, distinct.where("not large"), length)
    judged = cut(strings.repartition("key").sortWithinPartitions("key", "content")
                 .mapInArrow(_judge_groups(length), "key long, content long, ranges array<int>")
                 .where("size(ranges) > 0"), "repeats")
    release(spark)
    if distinct.where("large").limit(1).count():
        strings = _strings(docs, distinct.where("large"), length).dropDuplicates(["key", "content"])
        judged = judged.unionByName(cut(_split_groups(strings, length), "split-repeats"))
        release(spark)
    # from windows of a segment to bytes of a text
    spans = rows.join(judged, ["key", "content"]).select("row", *_unpacked(), "ranges")
    to_bytes = F.transform("ranges", lambda x, i: x + F.col("first")
                           + F.when(i % 2 == 1, F.lit(length - 1)).otherwise(F.lit(0)))
    return cut(spans.groupBy("row", "more").agg(
        F.flatten(F.collect_list(to_bytes)).alias("spans")), "spans")


def covered(spans: list[int], n: int) -> list[tuple[int, int]]:
    """The maximal covered runs of a text of ``n`` bytes."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted(zip(spans[::2], spans[1::2])):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return runs


def remove_repeats(docs: DataFrame, length: int = LENGTH, max_group: int = MAX_GROUP,
                   id_col: str = "doc_id", text_col: str = "text",
                   digest: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans and ``kept`` (the remaining
    bytes) or, with ``digest``, ``kept_sha256``."""
    # a text is known by 80 bits of two hashes: ids may be null or repeat
    docs = id_and_text(docs, id_col, text_col).withColumns({
        "row": F.xxhash64("text"), "more": F.hash("text").bitwiseAND(0xFFFF)})
    spans = repeated_spans(docs, length, max_group)
    last, kind = ("kept_sha256", "string") if digest else ("kept", "binary")

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, found in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
                text, parts, at, gone = text or b"", [], 0, 0
                runs = covered(found or [], len(text))
                for start, end in runs:
                    parts.append(text[at:start])
                    gone, at = gone + end - start, end
                kept = b"".join([*parts, text[at:]])
                out.append((len(text), gone, len(runs),
                            hashlib.sha256(kept).hexdigest() if digest else kept))
            cols = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]),
                 pa.array(cols[3], pa.string() if digest else pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", last])

    return (docs.join(spans, ["row", "more"], "left").select("doc_id", "text", "spans")
            .mapInArrow(removed, f"doc_id long, n_bytes long, n_removed long, n_spans long, "
                                 f"{last} {kind}"))
