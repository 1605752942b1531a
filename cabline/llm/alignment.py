"""Alignment of two tokenizers' tokens by diagonal run skipping.

A text with a space before it is encoded by a byte-level BPE file (A) and a sentencepiece
model (B).  Both token sequences cover the same bytes, so each is the array of its
tokens' end offsets, and the offsets in both arrays cut the tokens into groups.
``runs`` finds them along the diagonal ``j - i`` of the current shift: where both
arrays have the same end it compares stretches of 1, 2, 4 ... ends at this shift, each as a
whole, and halves the last, differing one; a one-to-one stretch of n tokens takes about
2 log n comparisons.  Where the ends differ, the side behind moves on until they meet:
that is one irregular group, and the shift is updated.

Tokens of the two sides that end together are *linked*.  ``align_tokenizers`` counts the
links of each id pair over the whole corpus and gives each document the sum of its
links' counts and how many of them are their B id's best.  Texts are encoded
once: pass 1 writes each document's distinct pairs, pass 2 looks their counts up.
The most frequent pairs, ``SENT_PAIRS`` at most, are sent to the tasks; the others, each
too rare to be a hot key, join by pair.  The best count per B id has at most as many
rows as B's vocabulary.

Texts of tabs, line ends, ASCII and Latin letters alone are encoded with the byte-level
file's own vocabulary and merges by tiktoken, which is four times as fast (checked when
loaded: ids follow the order of the merges); others by tokenizers, since their libraries' tables of
Unicode differ.  The same texts get B's ids by tiktoken too, with the model's pieces ranked by
their scores (checked when loaded: a BPE model that leaves texts as they are, whose pieces have
blanks only in front); others by sentencepiece.  Either way the tokens' bytes are compared with
the text's.

Cases: null and empty texts and those whose tokens don't give their bytes have no
tokens, zeros and no groups; a null doc_id and repeated rows are rows like any other;
other columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.llm._common import cut, id_and_text, per_process, release, shared
from cabline.llm.tokens import byte_signs

SENT_PAIRS = 1 << 18

#: of these signs alone, no tables of Unicode versions matter
_PLAIN = re.compile("[\t\n\x20-\x7e¡-¬®-ſ]*")
#: fixed value: the byte-level file's own pre-tokens
_PRE_TOKENS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
               r"|\s+(?!\S)|\s+")
_BLANK_SIGN = "▁"
#: the ends of these are reached across by no piece that has blanks only in front
_BLANK_AND_WORD, _BLANKS_AND_WORD = " [^ ]*", re.compile("(  +[^ ]*)")


class ByteLevel:
    """Ids of texts by a byte-level BPE file; ``pieces`` holds each id's bytes."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True     # their strings in texts are plain text
        byte_of = {sign: b for b, sign in byte_signs().items()}
        self.pieces = [b""] * self.tokenizer.get_vocab_size()
        for piece, i in self.tokenizer.get_vocab().items():
            self.pieces[i] = bytes(byte_of[c] for c in piece) if all(
                c in byte_of for c in piece) else piece.encode()
        self.bytes = _Bytes(self.pieces)
        self.fast = self._by_ranks(json.loads(self.tokenizer.to_str()))

    def _by_ranks(self, file: dict):
        """The same BPE by tiktoken, None where the file isn't ranked by its merges."""
        vocab, merges = file["model"]["vocab"], file["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        if file["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False,
                                     "trim_offsets": True, "use_regex": True} or \
                file["normalizer"] is not None or \
                any(vocab[x + y] != 256 + i for i, (x, y) in enumerate(pairs)):
            return None
        import tiktoken

        ranks = {self.pieces[i]: i for i in range(256 + len(pairs))}
        return tiktoken.Encoding("ranked", pat_str=_PRE_TOKENS, mergeable_ranks=ranks,
                                 special_tokens={})

    def slow(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None or _PLAIN.fullmatch(text) is None:
            return self.slow(text)
        return np.array(self.fast.encode_ordinary(text), np.int32)


class Pieces:
    """Ids of texts by a sentencepiece model; ``pieces`` holds each id's bytes."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        self.pieces = [bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i)
                       else self.model.id_to_piece(i).replace(_BLANK_SIGN, " ").encode()
                       for i in ids]
        self.bytes = _Bytes(self.pieces)
        self.fast, self.id_of_rank = self._by_scores() or (None, None)

    def _by_scores(self) -> tuple | None:
        """The same BPE by tiktoken and the ids of its ranks, None where the model is another kind."""
        try:
            from sentencepiece.sentencepiece_model_pb2 import ModelProto
        except ImportError:             # needs protobuf
            return None
        file, kind = ModelProto.FromString(self.model.serialized_model_proto()), ModelProto.SentencePiece
        trainer, normalizer = file.trainer_spec, file.normalizer_spec
        listed = {x.piece.replace(_BLANK_SIGN, " "): (-x.score, i)
                  for i, x in enumerate(file.pieces) if x.type == kind.NORMAL}
        plain = {x: at for x, at in listed.items() if _PLAIN.fullmatch(x)}
        merged = sorted((x for x in plain if len(x) > 1 and x[:2] != "  "), key=plain.__getitem__)
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback or \
                trainer.treat_whitespace_as_suffix or normalizer.precompiled_charsmap or \
                not normalizer.add_dummy_prefix or normalizer.remove_extra_whitespaces or \
                not normalizer.escape_whitespaces or \
                any(x.type in (kind.USER_DEFINED, kind.UNUSED) for x in file.pieces) or \
                any(" " in x.lstrip(" ") for x in listed) or \
                len({plain[x][0] for x in merged}) < len(merged) or \
                any(c not in plain for x in merged for c in x):
            return None
        import tiktoken

        # signs come first: they are the symbols that the model starts from, or else their bytes
        ids = {bytes([int(x.piece[3:5], 16)]): i
               for i, x in enumerate(file.pieces) if x.type == kind.BYTE}
        ids |= {x.encode(): i for x, (_, i) in plain.items() if len(x) == 1}
        # tiktoken takes a listed word as it is: none that the merges don't reach
        reached = self.model.encode([x[1:] for x in merged], num_threads=1)
        ids |= {x.encode(): plain[x][1] for x, found in zip(merged, reached)
                if x[0] != " " or found == [plain[x][1]]}
        fast = tiktoken.Encoding("scored", pat_str=_BLANK_AND_WORD, special_tokens={},
                                 mergeable_ranks={x: rank for rank, x in enumerate(ids)})
        return fast, np.array(list(ids.values()), np.int32)

    def slow(self, text: str) -> np.ndarray:
        # the model adds the blank that the text starts with
        return np.array(self.model.encode(text[1:], num_threads=1), np.int32)

    def ranked(self, text: str) -> np.ndarray:
        return self.id_of_rank[self.fast.encode_ordinary(text)]

    def encode(self, text: str) -> np.ndarray:
        wide = text.count("  ")
        if self.fast is None or 64 * wide > len(text) or _PLAIN.fullmatch(text) is None:
            return self.slow(text)
        if not wide:
            return self.ranked(text)
        # blanks in a row, all of one score, and the word behind them are the model's
        parts = enumerate(_BLANKS_AND_WORD.split(text))
        return np.concatenate([self.slow(x) if i % 2 else self.ranked(x) for i, x in parts if x])


class _Bytes:
    """The bytes of token sequences, by numpy look-up."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def ends(self, ids: np.ndarray, raw: np.ndarray) -> np.ndarray | None:
        """The tokens' end offsets; None where their bytes aren't ``raw``."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ends) or ends[-1] != len(raw):
            return None
        at = np.arange(len(raw)) + np.repeat(self.starts[ids] - ends + sizes, sizes)
        return ends if np.array_equal(self.flat[at], raw) else None


def encode_both(a: ByteLevel, b: Pieces, text: str) -> list[tuple] | None:
    """(ids, end offsets) of the two sides, None for a text without tokens."""
    if not text:
        return None
    text = " " + text
    raw, found = np.frombuffer(text.encode(), np.uint8), []
    for side in (a, b):
        ids = side.encode(text)
        ends = side.bytes.ends(ids, raw)
        if ends is None:
            return None
        found.append((ids, ends))
    return found


def runs(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """(start, end, shift) of the stretches of tokens ``start .. end - 1`` of ``a`` that end where
    those of ``b`` at ``+ shift`` end; ``a`` and ``b`` are increasing ends with the same last one."""
    i = j = 0
    n, m = len(a), len(b)
    found = []
    while i < n:
        x, y = a[i], b[j]
        while x != y:           # one irregular group, resolved where it is
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        # on the diagonal: how far does the shift hold?
        start, shift, size, most = i, j - i, 1, min(n, m - j + i)
        i += 1
        while i + size <= most and a[i:i + size] == b[i + shift:i + shift + size]:
            i += size
            size *= 2
        while size > 1:
            size //= 2
            if i + size <= most and a[i:i + size] == b[i + shift:i + shift + size]:
                i += size
        j = i + shift
        found.append((start, i, shift))
    return found


def group_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of each side lie before the end of each group."""
    found = np.array(runs(a.tolist(), b.tolist()), np.int64).reshape(-1, 3)
    size = found[:, 1] - found[:, 0]
    before = np.cumsum(size) - size
    ends_a = np.arange(size.sum()) + np.repeat(found[:, 0] + 1 - before, size)
    return ends_a, ends_a + np.repeat(found[:, 2], size)


class Rendering:
    """Groups as ``a1,a2|b1;a3|b2,b3``: each token's text with the sign after it is looked up."""

    def __init__(self, tokens: int) -> None:
        self.tokens = tokens
        self.texts = [f"{i}{sign}" for sign in ",|;" for i in range(tokens)]

    def __call__(self, ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray,
                 ends_b: np.ndarray) -> str:
        after_a, after_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        after_a[ends_a - 1], after_b[ends_b - 1] = 1, 2         # | and ;
        # a token stands behind the other side's tokens of the groups before (B: up to) its own
        group_a, group_b = np.cumsum(after_a) - after_a, np.cumsum(after_b > 0) - (after_b > 0)
        place_a = np.arange(len(ids_a)) + np.concatenate([[0], ends_b])[group_a]
        place_b = np.arange(len(ids_b)) + ends_a[group_b]
        found = np.empty(len(ids_a) + len(ids_b), np.int64)
        found[place_a] = ids_a + after_a * self.tokens
        found[place_b] = ids_b + after_b * self.tokens
        return "".join(map(self.texts.__getitem__, found.tolist()))[:-1]


def _aligned(docs: DataFrame, path_a: str, path_b: str, digest: bool) -> DataFrame:
    """Pass 1: doc_id, n_a, n_b, n_groups, groups[_sha256], pairs and times (distinct id
    pairs ``a * B's size + b`` of the document's links)."""
    name = "groups_sha256" if digest else "groups"

    def sides() -> tuple:
        a, b = ByteLevel(path_a), Pieces(path_b)
        return a, b, Rendering(max(len(a.pieces), len(b.pieces)))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, render = per_process(f"alignment:{path_a}:{path_b}", sides)
        size_b = len(b.pieces)
        none = np.zeros(0, np.int64)

        def one(text: bytes | None) -> tuple:
            both = encode_both(a, b, (text or b"").decode("utf-8", "replace"))
            if both is None:
                return 0, 0, 0, "", none, none
            (ids_a, ends_a), (ids_b, ends_b) = both
            ends_a, ends_b = group_ends(ends_a, ends_b)
            linked = ids_a[ends_a - 1].astype(np.int64) * size_b + ids_b[ends_b - 1]
            pairs, times = np.unique(linked, return_counts=True)
            groups = render(ids_a, ids_b, ends_a, ends_b)
            if digest:
                groups = hashlib.sha256(groups.encode()).hexdigest()
            return len(ids_a), len(ids_b), len(ends_a), groups, pairs, times

        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                texts = part.column("text").to_pylist()
                distinct = {x: one(x) for x in dict.fromkeys(texts)}
                rows = [distinct[x] for x in texts]
                offsets = pa.array(np.cumsum([0, *(len(r[4]) for r in rows)]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, np.concatenate([r[c] for r in rows])
                                                  .astype(kind)) for c, kind in
                         ((4, np.int64), (5, np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"),
                     *(pa.array([r[c] for r in rows], pa.int64()) for c in range(3)),
                     pa.array([r[3] for r in rows], pa.string()), *lists],
                    ["doc_id", "n_a", "n_b", "n_groups", name, "pairs", "times"])

    return docs.mapInArrow(align, f"doc_id long, n_a long, n_b long, n_groups long, {name} string, "
                                  "pairs array<bigint>, times array<int>")


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): the corpus-wide links of each pair, and whether no pair of
    its B id has more."""
    counts = (aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
              .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n")))
    counts = cut(counts, "pair-counts").withColumn("b", F.pmod("pair", F.lit(size_b)))
    top = counts.groupBy("b").agg(F.max("n").alias("top"))      # at most B's vocabulary
    return cut(counts.join(F.broadcast(top), "b").select("pair", "n", (F.col("n") == F.col("top"))
                                                         .alias("best")), "pair-bests")


def _frequent(counts: DataFrame, most: int) -> tuple[int, DataFrame]:
    """(level, rows): the pairs from the smallest level on that at most ``most`` pairs reach; a
    level is a sixteenth of an octave of counts."""
    levelled = counts.withColumn("level", F.floor(16 * F.log2("n")).cast("int"))
    least, enough = 1024, 0
    for r in sorted(levelled.groupBy("level").count().collect(), reverse=True):  # 1024 at most
        enough += r["count"]
        if enough > most:
            break
        least = r["level"]
    return least, levelled


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, digest: bool = False,
                     sent_pairs: int = SENT_PAIRS, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum (long) and its
    groups: ``groups``, or with ``digest`` ``groups_sha256`` ('' without tokens)."""
    import sentencepiece

    spark = docs.sparkSession
    name = "groups_sha256" if digest else "groups"
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    found = _aligned(id_and_text(docs, id_col, text_col), path_a, path_b, digest)
    found = cut(found.withColumn("row", F.monotonically_increasing_id()), "aligned",
                compression="zstd")
    counts = pair_counts(found, size_b)
    release(spark)
    least, levelled = _frequent(counts, sent_pairs)
    top = levelled.where(F.col("level") >= least).select("pair", "n", "best").toPandas()
    top = top.sort_values("pair")
    sent = shared(spark, (top["pair"].to_numpy(np.int64), top["n"].to_numpy(np.int64),
                          top["best"].to_numpy(bool)))          # sent_pairs rows at most

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = sent()
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                lists = part.column("pairs")
                at, times = lists.flatten().to_numpy(), part.column("times").flatten().to_numpy()
                row = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                place = np.minimum(np.searchsorted(pairs, at), max(0, len(pairs) - 1))
                known = pairs[place] == at if len(pairs) else np.zeros(len(at), bool)
                n_best, total = (np.zeros(part.num_rows, np.int64) for _ in range(2))
                place, t, r = place[known], times[known].astype(np.int64), row[known]
                np.add.at(total, r, t * n[place])
                np.add.at(n_best, r, t * best[place])
                rest = np.bincount(row[~known], minlength=part.num_rows)
                offsets = pa.array(np.concatenate([[0], np.cumsum(rest)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", name)),
                     pa.array(n_best), pa.array(total),
                     pa.ListArray.from_arrays(offsets, at[~known]),
                     pa.ListArray.from_arrays(offsets, times[~known])],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", name, "n_best", "count_sum",
                     "pairs", "times"])

    known = found.select("row", "doc_id", "n_a", "n_b", "n_groups", name, "pairs", "times").mapInArrow(
        look_up, f"row long, doc_id long, n_a long, n_b long, n_groups long, {name} string, "
                 "n_best long, count_sum long, pairs array<bigint>, times array<int>")
    rare = levelled.where(F.col("level") < least).select("pair", "n", "best")
    met = known.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
        "row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    added = (met.join(rare, "pair").groupBy("row")
             .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                  F.sum(F.col("times") * F.col("n")).alias("more")))
    return known.join(added, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), name)
