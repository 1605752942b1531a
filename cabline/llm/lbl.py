"""Language-model scoring with a log-bilinear model trained by noise contrast.

Tokens: A-Z lower-cased words ``[^\\x20\\x09-\\x0D]+`` of a text, then one end.
The model predicts an *output*: one of the most frequent words, the end, or one
of ``rare_classes`` classes of the other words (by a hash of the last two bytes,
which tells languages and styles apart).  The context's vectors, weighted per
position, give a predicted vector; its products with all outputs' vectors plus
biases are the scores, normalised over all outputs.  A score is a sum over the
context's positions, so its exponential is a product of one factor a position:
each position's are computed once, for all contexts and outputs.  Of contexts in order the
nearer halves' products are computed once a half and looked up; the sums of the most frequent
halves with each other are one matrix product.  Where products run out of range, or the tables
would be too large, the scores are computed as one matrix product a block.  Words are split,
counted and looked up by Arrow, many texts at a time.  A rare word's share of its class is
(c + 1) / (sum of c + 1 over the class + 1), c its training count, the last 1
for unseen words; so the probabilities of all known words and one unseen word
per class sum to 1.

Training counts are taken over all training documents (combined per task, then
by word).  The vectors are trained in numpy by noise-contrastive estimation:
each round every task runs AdaGrad over its own documents, from the model so
far, on every position of each text, and the models are averaged by their number
of examples; what is learnt from grows with the input, the model doesn't.  The ``known_words`` most
frequent words' counts are sent to the tasks, the others join by a 64-bit hash.

Cases: a null or empty text is its end alone; a null doc_id counts as the empty
string in the split; repeated rows are trained on and scored as often as they
stand; without training documents N = V = 0 and the model is uniform; an empty
table gives no rows.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabline.llm._common import cut, id_and_text, per_process, release, shared

FOLDS, HELD_OUT_FOLD = 7, 2
#: 65,535 outputs at most: they are kept in 16 bits
HOT_WORDS, RARE_CLASSES, DIMENSIONS, CONTEXT = 447, 64, 16, 4
KNOWN_WORDS = 150_000
ROUNDS, BATCH, NOISE, RATE = 2, 4096, 64, 0.1
MAX_COUNTER = 250_000
_BLOCK = 256            # tokens normalised at once
_TOKENS = 1 << 20       # sorted and scored at once
_BYTES = 4 << 20        # of texts split at once
_HALVES = 2048          # most frequent halves of contexts whose sums are one matrix product
_CELLS = 1 << 22        # of the factors' tables, 32 MB with their logs
_LEAST = 1e-20          # a sum of products as large has lost nothing to underflow


def fold(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def word_hash(word: bytes) -> int:
    import xxhash

    value = xxhash.xxh3_64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


def rare_class(word: bytes, classes: int) -> int:
    return zlib.crc32(word[-2:]) % classes


class _RareOutputs(dict):
    """a word's last two bytes -> output of its rare class."""

    def __init__(self, first: int, classes: int) -> None:
        super().__init__()
        self.first, self.classes = first, classes

    def __missing__(self, ending: bytes) -> int:
        value = self[ending] = self.first + rare_class(ending, self.classes)
        return value

    def of(self, words: list[bytes]) -> list[int]:
        return [self[w[-2:]] for w in words]


def pieces(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(first, end) of rows in order whose sizes sum to ``most`` at most; one row at least."""
    sums, first = np.concatenate([[0], np.cumsum(sizes)]), 0
    while first < len(sizes):
        end = max(first + 1, int(np.searchsorted(sums, sums[first] + most, "right")) - 1)
        yield first, end
        first = end


def text_pieces(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch's rows with at most _BYTES of text at a time."""
    sizes = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False)
    for first, end in pieces(sizes.astype(np.int64), _BYTES):
        yield b.slice(first, end - first)


def split_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(:func:`words_of` all texts one after the other, how many each text has)."""
    raw = texts.cast(pa.binary())
    # these functions look at single bytes: they don't need valid UTF-8
    raw = pa.Array.from_buffers(pa.string(), len(raw), raw.buffers(), offset=raw.offset)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(raw))
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    words = lists.flatten()
    words = pa.Array.from_buffers(pa.binary(), len(words), words.buffers(), offset=words.offset)
    some = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    if not some.all():                          # white space at a text's start or end
        text = np.repeat(np.arange(len(n)), n)
        n, words = np.bincount(text[some], minlength=len(n)), words.filter(pa.array(some))
    return words, n.astype(np.int64)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over the training documents; the end is the empty word."""
    names = ["word", "n"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, ends = [], 0

        def summed() -> pa.RecordBatch:
            sums = pa.Table.from_batches(found).group_by("word", use_threads=False).aggregate(
                [("n", "sum")]).combine_chunks()
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays(sums.column(x).chunks) for x in ("word", "n_sum")], names)

        for b in batches:
            train = [fold(x) != HELD_OUT_FOLD for x in b.column("doc_id").to_pylist()]
            ends += sum(train)
            for piece in text_pieces(b.filter(pa.array(train, pa.bool_()))):
                n = split_texts(piece.column("text"))[0].value_counts()
                if len(n):
                    found.append(pa.RecordBatch.from_arrays(n.flatten(), names))
                if sum(map(len, found)) >= 2 * MAX_COUNTER:
                    found = [summed()]
                    if len(found[0]) >= MAX_COUNTER:
                        yield from found
                        found = []
        if found:
            yield summed()
        yield pa.RecordBatch.from_arrays(
            [pa.array([b""] * (ends > 0), pa.binary()),
             pa.array([ends] * (ends > 0), pa.int64())], names)

    return (docs.mapInArrow(count, "word binary, n long").groupBy("word")
            .agg(F.sum("n").alias("n")))


class Vocabulary:
    """Outputs: hot words, the end, rare classes; one more context for "before the text"."""

    def __init__(self, hot: list[bytes], counts: np.ndarray, rare_classes: int) -> None:
        self.index = {w: i for i, w in enumerate(hot)}
        self.rare_classes = rare_classes
        self.end = len(hot)
        self.first_rare = len(hot) + 1
        self.outputs = self.first_rare + rare_classes
        self.start = self.outputs
        self.share = (counts + 0.5) / (counts + 0.5).sum()      # of outputs, the noise

    def rare(self) -> _RareOutputs:
        return per_process(f"lbl_rare:{self.first_rare}:{self.rare_classes}",
                           lambda: _RareOutputs(self.first_rare, self.rare_classes))

    def outputs_of(self, words: list[bytes]) -> np.ndarray:
        """The outputs of a text's tokens."""
        out = np.empty(len(words) + 1, np.int64)
        out[-1] = self.end
        out[:-1] = np.fromiter(map(self.index.get, words, itertools.repeat(-1)), np.int64,
                               len(words))
        others, rare = np.flatnonzero(out == -1), self.rare()
        out[others] = rare.of([words[i] for i in others.tolist()])
        return out

    def laid_out(self, texts: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        """(line, places): the texts' outputs one after the other, ``n`` starts before each, and
        where in the line the tokens are."""
        lengths = np.array([len(x) for x in texts], np.int64)
        places = np.arange(lengths.sum()) + np.repeat(n * np.arange(1, len(texts) + 1), lengths)
        line = np.full(lengths.sum() + n * len(texts), self.start, np.int64)
        if len(places):
            line[places] = np.concatenate(texts)
        return line, places


def contexts(line: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """(len(at), n) outputs before each place of the line, the nearest first."""
    return line[at[:, None] - 1 - np.arange(n)[None, :]]


class Model:
    """Context vectors ``r``, position weights ``c``, output vectors ``t``, biases ``b``."""

    NAMES = ("r", "c", "t", "b")

    def __init__(self, vocabulary: Vocabulary, dimensions: int, context: int) -> None:
        rng = np.random.default_rng(7)
        self.r = rng.normal(0, 0.3, (vocabulary.outputs + 1, dimensions)).astype(np.float32)
        self.c = np.full((context, dimensions), 1 / context, np.float32)
        self.t = np.zeros((vocabulary.outputs, dimensions), np.float32)
        self.b = np.log(vocabulary.share).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, x).ravel() for x in self.NAMES])

    def set_flat(self, values: np.ndarray) -> None:
        at = 0
        for x in self.NAMES:
            old = getattr(self, x)
            setattr(self, x, values[at:at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size

    def predicted(self, contexts: np.ndarray, weighted: np.ndarray | None = None) -> np.ndarray:
        """The weighted sum of the contexts' vectors; ``weighted``: all of them per position."""
        weighted = self.weighted() if weighted is None else weighted
        places = np.ascontiguousarray(contexts.T)
        found = weighted[0].take(places[0], 0)
        for table, at in zip(weighted[1:], places[1:]):
            found += table.take(at, 0)
        return found

    def weighted(self) -> np.ndarray:
        return self.r[None, :, :] * self.c[:, None, :]

    def log_probabilities(self, line: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Natural logs of the tokens at ``places``, normalised over all outputs."""
        half = len(self.r) ** ((len(self.c) + 1) // 2)          # halves that a context can have
        if len(self.c) * len(self.t) ** 2 > _CELLS or half > _CELLS:
            return self._by_scores(line, places)
        return self._by_factors(line, places)

    def _by_factors(self, line: np.ndarray, places: np.ndarray) -> np.ndarray:
        """As a score is a sum over the positions, its exponential is a product of one factor a
        position: looked up, so that no token needs exponentials of its own.  ``places`` rise."""
        shares = np.matmul(self.weighted(), self.t.T)       # (position, context, output)
        shares[0] += self.b
        shares -= shares.max(2, keepdims=True)              # factors up to 1; cancels below
        factors = np.exp(shares)
        found = np.empty(len(places))
        lost, n, middle = [], len(self.c), (len(self.c) + 1) // 2
        for i in range(0, len(places), _TOKENS):
            at = places[i:i + _TOKENS]
            first = at[0] - n
            part, at = line[first:at[-1] + 1], at - first
            # of all places behind the n first, texts' starts too
            of = np.zeros(len(part) - n)
            near, far = (np.zeros(len(of), np.int64) for _ in range(2))
            for k, share in enumerate(shares):
                before = part[n - 1 - k:len(part) - 1 - k]
                of += share.ravel().take(before * len(self.t) + part[n:], mode="clip")
                half = near if k < middle else far
                half *= len(self.r)
                half += before
            of, near, far = (x.take(at - n) for x in (of, near, far))
            total = _sums(factors, near, far)
            small = np.flatnonzero(total < _LEAST)
            if len(small):                                  # the factors' products ran out of range
                lost.append(i + small)
                total[small] = 1
            found[i:i + len(at)] = of - np.log(total, dtype=np.float64)
        if lost:
            lost = np.concatenate(lost)
            found[lost] = self._by_scores(line, places[lost])
        return found

    def _by_scores(self, line: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The same by all outputs' scores, for any number of outputs and any weights; in blocks
        that stay in the processor's cache, whatever texts they belong to."""
        outputs = np.concatenate([self.t, self.b[:, None]], 1)      # the bias as one more factor
        weighted = self.weighted()
        ones, longest = np.ones(len(outputs), np.float32), np.sqrt((outputs ** 2).sum(1).max())
        found = np.empty(len(places))
        # one buffer for all blocks, so that its pages are touched once
        room = np.empty((min(_BLOCK, len(places)), len(outputs)), np.float32)
        for i in range(0, len(places), _BLOCK):
            at = places[i:i + _BLOCK]
            q = np.ones((len(at), outputs.shape[1]), np.float32)
            q[:, :-1] = self.predicted(contexts(line, at, len(self.c)), weighted)
            scores = np.matmul(q, outputs.T, out=room[:len(at)])
            of = (q * outputs.take(line[at], 0)).sum(1, dtype=np.float64)
            if longest * np.sqrt((q ** 2).sum(1).max()) > 60:       # keep exp in range
                top = scores.max(1, keepdims=True)
                scores -= top
                of -= top[:, 0]
            np.exp(scores, out=scores)
            found[i:i + len(at)] = of - np.log(scores @ ones, dtype=np.float64)
        return found


def _products(factors: np.ndarray, halves: np.ndarray) -> np.ndarray:
    """(halves, outputs): the products of the factors of the contexts that each half holds."""
    found = np.ones((len(halves), factors.shape[2]), np.float32)
    for factor in factors[::-1]:
        halves, c = np.divmod(halves, factors.shape[1])
        found *= factor.take(c, 0)
    return found


class _Halves:
    """The nearer or farther halves of some tokens' contexts, each as one number."""

    def __init__(self, factors: np.ndarray, halves: np.ndarray, most: int) -> None:
        self.factors, self.halves = factors, halves
        times = np.bincount(halves)
        top = np.flatnonzero(times)
        top = top[np.argsort(-times[top], kind="stable")[:most]]
        self.products = _products(factors, top)         # of the most frequent, falling
        place = np.full(len(times), -1, np.int32)
        place[top] = np.arange(len(top))
        self.place = place.take(halves)                 # of each among these, or -1


def _sums_of(near: _Halves, far: _Halves, tokens: np.ndarray, found: np.ndarray) -> None:
    """The ``tokens``' sums: in the order of one half, so that a block has few of them, and with
    the frequent ones' products of the other."""
    tokens = tokens[np.argsort(near.halves[tokens])]
    half, place = near.halves[tokens], far.place[tokens]
    new = np.concatenate([[True], half[1:] != half[:-1]])[:len(half)]
    half, of = half[new], np.cumsum(new) - 1
    sums = np.empty(len(tokens), np.float32)
    rooms = np.empty((2, min(_BLOCK, len(tokens)), near.products.shape[1]), np.float32)
    first = end = 0
    for i in range(0, len(tokens), _BLOCK):
        j = min(i + _BLOCK, len(tokens))
        one, other = rooms[:, :j - i]
        if of[j - 1] >= end:
            first, end = of[i], of[i] + _BLOCK
            products = _products(near.factors, half[first:end])
        # every place is a row of the table: "clip" only spares a copy (-1 is done below)
        products.take(of[i:j] - first, 0, out=one, mode="clip")
        far.products.take(place[i:j], 0, out=other, mode="clip")
        seldom = np.flatnonzero(place[i:j] < 0)
        if len(seldom):
            other[seldom] = _products(far.factors, far.halves[tokens[i + seldom]])
        np.vecdot(one, other, out=sums[i:j])
    found[tokens] = sums


def _sums(factors: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Of each token the sum over all outputs of its contexts' factors' product; ``near``, ``far``:
    the halves of its context."""
    middle = (len(factors) + 1) // 2
    most = min(_HALVES, 2 * math.isqrt(len(near)))
    one, other = (_Halves(f, x, 4 * most) for f, x in ((factors[:middle], near),
                                                       (factors[middle:], far)))
    found = np.empty(len(near), np.float32)
    # halves that are frequent on both sides: all their sums with each other
    table = one.products[:most] @ other.products[:most].T
    both = ((one.place.view(np.uint32) < len(table)) &          # -1 is a large number
            (other.place.view(np.uint32) < table.shape[1]))
    found[both] = table[one.place[both], other.place[both]]
    rest = np.flatnonzero(~both)
    frequent = other.place[rest] >= 0
    _sums_of(one, other, rest[frequent], found)
    _sums_of(other, one, rest[~frequent], found)
    return found


def text_scores(model: Model, words: Vocabulary, texts: list[np.ndarray]) -> np.ndarray:
    """log10 of the probability of each text's outputs; each has its end at least."""
    logs = model.log_probabilities(*words.laid_out(texts, len(model.c))) / np.log(10)
    first = np.cumsum([0, *(len(x) for x in texts)])[:-1]
    return np.add.reduceat(logs, first) if len(texts) else logs


class Trainer:
    """AdaGrad on the noise-contrastive objective; noise is shared by a batch."""

    def __init__(self, model: Model, vocabulary: Vocabulary, seed: int) -> None:
        self.m, self.rng = model, np.random.default_rng(seed)
        self.cumulative = np.cumsum(vocabulary.share)
        self.log_noise = np.log(NOISE * vocabulary.share).astype(np.float32)
        self.squares = {x: np.full_like(getattr(model, x), 1e-2) for x in Model.NAMES}
        # of each row of a table its cells
        self.cells = np.arange(model.r.size).reshape(model.r.shape)
        self.examples = 0

    def _step(self, name: str, gradient: np.ndarray) -> None:
        value, squares = getattr(self.m, name), self.squares[name]
        gradient = gradient.astype(np.float32)
        squares += gradient * gradient
        value += RATE * gradient / np.sqrt(squares)

    def _summed(self, rows: np.ndarray, gradient: np.ndarray, n: int) -> np.ndarray:
        """(n, ...) sums of the gradient's rows by row number; as few rows as outputs."""
        width = gradient.shape[1]
        cells = self.cells.take(rows, 0)
        return np.bincount(cells.ravel(), gradient.ravel(), n * width).reshape(n, width)

    def train(self, contexts: np.ndarray, targets: np.ndarray) -> None:
        m, n = self.m, len(targets)
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)),
                           len(self.cumulative) - 1)
        contexts = np.ascontiguousarray(contexts.T)
        of_noise = m.t[noise]
        q, t = m.predicted(contexts.T), m.t.take(targets, 0)
        bias = m.b - self.log_noise
        data = np.vecdot(q, t) + bias.take(targets)
        up = 1 / (1 + np.exp(np.clip(data, -30, 30)))               # 1 - sigmoid
        # by noise word, so that each row has one bias; in place from here on
        down = -of_noise @ q.T
        down -= bias[noise][:, None]
        np.exp(np.clip(down, -30, 30, out=down), out=down)
        down += 1
        scale = np.float32(1 / np.sqrt(n))
        np.divide(-scale, down, out=down)                           # - sigmoid
        up = (up * scale).astype(np.float32)[:, None]
        d_q = down.T @ of_noise
        d_q += up * t
        # per position the predicted vectors' gradients by context: of them both factors follow
        d_q = d_q.astype(np.float64)
        by_context = [self._summed(at, d_q, len(m.r)) for at in contexts]
        r = m.r.astype(np.float64)
        d_c = np.stack([np.einsum("ij,ij->j", r, g) for g in by_context])
        d_r = sum(g * c for g, c in zip(by_context, m.c.astype(np.float64)))
        d_t = self._summed(targets, up * q, len(m.t))
        np.add.at(d_t, noise, down @ q)
        d_b = np.bincount(targets, up[:, 0], len(m.b))
        np.add.at(d_b, noise, down.sum(1))
        self._step("t", d_t)
        self._step("b", d_b)
        self._step("r", d_r)
        self._step("c", d_c)
        self.examples += n


def _binaries(values: np.ndarray, stops: np.ndarray) -> pa.Array:
    """The bytes of the values up to each stop, in order."""
    offsets = np.concatenate([[0], stops * values.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(stops),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _read(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2") for x in column.to_pylist()]


def examples(batches: Iterator[pa.RecordBatch], words: Vocabulary,
             context: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(contexts, targets) of every position of the texts' outputs, BATCH at a time."""
    held = (np.zeros((0, context), np.int64), np.zeros(0, np.int64))
    for b in batches:
        line, places = words.laid_out(_read(b.column("outputs")), context)
        for i in range(0, len(places), 1 << 18):
            at = places[i:i + (1 << 18)]
            c, t = (np.concatenate(x) for x in zip(held, (contexts(line, at, context), line[at])))
            whole = len(t) // BATCH * BATCH
            for j in range(0, whole, BATCH):
                yield c[j:j + BATCH], t[j:j + BATCH]
            held = c[whole:], t[whole:]
    if len(held[1]):
        yield held


def _trained(texts: DataFrame, vocabulary: Vocabulary, model: Model, context: int,
             round_: int) -> Model:
    """The average of the models that the tasks reach from ``model`` in one pass over the
    ``texts(outputs)``."""
    spark = texts.sparkSession
    sent = shared(spark, (vocabulary, model))       # of fixed size

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, start = sent()
        own = Model(words, start.r.shape[1], context)
        own.set_flat(start.flat())
        task = TaskContext.get().partitionId()
        trainer = Trainer(own, words, 1000 * round_ + task)
        for before, targets in examples(batches, words, context):
            trainer.train(before, targets)
        if trainer.examples:
            values = own.flat().astype(np.float64) * trainer.examples
            yield pa.RecordBatch.from_arrays(
                [pa.array([task], pa.int64()), pa.array([trainer.examples], pa.int64()),
                 pa.array([values.tobytes()], pa.binary())], ["task", "examples", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples, sums = 0, None
        for b in batches:
            for n, raw in zip(b.column("examples").to_pylist(), b.column("sums").to_pylist()):
                part = np.frombuffer(raw, np.float64)
                examples, sums = examples + n, part if sums is None else sums + part
        if sums is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([0], pa.int64()), pa.array([examples], pa.int64()),
                 pa.array([sums.tobytes()], pa.binary())], ["task", "examples", "sums"])

    schema = "task long, examples long, sums binary"
    added = texts.mapInArrow(train, schema).repartition(16, "task").mapInArrow(add, schema)
    rows = added.collect()                      # 16 sums at most
    if rows:
        sums = sum(np.frombuffer(r["sums"], np.float64) for r in rows)
        model.set_flat(sums / sum(r["examples"] for r in rows))
    return model


_SCORED = ["doc_id", "place", "held_out", "n_tokens", "n_known", "base_score"]


def _encoded(docs: DataFrame, vocabulary: Vocabulary, known: dict[bytes, int], ends: int,
             log_all: float, log_class: np.ndarray) -> DataFrame:
    """A table of the documents as the rounds and the scoring read them: their outputs (16 bits
    each), and of both scores what the sent counts give (``score``: the rare words' shares of
    their classes); ``rare`` and ``times``: hashes of the words that weren't sent."""
    sent = shared(docs.sparkSession, (vocabulary, known))       # known_words words

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known = sent()
        place = TaskContext.get().partitionId() << 40
        # per output: 0, or what a rare word's class subtracts
        minus = np.concatenate([np.zeros(words.first_rare), log_class])
        # one look-up a token: the place among the sent words gives output and count
        index = pc.SetLookupOptions(pa.array(list(known), pa.binary()))
        output_of = words.outputs_of(list(known))       # the end comes last, at place -1
        logs_of = np.log10(np.array([*known.values(), ends], np.float64) + 1)
        rare_outputs = words.rare()
        for b in itertools.chain.from_iterable(map(text_pieces, batches)):
            tokens, n = split_texts(b.column("text"))
            met = pc.index_in(tokens, options=index)
            others = tokens.filter(met.is_null()).to_pylist()
            met = met.fill_null(-1).to_numpy()
            # each text's end behind its words
            stops = np.cumsum(n + 1)
            text = np.repeat(np.arange(len(n)), n + 1)
            at = np.full(len(text), -1, np.int64)
            is_word = np.ones(len(text), bool)
            is_word[stops - 1] = False
            at[is_word] = met
            outputs, logs = output_of[at], logs_of[at]
            unknown = np.flatnonzero(is_word)[met < 0]
            outputs[unknown] = rare_outputs.of(others)
            logs[unknown] = 0
            rare = np.flatnonzero(outputs >= words.first_rare)
            shares = np.bincount(text[rare], logs[rare] - minus[outputs[rare]], len(n))
            # of the words that weren't sent: each text's hashes, and how often it has them
            hashes = np.fromiter(map(word_hash, others), np.int64, len(others))
            of = text[unknown]
            order = np.lexsort((hashes, of))
            hashes, of = hashes[order], of[order]
            first = np.ones(len(of), bool)
            first[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
            rest = np.searchsorted(of[first], np.arange(len(n) + 1))
            times = np.diff(np.append(np.flatnonzero(first), len(of)))
            known_tokens = n - np.bincount(of, minlength=len(n)) + (ends > 0)
            held = [fold(x) == HELD_OUT_FOLD for x in b.column("doc_id").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(place + np.arange(len(n))), pa.array(held, pa.bool_()),
                 pa.array(n + 1), pa.array(known_tokens),
                 pa.array(np.bincount(text, logs, len(n)) - log_all * (n + 1)), pa.array(shares),
                 _binaries(outputs.astype("<u2"), stops),
                 *(pa.ListArray.from_arrays(pa.array(rest, pa.int32()), pa.array(x, pa.int64()))
                   for x in (hashes[first], times))],
                [*_SCORED, "score", "outputs", "rare", "times"])
            place += len(n)

    return cut(docs.mapInArrow(
        encode, "doc_id long, place long, held_out boolean, n_tokens long, n_known long, "
                "base_score double, score double, outputs binary, rare array<bigint>, "
                "times array<bigint>"), "encoded-texts")


def score_texts(docs: DataFrame, hot_words: int = HOT_WORDS, rare_classes: int = RARE_CLASSES,
                dimensions: int = DIMENSIONS, context: int = CONTEXT, rounds: int = ROUNDS,
                known_words: int = KNOWN_WORDS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    if hot_words + 1 + rare_classes > 1 << 16:
        raise ValueError("more outputs than 16 bits tell apart")
    spark = docs.sparkSession
    docs = id_and_text(docs, id_col, text_col)
    counts = cut(word_counts(docs), "word-counts")
    release(spark)
    n_all, v_all = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # the smallest count that at most known_words words reach, to a sixteenth of an octave
    level = F.floor(16 * F.log2("n")).cast("int")
    words = counts.where("length(word) > 0").withColumn("level", level)
    levels = sorted(words.groupBy("level").count().collect(), reverse=True)     # 1024 at most
    enough, least = 0, 1024
    for r in levels:
        enough += r["count"]
        if enough > known_words:
            break
        least = r["level"]
    top = sorted(words.where(F.col("level") >= least).select("word", "n").collect(),
                 key=lambda r: (-r["n"], r["word"]))
    known = {r["word"]: r["n"] for r in top}
    hot = [r["word"] for r in top[:hot_words]]
    ends = counts.where("length(word) = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    hot_set = spark.sparkContext.broadcast(set(hot))

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column("word").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([word_hash(w) for w in words], pa.int64()),
                 pa.array([-1 if w in hot_set.value or not w else rare_class(w, rare_classes)
                           for w in words], pa.int32()), b.column("n")], ["hash", "class", "n"])

    hashed = counts.mapInArrow(classed, "hash long, class int, n long")
    totals = np.zeros((2, rare_classes))
    for r in (hashed.where("class >= 0").groupBy("class")
              .agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()):
        totals[:, r["class"]] = r["n"], r["n"] + r["words"]
    vocabulary = Vocabulary(hot, np.concatenate([[known[w] for w in hot], [ends], totals[0]]),
                            rare_classes)
    log_all = float(np.log10(n_all + v_all + 1))
    log_class = np.log10(totals[1] + 1)
    encoded = _encoded(docs, vocabulary, known, int(ends), log_all, log_class)
    model = Model(vocabulary, dimensions, context)
    for k in range(rounds):
        model = _trained(encoded.where("not held_out").select("outputs"), vocabulary, model,
                         context, k)
    sent = shared(spark, (vocabulary, model))           # of fixed size

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, m = sent()
        for b in (b.slice(i, j - i) for b in batches
                  for i, j in pieces(b.column("n_tokens").to_numpy(), _TOKENS)):
            score = text_scores(m, words, _read(b.column("outputs")))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in _SCORED), pa.array(b.column("score").to_numpy() + score)],
                [*_SCORED, "score"])

    scored = encoded.select(*_SCORED, "score", "outputs").mapInArrow(
        score, "doc_id long, place long, held_out boolean, n_tokens long, n_known long, "
               "base_score double, score double")
    # the words that weren't sent: their counts join by hash, then sum per document
    others = hashed.where(level < least).select("hash", "n")
    met = encoded.select("place", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "place", F.col("x.rare").alias("hash"), F.col("x.times").alias("times"))
    added = (met.join(others, "hash").groupBy("place")
             .agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0))
                  .alias("logs")))
    more, logs = F.coalesce("more", F.lit(0)), F.coalesce("logs", F.lit(0.0))
    return scored.join(added, "place", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + more).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base_score") + logs).alias("base_score"), (F.col("score") + logs).alias("score"))
