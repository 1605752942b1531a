import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cabline.llm import bwt_dedup, decontam, hamming, lbl, quality, queries
from cabline.llm.graph import components, joined, roots
from tests.conftest import SF_SMALL

SPACED = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# quality rules

def base(text):
    text = text or ""
    words = SPACED.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) for k in range(3)
              if windows[tuple(words[i:i + 3])] > 1}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(inside))


def test_quality_base_statistics_and_labels(spark, texts, small):
    rows = {r.doc_id: r for r in queries.op3_quality_rules(spark, SF_SMALL).collect()}
    assert rows.keys() == texts.keys()
    for doc_id, text in texts.items():
        r, b = rows[doc_id], base(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == b
        assert r.base_failed == (b[0] < 50 or 100 * b[4] > 50 * b[0])
        assert not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in small("labels").collect()}
    wrong = [d for d, q in labels.items() if not rows[d].base_failed and rows[d].kept != (q == 1)]
    assert len(wrong) <= 0.02 * len(labels)


def test_quality_score_is_the_mean_log_ratio(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "c c"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (9, 1), (1, 1)], "doc_id long, quality int")
    rows = {r.doc_id: r.score for r in quality.quality_rules(docs, labels, buckets=64).collect()}

    def buckets(text):
        return quality.features(text.split(), 64).tolist()

    good, raw = Counter(buckets(b"a b a")), Counter(buckets(b"a b a") + buckets(b"c c"))
    for doc_id, text in ((1, b"a b a"), (2, b"c c")):
        expected = [math.log((good[x] + 1) / (sum(good.values()) + 64))
                    - math.log((raw[x] + 1) / (sum(raw.values()) + 64)) for x in buckets(text)]
        assert rows[doc_id] == pytest.approx(sum(expected) / len(expected))
    assert rows[3] == 0


def test_best_threshold_takes_the_middle_of_the_gap():
    cells = [(False, 10, 5), (False, 100, 1), (True, 300, 7), (True, 90, 1)]
    edge = quality.best_threshold(cells)
    assert 101 <= (edge + quality.SCORE_RANGE) / 2 / quality.SCORE_RANGE * quality.CELLS <= 300
    assert quality.best_threshold([(True, 3, 2)]) == 0.0


def test_quality_odd_and_empty(spark, odd, none):
    labels = spark.createDataFrame([(None, 1), (6, None), (5, 1), (4, 0)],
                                   "doc_id long, quality int")
    rows = quality.quality_rules(odd, labels).collect()
    assert len(rows) == odd.count()
    assert all(not r.kept and r.base_failed for r in rows if r.doc_id in (1, 2, 3, 4))
    assert quality.quality_rules(none, labels).count() == 0
    assert quality.quality_rules(odd, labels.limit(0)).count() == odd.count()


# language model

def test_base_scores_and_held_out_gain(spark, texts):
    rows = {r.doc_id: r for r in queries.op5_lbl_scores(spark, SF_SMALL).collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    tokens = {d: SPACED.findall(lower(t)) + [""] for d, t in texts.items()}
    counts = Counter(w for d in texts if not held[d] for w in tokens[d])
    total, distinct = sum(counts.values()), len(counts)
    for d, r in rows.items():
        expected = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens[d])
        assert r.base_score == pytest.approx(expected, rel=1e-9)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            held[d], len(tokens[d]), sum(counts[w] > 0 for w in tokens[d]), total)
    out = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_sent_and_joined_words_give_equal_scores(small):
    docs = small("documents").where("doc_id < 40")      # a small fixture
    all_sent = {r.doc_id: r for r in lbl.score_texts(docs).collect()}
    for r in lbl.score_texts(docs, known_words=1500).collect():
        other = all_sent[r.doc_id]
        assert r.n_known == other.n_known
        assert r.base_score == pytest.approx(other.base_score)
        assert r.score == pytest.approx(other.score, rel=1e-6)


def test_probabilities_sum_to_one():
    import numpy as np
    vocabulary = lbl.Vocabulary([b"a", b"b"], np.array([5, 3, 2, 1, 1]), 2)
    model = lbl.Model(vocabulary, 4, 2)
    model.t += np.random.default_rng(1).normal(0, 1, model.t.shape).astype(np.float32)
    # every output after the same two
    total = np.exp([model.log_probabilities(np.array([5, 0, x]), np.array([2]))[0]
                    for x in range(5)]).sum()
    assert total == pytest.approx(1, abs=1e-5)


def test_scores_equal_a_plain_recomputation(monkeypatch):
    monkeypatch.setattr(lbl, "_BLOCK", 7)
    rng = np.random.default_rng(4)
    words = lbl.Vocabulary([b"a", b"b", b"c"], np.array([5, 3, 2, 2, 1, 1]), 2)
    model = lbl.Model(words, 4, 3)
    model.t += rng.normal(0, 1, model.t.shape).astype(np.float32)
    model.c += rng.normal(0, 1, model.c.shape).astype(np.float32)
    texts = [words.outputs_of(lbl.words_of(t)) for t in
             (b"a b c", None, b"b zz yy a " * 9, b"", b"c")]
    expected = []
    for outputs in texts:
        total = 0.0
        for i, output in enumerate(outputs.tolist()):
            q = sum(model.r[outputs[i - k] if i >= k else words.start].astype(float) * model.c[k - 1]
                    for k in (1, 2, 3))
            scores = model.t.astype(float) @ q + model.b
            total += scores[output] - math.log(sum(math.exp(x) for x in scores))
        expected.append(total / math.log(10))
    assert lbl.text_scores(model, words, texts).tolist() == pytest.approx(expected, rel=1e-4)


def test_every_position_is_an_example(monkeypatch):
    import numpy as np
    monkeypatch.setattr(lbl, "BATCH", 64)
    words = lbl.Vocabulary([b"a", b"b"], np.array([5, 3, 2, 1, 1]), 2)
    texts = [b"a", None, b"b a c", b"", b"a b c d " * 100, b"a b"]
    wanted = [words.outputs_of(lbl.words_of(t)) for t in texts]
    rows = [pa.RecordBatch.from_arrays([pa.array([x.astype("<u2").tobytes() for x in part], pa.binary())],
                                       ["outputs"]) for part in (wanted[:3], [], wanted[3:])]
    batches = list(lbl.examples(iter(rows), words, 2))
    assert {len(t) for _, t in batches[:-1]} == {64}
    assert np.concatenate([t for _, t in batches]).tolist() == np.concatenate(wanted).tolist()
    padded = [np.concatenate([[words.start] * 2, x]) for x in wanted]
    before = [[x[i - 1], x[i - 2]] for x in padded for i in range(2, len(x))]
    assert np.concatenate([c for c, _ in batches]).tolist() == [[int(v) for v in c] for c in before]


@pytest.mark.parametrize("context", [1, 2, 4])
@pytest.mark.parametrize("size", [0.5, 40.0])
def test_lbl_factors_against_scores(context, size):
    """Factors a position give what all outputs' scores give; of large weights some products
    run out of range."""
    rng = np.random.default_rng(3)
    words = lbl.Vocabulary([b"a", b"b", b"c"], np.array([5, 3, 2, 2, 1, 1]), 2)
    model = lbl.Model(words, 4, context)
    model.t = rng.normal(0, size, model.t.shape).astype(np.float32)
    model.r = rng.normal(0, 2, model.r.shape).astype(np.float32)
    texts = [rng.integers(0, words.outputs, n) for n in (1, 700, 3, 1500)]
    line, places = words.laid_out(texts, context)
    wanted = model._by_scores(line, places)
    assert np.allclose(model._by_factors(line, places), wanted, rtol=1e-4, atol=1e-4)
    outputs = np.arange(words.outputs)                  # after one context: sums to 1
    after = np.concatenate([np.append(line[:context], x) for x in outputs])
    logs = model._by_factors(after, context + (context + 1) * outputs)
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-5)
    assert len(model._by_factors(line, places[:0])) == 0


def test_lbl_exponentials_do_not_grow_with_the_texts(monkeypatch):
    words = lbl.Vocabulary([b"a", b"b"], np.array([5, 3, 2, 1, 1]), 2)
    model, n, exp = lbl.Model(words, 4, 2), [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, *a, **b: (n.append(np.size(x)), exp(x, *a, **b))[1])
    texts = [np.arange(2000) % words.outputs]
    small = lbl.text_scores(model, words, texts)
    assert sum(n) < 2000
    monkeypatch.setattr(lbl, "_CELLS", 0)               # as of a large vocabulary
    assert lbl.text_scores(model, words, texts) == pytest.approx(small, rel=1e-5)
    assert sum(n) >= 2000 * words.outputs


@pytest.mark.parametrize("context", [1, 2, 3, 4])
@pytest.mark.parametrize("size", [0.5, 40.0])
def test_lbl_sums_of_seldom_halves(monkeypatch, context, size):
    """Contexts whose halves are in no table, in one table and in both, in several blocks."""
    for name, value in (("_HALVES", 3), ("_BLOCK", 7), ("_TOKENS", 500)):
        monkeypatch.setattr(lbl, name, value)
    rng = np.random.default_rng(6)
    words = lbl.Vocabulary([b"a", b"b", b"c"], np.array([5, 3, 2, 2, 1, 1]), 2)
    model = lbl.Model(words, 4, context)
    model.t = rng.normal(0, size, model.t.shape).astype(np.float32)
    texts = [rng.integers(0, words.outputs, n) ** 2 % words.outputs for n in (1, 700, 3, 1500)]
    line, places = words.laid_out(texts, context)
    wanted = model._by_scores(line, places)
    assert np.allclose(model._by_factors(line, places), wanted, rtol=1e-4, atol=1e-4)


def test_lbl_products_do_not_grow_with_the_texts(monkeypatch):
    """Every half's product is computed once, not once a token."""
    words = lbl.Vocabulary([b"a", b"b"], np.array([5, 3, 2, 1, 1]), 2)
    model, rows, products = lbl.Model(words, 4, 4), [], lbl._products
    monkeypatch.setattr(lbl, "_products", lambda f, x: (rows.append(len(x)), products(f, x))[1])
    lbl.text_scores(model, words, [np.random.default_rng(2).integers(0, words.outputs, 9000)])
    assert 0 < sum(rows) <= 2 * (words.outputs + 1) ** 2


def test_lbl_texts_are_split_many_at_a_time():
    texts = [b" A b\x0b\x1cC ", None, b"", b"  ", b"x\xc2\x85y\xff\x00 z", "Ä ß\u00a0É".encode(),
             b"\t\n", b"one", b"A\xff\x80 \xe2", b"q " * 50]
    wanted = [lbl.words_of(x) for x in texts]
    whole = pa.array([b"before it", *texts, b"behind"], pa.binary())
    for some, expected in ((whole.slice(1, len(texts)), wanted), (whole.slice(2, 3), wanted[1:4]),
                           (whole.slice(0, 0), []), (whole.slice(8, 1), [[b"one"]])):
        words, n = lbl.split_texts(some)
        assert words.to_pylist() == [w for x in expected for w in x]
        assert n.tolist() == [len(x) for x in expected]
    assert list(lbl.pieces(np.array([5, 0, 9, 1, 1, 30, 2]), 6)) == [
        (0, 2), (2, 3), (3, 5), (5, 6), (6, 7)]
    assert list(lbl.pieces(np.zeros(4, np.int64), 6)) == [(0, 4)]


def test_lbl_small_pieces_give_the_same(spark, odd, monkeypatch):
    """Pieces of a few texts, counts summed again and again, against plain ones."""
    texts = [r.text for r in odd.collect()] + ["a b a", " b  c ", "ü \x0b É"] * 20
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").coalesce(1)
    rows = sorted(lbl.score_texts(docs, known_words=3, hot_words=2).collect())
    monkeypatch.setattr(lbl, "_BYTES", 40)
    monkeypatch.setattr(lbl, "MAX_COUNTER", 3)
    again = sorted(lbl.score_texts(docs, known_words=3, hot_words=2).collect())
    counts = Counter(w for d, t in enumerate(texts) if lbl.fold(d) != lbl.HELD_OUT_FOLD
                     for w in [*lbl.words_of((t or "").encode()), b""])
    binary = docs.selectExpr("doc_id", "cast(text as binary) as text")
    assert {bytes(r.word): r.n for r in lbl.word_counts(binary).collect()} == counts
    for a, b in zip(rows, again, strict=True):
        tokens = [*lbl.words_of((texts[a.doc_id] or "").encode()), b""]
        assert a[:5] == b[:5] and (a.n_tokens, a.n_known) == (
            len(tokens), sum(counts[w] > 0 for w in tokens))
        assert (a.base_score, a.score) == pytest.approx((b.base_score, b.score), rel=1e-9)


def test_lbl_step_equals_a_plain_one():
    rng = np.random.default_rng(8)
    words = lbl.Vocabulary([b"a", b"b", b"c"], np.array([5, 3, 2, 2, 1, 1]), 2)
    model, plain = (lbl.Model(words, 4, 3) for _ in range(2))
    for name in lbl.Model.NAMES:
        value = rng.normal(0, 0.5, getattr(model, name).shape)
        setattr(model, name, value.astype(np.float32))
        setattr(plain, name, getattr(model, name).astype(float))
    before, targets = rng.integers(0, words.outputs + 1, (50, 3)), rng.integers(0, words.outputs, 50)
    noise = np.searchsorted(np.cumsum(words.share), np.random.default_rng(5).random(lbl.NOISE))
    slopes = {x: np.zeros_like(getattr(plain, x)) for x in lbl.Model.NAMES}
    for context, target in zip(before, targets):
        q = sum(plain.r[c] * plain.c[k] for k, c in enumerate(context))
        for x, real in [(target, 1), *((x, 0) for x in noise)]:
            delta = plain.t[x] @ q + plain.b[x] - math.log(lbl.NOISE * words.share[x])
            up = (real - 1 / (1 + math.exp(-delta))) / math.sqrt(50)
            slopes["t"][x] += up * q
            slopes["b"][x] += up
            for k, c in enumerate(context):
                slopes["r"][c] += up * plain.t[x] * plain.c[k]
                slopes["c"][k] += up * plain.t[x] * plain.r[c]
    lbl.Trainer(model, words, 5).train(before, targets)
    for x, slope in slopes.items():
        wanted = getattr(plain, x) + lbl.RATE * slope / np.sqrt(1e-2 + slope ** 2)
        assert np.allclose(getattr(model, x), wanted, rtol=1e-4, atol=1e-4)


def test_lbl_odd_and_empty(odd, none):
    rows = lbl.score_texts(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.n_tokens == 1 for r in rows if r.doc_id in (1, 2, 3))
    assert all(math.isfinite(r.score) for r in rows)
    assert lbl.score_texts(none).count() == 0


# benchmark decontamination

ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def contamination(texts, items):
    windows = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall(lower(text))
        size = min(13, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[i:i + size])].add(item)
    sizes, out = {len(w) for w in windows}, {}
    for d, text in texts.items():
        words, hit, found = ALNUM.findall(lower(text)), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if owners := windows.get(tuple(words[i:i + size])):
                    found |= owners
                    hit.update(range(i, i + size))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[d] = (len(words), len(hit), len(found), digest,
                  bool(hit) and 20 * len(hit) >= len(words))
    return out


def test_decontamination_query(spark, texts, small):
    items = [(str(r.item_id), r.text) for r in small("benchmark").collect()]
    rows = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
            for r in queries.op7_decontamination(spark, SF_SMALL).collect()}
    assert rows == contamination(texts, items)


@pytest.mark.parametrize("block_words", [decontam.BLOCK_WORDS, 40])
def test_decontamination_short_and_overlapping_items(spark, block_words):
    docs = {1: "x a b c y", 2: "A, b! c? d e f g h i j k l m n", 3: None, 4: "", 5: "a b",
            6: "ü é a B c a b c", 7: "m n"}
    items = [("s", "a b c"), ("w", "a b c d e f g h i j k l m n"), ("e", ""), (None, None),
             ("t", "m n"), ("t2", "m n"), (None, "ü é")]
    found = decontam.find_contamination(
        spark.createDataFrame(list(docs.items()), "doc_id long, text string"),
        spark.createDataFrame(items, "item_id string, text string"), block_words=block_words)
    expected = contamination(docs, [(i or "", t) for i, t in items])
    for r in found.collect():
        assert (r.n_words, r.n_hit, r.n_items, decontam.items_digest(r["items"]),
                r.contaminated) == expected[r.doc_id]


def test_decontamination_odd_and_empty(spark, odd, none):
    items = spark.createDataFrame([(1, "one"), (2, "lazy dog again")], "item_id long, text string")
    rows = decontam.find_contamination(odd, items).collect()
    assert len(rows) == odd.count()
    assert {r.doc_id for r in rows if r.contaminated} == {4, 6, 7, 8}
    assert decontam.find_contamination(none, items).count() == 0
    assert not [r for r in decontam.find_contamination(odd, items.limit(0)).collect() if r.n_hit]


# near-duplicates

def find(parent, x):
    while parent.setdefault(x, x) != x:
        x = parent[x]
    return x


def near_duplicates(texts, percent=85):
    sets = {}
    for d, text in texts.items():
        words = (text or "").encode().lower().split()
        sets[d] = ({tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) > 4
                   else {tuple(words)} if words else set())
    holders, parent = defaultdict(list), {d: d for d in sets}
    for d in sorted(sets):
        common = Counter(x for s in sets[d] for x in holders[s])
        for other, n in common.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[other]) - n):
                a, b = find(parent, d), find(parent, other)
                parent[max(a, b)] = min(a, b)
        for s in sets[d]:
            holders[s].append(d)
    return {d: (len(sets[d]), find(parent, d), find(parent, d) == d) for d in sets}


def test_near_duplicate_query(spark, texts):
    rows = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
            for r in queries.op8_near_duplicates(spark, SF_SMALL).collect()}
    assert rows == near_duplicates(texts)


def test_near_duplicates_chains_and_large_groups(spark):
    """A chain of small edits, many near copies of one text, and strangers that share a half."""
    base_words = [f"w{i}" for i in range(120)]
    texts, d = {}, 0
    for i in range(12):                     # each a little further from the first
        texts[100 + i] = " ".join([f"z{j}" for j in range(2 * i)] + base_words[2 * i:])
    for i in range(60):
        words = [f"v{j}" for j in range(150)]
        words[(i * 7) % 150] = f"edit{i}"
        texts[1000 - i] = " ".join(words)
    for i in range(30):
        texts[2000 + i] = " ".join([f"v{j}" for j in range(75)] + [f"u{i}_{j}" for j in range(75)])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    rows = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
            for r in hamming.near_duplicates(docs).collect()}
    assert rows == near_duplicates(texts)


def test_every_pair_under_the_distance_shares_a_key():
    import numpy as np
    rng = np.random.default_rng(2)
    size = hamming.CHUNKS * hamming.LANES
    for _ in range(50):
        a = rng.integers(0, 1 << 16, size).astype("<u2")
        b = a.copy()
        b[rng.permutation(size)[:hamming.MAX_DISTANCE]] ^= 1
        x, y = hamming.bucket_keys(np.stack([a, b]))
        assert set(x.tolist()) & set(y.tolist())


@pytest.mark.parametrize("percent", [85, 80, 60, 30])
def test_signatures_fit_the_percentage(percent):
    """Few true pairs are over the distance, and all under it share a key."""
    import numpy as np
    rng, shape = np.random.default_rng(3), hamming.shape_of(percent)
    assert shape.miss(percent) <= 1 / 12_000
    for _ in range(20):
        a = rng.integers(0, 1 << 16, shape.size).astype("<u2")
        b = a.copy()
        b[rng.permutation(shape.size)[:shape.distance]] ^= 1
        x, y = hamming.bucket_keys(np.stack([a, b]), shape)
        assert set(x.tolist()) & set(y.tolist())


def test_near_duplicates_odd_and_empty(odd, none):
    rows = hamming.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    got = {r.doc_id: (r.component_id, r.kept) for r in rows}
    assert got[7] == (6, False) and got[8] == (6, False) and got[6] == (6, True)
    assert got[1] == (1, True) and got[None] == (None, True)
    assert hamming.near_duplicates(none).count() == 0


def family(n: int, edits, seed: int = 5) -> list[str]:
    """Texts that change ``edits(rng)`` words of one text of 200 words."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(200)]
    out = []
    for k in range(n):
        words = list(base)
        for at in rng.choice(200, int(edits(rng)), replace=False):
            words[at] = f"x{k}y{at}"
        out.append(" ".join(words))
    return out


def brute_components(texts: list[str], percent: int) -> list[int]:
    sets = [set(hamming.shingle_set(t.encode()).tolist()) for t in texts]
    at = list(range(len(texts)))

    def root(i):
        while at[i] != i:
            at[i] = at[at[i]]
            i = at[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if 100 * both >= percent * (len(x) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                at[b] = a
    return [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("percent", [80, 85])
def test_families_around_the_threshold_match_brute_force(spark, percent):
    texts = family(250, lambda rng: rng.integers(1, 7)) + family(150, lambda rng: 4, seed=6)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in hamming.near_duplicates(df, percent).collect()}
    assert [found[i] for i in range(len(texts))] == brute_components(texts, percent)


def test_a_family_under_the_threshold_makes_rows_in_proportion(spark):
    """2,000 texts of similarity 0.80 to 0.84: the rows dealt to blocks grow with the members
    (times the blocks of the other side, thousands of members each), not with their pairs."""
    n = 2000
    texts = family(n, lambda rng: 2)
    sets = [hamming.shingle_set(t.encode()) for t in texts]
    size = np.array([len(x) for x in sets])
    both = hamming.common_counts(sets, sets)
    either = size[:, None] + size[None, :] - both
    assert 0.80 < np.median(both / either) < 0.84
    rows = [(0, i, i, int(size[i])) for i in range(n)]
    members = spark.createDataFrame(rows, "cluster long, id long, tree long, n long")
    assert hamming._dealt(members.where("id > 0"), members).count() < 12 * n
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for percent in (80, 85):
        linked = 100 * both >= percent * either
        label = np.arange(n)
        while True:
            least = np.where(linked, label[None, :], n).min(1)
            if (least == label).all():
                break
            label = least
        found = {r.doc_id: r.component_id for r in hamming.near_duplicates(df, percent).collect()}
        assert [found[i] for i in range(n)] == label.tolist()


def test_common_counts_are_exact():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60_000, int(rng.integers(0, 40_000))).astype(np.uint64))
            for _ in range(12)]
    found = hamming.common_counts(sets[:5], sets[5:])
    for i in range(5):
        for j in range(7):
            assert found[i, j] == len(np.intersect1d(sets[i], sets[5 + j]))


def test_components_by_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 202), (50, 50)]
    got = {r.id: r.component for r in
           components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200, 202: 200}
    tree = spark.createDataFrame([(5, 3), (3, 1), (9, 8), (7, 5)], "id long, component long")
    got = {r.id: r.component for r in roots(tree).collect()}
    assert got == {5: 1, 3: 1, 7: 1, 9: 8}
    top = spark.createDataFrame([(8, 1), (1, 1), (20, 1)], "id long, component long")
    got = {r.id: r.component for r in joined(roots(tree), top).collect()}
    assert got == {5: 1, 3: 1, 7: 1, 9: 1, 8: 1, 1: 1, 20: 1}


# repeated passages

def repeats(texts, length=200):
    data = [(d, (t or "").encode()) for d, t in texts]
    counts = Counter(t[i:i + length] for _, t in data for i in range(len(t) - length + 1))
    out = []
    for d, t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if counts[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_repeated_passage_query(spark, texts):
    rows = queries.op9_repeated_passages(spark, SF_SMALL).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows]
    assert sorted(got, key=str) == repeats(texts.items())


def test_thousands_of_equal_rows_without_an_id(spark):
    """Copies of a text, with and without ids, are one text: whole passages go from each, and a
    text that shares a passage with them loses it too."""
    base = " ".join(f"tok{i}" for i in range(300))
    other = "start of another text " + base[500:900] + " and its own end"
    rows = [(None, base)] * 3000 + [(i, base) for i in range(200)] + [(9000, other), (None, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    out = bwt_dedup.remove_repeats(df).groupBy("n_bytes", "n_removed", "n_spans").count().collect()
    assert sorted(map(tuple, out)) == sorted([
        (len(base), len(base), 1, 3200), (5, 0, 0, 1),
        (len(other), 400 + (base[499] == " ") + (base[900] == " "), 1, 1)])


@pytest.mark.parametrize("max_group", [bwt_dedup.MAX_GROUP, 2])
def test_repeated_passages_periodic_shifted_and_repeated_rows(spark, max_group):
    passage = " ".join(f"p{i}" for i in range(90))
    texts = [(1, "ab" * 300), (2, "x" + "ab" * 150), (3, passage), (4, "é" + passage[5:] + "ü"),
             (5, passage[:199]), (6, passage[100:301] + "tail"), (7, None), (8, ""),
             (9, "same row " * 40), (9, "same row " * 40), (None, "z" * 250), (10, "z" * 205),
             *[(20 + i, f"{i} head {i} " * 9 + passage + f" foot {i}" * 9) for i in range(8)]]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    rows = bwt_dedup.remove_repeats(docs, max_group=max_group, digest=True).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows]
    assert sorted(got, key=str) == repeats(texts)


def test_repeats_of_many_rows_without_an_id(spark):
    """Different texts under a null id, or under one id, are different rows."""
    passages = [" ".join(f"{k}p{j}" for j in range(60)) for k in range(40)]
    texts = [(None if i % 3 else 5, f"{i} a " * (i % 7) + passages[i % 40][i % 50:] + f" {i} z" * 9
              if i % 2 else f"{i} b" * 60) for i in range(6000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    rows = bwt_dedup.remove_repeats(docs, digest=True).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows]
    assert sorted(got, key=str) == repeats(texts)


def test_repeats_across_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(bwt_dedup, "PIECE", 300)
    text = " ".join(f"q{i * i}" for i in range(400))
    found = list(bwt_dedup.segments((text + text[350:900]).encode()))
    assert len(found) > 5
    assert sum(int(x[2].sum()) for x in found) == len(text) + 550 - 199


def test_repeats_odd_and_empty(odd, none):
    rows = bwt_dedup.remove_repeats(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.n_removed == r.n_bytes for r in rows if r.doc_id in (6, 7, 8))
    assert bwt_dedup.remove_repeats(none).count() == 0
