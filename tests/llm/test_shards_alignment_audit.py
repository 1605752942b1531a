import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cabline.llm import alignment, feistel, filter_audit, queries, tokens
from cabline.llm._common import cut, mix64, scratch, setting
from tests.conftest import SF_SMALL

# ---- op11: Feistel shards ----


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 16, 17, 1000, 4097])
def test_permutation_is_a_bijection_with_an_inverse(n):
    p = feistel.Permutation(n, "k")
    at = p.position(np.arange(n))
    assert sorted(at.tolist()) == list(range(n))
    assert p.row(at).tolist() == list(range(n))


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 1 << 60), st.text(max_size=8), st.integers(0, 1 << 60))
def test_large_permutations_invert(n, key, x):
    p = feistel.Permutation(n, key)
    rows = np.array([x % n, 0, n - 1])
    at = p.position(rows)
    assert ((0 <= at) & (at < n)).all() and p.row(at).tolist() == rows.tolist()


def test_permutation_spreads_and_follows_the_key():
    at = feistel.Permutation(100_000, "a").position(np.arange(100_000))
    assert abs(np.corrcoef(np.arange(100_000), at)[0, 1]) < 0.02
    assert (at != feistel.Permutation(100_000, "b").position(np.arange(100_000))).mean() > 0.99
    with pytest.raises(ValueError):
        feistel.Permutation(5, "a").position(np.array([5]))


def plain_position(x: int, n: int, key: str) -> int:
    """The network in plain integers."""
    half = 1
    while 4 ** half < n:
        half += 1
    mask = (1 << half) - 1
    keys = [int.from_bytes(hashlib.sha256(f"{key}/{r}".encode()).digest()[:8], "little")
            for r in range(8)]
    while True:
        left, right = x >> half, x & mask
        for k in keys:
            f = int(mix64(np.array([(right + k) % (1 << 64)], np.uint64))[0])
            left, right = right, left ^ (f & mask)
        x = right << half | left
        if x < n:
            return x


def test_shards_match_plain_python(spark, texts):
    rows = queries.op11_feistel_shards(spark, SF_SMALL).collect()
    n, found = len(texts), {r.doc_id: r for r in rows}
    assert len(rows) == n and {r.law for r in rows} == {"rows"}
    for number, doc_id in enumerate(sorted(texts)):
        p = plain_position(number, n, queries.SHUFFLE_KEY)
        raw = (texts[doc_id] or "").encode()
        r = found[doc_id]
        assert (r["size"], r.text_crc32, r.shard, r.slot, r.grown_shard) == (
            len(raw) + 1, zlib.crc32(raw), p % 8, p // 8, None)


def test_shards_do_not_follow_the_partitions(spark, small):
    docs = small("documents").select("doc_id", "text")
    a = {r.doc_id: (r.shard, r.slot) for r in feistel.shard_rows(docs, 8, "k").collect()}
    b = feistel.shard_rows(docs.repartition(7, "text"), 8, "k").collect()
    assert a == {r.doc_id: (r.shard, r.slot) for r in b}
    numbers = {r.doc_id: r.row_number for r in b}
    for shard in range(8):
        mine = sorted((slot, i) for i, (s, slot) in a.items() if s == shard)
        back = feistel.row_at(shard, np.arange(len(mine)), len(a), 8, "k").tolist()
        assert back == [numbers[i] for _, i in mine]


def test_shards_of_odd_empty_and_repeated_rows(spark, odd, none):
    for df in (odd, none, odd.limit(1), spark.range(20_000).select(
            F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))):
        rows = feistel.shard_rows(df, 3, "k").collect()
        n = df.count()
        assert len(rows) == n
        slots = defaultdict(list)
        for r in rows:
            slots[r.shard].append(r.slot)
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())
        sizes = [len(slots[s]) for s in range(3)]
        assert max(sizes) - min(sizes) <= 1
        assert sorted(r.row_number for r in rows) == list(range(n))
    with pytest.raises(ValueError):
        feistel.shard_rows(odd.withColumn("SLOT", F.lit(1)), 3, "k")


def test_written_shards_come_back_in_slot_order(spark, small):
    docs, path = small("documents"), scratch(spark, "shards-test")
    feistel.write_shards(docs, path, 4, "k")
    total = 0
    for shard in range(4):
        rows = feistel.read_shard(spark, path, shard).select("slot", *docs.columns).collect()
        assert [r.slot for r in rows] == list(range(len(rows)))
        total += len(rows)
    assert total == docs.count()
    assert set(docs.columns) < set(spark.read.parquet(path).columns)


# ---- op12: alignment ----

@pytest.fixture(scope="module")
def sides():
    return (alignment.ByteLevel(tokens.byte_bpe_path()), alignment.Pieces(tokens.piece_bpe_path()))


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 120)), st.sets(st.integers(1, 120)), st.integers(121, 140))
def test_group_ends_are_the_common_ends(a, b, last):
    a, b = sorted(a | {last}), sorted(b | {last})
    ends_a, ends_b = (x.tolist() for x in alignment.group_ends(np.array(a), np.array(b)))
    common = sorted(set(a) & set(b))
    assert [a[i - 1] for i in ends_a] == common == [b[j - 1] for j in ends_b]


def test_long_one_to_one_stretches_are_skipped():
    class Counted(list):
        read = 0

        def __getitem__(self, at):
            Counted.read += 1
            return list.__getitem__(self, at)

    ends = list(range(3, 300_003, 3))
    a, b = Counted(ends), Counted([1, *ends])
    assert alignment.runs(a, b) == [(0, 100_000, 1)]
    assert Counted.read < 200


def test_fast_and_slow_encodings_agree(sides, texts):
    a, b = sides
    assert a.fast is not None
    latin = "".join(map(chr, [*range(0xA1, 0xAD), *range(0xAE, 0x180)]))
    rng = random.Random(3)
    signs = " \n\t" + "".join(map(chr, range(0x20, 0x7F))) * 2 + latin + " " * 60
    odd = ["".join(rng.choices(signs, k=rng.randint(1, 40))) for _ in range(3000)]
    odd += ["<|endoftext|> a</s><s><unk>", "a  b   c\n\n  d ", "it's I'LL don't 's", "x" * 3000,
            "1234 ½²³ ªº", "tail  \t\n", "\n\nlead"]
    for text in [*odd, *list(texts.values())[:100]]:
        if text:
            assert a.encode(" " + text).tolist() == a.slow(" " + text).tolist()


def test_plain_texts_get_the_model_s_ids_by_its_scores(sides, texts):
    _, b = sides
    assert b.fast is not None
    rng = random.Random(4)
    words = [p.decode().lstrip(" ") for i, p in enumerate(b.pieces) if not b.model.is_byte(i)]
    signs = "\n\t" + "".join(map(chr, [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x180)]))
    odd = [w for w in words if w]
    odd += ["".join(rng.choices(words, k=3)) + " " + "".join(rng.choices(signs, k=9))
            for _ in range(3000)]
    odd += [" ", "a ", " a", "a" * 500 + "  b", "x" * 3000, "1 22 333 " * 50 + "    4" + " y" * 99 + "   ",
            "\n \n" + "the cat " * 40 + "\n    the  cat", "<s> </s><unk><0x41>", "a ▁ b", "漢字 \x00"]
    for text in [*odd, *list(texts.values())[:100]]:
        if text:
            assert b.encode(" " + text).tolist() == b.model.encode(text)

    # a plain text never reaches the model, one of other letters does
    class Model:
        def encode(self, *args, **options):
            raise LookupError

    model, b.model = b.model, Model()
    try:
        assert len(b.encode(" the cat\tsaß,\n 12 naïve")) > 5
        with pytest.raises(LookupError):
            b.encode(" the Ω")
    finally:
        b.model = model


def brute_alignment(sides, texts: dict) -> dict:
    a, b = sides
    out, linked, counts = {}, {}, Counter()
    for doc_id, text in texts.items():
        raw = (" " + (text or "")).encode()
        ids_a, ids_b = (([], []) if not text else (a.slow(" " + text).tolist(), b.encode(" " + text).tolist()))
        by = [b"".join(s.pieces[i] for i in ids) for s, ids in ((a, ids_a), (b, ids_b))]
        if not text or by != [raw, raw]:
            out[doc_id] = (0, 0, 0, 0, "")
            linked[doc_id] = []
            continue
        ends = []
        for side, ids in ((a, ids_a), (b, ids_b)):
            at, of = 0, {}
            for n, i in enumerate(ids):
                at += len(side.pieces[i])
                of[at] = n
            ends.append(of)
        common = sorted(set(ends[0]) & set(ends[1]))
        linked[doc_id] = [(ids_a[ends[0][e]], ids_b[ends[1][e]]) for e in common]
        counts.update(linked[doc_id])
        groups, s, t = [], 0, 0
        for e in common:
            x, y = ends[0][e] + 1, ends[1][e] + 1
            groups.append(",".join(map(str, ids_a[s:x])) + "|" + ",".join(map(str, ids_b[t:y])))
            s, t = x, y
        out[doc_id] = (len(ids_a), len(ids_b), len(common), len(common),
                       hashlib.sha256(";".join(groups).encode()).hexdigest())
    top: dict = {}
    for (_, y), n in counts.items():
        top[y] = max(n, top.get(y, 0))
    return {i: (*out[i][:4], sum(counts[p] == top[p[1]] for p in linked[i]),
                sum(counts[p] for p in linked[i]), out[i][4]) for i in texts}


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_matches_brute_force(spark, sides, texts):
    found = {r.doc_id: tuple(r[c] for c in COLUMNS)
             for r in queries.op12_token_alignment(spark, SF_SMALL).collect()}
    assert found == brute_alignment(sides, texts)


def test_alignment_of_few_sent_pairs_and_odd_texts(spark, sides, texts):
    rows = {1: None, 2: "", 3: "a ▁ b", 4: " ", 5: "naïve Ωmega 漢字 \U0001f600", 6: "<|endoftext|>",
            7: "word " * 20_000, 8: "the cat. the cat. The cat", 9: "tail ", 10: "a\x00b c",
            **{100 + i: t for i, t in texts.items()}}
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in rows.items()],
                               "doc_id long, text string, pairs int, n_a string")
    for sent in (0, 50):
        got = alignment.align_tokenizers(df, tokens.byte_bpe_path(), tokens.piece_bpe_path(),
                                         digest=True, sent_pairs=sent).collect()
        assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in got} == brute_alignment(sides, rows)


def test_alignment_of_null_ids_repeats_and_empty_tables(spark, odd, none, sides):
    def run(df):
        return alignment.align_tokenizers(df, tokens.byte_bpe_path(), tokens.piece_bpe_path())

    assert run(none).count() == 0
    rows = run(odd).collect()
    expected = brute_alignment(sides, dict(enumerate(r.text for r in odd.collect())))
    assert (sorted((r.n_a, r.n_b, r.n_best, r.count_sum) for r in rows)
            == sorted((x[0], x[1], x[4], x[5]) for x in expected.values()))
    one = run(spark.createDataFrame([(1, "the cat")], "doc_id long, text string")).first()
    assert one.groups == ";".join(x for x in one.groups.split(";")) and "|" in one.groups


# ---- op13: filter audit ----

def brute_audit(docs: list[tuple], labels: list[tuple]) -> dict:
    """docs (doc_id, part, text), labels (doc_id, quality, toxic)."""
    first: dict = {}
    for i, _, t in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    rows = []
    for i, part, t in docs:
        t = t or ""
        words = t.encode().split()
        fails = {x for x, yes in {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and first[t] < i}.items() if yes}
        rows.append((part or "", fails, i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley: Counter = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                removed = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                shapley[x] += len(removed)
                out[part, "".join(order), step] = (
                    len(left), len(removed), sum(x in r[1] for r in mine) - len(removed),
                    sum(r[1] == {x} for r in mine), sum(r[2] for r in removed),
                    sum(r[3] for r in removed))
        for (p, order, step), v in list(out.items()):
            if p == part:
                out[p, order, step] = (*v, shapley[order[step - 1]])
    return out


def audited(df) -> dict:
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails,
                                              r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(out) == len(rows)
    return out


def test_audit_matches_brute_force(spark, small):
    docs = [tuple(r) for r in small("documents").select("doc_id", "lang", "text").collect()]
    labels = [tuple(r) for r in small("labels").select("doc_id", "quality", "toxic").collect()]
    assert audited(queries.op13_filter_audit(spark, SF_SMALL)) == brute_audit(docs, labels)


def test_audit_of_odd_rows(spark, none):
    long = " ".join(f"w{i}" for i in range(150))
    docs = [(None, None, None), (None, "en", long), (1, "en", long), (1, "en", long), (2, "", long),
            (3, "en", long.upper()), (4, None, "# short"), (5, "de", ""), (6, "de", None),
            (7, "xx", "word " * 50_000), (None, "en", long), (8, "en", "ÉÀ " + long + " Ω" * 40),
            (9, "a|b'\"", "A" * 9 + "é" * 81), (10, "a|b'\"", "A" * 10 + "漢" * 80)]
    labels = [(1, 1, 0), (1, 0, 1), (None, 1, 1), (4, None, 1), (4, None, 1), (5, 1, None), (99, 1, 1)]
    df = spark.createDataFrame([(i, t, p, 1, "x", "y") for i, p, t in docs],
                               "doc_id long, text string, lang string, id int, part string, failed string")
    of = spark.createDataFrame([(i, q, t, "z") for i, q, t in labels],
                               "doc_id long, quality int, toxic int, good string")
    assert audited(filter_audit.audit(df, of)) == brute_audit(docs, labels)
    assert filter_audit.audit(none.withColumn("lang", F.lit("x")), of).count() == 0
    assert audited(filter_audit.audit(df, of.limit(0))) == brute_audit(docs, [])


def test_audit_splits_a_text_with_a_third_of_the_rows(spark):
    rows = [(i, "en", "same text") for i in range(3000)] + [(5000 + i, "en", f"t {i}")
                                                            for i in range(3000)]
    df = spark.createDataFrame([(i, t, p) for i, p, t in rows], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audited(filter_audit.audit(df, none)) == brute_audit(rows, [])
    judged = filter_audit.judge(df, "doc_id", "text", "lang")
    first = judged.groupBy("hash").agg(F.min("doc_id").alias("first")).hint("merge")
    parts = filter_audit.salted_join(judged.withColumn("n", F.lit(1)), first, "hash")
    assert parts.groupBy("hash", F.spark_partition_id().alias("p")).count().where(
        "count > 2000").count() == 0


def test_audit_sends_no_rows_by_the_driver(spark):
    rows = [(i, "en", f"t {i % 40}") for i in range(60)]
    df = spark.createDataFrame([(i, t, p) for i, p, t in rows], "doc_id long, text string, lang string")
    # as a stored table: Spark takes its size from the compressed files
    labels = cut(spark.createDataFrame([(i, i % 2, i % 3 % 2) for i in range(0, 60, 5)],
                                       "doc_id long, quality int, toxic int"), "test-labels")
    judged = filter_audit.judge(df, "doc_id", "text", "lang")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "1g"):
        copies, marked = (filter_audit.failing_ids(judged, "E"),
                          filter_audit.label_ids(judged, labels, "doc_id"))
        assert copies.count() == 20
        assert len(marked.collect()) == sum(bool(i % 2 or i % 3 % 2) for i in range(0, 60, 5))
        for found in (copies, marked):
            found.collect()
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Broadcast" not in plan
