import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from cabline.llm import packing, queries, tokens, varbyte
from cabline.llm._common import scratch
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokens.word_bpe_path())


def encode(tokenizer, text, end):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_word_by_word_equals_the_tokenizer(tokenizer, texts):
    odd = ["", "Étion ÀB «x» don't I'LL ß ẞ ŉ 12ab a1b2 x.y ÿ Ÿ éa ǅ 漢字 the|||", "a<|endoftext|>b",
           "the&&&. ΑΣ ΣΑΣ. a\tb\r\nc\x0bd\x1ce\u00a0f", "e\u0301 \u0301x", "A" * 3000]
    for text in [*odd, *list(texts.values())[:60]]:
        found = next(tokens.encode_texts(tokens.word_bpe_path(), [text.encode()], 2))
        assert found == encode(tokenizer, text, 2).tobytes()


@pytest.mark.parametrize("values", [[], [0], [255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1],
                                    list(range(0, 70_000, 13))])
def test_variable_bytes_round_trip(values):
    ranks = np.array(values, "<u4")
    control, data = varbyte.pack(ranks)
    assert len(control) == -(-len(values) // 4)
    assert varbyte.unpack(control, data, len(values)).tolist() == values


def test_token_files_match_the_contract(spark, tokenizer, texts):
    rows = sorted(tuple(r) for r in queries.op1_token_files(spark, SF_SMALL).collect())
    start, expected = 0, []
    for doc_id in sorted(texts):
        ids = encode(tokenizer, texts[doc_id], 2)
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert rows == expected


def test_frequent_ids_take_one_byte(spark, tokenizer, small):
    path = scratch(spark, "token-test")
    varbyte.write_token_files(small("documents"), path, tokens.word_bpe_path(), 2)
    ids = np.frombuffer(spark.read.parquet(f"{path}/ranks").first()["ids"], "<u4").tolist()
    counts = Counter()
    for r in varbyte.read_token_files(spark, path).collect():
        counts.update(np.frombuffer(r["ids"], "<u4").tolist())
    assert ids == sorted(counts, key=lambda i: (-counts[i], i))


def test_token_files_odd_and_empty(spark, tokenizer, odd, none):
    path = scratch(spark, "token-test")
    varbyte.write_token_files(odd, path, tokens.word_bpe_path(), 2, shards=3)
    rows = varbyte.read_token_files(spark, path).orderBy("start").collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r.text for r in odd.collect()}
    for r in rows:
        if r.doc_id is not None:
            assert r["ids"] == encode(tokenizer, by_id[r.doc_id], 2).tobytes()
    assert [r.doc_id for r in rows][:2] == [None, None]
    path = scratch(spark, "token-test")
    varbyte.write_token_files(none, path, tokens.word_bpe_path(), 2)
    assert varbyte.read_token_files(spark, path, digest=True).count() == 0


def check_pieces(pieces, lengths, capacity):
    """Every id once, sequences gapless; returns the padding."""
    of_doc, of_sequence, padding = {}, {}, 0
    for doc, start, length, sequence, offset in pieces:
        of_doc.setdefault(doc, []).append((start, length))
        of_sequence.setdefault(sequence, []).append((offset, length))
    for spans, total in [(of_doc.get(d, []), n) for d, n in lengths.items()]:
        at = 0
        for start, length in sorted(spans):
            assert start == at and length > 0
            at += length
        assert at == total
    for spans in of_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
        padding += capacity - at if at & (at - 1) else 0
    return padding


def test_harmonic_packer_places_every_id_once():
    rng = random.Random(4)
    for capacity in (1, 8, 2048):
        lengths = {i: rng.choice([0, 1, 2, 3, rng.randrange(5000)]) for i in range(400)}
        packer, pieces = packing.HarmonicPacker(capacity), []
        for doc, n in lengths.items():
            pieces += packer.add(doc, n)
        pieces += packer.finish()
        padding = check_pieces(pieces, lengths, capacity)
        assert padding <= 0.005 * sum(lengths.values())
    with pytest.raises(ValueError):
        packing.HarmonicPacker(100)


def test_classes_hold_a_fixed_count():
    assert [packing.class_length(n, 2048) for n in (5000, 2048, 2047, 1024, 1023, 682, 681, 1)] == [
        2048, 2048, 1024, 1024, 682, 682, 512, 1]


def test_packing_query(spark, tokenizer, texts):
    rows = queries.op2_harmonic_packing(spark, SF_SMALL).collect()
    ids = {d: encode(tokenizer, t, 1) for d, t in texts.items()}
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r["length"]]
        assert zlib.crc32(part.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
    pieces = [(r.doc_id, r.start, r["length"], r.sequence_id, r.offset) for r in rows]
    total = sum(map(len, ids.values()))
    assert check_pieces(pieces, {d: len(x) for d, x in ids.items()}, 2048) < 0.005 * total


def test_packing_odd_and_empty(odd, none):
    rows = packing.pack_documents(odd, tokens.word_bpe_path(), 1).collect()
    assert sum(r["length"] for r in rows if r.doc_id == 1) == 1        # a null text: its end
    assert sum(r.start == 0 for r in rows) == odd.count()
    assert packing.pack_documents(none, tokens.word_bpe_path(), 1).count() == 0
