import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallymart.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_are_those_of_the_tokenizer(spark):
    texts = [
        None, "", " \n", "Hello, World's 2nd naïve café!", "a b c", "é é É", "<|endoftext|> x<|endoftext|>y",
        "ΣΑΣ ΟΔΟΣ", "word " * 9000, "x" * 3000, "Hello, World's 2nd naïve café!", "\x1c\x1d tab\tnew\nline",
    ]
    rows = spark.createDataFrame([(k, t, 7) for k, t in enumerate(texts)], "doc_id long, text string, length int")
    tokenizer, got = Tokenizer.from_file(PATH), {}
    for r in packing.pieces(rows, PATH, capacity=100).collect():
        got.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids))
    for k, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        cut = [ids[a : a + 100] for a in range(0, len(ids), 100)]
        want = [(p, 100 * p, len(c), np.array(c, "<u4").tobytes()) for p, c in enumerate(cut)]
        assert sorted(got[k]) == want


def test_chunks_beyond_the_table(monkeypatch):
    monkeypatch.setattr(packing, "_CACHE", 3)
    tokenizer, plain = packing.WordTokenizer(PATH), Tokenizer.from_file(PATH)
    for text in ("one two", "three four five", "one six seven eight nine", "", "two", "a<b <|endoftext|>", "b"):
        data = np.frombuffer(text.encode(), np.uint8)
        ids, sizes = tokenizer.encode(data, np.array([0, len(data)]))
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids and sizes.tolist() == [len(ids)]


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_every_capacity_holds(score):
    rng = random.Random(5)
    lengths = np.array([rng.randrange(1, 78) for _ in range(400)])
    sequence, offset = packing.best_fit(lengths, 100, 4, 6000, score=score)
    for s in np.unique(sequence):
        own = lengths[sequence == s]
        assert own.sum() <= 100 and len(own) <= 4 and (own**2).sum() <= 6000
        order = offset[sequence == s].argsort()
        assert np.concatenate([[0], np.cumsum(own[order])[:-1]]).tolist() == sorted(offset[sequence == s])


def test_tokens_alone_pack_tightly():
    lengths = np.array([60, 40, 70, 30, 50, 50, 100, 1])
    sequence, _ = packing.best_fit(lengths, 100, 100, 100 * 100)
    assert len(set(sequence)) == 5


def test_a_piece_beyond_a_capacity_is_an_error():
    with pytest.raises(ValueError):
        packing.best_fit(np.array([80]), 100, 4, 6000)


def test_groups_and_odd_rows(spark):
    rows = [(k % 50, k // 50, 1 + 37 * k % 99, "x") for k in range(500)] + [(3, 0, 112 - 100, "x")] * 2 + [(None, 0, 5, None)]
    table = spark.createDataFrame(rows, "doc_id long, piece int, length long, offset string")
    got = packing.pack(table, capacity=100, group_tokens=3000).collect()
    assert len(got) == len(rows)
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 100
    assert len(held) <= 1.1 * sum(r.length for r in got) / 100 + 10
    assert packing.pack(table.filter("false")).collect() == []


def test_rows_of_one_id_are_dealt_to_all_groups(spark):
    rows = [(None, 0, 10, 7)] * 600 + [(1, 0, 10, k) for k in range(600)]
    table = spark.createDataFrame(rows, "doc_id long, piece int, length long, ids_crc32 long")
    got = packing.pack(table, capacity=100, group_tokens=1500).collect()
    assert len(got) == len(rows)
    for doc_id in (None, 1):
        groups = [r.sequence_id >> 32 for r in got if r.doc_id == doc_id]
        assert len(set(groups)) == 8 and max(map(groups.count, groups)) < 200


def test_checksum(spark):
    rows = packing.pieces(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), PATH)
    ids = rows.first().ids
    assert packing.with_checksum(rows).first().ids_crc32 == zlib.crc32(ids)
