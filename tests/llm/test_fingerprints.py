import hashlib
import math
import random

import pytest

from tallymart.llm import fingerprints


def edited(rows):
    """By (doc_id, text): the edited text and the next text, in order of descending id, then text."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    out = []
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        third = len(text) // 3
        out.append((i, len(text), hashlib.sha256((text[: len(text) - third] + following[:third]).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_edited_texts_follow_the_order_of_ids(spark, docs, ranges):
    rng = random.Random(9)
    rows = [(rng.randrange(10**6), " ".join(rng.choice("añ b cd e fü gh😀".split()) for _ in range(rng.randrange(30)))) for _ in range(40)]
    rows += [(5, None), (7, ""), (8, "x"), (8, "x"), (8, "another text of this id")]
    got = fingerprints.edited_likeness(docs(rows), ranges).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(edited(rows))


def test_fingerprints_and_likeness(spark, docs):
    rng = random.Random(10)
    text = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    base = text(300)
    rows = [(1, base), (2, base), (3, text(300)), (4, None), (5, ""), (6, "one"), (7, "ONE "), (9, text(30_000))]
    got = {r.doc_id: r for r in fingerprints.edited_likeness(docs(rows)).collect()}
    assert got[1].fingerprint == got[2].fingerprint != got[3].fingerprint
    assert got[4].fingerprint == got[5].fingerprint == "0" * 32
    assert got[6].fingerprint == got[7].fingerprint
    assert got[2].near_next == 1.0 and got[3].near_next < 0.5 < got[3].near_edited
    for r in got.values():
        bits = (int(r.fingerprint, 16) ^ int(r.edited_fingerprint, 16)).bit_count()
        assert math.isclose(r.near_edited, max(0.0, math.cos(math.pi * bits / 128)), abs_tol=1e-9)


def test_fingerprint_equals_a_plain_vote(spark):
    from pyspark.sql import functions as F

    text = "Alpha beta gamma alpha beta delta"
    words = text.lower().split()
    pairs = list(zip(words, words[1:]))
    table = spark.createDataFrame(pairs, "a string, b string").select(
        F.xxhash64("a", "b").alias("h"), (F.length("a") + F.length("b")).alias("w")
    )
    votes = [0] * 128
    for r in table.withColumn("h1", F.xxhash64("h")).collect():
        for half, h in enumerate((r.h, r.h1)):
            for bit in range(64):
                votes[64 * half + bit] += r.w if h >> bit & 1 else -r.w
    hi, lo = (sum(1 << b for b in range(64) if votes[64 * half + b] > 0) for half in (0, 1))
    rows = spark.createDataFrame([(1, text)], "k int, text string")
    got = fingerprints.simhash(rows, ["k"], {"x": F.col("text")}).first()
    assert (got.x_hi & (1 << 64) - 1, got.x_lo & (1 << 64) - 1) == (hi, lo)


@pytest.mark.parametrize(("radius", "blocks"), [(0, None), (3, None), (4, 7)])
def test_near_pairs_equal_brute_force(spark, radius, blocks):
    rng = random.Random(11)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    numbers = [rng.getrandbits(128) for _ in range(30)]
    for _ in range(60):
        flips = rng.sample(range(128), rng.randrange(7))
        numbers.append(rng.choice(numbers) ^ sum(1 << f for f in flips))
    rows = [(signed(x >> 64), signed(x & (1 << 64) - 1)) for x in numbers]
    got = {frozenset(((r.hi, r.lo), (r.other_hi, r.other_lo))): r.bits for r in fingerprints.near_pairs(
        spark.createDataFrame([*rows, rows[0], (None, 1)], "hi long, lo long"), radius, blocks).collect()}
    want = {}
    for a, x in zip(numbers, rows):
        for b, y in zip(numbers, rows):
            if x != y and (a ^ b).bit_count() <= radius:
                want[frozenset((x, y))] = (a ^ b).bit_count()
    assert got == want


def test_tables_without_ids_or_rows(spark, docs):
    assert fingerprints.edited_likeness(docs([])).collect() == []
    got = fingerprints.edited_likeness(docs([(None, "b c d"), (None, "a")])).collect()
    assert [r.n_chars for r in sorted(got, key=lambda r: r.n_chars)] == [1, 5]
