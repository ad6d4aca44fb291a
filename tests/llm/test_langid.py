import math

import numpy as np

from tallymart.llm import langid

ENGLISH = "the cat sat on the mat and the dog ran over the hill with a loud bark"
GERMAN = "die katze sitzt auf der matte und der hund rennt über den hügel mit bellen"


def brute_bits(grams, text):
    counts = [{} for _ in range(4)]
    for gram, n in grams.items():
        for order in range(4):
            own = gram & ((1 << 8 * (order + 1)) - 1)
            after = counts[order].setdefault(own >> 8, {})
            after[own & 255] = after.get(own & 255, 0) + n
    padded, bits = b"\0\0\0" + text, 0.0
    for i in range(3, len(padded)):
        for order in (3, 2, 1, 0):
            after = counts[order].get(int.from_bytes(padded[i - order : i], "big"))
            if after is None:
                continue
            total = sum(after.values()) + len(after)
            if padded[i] in after:
                bits -= math.log2(after[padded[i]] / total)
                break
            bits -= math.log2(len(after) / total)
        else:
            bits += 8
    return bits


def grams_of(text):
    out, padded = {}, b"\0\0\0" + text
    for i in range(3, len(padded)):
        gram = int.from_bytes(padded[i - 3 : i + 1], "big")
        out[gram] = out.get(gram, 0) + 1
    return out


def test_code_lengths_are_exact(monkeypatch):
    trained = [grams_of(ENGLISH.encode()), grams_of(GERMAN.encode())]
    keys = np.array(sorted({k for g in trained for k in g}))
    model = langid.build(["en", "de"], keys, np.array([[g.get(k, 0) for g in trained] for k in keys], float))
    tests = [b"", b"the dog", b"q\xff\x00 der \xc3\xbc", GERMAN.encode()[::-1], b"a", b""]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in tests])])
    data = np.frombuffer(b"".join(tests), np.uint8)
    want = [[brute_bits(g, t) for g in trained] for t in tests]
    for part in (1 << 18, 1, 2, 5):
        monkeypatch.setattr(langid, "_PART", part)
        assert np.allclose(langid.code_lengths(model, data, offsets), want, rtol=1e-5, atol=1e-4)


def train_rows(spark):
    rows = [(k, ENGLISH if k % 2 else GERMAN, "en" if k % 2 else "de") for k in range(40)]
    return spark.createDataFrame([*rows, (900, "zzz", None), (901, None, "en")], "doc_id long, text string, lang string")


def test_predictions_and_odd_texts(spark):
    documents = train_rows(spark)
    model = langid.train(documents)
    assert model.languages == ["de", "en"]
    odd = [(1, "The dog sat"), (2, "der hund"), (3, None), (4, ""), (5, "12 34 !?"), (6, "the " * 100_000), (1, "The dog sat")]
    rows = spark.createDataFrame([(*r, 0.5) for r in odd], "doc_id long, text string, score double")
    found = langid.identify(rows, model)
    assert found.columns == ["doc_id", "text", "lang_pred", "score", "bits_per_byte"]
    got = sorted((r.doc_id, r.lang_pred) for r in found.collect())
    assert got == [(1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "en")]
    assert all(0 <= r.score <= 1 for r in found.collect())


def test_no_training_rows_and_empty_table(spark):
    documents = train_rows(spark)
    model = langid.train(documents.filter("false"))
    assert {r.lang_pred for r in langid.identify(documents, model).collect()} == {"und"}
    assert langid.identify(documents.filter("false"), langid.train(documents)).collect() == []


def test_held_out_rows_teach_nothing(spark):
    import zlib

    rows = train_rows(spark)
    taught = {r.doc_id for r in rows.filter(langid.learnable(rows)).collect()}
    assert taught == {k for k in [*range(40), 900, 901] if zlib.crc32(str(k).encode()) % 5}
