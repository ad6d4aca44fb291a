import hashlib
import random
import re
import time

import pytest

from tallymart.llm import pii

# The contract's patterns, as they stand.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    None, "", "nothing here", "a@b.co, x.y+z@mail-1.example.org; @no.com a@b", "10.0.0.1 and 256.1.1.1 and 1.2.3.4.5 0001.2.3.4",
    "4111 1111 1111 1111 4111111111111112 4111-1111-1111-1111-1 12 34", "+49 (30) 123-45 67 +1 2 +1234567890123456 +1 (988) 555-2485.",
    "é@x.de ü 8.8.8.8 ☎ +44 20 7946 0958 😀 a@b.c", "1 " * 60, "4" * 40, "x" * 5000 + " q@r.st", "9" * 400 + ".1.1.1",
]


def brute(text):
    spans = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": lambda: True,
                "ip": lambda m=m: all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split(".")),
                "card": lambda d=digits: 16 <= len(d) <= 19
                and sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1])) % 10 == 0,
                "phone": lambda d=digits: 8 <= len(d) <= 15,
            }[kind]()
            if ok:
                spans.append((kind, m.start(), m.end()))
    return spans


@pytest.mark.parametrize("text", TEXTS)
def test_plain_spans_are_those_of_the_patterns(text):
    base, spans = pii.find(text)
    assert base == brute(text)
    assert set(base) <= set(spans)


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("write john [at] mail [dot] com.", "email", "john [at] mail [dot] com"),
        ("write jane.doe(at)mail.example.com today", "email", "jane.doe(at)mail.example.com"),
        ("it is john at mail dot co dot uk", "email", "john at mail dot co dot uk"),
        ("ах jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
        ("ｊｏｅ＠ｍａｉｌ．ｃｏｍ", "email", "ｊｏｅ＠ｍａｉｌ．ｃｏｍ"),
        ("call plus one two zero two five five five zero one four seven now", "phone", "plus one two zero two five five five zero one four seven"),
        ("+49 30 fünf fünf fünf 12 34 56", "phone", "+49 30 fünf fünf fünf 12 34 56"),
        ("pay four one one one one one one one one one one one one one one one please", "card", "four one one one one one one one one one one one one one one one"),
        ("host １９２.168.0.1 is up", "ip", "１９２.168.0.1"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, found):
    base, spans = pii.find(text)
    assert base == brute(text)
    assert [(k, text[a:b]) for k, a, b in spans] == [(kind, found)]


@pytest.mark.parametrize(
    ("text", "kind", "plain", "whole"),
    [
        ("to jоhn@example.com now", "email", "hn@example.com", "jоhn@example.com"),  # only the local part is disguised
        ("to john [dot] smith@example.com now", "email", "smith@example.com", "john [dot] smith@example.com"),
        ("to john@mail.exаmple.com now", "email", "john@mail.ex", "john@mail.exаmple.com"),
        ("at 1２3.4.5.6 now", "ip", "3.4.5.6", "1２3.4.5.6"),
        ("call +49 30 1234567 eight nine now", "phone", "+49 30 1234567", "+49 30 1234567 eight nine"),
        ("at 1.２.3.4.5.6 now", "ip", "3.4.5.6", "1.２.3.4"),
    ],
)
def test_disguises_with_a_plain_part_are_found_whole(text, kind, plain, whole):
    base, spans = pii.find(text)
    assert base == brute(text)
    assert [(k, text[a:b]) for k, a, b in base] == [(kind, plain)]
    assert sorted((k, text[a:b]) for k, a, b in spans) == sorted([(kind, plain), (kind, whole)])
    first, last = text.split()[0], text.split()[-1]
    assert pii.hidden(text) == f"{first} [{kind.upper()}] {last}"


def test_spans_are_those_of_the_patterns_on_random_texts():
    rng = random.Random(8)
    for alphabet in ("ab.@-+ ", "12.@ a", "0.+()- 1", "41 -"):
        for _ in range(1500):
            text = "".join(rng.choices(alphabet, k=rng.randrange(40)))
            assert list(pii.plain(text)) == brute(text), text


def test_disguised_addresses_are_those_of_one_pattern():
    part = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+"
    whole = re.compile(rf"{part}(?:{pii._DOT}[A-Za-z0-9_%+-]+)*(?:{pii._REST.pattern})", re.I)
    rng = random.Random(9)
    for _ in range(20_000):
        text = "".join(rng.choices(["a", "b.c", " dot ", " at ", "[dot]", "(at)", "@", " @ ", " ", ".", "x-"], k=rng.randrange(16)))
        assert list(pii._mails(text)) == [m.span() for m in whole.finditer(text)], text


@pytest.mark.parametrize(
    "run",
    ["a", "1", "1.", "+", "+1", "4 ", "a.", "a@", "@", "1.1.1.1 ", "a@b.c ", "a dot ", "a dot b.c at ", "[at]", "one ", "1 "],
)
def test_runs_of_a_million_characters_take_no_longer_than_their_length(run):
    text = "\u0430 one @ at dot (at) +1 1.1 " + run * (1_000_000 // len(run)) + "!"
    start = time.process_time()
    base, spans = pii.find(text)
    assert time.process_time() - start < 8
    assert set(base) <= set(spans)


def test_plain_spans_beside_a_disguise_come_once():
    text = "mail a@b.co- or call +49 30 1234567, аnd 10.0.0.1"
    assert pii.find(text) == (brute(text), brute(text))


@pytest.mark.parametrize(
    "text", ["look at it", "meet at noon.Then go", "one two three four", "the dot is at the end", "naïve façade, at any rate.", "Привет мир"]
)
def test_clean_texts_are_left_alone(text):
    assert pii.find(text) == ([], [])
    assert pii.hidden(text) == text


def test_rows_and_masks(spark):
    rows = spark.createDataFrame([(k, t, "x") for k, t in enumerate(TEXTS)] * 2, "doc_id long, text string, spans string")
    got = pii.span_digest(pii.personal_data(rows)).collect()
    assert len(got) == 2 * len(TEXTS)
    for r in got:
        base, spans = pii.find(TEXTS[r.doc_id])
        line = lambda x: ",".join(f"{k}:{a}:{b}" for k, a, b in x)
        assert r.base_sha256 == hashlib.sha256(line(base).encode()).hexdigest() and r.spans == line(spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]
    masked = {r.doc_id: r for r in pii.masked(rows).collect()}
    assert masked[0].text is None and masked[0].spans == "x"
    assert masked[3].text.startswith("[EMAIL], [EMAIL]; @no.com")
    assert pii.masked(rows.filter("false")).collect() == []
