import base64
import gzip
import hashlib
import zlib

import pytest

from tallymart.llm import warc
from tallymart.llm.storage import landed


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 5) for r in rows], "page_id long, url string, html string, payload string, refers_to long")


ROWS = [
    (4, "http://a/", "same ü\r\n\r\nContent-Length: 3\r\n"), (2, "http://b/", "same ü\r\n\r\nContent-Length: 3\r\n"), (9, None, None),
    (7, "http://c/\r\nX: 1", ""), (8, "http://d/", "x" * 300_000), (2, "http://b/", "same ü\r\n\r\nContent-Length: 3\r\n"), (1, "é", "own"),
]


@pytest.mark.parametrize(("per_file", "least"), [(20_000, 0), (2, 0), (1, 1)])
def test_round_trip(spark, tmp_path, per_file, least):
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    found = warc.with_revisits(pages(spark, ROWS), least).repartition(2)
    names = landed(warc.write_monolithic(found, one, per_file), "names")
    index = landed(warc.normalise(spark, names, one, many), "index")
    got = sorted((tuple(r) for r in warc.read(index, many).collect()), key=str)
    first = {}
    for i, _, html in sorted(ROWS, key=lambda r: r[0]):
        first.setdefault(html or "", i)
    want = []
    for i, _, html in ROWS:
        raw, f = (html or "").encode(), first[html or ""]
        again = f != i and len(raw) >= least
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((i, len(raw), sha, "revisit" if again else "response", f if again else None, None if again else bytearray(raw)))
    assert got == sorted(want, key=str)
    for name in {r.name for r in names.collect()}:
        whole, members = (tmp_path / "one" / name).read_bytes(), (tmp_path / "many" / name).read_bytes()
        assert gzip.decompress(whole) == gzip.decompress(members)
        inflate = zlib.decompressobj(wbits=31)
        inflate.decompress(whole)
        assert not inflate.unused_data
        sidecar = [tuple(map(int, x.split())) for x in (tmp_path / "many" / f"{name}.idx").read_text().splitlines()]
        assert sorted(sidecar) == sorted((r.offset, r.length) for r in index.collect() if r.name == name)
        assert all(zlib.decompress(members[a : a + n], wbits=31).startswith(b"WARC/1.1\r\n") for a, n in sidecar)
    assert not [p for p in tmp_path.rglob(".pages*")]


def test_empty_table(spark, tmp_path):
    names = landed(warc.write_monolithic(warc.with_revisits(pages(spark, [])), str(tmp_path / "one")), "names")
    index = landed(warc.normalise(spark, names, str(tmp_path / "one"), str(tmp_path / "many")), "index")
    assert warc.read(index, str(tmp_path / "many")).collect() == []


def test_records_are_cut_anywhere():
    raw = [warc.record(k, "u", b"a\r\n\r\nb" * k, None if k % 2 else 7) for k in range(6)]
    whole = b"".join(raw)
    for step in (1, 3, 1000):
        assert list(warc.records(whole[a : a + step] for a in range(0, len(whole), step))) == raw
    with pytest.raises(ValueError):
        list(warc.records([whole[:-1]]))
