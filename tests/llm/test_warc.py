"""Archives: an exact round trip, members that stand alone, and streams cut anywhere."""

import gzip
import hashlib
import io
import random
import zlib
from collections import Counter

import pytest

from inkveil.llm.warc import WarcParams, index, inflated, normalise, read, records, round_trip, split, write


def pages():
    rng = random.Random(1)
    body = lambda n: "".join(rng.choices("<p>é日x \r\n\tWARC/1.1\r\n\r\n", k=n))
    rows = [(i, f"http://a.example/{i}?q=ü x\r\ny", body(rng.randint(0, 400))) for i in range(40)]
    rows += [(100 + i, None, rows[i % 3][2] + "z" * 100) for i in range(12)]
    rows += [(200, "u", None), (201, "u", ""), (202, "", "s" * 99), (203, "", "s" * 99), (204, "", "é" * 50), (205, "", "é" * 50)]
    rows += [(None, "u", "n" * 200), (None, "u", "n" * 200), (300, "u", "n" * 200), (300, "u", "n" * 200), (301, None, "n" * 200)]
    return rows + [(400, "u", "long " * 300_000)]


def expected(rows):
    firsts = {}
    for i, _, html in rows:
        if i is not None:
            firsts[html or ""] = min(i, firsts.get(html or "", i))
    found = []
    for i, _, html in rows:
        raw = (html or "").encode()
        first = firsts.get(html or "")
        revisit = len(raw) >= 100 and i is not None and first != i
        found.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return Counter(found)


SCHEMA = "page_id long, url string, html string"


def test_round_trip(spark):
    rows = pages()
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", digest string")
    for params in (WarcParams(), WarcParams(file_records=7, read_bytes=50, level=1)):
        got = round_trip(df, params).collect()
        assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(rows)
    assert round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_archives_are_streams_and_members(spark, tmp_path):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    write(df, f"{tmp_path}/one")
    total = normalise(spark, f"{tmp_path}/one", f"{tmp_path}/two").agg({"n": "sum"}).first()[0]
    assert total == len(rows)
    texts = Counter((r.record + "\r\n\r\n").encode() for r in records(df).collect())
    for file in (tmp_path / "one").glob("*.gz"):
        raw = file.read_bytes()
        stream = zlib.decompressobj(31)
        stream.decompress(raw)
        assert stream.eof and not stream.unused_data  # one member
    names = {p.name for p in (tmp_path / "two").iterdir() if not p.name.endswith(".crc")}
    assert all(n.endswith((".warc.gz", ".idx")) for n in names)
    members = Counter()
    for row in index(spark, f"{tmp_path}/two").collect():
        raw = (tmp_path / "two" / row.archive).read_bytes()
        members[gzip.decompress(raw[row.offset:row.offset + row.length])] += 1
    assert members == texts
    whole = Counter(x for p in (tmp_path / "two").glob("*.gz") for x in split(iter([gzip.decompress(p.read_bytes())])))
    assert whole == texts  # read from front to back as well
    got = read(spark, f"{tmp_path}/two").collect()
    assert Counter(bytes(r.payload).decode() for r in got if r.record_type == "response") == Counter(
        {h: n for (h, n) in Counter(r[2] or "" for r in rows if expected(rows) and not is_revisit(rows, r)).items()})
    assert all(r.payload is None for r in got if r.record_type == "revisit")


def is_revisit(rows, row):
    ids = [i for i, _, h in rows if i is not None and (h or "") == (row[2] or "")]
    return row[0] is not None and len((row[2] or "").encode()) >= 100 and min(ids) != row[0]


class Watched(io.BytesIO):
    """A file that notes the most that was asked of it at once."""

    most = 0

    def read(self, n=-1):
        assert n > 0
        self.most = max(self.most, n)
        return super().read(n)


def test_a_large_archive_is_read_as_a_stream():
    record = b"WARC/1.1\r\nContent-Length: 100000\r\n\r\n" + b"0123456789" * 10_000 + b"\r\n\r\n"
    source, params = Watched(gzip.compress(record * 300, 1)), WarcParams(read_bytes=4096)
    sizes = Counter(map(len, split(inflated(source, params))))
    assert sizes == {len(record): 300} and source.most == 4096 and source.tell() > 10 * 4096
    pieces = list(inflated(gzip.compress(bytes(10_000_000)), WarcParams(read_bytes=1000)))  # grows a thousandfold
    assert sum(map(len, pieces)) == 10_000_000 and max(map(len, pieces)) <= 4000


def test_streams_cut_anywhere_and_broken_ones():
    record = b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 9\r\n\r\nab\r\n\r\ncd\n\r\n\r\n"
    raw = gzip.compress(record) + gzip.compress(record * 3)
    for size in (1, 7, 1000):
        assert list(split(inflated(raw, WarcParams(read_bytes=size)))) == [record] * 4
    assert list(split(iter([bytes([b]) for b in record * 2]))) == [record] * 2
    with pytest.raises(ValueError):
        list(split(inflated(raw[:-9], WarcParams())))
    with pytest.raises(ValueError):
        list(split(iter([record[:-6]])))
