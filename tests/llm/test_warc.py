import base64
import hashlib
import io
import random
import tempfile
import zlib

import pyarrow.fs as fs
import pytest
from cases import rows

from loadpanel.llm import warc

PAGES = [
    (5, "http://a/5", "<p>same</p>", "x"),
    (2, "http://a/2\r\nEvil: 1", "<p>same</p>", "x"),
    (9, None, None, None),
    (3, "http://b", "", "x"),
    (None, "http://c", "<p>same</p>", "x"),
    (7, "http://d", "é漢😀" * 5000, "x"),
    (7, "http://d", "é漢😀" * 5000, "x"),
    (7, "http://d2", "other\r\n\r\nWARC/1.0\r\nbody", "x"),
    (8, "http://d3", "other\r\n\r\nWARC/1.0\r\nbody", "x"),
]
SCHEMA = "page_id long, url string, html string, file string"


def expected(pages):
    first = {}
    for i, _, h, *_ in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h, *_ in pages:
        body = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        new = i is None or first[h or ""] == i
        out.append((i, len(body), digest, "response" if new else "revisit", None if new else first[h or ""]))
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("file_bytes", [warc.FILE_BYTES, 1])
def test_round_trip_of_awkward_pages(spark, file_bytes):
    got = warc.roundtrip(spark.createDataFrame(PAGES, SCHEMA), file_bytes=file_bytes)
    assert rows(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == expected(PAGES)


def test_no_pages(spark):
    assert rows(warc.roundtrip(spark.createDataFrame([], SCHEMA))) == []


def test_normalised_files_hold_one_member_per_record(spark):
    folder = tempfile.mkdtemp()
    written = warc.write_archives(spark.createDataFrame(PAGES, SCHEMA).coalesce(1), f"{folder}/a")
    new = warc.normalise(written, f"{folder}/a", f"{folder}/b").collect()
    assert sum(r["records"] for r in new) == len(PAGES)
    for r in new:
        data = open(f"{folder}/b/{r['file']}", "rb").read()
        for line in open(f"{folder}/b/{r['file']}.idx"):
            offset, length, kind, record_id = line.rstrip("\n").split("\t")
            member = zlib.decompress(data[int(offset) : int(offset) + int(length)], 31)
            found = list(warc.Reader(io.BytesIO(member).read))
            assert [f.fields["WARC-Record-ID"] for f in found] == [record_id] and kind == "response"
    payloads = warc.read_archives(spark.createDataFrame(new), f"{folder}/b", read_bytes=1).collect()
    assert sorted(bytes(r["payload"]) for r in payloads) == sorted((h or "").encode() for _, _, h, _ in PAGES)


def test_reader_takes_any_chunks_and_rejects_cut_files():
    rng = random.Random(1)
    records = [warc.page_record(i, "u", bytes(rng.randrange(256) for _ in range(rng.randrange(3000)))) for i in range(20)]
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    whole = z.compress(b"".join(r.to_bytes() for r in records)) + z.flush()

    class Slow(io.BytesIO):
        def read(self, size=-1):
            return super().read(min(size, rng.randint(1, 50)))

    assert [r.to_bytes() for r in warc.Reader(warc.inflated(Slow(whole)))] == [r.to_bytes() for r in records]
    with pytest.raises((ValueError, zlib.error)):
        list(warc.Reader(warc.inflated(io.BytesIO(whole[: len(whole) // 2]))))
    assert isinstance(warc.open_folder("/tmp")[0], fs.LocalFileSystem)
    assert warc.open_folder("file:///tmp/x")[1] == "/tmp/x"
