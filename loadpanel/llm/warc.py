"""WARC archives: written as monolithic gzip streams, normalised to one member per record.

A monolithic file is a single gzip stream over all its records, so nothing inside
can be reached without inflating what comes before. ``normalise`` inflates each
such file once, as a stream, rewrites every record as a gzip member of its own and
puts an index of offsets beside the file. After that any record, or any run of
records, can be read on its own.

Files lie in the shared folder. Tasks write under names of their own and report
them in a table that Spark commits, so files of lost attempts are never read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from loadpanel.llm.common import new_folder, slices, text_bytes
from loadpanel.scale import lookup_join, materialize, row_bound

VERSION = b"WARC/1.0"
# Every record of one run carries the same date, so that reruns write equal records.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"
# A monolithic file is closed once this many payload bytes are in it.
FILE_BYTES = 64 << 20
# Compressed bytes that one reading task takes at once.
READ_BYTES = 8 << 20
BUFFER = 1 << 20


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path in it."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme that Spark gives it, so that every task opens the same one."""
    spark.range(1).write.mode("overwrite").parquet(f"{folder}/here")
    found = spark.read.parquet(f"{folder}/here").select("_metadata.file_path").first()[0]
    return found.rpartition("/here/")[0]


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@dataclass
class Record:
    """A WARC record: its named fields, in order, and its block."""

    fields: dict[str, str]
    block: bytes = b""

    def head(self) -> bytes:
        fields = {**self.fields, "Content-Length": str(len(self.block))}
        return VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields.items()) + b"\r\n"

    def to_bytes(self) -> bytes:
        return self.head() + self.block + b"\r\n\r\n"

    def http(self) -> tuple[dict[str, str], bytes]:
        """Header fields (lower case) and payload of the HTTP message in the block."""
        head, _, payload = self.block.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "replace").split("\r\n")[1:]
        pairs = (line.partition(":") for line in lines)
        return {k.strip().lower(): v.strip() for k, _, v in pairs}, payload


def _one_line(value: str) -> str:
    """A field value without control characters, which would end the field."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def page_record(page_id: int | None, url: str | None, payload: bytes) -> Record:
    """A response record with the page as an HTTP message."""
    digest = sha1_base32(payload)
    fields = {
        "WARC-Type": "response",
        "WARC-Record-ID": f"<{ID_PREFIX}{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": _one_line(url or ""),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return Record(fields, http.encode() + payload)


def as_revisit(record: Record, refers_to: int) -> Record:
    """The record as a revisit of another with the same payload: HTTP header only."""
    fields = {
        **record.fields,
        "WARC-Type": "revisit",
        "WARC-Refers-To": f"<{ID_PREFIX}{refers_to}>",
        "WARC-Profile": PROFILE,
    }
    head, _, _ = record.block.partition(b"\r\n\r\n")
    return Record(fields, head + b"\r\n\r\n")


class Reader:
    """Records of an inflated stream, one after the other."""

    def __init__(self, read: Callable[[int], bytes]):
        self.read, self.held = read, bytearray()

    def _until(self, size: int) -> bool:
        while len(self.held) < size:
            more = self.read(max(BUFFER, size - len(self.held)))
            if not more:
                return False
            self.held += more
        return True

    def _take(self, size: int) -> bytes:
        if not self._until(size):
            raise ValueError("a record ends before its Content-Length")
        out = bytes(self.held[:size])
        del self.held[:size]
        return out

    def __iter__(self) -> Iterator[Record]:
        while True:
            # Blank lines end the record before.
            while self._until(2) and self.held[:2] == b"\r\n":
                del self.held[:2]
            if not self.held:
                return
            end, seen = -1, 0
            while end < 0:
                end = self.held.find(b"\r\n\r\n", max(0, seen - 3))
                seen = len(self.held)
                if end < 0 and not self._until(seen + 1):
                    raise ValueError("a record header does not end")
            lines = self._take(end + 4).decode("utf-8").rstrip("\r\n").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"no WARC record starts with {lines[0][:40]!r}")
            fields = {}
            for line in lines[1:]:
                name, _, value = line.partition(":")
                fields[name.strip()] = value.strip()
            length = int(fields.pop("Content-Length"))
            yield Record(fields, self._take(length))


def inflated(stream) -> Callable[[int], bytes]:
    """A ``read`` over the inflated bytes of a gzip file, whatever its number of members."""
    state = {"z": zlib.decompressobj(31), "tail": b"", "end": False}

    def read(size: int) -> bytes:
        while not state["end"]:
            z = state["z"]
            data = state["tail"] or stream.read(BUFFER)
            if not data:
                if not z.eof and state.get("begun"):
                    raise ValueError("the gzip stream ends early")
                state["end"] = True
                break
            state["begun"] = True
            out = z.decompress(data, size)
            state["tail"] = z.unconsumed_tail or z.unused_data
            if z.eof:
                state["z"], state["begun"] = zlib.decompressobj(31), False
            if out:
                return out
        return b""

    return read


@dataclass
class _Monolith:
    """One gzip stream over many records."""

    system: fs.FileSystem
    path: str
    level: int = 1
    records: int = 0
    size: int = 0
    z: object = field(init=False)
    out: object = field(init=False)

    def __post_init__(self) -> None:
        self.z = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        self.out = self.system.open_output_stream(self.path, compression=None)

    def add(self, record: Record) -> None:
        data = record.to_bytes()
        self.out.write(self.z.compress(data))
        self.records += 1
        self.size += len(data)

    def close(self) -> None:
        self.out.write(self.z.flush())
        self.out.close()


_WRITTEN = "file string, page_id long, payload_bytes long, payload_digest string"


def _write(folder: str, file_bytes: int):
    schema = pa.schema(
        [("file", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_folder(folder)
        system.create_dir(base, recursive=True)
        file = None
        for batch in slices(batches, "payload"):
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "payload"))
            for page_id, url, payload in zip(*columns):
                if file is not None and file.size >= file_bytes:
                    file.close()
                    file = None
                if file is None:
                    name = f"crawl-{uuid.uuid4().hex}.warc.gz"
                    file = _Monolith(system, f"{base}/{name}")
                record = page_record(page_id, url, payload)
                file.add(record)
                digest = record.fields["WARC-Payload-Digest"].removeprefix("sha1:")
                rows.append((name, page_id, len(payload), digest))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
        if file is not None:
            file.close()

    return run


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes a response record per row into monolithic archives and lists them: file, page_id, size and digest."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        text_bytes("html").alias("payload"),
    )
    return materialize(rows.mapInArrow(_write(folder, file_bytes), _WRITTEN), "warc-written")


def revisits(written: DataFrame) -> DataFrame:
    """file, page_id, payload_digest, refers_to of the records whose payload a record with a smaller page_id has.

    Payloads are equal when SHA-1 and length agree. Counting combines before the
    shuffle; of the groups only those with several pages go on.
    """
    key = ["payload_digest", "payload_bytes"]
    first = written.groupBy(*key).agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
    first = materialize(first.filter("last > refers_to").drop("last"), "warc-first")
    found = lookup_join(written, first, key, spread="page_id")
    return found.filter("page_id > refers_to").select("file", "page_id", "payload_digest", "refers_to").distinct()


def _normalise(source: str, target: str, level: int):
    def run(files: pd.DataFrame, decided: pd.DataFrame) -> pd.DataFrame:
        refers = dict(zip(zip(decided["page_id"], decided["payload_digest"]), decided["refers_to"]))
        done = []
        for name in files["name"].unique():
            done.append(_normalise_file(source, target, name, refers, level))
        return pd.DataFrame(done, columns=["file", "records", "bytes"])

    return run


def _normalise_file(source: str, target: str, name: str, refers: dict, level: int) -> tuple[str, int, int]:
    """Inflates one file once; writes its records as members and their places into a sidecar."""
    system, base = open_folder(source)
    out_system, out_base = open_folder(target)
    out_system.create_dir(out_base, recursive=True)
    new = f"{name.removesuffix('.warc.gz')}-{uuid.uuid4().hex[:12]}.warc.gz"
    offset = records = 0
    with (
        system.open_input_stream(f"{base}/{name}", compression=None) as stream,
        out_system.open_output_stream(f"{out_base}/{new}", compression=None) as out,
        out_system.open_output_stream(f"{out_base}/{new}.idx") as index,
    ):
        for record in Reader(inflated(stream)):
            named = (
                _page_id(record.fields.get("WARC-Record-ID", "")),
                record.fields.get("WARC-Payload-Digest", "").removeprefix("sha1:"),
            )
            if named in refers:
                record = as_revisit(record, int(refers[named]))
            z = zlib.compressobj(level, zlib.DEFLATED, 31)
            member = z.compress(record.to_bytes()) + z.flush()
            out.write(member)
            entry = (offset, len(member), record.fields.get("WARC-Type", ""), record.fields.get("WARC-Record-ID", ""))
            index.write(("\t".join(map(str, entry)) + "\n").encode())
            offset += len(member)
            records += 1
    return new, records, offset


def _page_id(record_id: str) -> int | None:
    value = record_id.strip("<>").removeprefix(ID_PREFIX)
    return int(value) if value.lstrip("-").isdigit() else None


def normalise(
    files: DataFrame, source: str, target: str, decided: DataFrame | None = None, level: int = 1
) -> DataFrame:
    """Normalises the named files of ``source`` into ``target`` and lists the new files.

    ``decided`` (file, page_id, payload_digest, refers_to) names records to be written as revisits.
    One task inflates a file, in a bounded buffer; it holds one record at a time.
    """
    names = materialize(files.select(F.col("file").alias("name")).distinct(), "warc-names")
    # Names are a few bytes each and would all be put into one task; a file is a task's worth of work.
    tasks = 2 * max(1, row_bound(names))
    if decided is None:
        decided = names.sparkSession.createDataFrame([], "file string, page_id long, payload_digest string, refers_to long")
    decided = decided.withColumnRenamed("file", "owner")
    new = (
        names.repartition(tasks, "name")
        .groupBy("name")
        .cogroup(decided.repartition(tasks, "owner").groupBy("owner"))
        .applyInPandas(_normalise(source, target, level), "file string, records long, bytes long")
    )
    return materialize(new, "warc-normalised")


_RECORD = (
    "record_id string, record_type string, target_uri string, payload_digest string, "
    "payload_bytes long, refers_to string, payload binary"
)


def _ranges(folder: str, read_bytes: int):
    """Runs of members, from the sidecars, that are read together."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = open_folder(folder)
        for pdf in batches:
            for name in pdf["file"]:
                rows, start, end = [], 0, 0
                with system.open_input_stream(f"{base}/{name}.idx") as stream:
                    for line in io.TextIOWrapper(stream, "utf-8", newline="\n"):
                        offset, length = map(int, line.split("\t", 2)[:2])
                        if end > start and offset + length - start > read_bytes:
                            rows.append((name, start, end - start))
                            start = offset
                        end = offset + length
                if end > start:
                    rows.append((name, start, end - start))
                yield pd.DataFrame(rows, columns=["file", "start", "size"])

    return run


def _read(folder: str, with_payload: bool):
    schema = pa.schema(
        [
            ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.string()),
            ("payload", pa.binary()),
        ]
    )

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_folder(folder)
        for batch in batches:
            for name, start, size in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "size"))):
                with system.open_input_file(f"{base}/{name}") as file:
                    file.seek(start)
                    stream = io.BytesIO(file.read(size))
                rows, held = [], 0
                for record in Reader(inflated(stream)):
                    rows.append(_row(record, with_payload))
                    held += len(record.block) if with_payload else 200
                    if held > 8 << 20:
                        yield flush(rows)
                        rows, held = [], 0
                if rows:
                    yield flush(rows)

    return run


def _row(record: Record, with_payload: bool) -> tuple:
    f = record.fields
    http, payload = record.http()
    digest = f.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    size = int(http.get("content-length", len(payload)))
    if f.get("WARC-Type") == "response":
        if (len(payload), sha1_base32(payload)) != (size, digest):
            raise ValueError(f"record {f.get('WARC-Record-ID')} does not hold the payload it names")
    return (
        f.get("WARC-Record-ID", "").strip("<>"),
        f.get("WARC-Type"),
        f.get("WARC-Target-URI"),
        digest,
        size,
        f["WARC-Refers-To"].strip("<>") if "WARC-Refers-To" in f else None,
        payload if with_payload and f.get("WARC-Type") == "response" else None,
    )


def read_archives(
    files: DataFrame, folder: str, with_payload: bool = True, read_bytes: int = READ_BYTES
) -> DataFrame:
    """Every record of normalised archives, read in runs of members found in the sidecars.

    The payload of a response is checked against its digest. A revisit has none;
    its size and digest are those of the payload it refers to.
    """
    found = files.select("file").mapInPandas(_ranges(folder, read_bytes), "file string, start long, size long")
    ranges = materialize(found, "warc-ranges")
    # As many tasks as runs: each is a few bytes here and ``read_bytes`` of work.
    spread = ranges.repartition(max(1, row_bound(ranges)))
    return spread.mapInArrow(_read(folder, with_payload), _RECORD)


def roundtrip(pages: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Pages written, normalised and read back: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    A null html is an empty payload. Of equal payloads the smallest page_id is the
    response; rows that repeat that id with the same payload are responses too.
    Rows with a null page_id are responses and nothing refers to them. If a page_id
    repeats with different payloads, each row is judged by its own payload. Other
    columns are not written. Without rows, no rows.
    """
    folder = qualified(pages.sparkSession, folder or new_folder(pages.sparkSession, "warc"))
    crawl, archive = f"{folder}/crawl", f"{folder}/archive"
    written = write_archives(pages, crawl, file_bytes)
    new = normalise(written, crawl, archive, revisits(written))
    number = lambda c: F.when(F.col(c).startswith(ID_PREFIX), F.substring_index(c, ":", -1)).try_cast("long")
    return read_archives(new, archive, with_payload=False).select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
        F.col("target_uri").alias("url"),
    )
