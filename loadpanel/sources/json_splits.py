"""Row-wise JSON documents of any size, read by many tasks.

A file is cut at every ``}``, which Spark's text source does for each byte range by itself. Whether such a brace ends a
record depends on all that stands before it: it may be inside a string or a nested object. So a first pass sums up
each range for both cases, quotes open or not, running sums over the ranges tell how each begins, and the second pass
puts records together. A record across two ranges is joined from its parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from loadpanel.scale import materialize
from loadpanel.sources.json_files import ROW_SCHEMA, canonical_rows

_ESCAPE = re.compile(r"\\.", re.DOTALL)
_PIECE = "file string, start long, piece string"


def _opened(piece: str, inside: bool) -> tuple[bool, int]:
    """Whether a string is open behind the piece, and the braces it opens outside strings."""
    plain = _ESCAPE.sub("", piece) if "\\" in piece else piece
    quotes = plain.count('"')
    if not inside and plain.count("{") == 1 and plain.lstrip(", \r\n\t[").startswith("{"):
        return quotes % 2 == 1, 1
    parts = plain.split('"')
    return inside != (quotes % 2 == 1), sum(p.count("{") for p in parts[1 if inside else 0 :: 2])


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each byte range: whether it flips the open string, and how deep it leads if it begins outside or inside one."""
    sums: dict[tuple[str, int], list] = {}
    for batch in batches:
        for file, start, piece in zip(*(batch.column(i).to_pylist() for i in range(3))):
            own = sums.setdefault((file, start), [False, True, 0, 0])
            for case in (0, 1):
                own[case], opened = _opened(piece, own[case])
                own[2 + case] += opened - (not own[case])
    columns = zip(*((f, s, own[0], own[2], own[3]) for (f, s), own in sums.items())) if sums else [[]] * 5
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "start", "flips", "outside", "inside"])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records, and the parts of records that lie across ranges: opening ones and those that go on."""
    at, inside, depth, held, whole = None, False, 0, [], True
    rows: list[tuple] = []

    def left() -> None:
        if held:
            rows.append((*at, 1, whole, "".join(held)))
            held.clear()

    def batch_of() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["file", "start", "seq", "opens", "text"])
        rows.clear()
        return out

    for batch in batches:
        for file, start, piece, opens_inside, opens_depth in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if (file, start) != at:
                left()
                at, inside, depth, whole = (file, start), opens_inside, opens_depth, opens_depth == 0
            before = depth
            inside, opened = _opened(piece, inside)
            depth += opened
            if not held and before == 0 and whole:
                if not opened:  # what stands behind the last record
                    depth = 0
                    continue
                piece = piece[piece.index("{") :]
            held.append(piece + "}")
            depth -= not inside
            if depth == 0:
                rows.append((None if whole else file, start, 0, False, "".join(held)))
                held.clear()
                whole = True
            if len(rows) >= 4096:
                yield batch_of()
    left()
    if rows:
        yield batch_of()


def split_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The text of every object of the documents, which are arrays of objects or objects side by side.

    A byte range is ``spark.sql.files.maxPartitionBytes``, so the table of how ranges begin is the input divided by that.
    """
    texts = spark.read.option("lineSep", "}").text(paths if isinstance(paths, str) else list(paths))
    pieces = texts.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("piece"))
    ranges = materialize(pieces.mapInArrow(_ranges, "file string, start long, flips boolean, outside long, inside long"), "json-ranges")
    earlier = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    flips = F.coalesce(F.sum(F.col("flips").cast("long")).over(earlier), F.lit(0)) % 2 == 1
    stated = ranges.withColumn("opens_inside", flips).withColumn("delta", F.when(F.col("opens_inside"), F.col("inside")).otherwise(F.col("outside")))
    depth = F.coalesce(F.sum("delta").over(earlier), F.lit(0))
    begins = materialize(stated.select("file", "start", "opens_inside", depth.alias("opens_depth")), "json-begins")
    # A row for each byte range, some fifty bytes: a broadcast keeps the pieces in their order.
    placed = pieces.join(F.broadcast(begins), ["file", "start"]).select("file", "start", "piece", "opens_inside", "opens_depth")
    found = materialize(placed.mapInArrow(_records, "file string, start long, seq int, opens boolean, text string"), "json-records")
    parts = found.where("file is not null")
    number = F.sum(F.col("opens").cast("long")).over(W.partitionBy("file").orderBy("start", "seq"))
    joined = parts.withColumn("record", number).groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("start", "seq", "text"))).alias("parts"))
    glued = joined.select(F.array_join(F.col("parts.text"), "").alias("text"))
    return found.where("file is null").select("text").unionByName(glued)


def read_rowwise_split(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """As ``read_rowwise``, but a document is read by as many tasks as it has byte ranges. Malformed records raise."""
    fields = ", ".join(f"{name}: {kind}" for name, kind in (f.split() for f in ROW_SCHEMA.split(", ")))
    parsed = F.from_json("text", f"struct<{fields}>", {"mode": "FAILFAST"})
    return canonical_rows(split_records(spark, paths).select(parsed.alias("r")).select("r.*"))
