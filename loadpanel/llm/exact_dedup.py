"""Exact dedup by composable polynomial fingerprints.

A text of n bytes is read as the polynomial sum(b[i] * 256**(n-1-i)) modulo a
127-bit prime. The fingerprint of a concatenation follows from its parts:
H(a + b) = H(a) * 256**len(b) + H(b). So the chunks of a huge document are hashed
by several tasks and combined afterwards, in any grouping that keeps their order.
Texts with equal length and fingerprint are then compared byte by byte, chunk
after chunk, so a collision can never drop a document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loadpanel.llm.common import lower_ascii, slices
from loadpanel.scale import is_small, materialize, row_bound

# A 127-bit prime; not 2**127 - 1, modulo which 256 has few powers.
MODULUS = (1 << 127) - 1048599
BASE = 256
# Bytes hashed at once, and compared at once.
CHUNK = 1 << 16
# Texts beyond this many bytes are hashed chunk by chunk in separate tasks.
HUGE = 1 << 24


def combine(left: tuple[int, int], right: tuple[int, int], modulus: int = MODULUS) -> tuple[int, int]:
    """(length, hash) of a concatenation from those of its two parts."""
    return left[0] + right[0], (left[1] * pow(BASE, right[0], modulus) + right[1]) % modulus


def chunk_hash(data: bytes, modulus: int = MODULUS) -> tuple[int, int]:
    return len(data), int.from_bytes(data, "big") % modulus


def fingerprint(data: bytes, modulus: int = MODULUS, chunk: int = CHUNK) -> tuple[int, int]:
    """(length, hash) of a text, chunk by chunk."""
    parts = (chunk_hash(data[i : i + chunk], modulus) for i in range(0, len(data), chunk))
    return reduce(lambda a, b: combine(a, b, modulus), parts, (0, 0))


def _packed(value: int) -> bytes:
    return value.to_bytes(16, "big")


_ROW = "doc_id long, n_bytes long, fp binary, text_sha256 string"


def _whole(modulus: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("fp", pa.binary()), ("text_sha256", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes"):
            texts = batch.column("bytes").to_pylist()
            prints = [fingerprint(t, modulus) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([n for n, _ in prints], pa.int64()),
                    pa.array([_packed(h) for _, h in prints], pa.binary()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                ],
                schema=schema,
            )

    return run


def _chunks(modulus: int):
    schema = pa.schema(
        [("text_sha256", pa.string()), ("no", pa.int64()), ("n", pa.int64()), ("h", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [fingerprint(t, modulus) for t in batch.column("chunk").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("text_sha256"),
                    batch.column("no"),
                    pa.array([n for n, _ in parts], pa.int64()),
                    pa.array([_packed(h) for _, h in parts], pa.binary()),
                ],
                schema=schema,
            )

    return run


def _joined(modulus: int):
    def run(pdf):
        pdf = pdf.sort_values("no")
        parts = ((n, int.from_bytes(h, "big")) for n, h in zip(pdf["n"], pdf["h"]))
        n, h = reduce(lambda a, b: combine(a, b, modulus), parts, (0, 0))
        return pdf.iloc[:1][["text_sha256"]].assign(n_bytes=n, fp=_packed(h))

    return run


def _cut(size: int):
    """The bytes as an array of (number, chunk); one empty chunk for no bytes."""
    last = F.floor((F.greatest(F.length("bytes"), F.lit(1)) - 1) / size)
    return F.transform(
        F.sequence(F.lit(0).cast("long"), last),
        lambda i: F.struct(i.alias("no"), F.substring(F.col("bytes"), (i * size + 1).cast("int"), size).alias("chunk")),
    )


def _normalised(docs: DataFrame) -> DataFrame:
    text = lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("bytes"))


def fingerprints(docs: DataFrame, modulus: int = MODULUS, huge: int = HUGE, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, fp, text_sha256 of every row, the text with A-Z in lower case.

    Rows beyond ``huge`` bytes are cut into blocks of 64 chunks, which other tasks
    hash; a document's block hashes are then combined.
    """
    texts = _normalised(docs)
    size = F.length("bytes")
    small = texts.filter(size <= huge).mapInArrow(_whole(modulus), _ROW)
    large = texts.filter(size > huge).withColumn("text_sha256", F.sha2("bytes", 256))
    blocks = (
        large.dropDuplicates(["text_sha256"])
        .select("text_sha256", F.explode(_cut(64 * chunk)).alias("part"))
        .select("text_sha256", "part.no", "part.chunk")
        .repartition("text_sha256", "no")
        .mapInArrow(_chunks(modulus), "text_sha256 string, no long, n long, h binary")
    )
    whole = blocks.groupBy("text_sha256").applyInPandas(
        _joined(modulus), "text_sha256 string, n_bytes long, fp binary"
    )
    huge_rows = large.select("doc_id", "text_sha256").join(whole, "text_sha256")
    return small.unionByName(huge_rows.select("doc_id", "n_bytes", "fp", "text_sha256"))


def _same_as_model(texts: DataFrame, chunk: int) -> DataFrame:
    """Whether each row's text is that of its class's model, by comparing chunks."""
    row = ["doc_key", "text_sha256", "class"]
    parts = texts.select(*row, "is_model", F.explode(_cut(chunk)).alias("part")).select(
        *row, "is_model", "part.no", "part.chunk"
    )
    model = parts.filter("is_model").groupBy("class", "no").agg(F.first("chunk").alias("model"))
    return (
        parts.join(model, ["class", "no"], "left")
        .groupBy(*row)
        .agg(F.min(F.coalesce(F.col("chunk") == F.col("model"), F.lit(False))).alias("same"))
    )


def _doc_key():
    """The id, with a value that no id takes for a null one."""
    return F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))


def exact_duplicates(
    docs: DataFrame, modulus: int = MODULUS, huge: int = HUGE, chunk: int = CHUNK
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text counts as
    empty. Of equal texts the row with the largest doc_id stays. A null doc_id
    comes before all others; if a class has no other, its ``keep_id`` is null and
    its rows stay. Rows that repeat a doc_id with the same text are all marked as
    kept if that id is; ``one_row_each`` leaves one of them. Without rows, no rows.
    """
    prints = materialize(
        fingerprints(docs, modulus, huge, chunk).withColumn("doc_key", _doc_key()), "fingerprints"
    )
    key = ["n_bytes", "fp"]
    groups = prints.groupBy(*key).agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.struct("text_sha256", "doc_key")).alias("model")
    )
    groups = groups.filter("rows > 1").select(*key, "model", F.struct(*key).alias("class"))
    suspects = materialize(
        prints.join(groups, key).select(
            "doc_key",
            "text_sha256",
            "class",
            (F.struct("text_sha256", "doc_key") == F.col("model")).alias("is_model"),
        ).distinct(),
        "equal-fingerprints",
    )
    if row_bound(suspects):
        texts = _normalised(docs).withColumn("doc_key", _doc_key())
        listed = F.broadcast(suspects) if is_small(suspects) else suspects
        # An id may repeat with another text, so the digest is part of the row's name.
        texts = texts.join(listed, "doc_key").filter(F.sha2("bytes", 256) == F.col("text_sha256"))
        # What differs from the model although the fingerprints agree is a class by its own digest.
        split = F.when(F.col("same"), F.lit("")).otherwise(F.col("text_sha256"))
        verdicts = _same_as_model(texts, chunk).select("doc_key", "text_sha256", split.alias("split"))
        prints = prints.join(verdicts, ["doc_key", "text_sha256"], "left")
    else:
        prints = prints.withColumn("split", F.lit(""))
    prints = prints.withColumn("split", F.coalesce("split", F.lit("")))
    key = [*key, "split"]
    sizes = prints.groupBy(*key).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return prints.join(sizes, key).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        "text_sha256",
    )


def one_row_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row for each text: the row with the largest doc_id."""
    kept = exact_duplicates(docs).filter("kept").select(
        F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha")
    )
    text = lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit("")))
    named = docs.select(
        F.struct("*").alias("_row"),
        F.col("doc_id").cast("long").alias("_kept_id"),
        F.sha2(text.cast("binary"), 256).alias("_kept_sha"),
    )
    kept = kept.distinct()
    same = named["_kept_id"].eqNullSafe(kept["_kept_id"]) & (named["_kept_sha"] == kept["_kept_sha"])
    return named.join(kept, same, "left_semi").dropDuplicates(["_kept_id", "_kept_sha"]).select("_row.*")
