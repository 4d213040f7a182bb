"""How far the sources of a language differ in their use of terms.

The terms that enough documents of a language have are found exactly. They are dealt by a
checksum into shards, and a task makes a minimal perfect hash of each: a slot for every term
and no slot empty. A second pass over the texts has the hashes broadcast and counts into one
dense array of slots per (language, source). A term that is not in a shard gets a slot too,
so the term stored there is compared before it counts.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from loadpanel.llm.common import slices, text_bytes
from loadpanel.llm.terms import LETTERS
from loadpanel.scale import lookup_join, materialize

# Terms in a shard, about.
SHARD_TERMS = 16_384
# Keys of a displacement, about: fewer make larger hashes that are quicker to find.
BUCKET = 3
# Bytes of hashes that are broadcast at once; more are taken in rounds, each a pass over the texts.
BROADCAST_BYTES = 64 << 20
# Terms that a task holds before it hands on or looks up what it has counted, and dense slots that it holds.
HELD_TERMS, HELD_SLOTS = 400_000, 8_000_000
# Counts of a block of slots by all sources of its language.
BLOCK_COUNTS = 32_768
# Parts in p, and what is added to every count.
PARTS, ADDED = 1_000_000_000, 5

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _spread(x: np.ndarray) -> np.ndarray:
    """Mixes 64-bit numbers (the finaliser of a common hash)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _slots(hashes: np.ndarray, displacement: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """Slot of each hash under the displacement of its bucket; a negative one names the slot itself."""
    moved = _spread(hashes + displacement.astype(np.uint64) * _MIX) % np.asarray(n, np.uint64)
    return np.where(displacement < 0, -displacement - 1, moved.astype(np.int64))


def _hashed(terms: list[bytes], seed: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(t, seed) for t in terms), np.uint64, len(terms))


def perfect_hash(terms: list[bytes]) -> tuple[int, np.ndarray, np.ndarray]:
    """(seed, displacement of each bucket, slot of each term): every slot from 0 to n - 1 has one term.

    Buckets are placed by falling size, each by the first displacement that sends all its terms to free
    slots; the terms of buckets of one take the slots that are left.
    """
    n = len(terms)
    n_buckets = n // BUCKET + 1
    seed = 0
    while True:
        hashes = _hashed(terms, seed)
        if len(np.unique(hashes)) == n:
            break
        seed += 1
    bucket = (_spread(hashes ^ _MIX) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=n_buckets)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    displacement = np.zeros(n_buckets, np.int64)
    slot = np.empty(n, np.int64)
    free = np.ones(n, bool)
    several = np.flatnonzero(sizes > 1)
    for b in several[np.argsort(-sizes[several], kind="stable")]:
        own = order[starts[b] : starts[b + 1]]
        first, width = 0, 64
        while True:
            tries = np.arange(first, first + width, dtype=np.int64)
            at = _slots(hashes[own][None, :], np.repeat(tries[:, None], len(own), 1), n)
            apart = np.sort(at, axis=1)
            good = free[at].all(axis=1) & (apart[:, 1:] != apart[:, :-1]).all(axis=1)
            if good.any():
                k = int(np.argmax(good))
                displacement[b], slot[own], free[at[k]] = tries[k], at[k], False
                break
            first, width = first + width, min(2 * width, 4096)
    alone = np.flatnonzero(sizes == 1)
    left = np.flatnonzero(free)
    displacement[alone] = -left - 1
    slot[order[starts[alone]]] = left
    return seed, displacement, slot


class _Shards:
    """The hashes of some shards of one language: slots of terms, counted through all its shards here."""

    def __init__(self, n_shards: int, found: list[dict]) -> None:
        self.n_shards = n_shards
        self.base = np.full(n_shards, -1, np.int64)  # first slot of a shard in dense arrays
        self.size = np.ones(n_shards, np.int64)
        self.seed = np.zeros(n_shards, np.int64)
        self.first = np.zeros(n_shards, np.int64)  # first bucket
        self.n_buckets = np.ones(n_shards, np.int64)
        at = bucket = 0
        for s in found:
            k, n, m = s["shard"], len(s["terms"]), len(s["displacement"])
            self.base[k], self.size[k], self.seed[k], self.first[k], self.n_buckets[k] = at, n, s["seed"], bucket, m
            at, bucket = at + n, bucket + m
        self.n_slots = at
        self.displacement = np.concatenate([[0], *[np.asarray(s["displacement"], np.int64) for s in found]])[1:]
        self.terms = pa.chunked_array([pa.array(s["terms"], pa.binary()) for s in found], pa.binary()).combine_chunks()
        self.shards = np.array([s["shard"] for s in found], np.int64)

    def add(self, counts: Counter, dense: np.ndarray) -> None:
        """Adds the counts of the terms that are stored here to their slots."""
        terms = list(counts)
        shard = np.fromiter((zlib.crc32(t) for t in terms), np.int64, len(terms)) % self.n_shards
        here = np.flatnonzero(self.base[shard] >= 0)
        if not len(here):
            return
        shard = shard[here]
        hashes = np.fromiter(
            (xxhash.xxh3_64_intdigest(terms[i], seed) for i, seed in zip(here.tolist(), self.seed[shard].tolist())), np.uint64, len(here)
        )
        bucket = (_spread(hashes ^ _MIX) % self.n_buckets[shard].astype(np.uint64)).astype(np.int64)
        slot = self.base[shard] + _slots(hashes, self.displacement[self.first[shard] + bucket], self.size[shard])
        asked = pa.array([terms[i] for i in here.tolist()], pa.binary())
        same = pc.equal(self.terms.take(pa.array(slot)), asked).to_numpy(zero_copy_only=False)
        n = np.fromiter(counts.values(), np.int64, len(counts))[here]
        dense[slot[same]] += n[same]  # a slot has one term, and a term one count


def _read(docs: DataFrame) -> DataFrame:
    def named(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    return docs.select(named("lang").alias("lang"), named("source").alias("source"), text_bytes().alias("bytes"))


def _tokens(text: bytes) -> list[bytes]:
    return text.translate(LETTERS).split()


def document_frequency(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, n) of the terms that at least ``min_docs`` documents of the language have; terms as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def handed() -> Iterator[pa.RecordBatch]:
            for lang, counts in seen.items():
                columns = [pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "n"])
            seen.clear()

        for batch in slices(batches, "bytes", 4 << 20):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.setdefault(lang, Counter()).update(set(_tokens(text)))
            if sum(map(len, seen.values())) > HELD_TERMS:
                yield from handed()
        yield from handed()

    partial = _read(docs).select("lang", "bytes").mapInArrow(run, "lang string, term binary, n long")
    return partial.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs)


def _build(shard: pa.Table) -> pa.Table:
    terms = shard.column("term").to_pylist()
    seed, displacement, slot = perfect_hash(terms)
    stored = [b""] * len(terms)
    for t, at in zip(terms, slot.tolist()):
        stored[at] = t
    return pa.table(
        {
            "lang": shard.column("lang").slice(0, 1),
            "n_shards": shard.column("n_shards").slice(0, 1),
            "shard": shard.column("shard").slice(0, 1),
            "seed": pa.array([seed], pa.int64()),
            "displacement": pa.array([displacement.tolist()], pa.list_(pa.int64())),
            "terms": pa.array([stored], pa.list_(pa.binary())),
        }
    )


def build_shards(kept: DataFrame) -> DataFrame:
    """A minimal perfect hash for every shard of the kept terms (lang, term), with its terms in slot order."""
    per_lang = kept.groupBy("lang").agg(F.ceil(F.count("*") / SHARD_TERMS).cast("int").alias("n_shards"))
    dealt = lookup_join(kept.select("lang", "term"), materialize(per_lang, "shard-counts"), ["lang"], spread="term")
    return (
        dealt.withColumn("shard", (F.crc32("term") % F.col("n_shards")).cast("int"))
        .groupBy("lang", "shard")
        .applyInArrow(_build, "lang string, n_shards int, shard int, seed long, displacement array<long>, terms array<binary>")
    )


def count_slots(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """(lang, source, shard, slot, n) of every slot whose term a group of documents has, from stored ``shards``.

    The hashes are broadcast, at most about ``BROADCAST_BYTES`` at once.
    """
    weight = F.expr("aggregate(terms, 0L, (a, t) -> a + length(t) + 8)") + 8 * F.size("displacement")
    size = shards.agg(F.sum(weight)).first()[0] or 0
    rounds = -(-size // BROADCAST_BYTES)
    spark = docs.sparkSession
    read = _read(docs)
    schema = "lang string, source string, shard int, slot int, n long"
    parts = []
    for k in range(rounds):
        dealt = F.pmod(F.xxhash64("lang", "shard"), F.lit(rounds)) == k
        by_lang: dict[str, list[dict]] = {}
        for s in shards.filter(dealt).toArrow().to_pylist():
            by_lang.setdefault(s["lang"], []).append(s)
        held = spark.sparkContext.broadcast(by_lang)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            shards_of = {lang: _Shards(found[0]["n_shards"], found) for lang, found in held.value.items()}
            counts: dict[tuple[str, str], Counter] = {}
            dense: dict[tuple[str, str], np.ndarray] = {}

            def looked_up() -> None:
                for group, found in counts.items():
                    if group not in dense:
                        dense[group] = np.zeros(shards_of[group[0]].n_slots, np.int64)
                    shards_of[group[0]].add(found, dense[group])
                counts.clear()

            def handed() -> Iterator[pa.RecordBatch]:
                for (lang, source), n in dense.items():
                    own = shards_of[lang]
                    at = np.flatnonzero(n)
                    if not len(at):
                        continue
                    which = np.searchsorted(own.base[own.shards], at, "right") - 1
                    shard = own.shards[which]
                    columns = [
                        pa.array([lang] * len(at), pa.string()),
                        pa.array([source] * len(at), pa.string()),
                        pa.array(shard, pa.int32()),
                        pa.array(at - own.base[shard], pa.int32()),
                        pa.array(n[at]),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "shard", "slot", "n"])
                dense.clear()

            for batch in slices(batches, "bytes", 4 << 20):
                for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    if lang in shards_of:
                        counts.setdefault((lang, source), Counter()).update(_tokens(text))
                if sum(map(len, counts.values())) > HELD_TERMS:
                    looked_up()
                    if sum(map(len, dense.values())) > HELD_SLOTS:
                        yield from handed()
            looked_up()
            yield from handed()

        part = read.mapInArrow(run, schema).groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n"))
        parts.append(materialize(part, "slot-counts"))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _parts(counts: np.ndarray, total: np.ndarray | int, n_terms: int) -> np.ndarray:
    """1 + floor(PARTS * (count + ADDED) / (total + ADDED * n_terms)), exactly, for totals up to 2.8e14."""
    by = np.asarray(total + ADDED * n_terms, np.int64)
    step = 31_250
    whole, rest = np.divmod((counts + ADDED) * step, by)
    return 1 + whole * (PARTS // step) + rest * (PARTS // step) // by


def _compare(top: int):
    """Per block of slots: sums of differences for every pair of sources, the largest excesses for each source."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        lang = block["lang"].iloc[0]
        groups = block[block["kind"] == 0].sort_values("source")
        names = groups["source"].to_numpy(object)
        words = block[block["kind"] == 1].sort_values("slot")
        terms = words["term"].to_numpy(object)
        n_terms = int(groups["n_terms"].iloc[0])
        rows: list[tuple] = []
        if n_terms:
            cells = block[block["kind"] == 2]
            counts = np.zeros((len(names), len(terms)), np.int64)
            who = {name: i for i, name in enumerate(names)}
            at = np.searchsorted(words["slot"].to_numpy(np.int64), cells["slot"].to_numpy(np.int64))
            counts[cells["source"].map(who).to_numpy(np.int64), at] = cells["n"].to_numpy(np.int64)
            total = groups["n"].to_numpy(np.int64)
            p = _parts(counts, total[:, None], n_terms)
            q = _parts(counts.sum(axis=0), int(groups["n_lang"].iloc[0]), n_terms)
        else:
            counts = p = q = np.zeros((len(names), 0), np.int64)
        for i, name in enumerate(names):
            apart = np.abs(p[i + 1 :] - p[i]).sum(axis=1)
            for other, value in zip(names[i + 1 :], apart.tolist()):
                rows += [(name, "pair", other, value), (other, "pair", name, value)]
            if n_terms:
                more = np.flatnonzero((counts[i] > 0) & (p[i] > q))
                excess = p[i][more] - q[more]
                if len(more) > top:
                    least = np.partition(excess, len(excess) - top)[len(excess) - top]
                    more, excess = more[excess >= least], excess[excess >= least]
                best = sorted(zip((-excess).tolist(), (terms[j] for j in more)))[:top]
                rows += [(name, "term", term.decode(), -less) for less, term in best]
        out = pd.DataFrame(rows, columns=["source", "part", "item", "value"])
        out.insert(0, "lang", lang)
        return out

    return run


def audit(docs: DataFrame, min_docs: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part, item, value and rank: which sources of a language differ, and by which terms.

    Part ``pair`` has every other source of the language by the summed difference of all kept terms, part ``term``
    the ``top`` terms that the source uses more than its language. Null texts, languages and sources are read as
    empty ones. A group without terms has counts of zero; a language without kept terms gives pairs of value 0 and no
    terms; a source alone in its language has no pairs. Rows count by themselves, whatever their ids, so repeated
    rows count again; an empty table gives no rows; equal values rank by item in the order of UTF-8.
    """
    kept = materialize(document_frequency(docs, min_docs), "kept-terms")
    shards = materialize(build_shards(kept), "perfect-hashes")
    counts = count_slots(docs, shards)

    groups = _read(docs).select("lang", "source").distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = groups.join(totals, ["lang", "source"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    groups = materialize(groups, "groups")
    terms = shards.groupBy("lang").agg(F.sum(F.size("terms")).alias("n_terms"))
    by_lang = groups.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.count("*").alias("n_sources"))
    by_lang = by_lang.join(terms, "lang", "left").withColumn("n_terms", F.coalesce("n_terms", F.lit(0)))
    width = F.greatest(F.lit(64), F.expr(f"{BLOCK_COUNTS} div n_sources"))
    by_lang = materialize(by_lang.withColumn("width", F.least(width, F.lit(SHARD_TERMS)).cast("int")), "languages")

    # Blocks of slots, each with all its terms, all counts of them and all sources of the language.
    words = shards.select("lang", "shard", F.posexplode("terms").alias("slot", "term"))
    words = lookup_join(words, by_lang, ["lang"], spread="slot").withColumn("block", F.expr("slot div width"))
    cells = lookup_join(counts, by_lang, ["lang"], spread="slot").withColumn("block", F.expr("slot div width"))
    sizes = shards.select("lang", "shard", F.size("terms").alias("size"))
    blocks = lookup_join(sizes, by_lang.filter("n_terms > 0"), ["lang"], spread="shard").select(
        "lang", "shard", F.explode(F.expr("sequence(0L, (size - 1) div width)")).alias("block"), "n_lang", "n_terms"
    )
    none = by_lang.filter("n_terms = 0").select("lang", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("block"), "n_lang", "n_terms")
    spread = blocks.unionByName(none).join(groups, "lang")
    empty = {k: F.lit(None).cast(t) for k, t in (("source", "string"), ("slot", "int"), ("term", "binary"), ("n", "long"), ("n_lang", "long"), ("n_terms", "long"))}
    columns = ["lang", "shard", "block", "kind", *empty]

    def shaped(df: DataFrame, kind: int) -> DataFrame:
        missing = {k: v for k, v in empty.items() if k not in df.columns}
        return df.withColumn("kind", F.lit(kind)).withColumns(missing).select(*columns)

    rows = shaped(spread, 0).unionByName(shaped(words.drop("n_lang", "n_terms"), 1)).unionByName(shaped(cells.drop("n_lang", "n_terms"), 2))
    compared = rows.groupBy("lang", "shard", "block").applyInPandas(_compare(top), "lang string, source string, part string, item string, value long")
    found = compared.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top))
