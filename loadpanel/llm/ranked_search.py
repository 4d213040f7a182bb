"""Ranked search of texts by presence masks.

One pass over the texts counts the terms that the questions ask for. Documents are then
scored in blocks. For a question, the bitmaps of its terms say which documents of a block have
which terms; documents with the same terms have the same mask. The most that a mask can
score follows from the largest impact of each term in the block, so masks are taken by
falling bound until the bound is below the worst of the best found so far.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from loadpanel.llm.common import slices, text_bytes
from loadpanel.llm.terms import LETTERS_AND_DIGITS
from loadpanel.scale import materialize

# Bytes of question terms that are sent to the tasks at once; more are taken in rounds, each a pass over the texts.
ROUND_BYTES = 8 << 20
# Documents and counts of terms in a block.
BLOCK_DOCS, BLOCK_COUNTS = 32_768, 2_000_000
# Documents that are scored at first; each further step takes four times as many.
FIRST_SCORED = 256
# Parts of a thousand by which long documents count less, and how soon repeats of a term stop to count.
LENGTH, SATURATION, SCALE = 25, 12, 1_000_000_000


def _tokens(text: bytes) -> list[bytes]:
    return text.translate(LETTERS_AND_DIGITS).split()


def _question_terms(items: DataFrame) -> DataFrame:
    """item (a number of the row), item_id, its distinct terms and how often it has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [Counter(_tokens(t)) for t in batch.column(2).to_pylist()]
            terms = pa.array([list(c) for c in counts], pa.list_(pa.binary()))
            times = pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), terms, times], ["item", "item_id", "terms", "times"])

    numbered = items.select(F.monotonically_increasing_id().alias("item"), "item_id", text_bytes().alias("bytes"))
    kind = dict(items.dtypes)["item_id"]
    return numbered.mapInArrow(run, f"item long, item_id {kind}, terms array<binary>, times array<long>")


def _counts(docs: DataFrame, ids: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms), ids and tfs (asked terms and their counts) of every document with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes", 4 << 20):
            rows, sizes, ends, found, times = [], [], [0], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                tokens = _tokens(text)
                if not tokens:
                    continue
                counts = Counter(tokens)
                asked = counts.keys() & ids.keys()
                found += [ids[t] for t in asked]
                times += [counts[t] for t in asked]
                rows.append(row)
                sizes.append(len(tokens))
                ends.append(len(found))
            at = pa.array(ends, pa.int32())
            columns = [
                batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(at, pa.array(found, pa.int32())),
                pa.ListArray.from_arrays(at, pa.array(times, pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "ids", "tfs"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("bytes"))
    return read.mapInArrow(run, "doc_id long, n long, ids array<int>, tfs array<long>")


def _document_frequency(counted: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that have each asked term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["id", "df"])

    found = counted.select("ids").mapInArrow(run, "id int, df long").groupBy("id").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(n_terms, np.int64)
    df[found.column("id").to_numpy()] = found.column("df").to_numpy()
    return df


def weight(n_docs: int, df: int) -> int:
    """What a term counts for, by the documents that have it."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class _Best:
    """The best documents of one question so far: by score, then by id, null ids last."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def bar(self) -> int:
        """A document below this score is not among the best."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        good = score >= self.bar()
        if not good.any():
            return
        score, doc, null = (np.concatenate(x) for x in ((self.score, score[good]), (self.doc, doc[good]), (self.null, null[good])))
        order = np.lexsort((doc, null, -score))[: self.k]
        self.score, self.doc, self.null = score[order], doc[order], null[order]


class _Block:
    """Some documents with the impacts and bitmaps of the asked terms."""

    def __init__(self, doc, null, n, lengths, ids, tfs, n_docs: int, n_all: int, n_terms: int) -> None:
        self.doc, self.null, self.n_rows = doc, null, len(doc)
        if int(n.max()) <= (2**62) // (LENGTH * max(n_docs, 1)):
            m = 100 - LENGTH + (LENGTH * n * n_docs) // n_all
        else:  # beyond 64 bits
            m = np.array([100 - LENGTH + (LENGTH * x * n_docs) // n_all for x in n.tolist()], np.int64)
        rows = np.repeat(np.arange(self.n_rows), lengths)
        impact = (SCALE * tfs) // (1000 * tfs + SATURATION * m[rows])
        order = np.argsort(ids, kind="stable")
        self.rows, self.impact = rows[order], impact[order]
        sizes = np.bincount(ids, minlength=n_terms)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.most = np.zeros(n_terms, np.int64)
        there = np.flatnonzero(sizes)
        if len(there):
            self.most[there] = np.maximum.reduceat(self.impact, self.starts[there])
        self._bitmaps: dict[int, np.ndarray] = {}

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.starts[term], self.starts[term + 1])
        return self.rows[own], self.impact[own]

    def bitmap(self, term: int) -> np.ndarray:
        """A bit for every document of the block."""
        if term not in self._bitmaps:
            has = np.zeros(self.n_rows, bool)
            has[self.postings(term)[0]] = True
            self._bitmaps[term] = np.packbits(has)
        return self._bitmaps[term]

    def search(self, terms: np.ndarray, weights: np.ndarray, best: _Best) -> int:
        """Adds the documents that belong to the best; the number of documents it had to score."""
        here = self.most[terms] * weights > 0
        terms, weights = terms[here], weights[here]
        if not len(terms):
            return 0
        maps = np.stack([self.bitmap(t) for t in terms.tolist()])
        rows = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(maps, axis=0), count=self.n_rows))
        bits = np.unpackbits(maps, axis=1, count=self.n_rows)[:, rows]
        # The mask of a document: the bits of its terms in whole 64-bit words.
        words = np.zeros((len(rows), 8 * -(-len(terms) // 64)), np.uint8)
        packed = np.packbits(bits, axis=0).T
        words[:, : packed.shape[1]] = packed
        words = words.view(np.uint64)
        key = words[:, 0] if words.shape[1] == 1 else np.ascontiguousarray(words).view([("", np.uint64)] * words.shape[1])[:, 0]
        _, first, mask = np.unique(key, return_index=True, return_inverse=True)
        bound = (weights * self.most[terms]) @ bits[:, first].astype(np.int64)
        order = np.argsort(-bound[mask], kind="stable")
        bound = bound[mask][order]
        done, step = 0, FIRST_SCORED
        while done < len(order):
            # Masks whose bound equals the bar still go on: a smaller id may win.
            until = min(done + step, int(np.searchsorted(-bound, -best.bar(), "right")))
            if until <= done:
                break
            chosen = order[done:until]
            score = np.zeros(len(chosen), np.int64)
            for i, term in enumerate(terms.tolist()):
                has = np.flatnonzero(bits[i, chosen])
                if len(has):
                    of, impact = self.postings(term)
                    score[has] += weights[i] * impact[np.searchsorted(of, rows[chosen[has]])]
            at = rows[chosen]
            best.add(score, self.doc[at], self.null[at])
            done, step = until, 4 * step
        return done


def _scored(counted: DataFrame, questions: list[tuple[int, np.ndarray, np.ndarray]], k: int, n_docs: int, n_all: int, n_terms: int) -> DataFrame:
    """item, doc_id and score of the best documents of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k) for _ in questions]
        held: list[pa.RecordBatch] = []

        def search() -> None:
            if not held:
                return
            whole = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            doc = whole.column("doc_id").combine_chunks()
            ids, tfs = (pc.list_flatten(whole.column(c)).to_numpy().astype(np.int64) for c in ("ids", "tfs"))
            lengths = pc.list_value_length(whole.column("ids")).to_numpy().astype(np.int64)
            null = doc.is_null().to_numpy(zero_copy_only=False)
            block = _Block(doc.fill_null(0).to_numpy(), null, whole.column("n").to_numpy(), lengths, ids, tfs, n_docs, n_all, n_terms)
            for (_, terms, weights), own in zip(questions, best):
                block.search(terms, weights, own)

        for batch in batches:
            at = 0
            while at < batch.num_rows:  # an Arrow batch may have many large rows
                part = batch.slice(at, 1024)
                held.append(part)
                at += part.num_rows
                if sum(b.num_rows for b in held) >= BLOCK_DOCS or sum(len(b.column(2).flatten()) for b in held) >= BLOCK_COUNTS:
                    search()
        search()
        for (item, _, _), own in zip(questions, best):
            if len(own.score):
                columns = [pa.array([item] * len(own.score), pa.int64()), pa.array(own.doc, pa.int64(), mask=own.null), pa.array(own.score)]
                yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return counted.mapInArrow(run, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` documents that score highest for every row of ``items``.

    Null and empty texts have no terms: such documents are never found and such items find nothing. Every row of
    either table stands for itself, so a repeated item finds its documents again and repeated documents take ranks of
    their own. Equal scores go by smaller doc_id, null ids last. An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    asked = materialize(_question_terms(items), "question-terms")
    size = asked.agg(F.sum(F.expr("aggregate(terms, 0L, (a, t) -> a + length(t) + 40)"))).first()[0] or 0
    rounds = -(-size // ROUND_BYTES)
    kind = dict(items.dtypes)["item_id"]
    found = spark.createDataFrame([], "item long, doc_id long, score long")
    for part in range(rounds):
        rows = asked.filter(F.pmod(F.xxhash64("item"), F.lit(rounds)) == part).select("item", "terms", "times").collect()
        ids: dict[bytes, int] = {}
        for r in rows:
            for t in r["terms"]:
                ids.setdefault(bytes(t), len(ids))
        if not ids:
            continue
        counted = materialize(_counts(docs, ids), "term-counts")
        n_docs, n_all = counted.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        weights = np.array([weight(n_docs, df) for df in _document_frequency(counted, len(ids)).tolist()], np.int64)
        questions = []
        for r in rows:
            terms = np.array([ids[bytes(t)] for t in r["terms"]], np.int64)
            questions.append((r["item"], terms, weights[terms] * np.array(r["times"], np.int64)))
        found = found.unionByName(_scored(counted, questions, k, n_docs, n_all, len(ids)))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score")
