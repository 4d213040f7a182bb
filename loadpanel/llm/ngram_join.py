"""Jaccard join on word shingles with several global token orders.

In any fixed order of all tokens, two sets that are similar enough share a token
among the first few of each (prefix filter). A candidate pair here has to share
prefix tokens under three orders: rarest first, by hash, and by hash backwards;
only pairs that pass all of them are verified on the whole sets.

What keeps it linear:

* Documents with equal sets are one node from the start.
* A longer prefix by hash has to share several tokens with other nodes. Most
  documents fail that with their own tokens and need no candidates at all.
* Inside a group of nodes with a common prefix token, each node is first held
  against one pivot of the group; only nodes of different components so far are
  then paired. A thousand copies of a text with small edits stay about a thousand
  pairs, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from loadpanel.llm.common import slices
from loadpanel.llm.components import connected_components
from loadpanel.scale import is_small, materialize, row_bound

# Share of a set by which the longer prefix exceeds the plain one, in percent.
LONGER = 5
# Different pivots for the groups of one set of nodes.
PIVOTS = 2

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MUL = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MUL
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _folded(columns: list[np.ndarray], salt: int) -> np.ndarray:
    h = np.full(len(columns[0]), salt, np.uint64)
    for c in columns:
        h = _mixed(h * _MIX + c)
    return h


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z in lower case.

    Words end at ASCII white space. A text with fewer words than ``size`` is one
    shingle, one without words has none.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = parts.flatten()
    bounds = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    coded = flat.dictionary_encode()
    words = coded.dictionary.to_pylist()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    full = np.array([w != "" for w in words], bool)[codes] if len(codes) else np.zeros(0, bool)
    ends = np.concatenate([[0], np.cumsum(full)])[bounds]
    h = hashes[codes[full]] if len(codes) else hashes
    count = max(0, len(h) - size + 1)
    rolled = _folded([h[i : i + count] for i in range(size)], size) if count else np.zeros(0, np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for a, b in zip(ends.tolist(), ends[1:].tolist()):
            if b - a >= size:
                found = rolled[a : b - size + 1]
            elif b > a:
                found = _folded([h[i : i + 1] for i in range(a, b)], b - a)
            else:
                found = np.zeros(0, np.uint64)
            out.append(np.unique(found.view(np.int64)))
    return out


def _overlap(n: int, percent: int) -> int:
    """The least number of tokens that a set of ``n`` shares with any partner."""
    return -(-percent * n // 100)


def longer_prefix(n: int, percent: int) -> tuple[int, int]:
    """Length of the longer prefix of a set of ``n``, and how many of its tokens must occur elsewhere."""
    need = _overlap(n, percent)
    return n - need + max(1, n * LONGER // 100), max(1, need * LONGER // 100)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else [], pa.int64()))


def _print(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def _sets(size: int, percent: int, whole: bool):
    name = "tokens" if whole else "prefix"
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("fp", pa.binary()), ("need", pa.int64()), (name, pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), size)
            bounds = [longer_prefix(len(s), percent) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_print(s) for s in sets], pa.binary()),
                    pa.array([need for _, need in bounds], pa.int64()),
                    _lists(sets if whole else [s[:length] for s, (length, _) in zip(sets, bounds)]),
                ],
                schema=schema,
            )

    return run, f"doc_id long, n long, fp binary, need long, {name} array<long>"


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )


def _small(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if is_small(keys) else keys


def _candidates_possible(nodes: DataFrame) -> DataFrame:
    """Nodes with enough tokens of their longer prefix in other nodes' ones.

    Similar sets share the first few tokens they have in common, and those lie in
    the longer prefixes of both; so whoever shares fewer has no partner.
    """
    short = nodes.select(F.xxhash64("fp").alias("node"), "need", F.explode("prefix").alias("token"))
    shared = short.groupBy("token").agg(F.count(F.lit(1)).alias("held")).filter("held > 1").select("token")
    enough = short.join(shared.hint("merge"), "token").groupBy("node").agg(
        F.count(F.lit(1)).alias("found"), F.min("need").alias("need")
    )
    enough = materialize(enough.filter("found >= need").select("node"), "shingle-alive")
    # Two nodes with one 64-bit name would only stay in together.
    return nodes.withColumn("node", F.xxhash64("fp")).join(_small(enough), "node", "left_semi").select("fp", "min_doc")


def _whole_sets(docs: DataFrame, alive: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, fp, n, tokens) of the nodes that are left, from one document of each."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    keys = materialize(alive.select(named("min_doc").alias("name")).distinct(), "shingle-documents")
    texts = _texts(docs.withColumn("doc_id", F.col("doc_id").cast("long")))
    texts = texts.withColumn("name", named("doc_id")).join(_small(keys), "name", "left_semi").drop("name")
    run, schema = _sets(size, percent, whole=True)
    sets = texts.mapInArrow(run, schema).select("fp", "n", "tokens").dropDuplicates(["fp"])
    known = sets.join(_small(materialize(alive.select("fp"), "shingle-nodes")), "fp", "left_semi")
    # Written once, so the numbers stay as they are.
    return materialize(known.withColumn("id", F.monotonically_increasing_id()), "shingle-sets")


def _prefix_length(n: Column, percent: int) -> Column:
    return (n - F.ceil(n * percent / 100) + 1).cast("int")


def _rare_first(sets: DataFrame, percent: int) -> DataFrame:
    """(token, id, n, pos) of the prefixes with the rarest tokens first; ``pos`` is the token's place.

    A token of one node only is rarest of all and leads to nobody, so it just uses
    up a place of the prefix.
    """
    tokens = sets.select("id", F.explode("tokens").alias("token"))
    held = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    ordered = tokens.join(held.hint("merge"), "token").groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("held", "token"))).alias("common")
    )
    sized = ordered.join(sets.select("id", "n"), "id")
    alone = F.col("n").cast("int") - F.size("common")
    places = _prefix_length(F.col("n"), percent) - alone
    prefix = F.slice("common", F.lit(1), F.greatest(places, F.lit(0)))
    placed = sized.withColumn("alone", alone).select("id", "n", "alone", F.posexplode(prefix["token"]).alias("i", "token"))
    return materialize(placed.select("id", "n", "token", (F.col("alone") + F.col("i")).alias("pos")), "shingle-prefixes")


def _may_reach(a: str, pos_a: str, b: str, pos_b: str, percent: int) -> Column:
    """Whether two sets whose first common token has these places can be similar enough.

    Sizes must fit, and what stands from the token on must suffice for the overlap.
    A similar pair passes at its first common token, so it passes somewhere.
    """
    fits = (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)
    left = F.least(F.col(a) - F.col(pos_a), F.col(b) - F.col(pos_b))
    return fits & (left * (100 + percent) >= (F.col(a) + F.col(b)) * percent)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that share prefix tokens in both hash orders and are similar enough on the whole sets."""
    side = lambda name: sets.select(
        F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("tokens").alias(f"t_{name}")
    )
    both = pairs.select("u", "v").join(side("u").hint("merge"), "u").join(side("v").hint("merge"), "v")
    first = lambda name: F.slice(f"t_{name}", F.lit(1), _prefix_length(F.col(f"n_{name}"), percent))
    last = lambda name: F.slice(
        f"t_{name}", -_prefix_length(F.col(f"n_{name}"), percent), _prefix_length(F.col(f"n_{name}"), percent)
    )
    shared = F.size(F.array_intersect("t_u", "t_v"))
    return (
        both.filter(F.arrays_overlap(first("u"), first("v")) & F.arrays_overlap(last("u"), last("v")))
        .withColumn("shared", shared)
        .filter(F.col("shared") * 100 >= (F.col("n_u") + F.col("n_v") - F.col("shared")) * percent)
        .select("u", "v")
    )


def _pivot_pairs(prefixes: DataFrame, percent: int) -> DataFrame:
    """Each node with the pivot of each of its groups; groups of the same nodes have few different pivots.

    The pivot is the node with the fewest tokens of its own, the one most like the others.
    """
    order = F.xxhash64(F.col("id"), F.pmod(F.col("token"), F.lit(PIVOTS)))
    pivots = prefixes.groupBy("token").agg(
        F.min(F.struct("pos", order.alias("order"), "id", "n")).alias("pivot"), F.count(F.lit(1)).alias("held")
    )
    pivots = pivots.filter("held > 1").select(
        "token", F.col("pivot.id").alias("v"), F.col("pivot.n").alias("n_v"), F.col("pivot.pos").alias("pos_v")
    )
    pairs = prefixes.join(pivots.hint("merge"), "token").filter(F.col("id") != F.col("v"))
    return pairs.filter(_may_reach("n", "pos", "n_v", "pos_v", percent)).select(F.col("id").alias("u"), "v").distinct()


def _rest_pairs(prefixes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """All pairs of nodes with a common prefix token that no component holds together yet."""
    rooted = prefixes.join(_small(roots), prefixes["id"] == roots["node"], "left").select(
        "token", "id", "n", "pos", F.coalesce("root", "id").alias("root")
    )
    mixed = rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = mixed.filter("low < high").select("token")
    rooted = materialize(rooted.join(mixed.hint("merge"), "token", "left_semi"), "shingle-mixed")
    a, b = rooted.alias("a"), rooted.alias("b")
    apart = (F.col("a.id") < F.col("b.id")) & (F.col("a.root") != F.col("b.root"))
    reach = _may_reach("a.n", "a.pos", "b.n", "b.pos", percent)
    pairs = a.join(b, (F.col("a.token") == F.col("b.token")) & apart & reach)
    return pairs.select(F.col("a.id").alias("u"), F.col("b.id").alias("v")).distinct()


def links(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of similar nodes that hold the same components together as all similar pairs do."""
    prefixes = _rare_first(sets, percent)
    first = materialize(verified(_pivot_pairs(prefixes, percent), sets, percent), "shingle-links")
    rest = _rest_pairs(prefixes, materialize(connected_components(first), "shingle-roots"), percent)
    second = materialize(verified(materialize(rest, "shingle-pairs"), sets, percent), "shingle-links")
    return first.unionByName(second)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles and component_id.

    Two documents are linked when 100 times their common shingles of ``size`` words
    is at least ``percent`` times all their shingles; ``component_id`` is the
    smallest doc_id that links reach. Null and empty texts have no shingles and are
    linked with nothing. Rows that repeat a doc_id are judged by their own texts;
    a null doc_id counts only where a component has no other. Other columns are not
    looked at. Without rows, no rows.
    """
    run, schema = _sets(size, percent, whole=False)
    sets = materialize(_texts(docs).mapInArrow(run, schema), "shingle-prints")
    full = sets.filter("n > 0")
    nodes = full.groupBy("fp").agg(
        F.min("doc_id").alias("min_doc"), F.first("need").alias("need"), F.first("prefix").alias("prefix")
    )
    nodes = materialize(nodes, "shingle-nodes")
    alive = materialize(_candidates_possible(nodes), "shingle-candidates")
    joined = nodes.select("fp", "min_doc")
    if row_bound(alive):
        known = _whole_sets(docs, alive, size, percent)
        roots = connected_components(links(known, percent))
        rooted = known.select("fp", "id").join(roots, F.col("id") == F.col("node")).select("fp", "root")
        rooted = materialize(rooted.join(joined, "fp"), "shingle-rooted")
        least = rooted.groupBy("root").agg(F.min("min_doc").alias("least"))
        placed = rooted.join(least.hint("merge"), "root").select("fp", "least")
        joined = joined.join(placed, "fp", "left").select("fp", F.coalesce("least", "min_doc").alias("min_doc"))
    # Copies of one text are many rows of one key: a sort-merge join lets them be split.
    out = sets.select("doc_id", "n", "fp").join(joined.hint("merge"), "fp", "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("min_doc")).alias("component_id"),
    )


def one_row_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents whose component has a smaller doc_id; rows of one doc_id share its fate."""
    kept = near_duplicates(docs, size, percent).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = materialize(kept.select(F.col("doc_id").alias("_kept")).distinct(), "shingle-kept")
    return docs.join(_small(kept), docs["doc_id"].cast("long").eqNullSafe(F.col("_kept")), "left_semi")
