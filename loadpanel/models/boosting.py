"""Boosted regression trees over binned inputs, for many fits at once.

Every input is cut once into at most 255 bins. A tree needs nothing of a node but the sum of
gradients and the number of rows per input and bin; the gradients are whole numbers, so these
sums do not depend on the order or place of the rows. A round asks for the sums of the smaller
child of every leaf that may be split next, for all fits in one pass; the other child is the
parent less that one. A tree is grown best first: the leaf of most gain is split until there
are enough leaves.

Sums come from Spark jobs over a stored table. A fit whose rows fit one task (``TASK_ROWS``)
is carried on there, tree after tree, by the same rules and with the same result.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loadpanel.functions.quantiles import exact_quantiles
from loadpanel.scale import materialize

MAX_BINS = 255
# Gradients are rounded to this part of the target.
SCALE = 1 << 26
# A fit of so many rows, about, is carried on in one task.
TASK_ROWS = 500_000
# Trees after which the predictions so far are stored anew.
STORED_TREES = 8


@dataclass(frozen=True)
class Settings:
    n_trees: int
    learning_rate: float
    min_rows: int
    leaves: int
    depth: int | None = None
    # None: squared error; else the pinball loss of this quantile.
    quantile: float | None = None


class Layout:
    """Bins of all inputs side by side: where each input begins in a row of sums."""

    def __init__(self, sizes: Sequence[int]) -> None:
        self.sizes = np.asarray(sizes, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.n = int(self.starts[-1])
        self.input = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def flat(self, bins: np.ndarray) -> np.ndarray:
        """Places of a row's bins, one column per input."""
        return bins.astype(np.int64) + self.starts[:-1]

    def sums(self, flat: np.ndarray, gradients: np.ndarray, whole: int = 2**53) -> np.ndarray:
        """Sum of gradients and number of rows per bin: whole numbers, exact. As doubles if ``whole``, a bound of them, allows."""
        if whole < 2**53:
            at, own = flat.ravel(), np.repeat(gradients.astype(float), flat.shape[1])
            return np.stack([np.bincount(at, own, self.n), np.bincount(at, minlength=self.n)])
        out = np.zeros((2, self.n), np.int64)
        largest = int(np.abs(gradients).max(initial=0)) + 1
        step = max(1, min(len(flat), 2**53 // largest))  # sums below 2**53 are exact in doubles
        for i in range(0, len(flat), step):
            at = flat[i : i + step].ravel()
            own = np.repeat(gradients[i : i + step].astype(float), flat.shape[1])
            out[0] += np.bincount(at, own, self.n).astype(np.int64)
            out[1] += np.bincount(at, minlength=self.n)
        return out


def best_cuts(layout: Layout, sums: np.ndarray, min_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node: gain and place of its best cut, and gradient and rows of the left side.

    ``sums`` is (nodes, 2, bins). A cut after a bin sends it and all lower ones left. The gain is the fall in squared
    error of the gradients; of equal gains the first input, then the lowest bin. No gain is -inf.
    """
    up = np.cumsum(sums, axis=2)
    ends = up[:, :, layout.starts[1:] - 1]
    before = np.concatenate([np.zeros((*sums.shape[:2], 1), sums.dtype), ends[:, :, :-1]], axis=2)
    total = ends[:, :, 0]
    left = up - before.take(layout.input, axis=2)
    g, n = left[:, 0].astype(float, copy=False), left[:, 1].astype(float, copy=False)
    g_all, n_all = total[:, :1].astype(float, copy=False), total[:, 1:].astype(float, copy=False)
    more, m = g_all - g, n_all - n
    least = max(min_rows, 1)  # nothing is to the right of the last bin
    gain = g * g
    gain /= np.maximum(n, 1)
    more *= more
    more /= np.maximum(m, 1)
    gain += more
    gain -= g_all * g_all / n_all
    gain[np.minimum(n, m) < least] = -np.inf
    at = gain.argmax(axis=1)
    rows = np.arange(len(sums))
    return gain[rows, at], at, left[rows, 0, at], left[rows, 1, at]


@dataclass
class Node:
    path: int  # the root is 1, the children of p are 2p and 2p + 1
    depth: int
    gradient: int
    rows: int
    sums: np.ndarray | None = None
    gain: float = -np.inf
    cut: int = -1
    left_gradient: int = 0
    left_rows: int = 0
    children: tuple[int, int] | None = None


@dataclass
class Tree:
    """Nodes of one tree; a leaf has itself as both children."""

    cut: np.ndarray  # place in the layout
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaf_of(self, flat: np.ndarray, layout: Layout) -> np.ndarray:
        return route(self.cut, self.left, self.right, flat, layout)


def route(cut: np.ndarray, left: np.ndarray, right: np.ndarray, flat: np.ndarray, layout: Layout) -> np.ndarray:
    """The leaf in which each row ends."""
    at = np.zeros(len(flat), np.int64)
    going = np.arange(len(flat))
    while len(going):
        node = at[going]
        going = going[left[node] != node]
        node = at[going]
        c = cut[node]
        goes_left = flat[going, layout.input[c]] <= c
        at[going] = np.where(goes_left, left[node], right[node])
    return at


@dataclass
class Growing:
    """One tree of one fit, best first.

    Nodes are known ahead of the splits: a leaf that is among the ``left`` best of the queue, with ``left`` splits to
    go, may be split, all others cannot be. So the sums of a whole round of leaves are asked for at once, and the
    splits are replayed over what is known.
    """

    layout: Layout
    settings: Settings
    nodes: list[Node] = field(default_factory=list)

    def start(self, sums: np.ndarray) -> None:
        first = slice(0, int(self.layout.sizes[0]))
        self.nodes = [Node(1, 0, int(sums[0, first].sum()), int(sums[1, first].sum()), sums)]
        self._judge(self.nodes)

    def _judge(self, nodes: list[Node]) -> None:
        limit = self.settings.depth
        nodes = [n for n in nodes if n.rows >= 2 * self.settings.min_rows and (limit is None or n.depth < limit)]
        if nodes:
            found = best_cuts(self.layout, np.stack([n.sums for n in nodes]), self.settings.min_rows)
            for n, gain, cut, gradient, rows in zip(nodes, *(x.tolist() for x in found)):
                n.gain, n.cut, n.left_gradient, n.left_rows = gain, cut, gradient, rows

    def replay(self) -> tuple[list[int], list[int]]:
        """Nodes split so far, in order, and leaves whose children have to be known before it can go on."""
        heap = [(-self.nodes[0].gain, 1, 0)]
        split: list[int] = []
        while heap and len(split) < self.settings.leaves - 1:
            less, path, i = heapq.heappop(heap)
            if less >= 0:  # the best has no gain
                break
            if self.nodes[i].children is None:
                left = self.settings.leaves - 1 - len(split)
                others = heapq.nsmallest(left - 1, (x for x in heap if x[0] < 0))
                return split, [i, *(k for _, _, k in others if self.nodes[k].children is None)]
            split.append(i)
            for k in self.nodes[i].children:
                heapq.heappush(heap, (-self.nodes[k].gain, self.nodes[k].path, k))
        return split, []

    def expand(self, wanted: list[int]) -> list[tuple[int, int, int]]:
        """Makes the children of the leaves; (leaf, smaller child, other child) of each."""
        out = []
        for i in wanted:
            p, a = self.nodes[i], len(self.nodes)
            self.nodes.append(Node(2 * p.path, p.depth + 1, p.left_gradient, p.left_rows))
            self.nodes.append(Node(2 * p.path + 1, p.depth + 1, p.gradient - p.left_gradient, p.rows - p.left_rows))
            p.children = (a, a + 1)
            out.append((i, a, a + 1) if p.left_rows <= p.rows - p.left_rows else (i, a + 1, a))
        return out

    def give(self, made: list[tuple[int, int, int]], sums: list[np.ndarray]) -> None:
        """Sums of the smaller children; those of the others are what is left of the parents."""
        for (parent, small, other), own in zip(made, sums):
            self.nodes[small].sums = own
            self.nodes[other].sums = self.nodes[parent].sums - own
            self.nodes[parent].sums = None
        self._judge([self.nodes[k] for _, a, b in made for k in (a, b)])

    def routing(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """cut, left and right of all nodes known so far."""
        own = range(len(self.nodes))
        children = [n.children or (i, i) for i, n in zip(own, self.nodes)]
        return np.array([n.cut for n in self.nodes]), np.array([a for a, _ in children]), np.array([b for _, b in children])

    def tree(self) -> tuple[Tree, list[int]]:
        """The tree of the replayed splits, a leaf's value being its mean gradient; also its nodes here."""
        split = set(self.replay()[0])
        order, at = [0], 0
        while at < len(order):
            if order[at] in split:
                order += self.nodes[order[at]].children
            at += 1
        place = {k: i for i, k in enumerate(order)}
        cut, left, right, value = [], [], [], []
        for i, k in enumerate(order):
            n = self.nodes[k]
            a, b = (place[c] for c in n.children) if k in split else (i, i)
            cut.append(n.cut if k in split else 0)
            left.append(a)
            right.append(b)
            value.append(n.gradient / n.rows / SCALE if n.rows else 0.0)
        return Tree(np.array(cut), np.array(left), np.array(right), np.array(value)), order


def gradients(y: np.ndarray, predicted: np.ndarray, quantile: float | None) -> np.ndarray:
    """Direction in which each prediction should go, in whole parts of ``SCALE``."""
    if quantile is None:
        return np.rint((y - predicted) * SCALE).astype(np.int64)
    return np.where(y > predicted, round(quantile * SCALE), round((quantile - 1) * SCALE)).astype(np.int64)


def boost(bins: np.ndarray, y: np.ndarray, sizes: Sequence[int], settings: Settings) -> tuple[float, list[Tree]]:
    """First prediction and trees of one fit whose rows are all here."""
    layout = Layout(sizes)
    flat = layout.flat(bins)
    q = settings.quantile
    first = _first(y, q)
    predicted = np.full(len(y), first)
    trees: list[Tree] = []
    for _ in range(settings.n_trees):
        g = gradients(y, predicted, q)
        rows = {0: np.arange(len(y))}
        growing = Growing(layout, settings)
        # Rows by the largest gradient bound every sum, so a tree has one kind of sums throughout.
        whole = len(y) * (int(np.abs(g).max(initial=0)) + 1)
        growing.start(layout.sums(flat, g, whole))
        while wanted := growing.replay()[1]:
            made, sums = growing.expand(wanted), []
            for parent, small, other in made:
                own, cut = rows[parent], growing.nodes[parent].cut
                goes_left = flat[own, layout.input[cut]] <= cut
                a, b = growing.nodes[parent].children
                rows[a], rows[b] = own[goes_left], own[~goes_left]
                sums.append(layout.sums(flat[rows[small]], g[rows[small]], whole))
            growing.give(made, sums)
        tree, order = growing.tree()
        if len(order) == 1 and q is None:
            break  # nothing more to gain
        leaf = np.zeros(len(y), np.int64)
        for i, k in enumerate(order):
            if tree.left[i] == i:
                leaf[rows[k]] = i
                if q is not None:
                    tree.value[i] = float(np.quantile(y[rows[k]] - predicted[rows[k]], q))
        trees.append(tree)
        predicted = predicted + settings.learning_rate * tree.value[leaf]
    return first, trees


def _first(y: np.ndarray, quantile: float | None) -> float:
    """Mean of the targets by whole numbers, or their quantile."""
    if quantile is not None:
        return float(np.quantile(y, quantile))
    return int(np.rint(y * SCALE).astype(np.int64).sum()) / len(y) / SCALE


def predict(flat: np.ndarray, layout: Layout, first: float, trees: list[Tree], learning_rate: float, start: np.ndarray | None = None) -> np.ndarray:
    out = np.full(len(flat), first) if start is None else start
    for t in trees:
        out = out + learning_rate * t.value[t.leaf_of(flat, layout)]
    return out


Model = dict[int, tuple[float, list[Tree]]]


def fit(rows: DataFrame, sizes: dict[int, Sequence[int]], settings: Settings, n_rows: dict[int, int]) -> Model:
    """(first prediction, trees) of every fit.

    ``rows`` is a stored table (fit int, bins binary, y double), ``sizes`` the bins of each input by fit, ``n_rows`` the
    rows of each fit. Fits within ``TASK_ROWS`` are one task each of one job; the others go on together, a job a round.
    """
    here = [k for k, n in n_rows.items() if n <= TASK_ROWS]
    large = [k for k, n in n_rows.items() if n > TASK_ROWS]
    model: Model = {}
    if here:
        model |= _fit_in_tasks(rows.filter(F.col("fit").isin(here)), sizes, settings, len(here))
    if large:
        model |= _fit_by_rounds(rows.filter(F.col("fit").isin(large)), {k: sizes[k] for k in large}, settings)
    return model


def _fit_in_tasks(rows: DataFrame, sizes: dict[int, Sequence[int]], settings: Settings, n_fits: int) -> Model:
    def one(table: pa.Table) -> pa.Table:
        k = table.column("fit")[0].as_py()
        bins = _unpacked(table.column("bins").combine_chunks(), len(sizes[k]))
        found = boost(bins, table.column("y").to_numpy(), sizes[k], settings)
        return pa.table({"fit": pa.array([k], pa.int32()), "model": pa.array([pickle.dumps(found)], pa.binary())})

    # A number of partitions that is asked for stays: the rows are few, and each fit is a task's work.
    apart = rows.repartitionByRange(max(1, n_fits), "fit")
    found = apart.groupBy("fit").applyInArrow(one, "fit int, model binary").collect()
    return {r["fit"]: pickle.loads(r["model"]) for r in found}


def _unpacked(column: pa.Array, n_inputs: int) -> np.ndarray:
    """Bins of rows, from a column of byte strings of equal length."""
    if not len(column):
        return np.zeros((0, n_inputs), np.uint8)
    data = np.frombuffer(column.buffers()[2], np.uint8)
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return data[at[0] : at[-1]].reshape(len(column), n_inputs)


def _by_fit(batch: pa.RecordBatch, sizes: dict[int, Sequence[int]]) -> Iterator[tuple[int, Layout, np.ndarray, np.ndarray, np.ndarray]]:
    """fit, its layout, the places of its bins, target and prediction, for every fit of the batch."""
    fits = batch.column("fit").to_numpy()
    for k in np.unique(fits).tolist():
        own = np.flatnonzero(fits == k)
        part = batch.take(pa.array(own))
        layout = Layout(sizes[k])
        flat = layout.flat(_unpacked(part.column("bins"), len(sizes[k])))
        yield k, layout, flat, part.column("y").to_numpy(), part.column("p").to_numpy()


def _fit_by_rounds(rows: DataFrame, sizes: dict[int, Sequence[int]], settings: Settings) -> Model:
    q, rate = settings.quantile, settings.learning_rate
    if q is None:
        whole = F.sum(F.rint(F.col("y") * SCALE).cast("long")).cast("double")
        start = rows.groupBy("fit").agg((whole / F.count("*") / SCALE).alias("first"))
    else:
        start = exact_quantiles(rows.select("fit", "y"), ["fit"], "y", {"first": q})
    first = {r["fit"]: r["first"] for r in start.collect()}
    base = F.element_at(F.create_map(*[F.lit(x) for pair in first.items() for x in pair]), F.col("fit"))
    state = materialize(rows.select("fit", "bins", "y", base.alias("p")), "boosting")
    model: Model = {k: (first[k], []) for k in first}
    going, since = set(first), {k: 0 for k in first}  # trees that the stored predictions have
    for t in range(settings.n_trees):
        if t and t % STORED_TREES == 0:
            state = materialize(_moved(state, sizes, {k: m[1][since[k] :] for k, m in model.items()}, rate), "boosting")
            since = {k: len(m[1]) for k, m in model.items()}
        late = {k: model[k][1][since[k] :] for k in going}
        growing = {k: Growing(Layout(sizes[k]), settings) for k in going}
        roots = _sums(state, sizes, late, {k: (None, [0]) for k in going}, settings)
        for k, g in growing.items():
            g.start(roots[k, 0])
        while asked := {k: w for k, g in growing.items() if (w := g.replay()[1])}:
            made = {k: growing[k].expand(w) for k, w in asked.items()}
            wanted = {k: (growing[k].routing(), [small for _, small, _ in m]) for k, m in made.items()}
            sums = _sums(state, sizes, late, wanted, settings)
            for k, m in made.items():
                growing[k].give(m, [sums[k, small] for _, small, _ in m])
        grown = {k: g.tree()[0] for k, g in growing.items()}
        if q is None:
            going = {k for k in going if len(grown[k].cut) > 1}
        else:
            _set_quantiles(state, sizes, late, grown, settings)
        for k in going:
            model[k][1].append(grown[k])
        if not going:
            break
    return model


def _sums(state: DataFrame, sizes: dict, late: dict, wanted: dict, settings: Settings) -> dict[tuple[int, int], np.ndarray]:
    """Sums of the wanted nodes of all fits, by one pass: each task adds up its rows, Spark the tasks."""
    q, rate = settings.quantile, settings.learning_rate

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for k, layout, flat, y, p in _by_fit(batch, sizes):
                if k not in wanted:
                    continue
                routing, nodes = wanted[k]
                g = gradients(y, predict(flat, layout, 0.0, late[k], rate, p), q)
                # The wanted nodes are leaves of what is known of the tree.
                at = route(*routing, flat, layout) if routing else np.zeros(len(flat), np.int64)
                for node in nodes:
                    own = np.flatnonzero(at == node)
                    total[k, node] = total.get((k, node), 0) + layout.sums(flat[own], g[own])
        for (k, node), sums in total.items():
            there = np.flatnonzero(sums[1])
            columns = [np.full(len(there), k, np.int32), np.full(len(there), node, np.int32), there.astype(np.int32), sums[0, there], sums[1, there]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["fit", "node", "bin", "g", "n"])

    found = state.mapInArrow(run, "fit int, node int, bin int, g long, n long").groupBy("fit", "node", "bin").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
    table = found.toArrow()
    out = {(k, node): np.zeros((2, Layout(sizes[k]).n), np.int64) for k, (_, nodes) in wanted.items() for node in nodes}
    fits, nodes, bins, g, n = (table.column(c).to_numpy() for c in ("fit", "node", "bin", "g", "n"))
    for k, node in out:
        own = (fits == k) & (nodes == node)
        out[k, node][0, bins[own]], out[k, node][1, bins[own]] = g[own], n[own]
    return out


def _moved(state: DataFrame, sizes: dict, late: dict, rate: float) -> DataFrame:
    """The table with its predictions carried on by the trees since."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits, out = batch.column("fit").to_numpy(), batch.column("p").to_numpy().copy()
            for k, layout, flat, _, p in _by_fit(batch, sizes):
                out[fits == k] = predict(flat, layout, 0.0, late[k], rate, p)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(out)], ["fit", "bins", "y", "p"])

    return state.mapInArrow(run, "fit int, bins binary, y double, p double")


def _set_quantiles(state: DataFrame, sizes: dict, late: dict, grown: dict[int, Tree], settings: Settings) -> None:
    """Values of leaves: the quantile of their residuals."""
    rate = settings.learning_rate

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, layout, flat, y, p in _by_fit(batch, sizes):
                left = y - predict(flat, layout, 0.0, late[k], rate, p)
                leaf = grown[k].leaf_of(flat, layout)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(y), k, np.int32)), pa.array(leaf.astype(np.int32)), pa.array(left)], ["fit", "leaf", "residual"])

    residuals = materialize(state.mapInArrow(run, "fit int, leaf int, residual double"), "residuals")
    for r in exact_quantiles(residuals, ["fit", "leaf"], "residual", {"value": settings.quantile}).collect():
        grown[r["fit"]].value[r["leaf"]] = r["value"]


def bin_edges(df: DataFrame, columns: Sequence[str], by: str | None = None) -> dict:
    """Cuts between the bins of each column, by group where ``by`` names one: {group: [cuts of each column]}.

    Up to ``MAX_BINS`` distinct values have a bin each, with cuts half way; more are cut at quantiles. Tasks hand on
    their distinct values while these are few. NaN and null count as larger than all values.
    """
    keys = [by] if by else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            groups = batch.column(len(columns)).to_numpy() if by else np.zeros(batch.num_rows, np.int64)
            for g in np.unique(groups).tolist():
                for i in range(len(columns)):
                    v = batch.column(i).to_numpy(zero_copy_only=False)[groups == g].astype(float)
                    known = seen.get((g, i), np.zeros(0))
                    if len(known) <= MAX_BINS:
                        seen[g, i] = np.unique(np.concatenate([known, v[~np.isnan(v)]]))[: MAX_BINS + 1]
        for (g, i), v in seen.items():
            columns_ = [np.full(len(v), g, np.int64), np.full(len(v), i, np.int32), v]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns_], ["g", "i", "v"])

    read = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)], *[F.col(k).cast("long") for k in keys])
    few = read.mapInArrow(run, "g long, i int, v double").distinct()
    values = few.groupBy("g", "i").agg(F.slice(F.sort_array(F.collect_set("v")), 1, MAX_BINS + 1).alias("v"))
    found = {(r["g"], r["i"]): r["v"] for r in values.collect()}
    many = {i for (_, i), v in found.items() if len(v) > MAX_BINS}
    cuts: dict[tuple[int, int], list[float]] = {}
    if many:
        probs = F.array(*[F.lit(j / MAX_BINS) for j in range(1, MAX_BINS)])
        quantiles = [F.percentile_approx(f"c{i}", probs, F.lit(20 * MAX_BINS)).alias(f"c{i}") for i in sorted(many)]
        for r in read.groupBy(*(keys or [F.lit(0).alias("g")])).agg(*quantiles).collect():
            cuts |= {(r[0], i): sorted(set(r[f"c{i}"])) for i in many if r[f"c{i}"] is not None}
    out: dict = {}
    for g in {g for g, _ in found}:
        out[g] = []
        for i in range(len(columns)):
            v = np.array(found.get((g, i), []))
            out[g].append(np.array(cuts[g, i]) if len(v) > MAX_BINS else (v[1:] + v[:-1]) / 2)
    return out


def binned(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Bin of each value: the number of cuts below it."""
    return np.searchsorted(cuts, values, "left").astype(np.uint8)


def packed(bins: np.ndarray) -> list[bytes]:
    """The bins of each row as a byte string."""
    whole, width = bins.tobytes(), bins.shape[1]
    return [whole[i * width : (i + 1) * width] for i in range(len(bins))]
