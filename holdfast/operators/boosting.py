"""Gradient boosting of binned features: trees grown leaf by leaf or level by level, stopped by a held-out loss.

Rows lie in blocks: binned features, labels, weights and margins as bytes. A pass over the blocks adds
up gradients per (leaf, feature, bin), the sums of all tasks meet per (leaf, group of features), and only the best split
of each reaches the driver. Margins of the stored blocks are renewed every few rounds; until then the latest
trees are added on the fly, so nothing is ever refitted. Blocks that one task holds are boosted within that task, by the same
sums.
"""

from __future__ import annotations

import heapq
import json
import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.session import stage_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS, FEATURE_GROUP, STORE_EVERY = 65_536, 64, 16
_BLOCK = "role int, block long, n int, bins binary, y binary, w binary, margin binary"
_HELD = -1


@dataclass
class Tree:
    """Nodes by number; ``feature`` is -1 at a leaf; rows with bin <= ``cut`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, values: tuple[float, float]) -> tuple[int, int]:
        at = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, at, at + 1
        for value in values:
            for column, x in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, value)):
                column.append(x)
        return at, at + 1

    def leaves_of(self, bins: np.ndarray) -> np.ndarray:
        """The node in which each column of ``bins`` (features x rows) ends."""
        feature, cut, left, right = map(np.array, (self.feature, self.cut, self.left, self.right))
        at, every = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        while (feature[at] >= 0).any():
            asked = feature[at]
            goes_left = bins[np.maximum(asked, 0), every] <= cut[at]
            at = np.where(asked >= 0, np.where(goes_left, left[at], right[at]), at)
        return at

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves_of(bins)]


@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    cut: int
    left: tuple[float, float, float]  # gradient, hessian, rows
    right: tuple[float, float, float]


def shrunk(gradient, l1: float):
    return np.sign(gradient) * np.maximum(np.abs(gradient) - l1, 0.0)


def best_split(sums: np.ndarray, features: Sequence[int], l1: float, l2: float, min_rows: float,
               min_hessian: float) -> Split | None:
    """The split of highest gain from sums (features x [gradient, hessian, rows] x bins); ties to the first feature and bin."""
    left = np.cumsum(sums, axis=2)
    total = left[:, :, -1:]
    right = total - left

    def score(part):
        bottom = part[:, 1] + l2
        return np.divide(shrunk(part[:, 0], l1) ** 2, bottom, out=np.zeros_like(bottom), where=bottom > 0)

    gain = score(left) + score(right) - score(total)
    fits = (
        (left[:, 2] >= min_rows) & (right[:, 2] >= min_rows) & (left[:, 2] > 0) & (right[:, 2] > 0)
        & (left[:, 1] >= min_hessian) & (right[:, 1] >= min_hessian) & (gain > 1e-12)
    )
    if not fits.any():
        return None
    gain = np.where(fits, gain, -np.inf)
    f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    return Split(float(gain[f, b]), int(features[f]), int(b), tuple(left[f, :, b].tolist()), tuple(right[f, :, b].tolist()))


def fit_cuts(rows: DataFrame, features: str, max_bins: int) -> list[list[float]]:
    """Ascending cuts of every feature; a value's bin is the number of cuts below it.

    Features of few values get a cut at each; others at quantiles. What reaches the driver is bounded by
    features x bins.
    """
    values = rows.select(F.posexplode(vector_to_array(features)).alias("feature", "x"))
    spread = values.groupBy("feature").agg(
        F.approx_count_distinct("x", 0.02).alias("kinds"),
        F.percentile_approx("x", [i / max_bins for i in range(1, max_bins)], 20_000).alias("cuts"))
    found = {r["feature"]: r for r in spread.collect()}
    cuts = {f: sorted(set(r["cuts"])) for f, r in found.items()}
    few = [f for f, r in found.items() if r["kinds"] <= max_bins]
    if few:
        exact = values.filter(F.col("feature").isin(few)).distinct().groupBy("feature").agg(
            F.array_sort(F.collect_set("x")).alias("cuts")).collect()  # about max_bins values each
        cuts.update({r["feature"]: r["cuts"][:-1] for r in exact if len(r["cuts"]) <= max_bins})
    return [cuts.get(f, []) for f in range(max(found, default=-1) + 1)]


def binned(matrix: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    """Bins (features x rows) of a matrix (rows x features)."""
    wide = max(map(len, cuts), default=0) > 255
    out = np.empty(matrix.shape[::-1], np.uint16 if wide else np.uint8)
    for f, edges in enumerate(cuts):
        out[f] = np.searchsorted(edges, matrix[:, f], side="left")
    return out


def _wide(cuts) -> str:
    return "u2" if max(map(len, cuts), default=0) > 255 else "u1"


def _matrix(column) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False), float).reshape(len(column), -1)


def _blocks(rows: DataFrame, role: int, cuts, base: float, features: str, label: str, weight: str | None) -> DataFrame:
    """``rows`` in blocks of up to ``BLOCK_ROWS``; ``block`` numbers them for the draws of rows."""
    import pyarrow as pa

    size = max(1, min(BLOCK_ROWS, (1 << 26) // max(len(cuts), 1)))

    def pack(batches):
        from pyspark import TaskContext

        part, seen, held, count = TaskContext.get().partitionId(), 0, [], 0

        def block():
            bins = np.concatenate([h[0] for h in held], axis=1)
            y, w = (np.concatenate([h[i] for h in held]) for i in (1, 2))
            row = (role, part << 24 | seen, len(y), bins.tobytes(), y.tobytes(), w.tobytes(), np.full(len(y), base).tobytes())
            kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                              names=["role", "block", "n", "bins", "y", "w", "margin"])

        for batch in batches:
            y, w = (np.array(batch.column(i).to_numpy(zero_copy_only=False), float) for i in (1, 2))
            if len(y):
                held.append((binned(_matrix(batch.column(0)), cuts), y, w))
                count += len(y)
            if count >= size:
                yield block()
                held, count, seen = [], 0, seen + 1
        if held:
            yield block()

    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    table = rows.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), w.alias("w"))
    return table.mapInArrow(pack, _BLOCK)


def _one_by_one(batches):
    """Every block of the batches; one of them at a time is copied to Python, and no batch is kept beside the next."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns)}
        del batch


def _margins(block, cuts, trees: Sequence[Tree]):
    """(bins, y, w, margin) of a block with the latest trees added."""
    n = block["n"]
    bins = np.frombuffer(block["bins"], f"<{_wide(cuts)}").reshape(len(cuts), n)
    y, w, margin = (np.frombuffer(block[c], float) for c in ("y", "w", "margin"))
    for tree in trees:
        margin = margin + tree.margins(bins)
    return bins, y, w, margin


def _renewed(blocks: DataFrame, cuts, trees: Sequence[Tree]) -> DataFrame:
    """The blocks with ``trees`` in their stored margins."""
    import pyarrow as pa

    def renew(batches):
        kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
        for block in _one_by_one(batches):
            block["margin"] = _margins(block, cuts, trees)[3].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(block.values(), kinds)], names=list(block))

    return stage_table(blocks.mapInArrow(renew, _BLOCK), "margins")


def _together(blocks: DataFrame, tasks: int) -> DataFrame:
    """The blocks in memory, few of them in few tasks."""
    return (blocks.coalesce(tasks) if tasks < 64 else blocks).persist()


def _width(cuts) -> int:
    return max(map(len, cuts), default=0) + 1


def _groups(columns: np.ndarray) -> list[np.ndarray]:
    return [columns[i: i + FEATURE_GROUP] for i in range(0, len(columns), FEATURE_GROUP)]


def _sums(blocks, tree: Tree, wanted: Sequence[int], columns: np.ndarray, width: int, options: dict, draw: int):
    """Sums (wanted x columns x [gradient, hessian, rows] x bins) of the fitted rows, and [loss, weight] of the held-out ones."""
    slots = np.full(len(tree.feature), -1)
    slots[list(wanted)] = np.arange(len(wanted))
    share, seed = options["row_share"], options["seed"]
    sums = np.zeros((len(wanted), len(columns), 3, width))
    loss = np.zeros(2)
    for role, number, bins, y, w, margin in blocks:
        if role == 1:
            if 0 in wanted:
                loss += (w * (np.logaddexp(0.0, margin) - y * margin)).sum(), w.sum()
            continue
        p = 1.0 / (1.0 + np.exp(-margin))
        rows = slots[tree.leaves_of(bins)]
        if share < 1:
            rng = np.random.default_rng((seed, draw, number))
            rows = np.where(rng.random(len(rows)) < share, rows, -1)
        taken = np.flatnonzero(rows >= 0)
        slot, g, h = rows[taken] * width, (w * (p - y))[taken], (w * p * (1 - p))[taken]
        for i, f in enumerate(columns):
            place = slot + bins[f, taken]
            for k, x in enumerate((g, h, None)):
                sums[:, i, k] += np.bincount(place, x, len(wanted) * width).reshape(-1, width)
    return sums, loss


def _limits(options: dict) -> tuple:
    return tuple(options[o] for o in ("l1", "l2", "min_rows", "min_hessian"))


def _first(old: Split | None, split: Split) -> Split:
    """The split of higher gain; ties to the first feature."""
    return split if old is None or (-split.gain, split.feature) < (-old.gain, old.feature) else old


def _pass(blocks: DataFrame, cuts, trees, tree: Tree, wanted: Sequence[int], columns: np.ndarray, options: dict,
          draw: int) -> tuple[dict[int, Split | None], float | None, tuple]:
    """Best splits of the ``wanted`` nodes of ``tree``, the held-out loss under ``trees``, and the sums of node 0."""
    import pyarrow as pa

    width = _width(cuts)
    groups = _groups(columns)

    def local(batches):
        from pyspark import TaskContext

        blocks = ((block["role"], block["block"], *_margins(block, cuts, trees)) for block in _one_by_one(batches))
        sums, loss = _sums(blocks, tree, wanted, columns, width, options, draw)
        part = TaskContext.get().partitionId()
        out = [(_HELD, 0, part, loss.tobytes())] if 0 in wanted else []
        for s, node in enumerate(wanted):
            for j, group in enumerate(groups):
                first = j * FEATURE_GROUP
                out.append((node, j, part, sums[s, first: first + len(group)].tobytes()))
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                         names=["node", "grp", "part", "sums"])

    def merged(batches):
        key, total = None, None

        def result():
            node, group = key
            if node == _HELD:
                return {"node": node, "found": json.dumps(total.tolist())}
            sums = total.reshape(len(groups[group]), 3, width)
            split = best_split(sums, groups[group], *_limits(options))
            about = [sums[0].sum(axis=1).tolist(), None if split is None else list(split.__dict__.values())]
            return {"node": node, "found": json.dumps(about)}

        shape = pa.schema([("node", pa.int32()), ("found", pa.string())])
        for batch in batches:
            for node, group, _, raw in zip(*(c.to_pylist() for c in batch.columns)):
                sums = np.frombuffer(raw, float)
                if (node, group) == key:
                    total = total + sums
                else:
                    if key is not None:
                        yield pa.RecordBatch.from_pylist([result()], shape)
                    key, total = (node, group), sums
        if key is not None:
            yield pa.RecordBatch.from_pylist([result()], shape)

    tasks = max(1, min(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), len(wanted) * len(groups) // 8))
    parts = blocks.mapInArrow(local, "node int, grp int, part int, sums binary")
    if options["tasks"] > 1:
        parts = parts.repartition(tasks, "node", "grp")
    met = parts.sortWithinPartitions("node", "grp", "part")
    splits: dict[int, Split | None] = dict.fromkeys(wanted)
    loss, root = None, (0.0, 0.0, 0.0)
    for row in met.mapInArrow(merged, "node int, found string").collect():
        found = json.loads(row["found"])
        if row["node"] == _HELD:
            loss = found[0] / found[1] if found[1] else None
            continue
        root = tuple(found[0]) if row["node"] == 0 else root
        if found[1] is not None:
            gain, feature, cut, left, right = found[1]
            splits[row["node"]] = _first(splits[row["node"]], Split(gain, feature, cut, tuple(left), tuple(right)))
    return splits, loss, root


class _Spread:
    """Looks at nodes by passes over a table of blocks; its margins are renewed every ``STORE_EVERY`` trees."""

    def __init__(self, blocks: DataFrame, cuts, options: dict):
        self.blocks, self.cuts, self.options, self.stored = blocks, cuts, options, 0

    def __call__(self, trees: Sequence[Tree], tree: Tree, wanted: Sequence[int], columns: np.ndarray, draw: int):
        if len(trees) - self.stored >= STORE_EVERY:
            old, latest = self.blocks, trees[self.stored:]
            self.blocks, self.stored = _together(_renewed(old, self.cuts, latest), self.options["tasks"]), len(trees)
            self.blocks.count()
            old.unpersist()
        return _pass(self.blocks, self.cuts, trees[self.stored:], tree, wanted, columns, self.options, draw)


class _Alone:
    """The same within one task that holds all blocks: the sums of a single part are those of all."""

    def __init__(self, batches, cuts, options: dict):
        self.blocks = [[block["role"], block["block"], *_margins(block, cuts, [])] for block in _one_by_one(batches)]
        self.cuts, self.options, self.added = cuts, options, 0

    def __call__(self, trees: Sequence[Tree], tree: Tree, wanted: Sequence[int], columns: np.ndarray, draw: int):
        for latest in trees[self.added:]:
            for block in self.blocks:
                block[-1] = block[-1] + latest.margins(block[2])
        self.added = len(trees)
        sums, loss = _sums(self.blocks, tree, wanted, columns, _width(self.cuts), self.options, draw)
        splits: dict[int, Split | None] = dict.fromkeys(wanted)
        root = (0.0, 0.0, 0.0)
        for s, node in enumerate(wanted):
            for j, group in enumerate(_groups(columns)):
                part = sums[s, j * FEATURE_GROUP: j * FEATURE_GROUP + len(group)]
                split = best_split(part, group, *_limits(self.options))
                if node == 0:
                    root = tuple(part[0].sum(axis=1).tolist())
                if split is not None:
                    splits[node] = _first(splits[node], split)
        return splits, float(loss[0] / loss[1]) if 0 in wanted and loss[1] else None, root


def _boosted(look, features: int, options: dict) -> tuple[list[Tree], list[tuple], list[float | None], int]:
    """(trees, (round, node, split) of every split, held-out losses, round of the lowest): the rounds of a fit.

    ``look(trees, draft, nodes, columns, draw)`` has the best splits of a draft's nodes under the trees so far.
    """
    step, l1, l2, patience = (options[o] for o in ("step", "l1", "l2", "patience"))

    def value(part) -> float:
        g, h, _ = part
        return -step * float(shrunk(g, l1)) / (h + l2) if h + l2 > 0 else 0.0

    trees: list[Tree] = []
    splits: list[tuple] = []
    losses: list[float | None] = []
    best = 0
    while len(trees) < options["most"]:
        k = len(trees)
        rng = np.random.default_rng((options["seed"], k))
        n = max(1, math.ceil(options["feature_share"] * features))
        columns = np.sort(rng.choice(features, n, replace=False))
        tree, loss, made = grow(
            lambda draft, nodes: look(trees, draft, nodes, columns, k // options["draw_rounds"]),
            options["max_leaves"] or sys.maxsize, options["max_depth"] or sys.maxsize, value)
        losses.append(loss)
        if loss is not None and loss < losses[best]:
            best = k
        if patience is not None and k - best >= patience:
            break
        trees.append(tree)
        splits += [(k, node, s) for node, s in made]
        if not made and options["row_share"] == 1 and n == features:
            break  # nothing can be split any more
    if patience is not None and len(losses) <= len(trees):
        loss = look(trees, Tree(), [0], np.arange(features)[:1], 0)[1]
        losses.append(loss)
        if loss is not None and loss < losses[best]:
            best = len(losses) - 1
    return trees, splits, losses, best


def _boosted_alone(blocks: DataFrame, cuts, options: dict) -> tuple[list[Tree], list[tuple], list[float | None], int]:
    """All rounds in one task, for blocks that one task holds anyway: a round is some ms, where a pass by a job takes far longer."""
    import pyarrow as pa

    def rounds(batches):
        trees, splits, losses, best = _boosted(_Alone(batches, cuts, options), len(cuts), options)
        about = [[t.__dict__ for t in trees], [(k, node, list(s.__dict__.values())) for k, node, s in splits], losses, best]
        yield pa.RecordBatch.from_pydict({"found": [json.dumps(about)]})

    (row,) = blocks.coalesce(1).mapInArrow(rounds, "found string").collect()
    trees, splits, losses, best = json.loads(row["found"])
    return ([Tree(**t) for t in trees],
            [(k, node, Split(gain, feature, cut, tuple(left), tuple(right))) for k, node, (gain, feature, cut, left, right) in splits],
            losses, best)


def grow(passed, max_leaves: int, max_depth: int, value) -> tuple[Tree, float | None, list[tuple]]:
    """(tree, held-out loss before it, its splits): the tree that splits the leaf of highest gain next.

    A leaf's best split depends on its own rows alone. So the leaves that may be next are all split in a draft of the tree,
    their children are looked at in one pass, and the order by gain is followed as far as it is known;
    passes are about as many as the tree is deep. ``passed(draft, nodes)`` looks at nodes.
    """
    draft, depth = Tree(), {0: 0}
    splits, loss, root = passed(draft, [0])
    draft.value[0] = value(root)
    children: dict[int, tuple[int, int]] = {}

    def able(node: int) -> bool:
        return splits.get(node) is not None and depth[node] < max_depth

    while True:
        queue = [(-splits[0].gain, 0)] if able(0) else []
        chosen: list[int] = []
        unknown: list[int] = []
        while queue and len(chosen) + 1 < max_leaves:
            _, node = heapq.heappop(queue)
            chosen.append(node)
            last = len(chosen) + 1 >= max_leaves or depth[node] + 1 >= max_depth
            if node in children:
                for child in children[node]:
                    if child not in splits and not last:
                        unknown = [node]
                    elif able(child):
                        heapq.heappush(queue, (-splits[child].gain, child))
            elif not last:
                unknown = [node]
            if unknown:
                unknown += [n for _, n in queue if n not in children and depth[n] + 1 < max_depth]
                break
        if not unknown:
            break
        new = []
        for node in unknown:
            if node not in children:
                s = splits[node]
                children[node] = draft.split(node, s.feature, s.cut, (value(s.left), value(s.right)))
                depth.update(dict.fromkeys(children[node], depth[node] + 1))
            new += [c for c in children[node] if c not in splits]
        splits.update(passed(draft, new)[0])
    tree, names, made = Tree(), {0: 0}, []
    tree.value[0] = draft.value[0]
    for node in chosen:
        s = splits[node]
        pair = tree.split(names[node], s.feature, s.cut, (value(s.left), value(s.right)))
        names.update(zip(children.get(node, ()), pair))
        made.append((names[node], s))
    return tree, loss, made


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, kind)


_FLOAT, _INT, _TEXT = TypeConverters.toFloat, TypeConverters.toInt, TypeConverters.toString


class _BoosterParams(Params):
    featuresCol = _param("featuresCol", "vector of features", _TEXT)
    labelCol = _param("labelCol", "label, 0 or 1", _TEXT)
    weightCol = _param("weightCol", "row weight, empty for none", _TEXT)
    maxIter = _param("maxIter", "most rounds", _INT)
    stepSize = _param("stepSize", "share of a tree's values that is added", _FLOAT)
    maxLeaves = _param("maxLeaves", "most leaves of a tree, 0 for no limit", _INT)
    maxDepth = _param("maxDepth", "most splits above a leaf, 0 for no limit", _INT)
    minInstancesPerNode = _param("minInstancesPerNode", "fewest rows of a leaf", _FLOAT)
    minChildWeight = _param("minChildWeight", "least sum of second derivatives of a leaf", _FLOAT)
    regAlpha = _param("regAlpha", "strength of the absolute penalty", _FLOAT)
    regLambda = _param("regLambda", "strength of the squared penalty", _FLOAT)
    subsamplingRate = _param("subsamplingRate", "share of the rows drawn for a tree", _FLOAT)
    subsamplingFreq = _param("subsamplingFreq", "rounds for which a draw of rows is kept", _INT)
    featureShare = _param("featureShare", "share of the features drawn for a tree", _FLOAT)
    maxBins = _param("maxBins", "most bins of a feature", _INT)
    seed = _param("seed", "of the draws", _INT)

    def _value(self, name: str):
        return self.getOrDefault(self.getParam(name))

    def getMaxIter(self) -> int:
        return self._value("maxIter")

    def getStepSize(self) -> float:
        return self._value("stepSize")

    def getMaxDepth(self) -> int:
        return self._value("maxDepth")

    def getSubsamplingRate(self) -> float:
        return self._value("subsamplingRate")


class HistogramBooster(Estimator, _BoosterParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees by second-order gain over binned features.

    Null labels or weights are not allowed; a feature that is not a number falls in its last bin. No rows: a
    model that gives one half. Rows that repeat count as often as they occur.
    """

    @keyword_only
    def __init__(self, **params):
        super().__init__()
        self._setDefault(
            featuresCol="features", labelCol="label", weightCol="", maxIter=100, stepSize=0.1, maxLeaves=31,
            maxDepth=0, minInstancesPerNode=20.0, minChildWeight=1e-3, regAlpha=0.0, regLambda=0.0,
            subsamplingRate=1.0, subsamplingFreq=1, featureShare=1.0, maxBins=255, seed=42)
        self._set(**params)

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        return self.fit_stopped(dataset)[0]

    def fit_stopped(self, train: DataFrame, held: DataFrame | None = None, rounds: int = 50):
        """(model, best round, held-out losses, splits): boosting that ends ``rounds`` rounds after the lowest held-out loss.

        ``losses[i]`` is that after i trees. The best model is the first trees of the run; nothing is fitted again. Without
        ``held`` all rounds are run and kept. ``splits`` has (round, node, split) of every split kept.
        """
        options = {"l1": self._value("regAlpha"), "l2": self._value("regLambda"), "min_rows": self._value("minInstancesPerNode"),
                   "min_hessian": self._value("minChildWeight"), "row_share": self._value("subsamplingRate"), "seed": self._value("seed"),
                   "step": self._value("stepSize"), "most": self._value("maxIter"), "feature_share": self._value("featureShare"),
                   "draw_rounds": self._value("subsamplingFreq"), "max_leaves": self._value("maxLeaves"),
                   "max_depth": self._value("maxDepth"), "patience": None if held is None else rounds}
        names = [self._value(n) for n in ("featuresCol", "labelCol", "weightCol")]
        w = F.col(names[2]) if names[2] else F.lit(1.0)
        positive, total = train.agg(F.sum(F.col(names[1]).cast("double") * w), F.sum(w.cast("double"))).first()
        cuts = fit_cuts(train, names[0], self._value("maxBins"))
        share = min(max((positive or 0.0) / (total or 1.0), 1e-15), 1 - 1e-15) if total else 0.5
        base = math.log(share / (1 - share))
        blocks = _blocks(train, 0, cuts, base, *names)
        if held is not None:
            blocks = blocks.unionByName(_blocks(held, 1, cuts, base, *names))
        blocks = stage_table(blocks, "blocks")
        size = blocks.agg(F.sum("n")).first()[0] or 0
        options["tasks"] = max(1, size * max(len(cuts), 1) >> 20)  # rows x features a task
        trees, splits, losses, best = [], [], [], 0
        if total and options["tasks"] == 1:
            trees, splits, losses, best = _boosted_alone(blocks, cuts, options)
        elif total:
            look = _Spread(_together(blocks, options["tasks"]), cuts, options)
            try:
                trees, splits, losses, best = _boosted(look, len(cuts), options)
            finally:
                look.blocks.unpersist()
        kept = trees if held is None else trees[:max(best, 1)]
        model = BoostedTreesModel(featuresCol=names[0], trees=json.dumps(
            {"base": base, "cuts": cuts, "trees": [t.__dict__ for t in kept]}))
        return model, len(kept), losses, [s for s in splits if s[0] < len(kept)]


class BoostedTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``prediction``, the probability of label 1."""

    featuresCol = _param("featuresCol", "vector of features", _TEXT)
    trees = _param("trees", "base, cuts and trees as JSON", _TEXT)

    @keyword_only
    def __init__(self, featuresCol: str = "features", trees: str = '{"base": 0.0, "cuts": [], "trees": []}'):
        super().__init__()
        self._set(featuresCol=featuresCol, trees=trees)

    def _parts(self):
        about = json.loads(self.getOrDefault(self.trees))
        return about["base"], about["cuts"], [Tree(**t) for t in about["trees"]]

    @property
    def cuts(self) -> list[list[float]]:
        return self._parts()[1]

    @property
    def getNumTrees(self) -> int:
        return len(self._parts()[2])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        base, cuts, trees = self._parts()

        def probability(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype=float)
            bins = binned(np.stack(rows.to_numpy()).astype(float), cuts)
            margin = np.full(len(rows), base)
            for tree in trees:
                margin = margin + tree.margins(bins)
            return pd.Series(1.0 / (1.0 + np.exp(-margin)))

        scored = F.pandas_udf(probability, "double")
        return dataset.withColumn("prediction", scored(vector_to_array(self.getOrDefault(self.featuresCol))))
