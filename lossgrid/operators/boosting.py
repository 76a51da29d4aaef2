"""Boosted regression trees on the logistic loss, grown level by level from sums over all rows.

The method is that of MLlib's ``GBTClassifier``, and the result is its model. Rows lie in blocks of bin numbers that are
spread evenly over the cluster and kept there. One job per level of a tree adds up class counts and residuals per node,
feature and bin in every task; only these sums, whose size depends on features and bins alone, come to the driver, which
chooses the splits. The scores of the rows are carried from tree to tree.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.session import scratch_dir

#: Rows that a task handles at once, and of which a task has at most SLOT_ROWS where the table is larger than the cluster.
BLOCK_ROWS, SLOT_ROWS, LEAST_ROWS = 65536, 1 << 22, 4096
#: Trees between two points at which the lineage of the scores is cut.
CUT_EVERY = 20
#: Candidate thresholds are taken from about so many rows, as in MLlib; the sums that choose among them are of all rows.
THRESHOLD_ROWS = 10_000
#: Bytes of sums of all tasks that the driver adds itself; more are added on executors first.
DRIVER_BYTES = 1 << 25
#: Rows of a node from which only one of its children is added up. In small nodes splits of equal gain are common, and a
#: difference would be rounded otherwise than a sum.
REST_ROWS = 65536
#: Gains of a node that is a difference are equal up to this share of its impurity.
ROUNDING = 1e-10
PURE = 2.0**-52


@dataclass
class Node:
    """A node by its place in the tree (children of k are 2k + 1 and 2k + 2)."""

    weight: float
    total: float
    rows: int
    impurity: float = -1.0
    squares: float = 0.0
    gain: float = -1.0
    feature: int = -1
    cut: float = 0.0

    @property
    def value(self) -> float:
        return self.total / self.weight if self.weight else 0.0


@dataclass
class Layout:
    """Slots of the feature vector: ``numbers`` cut by thresholds, then one 0/1 slot per level of each category."""

    thresholds: list[np.ndarray]
    levels: list[int]
    bins: int
    ratio: float
    starts: list[int] = field(init=False)

    def __post_init__(self) -> None:
        self.starts = [len(self.thresholds) + sum(self.levels[:j]) for j in range(len(self.levels))]

    @property
    def slots(self) -> int:
        return len(self.thresholds) + sum(self.levels)


def thresholds_of(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` midpoints between neighbouring values that cut the weight into even parts; all of them if they are few."""
    distinct, place = np.unique(values, return_inverse=True)
    middle = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middle) <= most:
        return middle
    upto = np.cumsum(np.bincount(place, weights))
    stride, chosen = upto[-1] / (most + 1), []
    target = stride
    for i in range(1, len(distinct)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            chosen.append(middle[i - 1])
            target += stride
    return np.array(chosen)


def _blocks(batches: Iterable[pa.RecordBatch], layout: Layout) -> Iterator[pa.RecordBatch]:
    """Rows to blocks: twice the bin number per number, level per category, class."""

    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        columns = [c.to_numpy() for c in table.columns]
        d = len(layout.thresholds)
        bins = [(2 * np.searchsorted(layout.thresholds[f], columns[f], "left")).astype(np.uint8).tobytes() for f in range(d)]
        levels = [columns[d + j].astype(np.int32).tobytes() for j in range(len(layout.levels))]
        return pa.RecordBatch.from_pydict({
            "bins": pa.array([b"".join(bins)], pa.binary()), "levels": pa.array([b"".join(levels)], pa.binary()),
            "positive": pa.array([columns[-1].astype(np.uint8).tobytes()], pa.binary()),
        })

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            yield block(held)
            held, rows = [], 0
    if rows:
        yield block(held)


Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # bins, levels, positive, score
Splits = dict[int, tuple[int, int, float]]  # place -> category (-1: a number), row of its matrix, twice the last bin or the level


def _unpacked(row: tuple, numbers: int, categories: int) -> Block:
    positive = np.frombuffer(row["positive"], np.uint8)
    n = len(positive)
    return (np.frombuffer(row["bins"], np.uint8).reshape(numbers, n), np.frombuffer(row["levels"], np.int32).reshape(categories, n),
            positive, np.zeros(n))


def _places(block: Block, splits: Splits) -> np.ndarray:
    """Per row of a block the place of the node that it ends in."""
    bins, levels, positive, _ = block
    deepest = 2 * max(splits, default=0) + 2
    place = np.zeros(len(positive), np.uint8 if deepest < 256 else np.int64)
    for node in sorted(splits):  # parents first
        category, at, cut = splits[node]
        step = (bins[at] > cut if category < 0 else levels[at] == cut).astype(place.dtype)
        step += place.dtype.type(node + 1)
        step *= place == node
        place += step
    return place


def _moved(block: Block, splits: Splits, steps: dict[int, float]) -> Block:
    """The block with the scores after one more tree."""
    added = np.zeros(max(steps) + 1)
    added[list(steps)] = list(steps.values())
    return (*block[:3], block[3] + added[_places(block, splits)])


def _level_sums(
    blocks: Iterable[Block], splits: Splits, growing: list[int], first: bool, layout: Layout, counted: bool = True
) -> Iterator[np.ndarray]:
    """One array: per growing node, slot, bin and class the rows and their residuals; per node and class the squared residuals.

    Only the rows of the growing nodes are looked at. Where the rows are known already (``counted`` false) zeros stand for them.
    """
    many, width = len(growing), 2 * layout.bins
    cells = many * (len(layout.thresholds) * width + 2 * sum(layout.levels))
    counts, sums, squares = np.zeros(cells), np.zeros(cells), np.zeros(many * 2)
    number = np.full(2 * max([*splits, *growing]) + 3, -1)
    number[growing] = range(many)
    for block in blocks:
        bins, levels, positive, score = block
        node, rows = np.zeros(1, int), slice(None)
        if splits:
            node = number[_places(block, splits)]
            rows = np.flatnonzero(node >= 0)
            node, positive, score = node[rows], positive[rows], score[rows]
        sign = 2.0 * positive - 1.0
        if first:
            residual = sign
        else:
            with np.errstate(over="ignore"):
                residual = 4.0 * sign / (1.0 + np.exp(2.0 * sign * score))
        squares += np.bincount(2 * node + positive, residual * residual, len(squares))
        start, base, of = 0, None, 0
        for values, size in [*((b, width) for b in bins), *((2 * v, 2 * n) for v, n in zip(levels, layout.levels, strict=True))]:
            stop = start + many * size
            if base is None or of != size:
                base, of = node * size + positive, size
            keys = base + values[rows]
            if counted:
                counts[start:stop] += np.bincount(keys, minlength=many * size)
            sums[start:stop] += np.bincount(keys, residual, many * size)
            start = stop
    yield np.concatenate([counts, sums, squares])


def _parted(found: np.ndarray, many: int, layout: Layout) -> tuple[list[np.ndarray], np.ndarray]:
    """The sums of a level as views, by slot or category and then (rows or residuals), node, bin and class; the squares by node and class."""
    cells = (len(found) - 2 * many) // 2
    both, start, out = found[: 2 * cells].reshape(2, cells), 0, []
    for size in [*[2 * layout.bins] * len(layout.thresholds), *[2 * n for n in layout.levels]]:
        out.append(both[:, start : start + many * size].reshape(2, many, size))
        start += many * size
    return out, found[2 * cells :].reshape(many, 2)


def _with_siblings(
    found: np.ndarray, summed: list[int], growing: list[int], before: np.ndarray, parents: list[int], layout: Layout
) -> np.ndarray:
    """The sums of all growing nodes: what was not added up is what a parent has beside the other child.

    A cell without rows has a sum of 0, so thresholds with nothing between them stay equal.
    """
    size = len(found) // len(summed)
    out = np.empty(size * len(growing))
    (own, squares), (above, squares_above), (to, squares_to) = (
        _parted(v, n, layout) for v, n in ((found, len(summed)), (before, len(parents)), (out, len(growing)))
    )
    for i, place in enumerate(growing):
        if place in summed:
            j = summed.index(place)
            squares_to[i] = squares[j]
            for there, here in zip(to, own, strict=True):
                there[:, i] = here[:, j]
        else:
            j, k = summed.index(place + 1 if place % 2 else place - 1), parents.index((place - 1) // 2)
            squares_to[i] = np.maximum(squares_above[k] - squares[j], 0.0)
            for there, here, whole in zip(to, own, above, strict=True):
                there[:, i] = whole[:, k] - here[:, j]
                there[1, i][there[0, i] == 0] = 0.0
    return out


def _best_splits(
    found: np.ndarray, growing: list[int], layout: Layout, summed: Sequence[int] | None = None
) -> list[tuple[Node, Node | None, Node | None]]:
    """Per growing node its own sums and, where a split gains, its children; earlier slots and lower thresholds win ties.

    In nodes that were not ``summed`` gains that differ by the rounding of a difference are ties.
    """
    many, d, width = len(growing), len(layout.thresholds), 2 * layout.bins
    both = np.array([1.0, layout.ratio])  # weight of a row by class
    cells = (len(found) - 2 * many) // 2
    counts, sums, squares = found[:cells], found[cells : 2 * cells], (found[2 * cells :].reshape(many, 2) * both).sum(1)
    sides = []  # rows, weight, residuals of the part that a split sets apart, and of the whole node; by node and split
    wholes = []
    at, start = [], 0
    for f in range(d):
        part = [v[start : start + many * width].reshape(many, layout.bins, 2) for v in (counts, sums)]
        rows, weight, total = part[0].sum(2), (part[0] * both).sum(2), (part[1] * both).sum(2)
        left = [np.cumsum(v, 1) for v in (rows, weight, total)]
        k = len(layout.thresholds[f])
        sides.append([v[:, :k] for v in left])
        wholes.append([np.repeat(v[:, -1:], k, 1) for v in left])
        at += [(f, b, True) for b in range(k)]
        start += many * width
    for j, n in enumerate(layout.levels):
        part = [v[start : start + many * 2 * n].reshape(many, n, 2) for v in (counts, sums)]
        there = [part[0].sum(2), (part[0] * both).sum(2), (part[1] * both).sum(2)]
        sides.append(there)
        wholes.append([np.repeat(v.sum(1, keepdims=True), n, 1) for v in there])
        at += [(layout.starts[j] + s, 0, False) for s in range(n)]
        start += many * 2 * n
    apart = [np.concatenate([s[i] for s in sides], 1) for i in range(3)]
    whole = [np.concatenate([s[i] for s in wholes], 1) for i in range(3)]
    rest = [w - a for w, a in zip(whole, apart, strict=True)]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (apart[2] ** 2 / apart[1] + rest[2] ** 2 / rest[1] - whole[2] ** 2 / whole[1]) / whole[1]
    usable = (apart[0] > 0) & (rest[0] > 0) & (apart[1] > 0) & (rest[1] > 0)
    gain = np.where(usable, gain, -np.inf)
    # The sums of a node are those of its first slot: every slot adds up the same rows.
    own = [counts, sums]
    size = width if d else 2 * layout.levels[0] if layout.levels else 0
    out = []
    for i in range(many):
        n, g = (v[i * size : (i + 1) * size].reshape(-1, 2).sum(0) for v in own)
        node = Node(float((n * both).sum()), float((g * both).sum()), int(n.sum()), squares=float(squares[i]))
        node.impurity = (node.squares - node.total * node.value) / node.weight if node.weight else 0.0
        left = right = None
        best = int(gain[i].argmax()) if gain.shape[1] else -1
        if best >= 0 and summed is not None and growing[i] not in summed:
            best = int((gain[i] >= gain[i, best] - ROUNDING * abs(node.impurity)).argmax())
        if best >= 0 and gain[i, best] > 0 and abs(node.impurity) >= PURE:
            slot, b, below = at[best]
            node.gain, node.feature = float(gain[i, best]), slot
            node.cut = float(layout.thresholds[slot][b]) if below else 0.5
            parts = [Node(float(p[1][i, best]), float(p[2][i, best]), int(p[0][i, best])) for p in (apart, rest)]
            left, right = parts if below else parts[::-1]
        out.append((node, left, right))
    return out


def _split_of(node: Node, layout: Layout) -> tuple[int, int, float]:
    if node.feature < len(layout.thresholds):
        return -1, node.feature, 2 * int(np.searchsorted(layout.thresholds[node.feature], node.cut, "left"))
    j = max(j for j, start in enumerate(layout.starts) if start <= node.feature and layout.levels[j])
    return j, j, node.feature - layout.starts[j]


def _total(sums: RDD, size: int) -> np.ndarray:
    parts = sums.getNumPartitions()
    if size * 8 * parts > DRIVER_BYTES:
        return sums.treeReduce(np.add)
    return np.sum(sums.collect(), axis=0)


def _lesser(nodes: dict[int, Node], place: int) -> int:
    """Of a node and its sibling the one with fewer rows."""
    left = place if place % 2 else place - 1
    return left if nodes[left].rows <= nodes[left + 1].rows else left + 1


def _grown(blocks: RDD, first: bool, depth: int, layout: Layout, rows_at_root: np.ndarray | None) -> tuple[dict[int, Node], Splits, np.ndarray]:
    """One tree: its nodes by place, its splits, and the rows by slot, bin and class, which are the same for every tree.

    Of two children of a large node the one with fewer rows is added up, the other one is the rest of their parent.
    """
    nodes: dict[int, Node] = {}
    splits: Splits = {}
    growing, parents, before = [0], [], np.zeros(0)
    for level in range(depth):
        known, counted = dict(splits), bool(level) or rows_at_root is None
        summed = [p for p in growing if not p or nodes[(p - 1) // 2].rows < REST_ROWS or _lesser(nodes, p) == p]
        sums = blocks.mapPartitions(
            lambda part, known=known, summed=summed, counted=counted: _level_sums(part, known, summed, first, layout, counted)
        )
        size = 2 * len(summed) * (len(layout.thresholds) * 2 * layout.bins + 2 * sum(layout.levels) + 1)
        found = _total(sums, size)
        if level:
            found = _with_siblings(found, summed, growing, before, parents, layout)
        elif rows_at_root is None:
            rows_at_root = found[: (len(found) - 2) // 2].copy()
        else:
            found[: len(rows_at_root)] = rows_at_root
        parents, before, growing = growing, found, []
        for place, (node, left, right) in zip(parents, _best_splits(found, parents, layout, summed), strict=True):
            nodes[place] = node
            if left is not None:
                splits[place] = _split_of(node, layout)
                nodes[2 * place + 1], nodes[2 * place + 2] = left, right
                growing += [2 * place + 1, 2 * place + 2]
        if not growing:
            break
    return nodes, splits, rows_at_root


def fit_trees(
    df: DataFrame, *, label: str, numbers: Sequence[str], categories: Sequence[tuple[str, int]], rows: int, ratio: float,
    trees: int, depth: int, rate: float, seed: int, bins: int = 32,
) -> list[dict[int, Node]]:
    """The trees of a boosted fit of a 0/1 label; positives weigh ``ratio``. ``categories`` are level numbers and how many there are.

    ``rows`` is the number of rows of ``df``; every one of them enters all sums.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    slots = context.defaultParallelism
    spread = max(1, min(slots, rows // LEAST_ROWS)) * max(1, -(-rows // (SLOT_ROWS * slots)))
    values = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(numbers)]
    picked = df.select(*values, *[F.col(c).cast("int").alias(f"_l{j}") for j, (c, _) in enumerate(categories)], F.col(label).cast("int").alias("_y"))
    most = max(bins * bins, THRESHOLD_ROWS)
    sample = picked.select(*[f"_x{i}" for i in range(len(numbers))], "_y")
    seen = (sample.sample(False, most / rows, seed) if rows > most else sample).toPandas()
    weights = np.where(seen["_y"] == 1, ratio, 1.0)
    cuts = [thresholds_of(seen[f"_x{i}"].to_numpy(float), weights, max(min(bins, rows) - 1, 0)) for i in range(len(numbers))]
    layout = Layout(cuts, [n for _, n in categories], max([len(c) + 1 for c in cuts], default=1), ratio)
    packed = picked.repartition(spread).mapInArrow(lambda batches: _blocks(batches, layout), "bins binary, levels binary, positive binary")
    wide, many = len(numbers), len(categories)
    blocks = packed.rdd.map(lambda row: _unpacked(row, wide, many)).persist(StorageLevel.MEMORY_AND_DISK)
    cut = RDD.checkpoint if context.getCheckpointDir() else RDD.localCheckpoint
    cut(blocks)
    out, counts = [], None
    for m in range(trees):
        nodes, splits, counts = _grown(blocks, m == 0, depth, layout, counts)
        out.append(nodes)
        if m:
            before.unpersist()
        before, step = blocks, 1.0 if m == 0 else rate
        steps = {place: step * node.value for place, node in nodes.items() if place not in splits}
        blocks = before.map(lambda b, splits=splits, steps=steps: _moved(b, splits, steps)).persist(StorageLevel.MEMORY_AND_DISK)
        if m % CUT_EVERY == CUT_EVERY - 1:
            cut(blocks)
    before.unpersist()
    blocks.unpersist()
    return out


def _listed(nodes: dict[int, Node], categories_from: int) -> list[tuple]:
    """Nodes in MLlib's order, parents first, as rows of its table; twin leaves of one value are their parent."""

    def shrunk(place: int) -> bool:
        """Whether the node is a leaf of the written tree."""
        if nodes[place].feature < 0:
            return True
        left, right = 2 * place + 1, 2 * place + 2
        return shrunk(left) and shrunk(right) and value(left) == value(right)

    def value(place: int) -> float:
        return nodes[place].value if nodes[place].feature < 0 else value(2 * place + 1)

    rows: list[tuple] = []

    def add(place: int) -> int:
        node, at = nodes[place], len(rows)
        stats = [node.weight, node.total, node.squares]
        rows.append(())
        if shrunk(place):
            rows[at] = (at, value(place), node.impurity, stats, node.rows, -1.0, -1, -1, (-1, [], -1))
        else:
            left, right = add(2 * place + 1), add(2 * place + 2)
            # A 0/1 slot is a category of two values there, 0 on the left.
            split = (node.feature, [node.cut], -1) if node.feature < categories_from else (node.feature, [0.0], 2)
            rows[at] = (at, node.value, node.impurity, stats, node.rows, node.gain, left, right, split)
        return at

    add(0)
    return rows


NODE_SCHEMA = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
    "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def as_model(spark: SparkSession, estimator: GBTClassifier, trees: list[dict[int, Node]], *, numbers: int, slots: int) -> GBTClassificationModel:
    """The trees as an MLlib model, by MLlib's own format of saved models."""
    path = scratch_dir(spark, "boosted-trees")

    def metadata(kind: str, head: str, skip: Sequence[str] = (), **more: int) -> str:
        given = {p.name: v for p, v in estimator._paramMap.items() if p.name not in skip}
        default = {p.name: v for p, v in estimator._defaultParamMap.items() if p.name not in skip}
        return json.dumps({
            "class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
            "uid": f"{head}_{uuid.uuid4().hex[:12]}", "paramMap": given, "defaultParamMap": default, **more,
        })

    def write(rows: list[tuple], schema: str, name: str) -> None:
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}")

    boosted = ("maxIter", "stepSize", "lossType", "validationTol", "featureSubsetStrategy", "subsamplingRate", "probabilityCol", "rawPredictionCol")
    rate = estimator.getStepSize()
    head = metadata("classification.GBTClassificationModel", "GBTClassifier", numFeatures=slots, numTrees=len(trees))
    spark.createDataFrame([(head,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    write([(i, row) for i, nodes in enumerate(trees) for row in _listed(nodes, numbers)], NODE_SCHEMA, "data")
    each = [(i, metadata("regression.DecisionTreeRegressionModel", "dtr", boosted), 1.0 if i == 0 else rate) for i in range(len(trees))]
    write(each, "_1 int, _2 string, _3 double", "treesMetadata")
    model = GBTClassificationModel.load(path)
    model.grown = Walk.of(trees, [1.0 if i == 0 else rate for i in range(len(trees))])  # for scoring; a saved model does not keep it
    return model


#: Slots of the feature vector up to which rows are scored in batches; MLlib scores wider, sparse ones.
SCORED_SLOTS, SCORED_ROWS = 512, 16384


@dataclass
class Walk:
    """Trees as steps over whole columns: a row's leaf is put together from all comparisons of a tree, without a walk per row."""

    cuts: dict[int, np.ndarray]
    trees: list[tuple[list[tuple[int, int, int]], np.ndarray]]  # (place, feature, rank of the cut), children first; leaf values by place
    kind: type

    @classmethod
    def of(cls, trees: list[dict[int, Node]], weights: Sequence[float]) -> Walk:
        inner = [{p: n for p, n in nodes.items() if n.feature >= 0} for nodes in trees]
        found: dict[int, set[float]] = {}
        for node in (n for nodes in inner for n in nodes.values()):
            found.setdefault(node.feature, set()).add(node.cut)
        cuts = {f: np.array(sorted(c)) for f, c in found.items()}
        steps, last = [], max(max(nodes) for nodes in trees)
        for nodes, split, weight in zip(trees, inner, weights, strict=True):
            values = np.zeros(last + 1)
            for place, node in nodes.items():
                values[place] = weight * node.value
            order = [(p, n.feature, int(np.searchsorted(cuts[n.feature], n.cut))) for p, n in sorted(split.items(), reverse=True)]
            steps.append((order, values))
        return cls(cuts, steps, np.uint8 if last < 256 else np.int64)

    def probability(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1 per row; what equals a threshold is on its left."""
        out = np.empty(len(rows))
        for start in range(0, len(rows), SCORED_ROWS):
            part = rows[start : start + SCORED_ROWS]
            rank = {f: np.searchsorted(c, np.ascontiguousarray(part[:, f]), "left") for f, c in self.cuts.items()}
            rank = {f: r.astype(np.uint8) if len(self.cuts[f]) < 256 else r for f, r in rank.items()}
            margin = np.zeros(len(part))
            for order, values in self.trees:
                ended: dict[int, np.ndarray] = {}
                for place, feature, cut in order:
                    left, right = (ended.pop(p, self.kind(p)) for p in (2 * place + 1, 2 * place + 2))
                    step = (rank[feature] > cut).astype(self.kind)
                    step *= right - left  # modulo 256, and so is the sum
                    step += left
                    ended[place] = step
                margin += values[ended[0]] if ended else values[0]
            with np.errstate(over="ignore"):
                out[start : start + len(part)] = 1.0 / (1.0 + np.exp(-2.0 * margin))
        return out


def probability(model: GBTClassificationModel) -> Callable[[Column], Column] | None:
    """A function of the feature array that scores with the trees of a model grown here; None for other models and wide ones."""
    walk = getattr(model, "grown", None)
    if walk is None or model.numFeatures > SCORED_SLOTS:
        return None
    slots = model.numFeatures

    @F.arrow_udf("double")
    def scored(features: pa.Array) -> pa.Array:
        return pa.array(walk.probability(features.flatten().to_numpy(zero_copy_only=False).reshape(len(features), slots)))

    return scored
