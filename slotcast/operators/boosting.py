"""Gradient boosting on binned rows: best-first trees, rounds paid once, models as node tables.

Inputs become at most 64 bins a feature (0: missing or unknown), a split the set of bins that
go left, one 64-bit mask.  A tree grows at the leaf with the most gain until it has ``leaves``
of them.  Rounds go on from the predictions so far and end once ``patience`` of them bring no
less absolute validation error; the best prefix is kept.

Trees need histograms only.  Where a model's rows fit a task (``TASK_ROWS``, counted first)
the rounds run in one task, so many models are fitted side by side, one a task.  Beyond that
the rows stay where they are: tasks make partial histograms, Spark adds them up, and the
predictions so far are written every few rounds.  Both ways give the same trees.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import delete
from ..session import shared_folder

#: Bins of a feature, the one of missing values included.
BINS = 64
#: Rows of a model that is fitted in one task.  With 13 inputs a row took 230 to 390 bytes (its Arrow batch, bins,
#: one column's doubles, codes and slopes): 0.5 GB with 2 million of them, the interpreter included.
TASK_ROWS = 2_000_000
#: Rows whose codes for all features a histogram holds at once.
AT_ONCE = 20_000
#: Rounds between two writes of the predictions so far.
WRITE_EVERY = 10


@dataclass(frozen=True)
class Settings:
    """Learner settings; the defaults are fixed values but for ``leastRows``, ``seed``."""

    rounds: int = 500
    patience: int = 50
    leaves: int = 63
    stepSize: float = 0.05
    columnRate: float = 0.8
    subsamplingRate: float = 0.8
    redraw: int = 5
    leastRows: int = 20
    maxDepth: int = 64
    seed: int = 42
    loss: str = "squared"


@dataclass
class Tree:
    """Nodes by number; the root is 0, a leaf has feature -1."""

    feature: list[int] = field(default_factory=list)
    mask: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)

    def add(self, rows: int) -> int:
        for column, value in zip((self.feature, self.mask, self.left, self.right, self.value, self.gain, self.rows), (-1, 0, -1, -1, 0.0, 0.0, rows)):
            column.append(value)
        return len(self.feature) - 1

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf that each row of bins falls into."""
        feature, mask = np.array(self.feature), np.array(self.mask, np.uint64)
        left, right = np.array(self.left), np.array(self.right)
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while len(rows):
            rows = rows[feature[at[rows]] >= 0]
            node = at[rows]
            bit = (mask[node] >> bins[rows, feature[node]].astype(np.uint64)) & np.uint64(1)
            at[rows] = np.where(bit == 1, left[node], right[node])
        return at

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaf_of(bins)]


@dataclass
class Inputs:
    """How a frame's columns become bins: the edges of numbers, the labels of the key."""

    key: str
    labels: list[str]
    numbers: list[str]
    edges: list[list[float]] = field(default_factory=list)

    @property
    def names(self) -> list[str]:
        return [self.key, *self.numbers]

    def columns(self) -> list[Column]:
        """Double columns: the key's place in its labels from 1 on, numbers as they are."""
        place = F.array_position(F.array(*[F.lit(x) for x in self.labels]), F.col(self.key))
        return [F.coalesce(place, F.lit(0)).cast("double"), *[F.col(c).cast("double") for c in self.numbers]]

    def bins(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """One row of bins for each row.  More than 63 labels share bins with their neighbours."""
        out = np.zeros((len(columns[0]), len(columns)), np.uint8)
        for at, values in enumerate(columns):
            out[:, at] = self.bins_of(at, values)
        return out

    def bins_of(self, at: int, values: np.ndarray) -> np.ndarray:
        """Bins of one column, the key's at 0."""
        values = np.asarray(values, np.float64)
        if at:
            return np.where(np.isnan(values), 0, 1 + np.searchsorted(self.edges[at - 1], values))
        place = np.nan_to_num(values).astype(np.int64)
        spread = max(1, -(-len(self.labels) // (BINS - 1)))
        return np.where(place > 0, 1 + (place - 1) // spread, 0)


QUANTILES = [k / (BINS - 1) for k in range(1, BINS - 1)]


def edges_of(values: np.ndarray) -> list[float]:
    """Distinct lower quantiles of the values that are not missing."""
    values = np.sort(values[~np.isnan(values)])
    if not len(values):
        return []
    at = np.ceil(np.array(QUANTILES) * len(values)).astype(np.int64) - 1
    return np.unique(values[np.maximum(at, 0)]).tolist()


@dataclass
class Ensemble:
    """A fitted model: inputs, first prediction and trees whose values carry the step."""

    inputs: Inputs
    base: float
    trees: list[Tree]
    loss: str = "squared"

    def predict(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for tree in self.trees:
            out += tree.predict(bins)
        return out

    def node_rows(self) -> list[tuple]:
        """The model as a table; its head, the inputs and the base, on the row of tree -1."""
        head = json.dumps({"inputs": asdict(self.inputs), "base": self.base, "loss": self.loss})
        rows: list[tuple] = [(-1, 0, None, None, None, None, self.base, None, None, head)]
        names = self.inputs.names
        for number, t in enumerate(self.trees):
            for node, f in enumerate(t.feature):
                split = f >= 0
                rows.append(
                    (number, node, names[f] if split else None, _signed(t.mask[node]) if split else None,
                     t.left[node] if split else None, t.right[node] if split else None,
                     t.value[node], t.gain[node], t.rows[node], None)
                )
        return rows

    @staticmethod
    def of_rows(rows: Sequence) -> Ensemble:
        head = next(json.loads(r[9]) for r in rows if r[9])
        inputs = Inputs(**head["inputs"])
        place = {name: k for k, name in enumerate(inputs.names)}
        trees: list[Tree] = []
        for number, node, feature, mask, left, right, value, gain, n, _ in sorted(rows, key=lambda r: (r[0], r[1])):
            if number < 0:
                continue
            if node == 0:
                trees.append(Tree())
            t = trees[-1]
            t.add(n)
            t.value[node], t.gain[node] = value, gain
            if feature is not None:
                t.feature[node], t.mask[node], t.left[node], t.right[node] = place[feature], mask % 2**64, left, right
        return Ensemble(inputs, head["base"], trees, head["loss"])


NODES_DDL = (
    "tree int, node int, feature string, mask long, left int, right int, value double, gain double, n long, head string"
)


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


# --- growing one tree ----------------------------------------------------------------------


def best_split(hist: np.ndarray, columns: np.ndarray, least: int) -> tuple[float, int, int]:
    """(gain, feature, mask) of the best split of a node's (feature, bin, [sum, count]) table.

    Bins of numbers go left up to some bin, missing ones with either side; the key's bins go
    left up to some place in the order of their means.  No split: gain 0.
    """
    chosen = hist[columns]
    total, count = chosen[0, :, 0].sum(), chosen[0, :, 1].sum()
    if count < 2 * least:
        return 0.0, -1, 0
    identity = np.arange(BINS)
    orders = np.broadcast_to(identity, (len(columns), BINS)).copy()
    key = np.flatnonzero(columns == 0)
    for at in key:
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = np.where(chosen[at, :, 1] > 0, chosen[at, :, 0] / chosen[at, :, 1], np.inf)
        orders[at] = np.argsort(mean, kind="stable")
    first = np.cumsum(np.take_along_axis(chosen, orders[:, :, None], 1), axis=1)
    best = (0.0, -1, 0)
    for missing_right in (False, True):
        left = first - chosen[:, :1] if missing_right else first
        s, n = left[..., 0], left[..., 1]
        with np.errstate(invalid="ignore", divide="ignore"):
            gain = s * s / n + (total - s) ** 2 / (count - n) - total * total / count
        gain[(n < least) | (count - n < least)] = 0
        if missing_right:
            gain[key] = 0
        at, upto = np.unravel_index(np.argmax(gain), gain.shape)
        # Sums in another order differ in their last digits: a gain must stand out from them.
        if gain[at, upto] > best[0] + 1e-9 * max(1.0, best[0], total * total / count):
            mask = sum(1 << int(b) for b in orders[at, : upto + 1])
            best = (float(gain[at, upto]), int(columns[at]), mask & ~1 if missing_right else mask)
    return best


#: Histograms of the children of split nodes: [(node, feature, mask, left, right)] -> {node: table}.
Children = Callable[[list[tuple[int, int, int, int, int]]], dict[int, np.ndarray]]


def grow(root: np.ndarray, children: Children, columns: np.ndarray, settings: Settings, ahead: int = 1) -> Tree:
    """The tree that always splits the leaf with the most gain.

    Up to ``ahead`` leaves, the best first, are split at once to find their children's tables;
    children whose turn never comes are left out of the tree.
    """
    count = lambda table: int(round(table[0, :, 1].sum()))
    made = Tree()
    made.add(count(root))
    depth, found = [0], {0: (best_split(root, columns, settings.leastRows), root)}
    known: dict[int, tuple[int, int]] = {}
    heap = [(-found[0][0][0], 0)] if found[0][0][0] > 0 else []
    leaves = 1
    while heap and leaves < settings.leaves:
        if heap[0][1] not in known:
            asked = []
            for _, node in heapq.nsmallest(min(ahead, settings.leaves - leaves), heap):
                if node in known:
                    continue
                (_, feature, mask), table = found[node]
                known[node] = (made.add(0), made.add(0))
                depth += [depth[node] + 1] * 2
                asked.append((node, feature, mask, *known[node]))
            for node, table in children(asked).items():
                made.rows[node] = count(table)
                split = best_split(table, columns, settings.leastRows) if depth[node] < settings.maxDepth else (0.0, -1, 0)
                found[node] = (split, table)
        _, node = heapq.heappop(heap)
        (gain, feature, mask), _ = found[node]
        made.gain[node], made.feature[node], made.mask[node] = gain, feature, mask
        made.left[node], made.right[node] = known[node]
        leaves += 1
        for child in known[node]:
            if found[child][0][0] > 0:
                heapq.heappush(heap, (-found[child][0][0], child))
    return made


def compact(tree: Tree) -> Tree:
    """The tree without nodes that it does not reach, numbered from the root on."""
    out, queue = Tree(), [0]
    out.add(tree.rows[0])
    for new, old in enumerate(queue):
        out.value[new] = tree.value[old]
        if tree.feature[old] >= 0:
            out.feature[new], out.mask[new], out.gain[new] = tree.feature[old], tree.mask[old], tree.gain[old]
            for side, kept in (("left", out.left), ("right", out.right)):
                child = getattr(tree, side)[old]
                queue.append(child)
                kept[new] = out.add(tree.rows[child])
    return out


def _slope(y: np.ndarray, predicted: np.ndarray, loss: str) -> np.ndarray:
    return np.sign(y - predicted) if loss == "absolute" else y - predicted


def _in_sample(draw: np.ndarray, round_: int, settings: Settings) -> np.ndarray:
    """Rows of a round's sample, which is drawn anew every few rounds from the rows' own hashes."""
    if settings.subsamplingRate >= 1:
        return np.ones(len(draw), bool)
    salt = np.uint64((settings.seed * 1_000_003 + round_ // settings.redraw) * 0x9E3779B97F4A7C15 % 2**64)
    mixed = (draw.view(np.uint64) ^ salt) * np.uint64(0xD6E8FEB86659FD93)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)) % np.uint64(10_000) < np.uint64(round(10_000 * settings.subsamplingRate))


def _columns(n: int, round_: int, settings: Settings) -> np.ndarray:
    most = max(1, int(np.ceil(settings.columnRate * n)))
    return np.sort(np.random.default_rng([settings.seed, round_]).permutation(n)[:most])


def _histogram(bins: np.ndarray, slope: np.ndarray) -> np.ndarray:
    """Sums and counts of a node's rows by feature and bin."""
    width = bins.shape[1]
    out = np.empty((width, BINS, 2))
    if len(bins) > AT_ONCE:
        # Feature by feature takes 8 bytes a row, not 300, and adds each bin's rows in the same order.
        for at in range(width):
            own = bins[:, at].astype(np.intp)
            out[at, :, 0] = np.bincount(own, slope, BINS)
            out[at, :, 1] = np.bincount(own, minlength=BINS)
        return out
    codes = (bins.astype(np.int32) + np.arange(width, dtype=np.int32) * BINS).ravel()
    out[..., 0] = np.bincount(codes, np.repeat(slope, width), width * BINS).reshape(width, BINS)
    out[..., 1] = np.bincount(codes, minlength=width * BINS).reshape(width, BINS)
    return out


def lower_median(values: np.ndarray) -> float:
    return float(np.partition(values, (len(values) - 1) // 2)[(len(values) - 1) // 2])


def first_value(y: np.ndarray, loss: str) -> float:
    return lower_median(y) if loss == "absolute" else float(y.mean())


# --- rounds ----------------------------------------------------------------------------------


class TaskRows:
    """Rows of one model inside a task."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, draw: np.ndarray, val: np.ndarray, base: float, settings: Settings):
        self.settings, self.val_y, self.val_bins = settings, y[val], bins[val]
        self.bins, self.y, self.draw = bins[~val], y[~val], draw[~val]
        self.at, self.val_at = np.full(len(self.y), base), np.full(len(self.val_y), base)

    def tree(self, round_: int) -> Tree:
        s = self.settings
        rows = np.flatnonzero(_in_sample(self.draw, round_, s))
        bins, slope = self.bins[rows], _slope(self.y[rows], self.at[rows], s.loss)
        held = {0: np.arange(len(rows))}
        root = _histogram(bins, slope)
        tables = {0: root}

        def children(asked):
            out = {}
            for node, feature, mask, left, right in asked:
                own = held.pop(node)
                goes = (np.uint64(mask) >> bins[own, feature].astype(np.uint64)) & np.uint64(1) == 1
                held[left], held[right] = own[goes], own[~goes]
                small, large = sorted((left, right), key=lambda k: len(held[k]))
                out[small] = _histogram(bins[held[small]], slope[held[small]])
                out[large] = tables[node] - out[small]
            tables.update(out)
            return out

        tree = grow(root, children, _columns(bins.shape[1], round_, s), s)
        for leaf, own in held.items():
            if len(own):
                tree.value[leaf] = s.stepSize * (
                    lower_median(self.y[rows[own]] - self.at[rows[own]]) if s.loss == "absolute" else float(slope[own].mean())
                )
        return tree

    def step(self, tree: Tree) -> float:
        """Add a tree; the absolute validation error after it."""
        self.at += tree.predict(self.bins)
        self.val_at += tree.predict(self.val_bins)
        return float(np.abs(self.val_y - self.val_at).mean()) if len(self.val_y) else float("nan")


def boost(rows, inputs: Inputs, base: float, settings: Settings) -> Ensemble:
    """Rounds until patience ends; the prefix with the least validation error.

    Without validation rows all rounds are kept.
    """
    trees, errors = [], []
    for round_ in range(settings.rounds):
        trees.append(compact(rows.tree(round_)))
        errors.append(rows.step(trees[-1]))
        best, ended = best_round(errors, settings.patience)
        if ended:
            break
    kept = len(trees) if np.isnan(errors[-1]) else best
    return Ensemble(inputs, base, trees[:kept], settings.loss)


def best_round(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """Round with the least error before ``patience`` rounds bring no less, and whether that ended it."""
    best = 0
    for at, error in enumerate(errors):
        if error < errors[best]:
            best = at
        elif at - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_arrays(columns: Sequence[np.ndarray], y: np.ndarray, draw: np.ndarray, val: np.ndarray, inputs: Inputs, settings: Settings) -> Ensemble:
    """Fit in this task; edges and base come from the training rows."""
    inputs = replace(inputs, edges=[edges_of(np.asarray(c, np.float64)[~val]) for c in columns[1:]])
    return fit_bins(inputs.bins(columns), y, draw, val, inputs, settings)


def fit_bins(bins: np.ndarray, y: np.ndarray, draw: np.ndarray, val: np.ndarray, inputs: Inputs, settings: Settings) -> Ensemble:
    """``fit_arrays`` of rows that are binned already, by the edges of ``inputs``."""
    base = first_value(y[~val], settings.loss)
    return boost(TaskRows(bins, y, draw, val, base, settings), inputs, base, settings)


# --- Spark -----------------------------------------------------------------------------------


def model_rows(train: DataFrame, val: DataFrame, inputs: Inputs, target: str) -> DataFrame:
    """(x0, x1, ..., y, draw, val): inputs as doubles, the target, a hash of both and the part."""
    def of(rows: DataFrame, part: bool) -> DataFrame:
        xs = [c.alias(f"x{k}") for k, c in enumerate(inputs.columns())]
        rows = rows.filter(F.col(target).isNotNull()).select(*xs, F.col(target).cast("double").alias("y"))
        return rows.withColumn("draw", F.xxhash64(*rows.columns)).withColumn("val", F.lit(part))

    return of(train, False).union(of(val, True))


def arrays_of(table: pa.Table | pa.RecordBatch, width: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    xs = [_values(table, f"x{k}", float("nan")) for k in range(width)]
    return xs, _values(table, "y", float("nan")), _values(table, "draw", 0).astype(np.int64)


def _values(table: pa.Table | pa.RecordBatch, name: str, missing: float) -> np.ndarray:
    column = table.column(table.schema.get_field_index(name))
    return column.fill_null(missing).to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.fill_null(missing).to_numpy()


def _fit_in_task(inputs: Inputs, settings: Settings):
    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(frames)
        if not held:
            return
        table = pa.Table.from_batches(held)
        del held
        # An order that does not depend on the shuffle, so sums come out alike.  Columns become
        # bins one by one, and their doubles go.
        order = pc.sort_indices(table.select(["val", "draw"]), [("val", "ascending"), ("draw", "ascending")]).to_numpy()
        val = table.column("val").to_numpy().astype(bool)[order]
        y, draw = _values(table, "y", float("nan"))[order], _values(table, "draw", 0).astype(np.int64)[order]
        bins, edges = np.zeros((len(y), len(inputs.names)), np.uint8), []
        for at in range(len(inputs.names)):
            values = _values(table, f"x{at}", float("nan"))[order]
            table = table.drop_columns([f"x{at}"])
            if at:
                edges.append(edges_of(values[~val]))
            bins[:, at] = replace(inputs, edges=edges).bins_of(at, values)
        del table, order, values
        pa.default_memory_pool().release_unused()
        rows = fit_bins(bins, y, draw, val, replace(inputs, edges=edges), settings).node_rows()
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.string()]
        names = [part.split()[0] for part in NODES_DDL.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)

    return task


class SparkRows:
    """Rows of one model that stay distributed; every pass is one job over all of them."""

    def __init__(self, rows: DataFrame, inputs: Inputs, base: float, settings: Settings):
        self.spark, self.settings, self.width = rows.sparkSession, settings, len(inputs.names)
        self.trees: list[Tree] = []
        self.path = None
        self._write(rows.mapInArrow(_binned(inputs, base), "bins binary, y double, draw long, val boolean, at double"))

    def _write(self, rows: DataFrame) -> None:
        path, old = shared_folder(self.spark), self.path
        rows.write.parquet(path)
        self.rows, self.path = self.spark.read.schema(rows.schema).parquet(path), path
        if old:
            delete(self.spark, old)

    def close(self) -> None:
        delete(self.spark, self.path)

    def _tables(self, round_: int, splits: list, wanted: list[int]) -> dict[int, np.ndarray]:
        train = self.rows.filter(~F.col("val"))
        made = train.mapInArrow(
            _partial(self.trees, round_, splits, wanted, self.width, self.settings), "node int, code int, s double, n double"
        )
        out = {node: np.zeros((self.width * BINS, 2)) for node in wanted}
        for r in made.groupBy("node", "code").agg(F.sum("s"), F.sum("n")).collect():
            out[r[0]][r[1]] = r[2], r[3]
        return {node: table.reshape(self.width, BINS, 2) for node, table in out.items()}

    def tree(self, round_: int) -> Tree:
        s, splits = self.settings, []
        root = self._tables(round_, [], [0])[0]
        tables = {0: root}

        def children(asked):
            splits.extend(asked)
            out = self._tables(round_, splits, [left for *_, left, _ in asked])
            for node, _, _, left, right in asked:
                out[right] = tables[node] - out[left]
            tables.update(out)
            return out

        tree = compact(grow(root, children, _columns(self.width, round_, s), s, ahead=s.leaves))
        leaves = self.rows.filter(~F.col("val")).mapInArrow(_leaves(self.trees, round_, tree, self.width, s), "leaf int, r double")
        middle = F.percentile_approx("r", 0.5, 100_000) if s.loss == "absolute" else F.avg("r")
        for r in leaves.groupBy("leaf").agg(middle).collect():
            tree.value[r[0]] = s.stepSize * r[1]
        return tree

    def step(self, tree: Tree) -> float:
        self.trees.append(tree)
        if len(self.trees) == WRITE_EVERY:
            self._write(self.rows.mapInArrow(_moved(self.trees, self.width), self.rows.schema))
            self.trees = []
        parts = self.rows.filter("val").mapInArrow(_errors(self.trees, self.width), "e double, n long")
        total = parts.agg(F.sum("e"), F.sum("n")).first()
        return total[0] / total[1] if total[1] else float("nan")


def _binned(inputs: Inputs, base: float):
    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            columns, y, draw = arrays_of(batch, len(inputs.names))
            bins = pa.array([row.tobytes() for row in inputs.bins(columns)], pa.binary())
            arrays = [bins, pa.array(y), pa.array(draw), batch.column(batch.schema.get_field_index("val")), pa.array(np.full(len(y), base))]
            yield pa.RecordBatch.from_arrays(arrays, ["bins", "y", "draw", "val", "at"])

    return task


def _loaded(batch: pa.RecordBatch, trees: list[Tree], width: int):
    bins = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, width)
    y, draw, at = (batch.column(k).to_numpy() for k in (1, 2, 4))
    return bins, y, draw, at + sum(t.predict(bins) for t in trees)


def _partial(trees, round_, splits, wanted, width, settings):
    """Task that routes its rows by the splits so far and adds up those of the wanted nodes."""

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {node: np.zeros((width, BINS, 2)) for node in wanted}
        for batch in frames:
            bins, y, draw, at = _loaded(batch, trees, width)
            taken = _in_sample(draw, round_, settings)
            bins, slope = bins[taken], _slope(y[taken], at[taken], settings.loss)
            place = np.zeros(len(bins), np.int64)
            for node, feature, mask, left, right in splits:
                own = np.flatnonzero(place == node)
                goes = (np.uint64(mask) >> bins[own, feature].astype(np.uint64)) & np.uint64(1) == 1
                place[own] = np.where(goes, left, right)
            for node in wanted:
                own = place == node
                sums[node] += _histogram(bins[own], slope[own])
        for node, table in sums.items():
            flat = table.reshape(-1, 2)
            codes = np.flatnonzero(flat[:, 1])
            arrays = [np.full(len(codes), node, np.int32), codes.astype(np.int32), flat[codes, 0], flat[codes, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["node", "code", "s", "n"])

    return task


def _leaves(trees, round_, tree, width, settings):
    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            bins, y, draw, at = _loaded(batch, trees, width)
            taken = _in_sample(draw, round_, settings)
            leaf = tree.leaf_of(bins[taken]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array((y - at)[taken])], ["leaf", "r"])

    return task


def _moved(trees, width):
    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(_loaded(batch, trees, width)[3])], schema=batch.schema)

    return task


def _errors(trees, width):
    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            _, y, _, at = _loaded(batch, trees, width)
            yield pa.RecordBatch.from_arrays([pa.array([float(np.abs(y - at).sum())]), pa.array([len(y)])], ["e", "n"])

    return task


def _fit_on_spark(rows: DataFrame, inputs: Inputs, settings: Settings) -> Ensemble:
    train = rows.filter(~F.col("val"))
    middle = F.percentile_approx("y", 0.5, 100_000) if settings.loss == "absolute" else F.avg("y")
    number = lambda k: F.when(~F.isnan(f"x{k}"), F.col(f"x{k}"))
    facts = train.agg(
        middle, *[F.percentile_approx(number(k + 1), QUANTILES, 100_000) for k in range(len(inputs.numbers))]
    ).first()
    inputs = replace(inputs, edges=[sorted(set(q or [])) for q in facts[1:]])
    held = SparkRows(rows, inputs, facts[0], settings)
    try:
        return boost(held, inputs, facts[0], settings)
    finally:
        held.close()


def fit(train: DataFrame, val: DataFrame, inputs: Inputs, target: str, settings: Settings, task_rows: int | None = None) -> Ensemble:
    """Fit in one task where all rows fit it, else over all tasks."""
    rows = model_rows(train, val, inputs, target)
    path = shared_folder(train.sparkSession)
    rows.write.parquet(path)
    rows = train.sparkSession.read.schema(rows.schema).parquet(path)
    try:
        counts = {r["val"]: r["count"] for r in rows.groupBy("val").count().collect()}
        if not counts.get(False):
            raise ValueError("no training row has a target")
        if sum(counts.values()) > (TASK_ROWS if task_rows is None else task_rows):
            return _fit_on_spark(rows, inputs, settings)
        return Ensemble.of_rows(rows.coalesce(1).mapInArrow(_fit_in_task(inputs, settings), NODES_DDL).collect())
    finally:
        delete(train.sparkSession, path)


def node_table(spark: SparkSession, model: Ensemble) -> DataFrame:
    """(tree, node, feature, mask, left, right, value, gain, n, head): the model as rows."""
    return spark.createDataFrame(model.node_rows(), NODES_DDL)


def save(spark: SparkSession, model: Ensemble, path: str) -> None:
    node_table(spark, model).coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> Ensemble:
    return Ensemble.of_rows(spark.read.schema(NODES_DDL).parquet(path).collect())


def predicted(model: Ensemble) -> Column:
    """The model's prediction from a frame's columns, in Arrow batches.

    Marked as not deterministic, or a filter on it would compute it again in workers of its own.
    """
    import pandas as pd

    def predict(*columns):
        arrays = [c.to_numpy(np.float64) for c in columns]
        return pd.Series(model.predict(model.inputs.bins(arrays)))

    return F.pandas_udf(predict, "double").asNondeterministic()(*model.inputs.columns())
