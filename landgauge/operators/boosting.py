"""Gradient-boosted regression trees, grown leaf by leaf from histograms that tasks count and Spark adds up.

* Features become bins: at most ``max_bins`` ranges between quantiles of the training rows, and one for missing values.
  The rows are computed once and cached until they are in bins; then they are kept in blocks of bytes, cached where they are.
* A tree grows best first: the leaf of largest gain is split next, until ``leaves`` are there. A job counts, for every leaf that
  may come next, the histograms of the smaller child of its split; the larger one is the parent's less the smaller one's. So a
  tree takes about as many jobs as it is deep, and the result is that of splitting one leaf at a time.
* Tasks send histograms, never rows. Where there are many tasks, histograms are added up in rounds of 16 before the
  driver gets them.
* Squared error from the mean on; a split sends missing values to the better side. Validation rows are scored along with the next
  tree's first histogram; when ``patience`` trees bring no gain, the trees up to the best one stay.

Predictions so far stand in the blocks: a finished tree is added once, and the blocks are cached anew, so that no job walks an older
tree. Every ``RENEWED`` trees a checkpoint cuts the lineage of the cached blocks.

Where all blocks together are no more than ``ONE_TASK_BYTES``, one task holds them and grows all trees in the same way, as the jobs of
a tree would take far longer than their counting.
"""

from __future__ import annotations

import heapq
import pickle
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgauge.session import cut_lineage

#: Much more than a histogram of all looked-at nodes has cells for, so that adding up histograms costs little beside counting.
BLOCK_ROWS = 32_768
RENEWED = 25
#: Histograms of so many tasks are added up at once.
FAN_IN = 16
#: Some five million rows of 13 features. A tree of 64 leaves is ten jobs of 0.2 s at least; one task took 0.2 s a tree at most for a tenth of these rows.
ONE_TASK_BYTES = 160_000_000
BLOCKS = "x binary, y binary, seen binary, base binary"


@dataclass
class Tree:
    """Nodes by number; a leaf has feature -1. ``bin``: values up to it go left. Missing values are bin 0."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def columns(self) -> tuple[list, ...]:
        return self.feature, self.bin, self.missing_left, self.left, self.right, self.value, self.gain

    def add(self) -> int:
        for held, v in zip(self.columns(), (-1, 0, False, 0, 0, 0.0, 0.0)):
            held.append(v)
        return len(self.feature) - 1

    def nodes_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins."""
        at = np.zeros(len(x), np.int32)
        held = [(0, np.arange(len(x)))]
        while held:
            node, rows = held.pop()
            if self.feature[node] < 0:
                at[rows] = node
            elif len(rows):
                b = x[:, self.feature[node]][rows]
                goes_left = b <= self.bin[node]
                if not self.missing_left[node]:
                    goes_left &= b > 0
                held += [(self.left[node], rows[goes_left]), (self.right[node], rows[~goes_left])]
        return at

    def values_of(self, x: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes_of(x)]


@dataclass
class Split:
    gain: float
    feature: int
    bin: int
    missing_left: bool
    rows_left: int


def best_split(hist: np.ndarray, least_rows: int) -> Split | None:
    """The split of largest gain; ``hist`` is (features, bins, 2): sums of residuals and rows, bin 0 for missing values."""
    total, rows = hist[0, :, 0].sum(), hist[0, :, 1].sum()
    known = np.cumsum(hist[:, 1:], axis=1)
    best = None
    for missing_left in (False, True):
        left = known + hist[:, :1] if missing_left else known
        n_left, n_right = left[:, :, 1], rows - left[:, :, 1]
        fine = (n_left >= least_rows) & (n_right >= least_rows)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left[:, :, 0] ** 2 / n_left + (total - left[:, :, 0]) ** 2 / n_right - total**2 / rows
        gain = np.where(fine, gain, -np.inf)
        f, b = np.unravel_index(gain.argmax(), gain.shape)
        if gain[f, b] > 1e-12 and (best is None or gain[f, b] > best.gain):
            best = Split(float(gain[f, b]), int(f), int(b) + 1, missing_left, int(n_left[f, b]))
    return best


def _arrays(row, features: int):
    x = np.frombuffer(row["x"], np.uint8).reshape(features, -1).T
    return x, np.frombuffer(row["y"]), np.frombuffer(row["seen"], bool), np.frombuffer(row["base"])


def _summed(parts: DataFrame) -> DataFrame:
    """One row per partition: the sum of the vectors in it."""

    def work(batches):
        total = None
        for b in batches:
            for held in b.column("h"):
                h = np.frombuffer(held.as_py())
                total = h.copy() if total is None else total + h
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["h"])

    return parts.mapInArrow(work, "h binary")


class Boosting:
    """A fit in progress: blocks of rows with the predictions of all trees so far."""

    def __init__(self, blocks: DataFrame, features: int, bins: int, parts: int):
        self.blocks, self.features, self.bins, self.parts = blocks, features, bins, parts
        self.trees = 0
        self.replaced: DataFrame | None = None  # cached until the blocks that follow are

    def histograms(self, tree: Tree, nodes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(features, bins, 2) of each node, and (rows, squared error) of the validation rows."""
        features, bins = self.features, self.bins
        slots = np.full(len(tree.feature), -1)
        slots[nodes] = np.arange(len(nodes))
        size = len(nodes) * features * bins * 2

        def work(batches):
            total = np.zeros(size + 2)
            held = total[:size].reshape(features, len(nodes) * bins, 2)
            for b in batches:
                for row in b.to_pylist():
                    x, y, seen, base = _arrays(row, features)
                    rest = y - base
                    total[size] += (~seen).sum()
                    total[size + 1] += (rest[~seen] ** 2).sum()
                    slot = np.where(seen, slots[tree.nodes_of(x)], -1)
                    rows = np.flatnonzero(slot >= 0)
                    key, g = slot[rows] * bins, rest[rows]
                    for f in range(features):
                        at = key + x[:, f][rows]
                        held[f, :, 0] += np.bincount(at, weights=g, minlength=len(nodes) * bins)
                        held[f, :, 1] += np.bincount(at, minlength=len(nodes) * bins)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["h"])

        parts, n = self.blocks.mapInArrow(work, "h binary"), self.parts
        while n > FAN_IN:
            n = -(-n // FAN_IN)
            parts = _summed(parts.repartition(n))
        total = sum(np.frombuffer(r["h"]) for r in parts.collect())  # 16 rows at most
        hist = total[:size].reshape(features, len(nodes), bins, 2).transpose(1, 0, 2, 3)
        return hist, total[size:]

    def grow(self, leaves: int, depth: int | None, rate: float, least_rows: int) -> tuple[Tree, np.ndarray]:
        """The next tree, and (rows, squared error) of the validation rows before it."""
        tree = Tree()
        root = tree.add()
        hist, score = self.histograms(tree, [root])
        if self.replaced is not None:
            self.replaced.unpersist()
            self.replaced = None
        hists, depths = {root: hist[0]}, {root: 0}
        splits: dict[int, Split] = {}
        children: dict[int, tuple[int, int]] = {}  # of split nodes and of those looked at ahead
        heap: list[tuple[float, int]] = []

        def offer(node: int) -> None:
            if depth is None or depths[node] < depth:
                split = best_split(hists[node], least_rows)
                if split is not None:
                    splits[node] = split
                    heapq.heappush(heap, (-split.gain, node))

        def look_ahead(nodes: list[int]) -> None:
            """Histograms of the children of these nodes, in one job."""
            ahead = Tree(*[list(held) for held in tree.columns()])
            smaller = []
            for node in nodes:
                s = splits[node]
                pair = (tree.add(), tree.add())
                ahead.add(), ahead.add()
                self._apply(ahead, node, s, pair)
                children[node] = pair
                few = s.rows_left * 2 <= hists[node][0, :, 1].sum()
                smaller.append(pair[0] if few else pair[1])
            got, _ = self.histograms(ahead, smaller)
            for node, child, h in zip(nodes, smaller, got):
                other = sum(children[node]) - child
                hists[child], hists[other] = h, hists[node] - h
                for c in children[node]:
                    depths[c] = depths[node] + 1

        offer(root)
        n = 1
        while heap and n < leaves:
            node = heap[0][1]
            if node not in children:
                # All leaves that the leaves left to split could still reach.
                look_ahead([k for _, k in heapq.nsmallest(leaves - n, heap) if k not in children])
            heapq.heappop(heap)
            self._apply(tree, node, splits[node], children[node])
            n += 1
            for c in children[node]:
                offer(c)
        return self._pruned(tree, hists, rate), score

    @staticmethod
    def _apply(tree: Tree, node: int, s: Split, pair: tuple[int, int]) -> None:
        tree.feature[node], tree.bin[node], tree.missing_left[node] = s.feature, s.bin, s.missing_left
        (tree.left[node], tree.right[node]), tree.gain[node] = pair, s.gain

    @staticmethod
    def _pruned(tree: Tree, hists: dict[int, np.ndarray], rate: float) -> Tree:
        """The tree without nodes that were only looked at; leaves get their mean residual times the rate."""
        out = Tree()

        def copy(node: int) -> int:
            new = out.add()
            if tree.feature[node] < 0:
                total, rows = hists[node][0].sum(axis=0)
                out.value[new] = float(rate * total / rows) if rows else 0.0
            else:
                out.feature[new], out.bin[new], out.missing_left[new] = tree.feature[node], tree.bin[node], tree.missing_left[node]
                out.gain[new] = tree.gain[node]
                out.left[new], out.right[new] = copy(tree.left[node]), copy(tree.right[node])
            return new

        copy(0)
        return out

    def keep(self, tree: Tree) -> None:
        """Add a tree to the predictions. The next job caches the new blocks; the old ones go after it."""
        features, old = self.features, self.blocks

        def work(batches):
            for b in batches:
                rows = b.to_pylist()
                for row in rows:
                    x, _, _, base = _arrays(row, features)
                    row["base"] = (base + tree.values_of(x)).tobytes()
                yield pa.RecordBatch.from_pylist(rows, schema=b.schema)

        added = old.mapInArrow(work, BLOCKS)
        self.trees += 1
        self.blocks = (cut_lineage(added) if self.trees % RENEWED == 0 else added).persist()
        self.replaced = old

    def close(self) -> None:
        for held in (self.blocks, self.replaced):
            if held is not None:
                held.unpersist()


class InOneTask(Boosting):
    """The same fit over blocks held in memory."""

    def __init__(self, rows: list[dict], features: int, bins: int):
        self.features, self.bins, self.replaced = features, bins, None
        held = [_arrays(row, features) for row in rows]
        x, self.y, self.seen, self.base = (np.concatenate(part) for part in zip(*held))
        self.x = np.ascontiguousarray(x.T)
        self.rest, self.rows = self.y - self.base, {}  # rows of the nodes at the ends

    def histograms(self, tree: Tree, nodes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        score = np.zeros(2)
        if len(tree.feature) == 1:
            self.rest = self.y - self.base
            self.rows = {0: np.flatnonzero(self.seen).astype(np.int32)}
            score[:] = (~self.seen).sum(), (self.rest[~self.seen] ** 2).sum()
        parents = {c: p for p, f in enumerate(tree.feature) if f >= 0 for c in (tree.left[p], tree.right[p])}
        hist = np.empty((len(nodes), self.features, self.bins, 2))
        for k, node in enumerate(nodes):
            if node not in self.rows:
                self._parted(tree, parents[node])
            rows = self.rows[node]
            g = self.rest[rows]
            for f in range(self.features):
                at = self.x[f][rows]
                hist[k, f, :, 0] = np.bincount(at, weights=g, minlength=self.bins)
                hist[k, f, :, 1] = np.bincount(at, minlength=self.bins)
        return hist, score

    def _parted(self, tree: Tree, node: int) -> None:
        rows = self.rows.pop(node)
        b = self.x[tree.feature[node]][rows]
        goes_left = b <= tree.bin[node]
        if not tree.missing_left[node]:
            goes_left &= b > 0
        self.rows[tree.left[node]], self.rows[tree.right[node]] = rows[goes_left], rows[~goes_left]

    def keep(self, tree: Tree) -> None:
        self.base += tree.values_of(self.x.T)

    def close(self) -> None:
        self.rows = {}


def _boosted(
    boosting: Boosting, trees: int, leaves: int, depth: int | None, rate: float, least_rows: int, patience: int | None
) -> tuple[list[Tree], list[float]]:
    """All trees, and the root mean squared errors of the validation rows before each."""
    kept, history, best = [], [], 0
    for k in range(trees + 1):
        last = k == trees
        if last and not (patience and history):
            break
        tree, (watched, error) = boosting.grow(1 if last else leaves, depth, rate, least_rows)
        if watched:
            history.append(float(np.sqrt(error / watched)))
            best = int(np.argmin(history))
            if patience and k - best >= patience:
                break
        if last or len(tree.feature) == 1:
            break  # nothing left to split
        kept.append(tree)
        boosting.keep(tree)
    boosting.close()
    return kept[:best] if patience and history else kept, history


@dataclass
class BoostedTrees:
    """Fitted trees with the edges of their bins."""

    features: list[str]
    edges: list[np.ndarray]
    start: float
    trees: list[Tree]
    #: Root mean squared error of the validation rows after so many trees, the mean first; empty without such rows.
    history: list[float] = field(default_factory=list)

    @classmethod
    def fit(
        cls, rows: DataFrame, features: list[str], target: str, validation: str | None = None, trees: int = 1_000, leaves: int = 63,
        depth: int | None = None, rate: float = 0.05, patience: int | None = None, max_bins: int = 255, least_rows: int = 20,
    ) -> BoostedTrees:
        """``validation`` names a boolean column; its rows are watched and not learned from. Rows without target are left out."""
        if not 2 <= max_bins <= 255:
            raise ValueError("2 to 255 bins")
        seen = ~F.coalesce(F.col(validation), F.lit(False)) if validation else F.lit(True)
        data = rows.select(
            *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)], F.col(target).cast("double").alias("y"), seen.alias("seen")
        ).where(F.col("y").isNotNull())
        data = data.persist()  # computed once for the mean, the quantiles and the blocks
        learned = data.where("seen")
        shares = F.array(*[F.lit(k / max_bins) for k in range(1, max_bins)])
        known = [F.percentile_approx(F.nanvl(F.col(f"f{i}"), F.lit(None)), shares, F.lit(20_000)).alias(f"q{i}") for i in range(len(features))]
        row = learned.agg(F.avg("y").alias("start"), *known).first()
        edges = [np.unique(np.array(row[f"q{i}"] or [], np.float64)) for i in range(len(features))]
        model = cls(list(features), edges, float(row["start"] or 0.0), [])
        start, n_features = model.start, len(features)

        def block(batches):
            held, n = [], 0
            for b in batches:
                held.append(b)
                n += b.num_rows
                if n >= BLOCK_ROWS:
                    yield packed(held)
                    held, n = [], 0
            if n:
                yield packed(held)

        def packed(held):
            b = pa.concat_batches(held)
            x = model.binned([b.column(f"f{i}") for i in range(n_features)])
            y, s = b.column("y").to_numpy(), b.column("seen").to_numpy(zero_copy_only=False)
            columns = [x.T.tobytes(), y.tobytes(), s.astype(bool).tobytes(), np.full(len(y), start).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], names=["x", "y", "seen", "base"])

        blocks = data.mapInArrow(block, BLOCKS)
        cores = rows.sparkSession.sparkContext.defaultParallelism
        blocks = cut_lineage(blocks.repartition(cores)).persist() if blocks.rdd.getNumPartitions() < cores else cut_lineage(blocks).persist()
        data.unpersist()
        bins, asked = max(len(e) for e in edges) + 2, (trees, leaves, depth, rate, least_rows, patience)
        held = blocks.agg(sum(F.sum(F.length(c)) for c in blocks.columns)).first()[0]
        if held is None or held > ONE_TASK_BYTES:
            model.trees, model.history = _boosted(Boosting(blocks, n_features, bins, blocks.rdd.getNumPartitions()), *asked)
            return model

        def whole(batches):
            rows = [row for b in batches for row in b.to_pylist()]
            found = pickle.dumps(_boosted(InOneTask(rows, n_features, bins), *asked))
            yield pa.RecordBatch.from_arrays([pa.array([found], pa.binary())], names=["found"])

        model.trees, model.history = pickle.loads(blocks.coalesce(1).mapInArrow(whole, "found binary").first()["found"])
        blocks.unpersist()
        return model

    def binned(self, columns: list[pa.Array]) -> np.ndarray:
        x = np.empty((len(columns), len(columns[0])), np.uint8).T
        for i, (c, edges) in enumerate(zip(columns, self.edges)):
            v = c.to_numpy(zero_copy_only=False).astype(np.float64)
            x[:, i] = np.where(np.isnan(v), 0, np.searchsorted(edges, v) + 1)
        return x

    def transform(self, df: DataFrame, prediction: str) -> DataFrame:
        """Add the prediction; ``df`` keeps its columns. Tasks send the features only, and columns that nobody asks for are not made."""
        model = self
        own = [c for c in df.columns if c != prediction]

        @F.arrow_udf("double")
        def predicted(*columns: pa.Array) -> pa.Array:
            x = model.binned(list(columns))
            total = np.full(len(x), model.start)
            for tree in model.trees:
                total += tree.values_of(x)
            return pa.array(total)

        return df.select(*own, predicted(*[F.col(f).cast("double") for f in self.features]).alias(prediction))

    def importances(self) -> list[tuple[str, float, int]]:
        """Each feature's share of the gain of all splits, and the number of splits that use it."""
        uses, gains = np.zeros(len(self.features), np.int64), np.zeros(len(self.features))
        for tree in self.trees:
            used = np.array(tree.feature)
            inner = used >= 0
            uses += np.bincount(used[inner], minlength=len(uses))
            gains += np.bincount(used[inner], weights=np.array(tree.gain)[inner], minlength=len(uses))
        return list(zip(self.features, (gains / max(gains.sum(), 1e-300)).tolist(), uses.tolist()))

    def save(self, spark: SparkSession, path: str) -> None:
        nodes = [
            (k, i, *node) for k, t in enumerate(self.trees) for i, node in enumerate(zip(*t.columns()))
        ]
        shape = "tree int, node int, feature int, bin int, missing_left boolean, left int, right int, value double, gain double"
        spark.createDataFrame(nodes, shape).write.mode("overwrite").parquet(f"{path}/nodes")
        edges = [(i, f, e.tolist()) for i, (f, e) in enumerate(zip(self.features, self.edges))]
        features = spark.createDataFrame(edges, "place int, feature string, edges array<double>")
        features.write.mode("overwrite").parquet(f"{path}/features")
        one = spark.createDataFrame([(self.start, self.history)], "start double, history array<double>")
        one.write.mode("overwrite").parquet(f"{path}/start")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        features = spark.read.parquet(f"{path}/features").orderBy("place").collect()
        one = spark.read.parquet(f"{path}/start").first()
        trees: list[Tree] = []
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            if r.tree == len(trees):
                trees.append(Tree())
            t = trees[-1]
            for held, v in zip(t.columns(), r[2:]):
                held.append(v)
        return cls([r.feature for r in features], [np.array(r.edges) for r in features], one.start, trees, list(one.history))
