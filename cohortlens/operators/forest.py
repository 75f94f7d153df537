"""Random forests of regression trees over many rows.

The same forest as ``pyspark.ml`` grows (bootstrap by Poisson counts, square root of
the features drawn anew for each node, up to 32 bins a feature, variance reduction, a
tree as deep as asked for) and a ``pyspark.ml`` model in the end; only its random draws
differ.  There, each task touches the statistics of all open nodes of all trees for
every row, and keeps a count and a node of every tree with it.  Here:

1. Rows become one byte a feature.  The bins come from a sample of rows, as there.
2. A *slot* is a part of the rows (at most ``PART_BYTES``) and a group of trees.  A task
   holds its part once and takes one tree after the other, so that the statistics at
   work fit the CPU's cache.  A tree draws its rows by a hash of the row.
3. If the rows are one part, a task grows its trees to the end.  Otherwise the slots
   send statistics level by level; those of a tree are added up and searched for its
   splits in one task, and the driver keeps only the trees.

But for rounding, results do not depend on how rows are dealt over partitions.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.session import scratch_path, stored, stored_table

BINS = 32
SAMPLED = 50_000                # rows that the bins are chosen from
PART_BYTES = 192 << 20          # of the rows that a task holds
AT_ONCE = 1 << 17               # rows summed up at a time
WALKED = 1 << 13                # rows that go through a tree at a time

_CHUNK = "part int, n int, bins binary, y binary, w binary, key binary"
_NODE = ("treeID int, nodeData struct<id:int, prediction:double, impurity:double, impurityStats:array<double>, rawCount:bigint, "
         "gain:double, leftChild:int, rightChild:int, split:struct<featureIndex:int, leftCategoriesOrThreshold:array<double>, "
         "numCategories:int>>")
#: Poisson with mean 1: the chance of at most 0, 1, ... in units of 2**-32.
_POISSON = np.array(np.cumsum(np.exp(-1) / np.cumprod([1, *range(1, 12)])) * 2.0 ** 32, np.uint64).clip(0, 2 ** 32 - 1).astype(np.uint32)


def thresholds(values: np.ndarray) -> np.ndarray:
    """Where the bins of a feature end: between all values if they are few, else near the quantiles."""
    found, count = np.unique(values, return_counts=True)
    middle = found[:-1] + (found[1:] - found[:-1]) / 2
    if len(middle) < BINS:
        return middle
    below = np.cumsum(count)[:-1]
    wanted = np.arange(1, BINS) * (len(values) / BINS)
    at = np.searchsorted(below, wanted).clip(1, len(below) - 1)
    return middle[np.unique(at - (wanted - below[at - 1] <= below[at] - wanted))]


def _checked(batch: pa.RecordBatch, k: int, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Features (n x k), targets (n x t) and weights of a batch without gaps."""
    out = []
    for name, width in (("x", k), ("y", t)):
        flat = batch.column(name).flatten()
        if flat.null_count or len(flat) != batch.num_rows * width:
            raise ValueError(f"{name} must hold {width} numbers without gaps in every row")
        out.append(flat.to_numpy(zero_copy_only=False).reshape(-1, width))
    w = batch.column("w").to_numpy(zero_copy_only=False) if "w" in batch.schema.names else None
    if not all(np.isfinite(v).all() for v in out) or w is not None and not (np.isfinite(w) & (w >= 0)).all():
        raise ValueError("features, targets and weights must be finite, weights not negative")
    return *out, w


def _binned(cuts: list[np.ndarray], t: int, parts: int):
    def run(batches):
        for batch in batches:
            x, y, w = _checked(batch, len(cuts), t)
            bins = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], axis=1).astype(np.uint8)
            key = batch.column("key").to_numpy().view(np.uint64)
            part = (_mixed(key, 0) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
            rows = [(p, np.flatnonzero(part == p)) for p in range(parts)]
            rows = [(p, r) for p, r in rows if len(r)]
            yield pa.RecordBatch.from_arrays([
                pa.array([p for p, _ in rows], pa.int32()), pa.array([len(r) for _, r in rows], pa.int32()),
                pa.array([bins[r].tobytes() for _, r in rows], pa.binary()), pa.array([y[r].tobytes() for _, r in rows], pa.binary()),
                pa.array([None if w is None else w[r].tobytes() for _, r in rows], pa.binary()),
                pa.array([key[r].tobytes() for _, r in rows], pa.binary())], ["part", "n", "bins", "y", "w", "key"])
    return run


def _mixed(key: np.ndarray, salt: int) -> np.ndarray:
    x = key ^ np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & ((1 << 64) - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _slots(batches, k: int, t: int, means: Sequence[float]) -> Iterator[tuple[int, SimpleNamespace]]:
    """(slot, its rows in the order of their keys) of a task."""
    held: dict[int, list] = {}
    for batch in batches:
        for r in batch.to_pylist():
            held.setdefault(r["slot"], []).append(r)
    for slot in sorted(held):
        chunks = held.pop(slot)
        whole = lambda c, kind, width: np.frombuffer(b"".join([x.pop(c) for x in chunks]), kind).reshape(-1, width)
        weighted = chunks[0]["w"] is not None
        key = whole("key", np.uint64, 1).ravel()
        by = np.argsort(key, kind="stable")
        bins, y = whole("bins", np.uint8, k)[by], whole("y", np.float64, t)
        y = [y[by, i] - means[i] for i in range(t)]
        w = whole("w", np.float64, 1).ravel()[by] if weighted else None
        key, at = key[by], np.arange(len(key))
        first = np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), at, 0))
        key = key + (at - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)          # equal rows draw each for itself
        del by, at, first
        yield slot, SimpleNamespace(bins=bins.ravel(), y=y, w=w, key=key, k=k)


def _new_tree() -> SimpleNamespace:
    """Nodes in the order of their making: feature and last bin of the left side, left child (the right one
    follows it; -1: a leaf), and ``front``, the nodes of the last level."""
    return SimpleNamespace(feature=np.zeros(1, np.intp), last=np.zeros(1, np.uint8), left=np.full(1, -1), front=np.zeros(1, np.intp),
                           stats=np.zeros((1, 5)))


def _drawn(rows: SimpleNamespace, seed: int, number: int) -> SimpleNamespace:
    """The rows that a tree draws, with their counts: the same for every target."""
    count = np.empty(len(rows.key), np.uint8)
    for a in range(0, len(count), AT_ONCE):
        h = _mixed(rows.key[a:a + AT_ONCE], (seed << 20) + number + 1) >> np.uint64(32)
        count[a:a + AT_ONCE] = np.searchsorted(_POISSON, h.astype(np.uint32), side="right")
    at = np.flatnonzero(count)
    weight = count[at].astype(np.float64)
    return SimpleNamespace(at=at, base=at * rows.k, count=weight, weight=weight if rows.w is None else weight * rows.w[at])


def _walked(rows: SimpleNamespace, drawn: SimpleNamespace, tree: SimpleNamespace) -> np.ndarray:
    """Of each drawn row its place in the front, -1 if it has come to a leaf."""
    node = np.zeros(len(drawn.at), np.intp)
    while True:
        left = tree.left[node]
        if (left < 0).all():
            break
        below = left + (rows.bins[drawn.base + tree.feature[node]] > tree.last[node])
        node = np.where(left < 0, node, below)
    place = np.full(len(tree.left), -1)
    place[tree.front] = np.arange(len(tree.front))
    return place[node]


def _subset(k: int, m: int, nodes: int, seed: int, number: int, level: int) -> np.ndarray:
    """The features of each node of a level."""
    return np.random.default_rng([seed, number, level]).random((nodes, k)).argsort(axis=1)[:, :m]


def _summed(rows, base, place, count, weight, y, subset: np.ndarray | None, nodes: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Of each node (rows drawn, weight, weighted sum and sum of squares), and by drawn feature and bin the weight and sum."""
    wy = weight * y
    total = np.stack([np.bincount(place, v, nodes) for v in (count, weight, wy, wy * y)], axis=1)
    if subset is None:
        return total, None
    m = subset.shape[1]
    out = np.zeros((2, nodes * m * BINS))
    feature = [np.ascontiguousarray(subset[:, s]) for s in range(m)]
    first = [(np.arange(nodes) * m + s) * BINS for s in range(m)]
    for a in range(0, len(place), AT_ONCE):
        b = a + AT_ONCE
        for s in range(m):
            cell = first[s][place[a:b]] + rows.bins[base[a:b] + feature[s][place[a:b]]]
            out[0] += np.bincount(cell, weight[a:b], out.shape[1])
            out[1] += np.bincount(cell, wy[a:b], out.shape[1])
    return total, out.reshape(2, nodes, m, BINS)


def _best(total: np.ndarray, sums: np.ndarray, subset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, last bin of the left side, gain in variance; 0: no split) of each node."""
    (lw, ls), (rw, rs) = np.cumsum(sums, axis=3)[..., :-1], np.cumsum(sums[..., ::-1], axis=3)[..., -2::-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where((lw > 0) & (rw > 0), ls * ls / lw + rs * rs / rw, -np.inf).reshape(len(total), -1)
        at = score.argmax(axis=1)
        gain = score[np.arange(len(total)), at] - total[:, 2] ** 2 / total[:, 1]
        good = gain > 1e-12 * total[:, 3]
        gain = np.where(good, gain / total[:, 1], 0.0)
    return subset[np.arange(len(total)), at // (BINS - 1)], (at % (BINS - 1)).astype(np.uint8), gain


def _extend(tree: SimpleNamespace, total: np.ndarray, split) -> np.ndarray:
    """Sets the front's statistics and splits, makes its children the front: the first child's place of each old place, or -1."""
    tree.stats[tree.front, :4] = total
    if split is None:
        tree.front = tree.front[:0]
        return np.full(len(total), -1)
    feature, last, gain = split
    child = np.full(len(total), -1)
    split_at = np.flatnonzero(gain > 0)
    child[split_at] = 2 * np.arange(len(split_at))
    n, own = len(tree.left), tree.front[split_at]
    tree.stats[tree.front, 4] = gain
    tree.feature[own], tree.last[own], tree.left[own] = feature[split_at], last[split_at], n + child[split_at]
    more = 2 * len(split_at)
    tree.feature, tree.last = np.append(tree.feature, np.zeros(more, np.intp)), np.append(tree.last, np.zeros(more, np.uint8))
    tree.left, tree.stats = np.append(tree.left, np.full(more, -1)), np.concatenate([tree.stats, np.zeros((more, 5))])
    tree.front = np.arange(n, n + more)
    return child


def _grown(rows: SimpleNamespace, drawn: SimpleNamespace, y: np.ndarray, o: SimpleNamespace, number: int) -> SimpleNamespace:
    """A whole tree on the rows of one part."""
    tree, place = _new_tree(), np.zeros(len(drawn.at), np.intp)
    base, count, weight, y = drawn.base, drawn.count, drawn.weight, y[drawn.at]
    for level in range(o.depth + 1):
        nodes = len(tree.front)
        if not nodes:
            break
        subset = _subset(o.k, o.m, nodes, o.seed, number, level) if level < o.depth else None
        total, sums = _summed(rows, base, place, count, weight, y, subset, nodes)
        split = None if subset is None else _best(total, sums, subset)
        child = _extend(tree, total, split)
        if split is not None:
            for a in range(0, len(place), AT_ONCE):
                here = place[a:a + AT_ONCE]
                below = child[here] + (rows.bins[base[a:a + AT_ONCE] + split[0][here]] > split[1][here])
                place[a:a + AT_ONCE] = np.where(child[here] < 0, -1, below)
            stay = place >= 0
            if not stay.all():
                base, count, weight, y, place = base[stay], count[stay], weight[stay], y[stay], place[stay]
    return tree


def _nodes(tree: SimpleNamespace, number: int, target: int, mean: float, cuts: list[np.ndarray]) -> pa.RecordBatch:
    """The rows of ``_NODE``, with the target before them."""
    raw, w, s, ss, gain = tree.stats.T
    inner = tree.left >= 0
    safe = np.where(w > 0, w, 1.0)
    limit = [float(cuts[f][b]) if i else None for f, b, i in zip(tree.feature.tolist(), tree.last.tolist(), inner.tolist())]
    split = pa.StructArray.from_arrays([
        pa.array(np.where(inner, tree.feature, -1), pa.int32()), pa.array([[] if v is None else [v] for v in limit], pa.list_(pa.float64())),
        pa.array(np.full(len(w), -1), pa.int32())], ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    stats = np.stack([w, s + mean * w, ss + 2 * mean * s + mean * mean * w], axis=1)
    data = pa.StructArray.from_arrays([
        pa.array(np.arange(len(w)), pa.int32()), pa.array(mean + s / safe), pa.array(np.maximum(ss / safe - (s / safe) ** 2, 0.0)),
        pa.array(stats.tolist(), pa.list_(pa.float64())), pa.array(raw.astype(np.int64)), pa.array(np.where(inner, gain, -1.0)),
        pa.array(tree.left, pa.int32()), pa.array(np.where(inner, tree.left + 1, -1), pa.int32()), split],
        ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    fill = lambda v: pa.array(np.full(len(w), v), pa.int32())
    return pa.RecordBatch.from_arrays([fill(target), fill(number), data], ["target", "treeID", "nodeData"])


def _of_group(o: SimpleNamespace, slot: int) -> range:
    return range(slot % o.groups, o.n_trees, o.groups)


def _grow_whole(o: SimpleNamespace):
    def run(batches):
        for slot, rows in _slots(batches, o.k, o.t, o.means):
            for number in _of_group(o, slot):
                drawn = _drawn(rows, o.seed, number)
                for target in range(o.t):
                    yield _nodes(_grown(rows, drawn, rows.y[target], o, number), number, target, o.means[target], o.cuts)
    return run


def _level_sums(o: SimpleNamespace, trees: dict, level: int):
    """The statistics of a level, a row for each slot, target and tree."""
    def run(batches):
        for slot, rows in _slots(batches, o.k, o.t, o.means):
            for number in _of_group(o, slot):
                drawn = _drawn(rows, o.seed, number)
                for target in range(o.t):
                    tree = trees[target, number]
                    nodes = len(tree.front)
                    if not nodes:
                        continue
                    place = _walked(rows, drawn, tree)
                    stay = np.flatnonzero(place >= 0)
                    subset = _subset(o.k, o.m, nodes, o.seed, number, level) if level < o.depth else None
                    total, sums = _summed(rows, drawn.base[stay], place[stay], drawn.count[stay], drawn.weight[stay],
                                          rows.y[target][drawn.at[stay]], subset, nodes)
                    blob = total.tobytes() + (b"" if sums is None else sums.tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([target * o.n_trees + number], pa.int32()), pa.array([slot], pa.int32()),
                                                      pa.array([nodes], pa.int32()), pa.array([blob], pa.binary())],
                                                     ["tree", "slot", "nodes", "sums"])
    return run


def _level_splits(o: SimpleNamespace, level: int):
    """Adds up the statistics of a tree and searches the splits of its front."""
    def run(key, group):
        tree, nodes = key[0].as_py(), group.column("nodes")[0].as_py()
        blobs = zip(group.column("slot").to_pylist(), group.column("sums").to_pylist())
        whole = sum(np.frombuffer(b) for _, b in sorted(blobs, key=lambda r: r[0]))
        total = whole[:4 * nodes].reshape(nodes, 4)
        blob = total.tobytes()
        if level < o.depth:
            subset = _subset(o.k, o.m, nodes, o.seed, tree % o.n_trees, level)
            feature, last, gain = _best(total, whole[4 * nodes:].reshape(2, nodes, o.m, BINS), subset)
            blob += feature.astype(np.float64).tobytes() + last.astype(np.float64).tobytes() + gain.tobytes()
        return pa.table({"tree": pa.array([tree], pa.int32()), "splits": pa.array([blob], pa.binary())})
    return run


def _grow_by_level(slots: DataFrame, o: SimpleNamespace) -> DataFrame:
    trees = {(target, number): _new_tree() for target in range(o.t) for number in range(o.n_trees)}
    for level in range(o.depth + 1):
        sums = slots.mapInArrow(_level_sums(o, trees, level), "tree int, slot int, nodes int, sums binary")
        found = sums.groupBy("tree").applyInArrow(_level_splits(o, level), "tree int, splits binary")
        for r in found.toLocalIterator():
            tree = trees[divmod(r["tree"], o.n_trees)]
            nodes, numbers = len(tree.front), np.frombuffer(r["splits"])
            total, rest = numbers[:4 * nodes].reshape(nodes, 4), numbers[4 * nodes:].reshape(-1, nodes)
            _extend(tree, total, None if level == o.depth else (rest[0].astype(np.intp), rest[1].astype(np.uint8), rest[2]))
        if not any(len(tree.front) for tree in trees.values()):
            break
    groups: dict[int, list] = {}
    for (target, number), tree in trees.items():
        groups.setdefault(number % o.groups, []).append((target, number, tree))

    def run(batches):
        for batch in batches:
            for g in batch.column("id").to_pylist():
                for target, number, tree in groups.get(g, ()):
                    yield _nodes(tree, number, target, o.means[target], o.cuts)
    return slots.sparkSession.range(o.groups).mapInArrow(run, f"target int, {_NODE}")


def _model(nodes: DataFrame, estimator, n_features: int):
    """The ``pyspark.ml`` model of the nodes, through its stored form."""
    from pyspark.ml.regression import RandomForestRegressionModel
    spark, path = nodes.sparkSession, scratch_path(nodes.sparkSession, f"forest-{uuid.uuid4().hex}")
    named = lambda values: {p.name: v for p, v in values.items()}
    n_trees, own = estimator.getNumTrees(), named(estimator._paramMap)
    told = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "defaultParamMap": named(estimator._defaultParamMap)}
    forest = told | {"class": "org.apache.spark.ml.regression.RandomForestRegressionModel", "uid": estimator.uid, "paramMap": own,
                     "numFeatures": n_features, "numTrees": n_trees}
    of_tree = {k: v for k, v in own.items() if k not in ("numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap")}
    defaults = {k: v for k, v in told["defaultParamMap"].items() if k not in ("numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap")}
    tree = told | {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "paramMap": of_tree, "defaultParamMap": defaults}
    spark.createDataFrame([(json.dumps(forest),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame([(i, json.dumps(tree | {"uid": f"dtr_{estimator.uid[-12:]}_{i}"}), 1.0) for i in range(n_trees)],
                          "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes.write.parquet(f"{path}/data")
    model = RandomForestRegressionModel.load(path)
    model.walks = _walks(spark.read.schema(nodes.schema).parquet(f"{path}/data"))
    return model


def _walks(nodes: DataFrame) -> SimpleNamespace:
    """All nodes of a forest as arrays: the trees' roots, and of a node its feature, limit, left child (the right
    one follows it) and prediction; a leaf leads to itself."""
    of = nodes.select("treeID", *[F.col(f"nodeData.{c}").alias(c) for c in ("id", "prediction", "leftChild")],
                      F.col("nodeData.split.featureIndex").alias("feature"),
                      F.coalesce(F.get("nodeData.split.leftCategoriesOrThreshold", 0), F.lit(np.inf)).alias("limit")).toArrow()
    columns = {c: of.column(c).to_numpy() for c in of.column_names}
    by = np.lexsort((columns["id"], columns["treeID"]))
    columns = {c: v[by] for c, v in columns.items()}
    roots = np.flatnonzero(columns["id"] == 0)
    first, at = roots.repeat(np.diff(np.append(roots, len(by)))), np.arange(len(by))
    leaf = columns["leftChild"] < 0
    return SimpleNamespace(roots=roots.tolist(), feature=np.where(leaf, 0, columns["feature"]).astype(np.intp), limit=columns["limit"],
                           left=np.where(leaf, at, first + columns["leftChild"]), prediction=columns["prediction"])


def _prediction(walks: SimpleNamespace, x: np.ndarray) -> np.ndarray:
    """Mean over trees of the leaf that each row (n x k) comes to, one tree after the other."""
    n, k = x.shape
    flat, base, total = np.where(np.isnan(x), np.inf, x).ravel(), np.arange(n) * k, np.zeros(n)     # NaN goes right, as there
    for root in walks.roots:
        node = np.full(n, root)
        while True:
            below = walks.left[node]
            below += ~(flat[base + walks.feature[node]] <= walks.limit[node])
            if np.array_equal(below, node):
                break
            node = below
        total += walks.prediction[node]
    return total / len(walks.roots)


def predict(models: list, rows: DataFrame, targets: Sequence[str]) -> DataFrame:
    """``rows`` without x and y, with ``{t}_pred`` of each model that ``fit`` made: what ``transform`` gives.  That takes
    a row through all trees, so it has nearly every node to fetch anew; here a batch goes through one tree at a time."""
    kept = [c for c in rows.columns if c not in ("x", "y")]
    names = [f"{t}_pred" for t in targets]
    all_walks = [m.walks for m in models]

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, WALKED):
                part = batch.slice(a, WALKED)
                lists = part.column("x")
                flat = lists.flatten()
                if lists.null_count or flat.null_count or len(flat) % part.num_rows:
                    raise ValueError("x must hold as many numbers in every row, without gaps")
                x = flat.to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *[pa.array(_prediction(w, x)) for w in all_walks]],
                                                 [*kept, *names])
    from pyspark.sql.types import DoubleType, StructType
    schema = StructType([rows.schema[c] for c in kept])
    for name in names:
        schema = schema.add(name, DoubleType())
    return rows.select("x", *kept).mapInArrow(run, schema)


def _dealt(slots: DataFrame, n: int) -> DataFrame:
    """Each of the ``n`` slots in a partition of its own: by numbers that hash to different partitions."""
    own = slots.sparkSession.range(0, 64 * n, 1, 1).select(F.col("id").cast("int").alias("place")).groupBy(
        F.pmod(F.hash("place"), F.lit(n)).alias("at")).agg(F.min("place").alias("place")).collect()
    of = {r["at"]: r["place"] for r in own}
    places = F.array(*[F.lit(of.get(i, i)) for i in range(n)])
    return slots.withColumn("place", F.get(places, F.col("slot"))).repartition(n, "place").drop("place")


def fit(rows: DataFrame, n_rows: int, n_targets: int, estimators: list, weight_col: str | None = None) -> list:
    """One forest per target, with the settings of the ``pyspark.ml`` estimators (the same but for the label) on
    prepared rows (x, y, further columns), which are read several times."""
    settings, spark = estimators[0], rows.sparkSession
    key = F.xxhash64(*rows.columns).alias("key")
    data = rows.select("x", "y", *([F.col(weight_col).cast("double").alias("w")] if weight_col else []), key)
    chosen = F.pmod(F.xxhash64(F.lit("bins"), *rows.columns), F.lit(1 << 20)) < F.lit(int(min(1.0, SAMPLED / n_rows) * (1 << 20)) + 1)
    sample = rows.filter(chosen).select("x").collect()
    x = np.array([r["x"] for r in sample], np.float64)
    if not len(x) or not np.isfinite(x).all():
        raise ValueError("features must be finite numbers")
    k, n_trees, cores = x.shape[1], settings.getNumTrees(), max(1, spark.sparkContext.defaultParallelism)
    means = data.agg(*[F.avg(F.get("y", i)).alias(f"y{i}") for i in range(n_targets)]).first()
    parts = -(-n_rows * (k + 8 * n_targets + 8 + 8 * bool(weight_col)) // PART_BYTES)
    o = SimpleNamespace(cuts=[thresholds(x[:, j]) for j in range(k)], k=k, t=n_targets, m=int(np.ceil(np.sqrt(k))), n_trees=n_trees,
                        groups=min(n_trees, -(-cores // parts)), depth=settings.getMaxDepth(), seed=settings.getSeed() & 0xFFFFFFFF,
                        means=[v or 0.0 for v in means])
    binned = stored(data.mapInArrow(_binned(o.cuts, n_targets, parts), _CHUNK))
    slots = binned.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(o.groups - 1)))).withColumn(
        "slot", (F.col("part") * o.groups + F.col("g")).cast("int")).drop("part", "g")
    slots = _dealt(slots, parts * o.groups)
    if parts == 1:
        nodes = slots.mapInArrow(_grow_whole(o), f"target int, {_NODE}")
    else:
        nodes = _grow_by_level(stored(slots), o)
    nodes = stored_table(nodes, "forest-nodes")
    return [_model(nodes.filter(F.col("target") == i).drop("target"), e, k) for i, e in enumerate(estimators)]
