"""Runs in pieces of time: correlation, shrunk correlation and confound regression.

The rows of a run meet by (run, piece of time points) in one exchange; a task
reads time points one batch after the other and keeps only moments (or a
triangular factor) of each of its runs.  These are merged per run and region,
so neither a run of any length nor the number of its pieces has to fit into a
task.  What is held is bounded by the regions of the atlas and the confounds.

Edge cases: rows without a time point or region are left out; a region twice at
one time point is an error; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_POINTS = 2048          # time points of a piece, if they are numbered one by one

NEGLIGIBLE = 1e-10           # share of a column's sum of squares that counts as rounding
ROUNDING = 1e-24             # the same for a column that is constant but for its last digits


def time_points(signal: DataFrame, run_keys: Sequence[str], t: str, roi: str, value: str,
                piece_points: int = PIECE_POINTS, confounds: DataFrame | None = None,
                confound_cols: Sequence[str] = ()) -> DataFrame:
    """One row per (run, t): its piece, regions and values in the order of the regions and,
    if given, the run's confounds (array) with the number of their rows.  One exchange."""
    keys, kinds = list(run_keys), dict(signal.dtypes)
    piece = F.floor(F.col(t).cast("double") / piece_points)
    cell = F.struct(F.col(roi).alias("roi"), F.col(value).cast("double").alias("value"))
    rows = signal.where(F.col(t).isNotNull() & F.col(roi).isNotNull()).select(
        *keys, F.col(t).alias("__t"), piece.alias("__piece"), cell.alias("__v"))
    taken = []
    if confounds is not None:
        none = F.lit(None).cast(dict(rows.dtypes)["__v"])
        rows = rows.withColumn("__c", F.lit(None).cast("array<double>")).unionByName(
            confounds.where(F.col(t).isNotNull()).select(
                *[F.col(k).cast(kinds[k]).alias(k) for k in keys], F.col(t).cast(kinds[t]).alias("__t"),
                piece.alias("__piece"), none.alias("__v"),
                F.array(*[F.col(c).cast("double") for c in confound_cols]).alias("__c")))
        taken = [F.first("__c", ignorenulls=True).alias("__c"), F.count("__c").alias("__n")]
    points = rows.repartition(*keys, "__piece").groupBy(*keys, "__piece", "__t").agg(
        F.array_sort(F.collect_list("__v")).alias("__v"), *taken).where(F.size("__v") > 0)
    return points.select(*keys, "__piece", "__t", F.col("__v.roi").alias("__rois"),
                         F.col("__v.value").alias("__values"), *(["__c", "__n"] if taken else []))


def _segments(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Consecutive rows of a batch with equal keys; rows are sorted by the keys."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        new = np.zeros(n, bool)
        new[0] = True
        for k in keys:
            codes = batch.column(k).dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
            new[1:] |= codes[1:] != codes[:-1]
        starts = np.flatnonzero(new).tolist()
        for a, b in zip(starts, [*starts[1:], n]):
            yield tuple(batch.column(k)[a].as_py() for k in keys), batch.slice(a, b - a)


def _reduced(batches: Iterable[pa.RecordBatch], keys: Sequence[str], part: Callable, merge: Callable,
             label: str) -> Iterator[tuple[tuple, int, object]]:
    """``part`` of every segment, merged over neighbouring segments of one key, with the first ``label``."""
    held, first, state = None, None, None
    for key, rows in _segments(batches, keys):
        found = part(key, rows)
        if held is not None and key != held:
            yield held, first, state
            state = None
        if state is None:
            held, first, state = key, rows.column(label)[0].as_py(), found
        else:
            state = merge(state, found)
    if held is not None:
        yield held, first, state


def _matrix(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Regions, values (time points x regions, gaps as NaN), and which cells have a row (None: all)."""
    sizes = pc.list_value_length(rows.column("__rois")).to_numpy(zero_copy_only=False)
    ids = rows.column("__rois").flatten().to_numpy(zero_copy_only=False)
    x = rows.column("__values").flatten().to_numpy(zero_copy_only=False)
    width = int(sizes[0])
    if (sizes == width).all() and (ids.reshape(-1, width) == ids[:width]).all():
        if (ids[1:width] == ids[:width - 1]).any():
            raise ValueError("a region has two rows at one time point")
        return ids[:width], x.reshape(-1, width), None
    names, of = np.unique(ids, return_inverse=True)
    at = np.repeat(np.arange(len(sizes)), sizes)
    here = np.zeros((len(sizes), len(names)), bool)
    here[at, of] = True
    if here.sum() != len(ids):
        raise ValueError("a region has two rows at one time point")
    full = np.full(here.shape, np.nan)
    full[at, of] = x
    return names, full, here


def _kinds(df: DataFrame, names: Sequence[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"`{k}` {kinds[k]}" for k in names)


def _table(key: tuple, keys: Sequence[str], columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    columns = {**{k: [v] * n for k, v in zip(keys, key)}, **columns}
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


# ---------------------------------------------------------------- correlation (AGG1)

def _pair_moments(names: np.ndarray, x: np.ndarray, here: np.ndarray | None) -> tuple:
    """For region i (row) and j (column) over the time points where both have a value: their
    number, mean and sum of squares of i, co-moment; and whether both have a row at all."""
    mask = ~np.isnan(x)
    count = mask.sum(axis=0)
    shift = np.where(mask, x, 0.0).sum(axis=0) / np.maximum(count, 1)
    d = np.where(mask, x - shift, 0.0)
    if mask.all():
        shape = (len(names), len(names))
        n, s, ss, c = np.full(shape, float(len(x))), np.broadcast_to(d.sum(axis=0)[:, None], shape), \
            np.broadcast_to((d * d).sum(axis=0)[:, None], shape), d.T @ d
    else:
        m = mask.astype(float)
        n, s, ss, c = m.T @ m, d.T @ m, (d * d).T @ m, d.T @ d
    mean = s / np.maximum(n, 1.0)
    v = ss - s * mean
    seen = np.ones(n.shape, bool) if here is None else (here.astype(np.float32).T @ here.astype(np.float32)) > 0
    return names, n, mean + shift[:, None], np.where(v > 1e-12 * ss, v, 0.0), c - s * mean.T, seen


def _spread(part: tuple, names: np.ndarray) -> tuple:
    """The moments laid out for more regions; new pairs have no time point."""
    at = np.searchsorted(names, part[0])
    out = [names]
    for m in part[1:]:
        wide = np.zeros((len(names), len(names)), m.dtype)
        wide[np.ix_(at, at)] = m
        out.append(wide)
    return tuple(out)


def _merge_pairs(a: tuple, b: tuple) -> tuple:
    if len(a[0]) != len(b[0]) or (a[0] != b[0]).any():
        names = np.union1d(a[0], b[0])
        a, b = _spread(a, names), _spread(b, names)
    n = a[1] + b[1]
    share = b[1] / np.maximum(n, 1.0)
    d, f = b[2] - a[2], a[1] * share
    return a[0], n, a[2] + d * share, a[3] + b[3] + f * d * d, a[4] + b[4] + f * d * d.T, a[5] | b[5]


def _merge_vectors(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows n, mean of i, mean of j, squares of i, squares of j, co-moment of a region's pairs."""
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1.0)
    di, dj, f = b[1] - a[1], b[2] - a[2], a[0] * share
    return np.stack([n, a[1] + di * share, a[2] + dj * share, a[3] + b[3] + f * di * di,
                     a[4] + b[4] + f * dj * dj, a[5] + b[5] + f * di * dj])


def correlation(signal: DataFrame, run_keys: Sequence[str], t: str, roi: str, value: str,
                piece_points: int = PIECE_POINTS) -> DataFrame:
    """Edges (run, i, j, r), i < j, of all pairs of regions with rows at a common time point."""
    keys = list(run_keys)
    spark, kind = signal.sparkSession, dict(signal.dtypes)[roi]
    fields = ["n", "mi", "mj", "vi", "vj", "c"]
    part_ddl = f"{_kinds(signal, keys)}, i {kind}, part long, j array<{kind}>, " + ", ".join(
        f"{f} array<double>" for f in fields)
    edge_ddl = f"{_kinds(signal, keys)}, i {kind}, j {kind}, r double"
    part_schema, edge_schema = _arrow(spark, part_ddl), _arrow(spark, edge_ddl)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part(key, rows):
            return _pair_moments(*_matrix(rows))

        for key, first, (names, n, mean, v, c, seen) in _reduced(batches, keys, part, _merge_pairs, "__piece"):
            columns = {f: [] for f in ["i", "part", "j", *fields]}
            for i in range(len(names) - 1):
                j = i + 1 + np.flatnonzero(seen[i, i + 1:])
                if len(j):
                    for f, a in zip(columns, [names[i], first, names[j], n[i, j], mean[i, j], mean[j, i], v[i, j],
                                              v[j, i], c[i, j]]):
                        columns[f].append(a)
            if columns["i"]:
                yield _table(key, keys, columns, part_schema)

    def lists(rows, name):
        return rows.column(name).flatten().to_numpy(zero_copy_only=False)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part(key, rows):
            sizes = pc.list_value_length(rows.column("j")).to_numpy(zero_copy_only=False)
            j, m = lists(rows, "j"), np.stack([lists(rows, f) for f in fields])
            ends = np.cumsum(sizes)
            state = None
            for a, b in zip(ends - sizes, ends):
                found = (j[a:b], m[:, a:b])
                state = found if state is None else merge(state, found)
            return state

        def merge(a, b):
            if len(a[0]) != len(b[0]) or (a[0] != b[0]).any():
                names = np.union1d(a[0], b[0])
                wide = [np.zeros((len(fields), len(names))) for _ in range(2)]
                for w, (j, m) in zip(wide, (a, b)):
                    w[:, np.searchsorted(names, j)] = m
                return names, _merge_vectors(*wide)
            return a[0], _merge_vectors(a[1], b[1])

        for key, _, (j, (n, mi, mj, vi, vj, c)) in _reduced(batches, [*keys, "i"], part, merge, "part"):
            flat = (vi <= ROUNDING * n * mi * mi) | (vj <= ROUNDING * n * mj * mj) | (n < 2)
            r = np.where(flat, np.nan, c / np.sqrt(np.where(flat, 1.0, vi * vj)))
            yield _table(key[:-1], keys, {"i": [key[-1]] * len(j), "j": j, "r": r}, edge_schema)

    points = time_points(signal, keys, t, roi, value, piece_points).sortWithinPartitions(*keys, "__piece")
    found = points.mapInArrow(parts, part_ddl)
    found = found.repartition(*keys, "i").sortWithinPartitions(*keys, "i", "part")
    edges = found.mapInArrow(merged, edge_ddl)
    return edges.withColumn("r", F.when(~F.isnan("r"), F.col("r")))


# ---------------------------------------------------------------- shrunk correlation (AGG2)

def shrunk_correlation(signal: DataFrame, run_keys: Sequence[str], t: str, roi: str, value: str,
                       piece_points: int = PIECE_POINTS) -> DataFrame:
    """Ledoit-Wolf shrunk correlation, edges (run, i, j, r) with i < j; a gap is an error.

    With y a time point less the mean of its part, the sums n, Σ y yᵀ, Σ |y|², Σ |y|² y
    and Σ |y|⁴ move to another centre in closed form, so Σ_t (Σ_i x²)² needs no second
    pass.  A merge works on one region's row of the matrix, its entry of Σ |y|² y and
    its share of Σ |y|⁴; the p rows of a run then give its edges."""
    keys = list(run_keys)
    spark, kind = signal.sparkSession, dict(signal.dtypes)[roi]
    ddl = (f"{_kinds(signal, keys)}, i {kind}, part long, place int, names array<{kind}>, n double, "
           "mean array<double>, g array<double>, a double, v double, s double, si double")
    edge_ddl = f"{_kinds(signal, keys)}, i {kind}, j {kind}, r double"
    schema, edge_schema = _arrow(spark, ddl), _arrow(spark, edge_ddl)

    def same(a, b):
        if len(a) != len(b) or (a != b).any():
            raise ValueError("shrunk correlation needs a value of every region at every time point")

    def moved(n, g, a, v, s, d):
        """The sums around another centre, d away from the mean."""
        gd, dd = g @ d, d @ d
        return (g + n * np.outer(d, d), a + n * dd, v - d * a - 2.0 * gd - n * dd * d,
                s + 4.0 * (d @ gd) + n * dd * dd - 4.0 * (d @ v) + 2.0 * dd * a)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part(key, rows):
            names, x, here = _matrix(rows)
            if here is not None or np.isnan(x).any():
                raise ValueError("shrunk correlation needs a value of every region at every time point")
            mean = x.mean(axis=0)
            y = x - mean
            q = (y * y).sum(axis=1)
            return names, float(len(x)), mean, y.T @ y, q.sum(), q @ y, q @ q

        def merge(one, two):
            same(one[0], two[0])
            n = one[1] + two[1]
            mean = one[2] + (two[2] - one[2]) * (two[1] / n)
            sums = [moved(p[1], *p[3:], mean - p[2]) for p in (one, two)]
            return one[0], n, mean, *(a + b for a, b in zip(*sums))

        for key, first, (names, n, mean, g, a, v, s) in _reduced(batches, keys, part, merge, "__piece"):
            p = len(names)
            yield _table(key, keys, {
                "i": names, "part": [first] * p, "place": list(range(p)), "names": [names] * p, "n": [n] * p,
                "mean": [mean] * p, "g": list(g), "a": [a] * p, "v": v, "s": [s] * p, "si": [0.0] * p}, schema)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part(key, rows):
            state = None
            vectors = [[np.asarray(x.values.to_numpy(zero_copy_only=False)) for x in rows.column(f)]
                       for f in ("names", "mean", "g")]
            scalars = [rows.column(f).to_pylist() for f in ("place", "n", "a", "v", "s", "si")]
            for names, mean, g, place, n, a, v, s, si in zip(*vectors, *scalars):
                found = (names, place, n, mean, g, a, v, s, si)
                state = found if state is None else merge(state, found)
            return state

        def merge(one, two):
            same(one[0], two[0])
            n, k = one[2] + two[2], one[1]
            mean = one[3] + (two[3] - one[3]) * (two[2] / n)
            out = [0.0] * 5
            for _, _, m, centre, g, a, v, s, si in (one, two):
                d = mean - centre
                gd, dd = g @ d, d @ d
                new = (g + m * d[k] * d, a + m * dd, v - d[k] * a - 2.0 * gd - m * dd * d[k],
                       s + m * dd * dd + 2.0 * dd * a, si + 4.0 * d[k] * gd - 4.0 * d[k] * v)
                out = [x + y for x, y in zip(out, new)]
            return one[0], k, n, mean, *out

        for key, _, (names, k, n, mean, g, a, v, s, si) in _reduced(batches, [*keys, "i"], part, merge, "part"):
            yield _table(key[:-1], keys, {"i": [key[-1]], "part": [0], "place": [k], "names": [names], "n": [n],
                                          "mean": [mean], "g": [g], "a": [a], "v": [v], "s": [s], "si": [si]}, schema)

    def edges(key, rows):
        by = rows.sort_by("place")
        names = by.column("i").to_numpy()
        if any(len(x) != len(names) for x in by.column("names").to_pylist()):
            raise ValueError("shrunk correlation needs a value of every region at every time point")
        n, p = by.column("n")[0].as_py(), len(names)
        cov = np.array(by.column("g").to_pylist()).reshape(p, p) / n
        squares4 = by.column("s")[0].as_py() + sum(by.column("si").to_pylist())
        mu, squares = np.trace(cov) / p, (cov * cov).sum()
        delta = (squares - 2.0 * mu * np.trace(cov) + p * mu * mu) / p
        beta = min((squares4 / n - squares) / (p * n), delta)
        shrink = 0.0 if beta == 0 else beta / delta
        cov = (1.0 - shrink) * cov + shrink * mu * np.eye(p)
        sd = np.sqrt(np.diag(cov))
        with np.errstate(divide="ignore", invalid="ignore"):
            r = cov / np.outer(sd, sd)
        i, j = np.triu_indices(p, 1)
        return pa.Table.from_batches([_table(tuple(x.as_py() for x in key), keys, {
            "i": names[i], "j": names[j], "r": np.where(np.isfinite(r[i, j]), r[i, j], np.nan)}, edge_schema)])

    points = time_points(signal, keys, t, roi, value, piece_points).sortWithinPartitions(*keys, "__piece")
    found = points.mapInArrow(parts, ddl).repartition(*keys, "i").sortWithinPartitions(*keys, "i", "part")
    out = found.mapInArrow(merged, ddl).groupBy(*keys).applyInArrow(edges, edge_ddl)
    return out.withColumn("r", F.when(~F.isnan("r"), F.col("r")))


# ---------------------------------------------------------------- confound regression (SIG3)

def _without(cols: np.ndarray, w: np.ndarray, q: np.ndarray, wq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns and their weights without the part along the unit vector q; twice is enough for rounding."""
    for _ in range(2):
        share = q @ cols
        cols, w = cols - np.outer(q, share), w - np.outer(wq, share)
    return cols, w


def _coefficients(r: np.ndarray, z: np.ndarray, m2: np.ndarray, detrend: bool) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the columns (1, t, confounds) in the fit of each region, and whether more than
    rounding is left of it.  ``r`` stands for the columns and ``z`` for the regions: they have
    the inner products that the columns and regions of the whole run have."""
    k = r.shape[1]
    eye = np.eye(k)
    size = np.sqrt(r[:, 0] @ r[:, 0])
    one, w_one = r[:, 0] / size, eye[:, 0] / size
    cols, w = _without(r[:, 1:], eye[:, 1:], one, w_one)
    small = (cols * cols).sum(axis=0) <= ROUNDING * (r[:, 1:] * r[:, 1:]).sum(axis=0)
    cols, w = np.where(small, 0.0, cols), np.where(small, 0.0, w)
    time, w_time, cols, w = cols[:, 0], w[:, 0], cols[:, 1:], w[:, 1:]
    total = (cols * cols).sum(axis=0)
    if detrend and time.any():
        size = np.sqrt(time @ time)
        cols, w = _without(cols, w, time / size, w_time / size)
    left = (cols * cols).sum(axis=0)
    used = [(one, w_one)]
    explained = np.zeros(z.shape[1])
    beta = np.outer(w_one, one @ z)
    for c in np.flatnonzero(left > NEGLIGIBLE * total):
        col, wc = cols[:, [c]], w[:, [c]]
        for _ in range(2):
            for q, wq in used:
                col, wc = _without(col, wc, q, wq)
        rest = float((col * col).sum())
        if rest > NEGLIGIBLE * left[c]:
            q, wq = col[:, 0] / np.sqrt(rest), wc[:, 0] / np.sqrt(rest)
            used.append((q, wq))
            share = q @ z
            explained += share * share
            beta += np.outer(wq, share)
    return beta, m2 - explained > NEGLIGIBLE * m2


def regress(signal: DataFrame, confounds: DataFrame, run_keys: Sequence[str], confound_cols: Sequence[str],
            t: str, roi: str, value: str, detrend: bool = True, piece_points: int = PIECE_POINTS,
            region_block: int = 64) -> DataFrame:
    """Residual of every region's series after least squares on 1 and the run's confounds
    (with ``detrend``: without their line over time), in the pieces of the run.

    A tall-skinny QR: each task factorises the columns (1, t, confounds) of its time points
    and keeps the triangle with the regions' coordinates; triangles of one run are stacked
    and factorised again, ``region_block`` regions to a row.  Everything else, also which
    confounds add nothing, is decided on the last triangle.  The weights then meet every
    piece of their run."""
    keys, k = list(run_keys), len(confound_cols) + 2
    spark, kind, t_kind = signal.sparkSession, dict(signal.dtypes)[roi], dict(signal.dtypes)[t]
    ddl = (f"{_kinds(signal, keys)}, block int, part long, names array<{kind}>, r array<double>, z array<double>, "
           "n double, mean array<double>, m2 array<double>")
    fit_ddl = f"{_kinds(signal, keys)}, names array<{kind}>, beta array<double>, rest array<boolean>"
    out_ddl = f"{_kinds(signal, keys)}, `{t}` {t_kind}, `{roi}` {kind}, `{value}` double"
    schema, fit_schema, out_schema = (_arrow(spark, d) for d in (ddl, fit_ddl, out_ddl))

    def design(key, rows):
        names, y, here = _matrix(rows)
        if (rows.column("__n").to_numpy(zero_copy_only=False) != 1).any():
            raise ValueError(f"run {key}: every time point needs one row of confounds")
        c = rows.column("__c").flatten().to_numpy(zero_copy_only=False).reshape(-1, k - 2)
        if here is not None or np.isnan(y).any() or np.isnan(c).any():
            raise ValueError(f"run {key}: signal and confounds need a value at every time point")
        times = rows.column("__t").cast(pa.float64()).to_numpy(zero_copy_only=False)
        return names, y, np.column_stack([np.ones(len(y)), times, c])

    def merge(a, b):
        if len(a[0]) != len(b[0]) or (a[0] != b[0]).any():
            raise ValueError("confound regression needs a value of every region at every time point")
        q, r = np.linalg.qr(np.vstack([a[1], b[1]]))
        n = a[3] + b[3]
        d = b[4] - a[4]
        return a[0], r, q.T @ np.vstack([a[2], b[2]]), n, a[4] + d * (b[3] / n), a[5] + b[5] + d * d * (a[3] * b[3] / n)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part(key, rows):
            names, y, x = design(key, rows)
            q, r = np.linalg.qr(x)
            mean = y.mean(axis=0)
            return names, r, q.T @ y, float(len(y)), mean, ((y - mean) ** 2).sum(axis=0)

        for key, first, (names, r, z, n, mean, m2) in _reduced(batches, keys, part, merge, "__piece"):
            cuts = [slice(a, a + region_block) for a in range(0, len(names), region_block)]
            yield _table(key, keys, {
                "block": list(range(len(cuts))), "part": [first] * len(cuts), "names": [names[c] for c in cuts],
                "r": [r.ravel()] * len(cuts), "z": [z[:, c].ravel() for c in cuts], "n": [n] * len(cuts),
                "mean": [mean[c] for c in cuts], "m2": [m2[c] for c in cuts]}, schema)

    def fits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part(key, rows):
            state = None
            for row in range(rows.num_rows):
                names, r, z, mean, m2 = (rows.column(f)[row].values.to_numpy(zero_copy_only=False)
                                         for f in ("names", "r", "z", "mean", "m2"))
                found = (names, r.reshape(-1, k), z.reshape(-1, len(names)), rows.column("n")[row].as_py(), mean, m2)
                state = found if state is None else merge(state, found)
            return state

        for key, _, (names, r, z, _, _, m2) in _reduced(batches, [*keys, "block"], part, merge, "part"):
            beta, rest = _coefficients(r, z, m2, detrend)
            yield _table(key[:-1], keys, {"names": [names], "beta": [beta.ravel()], "rest": [rest]}, fit_schema)

    def residuals(key, rows, fit):
        if not rows.num_rows:
            return out_schema.empty_table()
        whole = tuple(x.as_py() for x in key)[:-1]
        points = rows.combine_chunks().to_batches()[0]
        names, y, x = design(whole, points)
        e, known = np.empty_like(y), np.zeros(len(names), bool)
        for row in fit.to_pylist():
            at = np.searchsorted(names, np.array(row["names"]))
            beta = np.array(row["beta"]).reshape(k, len(at))
            e[:, at] = np.where(row["rest"], y[:, at] - x @ beta, 0.0)
            known[at] = True
        if not known.all():
            raise ValueError("confound regression needs a value of every region at every time point")
        times = points.column("__t").take(pa.array(np.repeat(np.arange(len(y)), len(names))))
        found = {**{n: pa.array([v] * e.size, out_schema.field(n).type) for n, v in zip(keys, whole)}, t: times,
                 roi: pa.array(np.tile(names, len(y)), out_schema.field(roi).type), value: pa.array(e.ravel())}
        return pa.Table.from_arrays([found[f.name] for f in out_schema], schema=out_schema)

    points = time_points(signal, keys, t, roi, value, piece_points, confounds, confound_cols)
    found = points.sortWithinPartitions(*keys, "__piece").mapInArrow(parts, ddl)
    fitted = found.repartition(*keys, "block").sortWithinPartitions(*keys, "block", "part").mapInArrow(fits, fit_ddl)
    own = [f"__{n}" for n in keys]
    pieces = signal.where(F.col(t).isNotNull() & F.col(roi).isNotNull()).select(
        *[F.col(n).alias(o) for n, o in zip(keys, own)],
        F.floor(F.col(t).cast("double") / piece_points).alias("__at")).distinct()
    weights = pieces.join(fitted, [F.col(o).eqNullSafe(F.col(n)) for n, o in zip(keys, own)]).select(
        *own, "__at", "names", "beta", "rest")
    return points.groupBy(*keys, "__piece").cogroup(weights.groupBy(*own, "__at")).applyInArrow(residuals, out_ddl)


# ---------------------------------------------------------------- whole series, one after the other

def by_series(df: DataFrame, series_keys: Sequence[str], t: str, value: str,
              change: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``df`` with ``value`` replaced by ``change`` of each series in the order of ``t``.

    Series are sorted by the exchange and read from the stream of their task, many to a
    batch; only the series at hand is kept."""
    keys, schema = list(series_keys), df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = schema.names.index(value)

        def changed(pieces):
            x = np.concatenate([p.column(place).cast(pa.float64()).to_numpy(zero_copy_only=False) for p in pieces])
            y, a, out = change(x), 0, []
            for p in pieces:
                new = pa.array(y[a:a + p.num_rows]).cast(p.schema.field(place).type)
                out.append(p.set_column(place, p.schema.field(place), new))
                a += p.num_rows
            return out

        held, pieces, done = None, [], []
        for batch in batches:
            for key, rows in _segments([batch], keys):
                if pieces and key != held:
                    done += changed(pieces)
                    pieces = []
                held = key
                pieces.append(rows)
            if done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
                done = []
        if pieces:
            yield from pa.Table.from_batches(changed(pieces)).combine_chunks().to_batches()

    return df.repartition(*keys).sortWithinPartitions(*keys, t).mapInArrow(run, schema)
