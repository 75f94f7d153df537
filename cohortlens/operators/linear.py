"""Per-split linear algebra for imputation, scaling, ridge with leave-one-out
alpha choice, PCA and linear predictions — all splits in one Spark job.

Rows are ``(split, subject, role, x array<double>, y array<double>)``.

Sufficient statistics (count, means, centred cross-products) are taken with
numpy over pieces of a split (``mapInPandas`` after an exchange on split and
piece, so a split has at most ``PIECES`` partial results however many
partitions the input has) and merged with the parallel-variance formula.
Eigen-problems are solved on the executors, one row per split; fitted
parameters stay DataFrames and meet the rows by (split, piece), so neither the
driver nor a broadcast holds the parameters of all splits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import stored_table

# fixed values: 100 ridge penalties, log-spaced from 1e-3 to 1e5
RIDGE_ALPHAS = np.logspace(-3, 5, 100)

PIECES = 32                 # pieces of a split that are summarised or joined apart
ROWS_PER_PIECE = 20_000     # rows of a split in one grouped step of the leave-one-out errors
LOO_ROWS = 4096             # of them at a time

MOMENTS_SCHEMA = ("split int, n long, mx array<double>, my array<double>, cxx array<double>, "
                  "cxy array<double>, cyy array<double>")


def design_rows(x: DataFrame, features: Sequence[str], y: DataFrame, targets: Sequence[str],
                members: DataFrame, key: str = "subject") -> DataFrame:
    """(split, subject, role, x, y) from subject tables and split membership."""
    xa = x.select(key, F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    ya = y.select(key, F.array(*[F.col(c).cast("double") for c in targets]).alias("y"))
    rows = members.select("split", key, "role").join(xa, key, "left").join(ya, key, "left")
    # V7 inside the plan: a member without features or targets is an error, not a lost row
    found = [F.coalesce(c, F.raise_error(F.concat(F.lit(f"no {what} for "), F.col(key).cast("string")))
                        .cast("array<double>")).alias(c) for c, what in (("x", "features"), ("y", "targets"))]
    return rows.select(key, "split", "role", *found)


def _piece(rows: DataFrame, n, x_col: str = "x"):
    """Piece number 0..n-1 of a row, the same in every run."""
    return F.pmod(F.xxhash64("subject" if "subject" in rows.columns else x_col), n).cast("int")


def join_by_split(rows: DataFrame, values: DataFrame, how: str = "inner", x_col: str = "x") -> DataFrame:
    """Join one row of values per split; every split is met in ``PIECES`` pieces,
    so a split that holds most rows does not end in one task."""
    pieces = values.withColumn("__piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
    return (rows.withColumn("__piece", _piece(rows, F.lit(PIECES), x_col))
            .join(pieces, ["split", "__piece"], how).drop("__piece"))


def _stack(col: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, dtype=float) if v is not None else np.array([], dtype=float) for v in col])


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of an array column of any width, gaps as NaN."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return _dense(column, len(column.flatten()) // len(column)) if len(column) else np.zeros((0, 0))


def _by_split(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    """(split, matrix of each column) of the splits in a batch."""
    splits, values = batch.column("split").to_numpy(), [_matrix(batch.column(c)) for c in columns]
    for s in np.unique(splits):
        yield int(s), *[v[splits == s] for v in values]


# ---------------------------------------------------------------- imputation (ML2)

def gap_columns(rows: DataFrame, x_col: str = "x") -> list[int]:
    """Positions of the x columns with a gap, at most one number per column and partition."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, bool)
        for batch in batches:
            gap = np.isnan(_matrix(batch.column(0))).any(0)
            seen = gap | seen if len(seen) else gap
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen), pa.int32())], ["j"])

    return sorted(r["j"] for r in rows.select(x_col).mapInArrow(part, "j int").distinct().collect())


def column_means(rows: DataFrame, x_col: str = "x") -> DataFrame:
    """Per split: mean of every x column over non-NULL entries, and whether
    the column had any NULL (split, mean array, any_missing array)."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, list] = {}
        for batch in batches:
            for s, X in _by_split(batch, x_col):
                ok = ~np.isnan(X)
                a = acc.setdefault(s, [np.zeros(X.shape[1]), np.zeros(X.shape[1]), 0])
                a[0] += np.where(ok, X, 0.0).sum(0)
                a[1] += ok.sum(0)
                a[2] += X.shape[0]
        if acc:
            yield pa.RecordBatch.from_pydict({
                "split": pa.array(list(acc), pa.int32()), "s": [v[0].tolist() for v in acc.values()],
                "c": [v[1].tolist() for v in acc.values()], "n": pa.array([v[2] for v in acc.values()], pa.int64())})

    pieces = rows.withColumn("__piece", _piece(rows, F.lit(PIECES), x_col)).repartition("split", "__piece")
    parts = pieces.select("split", x_col).mapInArrow(part, "split int, s array<double>, c array<double>, n long")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        s = _stack(pdf["s"]).sum(0)
        c = _stack(pdf["c"]).sum(0)
        n = pdf["n"].sum()
        mean = np.where(c > 0, s / np.maximum(c, 1), np.nan)
        return pd.DataFrame({"split": [int(pdf["split"].iloc[0])],
                             "mean": [[None if np.isnan(v) else float(v) for v in mean]],
                             "any_missing": [[bool(v) for v in (c < n)]]})

    return parts.groupBy("split").applyInPandas(
        merge, "split int, mean array<double>, any_missing array<boolean>")


def impute_with_indicators(rows: DataFrame, means: DataFrame, indicator_cols: Sequence[int],
                           x_col: str = "x") -> DataFrame:
    """Fill NULLs with the split's train means and append 0/1 missing
    indicators for ``indicator_cols`` (positions).  ``means`` has one row per split."""
    filled = F.zip_with(F.col(x_col), F.col("__mean"), lambda a, b: F.coalesce(a, b, F.lit(0.0)))
    ind = [F.when(F.get(F.col(x_col), i).isNull(), F.lit(1.0)).otherwise(F.lit(0.0)) for i in indicator_cols]
    out = F.concat(filled, F.array(*ind)) if ind else filled
    m = means.select("split", F.col("mean").alias("__mean"))
    return join_by_split(rows, m, x_col=x_col).withColumn(x_col, out).drop("__mean")


# ---------------------------------------------------------------- moments

def moments(rows: DataFrame, x_col: str = "x", y_col: str = "y") -> DataFrame:
    """Per split: n, means of x and y, centred Xᵀ X, Xᵀ y, yᵀ y (flattened).
    A gap in x or y is an error: it would spread over the whole split."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, tuple] = {}
        for batch in batches:
            for s, X, Y in _by_split(batch, x_col, y_col):
                if np.isnan(X).any() or np.isnan(Y).any():
                    raise ValueError(f"split {s}: missing values, impute the columns first")
                n = X.shape[0]
                mx, my = X.mean(0), Y.mean(0)
                Xc, Yc = X - mx, Y - my
                cur = (n, mx, my, Xc.T @ Xc, Xc.T @ Yc, (Yc * Yc).sum(0))
                acc[s] = _chan(acc[s], cur) if s in acc else cur
        if acc:   # an empty partition yields nothing
            arrays = [[v[i].ravel() for v in acc.values()] for i in range(1, 6)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(acc), pa.int32()), pa.array([v[0] for v in acc.values()], pa.int64()),
                 *[pa.array(a, pa.list_(pa.float64())) for a in arrays]], ["split", "n", "mx", "my", "cxx", "cxy", "cyy"])

    pieces = rows.withColumn("__piece", _piece(rows, F.lit(PIECES), x_col)).repartition("split", "__piece")
    parts = pieces.select("split", x_col, y_col).mapInArrow(part, MOMENTS_SCHEMA)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        acc = None
        for r in pdf.itertuples(index=False):
            k, t = len(r.mx), len(r.my)
            cur = (r.n, np.asarray(r.mx), np.asarray(r.my), np.asarray(r.cxx).reshape(k, k),
                   np.asarray(r.cxy).reshape(k, t), np.asarray(r.cyy))
            acc = cur if acc is None else _chan(acc, cur)
        n, mx, my, cxx, cxy, cyy = acc
        return pd.DataFrame([(int(pdf["split"].iloc[0]), int(n), mx.tolist(), my.tolist(), cxx.ravel().tolist(),
                              cxy.ravel().tolist(), cyy.tolist())],
                            columns=["split", "n", "mx", "my", "cxx", "cxy", "cyy"])

    return parts.groupBy("split").applyInPandas(merge, MOMENTS_SCHEMA)


def _chan(a: tuple, b: tuple) -> tuple:
    """Merge two (n, mean_x, mean_y, Cxx, Cxy, Cyy) summaries (parallel algorithm)."""
    na, mxa, mya, cxxa, cxya, cyya = a
    nb, mxb, myb, cxxb, cxyb, cyyb = b
    n = na + nb
    dx, dy = mxb - mxa, myb - mya
    f = na * nb / n
    return (n, mxa + dx * nb / n, mya + dy * nb / n,
            cxxa + cxxb + f * np.outer(dx, dx), cxya + cxyb + f * np.outer(dx, dy), cyya + cyyb + f * dy * dy)


# ---------------------------------------------------------------- ridge (ML3 + ML7)

class SplitParams:
    """Per-split standardisation and eigen-decomposition of the scaled Gram."""

    def __init__(self, n, mx, my, cxx, cxy, cyy):
        k, t = len(mx), len(my)
        self.n = n
        self.mx = np.asarray(mx)
        self.my = np.asarray(my)
        cxx = np.asarray(cxx).reshape(k, k)
        cxy = np.asarray(cxy).reshape(k, t)
        sd = np.sqrt(np.maximum(np.diag(cxx), 0.0) / n)       # population sd (ML3)
        self.sd = np.where(sd > 0, sd, 1.0)                    # constant column: scale 1
        S = cxx / np.outer(self.sd, self.sd)
        lam, V = np.linalg.eigh(S)
        self.lam = np.maximum(lam, 0.0)
        self.V = V
        self.q = V.T @ (cxy / self.sd[:, None])                # k x t


PARAMS_SCHEMA = ("split int, n long, mx array<double>, my array<double>, sd array<double>, lam array<double>, "
                 "v array<double>, q array<double>")


def solve_splits(moment_rows: DataFrame) -> DataFrame:
    """One eigen-decomposition of the scaled Gram per split, on the executors."""

    def solve(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for r in pdf.itertuples(index=False):
                p = SplitParams(r.n, r.mx, r.my, r.cxx, r.cxy, r.cyy)
                yield pd.DataFrame([(int(r.split), int(r.n), p.mx.tolist(), p.my.tolist(), p.sd.tolist(),
                                     p.lam.tolist(), p.V.ravel().tolist(), p.q.ravel().tolist())],
                                   columns=["split", "n", "mx", "my", "sd", "lam", "v", "q"])

    return moment_rows.mapInPandas(solve, PARAMS_SCHEMA)


def _unpack(r) -> tuple:
    """(mx, my, sd, lam, V, q) of one row of ``solve_splits``."""
    mx, my, sd, lam = (np.asarray(v, dtype=float) for v in (r.mx, r.my, r.sd, r.lam))
    k, t = len(mx), len(my)
    return mx, my, sd, lam, np.asarray(r.v).reshape(k, k), np.asarray(r.q).reshape(k, t)


def ridge_cv(train_rows: DataFrame, alphas: Sequence[float] = RIDGE_ALPHAS, x_col: str = "x",
             y_col: str = "y") -> DataFrame:
    """ML7: ridge on standardised x with one alpha per split (shared by all
    targets) chosen by exact leave-one-out error:
    e_i = (y_i - ŷ_i)/(1 - h_i), h_i = 1/n + Σ_k u_ik²/(λ_k + α), u = Vᵀ x̃_i.

    Returns the coefficients (split, alpha, w array (k·t, row-major), b array
    (t)).  The errors are summed over pieces of at most about
    ``ROWS_PER_PIECE`` rows, each next to its split's parameters; ties of the
    error take the smaller alpha.  Parameters and coefficients are stored because
    later steps read them several times, as tables of known size: joins broadcast
    them only where they are small."""
    alphas = np.asarray(alphas, dtype=float)
    params = stored_table(solve_splits(moments(train_rows, x_col, y_col)), "ridge-params")
    counts = F.broadcast(params.select("split", F.ceil(F.col("n") / ROWS_PER_PIECE).alias("__pieces")))  # ints per split
    rows = train_rows.select("split", *(["subject"] if "subject" in train_rows.columns else []), x_col, y_col)
    rows = rows.join(counts, "split")
    rows = rows.select("split", _piece(rows, F.col("__pieces"), x_col).alias("piece"), x_col, y_col)
    pieces = params.withColumn("piece", F.explode(F.sequence(
        F.lit(0), (F.ceil(F.col("n") / ROWS_PER_PIECE) - 1).cast("int"))))

    def loo(g: pa.Table, p: pa.Table) -> pa.Table:
        if not g.num_rows or not p.num_rows:
            return pa.table({"split": pa.array([], pa.int32()), "a": pa.array([], pa.int32()), "sse": pa.array([], pa.float64())})
        own = SimpleNamespace(**p.slice(0, 1).to_pylist()[0])
        mx, my, sd, lam, V, q = _unpack(own)
        X, Y = _matrix(g.column(x_col)), _matrix(g.column(y_col))
        shrink = 1.0 / (lam[:, None] + alphas)          # k x alphas
        sse = np.zeros(len(alphas))
        for at in range(0, len(X), LOO_ROWS):           # rows x alphas, target by target
            U = ((X[at:at + LOO_ROWS] - mx) / sd) @ V
            left = 1.0 - (1.0 / own.n + (U * U) @ shrink)
            for t in range(Y.shape[1]):
                e = ((Y[at:at + LOO_ROWS, t] - my[t])[:, None] - U @ (q[:, t][:, None] * shrink)) / left
                sse += (e * e).sum(0)
        return pa.table({"split": pa.array([own.split] * len(alphas), pa.int32()),
                         "a": pa.array(np.arange(len(alphas)), pa.int32()), "sse": pa.array(sse)})

    sse = (rows.groupBy("split", "piece").cogroup(pieces.groupBy("split", "piece"))
           .applyInArrow(loo, "split int, a int, sse double").groupBy("split", "a").agg(F.sum("sse").alias("sse")))
    best = sse.groupBy("split").agg(F.min(F.struct("sse", "a")).alias("m")).select("split", F.col("m.a").alias("a"))

    def weights(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for r in pdf.itertuples(index=False):
                mx, my, sd, lam, V, q = _unpack(r)
                alpha = float(alphas[int(r.a)])
                w = (V @ (q / (lam + alpha)[:, None])) / sd[:, None]      # on the original x scale
                yield pd.DataFrame([(int(r.split), alpha, w.ravel().tolist(), (my - mx @ w).tolist())],
                                   columns=["split", "alpha", "w", "b"])

    return stored_table(params.join(best, "split").mapInPandas(
        weights, "split int, alpha double, w array<double>, b array<double>"), "ridge-weights")


def _every(first: int, step: int):
    """The elements first, first + step, ... of the weights."""
    return F.filter("w", lambda v, i: (i % step) == first)


def predict_linear(rows: DataFrame, coef: DataFrame, n_targets: int, target_names: Sequence[str],
                   x_col: str = "x") -> DataFrame:
    """ML11: ŷ_t = b_t + Σ_j x_j·w_jt per row, with the split's coefficients.

    The dot products are JVM-side array expressions."""
    own = [_every(ti, n_targets).alias(f"__w{ti}") for ti in range(n_targets)]
    j = join_by_split(rows, coef.select("split", "b", *own), x_col=x_col)
    preds = []
    for ti, name in enumerate(target_names):
        dot = F.aggregate(F.zip_with(F.col(x_col), F.col(f"__w{ti}"), lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
        preds.append((F.get(F.col("b"), ti) + dot).alias(f"{name}_pred"))
    return j.select(*[c for c in rows.columns if c not in (x_col, "y")], *preds)


# ---------------------------------------------------------------- PCA (ML4)

def pca_fit(train_rows: DataFrame, n_components: int, x_col: str = "x") -> DataFrame:
    """Per split: standardise (population sd) then principal axes of the block.

    Returns (split, pw array (component after component, k each), pb array):
    component c of x is pb_c + Σ_j x_j·pw_cj.  The sign makes the loading of
    largest magnitude positive."""
    fitted = solve_splits(moments(train_rows.withColumn("__y", F.array(F.lit(0.0))), x_col, "__y"))

    def axes(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for r in pdf.itertuples(index=False):
                mx, _, sd, lam, V, _ = _unpack(r)
                comp = V[:, np.argsort(lam)[::-1][:n_components]]
                sign = np.sign(comp[np.argmax(np.abs(comp), axis=0), np.arange(comp.shape[1])])
                w = comp * np.where(sign == 0, 1.0, sign) / sd[:, None]
                yield pd.DataFrame([(int(r.split), w.T.ravel().tolist(), (-(mx @ w)).tolist())],
                                   columns=["split", "pw", "pb"])

    return fitted.mapInPandas(axes, "split int, pw array<double>, pb array<double>")


def pca_transform(rows: DataFrame, fitted: DataFrame, x_col: str = "x", out_col: str = "x") -> DataFrame:
    """Project the block on the components of the row's split."""
    j = join_by_split(rows, fitted, x_col=x_col)
    k = F.size(x_col)
    dot = lambda b, i: b + F.aggregate(
        F.zip_with(F.col(x_col), F.slice(F.col("pw"), i * k + 1, k), lambda x, w: x * w),
        F.lit(0.0), lambda acc, v: acc + v)
    return j.withColumn(out_col, F.transform("pb", dot)).drop("pw", "pb")


# ---------------------------------------------------------------- iterative imputation (ML2)

def bayesian_ridge(n: float, cxx: np.ndarray, cxy: np.ndarray, cyy: float, max_iter: int = 300,
                   tol: float = 1e-3, a1: float = 1e-6, a2: float = 1e-6, l1: float = 1e-6,
                   l2: float = 1e-6) -> np.ndarray:
    """Bayesian ridge (evidence maximisation of the noise and weight
    precisions) on centred statistics only: XᵀX, Xᵀy, yᵀy, n."""
    eig, V = np.linalg.eigh(cxx)
    eig = np.maximum(eig, 0.0)
    xty = V.T @ cxy
    alpha = 1.0 / (cyy / n + np.finfo(float).eps)
    lam = 1.0
    old = None
    for it in range(max_iter):
        coef = V @ (xty / (eig + lam / alpha))
        rmse = cyy - 2.0 * coef @ cxy + coef @ cxx @ coef
        gamma = np.sum(alpha * eig / (lam + alpha * eig))
        lam = (gamma + 2 * l1) / (coef @ coef + 2 * l2)
        alpha = (n - gamma + 2 * a1) / (max(rmse, 0.0) + 2 * a2)
        if it and np.abs(old - coef).sum() < tol:
            break
        old = coef
    return V @ (xty / (eig + lam / alpha))


COEF_SCHEMA = "split int, round int, place int, c int, w array<double>, b double, settled boolean"


def iterative_impute(rows: DataFrame, k: int, max_iter: int = 10, tol: float = 1e-3, n_nearest: int | None = None,
                     x_col: str = "x", state_bytes: int = 256 << 20) -> DataFrame:
    """ML2: round-robin imputation fitted on each split's train rows.

    Start from train means; then per round and per column with gaps (fewest
    missing first among the split's train rows) fit a Bayesian ridge of the column on
    the other columns over train rows where it is observed, and replace its
    missing entries in train and test rows; a column with gaps in test rows only
    keeps the train mean there.  A split stops when the largest row-wise absolute change of
    its train rows falls below tol·max|observed|.  ``n_nearest`` fits on that
    many most correlated columns only (a cheaper model with other values);
    None takes all.

    All steps are affine in a row's values, so rows with the same gaps can be replaced by
    any rows with the same moments: of each (split, gap pattern) at most k + 1 rows of a
    triangular factor stay, taken once, map-side.  One task per split runs all
    columns and rounds on them; a step updates the moments by the rows with a gap in its column.
    The rows themselves are read again only to replay the fitted steps, and
    of them only those with gaps.  Where a split's factors exceed ``state_bytes``
    (very many different patterns) every step is a job over all rows instead, with the
    same result."""
    train = rows.filter("role = 'train'")
    pieces = train.withColumn("__piece", _piece(train, F.lit(PIECES), x_col)).repartition("split", "__piece")
    pseudo = stored_table(pieces.select("split", F.col(x_col).alias("x")).mapInArrow(
        _compressed(k), "split int, u double, x array<double>, is_row boolean, amax double"), "impute-factors")
    most = pseudo.groupBy("split").count().agg(F.max("count")).first()[0] or 0
    if most * (k + 1) * 8 > state_bytes:
        return _impute_by_steps(rows, k, max_iter, tol, n_nearest, x_col)
    coefs = stored_table(pseudo.groupBy("split").applyInArrow(_solve(k, max_iter, tol, n_nearest), COEF_SCHEMA), "impute-steps")

    has_gap = F.exists(x_col, lambda v: v.isNull())
    gaps = rows.filter(has_gap)
    n_pieces = gaps.groupBy("split").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_PIECE).cast("int").alias("__n"))
    gaps = gaps.join(n_pieces, "split").withColumn("__piece", _piece(gaps, F.col("__n"), x_col)).drop("__n")
    if coefs.filter("not settled").limit(1).count():
        # some change of these splits is known for factors only: their last round is found on the rows
        open_steps = coefs.filter("not settled")
        amax = pseudo.groupBy("split").agg(F.max("amax").alias("amax"))
        change = _replayed(gaps.filter("role = 'train'").select("split", "__piece", F.col(x_col).alias("x")), open_steps, n_pieces,
                           _changes(k), "split int, round int, change double")
        last = change.groupBy("split", "round").agg(F.max("change").alias("change")).join(amax, "split").groupBy("split").agg(
            F.min(F.when(F.col("change") < tol * F.col("amax"), F.col("round"))).alias("last"))
        coefs = coefs.join(last, "split", "left").filter("last is null or round <= last").drop("last")
    filled = _replayed(gaps, coefs, n_pieces, _fill(k, x_col), gaps.schema).select(*rows.columns)
    return rows.filter(~F.coalesce(has_gap, F.lit(False))).unionByName(filled)


def _dense(column: pa.ChunkedArray | pa.Array, k: int) -> np.ndarray:
    """Rows of an array column, gaps as NaN."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), k)


def _compressed(k: int, held: int = 64 << 20):
    """(1, x) of the rows of each (split, gap pattern), replaced by their triangular factor where
    they are many; ``is_row``: still the rows themselves."""

    def reduced(group: list, most: int) -> None:
        if sum(map(len, group[0])) > most:
            group[0], group[1] = [np.linalg.qr(np.vstack(group[0]), mode="r")], False

    def emit(groups: dict) -> Iterator[pa.RecordBatch]:
        for (split, gap), group in groups.items():
            gap = np.unpackbits(np.frombuffer(gap, np.uint8), count=k).astype(bool)
            reduced(group, k + 1 if not gap.any() else 4 * (k + 1))
            factor = np.vstack(group[0])
            x = np.full((len(factor), k), np.nan)
            x[:, ~gap] = factor[:, 1:]
            flat = pa.array(x.ravel(), pa.float64(), from_pandas=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(x), split), pa.int32()), pa.array(factor[:, 0]),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), flat),
                 pa.array(np.full(len(x), group[1])), pa.array(np.full(len(x), group[2]))], ["split", "u", "x", "is_row", "amax"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[int, bytes], list] = {}
        for batch in batches:
            x, splits = _dense(batch.column("x"), k), batch.column("split").to_numpy()
            patterns = np.packbits(np.isnan(x), axis=1)
            of = np.unique(np.column_stack([splits.astype(np.int64).view(np.uint8).reshape(-1, 8), patterns]), axis=0, return_inverse=True)[1]
            order = np.argsort(of.ravel(), kind="stable")
            for own in np.split(order, np.cumsum(np.bincount(of.ravel()))[:-1]):
                group = groups.setdefault((int(splits[own[0]]), patterns[own[0]].tobytes()), [[], True, 0.0])
                values = x[own][:, ~np.isnan(x[own[0]])]
                group[0].append(np.column_stack([np.ones(len(own)), values]))
                group[2] = max(group[2], np.abs(values).max(initial=0.0))
                reduced(group, 4 * (k + 1))
            if sum(len(a) for g in groups.values() for a in g[0]) * (k + 1) * 8 > held:
                yield from emit(groups)
                groups = {}
        yield from emit(groups)

    return run


def _solve(k: int, max_iter: int, tol: float, n_nearest: int | None):
    """All rounds of one split on its factors: round 0 has the means, then one row per step."""
    schema = pa.schema([("split", pa.int32()), ("round", pa.int32()), ("place", pa.int32()), ("c", pa.int32()),
                        ("w", pa.list_(pa.float64())), ("b", pa.float64()), ("settled", pa.bool_())])

    def run(key: tuple, table: pa.Table) -> pa.Table:
        x, u = _dense(table.column("x"), k), table.column("u").to_numpy()
        is_row, amax = table.column("is_row").to_numpy(), table.column("amax").to_numpy().max()
        whole = ~np.isnan(x).any(1)
        factor = np.linalg.qr(np.column_stack([u, x])[whole], mode="r") if whole.any() else np.zeros((0, k + 1))
        u, x, is_row = np.append(factor[:, 0], u[~whole]), np.vstack([factor[:, 1:], x[~whole]]), is_row[~whole]
        gap, weight = np.isnan(x), u * u
        seen = weight @ ~gap
        means = np.divide(np.where(gap, 0.0, u[:, None] * x).sum(0), seen, out=np.zeros(k), where=seen > 0)
        # centred by the first means, which are 0 then; the column before them is the constant
        a = np.column_stack([u, np.where(gap, 0.0, x - u[:, None] * means)])
        gram, missing = a.T @ a, weight @ gap
        todo = [c for c in np.lexsort((np.arange(k), np.rint(missing))) if missing[c] > 0.5 and seen[c] > 0.5]
        steps, settled = [(0, 0, -1, means, 0.0)], not todo
        for r in range(1, max_iter + 1 if todo else 1):
            before = a[len(factor):].copy()
            for place, c in enumerate(todo):
                m, others = gap[:, c], np.delete(np.arange(k), c)
                s = gram - a[m].T @ a[m]
                n, mean = s[0, 0], s[0, 1:] / s[0, 0]
                cov = s[1:, 1:] - n * np.outer(mean, mean)
                w = np.zeros(k)
                w[others] = _nearest_ridge(n, cov[np.ix_(others, others)], cov[others, c], max(cov[c, c], 0.0), n_nearest)
                b = mean[c] - mean @ w
                a[m, c + 1] = u[m] * b + a[m, 1:] @ w
                gram[c + 1] = gram[:, c + 1] = a.T @ a[:, c + 1]
                steps.append((r, place, c, w, means[c] + b - means @ w))
            if is_row.all() and np.abs(a[len(factor):] - before).sum(1).max() < tol * amax:
                settled = True
                break
        settled = settled or bool(is_row.all())
        split = key[0].as_py()
        return pa.Table.from_pylist([dict(zip(schema.names, (split, r, place, int(c), w.tolist(), float(b), settled)))
                                     for r, place, c, w, b in steps], schema=schema)

    return run


def _replayed(gaps: DataFrame, coefs: DataFrame, n_pieces: DataFrame, step, schema) -> DataFrame:
    """``step`` on the rows of each (split, piece) with the split's steps."""
    steps = coefs.drop("settled").join(n_pieces, "split").withColumn(
        "__piece", F.explode(F.sequence(F.lit(0), F.col("__n") - 1))).drop("__n")
    return gaps.groupBy("split", "__piece").cogroup(steps.groupBy("split", "__piece")).applyInArrow(step, schema)


def _rounds(x: np.ndarray, steps: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """The rows after each round, filled in place."""
    gap, steps = np.isnan(x), steps.sort_by([("round", "ascending"), ("place", "ascending")]).to_pylist()
    x[gap] = np.broadcast_to(steps[0]["w"], x.shape)[gap]
    for r in range(1, steps[-1]["round"] + 1):
        for step in steps:
            if step["round"] == r:
                m = gap[:, step["c"]]
                x[m, step["c"]] = step["b"] + x[m] @ np.asarray(step["w"])
        yield r, x


def _changes(k: int):
    def run(rows: pa.Table, steps: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and steps.num_rows:
            x = _dense(rows.column("x"), k)
            means = np.asarray(steps.filter(pc.equal(steps.column("round"), 0)).column("w")[0].as_py())
            before = np.where(np.isnan(x), means, x)
            for r, after in _rounds(x, steps):
                out.append((r, float(np.abs(after - before).sum(1).max())))
                before = after.copy()
        split = rows.column("split")[0].as_py() if out else 0
        return pa.table({"split": pa.array([split] * len(out), pa.int32()), "round": pa.array([r for r, _ in out], pa.int32()),
                         "change": pa.array([d for _, d in out], pa.float64())})

    return run


def _fill(k: int, x_col: str):
    def run(rows: pa.Table, steps: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return rows
        x = _dense(rows.column(x_col), k)
        if steps.num_rows:
            for _ in _rounds(x, steps):
                pass
        else:
            x[np.isnan(x)] = 0.0                            # a split without train rows
        filled = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), pa.array(x.ravel()))
        at = rows.schema.get_field_index(x_col)
        return rows.set_column(at, pa.field(x_col, filled.type), filled)

    return run


def _nearest_ridge(n: float, cxx: np.ndarray, cxy: np.ndarray, cyy: float, n_nearest: int | None) -> np.ndarray:
    use = np.arange(len(cxy))
    if n_nearest is not None and len(use) > n_nearest:
        sd = np.sqrt(np.maximum(np.diag(cxx), 1e-300))
        corr = np.abs(cxy / sd / np.sqrt(max(cyy, 1e-300)))
        use = np.sort(np.argsort(-corr, kind="stable")[:n_nearest])
    w = np.zeros(len(cxy))
    w[use] = bayesian_ridge(float(n), cxx[np.ix_(use, use)], cxy[use], float(cyy))
    return w


def _impute_by_steps(rows: DataFrame, k: int, max_iter: int, tol: float, n_nearest: int | None, x_col: str) -> DataFrame:
    """The same steps, each a job over all rows; written and read again with the schema, since a
    checkpoint keeps size estimates that joins multiply.  A split that has stopped takes no further step."""
    means = column_means(rows.filter("role = 'train'"), x_col).select("split", F.col("mean").alias("__mean"))
    base = join_by_split(rows, means, "left", x_col).withColumn("__orig", F.col(x_col)).withColumn(
        x_col, F.transform(x_col, lambda v, i: F.coalesce(v, F.get("__mean", i), F.lit(0.0)))).drop("__mean")
    cur = stored_table(base, "impute-rows")
    train = rows.filter("role = 'train'")
    missing = train.select("split", F.posexplode(F.transform(x_col, lambda v: v.isNull().cast("int"))).alias("c", "m")).groupBy(
        "split", "c").agg(F.sum("m").alias("m"), F.count(F.lit(1)).alias("n")).filter("m > 0 and m < n")
    amax = train.groupBy("split").agg(F.max(F.array_max(F.transform(x_col, lambda v: F.abs(v)))).alias("amax"))
    order = F.row_number().over(Window.partitionBy("split").orderBy("m", "c"))
    going = stored_table(missing.withColumn("place", order).select("split", "c", "place"), "impute-order")
    for _ in range(max_iter):
        prev = cur
        for place in range(1, (going.agg(F.max("place")).first()[0] or 0) + 1):
            now = going.filter(F.col("place") == place).select("split", "c")
            fit = cur.filter("role = 'train'").join(now, "split").filter(F.get("__orig", F.col("c")).isNotNull())
            fit = fit.select("split", "subject", F.filter(x_col, lambda v, i: i != F.col("c")).alias("__xo"),
                             F.array(F.get(F.col(x_col), F.col("c"))).alias("__yc"))
            coef = moments(fit, "__xo", "__yc").mapInPandas(_column_fit(k - 1, n_nearest), "split int, __w array<double>, __b double")
            coef = stored_table(coef.join(now, "split").withColumn("__w", F.concat(
                F.slice("__w", F.lit(1), F.col("c")), F.array(F.lit(0.0)), F.slice("__w", F.col("c") + 1, F.lit(k)))), "impute-coef")
            dot = F.aggregate(F.zip_with(x_col, "__w", lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
            gap = F.get("__orig", F.col("c")).isNull() & F.col("__b").isNotNull()
            cur = stored_table(join_by_split(cur, coef, "left", x_col).withColumn(
                x_col, F.transform(x_col, lambda v, i: F.when((i == F.col("c")) & gap, F.col("__b") + dot).otherwise(v))).drop(
                    "__w", "__b", "c"), "impute-rows")
        old = prev.filter("role = 'train'").select("split", "subject", F.col(x_col).alias("__old"))
        change = cur.filter("role = 'train'").join(old, ["split", "subject"]).groupBy("split").agg(F.max(F.aggregate(
            F.zip_with(x_col, "__old", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda acc, v: acc + v)).alias("change"))
        settled = change.join(amax, "split").filter(F.col("change") < tol * F.col("amax"))
        going = stored_table(going.join(settled, "split", "left_anti"), "impute-order")
        if not going.limit(1).count():
            break
    return cur.select(*rows.columns)


def _column_fit(kk: int, n_nearest: int | None):
    """Moments of one column on the others -> weights and intercept."""

    def fit(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for r in pdf.itertuples(index=False):
                w = _nearest_ridge(r.n, np.asarray(r.cxx).reshape(kk, kk), np.asarray(r.cxy).reshape(kk), r.cyy[0], n_nearest)
                yield pd.DataFrame([(int(r.split), w.tolist(), float(r.my[0] - np.asarray(r.mx) @ w))],
                                   columns=["split", "__w", "__b"])

    return fit
