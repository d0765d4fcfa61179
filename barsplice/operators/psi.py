"""Percent spliced in with a replicate error model and empirical-Bayes shrinkage.

Counts are long: one row per variant and replicate with ``inclusion``, ``skipping`` and
``others``.  Everything per variant is one aggregation; the model's few parameters are
found by BFGS on the driver, whose every step costs one Spark job that evaluates all points
it needs at once.  No per-variant data leaves the executors.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Generator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import table

PSEUDO = 0.5
START_VARIANCE = 0.01
Z95 = 1.96


def observations(counts: DataFrame, mode: str = "can") -> DataFrame:
    """PSI, its logit ``y`` and sampling variance ``s2`` of every variant and replicate with reads.

    ``can`` counts inclusion and skipping, ``all`` other events too.
    """
    if mode not in ("can", "all"):
        raise ValueError(f"unknown mode {mode!r}")
    inclusion, skipping, others = (F.col(c).cast("double") for c in ("inclusion", "skipping", "others"))
    n = inclusion + skipping if mode == "can" else inclusion + skipping + others
    rows = counts.withColumn("n", n).where(F.col("n") > 0)
    psi = (F.col("inclusion") + PSEUDO) / (F.col("n") + 2 * PSEUDO)
    return (
        rows.withColumn("psi", psi)
        .withColumn("y", F.log(F.col("psi") / (1 - F.col("psi"))))
        .withColumn("s2", 1 / (F.col("n") * F.col("psi") * (1 - F.col("psi"))))
    )


def raw_columns(counts: DataFrame) -> DataFrame:
    """Raw PSI and the truncated ratio ``inclusion:skipping:others`` of each row (null without reads)."""
    total = (F.col("inclusion") + F.col("skipping") + F.col("others")).cast("double")
    share = lambda c: F.try_divide(F.col(c).cast("double"), total)
    percent = lambda c: (share(c) * 100).cast("int")
    ratio = F.when(total > 0, F.concat_ws(":", *(percent(c) for c in ("inclusion", "skipping", "others"))))
    return counts.withColumn("raw_psi", share("inclusion")).withColumn("ratio", ratio).withColumn("n_total", total.cast("bigint"))


def wide(obs: DataFrame, replicates: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per variant (and group) with y1.., s1.. in the order of ``replicates``."""
    pick = lambda c, r: F.max(F.when(F.col("rep") == r, F.col(c)))
    return obs.groupBy(*by, "var_id").agg(*(pick(c, r).alias(f"{a}{i}") for i, r in enumerate(replicates, 1) for c, a in (("y", "y"), ("s2", "s"))))


def subsets(n: int) -> list[tuple[int, ...]]:
    """All sets of at least two replicates, numbered from 1."""
    return [c for k in range(2, n + 1) for c in itertools.combinations(range(1, n + 1), k)]


def joint_nll(wide_obs: DataFrame, points: DataFrame, n: int, by: Sequence[str] = ()) -> DataFrame:
    """``(point, nll)``: the negative log likelihood over all subsets at every row of ``points`` (point, a1..an).

    ``points`` are the few parameter vectors of one optimiser step; they are data, not
    literals, so the plan is compiled once.  With ``by`` every group (such as a sample) has
    points of its own.
    """
    there = {i: F.col(f"y{i}").isNotNull() for i in range(1, n + 1)}
    total = lambda members, term: sum(F.when(there[i], term(i)).otherwise(0.0) for i in members)
    placed = wide_obs.join(points, list(by)) if by else wide_obs.crossJoin(F.broadcast(points))
    rows = placed.withColumns({f"v{i}": F.col(f"s{i}") + F.exp(F.col(f"a{i}")) for i in there})
    rows = rows.withColumns({f"w{i}": 1 / F.col(f"v{i}") for i in there})
    thetas = {
        f"t{k}": F.try_divide(total(s, lambda i: F.col(f"y{i}") * F.col(f"w{i}")), total(s, lambda i: F.col(f"w{i}"))) for k, s in enumerate(subsets(n))
    }
    rows = rows.withColumns(thetas)
    # A replicate's log variance counts once for each subset that holds it.
    squares = sum(total(s, lambda i, k=k: F.pow(F.col(f"y{i}") - F.col(f"t{k}"), 2) * F.col(f"w{i}")) for k, s in enumerate(subsets(n)))
    logs = total(there, lambda i: F.log(F.col(f"v{i}")) * sum(i in s for s in subsets(n)))
    return rows.groupBy(*by, "point").agg(F.sum(0.5 * (logs + squares)).alias("nll"))


def spark_objective(wide_obs: DataFrame, n: int, by: str | None = None) -> Callable[[dict], dict]:
    """Values at the points of every group, from one job; without ``by`` the only group is None."""
    spark = wide_obs.sparkSession

    def at(points: dict) -> dict:
        out = {k: np.full(len(p), np.inf) for k, p in points.items()}
        rows = [(k, i, *p) for k, ps in points.items() for i, p in enumerate(ps.tolist()) if max(map(abs, p)) < 700]
        if rows:
            columns = list(zip(*rows, strict=True))
            keys = {by: pa.array(columns[0], pa.string())} if by else {}
            frame = spark.createDataFrame(pa.table({**keys, "point": pa.array(columns[1], pa.int32()), **{f"a{i + 1}": pa.array(columns[2 + i]) for i in range(n)}}))
            for r in joint_nll(wide_obs, frame, n, [by] if by else []).collect():
                out[r[by] if by else None][r["point"]] = r["nll"] if r["nll"] is not None and math.isfinite(r["nll"]) else np.inf
        return out

    return at


def minimise(objective: Callable[[dict], dict], starts: dict, **options) -> dict:
    """Minima of all groups, whose searches advance together: one call of ``objective`` is a step of each that still runs."""
    searches = {k: _search(x, **options) for k, x in starts.items()}
    asked = {k: next(search) for k, search in searches.items()}
    found = {}
    while asked:
        for k, values in objective(asked).items():
            try:
                asked[k] = searches[k].send(values)
            except StopIteration as end:
                found[k] = end.value
                del asked[k]
    return found


def _search(start: np.ndarray, rounds: int = 100, tolerance: float = 1e-8, width: float = 1e-3) -> Generator[np.ndarray, np.ndarray, np.ndarray]:
    """BFGS with central differences, which yields points and is sent their values.

    The first inverse Hessian comes from one batch of second differences.  A step's
    lengths and the gradient at its full length are evaluated together, so most steps
    cost one batch.
    """
    n = len(start)
    eye = np.eye(n)
    offsets = np.concatenate([eye, -eye]) * width
    lengths = 0.25 ** np.arange(8)

    def slope(f: np.ndarray) -> np.ndarray:
        return (f[:n] - f[n:]) / (2 * width)

    x = start.astype(float)
    wide_step = 20 * width
    corners = [wide_step * (a * eye[i] + b * eye[j]) for i in range(n) for j in range(n) for a in (1, -1) for b in (1, -1)]
    f = yield np.concatenate([x[None], x + offsets, x + np.array(corners)])
    value, g = f[0], slope(f[1 : 1 + 2 * n])
    second = (f[1 + 2 * n :].reshape(n, n, 4) * [1, -1, -1, 1]).sum(2) / (4 * wide_step**2)
    h = eye
    if np.isfinite(second).all():
        size, axes = np.linalg.eigh((second + second.T) / 2)
        h = axes @ np.diag(1 / np.maximum(np.abs(size), 1e-3 * max(1e-9, np.abs(size).max()))) @ axes.T
    for _ in range(rounds):
        direction = -h @ g
        if direction @ g >= 0:
            h, direction = eye, -g
        direction *= min(1.0, 4.0 / max(1e-12, np.abs(direction).max()))
        f = yield np.concatenate([x + lengths[:, None] * direction, x + direction + offsets])
        tried = f[: len(lengths)]
        enough = np.flatnonzero(tried <= value + 1e-4 * lengths * (direction @ g))
        if not len(enough):
            if np.array_equal(h, eye):
                break
            h = eye
            continue
        step = lengths[enough[0]] * direction
        done = abs(value - tried[enough[0]]) <= tolerance * (abs(value) + tolerance)
        x, value, old = x + step, tried[enough[0]], g
        if done:
            break
        g = slope(f[len(lengths) :]) if enough[0] == 0 else slope((yield x + offsets))
        change = g - old
        curve = step @ change
        if curve > 0:
            left = eye - np.outer(step, change) / curve
            h = left @ h @ left.T + np.outer(step, step) / curve
    return x


def fit_variances(counts: DataFrame, replicates: Sequence[str], mode: str = "can") -> dict[str, float]:
    """Additive variance of each replicate that minimises the joint negative log likelihood."""
    if len(replicates) < 2:
        return dict.fromkeys(replicates, START_VARIANCE)
    frame = wide(observations(counts, mode), replicates).cache()
    try:
        best = minimise(spark_objective(frame, len(replicates)), {None: np.full(len(replicates), math.log(START_VARIANCE))})[None]
    finally:
        frame.unpersist()
    return {r: float(math.exp(a)) for r, a in zip(replicates, best, strict=True)}


def fit_all(counts: DataFrame, replicates: dict[str, Sequence[str]], by: str = "sample", mode: str = "can") -> dict[tuple[str, str], float]:
    """``fit_variances`` of every sample at once, keyed by sample and replicate.

    ``replicates`` lists each sample's, as many in all samples.  The number of jobs is that
    of the longest search, whatever the number of samples; observations are worked out once
    and lie in the shared folder.
    """
    n = {len(r) for r in replicates.values()}
    if len(n) != 1:
        raise ValueError("samples need equal numbers of replicates")
    (n,) = n
    if n < 2:
        return {(s, r): START_VARIANCE for s, reps in replicates.items() for r in reps}
    numbers = [(s, r, str(i)) for s, reps in replicates.items() for i, r in enumerate(reps, 1)]
    named = counts.sparkSession.createDataFrame(numbers, f"{by} string, rep string, number string")
    placed = observations(counts, mode).join(F.broadcast(named), [by, "rep"]).drop("rep").withColumnRenamed("number", "rep")
    frame = table(wide(placed, [str(i) for i in range(1, n + 1)], [by]))
    best = minimise(spark_objective(frame, n, by), {s: np.full(n, math.log(START_VARIANCE)) for s in replicates})
    return {(s, r): float(math.exp(a)) for s, reps in replicates.items() for r, a in zip(reps, best[s], strict=True)}


def estimates(counts: DataFrame, variances: dict, mode: str = "can", by: Sequence[str] = ()) -> DataFrame:
    """One row per variant: psi, ratio and reads by replicate, the combined and the shrunk estimate with its interval.

    Replicates are numbered 1.. in lexical order.  Variants without reads in the mode's
    counts have no estimate and no row.  ``variances`` are keyed by replicate.  With ``by``
    (such as the sample) every group is estimated on its own and shrunk to its own mean;
    keys are then tuples of the group and the replicate.
    """
    keyed = {k if isinstance(k, tuple) else (k,): float(v) for k, v in variances.items()}
    reps = sorted({k[-1] for k in keyed})
    added = F.create_map(*itertools.chain.from_iterable((F.lit("\n".join(k)), F.lit(v)) for k, v in keyed.items()))
    obs = observations(raw_columns(counts), mode).withColumn("v", F.col("s2") + added[F.concat_ws("\n", *by, "rep")]).where("v is not null")
    pick = lambda c, r: F.max(F.when(F.col("rep") == r, F.col(c)))
    by_rep = [pick(c, r).alias(f"{name}{i}") for name, c in (("psi", "raw_psi"), ("ratio", "ratio"), ("n_total", "n_total")) for i, r in enumerate(reps, 1)]
    one = obs.groupBy(*by, "var_id").agg(
        *by_rep, (F.sum(F.col("y") / F.col("v")) / F.sum(1 / F.col("v"))).alias("theta"), (1 / F.sum(1 / F.col("v"))).alias("var_theta")
    )
    overall = one.groupBy(*by).agg(F.avg("theta").alias("mu"), F.var_samp("theta").alias("tau2"))
    joined = one.join(overall, list(by)) if by else one.crossJoin(F.broadcast(overall))
    logistic = lambda c: 1 / (1 + F.exp(-c))
    theta, var = F.col("theta_shrunk"), F.col("var_theta_shrunk")
    return (
        joined
        .withColumn("psi_est", logistic(F.col("theta")))
        .withColumn("shrinkage", F.try_divide(F.col("tau2"), F.col("tau2") + F.col("var_theta")))
        .withColumn("theta_shrunk", F.col("shrinkage") * F.col("theta") + (1 - F.col("shrinkage")) * F.col("mu"))
        .withColumn("var_theta_shrunk", F.col("shrinkage") * F.col("shrinkage") * F.col("var_theta"))
        .withColumn("psi_shrunk", logistic(theta))
        .withColumn("psi_shrunk_lwr", logistic(theta - Z95 * F.sqrt(var)))
        .withColumn("psi_shrunk_upr", logistic(theta + Z95 * F.sqrt(var)))
        .drop("mu", "tau2")
    )


def corrected_psi(counts: DataFrame, replicates: Sequence[str], mode: str = "can") -> DataFrame:
    """Estimates with fitted variances."""
    return estimates(counts, fit_variances(counts, replicates, mode), mode)


def from_wide(matrix: DataFrame, id_col: str = "variant_id", inclusion: str = "N_inc", skipping: str = "N_skip") -> DataFrame:
    """Long counts from a matrix with columns ``N_inc*`` and ``N_skip*``, one pair a replicate; no other events."""
    reps = [c[len(inclusion) :] for c in matrix.columns if c.startswith(inclusion)]
    rows = F.explode(F.array(*(F.struct(F.lit(r).alias("rep"), F.col(inclusion + r).cast("bigint").alias("inclusion"), F.col(skipping + r).cast("bigint").alias("skipping")) for r in reps)))
    return matrix.select(F.col(id_col).alias("var_id"), rows.alias("x")).select("var_id", "x.*", F.lit(0).cast("bigint").alias("others"))


def round_all(df: DataFrame, digits: int = 4) -> DataFrame:
    """Every floating-point column rounded."""
    return df.select(*(F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes))
