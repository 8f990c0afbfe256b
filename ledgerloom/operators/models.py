"""Customer clusters and many-series sales forecasts."""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.operators.retail import daily_sales
from ledgerloom.operators.rfm import rfm_table
from ledgerloom.session import checkpointed

FEATURES = ["recency", "frequency", "monetary"]
# Short jobs run over the features; fewer rows than this per task would be all scheduling.
ROWS_PER_TASK = 200_000
MAX_PASSES, TOLERANCE = 300, 1e-4  # of the mean variance, for the square of a centre's move


def cluster_name(center: list[Column], mean: dict[str, Column]) -> Column:
    recency, frequency, monetary = center
    return (
        F.when((monetary > mean["monetary"]) & (recency < mean["recency"]), "Champions")
        .when(recency > mean["recency"] * 1.5, "À Risque")
        .when(frequency > mean["frequency"], "Clients Loyaux")
        .otherwise("Standard")
    )


def _first_centers(rows: DataFrame, k: int, starts: Sequence[int]) -> dict[int, list[list[float]]]:
    """Of each start the k customers with the least md5 of start and id: fixed by seed and ids alone."""
    drawn = rows.withColumn("start", F.explode(F.array(*map(F.lit, starts))))
    order = Window.partitionBy("start").orderBy(F.md5(F.concat_ws(":", "start", "customer_id")), "customer_id")
    first = drawn.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k)
    centers: dict[int, list[list[float]]] = {}
    for r in sorted(first.select("start", "n", "recency", "frequency", "cents").collect()):
        centers.setdefault(r["start"], []).append([float(r["recency"]), float(r["frequency"]), r["cents"] / 100])
    return centers


def _nearest(centers: str, k: int) -> Column:
    """Number of the nearest of k centers; of equally near ones the first."""

    def distance(j: int) -> str:
        gaps = [f"({x} - {centers}[{j}][{d}])" for d, x in enumerate(("recency", "frequency", "money"))]
        return f"struct({' + '.join(f'{gap} * {gap}' for gap in gaps)} AS d, {j} AS j)"

    return F.expr(f"array_min(array({', '.join(map(distance, range(k)))})).j")


def _constant(value: object, kind: str) -> Column:
    """A nested constant that stays data: the generated code is the same for every value and compiled once."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _lloyd_pass(rows: DataFrame, centers: dict[int, list[list[float]]], k: int) -> dict[int, dict[int, tuple]]:
    """Count and feature sums of every cluster of every start, in one job over the rows."""
    starts = _constant([{"s": s, "c": c} for s, c in centers.items()], "array<struct<s: int, c: array<array<double>>>>")
    each = rows.withColumn("start", F.explode(starts))
    near = each.select("start.s", _nearest("start.c", k).alias("j"), "recency", "frequency", "cents")
    sums = near.groupBy("s", "j").agg(F.count("*"), F.sum("recency"), F.sum("frequency"), F.sum("cents"))
    found: dict[int, dict[int, tuple]] = {s: {} for s in centers}
    for s, j, *values in sums.collect():
        found[s][j] = tuple(values)
    return found


def customer_clusters(
    sales: DataFrame, as_of: str, k: int = 4, restarts: int = 10, seed: int = 42
) -> DataFrame:
    """K-means on raw recency, frequency and monetary; the restart with the least cost is kept.

    A pass is one aggregation for all restarts together, of at most restarts * k groups. Sums are whole numbers
    (money in cents), so the result does not depend on the order of rows: seed and data fix it. A restart has
    converged when no centre moves by more than a hundredth of the common spread. Clusters are named by their centre
    against the overall means, so several may share a name. Fewer than k customers give no rows.
    """
    # One row per customer, kept: the passes and the labels read it instead of joining the sales again.
    rfm = checkpointed(rfm_table(sales, as_of).select("customer_id", *FEATURES))
    cents = F.round(F.col("monetary") * 100).cast("bigint")
    money = (F.col("cents") / 100).alias("money")
    rows = rfm.withColumn("cents", cents).select("customer_id", "recency", "frequency", "cents", money)
    exact = [F.col("recency").cast("decimal(19,0)"), F.col("frequency").cast("decimal(19,0)"), F.col("cents").cast("decimal(19,0)")]
    n, *moments = rows.agg(F.count("*"), *(F.sum(x) for x in exact), *(F.sum(x * x) for x in exact)).first()
    if n < k:
        return rfm.limit(0).withColumns({"cluster": F.lit(0), "segment": F.lit(""), "training_cost": F.lit(0.0)})
    totals = [float(moments[0]), float(moments[1]), float(moments[2]) / 100]
    squares = float(moments[3]) + float(moments[4]) + float(moments[5]) / 10000
    spread = (squares - sum(t * t / n for t in totals)) / n / 3
    rows = rows.coalesce(n // ROWS_PER_TASK + 1).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centers = _first_centers(rows, k, range(seed, seed + restarts))
        active, held = set(centers), {}
        for _ in range(MAX_PASSES):
            for s, clusters in _lloyd_pass(rows, {s: centers[s] for s in sorted(active)}, k).items():
                moved = 0.0
                new = [list(c) for c in centers[s]]  # an empty cluster keeps its centre
                for j, (count, r, f, m) in clusters.items():
                    new[j] = [r / count, f / count, m / (count * 100)]
                    moved = max(moved, sum((x - y) * (x - y) for x, y in zip(new[j], centers[s][j], strict=True)))
                centers[s] = new
                held[s] = 0.0  # added up in the order of the clusters; sum() would carry the rounding errors along
                for _, (count, r, f, m) in sorted(clusters.items()):
                    held[s] += (float(r) ** 2 + float(f) ** 2 + (m / 100) ** 2) / count
                if moved <= TOLERANCE * spread:
                    active.remove(s)
            if not active:
                break
    finally:
        rows.unpersist()
    best = max(sorted(held), key=held.__getitem__)
    own = F.col("own")
    mean = {c: F.lit(t / n) for c, t in zip(FEATURES, totals, strict=True)}
    labelled = rfm.withColumns({"money": cents / 100, "own": _constant(centers[best], "array<array<double>>")})
    labelled = labelled.withColumn("cluster", _nearest("own", k))
    at = [own[F.col("cluster")][i] for i in range(len(FEATURES))]
    return labelled.select(
        "customer_id",
        *FEATURES,
        "cluster",
        cluster_name(at, mean).alias("segment"),
        F.lit(squares - held[best]).alias("training_cost"),
    )


def value_by_cluster(clustered: DataFrame) -> DataFrame:
    """Mean revenue of a customer per named cluster, highest first."""
    return (
        clustered.groupBy("segment")
        .agg(F.count("*").alias("customers"), F.avg("monetary").alias("average_monetary"))
        .orderBy(F.desc("average_monetary"), "segment")
    )


# --- forecast ----------------------------------------------------------------------------------

SEASON = 7
MIN_DAYS = 14
FORECAST_SCHEMA = (
    "series string, step int, day date, mean double, lower double, upper double"
)


def _difference(y: np.ndarray) -> np.ndarray:
    d = y[1:] - y[:-1]
    return d[SEASON:] - d[:-SEASON]


def _lag_polynomials(theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """AR and MA polynomials of the (1,.,1)(1,.,1) model with a season of seven."""
    phi, seasonal_phi, ma, seasonal_ma = theta
    ar, mov = np.zeros(SEASON + 2), np.zeros(SEASON + 2)
    ar[[0, 1, SEASON, SEASON + 1]] = 1.0, -phi, -seasonal_phi, phi * seasonal_phi
    mov[[0, 1, SEASON, SEASON + 1]] = 1.0, ma, seasonal_ma, ma * seasonal_ma
    return ar, mov


def _innovations(w: np.ndarray, thetas: np.ndarray, exact: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kalman recursion of the state-space form, one column per coefficient row: one-step errors, their variances
    (in units of the shock variance) and the state expected after the last value.

    The first state has the stationary distribution, so the likelihood is exact. When the variance has come down to
    that of a shock, the gain stays as it is and only the state moves on. Not ``exact``: as if that were so from the
    start, with no shocks before it, which is several times faster.
    """
    polynomials = [_lag_polynomials(theta) for theta in thetas]
    lags = -np.array([p[0] for p in polynomials])
    shock = np.array([p[1] for p in polynomials])
    m, r = shock.shape
    gain, both, live = np.hstack((shock[:, 1:] + lags[:, 1:], np.zeros((m, 1)))), np.zeros((1, m, r)), exact
    if exact:
        move = np.zeros((m, r, r))
        move[:, : r - 1, 0] = lags[:, 1:]
        move[:, np.arange(r - 1), np.arange(1, r)] = 1.0
        spread, power = shock[:, :, None] * shock[:, None, :], move.copy()
        for _ in range(12):  # the sum over all steps back, twice as many each time
            spread = spread + power @ spread @ power.transpose(0, 2, 1)
            power = power @ power
        # The change of the state's covariance has rank one (Chandrasekhar's recursion): a vector and a factor hold it.
        variance = spread[:, 0, 0]
        gain = (move @ spread[:, :, :1])[:, :, 0] / variance[:, None]
        factor = -variance
        both = np.stack((both[0], gain))  # the state, and the vector of the change: both move alike
    errors, variances = np.empty((len(w), m)), np.ones((len(w), m))
    ar = np.hstack((lags[:, 1:], np.zeros((m, 1))))
    for t, value in enumerate(w):
        first = both[:, :, 0].copy()
        errors[t] = error = value - first[0]
        ahead = ar * first[:, :, None]
        ahead[:, :, :-1] += both[:, :, 1:]
        ahead[0] += gain * error[:, None]
        if live:
            variances[t] = variance
            step = factor * first[1]
            after = variance + step * first[1]
            gain = (gain * variance[:, None] + ahead[1] * step[:, None]) / after[:, None]
            ahead[1] -= gain * first[1][:, None]
            factor, variance = factor + step * step / variance, after
            if not t % 16 and np.abs(variance - 1).max() < 1e-6:
                live, ahead = False, ahead[:1]
        both = ahead
    state = both[0]
    return errors, variances, state


def _scaled(w: np.ndarray, thetas: np.ndarray, exact: bool) -> np.ndarray:
    """Errors whose sum of squares is least where the likelihood is greatest."""
    errors, variances, _ = _innovations(w, thetas, exact)
    return errors / np.sqrt(variances) * np.exp(np.log(variances).mean(axis=0) / 2)


def _with_steps(theta: np.ndarray, size: float = 1e-5) -> np.ndarray:
    return np.vstack([theta, theta + size * np.eye(4)])


def _fit(w: np.ndarray) -> np.ndarray:
    """Greatest likelihood, sought from where the faster conditional sum of squares is least."""
    return _descend(w, _descend(w, np.zeros(4), 30, exact=False), 3, exact=True)


def _descend(w: np.ndarray, theta: np.ndarray, most: int, exact: bool) -> np.ndarray:
    """Damped Gauss-Newton with coefficients inside (-1, 1)."""
    damping = 1e-2
    columns = _scaled(w, _with_steps(theta), exact)
    for _ in range(most):
        errors = columns[:, 0]
        jac = (columns[:, 1:] - columns[:, :1]) / 1e-5
        normal = jac.T @ jac
        step = np.linalg.lstsq(
            normal + damping * np.diag(np.diag(normal) + 1e-12), -jac.T @ errors, rcond=None
        )[0]
        trial = np.clip(theta + step, -0.98, 0.98)
        trial_columns = _scaled(w, _with_steps(trial), exact)
        cost, trial_cost = errors @ errors, trial_columns[:, 0] @ trial_columns[:, 0]
        if trial_cost < cost:
            theta, columns, damping = trial, trial_columns, damping / 3
            if 1 - trial_cost / cost < 1e-5:
                break
        else:
            damping *= 4
            if damping > 1e8:
                break
    return theta


def seasonal_forecast(y: np.ndarray, steps: int, z: float = 1.959963984540054) -> np.ndarray:
    """Mean, lower and upper limit of the next ``steps`` values as an array of three columns."""
    w = _difference(y)
    theta = _fit(w) if np.ptp(w) > 0 else np.zeros(4)
    errors, variances, state = _innovations(w, theta[None])
    ar, mov = _lag_polynomials(theta)
    differencing = np.convolve([1.0, -1.0], np.r_[1.0, np.zeros(SEASON - 1), -1.0])
    full_ar = np.convolve(ar, differencing)
    # The differenced values expected ahead follow from the state alone; then the differences are undone.
    state = state[0]
    history = np.r_[y, np.zeros(steps)]
    for t in range(len(y), len(y) + steps):
        history[t] = state[0] - differencing[1:] @ history[t - SEASON - 1 : t][::-1]
        state = np.r_[state[1:], 0.0] - np.r_[ar[1:], 0.0] * state[0]
    weights = np.zeros(steps)
    for j in range(steps):
        own = mov[j] if j < len(mov) else 0.0
        back = min(j, len(full_ar) - 1)
        weights[j] = own - full_ar[1 : back + 1] @ weights[j - back : j][::-1] if j else 1.0
    sigma = np.sqrt((errors**2 / variances).mean()) if len(w) else 0.0
    spread = z * sigma * np.sqrt(np.cumsum(weights**2))
    mean = history[len(y) :]
    return np.column_stack([mean, mean - spread, mean + spread])


def _forecast_series(pdf: pd.DataFrame, steps: int) -> pd.DataFrame:
    days = pdf.sort_values("day")
    if len(days) < MIN_DAYS:
        return pd.DataFrame(columns=["series", "step", "day", "mean", "lower", "upper"])
    values = seasonal_forecast(days["total_sale"].to_numpy(dtype=float), steps)
    last = pd.Timestamp(days["day"].iloc[-1])
    return pd.DataFrame(
        {
            "series": days["series"].iloc[0],
            "step": np.arange(1, steps + 1, dtype="int32"),
            "day": [(last + pd.Timedelta(days=i)).date() for i in range(1, steps + 1)],
            "mean": values[:, 0],
            "lower": values[:, 1],
            "upper": values[:, 2],
        }
    )


def sales_forecast(sales: DataFrame, by: str | Sequence[str] | None = None, steps: int = 30) -> DataFrame:
    """Forecast of daily revenue with a 95 percent interval, for all sales or one series per key or combination of keys.

    A (1,1,1)(1,1,1)7 model in state-space form, fitted by exact likelihood. A group holds one value per calendar day,
    whatever the number of sales behind it, so series are fitted independently and in parallel. Series of fewer
    than 14 days give no rows.
    """
    keys = [by] if isinstance(by, str) else list(by or ())
    keyed = sales.withColumn("series", F.concat_ws(" / ", *keys) if keys else F.lit("ALL"))
    daily = daily_sales(keyed, "series").withColumn("total_sale", F.col("total_sale").cast("double"))
    # A fit costs far more than its bytes suggest, so the series keep all shuffle partitions instead of
    # being packed into few tasks by size.
    tasks = int(sales.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return daily.repartition(tasks, "series").groupBy("series").applyInPandas(
        lambda pdf: _forecast_series(pdf, steps), FORECAST_SCHEMA
    )
