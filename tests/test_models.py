import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import models


def customers(spark, per_group=30):
    """Four well separated groups of customers."""
    rng = np.random.default_rng(5)
    rows = []
    for group, (days, orders, money) in enumerate([(5, 9, 9000), (300, 1, 50), (60, 6, 2500), (60, 1, 100)]):
        for i in range(per_group):
            last = pd.Timestamp("2024-06-30") - pd.Timedelta(days=days + int(rng.integers(0, 3)))
            for o in range(orders):
                amount = round(money / orders + rng.random(), 2)
                rows.append((group * 1000 + i, f"{group}-{i}-{o}", last - pd.Timedelta(days=o), amount))
    frame = pd.DataFrame(rows, columns=["customer_id", "order_id", "order_date", "total_sale"])
    return spark.createDataFrame(frame).withColumns(
        {"order_date": F.col("order_date").cast("timestamp_ntz"), "total_sale": F.col("total_sale").cast("decimal(18,2)")}
    )


def test_clusters_follow_the_naming_rule(spark):
    rows = models.customer_clusters(customers(spark), "2024-07-01 00:00:00", restarts=3).toPandas()
    assert len(rows) == 120
    mean = rows[models.FEATURES].mean()
    for _, own in rows.groupby("cluster"):
        center = own[models.FEATURES].mean()
        if center["monetary"] > mean["monetary"] and center["recency"] < mean["recency"]:
            expected = "Champions"
        elif center["recency"] > mean["recency"] * 1.5:
            expected = "À Risque"
        elif center["frequency"] > mean["frequency"]:
            expected = "Clients Loyaux"
        else:
            expected = "Standard"
        assert set(own["segment"]) == {expected}
    assert {"Champions", "À Risque"} & set(rows["segment"])
    value = models.value_by_cluster(spark.createDataFrame(rows)).toPandas()
    assert value["average_monetary"].is_monotonic_decreasing


def lloyd(points, centers):
    """Plain passes of one start, to the same rule."""
    spread = points.var(axis=0).mean()
    while True:
        label = ((points[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([points[label == j].mean(axis=0) if (label == j).any() else c for j, c in enumerate(centers)])
        moved = ((new - centers) ** 2).sum(axis=1).max()
        cost = sum(((points[label == j] - new[j]) ** 2).sum() for j in range(len(centers)))
        centers = new
        if moved <= models.TOLERANCE * spread:
            return cost, centers


def test_all_starts_run_together_and_the_best_is_kept(spark, monkeypatch):
    import hashlib

    passes = []
    one = models._lloyd_pass
    monkeypatch.setattr(models, "_lloyd_pass", lambda rows, centers, k: (passes.append(len(centers)), one(rows, centers, k))[1])
    rows = models.customer_clusters(customers(spark), "2024-07-01 00:00:00", restarts=5, seed=7).toPandas()
    points = rows[models.FEATURES].to_numpy(float)
    found = []
    for s in range(7, 12):
        order = sorted(range(len(rows)), key=lambda i: hashlib.md5(f"{s}:{rows['customer_id'][i]}".encode()).hexdigest())
        found.append(lloyd(points, points[order[:4]]))
    cost, centers = min(found, key=lambda f: f[0])
    assert rows["training_cost"].iloc[0] == pytest.approx(cost, rel=1e-6)
    nearest = ((points[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (rows["cluster"] == nearest).all()
    assert passes[0] == 5 and passes == sorted(passes, reverse=True)  # one job for all starts that still move


def test_result_is_fixed_by_the_seed(spark):
    one = models.customer_clusters(customers(spark), "2024-07-01 00:00:00", restarts=3)
    two = models.customer_clusters(customers(spark).repartition(13), "2024-07-01 00:00:00", restarts=3)
    assert sorted(one.collect()) == sorted(two.collect())


def test_equal_customers_leave_clusters_empty(spark):
    same = customers(spark, 8).filter("customer_id < 1000").withColumns(
        {"order_date": F.lit("2024-01-01").cast("timestamp_ntz"), "total_sale": F.lit(5).cast("decimal(18,2)")}
    )
    rows = models.customer_clusters(same, "2024-07-01 00:00:00", restarts=2).collect()
    assert {r["cluster"] for r in rows} == {0} and rows[0]["training_cost"] == 0


def test_too_few_customers(spark):
    few = customers(spark).filter("customer_id < 3")
    assert models.customer_clusters(few, "2024-07-01 00:00:00").count() == 0


def seasonal(days=140, noise=1.0, seed=1):
    rng = np.random.default_rng(seed)
    t = np.arange(days)
    return 200 + 0.5 * t + 20 * np.sin(2 * np.pi * t / 7) + rng.normal(0, noise, days)


def test_forecast_of_a_seasonal_series():
    y = seasonal(170)
    out = models.seasonal_forecast(y[:140], 30)
    assert out.shape == (30, 3)
    assert np.abs(out[:, 0] - y[140:]).mean() < 4
    inside = (y[140:] >= out[:, 1]) & (y[140:] <= out[:, 2])
    assert inside.mean() > 0.8
    width = out[:, 2] - out[:, 1]
    assert (np.diff(width) > -1e-9).all()


def test_forecast_is_exact_without_noise():
    y = seasonal(100, noise=0)
    out = models.seasonal_forecast(y[:70], 30)
    assert np.allclose(out[:, 0], y[70:], atol=1e-6)


def test_forecast_recovers_coefficients():
    rng = np.random.default_rng(8)
    e = rng.normal(size=3000)
    w = np.zeros(3000)
    for t in range(1, 3000):
        w[t] = 0.5 * w[t - 1] + e[t] + 0.3 * e[t - 1]
    phi, seasonal_phi, ma, seasonal_ma = models._fit(w)
    assert phi == pytest.approx(0.5, abs=0.08) and ma == pytest.approx(0.3, abs=0.08)


def test_likelihood_equals_the_dense_one():
    """Against the multivariate normal density of the same model, from its own covariances."""
    rng = np.random.default_rng(4)
    w, theta = rng.normal(size=40), np.array([0.5, 0.3, -0.4, -0.6])
    ar, mov = models._lag_polynomials(theta)
    psi = np.zeros(1500)
    for j in range(len(psi)):
        psi[j] = (mov[j] if j < len(mov) else 0) - sum(ar[i] * psi[j - i] for i in range(1, min(j, 8) + 1))
    cov = np.array([psi[: len(psi) - k] @ psi[k:] for k in range(40)])
    dense = cov[np.abs(np.subtract.outer(np.arange(40), np.arange(40)))]
    errors, variances, _ = models._innovations(w, theta[None])
    assert (errors**2 / variances).sum() == pytest.approx(w @ np.linalg.solve(dense, w), rel=1e-6)
    assert np.log(variances).sum() == pytest.approx(np.linalg.slogdet(dense)[1], abs=1e-5)


def test_one_series_per_combination(spark):
    rows = [("m1", "t1", d) for d in range(20)] + [("m1", "t2", d) for d in range(30)] + [("m2", "t1", d) for d in range(5)]
    df = spark.createDataFrame(rows, "model_name string, theme string, d int").select(
        "model_name",
        "theme",
        (F.lit("2024-01-01").cast("date") + F.col("d")).cast("timestamp_ntz").alias("order_date"),
        (F.col("d") % 7 + 10).cast("decimal(18,2)").alias("total_sale"),
    )
    got = models.sales_forecast(df, ["model_name", "theme"], steps=3).toPandas()
    assert got.groupby("series").size().to_dict() == {"m1 / t1": 3, "m1 / t2": 3}
    # A whole number of weeks and no noise: the series goes on as it was.
    assert np.allclose(got[got["series"] == "m1 / t1"].sort_values("step")["mean"], [16, 10, 11], atol=1e-6)


def test_forecast_many_series(spark):
    frames = []
    for key, days in (("a", 60), ("b", 40), ("short", 13)):
        frames.append(pd.DataFrame({"theme": key, "d": range(days), "v": seasonal(days)}))
    df = spark.createDataFrame(pd.concat(frames)).select(
        "theme",
        (F.lit("2024-01-01").cast("date") + F.col("d").cast("int")).cast("timestamp_ntz").alias("order_date"),
        F.col("v").cast("decimal(18,2)").alias("total_sale"),
    )
    rows = models.sales_forecast(df, "theme").toPandas()
    assert rows.groupby("series").size().to_dict() == {"a": 30, "b": 30}
    first = rows[(rows["series"] == "a") & (rows["step"] == 1)].iloc[0]
    assert str(first["day"]) == "2024-03-01" and first["lower"] < first["mean"] < first["upper"]
    assert models.sales_forecast(df.filter("theme = 'short'")).count() == 0


def test_constant_series():
    out = models.seasonal_forecast(np.full(20, 5.0), 3)
    assert np.allclose(out, 5.0)
