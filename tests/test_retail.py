import itertools
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from support import at, tuples
from ledgerloom.operators import facts, retail as ops, rfm


@pytest.fixture(scope="module")
def sales(shop):
    return facts.sales_fact(shop)


@pytest.fixture(scope="module")
def pdf(sales):
    return sales.withColumn("total_sale", F.col("total_sale").cast("double")).toPandas()


def test_sales_fact(pdf):
    """Cancelled, unknown customer, unknown product and unknown order are out."""
    assert sorted(pdf["order_id"]) == ["o1", "o1", "o1", "o2", "o2", "o3", "o3"]
    assert pdf["total_sale"].sum() == pytest.approx(20 + 10 + 20 + 20 + 0 + 10 + 39)


def test_kpi_row(sales):
    assert tuples(ops.kpi_row(sales)) == [(119.0, 3, 2)]


def test_slice_ends_at_midnight(sales):
    kept = facts.filter_sales(sales, "2024-01-01", "2024-02-10", themes=["Space"])
    assert {r["order_id"] for r in kept.collect()} == {"o1", "o2"}
    assert facts.filter_sales(sales, "2024-01-01", "2024-02-11", models=["Beta"]).count() == 3


def test_daily_trend_fills_gaps(sales, pdf):
    series = pdf.set_index("order_date").resample("D")["total_sale"].sum()
    mean = series.rolling(window=7).mean()
    got = ops.daily_trend(sales).toPandas().sort_values("day")
    assert got["total_sale"].tolist() == pytest.approx(series.tolist())
    assert np.allclose(got["moving_average"].astype(float), mean, equal_nan=True)


def test_affinity_ignores_repeats(sales):
    assert tuples(ops.top_affinity(sales)) == [("Alpha & Beta", 2), ("Beta & Gamma", 1)]


def test_affinity_needs_two_orders(sales):
    assert ops.top_affinity(sales.filter("order_id = 'o1'")).count() == 0


def random_sales(spark, seed=3, orders=40, lines=300, hot=0.0):
    rng = np.random.default_rng(seed)
    order = rng.integers(0, orders, lines)
    order[rng.random(lines) < hot] = 0
    frame = pd.DataFrame(
        {
            "order_id": order,
            "customer_id": order % 7,
            "model_name": rng.choice(list("ABCDE"), lines),
            "theme": rng.choice(["t1", "t2"], lines),
            "sales_channel": np.where(order % 2 == 0, "online", "in_person"),
            "total_sale": rng.integers(1, 1000, lines) / 100,
        }
    )
    frame["order_date"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(order * 5, unit="D")
    df = spark.createDataFrame(frame).withColumns(
        {"order_date": F.col("order_date").cast("timestamp_ntz"), "total_sale": F.col("total_sale").cast("decimal(18,2)")}
    )
    return df, frame


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_pairs_against_brute_force(spark, hot):
    """Also with one order that holds a large share of all lines."""
    df, frame = random_sales(spark, hot=hot)
    distinct, multiple = Counter(), Counter()
    for _, basket in frame.groupby("order_id")["model_name"]:
        distinct.update(itertools.combinations(sorted(set(basket)), 2))
        multiple.update(tuple(sorted(p)) for p in itertools.combinations(basket, 2))
    assert {(r["a"], r["b"]): r["pair_count"] for r in ops.basket_affinity(df).collect()} == distinct
    assert {(r["a"], r["b"]): r["weight"] for r in ops.copurchase_edges(df).collect()} == multiple
    nodes = Counter(n for pair in multiple for n in set(pair))
    assert {r["model_name"]: r["degree"] for r in ops.network_degrees(df).collect()} == nodes
    assert tuples(ops.network_summary(df)) == [(len(nodes), len(multiple), max(multiple.values()))]
    relative = {r["relative_weight"] for r in ops.copurchase_network(df).collect()}
    assert max(relative) == 1.0


def test_cohorts_against_pandas(spark):
    df, frame = random_sales(spark)
    month = frame["order_date"].dt.to_period("M")
    first = month.groupby(frame["customer_id"]).transform("min")
    index = (month.dt.year - first.dt.year) * 12 + (month.dt.month - first.dt.month)
    counts = frame["customer_id"].groupby([first, index]).nunique()
    expected = {
        (str(c), int(i)): (int(n), pytest.approx(n / counts[(c, 0)] * 100)) for (c, i), n in counts.items()
    }
    got = {
        (r["cohort_month"], r["cohort_index"]): (r["customers"], r["retention"])
        for r in ops.cohort_retention(df).collect()
    }
    assert got == expected
    assert all(v[1] == 100 for k, v in got.items() if k[1] == 0)
    wide = ops.cohort_matrix(df).toPandas().set_index("cohort_month")
    for (cohort, offset), (_, rate) in got.items():
        assert wide.loc[cohort, f"month_{offset}"] == rate


def test_running_totals_merge_namesakes(sales):
    got = tuples(ops.customer_running_totals(sales))
    assert got == [("Ana Lopez", "2024-01", 70.0), ("Ana Lopez", "2024-02", 119.0)]
    assert ops.customer_race(sales, 1).count() == 2


def test_profiles(sales, shop):
    rows = {r["customer_id"]: r for r in ops.customer_profiles(sales, shop.customers).collect()}
    assert set(rows) == {"c1", "c2"}
    c1 = rows["c1"]
    assert (c1["lines"], c1["total_sale"], c1["last_order"]) == (5, 99.0, "2024-02-10")
    assert c1["average_sale"] == pytest.approx(99 / 5)
    assert (c1["top_models"], c1["top_themes"]) == ("Alpha:3, Beta:2", "Space:5")
    assert (c1["customer"], c1["preferred_channel"]) == ("Ana Lopez", "online")


def test_profile_without_channel(spark, sales, shop):
    bare = sales.withColumn("sales_channel", F.lit(None).cast("string"))
    rows = ops.customer_profiles(bare, shop.customers).collect()
    assert {r["preferred_channel"] for r in rows} == {"N/A"}


def test_profiles_against_pandas(spark, shop):
    df, frame = random_sales(spark, hot=0.4)
    people = spark.createDataFrame([(i, f"f{i}", "l") for i in range(7)], "customer_id long, first_name string, last_name string")
    for row in ops.customer_profiles(df, people).collect():
        own = frame[frame["customer_id"] == row["customer_id"]]
        counts = sorted(own["model_name"].value_counts().items(), key=lambda kv: (-kv[1], kv[0]))[:3]
        assert row["top_models"] == ", ".join(f"{k}:{v}" for k, v in counts)
        assert row["lines"] == len(own)


def test_price_scenarios_truncate_like_int(spark, sales, pdf):
    got = {(r["model_name"], r["price_change"]): r for r in ops.price_scenarios(sales).collect()}
    assert len(got) == 3 * 21
    for (model, change), row in got.items():
        own = pdf[pdf["model_name"] == model]
        price = own["price_at_purchase"].astype(float).sum() / len(own)
        quantity = int(len(own) * (1 + (-1.5 * change) / 100))
        assert row["new_quantity"] == quantity
        assert row["new_revenue"] == pytest.approx(price * (1 + change / 100) * quantity)


def test_hierarchy_sums_agree(sales):
    rows = ops.hierarchy_totals(sales).toPandas()
    assert {level: rows[rows["level"] == level]["total_sale"].sum() for level in (1, 2, 3)} == {
        1: 119.0, 2: 119.0, 3: 119.0,
    }


def test_flow_totals(sales):
    flows = ops.flow_counts(sales).toPandas()
    assert flows[flows["source"].str.startswith("Canal")]["value"].sum() == 7
    assert flows[flows["target"].str.startswith("Finish")]["value"].sum() == 7


def test_calendar(sales):
    matrix = {(r["week"], r["weekday"]): r["total_sale"] for r in ops.calendar_matrix(sales).collect()}
    assert matrix == {(1, 0): 50.0, (1, 2): 20.0, (6, 5): 49.0}
    assert ops.calendar_daily(sales).count() == 3


def test_questions(sales, shop):
    assert ops.best_month(sales).first()["month"] == "2024-01"
    assert [r["customer_id"] for r in ops.loyal_customers(sales, shop.customers, 1).collect()] == ["c1"]
    assert tuples(ops.new_customers_by_quarter(sales)) == [("2024-Q1", 2)]
    baskets = {r["sales_channel"]: r["average_basket"] for r in ops.basket_by_channel(sales).collect()}
    assert baskets == {"online": 49.5, "in_person": 20.0}
    assert {r["model_name"] for r in ops.best_sellers_by_theme(sales, 1).collect()} == {"Alpha", "Gamma"}


def test_rfm(sales):
    rows = {r["customer_id"]: r for r in rfm.rfm_table(sales).collect()}
    # Snapshot 2024-02-11 23:59:59.
    assert (rows["c1"]["recency"], rows["c1"]["frequency"], rows["c1"]["monetary"]) == (1, 2, 99.0)
    assert rows["c2"]["recency"] == 39
    aged = {r["customer_id"]: r["recency"] for r in rfm.rfm_table(sales, "2024-02-12 00:00:00").collect()}
    assert aged == {"c1": 1, "c2": 39}


def test_rfm_scores_against_pandas(spark):
    df, frame = random_sales(spark, orders=60, lines=400)
    df = df.withColumn("customer_id", F.col("order_id") % 23)
    frame["customer_id"] = frame["order_id"] % 23
    snapshot = frame["order_date"].max() + pd.Timedelta(days=1)
    base = frame.groupby("customer_id").agg(
        R=("order_date", lambda d: (snapshot - d.max()).days), F=("order_id", "nunique"), M=("total_sale", "sum")
    )

    def score(values, labels):
        try:
            return pd.qcut(values, 4, labels=labels, duplicates="drop").astype(int)
        except ValueError:
            return pd.Series(1, index=values.index)

    base["r"] = score(base["R"], [4, 3, 2, 1])
    base["f"] = score(base["F"].rank(method="first"), [1, 2, 3, 4])
    base["m"] = score(base["M"].round(2), [1, 2, 3, 4])
    got = rfm.rfm_scores(df).toPandas().set_index("customer_id").sort_index()
    assert got["r_score"].tolist() == base["r"].tolist()
    assert got["f_score"].tolist() == base["f"].tolist()
    assert got["m_score"].tolist() == base["m"].tolist()
    assert rfm.segment_counts(rfm.rfm_scores(df)).agg(F.sum("customers")).first()[0] == 23


def test_equal_recency_scores_one(spark):
    df, _ = random_sales(spark)
    same_day = df.withColumn("order_date", F.lit(at("2024-01-01 00:00:00")).cast("timestamp_ntz"))
    assert {r["r_score"] for r in rfm.rfm_scores(same_day).collect()} == {1}


def test_risk_overrides_loyalty(spark):
    rows = [(i, f"o{i}-{j}", 10, d) for i, n, d in ((1, 5, 1), (2, 1, 300), (3, 1, 301), (4, 1, 302), (5, 2, 303)) for j in range(n)]
    df = spark.createDataFrame(rows, "customer_id long, order_id string, total_sale int, d int").withColumn(
        "total_sale", F.col("total_sale").cast("decimal(18,2)")
    ).withColumn(
        "order_date", (F.lit("2024-01-01").cast("date") + F.col("d").cast("int")).cast("timestamp_ntz")
    )
    people = spark.createDataFrame([(i, "a", str(i)) for i in range(1, 6)], "customer_id long, first_name string, last_name string")
    segments = {r["customer_id"]: r["segment"] for r in rfm.quantile_segments(df, people).collect()}
    assert segments[1] == "À Risque"  # most frequent, yet the longest absent
