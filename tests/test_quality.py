from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from support import at, tuples
from ledgerloom.operators import facts, integrity, quality as ops, relational
from ledgerloom.schemas import QUALITY_METRICS

NOW = "2024-01-31 12:00:00"


@pytest.fixture(scope="module")
def frame(shop):
    return facts.quality_fact(shop)


@pytest.fixture(scope="module")
def odd_cards(make_cards):
    return make_cards(
        {"amount": Decimal("-1.00"), "transaction_id": 999_999_999},
        {"amount": Decimal("10000.00"), "card_number": 123, "transaction_type": "CHARGEBACK"},
        {"amount": Decimal("10000.01"), "card_number": 12345678901234},
        {"amount": None, "transaction_id": 10_000_000_000, "currency": "EUR"},
        {"transaction_id": None, "card_number": 123456789012345},
        {"card_number": 1234567890123456789},
        {"card_number": -400000000000123, "merchant_id": None},
        {"transaction_id": 1_000_000_001},
    )


def test_range_validation(odd_cards):
    assert tuples(ops.range_validation(odd_cards)) == [
        ("Amount Validation", 8, 1, 1, 1),
        ("Transaction ID Validation", 8, 1, 1, 1),
    ]


def test_empty_table_sums_are_null(odd_cards):
    empty = odd_cards.limit(0)
    row = ops.range_validation(empty).first()
    assert row["total_records"] == 0 and row["null_amounts"] is None
    assert ops.measure(empty, F.lit(None).cast("timestamp_ntz")).first()["metric_value"] is None


def test_null_report_and_format(odd_cards):
    report = ops.null_report(odd_cards).first()
    assert (report["null_transaction_id"], report["null_amount"], report["null_merchant_id"]) == (1, 1, 1)
    assert tuples(ops.card_format(odd_cards)) == [(8, 2, 0, 1)]


def test_duplicates(odd_cards):
    assert tuples(relational.repeated(odd_cards, "transaction_id")) == [(1_000_000_001, 5)]
    # NULL keys form one group.
    doubled = odd_cards.unionByName(odd_cards)
    assert relational.surplus_rows(doubled, "transaction_id").first()[0] == 16 - 4


def test_distribution_shares_sum_to_hundred(odd_cards):
    for _, rows in ops.distributions(odd_cards).toPandas().groupby("anomaly_check"):
        assert rows["percentage"].sum() == pytest.approx(100)
        assert rows["count"].sum() == 8


def test_metric_table(odd_cards):
    at_ = F.lit(NOW).cast("timestamp_ntz")
    metrics = ops.measure(odd_cards, at_)
    assert metrics.schema.simpleString() == QUALITY_METRICS.simpleString()
    values = {r["metric_name"]: r["metric_value"] for r in metrics.collect()}
    assert values["COMPLETENESS_AMOUNT"] == Decimal("87.5000")
    assert values["VALIDITY_AMOUNT_RANGE"] == Decimal("62.5000")
    assert values["VALIDITY_CARD_NUMBER_FORMAT"] == Decimal("75.0000")
    assert values["CONSISTENCY_CURRENCY_USD"] == Decimal("87.5000")
    assert values["CONSISTENCY_TRANSACTION_TYPES"] == Decimal("87.5000")


def metric(spark, *rows):
    full = [(n, "VALIDITY", None if v is None else Decimal(v), 10, at(t), "T") for n, v, t in rows]
    return spark.createDataFrame(full, QUALITY_METRICS)


def test_rating_edges(spark):
    rows = [("m", v, NOW) for v in ("95", "90", "80", "70", "69.9999", None)]
    got = [r["quality_rating"] for r in ops.dashboard(metric(spark, *rows)).collect()]
    assert got == ["EXCELLENT", "GOOD", "ACCEPTABLE", "POOR", "CRITICAL", "CRITICAL"]


def test_alert_edges(spark):
    rows = [("a", "69.9999", NOW), ("b", "70", NOW), ("c", "80", NOW), ("d", "80.0001", NOW), ("e", None, NOW)]
    got = {r["metric_name"]: r["alert_level"] for r in ops.quality_alerts(metric(spark, *rows)).collect()}
    assert got == {"a": "CRITICAL", "b": "WARNING", "c": "WARNING"}


def test_trends(spark):
    rows = [("a", "90", "2024-01-01 00:00:00"), ("a", "85", "2024-01-02 00:00:00"), ("b", "1", NOW)]
    got = tuples(ops.quality_trends(metric(spark, *rows)).select("metric_name", "previous_value", "trend_change"))
    assert got == [("a", Decimal("90.0000"), Decimal("-5.0000")), ("a", None, None), ("b", None, None)]


def test_monitor(spark, odd_cards):
    history = metric(
        spark, ("old", "10", "2024-01-30 11:59:59"), ("kept", "10", "2024-01-30 12:00:00"), ("hot", "10", "2024-01-31 11:30:00")
    )
    table, status = ops.monitor(odd_cards, history, NOW)
    assert {r["metric_name"] for r in table.collect()} == {"kept", "hot", "COMPLETENESS_TRANSACTION_ID"}
    assert status.first()["status"] == "ALERT: 1 critical data quality issues detected!"
    _, calm = ops.monitor(odd_cards, history.limit(0), NOW)
    assert calm.first()["status"] == "Data quality monitoring completed successfully"


# --- retail frame ------------------------------------------------------------------------------


def test_quality_fact_keeps_every_order(frame):
    rows = frame.toPandas()
    assert sorted(rows["order_id"].unique()) == ["o1", "o2", "o3", "o4", "o5", "o6", "o7"]
    assert len(rows) == 12
    assert rows[rows["order_id"] == "o5"]["customer_id"].isna().all()
    assert rows["product_id"].isna().sum() == 2  # order without items, unknown product


def test_missing_values(frame):
    got = {r["column_name"]: (r["missing"], r["percent"]) for r in ops.null_counts(frame).collect()}
    assert got["quantity"] == (2, 16.67)
    assert got["product_id"] == (2, 16.67)
    assert got["email"] == (4, 33.33)
    assert "order_id" not in got


def test_summary_against_pandas(frame):
    rows = frame.toPandas()
    missing = rows.isnull().sum().sum()
    cells = rows.size
    row = ops.frame_summary(frame, NOW).first()
    assert row["completeness"] == pytest.approx((cells - missing) / cells * 100)
    assert row["validity"] == pytest.approx((rows["total_sale"].astype(float) > 0).sum() / len(rows) * 100)


def test_consistency(frame):
    got = {r["check_name"]: (r["status"], r["success_rate"]) for r in ops.consistency_checks(frame, NOW).collect()}
    # NULL does not pass.
    assert got["Prix > 0"] == ("Failed", pytest.approx(83.33))
    assert got["Quantité > 0"] == ("Failed", 75.0)
    assert got["Date ≤ Aujourd'hui"][0] == "Failed"
    assert got["TOTAL_SALE = QTY × PRICE"] == ("Failed", pytest.approx(83.33))


def test_score(frame):
    row = ops.quality_score(frame, NOW).first()
    assert row["duplicate_rows"] == 1
    s = row["completeness"] * 0.3 + (100 - 100 / 12) * 0.2 + row["validity"] * 0.2 + row["mean_rate"] * 0.3
    assert row["quality_score"] == pytest.approx(s, abs=1e-3)
    assert row["band"] == ("GOOD" if s >= 80 else "INSUFFICIENT")


def test_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100, None or 2]], "total_sale double")
    row = ops.outlier_report(df).first()
    assert (row["outliers"], row["total_records"]) == (1, 6)


def test_freshness(frame):
    row = ops.freshness(frame, NOW).first()
    assert (row["newest"], row["oldest"]) == ("2030-01-01", "2024-01-01")
    assert row["days_since"] == -2162  # rounded down, also for a future order


def test_integrity(shop, frame):
    row = integrity.integrity_report(shop, frame).first()
    assert (row["orphan_items"], row["orders_without_items"]) == (1, 1)
    assert (row["orphan_customers"], row["orphan_products"]) == (1, 1)  # NULL customer not counted
    assert (row["total_orders"], row["cancelled_orders"], row["active_orders"]) == (7, 1, 6)
    assert not row["intact"]


def test_loss_and_null_keys(shop):
    row = integrity.join_loss(shop, facts.sales_fact(shop)).first()
    assert (row["joined_orders"], row["lost_orders"]) == (3, 3)
    assert row["lost_percent"] == 50.0
    nulls = shop.items.withColumn("order_id", F.lit(None).cast("string"))
    assert integrity.orphan_items(nulls, shop.orders).first()[0] == nulls.count()


def test_distinct_keys(frame):
    assert tuples(ops.distinct_keys(frame)) == [(7, 3, 3)]


def test_cancelled(shop):
    assert tuples(ops.cancelled_share(shop.orders)) == [(7, 1, pytest.approx(100 / 7))]
    assert ops.cancelled_share(shop.orders.limit(0)).first()["cancelled_percent"] == 0.0
