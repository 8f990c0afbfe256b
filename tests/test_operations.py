"""Lineage, alerts, cost, run and load statistics, routing, support orders."""

from decimal import Decimal

from pyspark.sql import functions as F

from support import at, tuples
from ledgerloom.operators import alerts, cost, lineage, monitoring, relational
from ledgerloom.schemas import ALERT_HISTORY, COST_METRICS, LINEAGE, LOAD_LOG, RUN_HISTORY, USAGE

NOW = "2024-01-31 12:00:00"


def test_lineage_paths(spark):
    edges = lineage.lineage_table(spark, NOW)
    assert edges.columns == LINEAGE.names
    paths = {r["lineage_id"]: r for r in lineage.lineage_paths(edges).collect()}
    assert len(paths) == 7
    assert paths["L006"]["root_source"] == "@CC_STAGE"
    assert paths["L006"]["lineage_path"].endswith("CC_TRANS_ALL -> CC_TRANS_AUDITOR_VIEW")


def test_lineage_skips_level_gaps(spark):
    rows = [("a", "x", "y", "K", 1), ("b", "y", "z", "K", 3), ("c", "y", "w", "K", 2)]
    edges = spark.createDataFrame(
        rows, "lineage_id string, source_object string, target_object string, transformation_type string, dependency_level int"
    )
    assert [r["lineage_id"] for r in lineage.lineage_paths(edges).orderBy("lineage_id").collect()] == ["a", "c"]


EDGES = "lineage_id string, source_object string, target_object string, transformation_type string, dependency_level int"


def test_lineage_of_depth_eight_reads_each_level_once(spark, monkeypatch):
    rows = [(f"{k}{s}", f"o{k}{s}", f"o{k + 1}{s}", "K", k) for k in range(1, 9) for s in "ab"]
    written = []
    keep = lineage.checkpointed
    monkeypatch.setattr(lineage, "checkpointed", lambda df: (written.append(keep(df)), written[-1])[1])
    paths = lineage.lineage_paths(spark.createDataFrame(rows, EDGES))
    assert [df.count() for df in written] == [16] + [2] * 8 + [0]  # the edges, then each level, then nothing
    assert "Join" not in paths._jdf.queryExecution().executedPlan().toString()
    last = paths.filter("dependency_level = 8 AND root_source = 'o1a'").first()["lineage_path"]
    assert last == " -> ".join(f"o{k}a" for k in range(1, 10))


def test_reachable_objects_with_cycles_and_shortcuts(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("a", "d"), ("d", "d"), ("x", "y"), ("x", "y")]
    edges = spark.createDataFrame([("i", s, t, "K", 1) for s, t in pairs], EDGES)
    got = {(r["root_source"], r["target_object"]): r["distance"] for r in lineage.reachable_objects(edges).collect()}
    cycle = {(s, t): (("abc".index(t) - "abc".index(s)) % 3 or 3) for s in "abc" for t in "abc"}
    assert got == cycle | {("a", "d"): 1, ("b", "d"): 2, ("c", "d"): 1, ("d", "d"): 1, ("x", "y"): 1}
    assert lineage.reachable_objects(edges.limit(0)).count() == 0


def test_impact(spark):
    rows = {r["source_object"]: r for r in lineage.impact_analysis(lineage.lineage_table(spark, NOW)).collect()}
    top = rows["CC_TRANS_ALL"]
    assert top["downstream_objects"] == "CC_TRANS_ANALYST_VIEW, CC_TRANS_AUDITOR_VIEW, DATA_QUALITY_METRICS"
    assert (top["impact_count"], top["max_depth"]) == (3, 5)


def backlog(spark, n):
    return spark.createDataFrame([(n,)], "pending long")


def test_alert_run(spark, make_cards):
    cards = make_cards(
        {"amount": Decimal("5000.01"), "transaction_timestamp": at("2024-01-31 11:56:00")},
        {"amount": Decimal("5000.00"), "transaction_timestamp": at("2024-01-31 11:56:00")},
        {"amount": Decimal("9000.00"), "transaction_timestamp": at("2024-01-31 11:50:00"), "approved": False},
        {"amount": Decimal("9000.00"), "transaction_timestamp": at("2024-01-31 11:45:00")},  # limit is out
    )
    row = alerts.run_alerts(cards, backlog(spark, 1000), NOW).first()
    assert (row["high_value_count"], row["approval_rate"], row["alert_count"]) == (1, 67, 2)
    assert row["message"] == (
        "ALERTS TRIGGERED (2): HIGH VALUE ALERT: 1 transactions over $5000 detected. "
        "APPROVAL RATE ALERT: Rate dropped to 67%. "
    )


def test_approval_rate_rounds_before_comparing(spark, make_cards):
    rows = [{"approved": i >= 51} for i in range(250)]  # 79.6 percent
    row = alerts.run_alerts(make_cards(*rows), backlog(spark, 0), NOW).first()
    assert (row["approval_rate"], row["alert_count"]) == (80, 0)
    assert row["message"] == "No alerts triggered - system operating normally"


def test_no_rows_no_alert(spark, make_cards):
    row = alerts.run_alerts(make_cards({}).limit(0), backlog(spark, 1001), NOW).first()
    assert (row["approval_rate"], row["alert_count"]) == (None, 1)


def test_rules_and_history(spark, make_cards):
    cards = make_cards({"amount": Decimal("5000.00")}, {"amount": Decimal("10.00")})
    metrics = spark.createDataFrame([(Decimal("89.0000"), at("2024-01-31 11:55:00"))], "metric_value decimal(10,4), measurement_timestamp timestamp_ntz")
    measured = alerts.measured_alerts(cards, metrics, backlog(spark, 1000), NOW)
    result = alerts.evaluate_rules(alerts.alert_config(spark, NOW), measured)
    got = {r["alert_id"]: (int(r["alert_value"]), r["is_triggered"]) for r in result.collect()}
    # Equal to the threshold does not trigger.
    assert got == {"A001": (5000, False), "A002": (100, False), "A003": (89, True), "A004": (1000, False), "A005": (2, True)}
    history = alerts.history_rows(result, NOW)
    assert history.columns == ALERT_HISTORY.names
    assert {r["alert_id"] for r in history.collect()} == {"A003", "A005"}


def test_alert_history_is_appended(spark, tmp_path):
    rows = spark.createDataFrame([("A1", "n", Decimal(1), 0, at(NOW), "m", None, None)], ALERT_HISTORY)
    for _ in range(2):
        rows.write.mode("append").parquet(str(tmp_path / "history"))
    assert spark.read.parquet(str(tmp_path / "history")).count() == 2


def test_cost(spark):
    usage = spark.createDataFrame(
        [
            ("W1", Decimal("1.000000"), 0, 61_000, 5, at("2024-01-31 01:00:00")),
            ("W1", Decimal("1.000000"), 5, 10, 5, at("2024-01-31 01:00:00")),
            ("W1", Decimal("1.000000"), 5, 10, 5, at("2024-01-31 02:00:00")),  # same facts again
            ("W2", Decimal("0.100000"), 5, 1_500, 1_000_000_001, at("2024-01-30 00:00:00")),
            ("W2", Decimal("0.100000"), 0, 10, 10, at("2024-01-30 00:00:00")),
            ("W2", Decimal("0.100000"), 5, 10, 10, at("2024-01-29 23:59:59")),  # too old
        ],
        USAGE,
    )
    rows = cost.cost_rows(usage, NOW)
    assert rows.columns == COST_METRICS.names and rows.count() == 4
    advice = {(r["warehouse_name"], r["query_count"]): r["optimization_opportunities"] for r in rows.collect()}
    assert advice == {
        ("W1", 0): "Consider query optimization",
        ("W1", 5): "High cost per query",
        ("W2", 5): "Consider result caching",
        ("W2", 0): "Operating efficiently",
    }
    assert {r["avg_execution_time_seconds"] for r in rows.collect()} == {61, 0, 2}
    board = {r["warehouse_name"]: r for r in cost.cost_dashboard(rows, NOW).collect()}
    assert (board["W1"]["total_credits"], board["W1"]["optimization_checks"]) == (2.0, 2)
    assert board["W1"]["avg_cost_per_query"] == 0.2
    assert board["W1"]["recommendations"] == "Consider query optimization; High cost per query"


def test_run_statistics(spark):
    rows = [
        ("load", "SUCCEEDED", at("2024-01-01 00:00:00.900000"), at("2024-01-01 00:00:02.100000")),
        ("load", "FAILED", at("2024-01-01 00:00:00"), at("2024-01-01 00:00:09")),
        ("refine", "EXECUTING", at("2024-01-01 00:00:00"), None),
    ]
    history = spark.createDataFrame(rows, RUN_HISTORY)
    assert tuples(monitoring.run_durations(history)) == [("load", 2.0, 2, 2)]
    assert tuples(monitoring.runs_by_state(history)) == [
        ("load", "FAILED", 1, 9.0), ("load", "SUCCEEDED", 1, 2.0), ("refine", "EXECUTING", 1, None),
    ]


def test_load_statistics(spark):
    rows = [
        ("T", "f1", "LOADED", 5, 5, 0, 100, at("2024-01-01 00:10:00"), None),
        ("T", "f2", "LOAD_FAILED", 2, 0, 2, 50, at("2024-01-01 00:50:00"), "x"),
    ]
    log = spark.createDataFrame(rows, LOAD_LOG)
    assert tuples(relational.load_volume(log)) == [("T", 5, 150, 2)]
    assert [r["file_name"] for r in relational.failed_loads(log).collect()] == ["f2"]
    assert tuples(relational.hourly_files(log).drop("hour")) == [(2, 150, 75.0)]


def test_routes(spark):
    df = spark.createDataFrame([("Idol A", 50.0), ("Idol B", 200.0), ("Mug", 100.0), ("Mug", 100.01)], "item string, amount double")
    got = tuples(relational.route_events(df, "item", "amount", "Idol", 100).select("item", "route"))
    assert got == [("Idol A", "FULFILLMENT"), ("Idol B", "FULFILLMENT"), ("Idol B", "VIP"), ("Mug", "VIP")]


def test_states_and_shares(spark):
    rows = [("a", '{"state": "NY"}', "n1"), ("a", '{"state": "NY"}', "n1"), ("b", "null", "n2"), ("b", None, "n3"), ("a", '{"city": "x"}', "n4")]
    support = spark.createDataFrame(rows, "item string, address string, name string").withColumn("address", F.parse_json("address"))
    assert tuples(relational.orders_by_state(support)) == [("NY", 2, 1), (None, 1, 1)]
    assert tuples(relational.market_share(support)) == [("a", 3, 60.0), ("b", 2, 40.0)]


def test_statistics_and_names(spark, make_cards):
    cards = make_cards({"amount": Decimal("1.00")}, {"amount": Decimal("2.00")}, {"amount": Decimal("9.00"), "approved": False})
    assert tuples(relational.group_statistics(cards, "approved")) == [(False, 1, 9.0, 9.0, 9.0, 9.0), (True, 2, 1.5, 1.0, 2.0, 3.0)]
    assert relational.approved_headline(cards).first()["avg_approved_amount"] == 1.5
    assert relational.upper_case_columns(cards.select("amount")).columns == ["AMOUNT"]
