from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from support import at
from ledgerloom.functions.scalars import anonymous_number
from ledgerloom.operators import privacy as ops
from ledgerloom.schemas import RETENTION_POLICY
from ledgerloom.sources import sinks

NOW = "2024-01-31 12:00:00"
TIMES = {
    1: "2017-01-31 11:59:59",  # just over seven years
    2: "2017-01-31 12:00:00",
    3: "2022-01-31 11:59:59",  # just over two years
    4: "2022-01-31 12:00:00",
    5: "2024-01-30 12:00:00",
}


@pytest.fixture(scope="module")
def aged(make_cards):
    return make_cards(
        *[
            {"transaction_id": i, "transaction_timestamp": at(t), "card_number": 4_000_000_000_000_000 + i}
            for i, t in TIMES.items()
        ]
    )


def test_views_reveal_four_digits_at_most(make_cards):
    cards = make_cards({"amount": Decimal("150.00"), "card_number": 4111111111111234})
    analyst = ops.analyst_view(cards).first()
    assert analyst["masked_card_number"] == "****-****-****-1234"
    assert (analyst["amount"], analyst["transaction_date"]) == (200, at("2024-01-31 00:00:00"))
    auditor = ops.auditor_view(cards).first()
    assert (auditor["card_number"], auditor["amount_range"]) == ("MASKED", "100-500")
    assert auditor["transaction_month"] == at("2024-01-01 00:00:00")
    assert len(auditor["hashed_transaction_id"]) == 64


@pytest.mark.parametrize(
    "role, number, amount",
    [
        ("DATA_ADMIN_ROLE", 4111111111111234, "1000.00"),
        ("ACCOUNTADMIN", 4111111111111234, "1000.00"),
        ("ANALYST_ROLE", 1234, "1000.00"),
        ("AUDITOR_ROLE", 0, "750.00"),
        ("PUBLIC", 0, "0.00"),
    ],
)
def test_roles(make_cards, role, number, amount):
    cards = make_cards({"amount": Decimal("1000.00"), "card_number": 4111111111111234})
    row = ops.apply_masks(cards, role).first()
    assert (row["card_number"], row["amount"]) == (number, Decimal(amount))


def test_accessible_summary(make_cards):
    cards = make_cards({"amount": Decimal("1000.01")}, {"amount": Decimal("50.00")})
    rows = {r["current_role"]: r for r in ops.accessible_summary(cards, ["AUDITOR_ROLE", "PUBLIC"]).collect()}
    assert rows["AUDITOR_ROLE"]["avg_visible_amount"] == 775.0
    assert (rows["PUBLIC"]["accessible_records"], rows["PUBLIC"]["sample_card_number"]) == (2, 0)


def test_classification_drives_masks(make_cards):
    cards = make_cards({"amount": Decimal("149.00"), "card_number": 4111111111111234})
    row = ops.mask_by_classification(cards).first()
    assert (row["card_number"], row["amount"]) == ("1234", 100)
    assert len(row["transaction_id"]) == 64 and row["transaction_type"] == "PURCHASE"


def test_strategy_order(spark):
    rows = ops.masking_strategy(ops.classification(spark)).collect()
    assert [r["sensitivity_level"] for r in rows] == ["HIGH"] + ["MEDIUM"] * 3 + ["LOW"] * 4
    assert (rows[0]["masking_strategy"], rows[0]["masking_method"]) == ("FULL_MASKING", "Show only last 4 digits")


def test_policy_and_retention(spark, aged):
    policy = ops.retention_policy(spark, NOW)
    assert policy.columns == RETENTION_POLICY.names
    assert {r["table_name"]: str(r["next_cleanup_date"]) for r in policy.collect()}["CC_TRANS_STAGING"] == "2024-03-01"
    assert ops.retained(aged, "transaction_timestamp", 30, NOW).count() == 1
    report = ops.retention_report({"CC_TRANS_STAGING": (aged, "transaction_timestamp")}, NOW).first()
    assert (report["retained_rows"], report["expired_rows"]) == (1, 4)


def test_anonymise_limits(aged):
    rows = {r["transaction_id"]: r for r in ops.anonymise(aged, NOW).collect()}
    assert set(rows) == {2, 3, 4, 5}
    assert [i for i in rows if rows[i]["anonymised"]] == [2, 3]
    assert rows[4]["card_number"] == 4_000_000_000_000_004


def test_anonymise_stored_rewrites_only_old_days(spark, aged, tmp_path):
    path = str(tmp_path / "cards")
    sinks.write_partitioned(aged, path)
    recent = sorted(p.name for p in (tmp_path / "cards" / "transaction_date=2024-01-30").glob("*.parquet"))
    for run in ("first", "second"):
        ops.anonymise_stored(spark, path, str(tmp_path / run), NOW)
        rows = {r["transaction_id"]: r for r in spark.read.option("mergeSchema", True).parquet(path).collect()}
        assert set(rows) == {2, 3, 4, 5}
        for i in (2, 3):
            original = spark.range(1).select(anonymous_number(F.lit(4_000_000_000_000_000 + i))).first()[0]
            assert rows[i]["card_number"] == original  # hashed once, also after the second run
        assert rows[5]["card_number"] == 4_000_000_000_000_005
    assert recent == sorted(p.name for p in (tmp_path / "cards" / "transaction_date=2024-01-30").glob("*.parquet"))


def test_anonymise_stored_after_a_late_old_day(spark, aged, make_cards, tmp_path):
    path = str(tmp_path / "cards")
    sinks.write_partitioned(aged, path)
    ops.anonymise_stored(spark, path, str(tmp_path / "first"), NOW)
    done = {r["transaction_id"]: r["card_number"] for r in spark.read.parquet(path).collect()}
    late = make_cards({"transaction_id": 9, "transaction_timestamp": at("2021-01-01 00:00:00"), "card_number": 4_000_000_000_000_009})
    sinks.write_partitioned(late, path)  # no flag in this day, whose folder comes first
    ops.anonymise_stored(spark, path, str(tmp_path / "second"), NOW)
    rows = {r["transaction_id"]: r["card_number"] for r in spark.read.parquet(path).collect()}
    assert {i: rows[i] for i in done} == done
    expected = spark.range(1).select(anonymous_number(F.lit(4_000_000_000_000_009))).first()[0]
    assert set(rows) == {*done, 9} and rows[9] == expected


def test_samples(make_cards):
    cards = make_cards({}, {}, {}, {})
    rows = ops.masking_samples(cards).collect()
    assert len(rows) == 9 and {r["card_number"] for r in rows if r["data_type"].startswith("Auditor")} == {"MASKED"}


def test_inventory(make_cards):
    rows = ops.field_inventory(make_cards({}, {"amount": None})).collect()
    assert [r["field_name"] for r in rows] == [
        "CARD_NUMBER", "AMOUNT", "TRANSACTION_ID", "MERCHANT_ID", "TRANSACTION_TIMESTAMP",
    ]
    assert {r["field_name"]: r["exposed_values"] for r in rows}["AMOUNT"] == 1


