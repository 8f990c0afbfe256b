import json

import pytest
from pyspark.sql import functions as F

from support import at, tuples
from ledgerloom.operators.facts import typed_cards
from ledgerloom.schemas import CARD_JSON, SUPPORT_ORDERS
from ledgerloom.schemas import LONG, TEXT, struct
from ledgerloom.sources import readers, sinks


def document(i, **transaction):
    base = {
        "id": 1_000_000_000 + i, "type": "PURCHASE", "amount": 599.60, "currency": "USD",
        "timestamp": "2024-01-31T12:00:00.5Z", "approved": True,
    }
    return {
        "element": i, "object": "basic-card", "transaction": {**base, **transaction},
        "card": {"number": 4_000_000_000_000_000 + i}, "merchant": {"id": 100_000_000 + i},
    }


SUPPORT = {
    "txid": "t1", "rfid": "r", "item": "Mug", "purchase_time": "2024-01-01 10:00:00",
    "expiration_time": "2024-02-01", "days": 3, "name": "n", "phone": None, "email": "e",
    "address": {"street_address": "s", "city": "c", "state": "NY", "postalcode": "1"},
    "emergency_contact": None,
}


def test_support_orders_from_json_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        json.dumps(SUPPORT) + "\n\n" + json.dumps({**SUPPORT, "txid": "t2", "address": None}) + "\n"
    )
    df = readers.read_support_orders(spark, str(tmp_path))
    assert df.schema == SUPPORT_ORDERS
    states = df.select("txid", F.variant_get("address", "$.state", "string"), F.col("emergency_contact").isNull())
    assert tuples(states) == [("t1", "NY", True), ("t2", None, True)]


def test_corrupt_lines_are_kept(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1}\n{broken\n')
    df = readers.read_json_lines(spark, str(tmp_path), struct(a=LONG), "_corrupt_record").cache()
    assert tuples(df) == [(1, None), (None, "{broken")]


def test_text_columns_to_variants(spark):
    df = spark.createDataFrame([('{"state": "NY"}',), ("null",), (None,)], "address string")
    got = readers.parse_json_columns(df, "address")
    assert [r[0] for r in got.select(F.col("address").isNull()).collect()] == [False, True, True]


def test_array_files_give_one_row_per_element(spark, tmp_path):
    (tmp_path / "cc_trans_1.json").write_text(json.dumps([document(1), document(2)]))
    (tmp_path / "cc_trans_p2_1.json").write_text(json.dumps([document(3)]))
    (tmp_path / "cc_trans_single.json").write_text(json.dumps(document(4)))
    every = readers.read_json_variants(spark, str(tmp_path))
    assert sorted(r["element"] for r in typed_cards(every).collect()) == [1, 2, 3, 4]
    some = readers.read_json_variants(spark, str(tmp_path), pattern=".*cc_trans_p2.*")
    assert [r["element"] for r in typed_cards(some).collect()] == [3]


def test_typed_view_and_rounding_cast(spark):
    docs = [document(1), document(2, amount=599.4), document(3, amount="x"), document(4, approved=None)]
    staging = spark.createDataFrame([(json.dumps(d),) for d in docs], "t string").select(F.parse_json("t").alias("json_data"))
    rows = {r["element"]: r for r in typed_cards(staging, lenient=True).collect()}
    assert str(rows[1]["amount"]) == "599.60" and rows[3]["amount"] is None and rows[4]["approved"] is None
    assert rows[1]["transaction_timestamp"] == at("2024-01-31 12:00:00.500000")
    whole = F.variant_get("json_data", "$.transaction.amount", "decimal(38,0)")
    good = staging.filter(F.try_variant_get("json_data", "$.transaction.amount", "decimal(38,0)").isNotNull())
    assert [r[0] for r in good.filter(whole < 600).select(F.variant_get("json_data", "$.element", "int")).collect()] == [2]
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST|CAST_INVALID_INPUT"):
        typed_cards(staging).collect()


def test_card_json_schema_reads_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(document(7)))
    assert readers.read_json_lines(spark, str(tmp_path), CARD_JSON).first()["card"]["number"] == 4_000_000_000_000_007


def test_parquet_columns_match_by_case_sensitive_name(spark, tmp_path):
    stored = spark.createDataFrame([("1", "x", 5)], "TXID string, name string, extra long")
    stored.write.parquet(str(tmp_path / "p"))
    target = struct(TXID=TEXT, NAME=TEXT, DAYS=LONG)
    df = readers.read_parquet_by_name(spark, str(tmp_path / "p"), target)
    assert df.schema.simpleString() == target.simpleString()
    assert tuples(df) == [("1", None, None)]  # "name" differs in case


def test_stage_listing(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    (tmp_path / "b.json").write_text("{ }")
    assert sorted(r["size"] for r in readers.list_stage(spark, str(tmp_path)).collect()) == [2, 3]


def test_force_reload_repeats_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps([document(1)]))
    reader = lambda s, path: typed_cards(readers.read_json_variants(s, path))
    for _ in range(2):
        sinks.reload_all(spark, reader, str(tmp_path / "in"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_batched_files(spark, tmp_path):
    sinks.write_batches(spark.range(25).coalesce(1), str(tmp_path / "b"), 10)
    files = list((tmp_path / "b").glob("*.parquet"))
    assert len(files) == 3 and all("snappy" in f.name for f in files)


def test_append_columns_and_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3).withColumn("x", F.lit(1))
    sinks.append_columns(df, path, ["x", "id"], stamp="loaded_at")
    sinks.append_columns(df, path, ["x", "id"], stamp="loaded_at")
    got = spark.read.parquet(path)
    assert got.columns == ["x", "id", "loaded_at"] and got.count() == 6
    assert got.filter("loaded_at is null").count() == 0
    sinks.replace_table(spark.range(1), path)
    assert spark.read.parquet(path).count() == 1


def test_partitioned_rerun_replaces_only_its_days(spark, make_cards, tmp_path):
    path = str(tmp_path / "days")
    sinks.write_partitioned(
        make_cards({"transaction_id": 1}, {"transaction_id": 2, "transaction_timestamp": at("2024-01-30 00:00:00")}), path
    )
    sinks.write_partitioned(make_cards({"transaction_id": 3}), path)
    assert sorted(r["transaction_id"] for r in spark.read.parquet(path).collect()) == [2, 3]
    recent = sinks.since(spark.read.parquet(path), F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"))
    assert [r["transaction_id"] for r in recent.collect()] == [3]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_date" in plan


def test_clustered_files_do_not_overlap(spark, make_cards, tmp_path):
    cards = make_cards(*[{"transaction_id": i, "transaction_timestamp": at(f"2024-01-{1 + i % 28:02d} 00:00:00")} for i in range(200)])
    sinks.write_clustered(cards, str(tmp_path / "c"), ["transaction_timestamp", "merchant_id"])
    bounds = (
        spark.read.parquet(str(tmp_path / "c"))
        .groupBy(F.input_file_name())
        .agg(F.min("transaction_timestamp").alias("lo"), F.max("transaction_timestamp").alias("hi"))
        .orderBy("lo")
        .collect()
    )
    assert all(a["hi"] <= b["lo"] for a, b in zip(bounds, bounds[1:]))


def test_materialised_base_equals_source(spark, tmp_path):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    assert tuples(sinks.materialise(df, str(tmp_path / "m"))) == tuples(df)
