import json
import time

import pytest
from pyspark.sql import functions as F

from support import at, tuples
from ledgerloom.plans import QUERIES
from ledgerloom.schemas import CARD_TRANSACTIONS, CUSTOMERS, LONG, ORDER_ITEMS, ORDERS, PRODUCTS, TEXT, struct
from ledgerloom.streaming import alerts, changes, runs, topics
from test_sources import document


def put(folder, name, *documents):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(list(documents)))


def test_refine_consumes_once_and_peek_does_not_advance(spark, tmp_path):
    stage, table, log = tmp_path / "stage", str(tmp_path / "table"), str(tmp_path / "log")
    put(stage, "cc_trans_1.json", document(1), document(2))

    def run():
        changes.refine(spark, str(stage), table, str(tmp_path / "offsets"), log).awaitTermination()
        return changes.read_table(spark, table, CARD_TRANSACTIONS)

    assert changes.backlog(spark, str(stage), log).first()["pending"] == 2
    assert changes.peek(spark, str(stage), log).count() == 2
    first = run()
    assert sorted(r["element"] for r in first.collect()) == [1, 2]
    assert first.filter("loaded_at is null").count() == 0
    assert changes.backlog(spark, str(stage), log).first()["pending"] == 0
    assert run().count() == 2
    put(stage, "cc_trans_2.json", document(3))
    assert [r["name"].split("/")[-1] for r in changes.pending_files(spark, str(stage), log).collect()] == ["cc_trans_2.json"]
    assert sorted(r["element"] for r in run().collect()) == [1, 2, 3]
    history = changes.load_history(spark, log).collect()
    assert sorted((r["file_name"].split("/")[-1], r["status"], r["row_count"]) for r in history) == [
        ("cc_trans_1.json", "LOADED", 2), ("cc_trans_2.json", "LOADED", 1),
    ]


def test_pattern_and_no_initial_rows(spark, tmp_path):
    stage = tmp_path / "stage"
    put(stage, "cc_trans_1.json", document(1))
    time.sleep(1.1)
    since = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSS")).first()[0]
    time.sleep(1.1)
    put(stage, "cc_trans_p2_1.json", document(2))
    put(stage, "cc_trans_3.json", document(3))
    options = {"pattern": ".*cc_trans_p2.*", "since": None}, {"pattern": None, "since": since}
    found = []
    for i, option in enumerate(options):
        table = str(tmp_path / f"table{i}")
        changes.refine(spark, str(stage), table, str(tmp_path / f"offsets{i}"), **option).awaitTermination()
        found.append(sorted(r["element"] for r in changes.read_table(spark, table, CARD_TRANSACTIONS).collect()))
    assert found == [[2], [2, 3]]


def test_load_then_refine(spark, tmp_path):
    stage = tmp_path / "stage"
    put(stage, "a.json", document(1), document(2))
    for _ in range(2):
        changes.load_then_refine(
            spark, str(stage), str(tmp_path / "staging"), str(tmp_path / "table"), str(tmp_path / "offsets")
        )
    assert changes.read_table(spark, str(tmp_path / "table"), CARD_TRANSACTIONS).count() == 2


def test_load_history_of_broken_json_lines(spark, tmp_path):
    stage = tmp_path / "stage"
    stage.mkdir()
    (stage / "good.json").write_text('{"a": 1}\n{"a": 2}\n')
    (stage / "mixed.json").write_text('{"a": 3}\n{broken\n')
    (stage / "bad.json").write_text("{broken\n")
    stream = changes.json_stage_stream(spark, str(stage), struct(a=LONG))
    changes.load_once(
        stream, str(tmp_path / "t"), str(tmp_path / "offsets"), str(tmp_path / "log"), table_name="T"
    ).awaitTermination()
    assert tuples(changes.read_table(spark, str(tmp_path / "t"), struct(a=LONG))) == [(1,), (2,), (3,)]
    got = {
        r["file_name"].split("/")[-1]: (r["status"], r["row_parsed"], r["row_count"], r["error_count"], r["first_error_message"])
        for r in changes.load_history(spark, str(tmp_path / "log")).collect()
    }
    assert got == {
        "good.json": ("LOADED", 2, 2, 0, None),
        "mixed.json": ("PARTIALLY_LOADED", 2, 1, 1, "{broken"),
        "bad.json": ("LOAD_FAILED", 1, 0, 1, "{broken"),
    }


def test_parquet_load_once_by_name(spark, tmp_path):
    stage, target = str(tmp_path / "stage"), struct(ID=TEXT, EXTRA=LONG)
    spark.createDataFrame([("a", 1)], "ID string, other long").write.parquet(stage)
    run = lambda: changes.load_parquet_once(
        spark, stage, struct(ID=TEXT, other=LONG), target, str(tmp_path / "t"), str(tmp_path / "offsets")
    ).awaitTermination()
    run(), run()
    assert tuples(changes.read_table(spark, str(tmp_path / "t"), target)) == [("a", None)]


def test_source_files_are_deleted_after_a_later_batch(spark, tmp_path):
    stage = tmp_path / "stage"
    stage.mkdir()
    for i in range(3):
        (stage / f"f{i}.json").write_text(json.dumps({"a": i}) + "\n")
        stream = changes.json_stage_stream(spark, str(stage), struct(a=LONG), clean="delete")
        changes.load_once(stream, str(tmp_path / "t"), str(tmp_path / "offsets")).awaitTermination()
    for _ in range(20):
        if not (stage / "f0.json").exists():
            break
        time.sleep(0.5)
    assert not (stage / "f0.json").exists()
    assert changes.read_table(spark, str(tmp_path / "t"), struct(a=LONG)).count() == 3


NESTED = {
    "products": [{"product_id": "p1", "model_name": "Alpha", "base_price": 10.5, "launch_date": "2020-01-01"}],
    "customers": [{"customer_id": "c1", "first_name": "Ana"}],
    "orders": [
        {
            "order_id": "o1", "customer_id": "c1", "order_date": "2024-01-01T10:00:00", "order_status": "shipped",
            "sales_channel": "online", "store_id": None,
            "order_items": [
                {"product_id": "p1", "quantity": 2, "price_at_purchase": 10.5, "rfid": "r"},
                {"product_id": "p1", "quantity": 1, "price_at_purchase": 10.5, "rfid": "s"},
            ],
        },
        {"order_id": "o2", "order_items": []},
        {"order_id": "o3"},
    ],
}


def texts(spark, *messages):
    return spark.createDataFrame([(json.dumps(m),) for m in messages], "data string")


def test_fan_out(spark):
    parts = topics.fan_out(texts(spark, NESTED, {"orders": []}, {"customers": [{"customer_id": "c2"}]}))
    assert {k: v.count() for k, v in parts.items()} == {"products": 1, "customers": 2, "orders": 3, "order_items": 2}
    for name, schema in (("products", PRODUCTS), ("customers", CUSTOMERS), ("orders", ORDERS), ("order_items", ORDER_ITEMS)):
        assert parts[name].columns == schema.names
    assert {r["order_id"] for r in parts["order_items"].collect()} == {"o1"}
    assert parts["orders"].filter("order_id = 'o1'").first()["order_date"] == at("2024-01-01 10:00:00")


def test_topic_round_trip(spark, tmp_path):
    folder, target = str(tmp_path / "topics"), str(tmp_path / "tables")
    topics.publish(texts(spark, NESTED), folder, "shop")
    assert topics.topic_statistics(spark, folder, "shop").first()["queue_size"] == 1
    run = lambda: topics.fan_out_stream(
        topics.consume(spark, folder, "shop"), target, str(tmp_path / "offsets")
    ).awaitTermination()
    run(), run()
    items = lambda: changes.read_table(spark, f"{target}/order_items", ORDER_ITEMS).count()
    assert items() == 2
    topics.publish(texts(spark, {"orders": NESTED["orders"]}), folder, "shop")
    run()
    assert items() == 4
    # A batch without customers writes no customers.
    assert changes.read_table(spark, f"{target}/customers", CUSTOMERS).count() == 1


def test_broken_message_file_is_skipped_and_counts_are_kept(spark, tmp_path):
    folder = tmp_path / "topics"
    topics.publish(texts(spark, NESTED, NESTED), str(folder), "shop")
    (folder / "shop" / "broken.json").write_text("{oops")
    topics.count_stream(
        topics.consume(spark, str(folder), "shop"), str(tmp_path / "counts"), str(tmp_path / "offsets")
    ).awaitTermination()
    row = spark.read.parquet(str(tmp_path / "counts")).first()
    assert (row["messages"], row["products"], row["customers"], row["orders"]) == (2, 2, 2, 6)


def test_rows_as_messages_to_tables(spark, tmp_path):
    folder = str(tmp_path / "topics")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "name string, n long")
    topics.publish(topics.rows_as_messages(rows), folder, "left")
    table = (str(tmp_path / "left"), struct(name=TEXT, n=LONG))
    topics.topics_to_tables(
        topics.consume(spark, folder, "left"), {"left": table}, str(tmp_path / "offsets")
    ).awaitTermination()
    assert tuples(changes.read_table(spark, *table)) == [("a", 1), ("b", 2)]


def test_statistics_leave_out_consumed_files(spark, tmp_path):
    folder, log = str(tmp_path / "topics"), str(tmp_path / "log")
    topics.publish(texts(spark, NESTED), folder, "shop")
    stream = topics.consume(spark, folder, "shop")
    changes.load_once(stream, str(tmp_path / "raw"), str(tmp_path / "offsets"), log).awaitTermination()
    assert topics.topic_statistics(spark, folder, "shop", log).first()["queue_size"] == 0
    topics.publish(texts(spark, NESTED), folder, "shop")
    assert topics.topic_statistics(spark, folder, "shop", log).first()["queue_size"] == 1


def card_files(spark, make_cards, path, *batches):
    for rows in batches:
        make_cards(*rows).coalesce(1).write.mode("append").parquet(path)


def test_window_alerts_stream(spark, make_cards, tmp_path):
    path = str(tmp_path / "cards")
    early = [{"transaction_id": i, "approved": i > 4, "transaction_timestamp": at(f"2024-01-31 10:00:{i:02d}")} for i in range(10)]
    card_files(spark, make_cards, path, early, [{"transaction_timestamp": at("2024-01-31 12:00:00")}])
    stream = spark.readStream.schema(CARD_TRANSACTIONS).parquet(path)
    alerts.append_to(alerts.alert_stream(stream), str(tmp_path / "out"), str(tmp_path / "offsets")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(rows) == 15  # every minute start whose window holds 10:00:00 to 10:00:09
    assert {(r["transactions"], r["approval_rate"], r["approval_alert"]) for r in rows} == {(10, 50, True)}


def test_duplicates_stream(spark, make_cards, tmp_path):
    path = str(tmp_path / "cards")
    first = [{"transaction_id": 1, "transaction_timestamp": at("2024-01-31 10:01:00")}] * 2
    card_files(spark, make_cards, path, first, [{"transaction_id": 2, "transaction_timestamp": at("2024-01-31 12:00:00")}])
    stream = lambda: spark.readStream.schema(CARD_TRANSACTIONS).parquet(path)
    alerts.append_to(alerts.deduplicated(stream()), str(tmp_path / "clean"), str(tmp_path / "o2")).awaitTermination()
    assert sorted(r["transaction_id"] for r in spark.read.parquet(str(tmp_path / "clean")).collect()) == [1, 2]


def watched(spark, tmp_path, stream):
    alerts.update_to(alerts.duplicate_watch(stream, "card_number"), str(tmp_path / "watch"), str(tmp_path / "o")).awaitTermination()
    rows = alerts.latest(spark, str(tmp_path / "watch"), alerts.REPEATS, ["window_start", "card_number"]).collect()
    return {(r["card_number"], r["window_start"].strftime("%H:%M")): (r["occurrences"], r["repeats"]) for r in rows}


def test_repeats_across_an_edge_and_in_open_periods(spark, make_cards, tmp_path):
    path = str(tmp_path / "cards")
    seen = lambda key, *times: [{"card_number": key, "transaction_timestamp": at(f"2024-01-31 {t}")} for t in times]
    early = seen(1, "10:29:30", "10:30:30") + seen(2, "10:29:00", "10:59:00") + seen(3, "10:29:00", "10:59:01")
    early += seen(4, "10:05:00", "10:05:00", "10:06:00") + seen(5, "10:40:00")
    late = seen(5, "10:20:00") + seen(6, "10:58:00", "10:59:00")  # one row earlier than what is known of its key
    card_files(spark, make_cards, path, early, late)
    stream = spark.readStream.option("maxFilesPerTrigger", 1).schema(CARD_TRANSACTIONS).parquet(path)
    assert watched(spark, tmp_path, stream) == {
        (1, "10:30"): (1, 1),  # a minute apart, in two periods
        (2, "10:30"): (1, 1),  # just near enough
        (4, "10:00"): (3, 2),
        (5, "10:30"): (1, 1),  # the earlier row came later
        (6, "10:30"): (2, 1),  # the period is open
    }


def test_watermark_ends_the_state(spark, make_cards, tmp_path):
    path = str(tmp_path / "cards")
    hours = [[{"card_number": k, "transaction_timestamp": at(f"2024-01-31 {h:02d}:00:00")} for k in range(20)] for h in range(8)]
    card_files(spark, make_cards, path, *hours)
    stream = spark.readStream.option("maxFilesPerTrigger", 1).schema(CARD_TRANSACTIONS).parquet(path)
    query = alerts.update_to(alerts.duplicate_watch(stream, "card_number"), str(tmp_path / "w"), str(tmp_path / "o"))
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(kept) <= 20 * 2 * 3  # two windows a row; at most three hours are open


def test_open_windows_show_what_has_come(spark, make_cards, tmp_path):
    path = str(tmp_path / "cards")
    rows = [{"transaction_timestamp": at(f"2024-01-31 10:00:{i:02d}"), "approved": False} for i in range(30)]
    card_files(spark, make_cards, path, rows, [{"transaction_timestamp": at("2024-01-31 10:01:00"), "approved": True}])
    stream = spark.readStream.option("maxFilesPerTrigger", 1).schema(CARD_TRANSACTIONS).parquet(path)
    query = alerts.update_to(alerts.step_updates(stream), str(tmp_path / "steps"), str(tmp_path / "o"))
    query.awaitTermination()
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 2  # a row per minute
    windows = {r["window_start"].strftime("%H:%M"): r["transactions"] for r in alerts.current_alerts(spark, str(tmp_path / "steps")).collect()}
    assert len(windows) == 16 and windows["09:46"] == 30 and windows["10:00"] == 31 and windows["10:01"] == 1


def test_run_history_and_stop(spark, tmp_path):
    history = str(tmp_path / "runs")
    assert runs.recorded(spark, "job", history, lambda: 5) == 5
    with pytest.raises(ValueError):
        runs.recorded(spark, "job", history, lambda: int("x"))
    got = runs.run_history(spark, history).collect()
    assert sorted(r["state"] for r in got) == ["FAILED", "SUCCEEDED"]
    assert all(r["scheduled_time"] <= r["completed_time"] for r in got)

    (tmp_path / "stage").mkdir()
    stream = changes.json_stage_stream(spark, str(tmp_path / "stage"), struct(a=LONG))
    query = changes.load_once(stream, str(tmp_path / "t"), str(tmp_path / "offsets"), every="1 minute")
    assert query.isActive
    assert len(runs.stop_all(spark)) == 1 and not spark.streams.active


def test_a_new_checkpoint_leaves_older_rows_alone(spark, tmp_path):
    stage, table = tmp_path / "stage", str(tmp_path / "table")
    put(stage, "cc_trans_1.json", document(1))
    changes.refine(spark, str(stage), table, str(tmp_path / "first")).awaitTermination()
    time.sleep(1.1)
    since = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSS")).first()[0]
    time.sleep(1.1)
    put(stage, "cc_trans_2.json", document(2))
    changes.refine(spark, str(stage), table, str(tmp_path / "second"), since=since).awaitTermination()
    rows = changes.read_table(spark, table, CARD_TRANSACTIONS).collect()
    assert sorted(r["element"] for r in rows) == [1, 2]


def raw(spark, *messages):
    return spark.createDataFrame([(m,) for m in messages], "data string")


def test_refused_messages_are_kept(spark, tmp_path):
    good = '{"orders": [{"order_id": "o1", "order_items": [{"product_id": "p1", "quantity": 1}]}]}'
    assert topics.payload_counts(raw(spark, good, "no json")).first()["unreadable"] == 1
    topics.publish(raw(spark, good, "no json", '{"orders": 5'), str(tmp_path / "topics"), "orders")
    messages = topics.consume(spark, str(tmp_path / "topics"), "orders")
    topics.fan_out_stream(messages, str(tmp_path / "tables"), str(tmp_path / "offsets")).awaitTermination()
    assert changes.read_table(spark, str(tmp_path / "tables" / "orders"), ORDERS).count() == 1
    refused = spark.read.parquet(str(tmp_path / "tables" / "quarantine"))
    assert sorted(r["data"] for r in refused.collect()) == ["no json", '{"orders": 5']


def test_unmapped_topics_are_kept(spark, tmp_path):
    topics.publish(raw(spark, '{"customer_id": "c1"}', "broken"), str(tmp_path / "in"), "customers")
    topics.publish(raw(spark, "{}"), str(tmp_path / "in"), "other")
    messages = spark.readStream.schema(topics.ENVELOPE).option("recursiveFileLookup", True).json(str(tmp_path / "in"))
    topics.topics_to_tables(
        messages, {"customers": (str(tmp_path / "customers"), CUSTOMERS)}, str(tmp_path / "offsets"),
        quarantine=str(tmp_path / "refused"),
    ).awaitTermination()
    assert changes.read_table(spark, str(tmp_path / "customers"), CUSTOMERS).count() == 1
    refused = spark.read.parquet(str(tmp_path / "refused")).collect()
    assert sorted((r["topic"], r["reason"]) for r in refused) == [("customers", "unreadable"), ("other", "unmapped topic")]


def cached_at_writes(spark, monkeypatch):
    """A list that gets the number of cached tables at each write of a batch."""
    seen = []

    def noted(df, path, write=topics.replace_table):
        seen.append(len(spark.sparkContext._jsc.getPersistentRDDs()))
        write(df, path)

    monkeypatch.setattr(topics, "replace_table", noted)
    return seen


def test_topic_map_parses_once_and_caches_no_batch(spark, tmp_path, monkeypatch):
    """A batch may be larger than the memory; it is stored parsed, and the store goes with the batch."""
    seen, before = cached_at_writes(spark, monkeypatch), len(spark.sparkContext._jsc.getPersistentRDDs())
    for topic in ("customers", "orders"):
        topics.publish(raw(spark, f'{{"{topic[:-1]}_id": "1"}}', None, "broken", "{}"), str(tmp_path / "in"), topic)
    topics.publish(raw(spark, "{}", None), str(tmp_path / "in"), "other")
    messages = spark.readStream.schema(topics.ENVELOPE).option("recursiveFileLookup", True).json(str(tmp_path / "in"))
    tables = {"customers": (str(tmp_path / "customers"), CUSTOMERS), "orders": (str(tmp_path / "orders"), ORDERS)}
    topics.topics_to_tables(messages, tables, str(tmp_path / "offsets"), quarantine=str(tmp_path / "refused")).awaitTermination()
    assert seen == [before] * 3
    assert not list((tmp_path / "offsets" / "parsed").glob("*"))
    for topic, table in tables.items():
        rows = changes.read_table(spark, *table).select(f"{topic[:-1]}_id")
        assert tuples(rows) == [("1",), (None,)]
    refused = tuples(spark.read.parquet(str(tmp_path / "refused")).select("topic", "data", "reason"))
    broken = [(t, d, "unreadable") for t in tables for d in ("broken", None)]
    assert refused == sorted([*broken, ("other", "{}", "unmapped topic"), ("other", None, "unmapped topic")], key=repr)


def test_topic_map_without_quarantine_writes_nothing_of_a_refused_batch(spark, tmp_path):
    topics.publish(raw(spark, '{"customer_id": "c1"}', "broken"), str(tmp_path / "in"), "customers")
    table = (str(tmp_path / "customers"), CUSTOMERS)
    query = topics.topics_to_tables(
        topics.consume(spark, str(tmp_path / "in"), "customers"), {"customers": table}, str(tmp_path / "offsets")
    )
    with pytest.raises(Exception, match="refused messages"):
        query.awaitTermination()
    assert not (tmp_path / "customers").exists()
    assert not list((tmp_path / "offsets" / "parsed").glob("*"))


def test_fan_out_stream_caches_no_batch_and_leaves_out_empty_tables(spark, tmp_path, monkeypatch):
    seen, before = cached_at_writes(spark, monkeypatch), len(spark.sparkContext._jsc.getPersistentRDDs())
    empty = '{"products": [], "customers": null, "orders": [{"order_id": "o2", "order_items": []}, null]}'
    good = '{"orders": [{"order_id": "o1", "order_items": [{"product_id": "p1", "quantity": 1}]}]}'
    run = lambda name: topics.fan_out_stream(
        topics.consume(spark, str(tmp_path / "in"), "orders"), str(tmp_path / name), str(tmp_path / f"{name}-offsets")
    ).awaitTermination()
    topics.publish(raw(spark, empty, "broken"), str(tmp_path / "in"), "orders")
    run("first")
    assert sorted(p.name for p in (tmp_path / "first").iterdir()) == ["orders", "quarantine"]
    topics.publish(raw(spark, good), str(tmp_path / "in"), "orders")
    run("second")
    assert sorted(p.name for p in (tmp_path / "second").iterdir()) == ["order_items", "orders", "quarantine"]
    orders = changes.read_table(spark, str(tmp_path / "second" / "orders"), ORDERS).select("order_id")
    assert tuples(orders) == [("o1",), ("o2",), (None,)]
    assert seen == [before] * 5
    assert not list((tmp_path / "second-offsets" / "parsed").glob("*"))


def test_streams_over_a_folder_table(spark, tmp_path):
    from ledgerloom.plans.streams import event_stream

    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    query = (
        event_stream(spark, str(tmp_path)).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "o"))
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == source.count()


def test_topics_are_compressed_into_files_for_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(topics, "FILE_MESSAGES", 300)
    order = '{{"orders": [{{"order_id": "{0}", "sales_channel": "in_person", "order_items": [{{"product_id": "{0}", "quantity": 1}}]}}]}}'
    texts = [order.format(i) for i in range(1000)]
    rows = spark.createDataFrame([], "data string").coalesce(1).union(raw(spark, *texts).coalesce(1))  # first part empty
    topics.publish(rows, str(tmp_path / "topics"), "orders")
    files = [f for f in (tmp_path / "topics" / "orders").iterdir() if f.name.startswith("part-")]
    topics.publish(rows.limit(0), str(tmp_path / "topics"), "none")
    assert [f.stat().st_size for f in (tmp_path / "topics" / "none").iterdir() if f.name.startswith("part-")] == [0]
    assert len(files) == 4 and 3 * sum(f.stat().st_size for f in files) < sum(map(len, texts))
    messages = topics.consume(spark, str(tmp_path / "topics"), "orders", files_per_batch=3)
    topics.fan_out_stream(messages, str(tmp_path / "tables"), str(tmp_path / "offsets")).awaitTermination()
    items = changes.read_table(spark, str(tmp_path / "tables" / "order_items"), ORDER_ITEMS)
    assert sorted(int(r["order_id"]) for r in items.collect()) == [*range(1000)]


MADE = {
    "orders": "id AS o_orderkey, id % 9 AS o_custkey, timestamp_ntz'2024-01-01 10:00:00' AS o_orderdate, 'F' AS o_orderstatus, '2-HIGH' AS o_orderpriority",
    "lineitem": "id % 300 AS l_orderkey, id AS l_partkey, 2 AS l_quantity, cast(id AS double) AS l_extendedprice",
    "customer": "id AS c_custkey, 'S' AS c_mktsegment, 'N' AS c_name, 1.0D AS c_acctbal, 1 AS c_nationkey",
    "part": "id AS p_partkey, 'B' AS p_brand, 'T' AS p_type, 'N' AS p_name, 1.0D AS p_retailprice",
    "events": "id AS event_id, timestamp_ntz'2024-01-01 10:00:00' AS ts, id AS user_id, 'click' AS event_type, 1.5D AS value, '{\"k\": 1}' AS props",
}


@pytest.mark.parametrize("name", ["stream_topic_tables", "stream_fan_out"])
def test_registered_streams_store_a_few_files_at_once(spark, tmp_path, monkeypatch, name):
    """Peak disk: a parsed batch is a part of the topic, not all of it."""
    for table, columns in MADE.items():
        rows = spark.range(900 if table == "lineitem" else 300).selectExpr(*columns.split(", "))
        rows.coalesce(1).write.parquet(str(tmp_path / f"{table}.parquet"))
    monkeypatch.setattr(topics, "FILE_MESSAGES", 100)
    monkeypatch.setattr(topics, "BATCH_FILES", 2)
    stored = []

    def noted(df, path, write=topics.materialise):
        kept = write(df, path)
        stored.append(kept.count())
        return kept

    monkeypatch.setattr(topics, "materialise", noted)
    counts = {r[0]: r[1] for r in QUERIES[name].run(spark, str(tmp_path)).collect()}
    assert max(stored) <= 200
    if name == "stream_fan_out":
        assert sum(stored) == 900 and counts == {"orders": 900, "order_items": 900}
    else:
        assert sum(stored) == 1500 and counts == {"cards": 300, "lines": 900, "refused": 300}
