"""Z-order files, compaction, progress history, session masks, sketches."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import privacy, sketches
from ledgerloom.schemas import CARD_TRANSACTIONS, LONG, TEXT, struct
from ledgerloom.sources import sinks
from ledgerloom.streaming import changes, runs
from support import at, tuples

NUMBERS = struct(a=LONG, b=TEXT)


def test_zorder_files_are_narrow_in_both_columns(spark, tmp_path):
    df = spark.range(20_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 ELSE (id * 7919) % 10007 END AS x", "(id * 104729) % 9973 AS y")
    df = df.unionByName(spark.sql("SELECT -1L AS id, CAST(NULL AS BIGINT) AS x, 5L AS y"))  # a hot value and a NULL
    sinks.write_zordered(df, str(tmp_path / "z"), ["x", "y"], files=32)
    stored = spark.read.parquet(str(tmp_path / "z"))
    assert stored.columns == df.columns and tuples(stored) == tuples(df)
    ranges = sinks.file_ranges(stored, ["x", "y"]).collect()
    assert len(ranges) >= 24
    for column in ("x", "y"):
        touched = [r for r in ranges if r[f"{column}_least"] is not None and r[f"{column}_least"] <= 5000 <= r[f"{column}_most"]]
        assert len(touched) < len(ranges) / 2, column
    sizes = [r["n"] for r in stored.groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 3 * 20_000 / 32  # the hot value is cut


def batches(spark, base, n):
    for i in range(n):
        part = f"{base}/stream=s/batch_id={i}"
        spark.createDataFrame([(i, "x"), (i, None)], NUMBERS).coalesce(1).write.parquet(part)


def table_rows(spark, base):
    return tuples(changes.read_table(spark, base, NUMBERS))


def test_compaction_keeps_the_rows(spark, tmp_path):
    base = str(tmp_path / "t")
    batches(spark, base, 12)
    before = table_rows(spark, base)
    changes.compact(spark, base, NUMBERS)
    assert [f.rsplit("/", 1)[1] for f in changes.live_folders(spark, base)] == ["upto=11"]
    assert len(list((tmp_path / "t" / "stream=s").glob("*/*.parquet"))) < 12 and table_rows(spark, base) == before
    for n in (12, 13):
        spark.createDataFrame([(99, "new")], NUMBERS).write.parquet(f"{base}/stream=s/batch_id={n}")
    after = sorted(before + [(99, "new")] * 2, key=repr)
    assert table_rows(spark, base) == after
    changes.compact(spark, base, NUMBERS)
    assert table_rows(spark, base) == after
    changes.compact(spark, base, NUMBERS)  # nothing to do
    assert [f.rsplit("/", 1)[1] for f in changes.live_folders(spark, base)] == ["upto=13"]


@pytest.mark.parametrize("moment", ["rename", "remove_covered"])
def test_compaction_that_dies_is_repeated(spark, tmp_path, monkeypatch, moment):
    base = str(tmp_path / "t")
    batches(spark, base, 4)
    before = table_rows(spark, base)
    with monkeypatch.context() as patch:
        patch.setattr(changes, moment, lambda *_: (_ for _ in ()).throw(RuntimeError("gone")))
        with pytest.raises(RuntimeError):
            changes.compact(spark, base, NUMBERS)
    assert table_rows(spark, base) == before
    changes.compact(spark, base, NUMBERS)
    assert table_rows(spark, base) == before
    assert [p.name for p in (tmp_path / "t" / "stream=s").iterdir()] == ["upto=3"]


def test_progress_of_good_and_failed_queries(spark, tmp_path):
    spark.range(10).selectExpr("id AS a", "'x' AS b").write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(NUMBERS).parquet(str(tmp_path / "in"))

    def start(name, write):
        out = stream().writeStream.foreachBatch(write).queryName(name).trigger(availableNow=True)
        return out.option("checkpointLocation", str(tmp_path / name)).start()

    def fail(batch, number):
        raise ValueError("refused")

    with runs.ProgressLog(spark, str(tmp_path / "history")):
        start("good", lambda batch, number: batch.count()).awaitTermination()
        with pytest.raises(Exception, match="refused"):
            start("bad", fail).awaitTermination()
    rows = runs.progress_history(spark, str(tmp_path / "history")).collect()
    assert sum(r["input_rows"] or 0 for r in rows if r["name"] == "good") == 10
    ends = {r["name"]: (r["event"], r["error"]) for r in rows if r["event"] != "BATCH"}
    assert ends["good"] == ("FINISHED", None)
    assert ends["bad"][0] == "FAILED" and "refused" in ends["bad"][1]


def test_one_view_for_all_roles(spark, make_cards):
    cards = make_cards({"amount": Decimal(777)}, {"amount": Decimal("1500.50")}, {"amount": Decimal(30)})
    privacy.masked_view(cards, "cards_for_all")
    assert {r["amount"] for r in spark.table("cards_for_all").collect()} == {0}  # nobody: nothing is shown
    for role in ("DATA_ADMIN_ROLE", "ACCOUNTADMIN", "ANALYST_ROLE", "AUDITOR_ROLE", "it's"):
        privacy.set_role(spark, role)
        assert tuples(spark.table("cards_for_all")) == tuples(privacy.apply_masks(cards, role)), role
    assert spark.table("cards_for_all").columns == CARD_TRANSACTIONS.names


def test_sketches_merge_over_days(spark):
    df = spark.range(30_000).select(
        (F.col("id") % 5000).alias("k"), (F.lit(at("2024-01-01")) + F.make_dt_interval((F.col("id") % 10).cast("int"))).alias("t")
    )
    df = df.unionByName(spark.createDataFrame([(None, at("2024-01-01")), (1, None)], "k long, t timestamp"))
    daily = sketches.daily_sketches(df, "k", "t")
    assert daily.count() == 10
    bound = 3 * sketches.standard_error()
    assert sketches.distinct_in_span(daily).first()[0] == pytest.approx(5000, rel=bound)
    exact = {r["day"]: r["n"] for r in df.groupBy(F.to_date("t").alias("day")).agg(F.countDistinct("k").alias("n")).collect()}
    for r in sketches.distinct_in_span(daily, "day").collect():
        assert r["distinct_keys"] == pytest.approx(exact[r["day"]], rel=bound)
