"""Stores: whole or invisible, two writers, compaction, and reads that touch only what they need."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tempora import schemas as S
from tempora.functions.rules import RunParams
from tempora.operators import gmv, incremental
from tempora.operators.gmv import gmv_snapshot
from tempora.operators.latest import latest_as_of
from tempora.plans import jobs
from tempora.session import scratch_path
from tempora.sinks import raw
from tempora.sinks.gold import GoldTable, SnapshotError
from tempora.sinks.notes import Notes, folders
from tempora.sinks.silver import SilverStore, known_on, silver_schema
from tempora.sinks.versioned import StaleWrite, VersionedTable
from tempora.sources import testdata as TD

SF = "/root/testdata/sf0.001"
R1, R2 = RunParams.for_day("1998-06-30"), RunParams.for_day("1998-07-31")


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def files(path):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path.removeprefix("file:")) for f in fs if f.endswith(".parquet"))


def test_a_note_is_written_once(spark):
    notes = Notes(spark, scratch_path(spark, "notes"))
    assert notes.names() == [] and notes.newest() is None
    assert notes.write("b", {"n": 1}) and not notes.write("b", {"n": 2}) and notes.write("a", {"é": [None, "x"]})
    assert notes.names() == ["a", "b"] and notes.read("a") == {"é": [None, "x"]} and notes.newest() == ("b", {"n": 1})
    notes.keep_newest(1)
    assert notes.names() == ["b"]


# -- GOLD ----------------------------------------------------------------------------

@pytest.fixture()
def half_written(spark, mock):
    """A store whose run 2 died while writing: some rows are there, the note is not."""
    gold = GoldTable(spark, scratch_path(spark, "gold-half"))
    runs = [RunParams.for_day(d) for d in ("2023-01-07", "2023-01-10")]
    gold.append(gmv_snapshot(mock, runs[0]))
    (gmv_snapshot(mock, runs[1]).limit(1).withColumn("attempt", F.lit("dead")).withColumn("transaction_month", F.trunc("transaction_date", "month"))
        .write.mode("append").partitionBy("as_of_date", "attempt", "transaction_month").parquet(gold.path))
    return gold, runs


def test_a_half_written_run_is_invisible_and_written_anew(spark, mock, half_written):
    gold, runs = half_written
    first = rows(gmv_snapshot(mock, runs[0]))
    assert rows(gold.history()) == rows(gold.current()) == rows(gold.as_seen_on("2023-02-01")) == first
    assert gold.as_of(runs[1].as_of_date).count() == 0 and gold.latest_as_of_date().first()[0] == dt.date(2023, 1, 7)
    assert gold.collisions(gmv_snapshot(mock, runs[1])).count() == 0
    assert gold.append(gmv_snapshot(mock, runs[1]), if_stored="skip")
    assert rows(gold.current()) == rows(gmv_snapshot(mock, runs[1])) and len(rows(gold.history())) == 4


def test_a_dead_daily_job_is_made_up_for(spark, mock, monkeypatch):
    root = scratch_path(spark, "gold-dead")
    for t, df in mock.items():
        jobs.ingest(spark, df, f"{root}/raw", t)

    def die(self, name, content):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(Notes, "write", die)
        with pytest.raises(RuntimeError):
            jobs.daily_snapshot(spark, f"{root}/raw", f"{root}/gold", "2023-01-10", mode="full")
    assert files(f"{root}/gold") and GoldTable(spark, f"{root}/gold").history().count() == 0
    assert jobs.daily_snapshot(spark, f"{root}/raw", f"{root}/gold", "2023-01-10")
    assert rows(GoldTable(spark, f"{root}/gold").current()) == rows(gmv_snapshot(mock, RunParams.for_day("2023-01-10")))


def test_two_writers_of_one_run(spark, mock, monkeypatch):
    gold, run = GoldTable(spark, scratch_path(spark, "gold-two")), RunParams.for_day("2023-01-10")
    names = Notes.names
    with monkeypatch.context() as m:  # the second writer has looked before the first has published
        m.setattr(Notes, "names", lambda self: [])
        assert gold.append(gmv_snapshot(mock, run))
        assert gold.append(gmv_snapshot(mock, run), if_stored="skip") is False
        with pytest.raises(SnapshotError):
            gold.append(gmv_snapshot(mock, run))
    assert names(gold.runs) == ["2023-01-10"] and rows(gold.current()) == rows(gmv_snapshot(mock, run))


def test_the_newest_run_is_found_without_a_scan(spark, mock, half_written):
    gold, runs = half_written
    gold.append(gmv_snapshot(mock, runs[1]))
    plan = formatted(gold.current())
    assert plan.count("Scan parquet") == 2 and "(as_of_date#" in plan and "= 2023-01-10)" in plan and "Subquery" not in plan  # tree and details
    assert "as_of_date=2023-01-07" not in plan and "dead" not in plan
    assert "Scan parquet" not in formatted(gold.latest_as_of_date())
    empty = gmv_snapshot(mock, RunParams.for_day("2000-01-01"))
    assert gold.append(empty, dates=["2024-01-01"])  # a run without rows is stored, but is not the newest snapshot
    assert gold.is_stored("2024-01-01") and rows(gold.current()) == rows(gmv_snapshot(mock, runs[1]))


# -- RAW -----------------------------------------------------------------------------

def test_deliveries_are_compacted(spark, monkeypatch):
    monkeypatch.setattr(raw, "COMPACT_EVERY", 4)
    path = scratch_path(spark, "raw-compact")
    log = TD.purchase_cdc(spark, SF).where("ingestion_ts < '1995-06-01'").withColumn("_b", F.pmod("purchase_id", F.lit(13))).checkpoint()
    before = None
    for b in range(13):
        if b == 12:
            before = raw.read_raw(spark, path, S.PURCHASE, with_partition=True)
        raw.append_raw(spark, log.where(F.col("_b") == b).drop("_b"), path, S.PURCHASE)
    log = log.drop("_b")
    assert rows(raw.read_raw(spark, path, S.PURCHASE).drop("transaction_date")) == rows(log)
    assert before.count() < log.count()  # a read that began before a compaction still finds its files
    stored = raw.read_raw(spark, path, S.PURCHASE, with_partition=True)
    assert stored.select("delivery_id").distinct().count() == 13
    late = stored.where("delivery_id > 9")  # late deliveries are told apart after compaction too
    assert rows(late.drop("transaction_date", "ingest_month", "delivery_id")) == rows(log.where("pmod(purchase_id, 13) > 8"))
    months = log.select(F.trunc("ingestion_ts", "month")).distinct().count()
    folders_of = [len(folders(spark, f"{path}/{m}")) for m in folders(spark, path) if m.startswith("ingest_month")]
    assert max(folders_of) <= 2 * 4 + 1 and len(files(path + "__base")) <= 2 * 2 * months
    assert raw.newest_delivery(spark, path) == 13 and len(Notes(spark, path + "__deliveries").names()) <= raw.NOTES_KEPT
    assert not raw.compact_raw(spark, path, S.PURCHASE, 4) and raw.compact_raw(spark, path, S.PURCHASE)
    assert rows(raw.read_raw(spark, path, S.PURCHASE).drop("transaction_date")) == rows(log)
    # inside a compacted month, rows lie by groups of deliveries, then by key
    one = spark.read.parquet(files(path + "__base")[0]).select(F.floor(F.col("delivery_id") / 4).alias("g"), *S.RAW_KEYS[S.PURCHASE]).collect()
    assert one == sorted(one)
    plan = formatted(raw.read_raw(spark, path, S.PURCHASE, with_partition=True).where("delivery_id > 9 AND purchase_id = 3"))
    assert "GreaterThan(delivery_id,9)" in plan and "EqualTo(purchase_id,3)" in plan


def test_a_half_written_delivery_is_invisible(spark, monkeypatch):
    path = scratch_path(spark, "raw-half")
    log = TD.purchase_cdc(spark, SF).where("ingestion_ts < '1995-03-01'").checkpoint()
    raw.append_raw(spark, log.where("purchase_id % 2 = 0"), path, S.PURCHASE)

    def die(self, name, content):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as m:
        m.setattr(Notes, "write", die)
        with pytest.raises(RuntimeError):
            raw.append_raw(spark, log.where("purchase_id % 4 = 1"), path, S.PURCHASE)
    assert raw.read_raw(spark, path, S.PURCHASE).count() == log.where("purchase_id % 2 = 0").count()
    raw.append_raw(spark, log.where("purchase_id % 2 = 1"), path, S.PURCHASE)
    assert rows(raw.read_raw(spark, path, S.PURCHASE).drop("transaction_date")) == rows(log)


# -- versioned partitions and SILVER -----------------------------------------------------

def test_versions_are_published_whole(spark):
    schema = spark.createDataFrame([], "v long, p long").schema
    table = VersionedTable(spark, scratch_path(spark, "versioned"), schema, "p")
    assert table.read().count() == 0
    first = table.replace(spark.createDataFrame([(1, 1), (2, 2), (3, 3)], schema), [1, 2, 3], {"n": 1}, table.manifest())
    table.replace(spark.createDataFrame([(20, 2)], schema), [2, 3], {"n": 2}, first)
    assert sorted(map(tuple, table.read().collect())) == [(1, 1), (20, 2)] and table.manifest()["kept"] == {"n": 2}
    with pytest.raises(StaleWrite):
        table.replace(spark.createDataFrame([(9, 1)], schema), [1], {}, first)
    assert sorted(map(tuple, table.read().collect())) == [(1, 1), (20, 2)]
    assert sorted(map(tuple, table.read(manifest={"number": 1, **table.notes.read("000000000001")}).collect())) == [(1, 1), (2, 2), (3, 3)]
    assert [tuple(r) for r in table.read([2]).collect()] == [(20, 2)] and "p=1" not in formatted(table.read([2]))
    table.vacuum(1)
    assert len(folders(spark, table.path)) == 2 and table.notes.names() == ["000000000002"]


@pytest.fixture(scope="module")
def stores(spark):
    """RAW in four deliveries (a seventh of the oldest events comes last), SILVER merged delivery by delivery."""
    root = scratch_path(spark, "silver-raw")
    silver = SilverStore(spark, root + "__silver")
    cuts = ["1900-01-01", "1998-07-01", "1998-08-01", "2100-01-01"]
    late = F.col("purchase_id") % 7 == 1
    for n in range(4):
        for t in jobs.SNAPSHOT_LOGS:
            log = TD.DERIVERS[t](spark, SF)
            if n < 3:
                part = log.where((F.col("ingestion_ts") >= cuts[n]) & (F.col("ingestion_ts") < cuts[n + 1]))
                part = part.where(~late | late.isNull()) if n == 0 else part
            else:
                part = log.where((F.col("ingestion_ts") < cuts[1]) & late)
            raw.append_raw(spark, part, raw.raw_path(root, t), t)
        silver.refresh(root)
    return root, silver


@pytest.mark.parametrize("day", ["1995-03-03", "1998-06-30", "1998-07-31", "2001-12-31"])
def test_silver_states_equal_the_pick(spark, stores, day):
    root, silver = stores
    for t in jobs.SNAPSHOT_LOGS:
        want = latest_as_of(TD.DERIVERS[t](spark, SF), S.ENTITY_KEYS[t], RunParams.for_day(day).cutoff_ts)
        got = silver.state(t, day)
        assert rows(got.select(*want.columns)) == rows(want)
        assert "Window" not in formatted(got) and "Exchange" not in formatted(got)


def test_bucketed_silver_joins_without_an_exchange(spark, stores, small_logs):
    root, silver = stores
    names = silver.publish_bucketed("silver_test", 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = gmv.snapshot_from_states(*[known_on(spark.table(names[t]), R2.as_of_date) for t in jobs.SNAPSHOT_LOGS[:2] + (S.ITEM,)], R2)
        assert rows(got) == rows(gmv_snapshot(small_logs, R2))
        plan = got._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        assert "Exchange hashpartitioning(transaction_date" in final and "Exchange hashpartitioning(purchase_id" not in plan and "Window" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_merging_again_changes_nothing(spark, stores):
    root, silver = stores
    before = rows(silver.versions(S.PURCHASE))
    again = raw.read_raw(spark, raw.raw_path(root, S.PURCHASE), S.PURCHASE).where("purchase_id % 3 = 0")
    silver.merge(S.PURCHASE, again, silver.covered(S.PURCHASE))
    assert rows(silver.versions(S.PURCHASE)) == before
    assert [f.name for f in silver_schema(S.ITEM)][-1] == "prod_item_partition"


def test_incremental_from_silver_equals_the_full_run(spark, stores, small_logs):
    root, silver = stores
    logs = jobs.raw_logs(spark, root, jobs.SNAPSHOT_LOGS)
    for prev, new, covered in ((R1, R2, 1), (RunParams.for_day("1998-07-30"), R2, 4), (R2, RunParams.for_day("1999-12-31"), 3)):
        seen = {t: df.where(F.col("delivery_id") <= covered) for t, df in logs.items()}
        fresh = jobs.arrivals(logs, prev, new, {t: covered for t in logs})
        got = incremental.incremental_from(silver, fresh, gmv_snapshot(seen, prev), new)
        assert rows(got) == rows(gmv_snapshot(small_logs, new)), (prev, new, covered)
        # the same with the later deliveries not merged yet
        behind = SilverStore(spark, scratch_path(spark, "silver-behind"))
        behind.refresh(root, dict.fromkeys(logs, covered))
        assert behind.refresh(root, dict.fromkeys(logs, 4), every=9) == dict.fromkeys(logs, covered)
        ahead = behind.with_recent(root, dict.fromkeys(logs, 4))
        assert rows(incremental.incremental_from(ahead, fresh, gmv_snapshot(seen, prev), new)) == rows(gmv_snapshot(small_logs, new))
        if covered == 4:
            want = incremental.impacted_dates(small_logs, prev, new)
            assert rows(incremental.impacted_dates_from(silver, fresh, prev, new)) == rows(want)


def test_incremental_reads_arrivals_and_touched_partitions(spark, stores):
    root, silver = stores
    logs = jobs.raw_logs(spark, root, jobs.SNAPSHOT_LOGS)
    prev = RunParams.for_day("1998-07-30")
    fresh = jobs.arrivals(logs, prev, R2, {t: 4 for t in logs})
    for df in (incremental.incremental_from(silver, fresh, gmv_snapshot(logs, prev).checkpoint(), R2),
               incremental.impacted_dates_from(silver, fresh, prev, R2)):
        plan = formatted(df)
        assert "Window" not in plan  # no pick from a log
        scanned = [p for line in plan.split("\n") if line.startswith("Location: ") for p in [line]]
        assert scanned and all("__silver" in p for p in scanned)
    parts = silver.parts_with([dt.date(1998, 7, 15)])
    assert 0 < len(parts) <= 2 < len(silver.tables[S.PURCHASE].manifest()["parts"])
    assert silver.item_parts(parts) == sorted(map(int, parts)) and silver.parts_with([None]) == []


def test_an_append_counts_in_the_passes_that_write(spark):
    path, quarantine = scratch_path(spark, "raw-observed"), scratch_path(spark, "raw-observed-bad")
    log = TD.purchase_cdc(spark, SF).checkpoint()
    raw.append_raw(spark, log.where("purchase_id % 2 = 0"), path, S.PURCHASE)
    sc = spark.sparkContext
    sc.setJobGroup("append", "append")
    done = raw.append_raw(spark, log, path, S.PURCHASE)
    jobs = len(sc.statusTracker().getJobIdsForGroup("append"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    odd = log.where("purchase_id % 2 <> 0")
    assert done["accepted"] == odd.count() and done["rejected"] == 0
    assert done["accepted_until"] == log.agg(F.max("ingestion_ts")).first()[0]
    assert jobs <= 12  # 21 when every count was a job of its own
    broken = log.withColumn("op", F.when(F.col("purchase_id") % 5 == 0, "?").otherwise(F.col("op")))
    bad = log.where("purchase_id % 5 = 0")
    with pytest.raises(raw.DeliveryError, match=f"{bad.count()} rows break a rule"):
        raw.append_raw(spark, broken, path, S.PURCHASE)
    for _ in range(2):  # a repeated delivery overwrites its own folder
        assert raw.append_raw(spark, broken, path, S.PURCHASE, quarantine)["rejected"] == bad.count()
    assert spark.read.parquet(quarantine).count() == bad.count() and len(folders(spark, quarantine)) == 1
    nothing = raw.append_raw(spark, log.limit(0), path, S.PURCHASE)
    assert nothing | {"path": ""} == {"path": "", "accepted": 0, "rejected": 0, "accepted_until": None}
    assert rows(raw.read_raw(spark, path, S.PURCHASE).drop("transaction_date")) == rows(log)
