import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from haze.session import scratch_path
from haze.snapshots import NO_DATE, Conflict, Warehouse

SCHEMA = "canonical_city string, d date, v int"


def _rows(spark, *rows):
    return spark.createDataFrame([(c, d and dt.date.fromisoformat(d), v) for c, d, v in rows], SCHEMA)


@pytest.fixture
def wh(spark):
    return Warehouse(spark, scratch_path(spark, "test-warehouse"))


def _set(df):
    return sorted((r.canonical_city, str(r.d), r.v) for r in df.collect())


def test_nothing_is_visible_before_the_commit(spark, wh):
    tx = wh.begin()
    tx.replace("t", _rows(spark, ("a", "2024-01-01", 1), ("b", None, 2)), F.col("d"))
    assert wh.versions() == [] and _set(tx.read("t")) == [("a", "2024-01-01", 1), ("b", "None", 2)]
    with pytest.raises(KeyError):
        wh.read("t")
    tx.commit({"by": "test"})
    assert wh.versions() == [1] and wh.snapshot().notes == {"by": "test"}
    assert set(wh.snapshot().tables["t"]) == {"2024-01-01", NO_DATE}


def test_replaced_dates_and_old_versions(spark, wh):
    tx = wh.begin()
    tx.replace("t", _rows(spark, ("a", "2024-01-01", 1), ("b", "2024-01-02", 2), ("c", "2024-01-03", 3)), F.col("d"))
    first = tx.commit()
    tx = wh.begin()
    tx.replace("t", _rows(spark, ("z", "2024-01-02", 9)), F.col("d"), parts=["2024-01-02", "2024-01-03"])
    tx.commit()
    assert _set(wh.read("t")) == [("a", "2024-01-01", 1), ("z", "2024-01-02", 9)]  # a date without rows is gone
    assert _set(wh.read("t", snapshot=first)) == [("a", "2024-01-01", 1), ("b", "2024-01-02", 2), ("c", "2024-01-03", 3)]
    with pytest.raises(ValueError, match="not replaced"):
        wh.begin().replace("t", _rows(spark, ("z", "2024-02-02", 9)), F.col("d"), parts=["2024-01-01"])


def test_a_read_of_dates_lists_only_their_files(spark, wh):
    tx = wh.begin()
    tx.replace("t", _rows(spark, *(("a", f"2024-01-{k:02}", k) for k in range(1, 21))), F.col("d"))
    tx.commit()
    files = wh.read("t", ["2024-01-03", "2024-01-07", "2030-01-01"]).inputFiles()
    assert len(files) == 2 and all("2024-01-03" in f or "2024-01-07" in f for f in files)


def test_the_second_of_two_commits_fails_and_changes_nothing(spark, wh):
    one, two = wh.begin(), wh.begin()
    one.replace("t", _rows(spark, ("one", "2024-01-01", 1)), F.col("d"))
    two.replace("t", _rows(spark, ("two", "2024-01-01", 2)), F.col("d"))
    two.commit()
    with pytest.raises(Conflict):
        one.commit()
    assert _set(wh.read("t")) == [("two", "2024-01-01", 2)] and wh.versions() == [1]


def test_a_load_replaces_its_earlier_try(spark, wh):
    for load, rows in (("x", [("a", "2024-01-01", 1), ("a", "2024-01-02", 2)]), ("y", [("b", "2024-01-01", 5)]), ("x", [("a", "2024-01-03", 3)])):
        tx = wh.begin()
        dates, changed = tx.load("raw", _rows(spark, *rows), F.col("d"), load)
        tx.commit()
    assert dates == {"2024-01-01", "2024-01-02", "2024-01-03"}
    assert _set(changed) == [("a", "2024-01-01", 1), ("a", "2024-01-02", 2), ("a", "2024-01-03", 3)]
    assert _set(wh.read("raw")) == [("a", "2024-01-03", 3), ("b", "2024-01-01", 5)]


def test_copy_on_write_by_date_and_city(spark, wh):
    """Ten years and many cities: one folder for each date, other cities of a date stay."""
    spine = spark.sql("SELECT explode(sequence(DATE'2015-01-01', DATE'2024-12-31')) AS d")
    cities = spark.range(20).select(F.concat(F.lit("c"), "id").alias("canonical_city"))
    first = spine.where("d < '2015-03-01'").crossJoin(cities).select("canonical_city", "d", F.lit(1).alias("v"))
    tx = wh.begin()
    tx.replace_keys("wx", first, F.col("d"), ["canonical_city"])
    tx.commit()
    tx = wh.begin()
    again = spine.where("d < '2015-02-01'").select(F.lit("c3").alias("canonical_city"), "d", F.lit(2).alias("v"))
    dates = tx.replace_keys("wx", again.unionByName(_rows(spark, (None, "2015-01-01", 7))), F.col("d"), ["canonical_city"])
    tx.commit()
    assert len(dates) == 31 and all(len(f) == 1 for f in wh.snapshot().tables["wx"].values())
    got = wh.read("wx")
    assert got.count() == 59 * 20 + 1 and got.where("v = 2").count() == 31 and got.where("canonical_city = 'c3' AND v = 1").count() == 28


def test_merging_keeps_rows(spark, wh):
    for k in range(4):
        tx = wh.begin()
        tx.load("raw", _rows(spark, ("a", "2024-01-01", k)), F.col("d"), f"l{k}")
        tx.commit()
    tx = wh.begin()
    assert tx.merge_folders("raw", F.col("d"), most=3) == {"2024-01-01"}
    tx.commit()
    assert len(wh.snapshot().tables["raw"]["2024-01-01"]) == 1 and [v for _, _, v in _set(wh.read("raw"))] == [0, 1, 2, 3]


def test_vacuum_removes_what_no_kept_snapshot_lists(spark, wh):
    for v in range(3):
        tx = wh.begin()
        tx.replace("t", _rows(spark, ("a", "2024-01-01", v), ("b", "2024-01-02", v)), F.col("d"), parts=None if v == 0 else ["2024-01-01", "2024-01-02"])
        tx.commit()
    dead = wh.begin()  # a run that never commits
    dead.replace("t", _rows(spark, ("dead", "2024-01-01", 0)), F.col("d"))
    assert wh.vacuum(keep=1) == []  # all younger than a day
    assert len(wh.vacuum(keep=1, min_age_hours=0)) == 3 and wh.versions() == [3]
    assert [v for _, _, v in _set(wh.read("t"))] == [2, 2]


def test_concurrent_writes_of_one_transaction(spark, wh):
    tx = wh.begin()
    work = [threading.Thread(target=tx.replace, args=(f"t{k}", _rows(spark, ("a", "2024-01-01", k)), F.col("d"))) for k in range(4)]
    [t.start() for t in work]
    [t.join() for t in work]
    assert sorted(tx.commit().tables) == ["t0", "t1", "t2", "t3"]
