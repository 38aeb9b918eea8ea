import datetime as dt
import os
import shutil
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import at, rows, rule, rules, tick, ticks
from tickward.operators.retention import day_slice, purge_expired
from tickward.schemas import RULE, TICK
from tickward.sources import commits as log_module
from tickward.sources import files, storage
from tickward.sources.commits import BatchId, Commit, commits, prune, read_commits, rewrite, write_commit
from tickward.sources.files import append_archive, archive_by_day, archive_day, archive_snapshot, read_archive


def days(spark):
    return ticks(
        spark,
        tick("a", ts=at("2025-01-01 05:00:00")),
        tick("b", ts=at("2025-01-02 05:00:00")),
        tick("c", ts=at("2025-01-02 06:00:00")),
        tick("d", ts=None),
    )


def test_batch_archive_is_replay_safe(spark, out):
    assert read_archive(spark, out, TICK).count() == 0
    append_archive(ticks(spark, tick("a")), out, 0)
    append_archive(ticks(spark, tick("b")), out, 1)
    append_archive(ticks(spark, tick("b")), out, 1)
    assert rows(read_archive(spark, out, TICK), "id", "batch_id") == [("a", 0), ("b", 1)]


def test_batches_of_another_stream_do_not_replace_each_other(spark, out):
    for source in ("one", "two", "two"):
        append_archive(ticks(spark, tick(source)), out, BatchId.of(0, source))
    assert rows(read_archive(spark, out, TICK), "id", "batch_id") == [("one", 0), ("two", 0)]


def dated(spark, path):
    return rows(spark.read.parquet(path).selectExpr("id", "cast(date as string) as date"), "id", "date")


def test_day_archive_run_again_adds_nothing_and_loses_nothing(spark, out):
    archive_day(days(spark), "last_updated", out, "2025-01-01")
    for left in ("id <> 'none'", "id = 'b'", "id <> 'none'"):
        archive_day(days(spark).filter(left), "last_updated", out, "2025-01-02")
    assert dated(spark, out) == [("a", "2025-01-01"), ("b", "2025-01-02"), ("c", "2025-01-02")]


def test_repeated_rows_of_a_day_are_all_archived(spark, out):
    twice = days(spark).unionAll(days(spark))
    for df in (days(spark), twice, twice):
        archive_by_day(df, "last_updated", out)
    assert spark.read.parquet(out).count() == 8


def test_archive_by_day_keeps_what_left_the_table_and_what_has_no_time(spark, out):
    archive_by_day(days(spark), "last_updated", out)
    archive_by_day(ticks(spark, tick("z", ts=at("2025-01-02 01:00:00"))), "last_updated", out)
    want = [("a", "2025-01-01"), ("b", "2025-01-02"), ("c", "2025-01-02"), ("d", None), ("z", "2025-01-02")]
    assert dated(spark, out) == want


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_days_are_utc_in_any_session_zone(spark, out, zone):
    days(spark).write.parquet(f"{out}/t")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.read.parquet(f"{out}/t")
        assert rows(day_slice(df, "last_updated", "2025-01-02"), "id") == [("b",), ("c",)]
        assert rows(purge_expired(df, as_of="2025-01-03 05:30:00"), "id") == [("c",), ("d",)]
        archive_by_day(df, "last_updated", f"{out}/a")
        assert dated(spark, f"{out}/a") == [("a", "2025-01-01"), ("b", "2025-01-02"), ("c", "2025-01-02"), ("d", None)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_snapshot_archive_overwrites_its_date(spark, out):
    archive_snapshot(days(spark), out, "2025-01-02")
    archive_snapshot(ticks(spark, tick("z")), out, "2025-01-02")
    archive_snapshot(ticks(spark, tick("y")), out, "2025-01-03")
    assert rows(spark.read.parquet(out), "id") == [("y",), ("z",)]
    with pytest.raises(ValueError):
        archive_snapshot(days(spark), out, "yesterday")


def test_commits(spark, out):
    assert commits(spark, out) == [] and read_commits(spark, out, TICK).count() == 0
    write_commit(ticks(spark, tick("a")), out)
    full = write_commit(ticks(spark, tick("b")), out, "full")
    write_commit(ticks(spark, tick("c")), out)
    late = write_commit(ticks(spark, tick("d")), out, "full", upto=full.seq, note=7)
    assert [c.seq for c in commits(spark, out)] == [0, 1, 2, 3] and Commit.read(late.mark) == late
    assert rows(read_commits(spark, out, TICK), "id") == [("c",), ("d",)]


def test_a_writer_that_pauses_however_long_loses_nothing(spark, out, monkeypatch):
    """Its data is written, a fold and a prune run, and only then it marks its commit."""
    write_commit(ticks(spark, tick("a")), out)
    mark = log_module.create_new

    def paused(*args):
        monkeypatch.setattr(log_module, "create_new", mark)
        rewrite(spark, out, TICK, lambda df: df)
        write_commit(ticks(spark, tick("c")), out)
        prune(spark, out)
        return mark(*args)

    monkeypatch.setattr(log_module, "create_new", paused)
    write_commit(ticks(spark, tick("b")), out)
    assert rows(read_commits(spark, out, TICK), "id") == [("a",), ("b",), ("c",)]
    rewrite(spark, out, TICK, lambda df: df)
    assert rows(read_commits(spark, out, TICK), "id") == [("a",), ("b",), ("c",)] and commits(spark, out).deltas == []


def test_two_jobs_that_rewrite_the_same_state_both_count(spark, out):
    """The second finds the next state made and starts again from it."""
    write_commit(ticks(spark, *[tick(c) for c in "abcd"]), out, "full")
    began = []

    def without(df, id):
        if not began:
            began.append(1)
            rewrite(spark, out, TICK, lambda df: df.filter("id <> 'a'"))
            write_commit(ticks(spark, tick("e")), out)
        return df.filter(F.col("id") != id)

    rewrite(spark, out, TICK, lambda df: without(df, "b"))
    assert rows(read_commits(spark, out, TICK), "id") == [("c",), ("d",), ("e",)]
    assert len(commits(spark, out)) == 4 and len(os.listdir(f"{out}/data")) == 4


def test_a_stale_writer_cannot_take_a_head_that_was_pruned(spark, out):
    write_commit(ticks(spark, tick("a")), out, "full")
    stale = commits(spark, out)
    for name in "bc":
        write_commit(ticks(spark, tick(name)), out, "full")
    prune(spark, out, dt.timedelta(0))
    late = Commit(9, "full", "", -1, -1, "x")
    assert not log_module._follow(spark, out, stale, late, stale)
    assert rows(read_commits(spark, out, TICK), "id") == [("c",)]


def test_a_numbered_commit_whose_writer_died_before_the_mark_counts(spark, out):
    mark = write_commit(ticks(spark, tick("a")), out, note=0, number=0).mark
    assert write_commit(ticks(spark, tick("b")), out, note=0, number=0) is None
    os.remove(f"{out}/_commits/{mark}")
    assert [c.mark for c in commits(spark, out)] == [mark]
    assert rows(read_commits(spark, out, TICK), "id") == [("a",)]


def test_publishing_is_exclusive_and_object_stores_must_be_able_to(spark, out, monkeypatch):
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda n: storage.publish(spark, f"{out}/x/0", str(n)), range(8)))
    assert sum(won) == 1 and storage.read_text(spark, f"{out}/x/0") == str(won.index(True))
    assert os.listdir(f"{out}/x") == ["0"]
    monkeypatch.setattr(storage, "OBJECT_STORES", ("file",))
    with pytest.raises(ValueError, match="conditional writes"):
        storage.publish(spark, f"{out}/x/1", "")


def test_replayed_batches_are_recognised_even_after_folding(spark, out):
    for _ in range(2):
        for n in range(3):
            write_commit(ticks(spark, tick(str(n))), out, batch_id=BatchId.of(n, "s"))
        rewrite(spark, out, TICK, lambda df: df)
        prune(spark, out, dt.timedelta(0))
    assert rows(read_commits(spark, out, TICK), "id") == [("0",), ("1",), ("2",)]
    write_commit(ticks(spark, tick("other")), out, batch_id=BatchId.of(0, "t"))
    assert read_commits(spark, out, TICK).count() == 4


def test_prune_spares_what_is_in_force_and_what_is_recent(spark, out):
    for name in "ab":
        write_commit(ticks(spark, tick(name)), out, "full")
    write_commit(ticks(spark, tick("c")), out)
    assert prune(spark, out) == []
    assert prune(spark, out, dt.timedelta(0)) == [0]
    assert rows(read_commits(spark, out, TICK), "id") == [("b",), ("c",)]


def test_data_without_marks_is_an_error_and_other_marks_do_not_matter(spark, out):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        write_commit(ticks(spark, tick("a")), out)
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert read_commits(spark, out, TICK).count() == 1
    os.rename(f"{out}/_commits", f"{out}/elsewhere")
    with pytest.raises(ValueError, match="no commits"):
        read_commits(spark, out, TICK)


def test_rewriting_a_table_from_itself(spark, out):
    write_commit(rules(spark, rule(1), rule(2)), out, "full", partition_by=["is_alerted"])
    rewrite(spark, out, RULE, lambda df: df.filter("chat_id = 2"), partition_by=["is_alerted"])
    assert rows(read_commits(spark, out, RULE), "chat_id", "is_alerted") == [(2, False)]


def test_flag_folders_read_back_typed_and_prune(spark, out):
    df = rules(spark, rule(1, flag=True), rule(2, flag=False), rule(3, flag=None))
    write_commit(df, out, "full", partition_by=["is_alerted"])
    back = read_commits(spark, out, RULE)
    assert back.schema["is_alerted"].dataType == T.BooleanType()
    assert rows(back, "chat_id", "is_alerted") == [(1, True), (2, False), (3, None)]
    write_commit(rules(spark, rule(4)), out)
    back = read_commits(spark, out, RULE)
    assert rows(back, "chat_id", "is_alerted") == [(1, True), (2, False), (3, None), (4, False)]
    plan = back.filter("is_alerted = false")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_alerted" in plan


def scanned_days(monkeypatch):
    """Days of the archive that a comparison asks for."""
    asked = []
    compare = files._missing_from
    monkeypatch.setattr(files, "_missing_from", lambda rows, held: asked.append(sorted(str(r[0]) for r in held.select("date").distinct().collect())) or compare(rows, held))
    return asked


def test_days_that_agree_are_not_read_again(spark, out, monkeypatch):
    month = ticks(spark, *[tick(f"t{n}", ts=at(f"2025-01-{n % 30 + 1:02d} 10:00:00")) for n in range(90)], tick("none", ts=None), tick("none", ts=None))
    archive_by_day(month, "last_updated", out)
    asked = scanned_days(monkeypatch)
    archive_by_day(month, "last_updated", out)
    assert asked == [] and spark.read.parquet(out).count() == 92
    later = month.unionByName(ticks(spark, tick("t0", ts=at("2025-01-01 10:00:00")), tick("far", ts=at("1970-01-01 00:00:00")), tick("new", ts=at("2025-03-01 00:00:00"))))
    archive_by_day(later, "last_updated", out)
    assert asked == [["2025-01-01"]] and spark.read.parquet(out).count() == 95
    archive_by_day(later, "last_updated", out)
    assert len(asked) == 1
    # rows that left the table stay, and the day is compared, not written
    archive_by_day(later.where("id <> 't5'"), "last_updated", out)
    assert asked[1:] == [["2025-01-06"]] and spark.read.parquet(out).count() == 95


def test_an_archive_whose_digests_are_lost_is_compared(spark, out):
    archive_by_day(days(spark), "last_updated", out)
    want = spark.read.parquet(out).count()
    shutil.rmtree(f"{out}/_digests")
    for _ in range(2):
        archive_by_day(days(spark), "last_updated", out)
    assert spark.read.parquet(out).count() == want


def test_maps_are_archived_once(spark, out):
    made = spark.sql("SELECT * FROM VALUES (1, map('a', 1, 'b', 2), TIMESTAMP '2025-01-01 00:00:00'), (1, map('b', 2, 'a', 1), TIMESTAMP '2025-01-01 01:00:00'), (2, NULL, NULL) t(id, m, ts)")
    archive_by_day(made, "ts", out)
    more = made.unionByName(spark.sql("SELECT 3 AS id, map('c', 3) AS m, TIMESTAMP '2025-01-01 00:00:00' AS ts"))
    for _ in range(2):
        archive_by_day(more, "ts", out)
    assert sorted((r.id, r.m) for r in spark.read.parquet(out).collect() if r.m) == [(1, {"a": 1, "b": 2}), (1, {"a": 1, "b": 2}), (3, {"c": 3})]
    assert spark.read.parquet(out).count() == 4


def test_digests_are_folded(spark, out, monkeypatch):
    monkeypatch.setattr(files, "FOLD_DIGESTS", 2)
    for n in range(5):
        archive_by_day(ticks(spark, *[tick(f"t{k}", ts=at("2025-01-01")) for k in range(n + 1)]), "last_updated", out)
    assert len(commits(spark, f"{out}/_digests").deltas) <= 2
    assert spark.read.parquet(out).count() == 5
