"""Streams give what their batch twins give."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from nightloom.streaming import streams


def run(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name)


def write(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(0.05)


def test_ingest_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("1 54593.3 10 20 20.1 F51 S1\n# x\n2 54593.3 10 21 20.1 F51 NS\n")
    (tmp_path / "in/b.txt").write_text("3 54593.3 10 22 20.1 F51 NS\nbad\n")
    rows = run(streams.ingest_stream(spark, str(tmp_path / "in")), "ingested").collect()
    assert sorted(r.det_id for r in rows) == [1, 2, 3] and len({r.file_id for r in rows}) == 2


def test_nights(spark, tmp_path):
    t0 = dt.datetime(2020, 1, 1, 20)
    rows = [(k, t0 + dt.timedelta(hours=k)) for k in range(30)]
    write(spark, str(tmp_path / "e"), rows, "k int, ts timestamp")
    stream = spark.readStream.schema("k int, ts timestamp").parquet(str(tmp_path / "e"))
    got = {r.night_start: r.n for r in run(streams.nightly_counts(stream, "ts", 22), "nights", "complete").collect()}
    want = {r.night_start: r.n for r in streams.nightly_counts(spark.read.parquet(str(tmp_path / "e")), "ts", 22).collect()}
    assert got == want and sorted(want.values()) == [2, 4, 24]


def test_stacks(spark, tmp_path):
    t0 = dt.datetime(2020, 1, 1)
    schema = "stack_id bigint, field_id bigint, expected int, ts timestamp"
    folder = str(tmp_path / "f")
    write(spark, folder, [(1, 1, 2, t0), (2, 3, 2, t0)], schema)
    write(spark, folder, [(1, 2, 2, t0 + dt.timedelta(minutes=10))], schema)
    write(spark, folder, [(9, 9, 1, t0 + dt.timedelta(days=3))], schema)
    write(spark, folder, [(9, 10, 1, t0 + dt.timedelta(days=4))], schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    got = {(r.stack_id, r.n, r.outcome) for r in run(streams.complete_stacks_stream(stream, "ts", "1 hour", 3_600_000), "stacks").collect()}
    assert {(1, 2, "complete"), (2, 1, "orphan")} <= got


def test_alerts(spark, tmp_path):
    t0 = dt.datetime(2020, 1, 1)
    rows = [(k % 3, "r", "mail", t0, 5.0 * k) for k in range(9)]
    write(spark, str(tmp_path / "a"), rows, "alert_id bigint, rule string, channel string, ts timestamp, value double")
    stream = spark.readStream.schema("alert_id bigint, rule string, channel string, ts timestamp, value double").parquet(str(tmp_path / "a"))
    assert run(streams.dedupe_alerts(stream, "ts"), "alerts").count() == 3
    static = spark.createDataFrame([(0, "K1", 50.0), (1, "S1", 50.0), (2, "K2", 1.0)], "alert_id bigint, object_name string, arc_length double")
    fired = run(streams.alert_stream(stream, static, "alert_id", {"big": F.col("value") > 10}, "alert_id", least_arc=10.0), "fired")
    assert [(r.alert_id, r.rule) for r in fired.collect()] == [(0, "big"), (0, "big")]


def test_queue_state(spark, tmp_path):
    schema = "object_id bigint, seq bigint, status string"
    folder = str(tmp_path / "q")
    write(spark, folder, [(1, 1, "N"), (2, 1, "N")], schema)
    write(spark, folder, [(1, 2, "I")], schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    q = streams.queue_state_stream(stream, str(tmp_path / "state"), str(tmp_path / "cp"), "object_id", ["seq"], "status").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.object_id: r.status for r in streams.queue_state(spark, str(tmp_path / "state"), "object_id", "status").collect()}
    assert got == {1: "I", 2: "N"}


def test_runs_of_a_batch():
    assert streams.runs_of(0, 4) == [(0, 0)] and streams.runs_of(3, 4) == [(1, 3)]
    assert streams.runs_of(12, 4) == [(0, 12), (1, 11), (1, 7), (1, 3)] and streams.runs_of(15, 4) == [(2, 15)]


def test_queue_state_writes_what_changes(spark, tmp_path):
    """A large state and small batches: written bytes follow the changes, the state is that of all changes, and a lost run is an error."""
    import shutil

    schema = "object_id bigint, seq bigint, status string"
    folder, state = str(tmp_path / "q"), str(tmp_path / "state")
    spark.range(50_000).select(F.col("id").alias("object_id"), F.lit(0).cast("bigint").alias("seq"), F.md5(F.col("id").cast("string")).alias("status")).coalesce(1).write.parquet(folder)
    time.sleep(0.05)
    want = {}
    for k in range(1, 8):
        rows = [(k * 100 + j, k, f"s{k}") for j in range(150)]
        want |= {r[0]: r[2] for r in rows}
        write(spark, folder, rows, schema)
    size = lambda p: sum(f.stat().st_size for f in p.rglob("*.parquet"))
    written = []

    def follow(stop):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        streams.queue_state_stream(stream, state, str(tmp_path / "cp"), "object_id", ["seq"], "status", fan=3).trigger(availableNow=True).start().awaitTermination(300)
        written.append(size(tmp_path / "state"))
        got = {r.object_id: r.status for r in streams.queue_state(spark, state, "object_id", "status", fan=3).collect()}
        assert len(got) == 50_000 and all(got[k] == v for k, v in stop.items())

    follow(want)
    assert streams.complete_runs(spark, state) == {(0, 7), (0, 6), (1, 5), (1, 2)}  # eight batches; what was merged is gone
    assert size(tmp_path / "state/level=0") < 0.05 * written[0]
    write(spark, folder, [(1, 99, "last")], schema)
    follow(want | {1: "last"})
    shutil.rmtree(tmp_path / "state/level=2")
    write(spark, folder, [(2, 99, "last")], schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    with pytest.raises(Exception, match="incomplete"):
        streams.queue_state_stream(stream, state, str(tmp_path / "cp"), "object_id", ["seq"], "status", fan=3).trigger(availableNow=True).start().awaitTermination(120)
    shutil.rmtree(tmp_path / "state/level=1")
    with pytest.raises(FileNotFoundError):
        streams.queue_state(spark, state, "object_id", "status", fan=3)
