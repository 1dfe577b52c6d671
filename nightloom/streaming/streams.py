"""The survey's queues and watchers as structured streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.graph import children, remove
from ..operators.rules import evaluate_rules
from ..sources.text import parse_detections


def ingest_stream(spark: SparkSession, folder: str, per_batch: int = 100) -> DataFrame:
    """Detections of arriving text files, each file once by name and size (the ledger's key), with that key."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", per_batch).load(folder)
    keyed = lines.select("value", F.concat_ws(":", F.col("_metadata.file_name"), F.col("_metadata.file_size").cast("string")).alias("file_id"))
    return parse_detections_with(keyed)


def parse_detections_with(keyed: DataFrame) -> DataFrame:
    """Parsed detections that keep their file's key."""
    from ..sources.text import DETECTION, _typed

    rows = keyed.filter(~F.col("value").rlike(r"^\s*(#|$)"))
    return rows.select("file_id", *_typed(F.split(F.trim("value"), r"\s+"), DETECTION)).filter("det_id is not null")


def nightly_counts(events: DataFrame, time: str, start_hours: int, delay: str | None = "1 day", keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows per noon-to-noon night (and keys); streams drop what comes later than ``delay``."""
    e = events.withWatermark(time, delay) if events.isStreaming and delay else events
    w = F.window(time, "1 day", startTime=f"{start_hours} hours")
    return e.groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("night_start"), *keys, "n")


STACKS = "stack_id bigint, n bigint, outcome string"


def complete_stacks_stream(fields: DataFrame, time: str, wait: str, wait_ms: int) -> DataFrame:
    """(stack_id, n, outcome): stacks whose siblings (``expected`` of them) all came, or that timed out as orphans.

    ``fields`` has stack_id, field_id, expected and the event time.
    """

    def hold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, expected = state.get if state.exists else ([], 0)
        seen = set(seen)
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"stack_id": [key[0]], "n": [len(seen)], "outcome": ["orphan"]})
            return
        latest = 0
        for batch in batches:
            seen |= set(map(int, batch["field_id"]))
            expected = max(expected, int(batch["expected"].max()))
            latest = max(latest, int(batch[time].max().timestamp() * 1000))
        if len(seen) >= expected:
            state.remove()
            yield pd.DataFrame({"stack_id": [key[0]], "n": [len(seen)], "outcome": ["complete"]})
            return
        state.update((sorted(seen), expected))
        state.setTimeoutTimestamp(max(latest, state.getCurrentWatermarkMs()) + wait_ms)

    keyed = fields.withWatermark(time, wait).groupBy("stack_id")
    return keyed.applyInPandasWithState(hold, STACKS, "seen array<bigint>, expected int", "append", GroupStateTimeout.EventTimeTimeout)


def complete_stacks(fields: DataFrame) -> DataFrame:
    """The batch twin: stacks with all siblings, others as orphans."""
    s = fields.groupBy("stack_id").agg(F.count_distinct("field_id").alias("n"), F.max("expected").alias("expected"))
    return s.select("stack_id", "n", F.when(F.col("n") >= F.col("expected"), "complete").otherwise("orphan").alias("outcome"))


def alert_stream(new: DataFrame, static: DataFrame, on: str, rules: dict[str, Column], key: str, synthetic: bool = False, least_arc: float | None = None) -> DataFrame:
    """(key, rule) of new rows joined to a static table; synthetic objects and short arcs are held back. Streams and tables alike."""
    j = new.join(static, on)
    if not synthetic:
        j = j.filter(~F.coalesce(F.col("object_name").startswith("S"), F.lit(False)))
    if least_arc is not None:
        j = j.filter(F.col("arc_length") >= least_arc)
    return evaluate_rules(j, rules, key)


def dedupe_alerts(alerts: DataFrame, time: str, delay: str = "7 days") -> DataFrame:
    """One alert per (alert_id, rule, channel)."""
    a = alerts.withWatermark(time, delay) if alerts.isStreaming else alerts
    return a.dropDuplicates(["alert_id", "rule", "channel"])


def new_alerts(alerts: DataFrame, published: DataFrame) -> DataFrame:
    """The batch twin: alerts not published yet."""
    keys = ["alert_id", "rule", "channel"]
    return alerts.dropDuplicates(keys).join(published.select(*keys), keys, "left_anti")


def latest_alerts(alerts: DataFrame, time: str) -> DataFrame:
    """Updates keep the newest row of each alert."""
    keys = ["alert_id", "rule", "channel"]
    rest = [c for c in alerts.columns if c not in keys]
    return alerts.groupBy(*keys).agg(F.max(F.struct(time, *[c for c in rest if c != time])).alias("m")).select(*keys, "m.*")


def latest_status(changes: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """The newest value per key."""
    return changes.groupBy(key).agg(F.max(F.struct(*order, value)).alias("m")).select(key, F.col(f"m.{value}").alias(value))


def runs_of(number: int, fan: int) -> list[tuple[int, int]]:
    """(level, last batch) of the runs that hold batches 0 to ``number``: as many of each level as the digits of their count to the base ``fan`` say."""
    found, end, count, level = [], number, number + 1, 0
    while count:
        count, digit = divmod(count, fan)
        found += [(level, end - k * fan**level) for k in range(digit)]
        end -= digit * fan**level
        level += 1
    return found


def queue_state_stream(changes: DataFrame, path: str, checkpoint: str, key: str, order: list[str], value: str, fan: int = 8):
    """A stream that keeps the newest status per object below ``path`` (read it with :func:`queue_state`).

    A micro-batch writes its own newest rows, a run of level 0. ``fan`` runs of a level become one of the next, so a row is written once per level, the logarithm of the batches, and what is written follows the changes, not the
    state. Which runs there are follows from a batch's number alone: a batch that is run again writes the same, and runs that were merged go only with the batch after. A batch whose earlier
    runs are missing fails instead of starting over.
    """
    spark = changes.sparkSession
    run = lambda level, last: f"{path}/level={level}/upto={last}"
    inputs = lambda level, last: [(level - 1, last - k * fan ** (level - 1)) for k in range(fan)]

    def merge(batch: DataFrame, number: int) -> None:
        there = complete_runs(spark, path)
        if number and (lost := [x for x in runs_of(number - 1, fan) if x not in there]):
            raise FileNotFoundError(f"state of batch {number - 1} is incomplete below {path}: no run {lost[0]}")
        batch.groupBy(key).agg(F.max(F.struct(*order, value)).alias("m")).write.mode("overwrite").parquet(run(0, number))
        level = 1
        while (number + 1) % fan**level == 0:
            spark.read.parquet(*[run(*x) for x in inputs(level, number)]).groupBy(key).agg(F.max("m").alias("m")).write.mode("overwrite").parquet(run(level, number))
            level += 1
        level = 1
        while number and number % fan**level == 0:  # merged by the batch before, which is done
            for x in inputs(level, number - 1):
                remove(spark, run(*x))
            level += 1

    return changes.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def complete_runs(spark: SparkSession, path: str) -> set[tuple[int, int]]:
    """The runs below ``path`` whose writing has ended; a handful per level."""
    names = [(int(level.split("=")[1]), int(last.split("=")[1])) for level in children(spark, path) if level.startswith("level=") for last in children(spark, f"{path}/{level}") if last.startswith("upto=")]
    return {(level, last) for level, last in names if "_SUCCESS" in children(spark, f"{path}/level={level}/upto={last}")}


def queue_state(spark: SparkSession, path: str, key: str, value: str, fan: int = 8) -> DataFrame:
    """(key, value) of the last batch that :func:`queue_state_stream` wrote, or of the one before where that is being written; runs that are missing beyond that are an error."""
    there = complete_runs(spark, path)
    newest = max((last for _, last in there), default=-1)
    for number in (newest, newest - 1):
        if number >= 0 and set(need := runs_of(number, fan)) <= there:
            rows = spark.read.parquet(*[f"{path}/level={level}/upto={last}" for level, last in need])
            return rows.groupBy(key).agg(F.max("m").alias("m")).select(key, F.col(f"m.{value}").alias(value))
    raise FileNotFoundError(f"no whole state of batch {newest} below {path}")


__all__ = ["alert_stream", "complete_stacks", "complete_stacks_stream", "dedupe_alerts", "ingest_stream", "latest_alerts", "latest_status", "new_alerts", "nightly_counts", "parse_detections", "queue_state", "queue_state_stream"]
