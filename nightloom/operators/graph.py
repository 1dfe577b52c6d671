"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``. Where none is set, a new temporary one on a local master; on a cluster that would
    lose what lost executors leave to others, so it is refused there."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="spark-shared-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """``checkpoint()`` into the shared folder (:func:`shared_root`)."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def file_system(spark: SparkSession, path: str):
    """The file system of a path and the path, as the cluster's own classes: any store that Spark writes to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, none where there is no such folder."""
    fs, at = file_system(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, if it is there."""
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def forget(*cut: DataFrame | None) -> None:
    """Delete the checkpoints of frames from :func:`cut_lineage` that nothing reads any more: what came from them must be written by now."""
    for df in cut:
        if df is not None:
            kept = df._jdf.queryExecution().logical()
            if kept.nodeName().startswith("Scan ExistingRDD") or kept.getClass().getSimpleName() == "LogicalRDD":
                file = kept.rdd().getCheckpointFile()
                if file.isDefined():
                    remove(df.sparkSession, file.get())


def connected_components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """(node, component) for each node of an edge; the component is its smallest node.

    Each round links every node's larger neighbours, then its smaller ones, to its smallest neighbour; the number
    of rounds grows with the logarithm of the graph's size. Minima are aggregated before the shuffle and
    joined back by sort-merge joins, which adaptive execution splits at hubs. Edges with a null end are left out;
    loops and repeated edges change nothing.
    """
    e = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u is not null and v is not null")
    nodes = e.select(F.col("u").alias("node")).union(e.select("v")).distinct()
    e = cut_lineage(e.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, e = e, cut_lineage(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        forget(old)
        now = tuple(e.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())
        if now == before:
            break
        before = now
    component = e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return nodes.join(component, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
