"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightloom.operators.graph import cut_lineage, shared_root

#: A word of the query contracts: what stands between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder of ``spark.checkpoint.dir`` (:func:`nightloom.operators.graph.cut_lineage`)."""
    return cut_lineage(df)


def shared_folder(spark: SparkSession) -> str:
    """A new folder's name below the shared folder of ``spark.checkpoint.dir``."""
    return f"{shared_root(spark)}/{uuid.uuid4().hex}"


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names for columns at work that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def others(df: DataFrame, new: Iterable[str]) -> list[str]:
    """The columns of ``df`` but those that new ones replace."""
    gone = {n.lower() for n in new}
    return [c for c in df.columns if c.lower() not in gone]


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks, and all of an executor's share its limit."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of the GNU C library
        trim(0)


def add_columns(df: DataFrame, column: str, fields: str, start: Callable[[], Callable[[list], list[list]]]) -> DataFrame:
    """``df`` with new columns (DDL ``fields``) that Python computes from one column, in Arrow batches.

    ``start()`` runs once a task and gives a function from a batch's values to one list per new column. The
    other columns pass unread; those named as a new one are replaced.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    new = T.StructType.fromDDL(fields)
    kept = [f for f in df.schema.fields if f.name.lower() not in {n.lower() for n in new.names}]
    source = column if column in {f.name for f in kept} else fresh(df, "_read")[0]
    read = df.select(*[f"`{f.name}`" for f in kept], *([] if source == column else [F.col(column).alias(source)]))
    names, kinds, n_kept = [f.name for f in kept] + new.names, [to_arrow_type(f.dataType) for f in new], len(kept)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        compute = start()
        for batch in batches:
            values = compute(batch.column(source).to_pylist()) if batch.num_rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_kept], *(pa.array(v, k) for v, k in zip(values, kinds, strict=True))], names=names)
        del compute
        give_back()

    return read.mapInArrow(run, T.StructType([*kept, *new]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bytes_at_most(df: DataFrame, columns: list[str], limit: int) -> bool:
    """Whether the text columns hold at most ``limit`` bytes in all; one small aggregate, no rows collected."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) + 16 for c in columns), F.lit(0))
    return (df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"] or 0) <= limit


def fold(doc_id: Column, modulus: int) -> Column:
    """The fold of a document: crc32 of its id as text."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))
