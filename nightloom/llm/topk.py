"""Exact top-k search by inner product: the threshold algorithm over sorted per-dimension lists."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpointed, fresh, give_back, table

#: Rows in a candidate block and in a block of queries: what one task holds.
BLOCK_ROWS, QUERY_ROWS = 16384, 1024
#: Components are whole numbers of at most this size, so that scores of up to 16,384 dimensions fit in 64 bits.
LARGEST = 1 << 24
FIRST_DEPTH = 32


class SortedLists:
    """A block's vectors and, for each dimension, its rows in order of that component."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((rows, ids))
        self.ids, self.rows = ids[order], rows[order]
        most = int(np.abs(vectors).max(initial=0)) ** 2 * max(1, vectors.shape[1])
        self.vectors = vectors[order].astype(np.float64 if most < 1 << 53 else np.int64)  # sums are exact in either
        self.order = np.argsort(self.vectors, axis=0, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(self.vectors, self.order, axis=0)

    def top(self, query: np.ndarray, k: int, own: int | None) -> tuple[np.ndarray, np.ndarray, int]:
        """(places, scores, places looked at) of the ``k`` best rows but ``own``, ties to smaller ids.

        All lists whose dimension the query uses are read to the same depth, from the end that helps it; rows met first are scored in full. A row
        not met yet scores at most the sum of the last values read, so reading ends once the k-th score is above it (at equal scores a smaller id may still come).
        """
        n = len(self.ids)
        query = query.astype(self.vectors.dtype)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = np.zeros(n, bool)
        if own is not None:
            seen[own] = True
        places, scores = np.empty(0, np.int64), np.empty(0, self.vectors.dtype)
        depth, step, looked = 0, FIRST_DEPTH, 0
        while depth < n:
            stop = min(n, depth + step)
            met = np.zeros(n, bool)
            met[self.order[n - stop : n - depth][:, up]] = True
            met[self.order[depth:stop][:, down]] = True
            if not len(up) and not len(down):  # every score is 0
                met[:] = True
            met &= ~seen
            seen |= met
            new = np.flatnonzero(met)
            looked += len(new)
            found = self.vectors[new] @ query
            if len(scores) == k:
                new, found = new[found >= scores[-1]], found[found >= scores[-1]]
            places, scores = np.concatenate([places, new]), np.concatenate([scores, found])
            best = np.lexsort((places, -scores))[:k]  # places are in order of ids
            places, scores = places[best], scores[best]
            bound = self.values[n - stop, up] @ query[up] + self.values[stop - 1, down] @ query[down]
            if seen.all() or len(scores) == k and scores[-1] > bound:
                break
            depth, step = stop, step * 2
        return places, scores, looked


def unpacked(column) -> np.ndarray:
    """The vectors of an Arrow column of lists of one length."""
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def whole_vector(vector: Column, scale: int, width: int) -> Column:
    """floor(scale * x) of each component, zeros up to ``width``; null where the vector or a component is null or not finite."""
    scaled = F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))).cast("int"))
    good = F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return F.when(good, F.concat(scaled, F.array_repeat(F.lit(0), F.greatest(F.lit(0), F.lit(width) - F.size(vector)))))


def top_matches(vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector: str = "embedding", scale: int = 256, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of highest integer inner product with each row for which ``is_query`` holds, itself left out.

    Vectors become whole numbers floor(``scale`` * x), clamped to ``LARGEST``. Rows are dealt to blocks of about ``block_rows`` by their place in the table,
    whatever their ids, and each block of queries visits each block of candidates: a task holds one of either, and only ``k`` rows per query and block leave it.
    Inside, the threshold algorithm reads sorted lists (:class:`SortedLists`). The best over all blocks are the result, exact whatever the data.

    Ties go to smaller ids, null ids last. Repeated rows and ids are rows like others: each such query has its own ranks, under one ``query_id``. Null vectors and those with a null, NaN
    or infinite component take no part; vectors of different lengths count as ending in zeros. Fewer than ``k`` candidates give fewer rows, none and empty tables none. Other columns are left out.
    """
    width = int(vectors.agg(F.max(F.size(vector))).first()[0] or 0)
    width = max(1, width)
    flag = fresh(vectors, "_query")[0]
    rows = vectors.withColumn(flag, F.coalesce(is_query, F.lit(False))).select(F.col(id_column).cast("bigint").alias("id"), whole_vector(F.col(vector), scale, width).alias("v"), F.col(flag).alias("q"))
    rows = checkpointed(rows.withColumn("row", F.monotonically_increasing_id()).filter("v is not null"))
    n, n_queries = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("q").cast("int")), F.lit(0))).first()
    blocks, query_blocks = -(-n // block_rows) or 1, -(-n_queries // query_rows) or 1
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    spread = lambda count, salt: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(count)).cast("int")
    candidates = rows.select("id", "row", "v", spread(blocks, 0).alias("block"), each(query_blocks).alias("visitors"))
    queries = rows.filter("q").select(F.col("id").alias("query_id"), F.col("row").alias("query"), F.col("v").alias("wanted"), spread(query_blocks, 1).alias("visitors"), each(blocks).alias("block"))

    def search(left, right):
        import pyarrow as pa

        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            rows, unnamed = left["row"].to_numpy(), left["id"].is_null().to_numpy()
            lists = SortedLists(left["id"].fill_null(np.iinfo(np.int64).max).to_numpy(), rows, unpacked(left["v"]))
            missing = set(rows[unnamed].tolist())
            where = {r: i for i, r in enumerate(lists.rows.tolist())}
            for query_id, row, v in zip(right["query_id"].to_pylist(), right["query"].to_pylist(), unpacked(right["wanted"]), strict=True):
                places, scores, _ = lists.top(v, k, where.get(row))
                out += [(row, query_id, None if int(lists.rows[p]) in missing else int(lists.ids[p]), int(s), int(lists.rows[p])) for p, s in zip(places, scores, strict=True)]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        made = pa.table([pa.array(c, pa.int64()) for c in columns], names=["query", "query_id", "vec_id", "score", "row"])
        give_back()
        return made

    fields = "query bigint, query_id bigint, vec_id bigint, score bigint, row bigint"
    found = candidates.groupBy("block", "visitors").cogroup(queries.groupBy("block", "visitors")).applyInArrow(search, fields)
    best = F.row_number().over(W.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op11_top_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_matches(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP11_SQL = """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rn, vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.rn, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON c.rn <> q.rn WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(k AS INT) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY rn ORDER BY score DESC, vec_id) AS k FROM s) x WHERE k <= 5
"""
