"""A Merkle manifest of a table: trees of hashes per group below one root, with every row's proof of membership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nightloom.operators.numbering import numbered

from .common import checkpointed, fold, table

FANOUT = 8
#: Runs of siblings that share a window's partition; a power of FANOUT, so that no run is cut.
RUNS_TOGETHER = 64


def framed(value: Column) -> Column:
    """A value as text that can't be mistaken for two: its length in bytes, a colon and the value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_hash(*values: Column) -> Column:
    """The hash of a row's values in their order."""
    return F.sha2(F.concat(*[framed(v) for v in values]).cast("binary"), 256)


def placed(leaves: DataFrame) -> DataFrame:
    """(key, pos, n, h, row) from (key, o, h, row): each leaf's place in its key's order and the key's number of leaves.

    Leaves are range-partitioned over all keys, so a key with most of them is spread; a small table with a row per range and key says
    how many of the key's leaves come in earlier ranges. The ranged rows are written first, as ranges come from a sample.
    """
    ranged = leaves.repartitionByRange("key", "o", "h").sortWithinPartitions("key", "o", "h").select("key", "h", "row", F.monotonically_increasing_id().alias("id"))
    ranged = checkpointed(ranged).withColumn("part", F.shiftright("id", 33))
    sizes = ranged.groupBy("part", "key").agg(F.count("*").alias("here"), F.min("id").alias("first"))
    earlier = F.coalesce(F.sum("here").over(W.partitionBy("key").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("part", "key", (earlier - F.col("first")).alias("shift"), F.sum("here").over(W.partitionBy("key")).alias("n"))  # rows: ranges and keys
    return ranged.join(sizes, ["part", "key"]).select("key", (F.col("id") + F.col("shift")).alias("pos"), "n", "h", "row")


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Add ``left`` and ``right``: the hashes of the other nodes of a run of ``FANOUT``, joined in order.

    Neighbours at fixed offsets come from lag and lead columns, masked by the node's slot in its run and the run's length. A window's
    partition holds whole runs, a fixed number of them.
    """
    w = W.partitionBy("key", F.floor(F.col("pos") / (FANOUT * RUNS_TOGETHER))).orderBy("pos")
    slot = F.col("pos") % FANOUT
    length = F.least(F.lit(FANOUT), F.col("n") - F.col("pos") + slot)
    left = [F.when(slot >= j, F.lag("h", j).over(w)) for j in range(FANOUT - 1, 0, -1)]
    right = [F.when(slot + j < length, F.lead("h", j).over(w)) for j in range(1, FANOUT)]
    return nodes.withColumns({"left": F.concat_ws("", *left), "right": F.concat_ws("", *right)})


def parents(level: DataFrame) -> DataFrame:
    """The next level: the first child of each run hashes itself and its siblings. A node alone in its tree is its root and stays as it is."""
    first = level.filter(F.col("pos") % FANOUT == 0)
    made = F.when(F.col("n") > 1, F.sha2(F.concat("h", "right").cast("binary"), 256)).otherwise(F.col("h"))
    return first.select("key", F.floor(F.col("pos") / FANOUT).alias("pos"), F.ceil(F.col("n") / FANOUT).alias("n"), made.alias("h"))


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all keys' trees, siblings beside each node, and the roots (key, pos, n, h). Each level is written, an eighth of the one below."""
    levels, most = [], None
    while most is None or most > 1:
        levels.append(checkpointed(with_siblings(nodes)))
        most = most or levels[0].agg(F.max("n")).first()[0] or 1
        nodes, most = parents(levels[-1]), -(-most // FANOUT)
    return levels, nodes


def descend(levels: list[DataFrame], roots: DataFrame, known: list[str]) -> DataFrame:
    """The lowest level with ``path``, the (left, right) hashes from a node's own run up to its root's, after the roots' own ``path``; and with
    the roots' columns ``known``. A level's nodes meet their parents one level up, at most ``FANOUT`` of them one parent."""
    above = roots
    for level in reversed(levels):
        up = above.select(F.col("key"), F.col("pos").alias("up"), F.col("path").alias("rest"), *known)
        own = F.when(F.col("n") > 1, F.array(F.struct("left", "right"))).otherwise(F.array().cast("array<struct<left:string,right:string>>"))
        joined = level.withColumn("up", F.floor(F.col("pos") / FANOUT)).join(up, ["key", "up"])
        above = joined.select("key", "pos", *[c for c in level.columns if c not in ("key", "pos", "n", "left", "right")], F.concat(own, F.col("rest")).alias("path"), *known)
    return above


def merkle_manifest(docs: DataFrame, leaf: Column, group: str = "lang", order: str = "doc_id", keep: tuple[str | Column, ...] = ("doc_id",)) -> DataFrame:
    """(the columns ``keep``, leaf, subroot, root, path): a row per row of ``docs``.

    Leaves of a group ascend by ``order`` (nulls first, then by hash); runs of ``FANOUT`` nodes become their hash until one is left, the group's subroot. The
    subroots, by group (null first, then by its bytes), become the root likewise. ``path`` lists what :func:`folded` needs to come from a leaf to the root: per level the
    hashes of the run's other nodes, those before and those after it. All hashes are hex texts of SHA-256, and what is hashed are such texts, joined.

    No task holds a group: places come from ranges of all rows, siblings from windows over whole runs, paths from joins with parents. Only hashes and ``keep`` move. Rows
    that are the same in order and hash stand beside each other, each a leaf. An empty table gives none. Columns not kept are left out; theirs and the result's names don't clash with any at work, but
    a kept column must not be named like one of the result.
    """
    key = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaves = checkpointed(docs.select(key.alias("key"), F.col(order).alias("o"), leaf.alias("h"), F.struct(*keep).alias("row")))
    levels, subroots = climb(placed(leaves))
    tops = numbered(checkpointed(subroots.select(F.col("key").alias("of"), "h")), ["of"], "place")
    top_levels, root = climb(tops.select(F.lit("").alias("key"), (F.col("place") - 1).alias("pos"), F.lit(tops.count()).cast("bigint").alias("n"), "h", "of"))
    none = F.array().cast("array<struct<left:string,right:string>>")
    known = descend(top_levels, root.select("key", "pos", F.col("h").alias("root"), none.alias("path")), ["root"])
    known = checkpointed(known.select(F.col("of").alias("key"), F.lit(0).cast("bigint").alias("pos"), F.col("h").alias("subroot"), "root", "path"))
    return descend(levels, known, ["subroot", "root"]).select("row.*", F.col("h").alias("leaf"), "subroot", "root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda h, x: F.sha2(F.concat(x["left"], h, x["right"]).cast("binary"), 256))


def proof(path: Column) -> Column:
    """The hashes of a path as one text, from the leaf's level up, in order."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), "")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    leaf = lambda text: row_hash(*map(F.col, ("doc_id", "source", "lang", "n_chars")), text)
    changed = F.coalesce(fold(F.col("doc_id"), 3) == 0, F.lit(False))
    now = F.when(changed, leaf(F.translate("text", UPPER, LOWER)))
    found = merkle_manifest(docs, leaf(F.col("text")), keep=("doc_id", now.alias("now")))
    found = found.withColumn("folded_root", folded(F.coalesce("now", "leaf"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("path")).cast("binary"), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def manifest_sql(levels: int = 8, top_levels: int = 4) -> str:
    """The query as SQL for up to 8 ** levels rows a language and 8 ** top_levels languages."""
    framing = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: f"sha256({' || '.join(map(framing, ('doc_id', 'source', 'lang', 'n_chars', text)))})"
    parts = [
        "crc AS (SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)",
        f"""d AS MATERIALIZED (SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g, {leaf('text')} AS h, CASE WHEN coalesce(
  xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0, false)
  THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {leaf('text')} END AS now FROM documents, crc)""",
        "a0 AS MATERIALIZED (SELECT doc_id, now, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n, h FROM d)",
    ]

    def tree(name: str, count: int) -> None:
        for k in range(count):
            parts.append(f"{name}{k + 1} AS MATERIALIZED (SELECT g, pos // 8 AS pos, (min(n) + 7) // 8 AS n, CASE WHEN min(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE min(h) END AS h FROM {name}{k} GROUP BY g, pos // 8)")
            parts.append(f"{name}s{k} AS MATERIALIZED (SELECT x.g, x.pos, x.n > 1 AS up, coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS l, coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS r FROM {name}{k} x JOIN {name}{k} y ON y.g = x.g AND y.pos // 8 = x.pos // 8 GROUP BY x.g, x.pos, x.n)")

    tree("a", levels)
    parts.append(f"b0 AS MATERIALIZED (SELECT '' AS g, g AS lang, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS n, h FROM a{levels})")
    tree("b", top_levels)
    parts.append(f"f0 AS (SELECT a0.*, a0.pos AS p, b0.pos AS q, b0.h AS subroot, b{top_levels}.h AS root, now AS f, '' AS proof FROM a0 JOIN b0 ON b0.lang = a0.g, b{top_levels})")
    steps = [("a", k, "f.g", "f.p") for k in range(levels)] + [("b", k, "''", "f.q") for k in range(top_levels)]
    for i, (name, k, g, pos) in enumerate(steps):
        parts.append(f"f{i + 1} AS (SELECT f.* REPLACE (CASE WHEN s.up THEN sha256(s.l || f.f || s.r) ELSE f.f END AS f, CASE WHEN s.up THEN f.proof || s.l || s.r ELSE f.proof END AS proof) FROM f{i} f JOIN {name}s{k} s ON s.g = {g} AND s.pos = {pos} // {8**k})")
    return "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, h AS leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM f{len(steps)}"


OP13_SQL = manifest_sql()
