"""N-gram Jaccard join with a MinHash LSH forest and exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightloom.operators.graph import connected_components

from .batches import RANGE_CHARS, U64, WORD_BASE, Texts, Words, digest_of, mixed, packed_texts, packed_values, tidied, tidied_pair, total_chars, unpacked_values
from .common import checkpointed, fresh, table
from .substrings import QUESTION, question, unique_pairs

#: Half the common batch: these workers hold signatures or windows besides.
BATCH_CHARS = 4 << 20
#: Texts of one block of a candidate component; larger components are verified block against block.
BLOCK = 1024
#: And bytes of shingle sets in it, 8 a shingle: sets of long texts make blocks of fewer texts.
BLOCK_BYTES = 16 << 20
#: A text at least this similar (estimated) to a leader is covered by it, a leader by another one at the second value; leaders are linked
#: to all texts down to the third.
COVER, SAME, LINK = 0.75, 0.9, 0.25
#: Join keys of texts with copies or links are spread over so many parts.
SALTS = 16


def prefix_length(trees: int, depth: int, similarity: float, target: float) -> int:
    """How far a text's matched prefixes are shortened: from the whole label down until a text of the given similarity
    shares one in some tree with the target probability."""
    for x in range(depth, 0, -1):
        if 1 - (1 - similarity**x) ** trees >= target:
            return x
    raise ValueError("too few trees for the target recall")


def least_similarity(n: int, threshold: float) -> float:
    """The least Jaccard similarity of ``threshold`` or more that a set of ``n`` elements can have with a different set (1: none can)."""
    fits = [common / union for common in range(max(1, int(threshold * n) - 1), n + 1) for union in range(n, int(common / threshold) + 2) if threshold - 1e-12 <= common / union < 1]
    return min(fits, default=1.0)


def shortest_prefixes(sizes: np.ndarray, trees: int, depth: int, threshold: float, target: float) -> np.ndarray:
    """The prefix length at which each text has reached the target, from the number of its shingles.

    Sets of a few shingles can't come close to the threshold (a different set is at most 4/5 or 5/6 of one of 5), so they stop at longer prefixes.
    """
    floor = prefix_length(trees, depth, threshold, target)
    out = np.full(len(sizes), floor, np.int8)
    for n in np.unique(sizes[sizes <= 64]).tolist():  # of larger sets some come within 1/64 of the threshold
        out[sizes == n] = prefix_length(trees, depth, least_similarity(n, threshold), target)
    return out


class Shingles:
    """Hashes of the runs of ``n`` words of each text; a shorter text is one run. Words are lower-cased."""

    def __init__(self, texts: list[bytes], n: int):
        w = Words([t.decode("utf-8", "replace").lower().encode() for t in texts])
        hashes = w.sequences(n, WORD_BASE)
        ok = w.left >= n
        for short in range(1, n):
            if (those := np.repeat(w.count == short, w.count) & (w.place == 0)).any():
                hashes[those] = w.sequences(short, WORD_BASE)[those]
                ok |= those
        self.text = np.repeat(np.arange(len(texts)), w.count)[ok]
        self.hash = hashes[ok]
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))

    def sets(self, wanted: np.ndarray) -> list[np.ndarray]:
        return [np.unique(self.hash[self.first[k] : self.first[k + 1]]) for k in wanted]


def signatures(shingles: Shingles, n_texts: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a shingle, and ``size`` minimum hashes of each (32 bits)."""
    there = np.flatnonzero(np.diff(shingles.first) > 0)
    starts = shingles.first[:-1][there]
    out = np.empty((len(there), size), np.uint32)
    if len(there):
        seeds = mixed(np.arange(1, 2 * size + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
        with np.errstate(over="ignore"):
            for k in range(size):
                low = np.minimum.reduceat((shingles.hash ^ seeds[2 * k]) * (seeds[2 * k + 1] | U64(1)), starts)
                out[:, k] = (mixed(low) >> U64(32)).astype(np.uint32)
    return there, out


class Labels:
    """The labels of texts in the trees, as rows of two sorted-trie keys: a hash of the shortest prefix in use, and what follows it."""

    def __init__(self, sig: np.ndarray, trees: int, depth: int, floor: int):
        labels = sig.reshape(len(sig), trees, depth).astype(U64)
        code = np.broadcast_to(np.arange(1, trees + 1, dtype=U64), labels.shape[:2]).copy()
        for k in range(floor):
            code = mixed(code * U64(0x9E3779B97F4A7C15) + labels[:, :, k])
        self.floor, self.depth, self.shape = floor, depth, code.shape
        self.bits = min(32, 64 // max(1, depth - floor))
        rest = np.zeros(code.shape, U64)
        for k in range(floor, depth):
            rest = rest << U64(self.bits) | labels[:, :, k] & U64((1 << self.bits) - 1)
        self.pairs = np.stack([code.ravel(), rest.ravel()], axis=1)
        self.unique, self.inverse, self.n = unique_pairs(self.pairs)

    def levels(self, asked: np.ndarray) -> np.ndarray:
        """The longest prefix of each text's label in each tree that another text shares, from what the ranges found (0: none in use)."""
        return np.where(self.n > 1, self.depth, asked)[self.inverse].reshape(self.shape)


def common_levels(pairs: np.ndarray, floor: int, depth: int) -> np.ndarray:
    """The longest prefix that each of the sorted labels shares with a neighbour, which is the longest that it shares with any; 0 under ``floor``."""
    bits = min(32, 64 // max(1, depth - floor))
    with_next = np.zeros(len(pairs) + 1, np.int8)  # of each label and the one before it
    if len(pairs) > 1:
        same = pairs[1:, 0] == pairs[:-1, 0]
        level = np.where(same, floor, 0)
        for k in range(floor, depth):
            shift = U64(bits * (depth - 1 - k))
            same = same & (pairs[1:, 1] >> shift == pairs[:-1, 1] >> shift)
            level = np.where(same, k + 1, level)
        with_next[1:-1] = level
    return np.maximum(with_next[:-1], with_next[1:])


def walk(rest: np.ndarray, digests: list[bytes], small: np.ndarray, shortest: np.ndarray, floor: int, depth: int) -> tuple[list[tuple[bytes, bytes]], list[int]]:
    """Edges of the texts under one trie node of length ``floor`` to leaders, and the leaders; ``rest`` has their labels from there on, sorted.

    Prefixes are shortened step by step, from whole labels to ``floor``. At each step the texts that still look for candidates lead one after the other: a
    leader is compared with all texts under its node, and linked down to ``LINK``. Texts that it covers have their
    candidates and look no further, like those whose own prefix length is reached; so only uncovered texts and leaders go on to shorter
    prefixes, where a leader stops at one that is all but the same. If two texts are similar, one of them covered by a leader, the other is still
    within ``LINK`` of that leader or of the one that stopped it, so both hang together. Only edges that join two parts are given: fewer than texts.
    """
    n = len(digests)
    edges: list[tuple[bytes, bytes]] = []
    part, open_, leads = np.arange(n), np.ones(n, bool), np.zeros(n, bool)
    bits = min(32, 64 // max(1, depth - floor))
    for level in range(depth, floor - 1, -1):
        code = rest >> U64(bits * (depth - level)) if bits * (depth - level) < 64 else np.zeros(n, U64)
        bounds = [0, *(np.flatnonzero(code[1:] != code[:-1]) + 1).tolist(), n]
        for a, z in zip(bounds, bounds[1:], strict=False):
            if z - a < 2:
                continue
            left = a + np.flatnonzero(open_[a:z] & (shortest[a:z] <= level))
            while len(left):
                k = int(left[0])
                leads[k] = True
                alike = (small[a:z] == small[k]).mean(axis=1)
                near = a + np.flatnonzero(alike >= LINK)
                parts, first = np.unique(part[near], return_index=True)
                other = parts != part[k]
                if other.any():
                    edges += [(digests[x], digests[k]) for x in near[first[other]].tolist()]
                    part[np.isin(part, parts)] = part[k]
                left = left[left != k]
                stop = alike[left - a] >= np.where(leads[left], SAME, COVER)
                open_[left[stop]] = False
                left = left[~stop]
    return edges, np.flatnonzero(open_ | leads).tolist()


EDGES = "kind int, bucket bigint, digest binary, other binary, small binary"


def link_buckets(rows: DataFrame, floor: int, depth: int, tasks: int) -> DataFrame:
    """Edges between the texts of each trie node of length ``floor`` (bucket, label, digest, small, shortest), node by node in sorted order.

    Rows are range-partitioned in the tries' order, so a node of any size is spread over tasks, where :func:`walk` goes up from whole
    labels; the leaders of nodes that may go on in the next task are linked among each other in a second step.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        first = True

        def emit(group: pd.DataFrame, edge_of_task: bool) -> list[tuple]:
            digests = list(group["digest"])
            if len(digests) < 2 and not edge_of_task:
                return []
            small = np.frombuffer(b"".join(group["small"]), np.uint8).reshape(len(digests), -1)
            rest = np.frombuffer(b"".join(group["label"]), ">u8").astype(U64)
            edges, leaders = walk(rest, digests, small, group["shortest"].to_numpy(), floor, depth)
            bucket = int(group["bucket"].iloc[0])
            out = [(0, bucket, a, b, None) for a, b in edges]
            if edge_of_task:
                out += [(1, bucket, digests[k], None, small[k].tobytes()) for k in leaders]
            return out

        for part in parts:
            part = part if held is None else pd.concat([held, part], ignore_index=True)
            cuts = np.flatnonzero(np.diff(part["bucket"].to_numpy()) != 0) + 1
            bounds = [0, *cuts.tolist()]
            out: list[tuple] = []
            for a, z in zip(bounds, bounds[1:], strict=False):
                if z - a > 1 or first:
                    out += emit(part.iloc[a:z], first)
                first = False
            held = part.iloc[bounds[-1] :]
            if out:
                yield pd.DataFrame(out, columns=["kind", "bucket", "digest", "other", "small"])
        if held is not None and len(held):
            yield pd.DataFrame(emit(held, True), columns=["kind", "bucket", "digest", "other", "small"])

    def across(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("digest").sort_values("digest")
        small = np.frombuffer(b"".join(pdf["small"]), np.uint8).reshape(len(pdf), -1)
        edges, _ = walk(np.zeros(len(pdf), U64), list(pdf["digest"]), small, np.zeros(len(pdf), np.int8), floor, floor)
        return pd.DataFrame(edges, columns=["u", "v"])

    spread = rows.repartitionByRange(tasks, "bucket", "label", "digest").sortWithinPartitions("bucket", "label", "digest")
    linked = checkpointed(spread.mapInPandas(run, EDGES))
    inside = linked.filter("kind = 0").select(F.col("digest").alias("u"), F.col("other").alias("v"))
    between = linked.filter("kind = 1").groupBy("bucket").applyInPandas(across, "u binary, v binary")
    return inside.union(between)


def similar_counts(sets: list[np.ndarray], threshold: float, split: int | None) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of each set, and enough of the linked pairs to keep linked sets together.

    With ``split`` only pairs of a set before and one from ``split`` on are taken. Intersections are counted by
    products of the incidence matrix over shingles that at least two sets have, some thousand columns at a time.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.float32)
    owner = np.repeat(np.arange(n), sizes.astype(np.int64))
    _, column, seen = np.unique(np.concatenate(sets) if n else np.empty(0, U64), return_inverse=True, return_counts=True)
    keep = seen[column] > 1
    owner, column = owner[keep], np.unique(column[keep], return_inverse=True)[1]
    n_left = n if split is None else split
    common = np.zeros((n_left, n if split is None else n - split), np.float32)
    width = max(256, min(4096, (8 << 20) // max(1, n)))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [a, a + width])
        m = np.zeros((n, width), np.float32)
        m[owner[lo:hi], column[lo:hi] - a] = 1
        common += m[:n_left] @ (m if split is None else m[split:]).T
    rest = sizes if split is None else sizes[split:]
    union = sizes[:n_left, None] + rest[None, :] - common
    linked = common >= np.float32(threshold) * union - 1e-3
    linked &= union > 0
    # exact at the border
    for i, j in np.argwhere(linked & (common < np.float32(threshold) * union + 1e-3)).tolist():
        linked[i, j] = round(float(common[i, j])) >= threshold * round(float(union[i, j])) - 1e-9
    if split is None:
        np.fill_diagonal(linked, False)
    links = np.zeros(n, np.int64)
    links[:n_left] += linked.sum(axis=1)
    if split is not None:
        links[split:] += linked.sum(axis=0)
    # breadth first over the matrix: one edge per newly reached set
    edges, offset = [], 0 if split is None else split
    parent = np.full(n, -1)
    for root in range(n):
        if parent[root] >= 0:
            continue
        parent[root], frontier = root, [root]
        while frontier:
            k = frontier.pop()
            near = np.flatnonzero(linked[k]) + offset if k < n_left else np.flatnonzero(linked[:, k - offset])
            for j in near[parent[near] < 0].tolist():
                parent[j] = root
                edges.append((j, root))
                frontier.append(j)
    return links, edges


def prefix_size(n: int, threshold: float) -> int:
    """How many of a sorted set's ``n`` elements come first: sets as similar as ``threshold`` have their least common element among those of both."""
    return n - math.ceil(threshold * n - 1e-9) + 1


def meeting_blocks(sets: DataFrame) -> DataFrame:
    """(component, a, b, block, digest, shingles): each set with its own block, and with each other block that has a set it can be linked to.

    Two linked sets share an element of both their prefixes (:func:`prefix_size`), so a set goes to the blocks where one of its own
    prefix's elements is in a prefix. Elements carry lists of blocks, never of sets, so an element that all sets share adds no rows.
    """
    first = sets.select("component", "digest", "block", F.explode("prefix").alias("element"))
    places = first.groupBy("component", "element").agg(F.collect_set("block").alias("places")).filter(F.size("places") > 1)
    # an element that a third of all sets have is met in as many places as there are salts
    salted = places.withColumn("salt", F.explode(F.array(*[F.lit(k) for k in range(SALTS)])))
    first = first.withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(SALTS)).cast("int"))
    met = first.join(salted, ["component", "element", "salt"]).groupBy("digest").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
    other = F.explode(F.array_union(F.array("block"), F.coalesce("places", F.array().cast("array<int>"))))
    found = sets.join(met, "digest", "left").select("component", "block", "digest", "shingles", other.alias("other"))
    return found.select("component", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "digest", "shingles")


def near_duplicate_texts(docs: DataFrame, text: str = "text", shingle: int = 5, threshold: float = 0.8, trees: int = 16, depth: int = 6, target: float = 0.999) -> DataFrame:
    """(digest, class_digest, n_links) of each distinct text that is similar to another one.

    A link joins two different texts whose sets of ``shingle``-word runs have a Jaccard similarity of ``threshold`` or
    more; ``n_links`` counts a text's links exactly within its candidate component, and classes are the components of links.

    Texts are packed into batches, as many copies of a text as there are counting as one. Each has a label of ``depth``
    minimum hashes in each of ``trees`` prefix trees. Batches send their labels to key ranges, where sorting them makes the tries:
    what a label shares with its neighbours is its longest matched prefix, and the ranges answer with that. Labels with a match become rows, in the
    tries' order, and each text's prefixes are shortened from the whole label on until it has its candidates or has reached
    the target recall (:func:`walk`, :func:`shortest_prefixes`). Candidate components then gather shingle sets and verify all their pairs, block
    against block where a component has more than ``BLOCK`` texts or ``BLOCK_BYTES`` of sets, and there only blocks that can hold links (:func:`meeting_blocks`); pairs never become rows.
    """
    chars = total_chars(docs, text)
    n_batches, n_ranges = -(-chars // BATCH_CHARS) or 1, -(-chars // RANGE_CHARS) or 1
    floor, size = prefix_length(trees, depth, threshold, target), trees * depth
    by_batch = packed_texts(docs, text, n_batches).groupBy("batch")

    def signed(blobs: list[bytes]) -> tuple[Texts, np.ndarray, np.ndarray, np.ndarray, Labels]:
        texts = Texts(blobs)
        shingles = Shingles(texts.texts, shingle)
        there, sig = signatures(shingles, len(texts.texts), size)
        sizes = np.diff(shingles.first)[there]
        few = np.flatnonzero(sizes <= 64)
        sizes[few] = [len(s) for s in shingles.sets(there[few])]
        return texts, there, sig, shortest_prefixes(sizes, trees, depth, threshold, target), Labels(sig, trees, depth, floor)

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        return question(int(pdf["batch"].iloc[0]), signed(list(pdf["blob"]))[4].unique, n_ranges)

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("batch")
        sent = [np.frombuffer(x, U64).reshape(-1, 2) for x in pdf["keys"]]
        rows = np.concatenate(sent)
        order = np.lexsort((rows[:, 1], rows[:, 0]))
        levels = np.empty(len(rows), np.int8)
        levels[order] = common_levels(rows[order], floor, depth)
        ends = np.cumsum([len(k) for k in sent]).tolist()
        return pd.DataFrame({"batch": pdf["batch"], "range": pdf["range"], "levels": [packed_values(levels[e - len(k) : e].astype(np.int64)) for k, e in zip(sent, ends, strict=True)]})

    def bucket_rows(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["bucket", "label", "digest", "small", "shortest"]
        if not len(left) or not len(right):
            return pd.DataFrame(columns=names)
        texts, there, sig, shortest, labels = signed(list(left["blob"]))
        levels = labels.levels(np.concatenate([unpacked_values(x, np.int8) for x in right.sort_values("range")["levels"]]))
        pairs = labels.pairs.reshape(*labels.shape, 2)
        out = []
        for i, t in np.argwhere(levels >= shortest[:, None]).tolist():
            out.append((pairs[i, t, 0].astype(np.int64), int(pairs[i, t, 1]).to_bytes(8, "big"), texts.digests[there[i]], sig[i].astype(np.uint8).tobytes(), int(shortest[i])))
        return pd.DataFrame(out, columns=names)

    matched = by_batch.applyInPandas(tidied(ask), QUESTION).groupBy("range").applyInPandas(tidied(match), "batch bigint, range bigint, levels binary")
    rows = by_batch.cogroup(matched.groupBy("batch")).applyInPandas(tidied_pair(bucket_rows), "bucket bigint, label binary, digest binary, small binary, shortest int")
    candidates = checkpointed(connected_components(link_buckets(rows, floor, depth, n_ranges)))

    def add_batch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            part["batch"] = [int.from_bytes(d[:8], "little") % n_batches for d in part["node"]]
            yield part

    members = candidates.select("node", "component").mapInPandas(add_batch, "node binary, component binary, batch bigint")

    def shingle_rows(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame(columns=["component", "digest", "shingles"])
        texts = Texts(list(left["blob"]))
        place = {d: k for k, d in enumerate(texts.digests)}
        wanted = np.array([place[bytes(d)] for d in right["node"]])
        sets = Shingles([texts.texts[k] for k in wanted], shingle).sets(np.arange(len(wanted)))
        return pd.DataFrame({"component": right["component"], "digest": right["node"], "shingles": [x.tobytes() for x in sets]})

    def add_prefix(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            sets = [np.frombuffer(x, U64) for x in part["shingles"]]
            part["prefix"] = [x[: prefix_size(len(x), threshold)].astype(np.int64).tolist() for x in sets]
            yield part

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["block", "digest"])
        digests = list(pdf["digest"])
        split = None if pdf["a"].iloc[0] == pdf["b"].iloc[0] else int((pdf["block"] == pdf["a"]).sum())
        links, edges = similar_counts([np.frombuffer(x, U64) for x in pdf["shingles"]], threshold, split)
        root = list(range(len(digests)))
        for j, r in edges:
            root[j] = r
        return pd.DataFrame({"digest": digests, "links": links, "root": [digests[r] for r in root]})

    gathered = checkpointed(by_batch.cogroup(members.groupBy("batch")).applyInPandas(tidied_pair(shingle_rows), "component binary, digest binary, shingles binary"))
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(F.octet_length("shingles")) / BLOCK_BYTES)).cast("int")
    large = checkpointed(gathered.groupBy("component").agg(blocks.alias("blocks")).filter("blocks > 1"))  # a row per large component
    alone = lambda sets: sets.select("component", F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("block"), "digest", "shingles")
    if large.isEmpty():
        paired = alone(gathered)
    else:
        sets = gathered.join(large, "component").select("component", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int").alias("block"), "digest", "shingles")
        sets = checkpointed(sets.mapInPandas(add_prefix, "component binary, block int, digest binary, shingles binary, prefix array<bigint>"))
        paired = alone(gathered.join(large, "component", "left_anti")).unionByName(meeting_blocks(sets))
    verified = checkpointed(paired.groupBy("component", "a", "b").applyInPandas(verify, "digest binary, links bigint, root binary"))
    classes = connected_components(verified.filter("links > 0 and digest <> root"), "digest", "root")
    counted = verified.groupBy("digest").agg(F.sum("links").alias("n_links")).filter("n_links > 0")
    return counted.join(classes.select(F.col("node").alias("digest"), F.col("component").alias("class_digest")), "digest", "left").select("digest", F.coalesce("class_digest", "digest").alias("class_digest"), "n_links")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, digest, class_id, n_links and n_copies for every row.

    ``class_id`` is the smallest doc_id among the rows whose texts hang together by links (``near_duplicate_texts``) or are the same;
    ``n_links`` counts the different texts similar to this one, ``n_copies`` the rows with this very text. Texts
    without a word are only ever copies of each other. A null text is a class of its own with its own id. Repeated rows are copies. Empty
    tables give empty results. Joins are on digests; where many rows share one, adaptive execution splits the join.
    """
    found = checkpointed(near_duplicate_texts(docs, text, **options))
    rows = docs.select(F.col(doc_id).alias("doc_id"), digest_of(F.col(text)).alias("digest"))
    texts = rows.filter("digest is not null").groupBy("digest").agg(F.count("*").alias("n_copies"), F.min("doc_id").alias("_first"))
    texts = texts.join(found, "digest", "left").withColumn("_class", F.coalesce("class_digest", "digest"))
    classes = texts.filter("class_digest is not null").groupBy("_class").agg(F.min("_first").alias("class_id"))
    # texts without copies and links need no answer: they are classes of their own
    known = texts.filter("n_copies > 1 or class_digest is not null").join(classes, "_class", "left")
    known = known.select("digest", F.coalesce("class_id", "_first").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies", F.lit(True).alias("_known"))
    # a text that a third of all rows have is met in as many places as there are salts
    salted = known.withColumn("_salt", F.explode(F.array(*[F.lit(k) for k in range(SALTS)])))
    joined = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted, ["digest", "_salt"], "left")
    return joined.select("doc_id", "digest", F.when(F.col("_known"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"))


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the row with the smallest id stays (of equal rows
    one). Rows with a null text or a class without any id all stay."""
    id_, digest, key = fresh(docs, "_id", "_digest", "_key")
    marked = near_duplicates(docs, doc_id, text, **options)
    stay = marked.filter("digest is not null and (class_id is null or doc_id = class_id)").select(F.col("doc_id").alias(id_), F.col("digest").alias(digest)).distinct()
    keyed = docs.withColumn(key, digest_of(F.col(text)))
    same = (F.col(key) == F.col(digest)) & F.col(doc_id).eqNullSafe(F.col(id_))
    kept = keyed.join(stay, same, "left_semi").dropDuplicates([key, doc_id])
    return kept.drop(key).unionByName(docs.filter(F.col(text).isNull()))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of the class), n_links (different texts similar to this one), n_copies (rows with this very text)."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("digest")


OP7_SQL = r"""
WITH RECURSIVE t AS MATERIALIZED (SELECT row_number() OVER (ORDER BY text) AS t, text, min(doc_id) AS first_id, count(*) AS n_copies FROM documents WHERE text IS NOT NULL GROUP BY text),
w AS (SELECT t, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS ws FROM t),
s AS MATERIALIZED (SELECT DISTINCT t, hash(array_to_string(ws[i:i + 4], ' ')) AS h FROM (SELECT t, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0) x),
n AS MATERIALIZED (SELECT t, count(*) AS n FROM s GROUP BY t),
p AS (SELECT a.t AS a, b.t AS b, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.t < b.t GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.t = a JOIN n y ON y.t = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT t, t FROM t UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
k AS (SELECT r.a AS t, min(first_id) AS class_id FROM r JOIN t ON t.t = r.b GROUP BY r.a),
m AS (SELECT a AS t, count(*) AS n_links FROM e GROUP BY a)
SELECT doc_id, CASE WHEN t.t IS NULL THEN doc_id ELSE class_id END AS class_id, coalesce(n_links, 0) AS n_links, coalesce(n_copies, 1) AS n_copies
FROM documents d LEFT JOIN t ON t.text = d.text LEFT JOIN k ON k.t = t.t LEFT JOIN m ON m.t = t.t
"""
