"""Removal of repeated word sequences with difference-cover anchors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import RANGE_CHARS, SECOND_BASE, U64, WORD_BASE, Texts, Words, contains, digest_of, packed_texts, split_by_range, tidied, tidied_pair, total_chars
from .common import fresh, others, table

#: Half the common batch: these workers hold windows besides.
BATCH_CHARS = 4 << 20
#: Perfect difference sets. Every difference modulo the period is one between two of the positions.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
ANSWER = "batch bigint, stage int, keys binary"
QUESTION = "range bigint, batch bigint, keys binary"


def cover_for(window: int) -> int:
    """The longest period that leaves anchors of at least two fifths of the window (at least one word)."""
    return max((p for p in COVERS if window - p + 1 >= max(1, window * 2 // 5)), default=1)


class Repeats:
    """One batch's anchors, candidate windows and repeated windows, from its texts and the answers so far."""

    def __init__(self, blobs: list[bytes], window: int):
        self.texts = Texts(blobs)
        self.words = Words(self.texts.texts, twice=True)
        self.window = window
        w = self.words
        self.copied = np.repeat(self.texts.rows > 1, w.count)  # whole text occurs again
        period = cover_for(window)
        self.reach = period - 1
        self.anchor_words = window - self.reach
        at_cover = np.zeros(period, bool)
        at_cover[list(COVERS.get(period, (0,)))] = True
        # a text shorter than a window has none, and needs no anchors
        long_text = np.repeat(w.count >= window, w.count)
        self.anchors = np.flatnonzero(at_cover[w.place % period] & (w.left >= self.anchor_words) & long_text)
        self.anchor_keys = w.sequences(self.anchor_words, WORD_BASE)[self.anchors]

    def anchor_question(self) -> np.ndarray:
        return np.unique(self.anchor_keys)

    def candidates(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of windows that hold a repeated anchor, and their 128-bit keys as two columns.

        Two equal windows hold, by the cover's property, an anchor at the same offset in both; extending each
        repeated anchor by up to the period to the left reaches every such window.
        """
        w = self.words
        keys, inverse, n = np.unique(self.anchor_keys, return_inverse=True, return_counts=True)
        repeated = self.anchors[((n > 1) | contains(known, keys))[inverse] | self.copied[self.anchors]]
        mark = np.zeros(len(w.hash) + 1, np.int32)
        text_first = repeated - w.place[repeated]
        last = text_first + (w.left[repeated] + w.place[repeated]) - self.window
        a, z = np.maximum(text_first, repeated - self.reach), np.minimum(repeated, last) + 1
        ok = z > a
        np.add.at(mark, a[ok], 1)
        np.add.at(mark, z[ok], -1)
        starts = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
        pair = np.stack([w.sequences(self.window, WORD_BASE)[starts], w.sequences(self.window, SECOND_BASE, second=True)[starts]], axis=1)
        return starts, pair

    def removed(self, known: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Whether each word is covered by a window that starts anywhere else too."""
        starts, pair = self.candidates(known)
        twice = self.copied[starts].copy()
        if len(starts):
            unique, inverse, n = unique_pairs(pair)
            twice |= ((n > 1) | pairs_among(windows, unique))[inverse]
        mark = np.zeros(len(self.words.hash) + 1, np.int32)
        np.add.at(mark, starts[twice], 1)
        np.add.at(mark, starts[twice] + self.window, -1)
        return np.cumsum(mark[:-1]) > 0

    def rows(self, gone: np.ndarray) -> pd.DataFrame:
        w, out = self.words, []
        for k, digest in enumerate(self.texts.digests):
            a, z = w.first[k], w.first[k + 1]
            drop = gone[a:z]
            kept = None
            n = int(drop.sum())
            if n < z - a:
                kept = b" ".join([w.data[s:e] for s, e in zip(w.start[a:z][~drop].tolist(), w.end[a:z][~drop].tolist(), strict=True)])
            out.append((digest, int(z - a), n, (kept or b"").decode("utf-8", "replace")))
        return pd.DataFrame(out, columns=["digest", "n_words", "n_removed", "kept_text"])


def unique_pairs(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows of a two-column array in order, the place of each row among them, and their numbers."""
    order = np.lexsort((pair[:, 1], pair[:, 0]))
    s = pair[order]
    fresh = np.ones(len(s), bool)
    fresh[1:] = (s[1:] != s[:-1]).any(axis=1)
    group = np.cumsum(fresh) - 1
    inverse = np.empty(len(s), np.int64)
    inverse[order] = group
    return s[fresh], inverse, np.bincount(group) if len(s) else np.empty(0, np.int64)


def pairs_among(known: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Whether each of the distinct rows of ``pair`` is a row of ``known``."""
    if not len(known) or not len(pair):
        return np.zeros(len(pair), bool)
    _, inverse, n = unique_pairs(np.concatenate([unique_pairs(known)[0], pair]))
    return n[inverse[len(inverse) - len(pair) :]] > 1


def question(batch: int, keys: np.ndarray, n_ranges: int) -> pd.DataFrame:
    """One row per range with the sorted keys (one or two columns) that fall in it."""
    first = keys if keys.ndim == 1 else keys[:, 0]
    parts = split_by_range(first, n_ranges) if len(first) else []
    return pd.DataFrame({"range": [r for r, _, _ in parts], "batch": [batch] * len(parts), "keys": [keys[a:z].tobytes() for _, a, z in parts]})


def answered(pdf: pd.DataFrame, stage: int) -> np.ndarray:
    """The keys that the ranges sent back for one stage, sorted where they are single."""
    return np.frombuffer(b"".join(pdf["keys"][pdf["stage"] == stage]), U64)


def batch_of(left: pd.DataFrame, right: pd.DataFrame) -> int:
    return int((left if len(left) else right)["batch"].iloc[0])


def repeated_keys(questions: DataFrame, stage: int, columns: int) -> DataFrame:
    """Tell each batch which of its keys other batches have too (each batch sends a key once)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("batch")
        sent = [np.frombuffer(x, U64).reshape(-1, columns) for x in pdf["keys"]]
        rows = np.concatenate(sent)
        if columns == 1:
            _, inverse, n = np.unique(rows[:, 0], return_inverse=True, return_counts=True)
        else:
            _, inverse, n = unique_pairs(rows)
        shared, at, out = n[inverse] > 1, 0, []
        for batch, keys in zip(pdf["batch"], sent, strict=True):
            mine = keys[shared[at : at + len(keys)]]
            at += len(keys)
            if len(mine):
                out.append((batch, stage, mine.tobytes()))
        return pd.DataFrame(out, columns=["batch", "stage", "keys"])

    return questions.groupBy("range").applyInPandas(tidied(run), ANSWER)


def repeated_words(docs: DataFrame, text: str = "text", window: int = 35) -> DataFrame:
    """One row per distinct non-null text: digest, n_words, n_removed, kept_text.

    A word is removed if a window of ``window`` words that covers it starts anywhere else too, in this text, in another or in a copy
    of this one. Windows are judged on the input. ``kept_text`` has the other words joined by one space.

    Texts are packed into batches (:mod:`batches`). Batches ask about their anchors (``window`` less the period
    plus one words, at cover positions only), extend repeated anchors to candidate windows, and ask about those by 128-bit
    hashes, each half made of other hashes of the words. Exact copies meet in one batch and travel once per task. The packed texts are shuffled once; the later steps reuse that exchange.
    """
    chars = total_chars(docs, text)
    n_batches, n_ranges = -(-chars // BATCH_CHARS) or 1, -(-chars // RANGE_CHARS) or 1
    packed = packed_texts(docs, text, n_batches)

    def anchors(pdf: pd.DataFrame) -> pd.DataFrame:
        return question(int(pdf["batch"].iloc[0]), Repeats(list(pdf["blob"]), window).anchor_question(), n_ranges)

    def windows(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        repeats = Repeats(list(left["blob"]), window)
        _, pair = repeats.candidates(np.sort(answered(right, 1)))
        return question(batch_of(left, right), unique_pairs(pair)[0] if len(pair) else pair, n_ranges)

    def result(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        repeats = Repeats(list(left["blob"]), window)
        return repeats.rows(repeats.removed(np.sort(answered(right, 1)), answered(right, 2).reshape(-1, 2)))

    by_batch = packed.groupBy("batch")
    first = repeated_keys(by_batch.applyInPandas(tidied(anchors), QUESTION), 1, 1)
    second = repeated_keys(by_batch.cogroup(first.groupBy("batch")).applyInPandas(tidied_pair(windows), QUESTION), 2, 2)
    answers = first.unionByName(second)
    return by_batch.cogroup(answers.groupBy("batch")).applyInPandas(tidied_pair(result), "digest binary, n_words bigint, n_removed bigint, kept_text string")


def remove_repeats(docs: DataFrame, text: str = "text", window: int = 35) -> DataFrame:
    """All rows of ``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` (columns of these names are replaced).

    Null texts have no words and a null ``kept_text``. Repeated rows are copies of each other. Empty tables give empty results. A text longer than a batch is a batch of its own,
    so the longest one bounds a task's memory.
    """
    names = others(docs, ("n_words", "n_removed", "kept_text"))
    digest, words, gone, kept = fresh(docs, "_digest", "_words", "_gone", "_kept")
    keyed = docs.select(*[F.col(f"`{c}`") for c in names], digest_of(F.col(text)).alias(digest))
    found = repeated_words(docs, text, window).toDF(digest, words, gone, kept)
    zero = lambda c, name: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(name)
    new = [zero(words, "n_words"), zero(gone, "n_removed"), F.col(kept).alias("kept_text")]
    return keyed.join(found, digest, "left").select(*[F.col(f"`{c}`") for c in names], *new)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = repeated_words(docs).select("digest", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
    keyed = docs.select("doc_id", digest_of(F.col("text")).alias("digest"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return keyed.join(found, "digest", "left").select("doc_id", zero("n_words"), zero("n_removed"), F.coalesce("kept_sha256", F.sha2(F.lit(""), 256)).alias("kept_sha256"))


OP6_SQL = r"""
WITH w AS MATERIALIZED (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT rn, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM (SELECT rn, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35) x),
d AS (SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY h) AS c FROM s) x WHERE c > 1),
g AS MATERIALIZED (SELECT DISTINCT rn, unnest(range(i, i + 35)) AS p FROM d),
n AS (SELECT rn, count(*) AS n_removed FROM g GROUP BY rn),
k AS (SELECT rn, string_agg(word, ' ' ORDER BY p) AS t FROM (SELECT rn, unnest(ws) AS word, CAST(generate_subscripts(ws, 1) AS BIGINT) AS p FROM w) x ANTI JOIN g USING (rn, p) GROUP BY rn)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN n USING (rn) LEFT JOIN k USING (rn)
"""
