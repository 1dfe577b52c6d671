"""Language identification with hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_columns, checkpointed, fold, fresh, others, table

#: Bits of a unit vector's fixed-point entries, so that sums do not depend on their order.
FIXED = 20
#: Prototypes that tasks hold at a time; more labels are compared in as many passes as it takes.
BLOCK_LABELS = 4096
#: Letters whose vectors a task keeps; beyond them it begins anew before the next text.
MOST_LETTERS = 8192


class Encoder:
    """Document vectors: a random +-1 vector per letter, n-grams bound by permuted products, documents as bundles.

    The vector of trigram abc is roll(a, 2) * roll(b, 1) * c; letters' vectors come from their code point
    alone, so all tasks have the same. Runs of other characters count as one boundary letter, row 0. Bound
    vectors of trigrams of the first 128 letters seen are kept up to ``cached``; others are bound when they come.
    """

    def __init__(self, dimensions: int, seed: int, cached: int = 16_384):
        self.dimensions, self.seed = dimensions, seed
        self.bound = np.empty((cached, dimensions), np.float32)
        self._begin()

    def _begin(self) -> None:
        self.rows = np.full(0x110000, -1, np.int32)  # of each code point
        self.letters = [np.empty((0, self.dimensions), np.int8) for _ in range(3)]
        self._learn([32])
        self.gram, self.n_bound = np.full(1 << 21, -1, np.int32), 0  # place of each kept trigram

    def _learn(self, points: list[int]) -> None:
        letters = [p for p in points if p == 32 or chr(p).isalpha()]
        fresh = np.array([np.random.default_rng([self.seed, p]).integers(0, 2, self.dimensions) * 2 - 1 for p in letters], np.int8).reshape(-1, self.dimensions)
        self.rows[points] = 0
        self.rows[letters] = np.arange(len(letters)) + len(self.letters[0])
        self.letters = [np.concatenate([old, np.roll(fresh, 2 - k, axis=1)]) for k, old in enumerate(self.letters)]

    def _bind(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        return (self.letters[0][a] * self.letters[1][b] * self.letters[2][c]).astype(np.float32)

    def _bundle(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Sum of the trigrams' vectors, bound anew."""
        grams, counts = np.unique(a.astype(np.int64) << 40 | b.astype(np.int64) << 20 | c, return_counts=True)
        total = np.zeros(self.dimensions, np.float32)
        for k in range(0, len(grams), 2048):
            g = grams[k : k + 2048]
            total += counts[k : k + 2048].astype(np.float32) @ self._bind(g >> 40, g >> 20 & 0xFFFFF, g & 0xFFFFF)
        return total

    def vector(self, text: str | None) -> np.ndarray | None:
        """The unit vector of a whole text, or None if it has no letter."""
        if not text:
            return None
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(self.letters[0]) > MOST_LETTERS:
            self._begin()
        rows = self.rows[points]
        if (rows < 0).any():
            self._learn(np.unique(points[rows < 0]).tolist())
            rows = self.rows[points]
        letter = rows > 0
        if not letter.any():
            return None
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # the first boundary after a letter
        rows = np.concatenate([[0], rows[keep], [0]])
        a, b, c = rows[:-2], rows[1:-1], rows[2:]
        small = (rows < 128).all()
        if small:
            ids = self.gram[a << 14 | b << 7 | c]
            if (ids < 0).any() and (room := len(self.bound) - self.n_bound):
                new = np.unique((a << 14 | b << 7 | c)[ids < 0])[:room]
                self.gram[new] = np.arange(len(new)) + self.n_bound
                self.bound[self.n_bound : self.n_bound + len(new)] = self._bind(new >> 14, new >> 7 & 127, new & 127)
                self.n_bound += len(new)
                ids = self.gram[a << 14 | b << 7 | c]
            known = ids >= 0
            counts = np.bincount(ids[known])
            total = np.zeros(self.dimensions, np.float32)
            there = counts.nonzero()[0]
            for k in range(0, len(there), 2048):
                part = there[k : k + 2048]
                total += counts[part].astype(np.float32) @ self.bound[part]
            if not known.all():
                total += self._bundle(a[~known], b[~known], c[~known])
        else:
            total = self._bundle(a, b, c)
        norm = float(np.sqrt(np.dot(total.astype(np.float64), total.astype(np.float64))))
        return total / norm if norm else None


def train_prototypes(labelled: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = 1024, seed: int = 11) -> DataFrame:
    """One row per language: lang, prototype (array of bigint), the sum of its documents' unit vectors.

    Bundling is linear, so each task sums the vectors it sees and returns one vector per language; those
    are added up by Spark. Rows with null text, text without a letter or null lang teach nothing. What each task returns
    is languages times dimensions, whatever the input's size.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, sums = Encoder(dimensions, seed), {}
        for batch in batches:
            for t, label in zip(batch["t"], batch["l"], strict=True):
                if isinstance(label, str) and (v := encoder.vector(t if isinstance(t, str) else None)) is not None:
                    fixed = np.rint(v * (1 << FIXED)).astype(np.int64)
                    sums[label] = sums[label] + fixed if label in sums else fixed
        for label, v in sums.items():
            yield pd.DataFrame({"lang": label, "k": np.arange(dimensions, dtype=np.int32), "v": v})

    parts = labelled.select(F.col(text).alias("t"), F.col(lang).alias("l")).filter("t is not null and l is not null").mapInPandas(run, "lang string, k int, v bigint")
    summed = parts.groupBy("lang", "k").agg(F.sum("v").alias("v"))
    return summed.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))), lambda x: x["v"]).alias("prototype"))


def identify_language(docs: DataFrame, prototypes: DataFrame, text: str = "text", seed: int = 11) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row.

    ``lang_pred`` is the language whose prototype has the largest cosine with the whole text's vector (ties: the
    first in code point order), ``score`` that cosine, 0 at least. Null texts, texts without a letter and any
    text when nothing was learned get ``und`` and 0. All rows and columns stay, repeated rows alike, and empty tables stay empty; columns of these names are replaced. Texts of any length are read whole.

    Prototypes are compared in blocks of ``BLOCK_LABELS``: each block is broadcast and all texts run past it. If there is more than one, a
    block's best label so far is written before the next one is read, so neither a task nor the driver ever holds more than one.
    """
    n_blocks = -(-prototypes.count() // BLOCK_LABELS) or 1
    if n_blocks == 1:
        return nearest_labels(docs, prototypes, text, seed, "lang_pred", "score")
    kept = others(docs, ("lang_pred", "score"))
    source, lang, score, new_lang, new_score = fresh(docs, "_text", "_lang", "_score", "_new", "_new_score")
    best = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias(source), F.lit("und").alias(lang), F.lit(0.0).alias(score))
    for block in range(n_blocks):
        one = prototypes.filter(F.pmod(F.xxhash64("lang"), F.lit(n_blocks)) == block)
        found = nearest_labels(best, one, source, seed, new_lang, new_score)
        better = (F.col(new_lang) != "und") & ((F.col(lang) == "und") | (F.col(new_score) > F.col(score)) | ((F.col(new_score) == F.col(score)) & (F.col(new_lang) < F.col(lang))))
        new = [F.when(better, F.col(n)).otherwise(F.col(o)).alias(o) for n, o in ((new_lang, lang), (new_score, score))]
        best = checkpointed(found.select(*[F.col(f"`{c}`") for c in kept], source, *new))
    return best.select(*[F.col(f"`{c}`") for c in kept], F.col(lang).alias("lang_pred"), F.col(score).alias("score"))


def nearest_labels(docs: DataFrame, prototypes: DataFrame, text: str, seed: int, lang: str, score: str) -> DataFrame:
    """Add the label of the largest cosine and that cosine, over prototypes that fit into a task."""
    known = prototypes.orderBy("lang").collect()  # one block, one vector a language
    names = [r["lang"] for r in known]
    matrix = np.array([r["prototype"] for r in known], np.float64)
    if len(known):
        matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
    shared = docs.sparkSession.sparkContext.broadcast(matrix.astype(np.float32))

    def start():
        profiles = shared.value
        encoder = Encoder(profiles.shape[1], seed) if len(names) else None

        def compute(texts: list) -> list[list]:
            found = []
            for t in texts:
                v = encoder.vector(t) if encoder else None
                if v is None:
                    found.append(("und", 0.0))
                else:
                    cosines = np.clip((profiles @ v).astype(np.float64), 0, 1).round(6)
                    best = int(np.argmax(cosines))
                    found.append((names[best], float(cosines[best])))
            return [[x for x, _ in found], [x for _, x in found]]

        return compute

    return add_columns(docs, text, f"`{lang}` string, `{score}` double", start)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    prototypes = checkpointed(train_prototypes(docs.filter(~F.coalesce(held_out, F.lit(False))).select("text", "lang")))
    return identify_language(docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out")), prototypes).select("doc_id", "held_out", "lang_pred", "score")
