"""The corpus pipeline: stages over ``documents`` that each call one operator of ``nightloom.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes each stage's rows as Parquet below the shared
folder and reads them again for the next one, so no stage is ever computed twice and a lost executor costs no more than the stage
at hand. All stages but the last return the columns they were given, in their order and whatever their names: those that a stage's operator does not read travel
in one struct beside it, so none meets a column that the operator makes. What an operator changes is ``text``, and ``n_chars`` with it.

Null and empty texts go with the first stage. Repeated rows are copies, of which one stays. Empty tables stay empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightloom.llm.common import checkpointed, fold, fresh, shared_folder, table
from nightloom.llm.decontaminate import find_benchmark
from nightloom.llm.langid import identify_language, train_prototypes
from nightloom.llm.mixing import mix_sources
from nightloom.llm.neardups import keep_one_of_each
from nightloom.llm.substrings import remove_repeats
from nightloom.operators.graph import remove

#: Cosine below which a long text resembles no language that was learned, and the length at which half of its square is asked. A text's cosine grows with the root of its share of
#: signal, n / (n + constant); random letters of a learned alphabet come to 0.12 at 2000 letters, other scripts to 0.03.
LEAST_SCORE, HALF_CHARS = 0.15, 160


def least_score(text: Column) -> Column:
    """The cosine asked of a text: it rises smoothly with its length, from almost none to ``LEAST_SCORE``."""
    n = F.char_length(text)
    return LEAST_SCORE * F.sqrt(n / (n + HALF_CHARS))


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


class Apart:
    """A table's columns that an operator reads, and the others in one struct."""

    def __init__(self, docs: DataFrame, *used: str):
        self.columns = docs.columns
        self.used = [c for c in docs.columns if c.lower() in used]
        self.rest = fresh(docs, "_rest")[0]
        rest = [c for c in docs.columns if c not in self.used]
        packed = [F.struct(*[quoted(c).alias(c) for c in rest]).alias(self.rest)] if rest else []
        self.narrow = docs.select(*[quoted(c) for c in self.used], *packed)

    def back(self, found: DataFrame, **changed: Column) -> DataFrame:
        """The table's columns again, some of those used ``changed``."""
        return found.select(*[(changed[c] if c in changed else quoted(c) if c in self.used else F.col(self.rest)[c]).alias(c) for c in self.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that resemble a learned language stay; null texts, texts without letters and others go."""
    apart = Apart(docs, "doc_id", "text")
    taught = docs.filter(~F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))).select("text", "lang")
    found = identify_language(apart.narrow, checkpointed(train_prototypes(taught)))
    return apart.back(found.filter((F.col("lang_pred") != "und") & (F.col("score") >= least_score(F.col("text")))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays. Null texts, if any, all stay."""
    apart = Apart(docs, "doc_id", "text")
    return apart.back(keep_one_of_each(apart.narrow))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages leave the texts; documents of nothing else go, untouched ones stay as they are."""
    apart = Apart(docs, "doc_id", "text", "n_chars")
    found = remove_repeats(apart.narrow).filter("n_removed < n_words or n_words = 0")
    cut = F.col("n_removed") > 0
    changed = {c: F.when(cut, F.col("kept_text") if c.lower() == "text" else F.char_length("kept_text")).otherwise(quoted(c)) for c in apart.used if c.lower() != "doc_id"}
    return apart.back(found, **{c: v if c.lower() == "text" else v.cast(dict(docs.dtypes)[c]) for c, v in changed.items()})


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    apart = Apart(docs, "doc_id", "text")
    return apart.back(find_benchmark(apart.narrow, table(spark, sf_dir, "benchmark")).filter(F.size("matches") == 0))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: how many copies of each document, and the words they make."""
    return mix_sources(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

#: SQL can't express the stages; ``tests/llm`` holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``. A stage's folder goes when the next one's rows are written; the last one's stays, as the result reads it."""
    docs, folder, before = table(spark, sf_dir, "documents"), shared_folder(spark), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before is not None:
            remove(spark, f"{folder}/{before}")
        before = name
    return docs
