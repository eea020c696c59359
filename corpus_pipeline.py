"""A document corpus made ready for training: each stage works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skycal.llm import decontamination, packing, quality, simhash, substrings
from skycal.llm.shared import Store, table

REPEAT_BYTES = 300     # a passage of so many bytes, or
REPEAT_WORDS = 51      # of so many words, in however few bytes


def _rows(docs: DataFrame) -> Column:
    """All columns as one, so that none of them can have the name of a column that a stage adds."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject. Null and empty texts are scored like others; repeated
    rows share their fate."""
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of linked fingerprints: the one with the smallest id, and of its texts, if there are
    several, that with the smallest hash. Documents without an id come after all others. Of rows equal in id and text
    that stays whose other columns come first as JSON. Null and empty texts are one group."""
    others = F.to_json(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]))
    keys = docs.select(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64("text").alias("h")).alias("key"),
                       F.col("text").alias("content"), _rows(docs), others.alias("others"))
    found = simhash.near_duplicates(keys, id_col="key", text_col="content")
    first = found.where("key = component").select("key").distinct()
    return keys.join(first, "key", "left_semi").groupBy("key").agg(F.min_by("row", "others").alias("row")).select("row.*")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the passages of REPEAT_BYTES, or of REPEAT_WORDS in fewer bytes, that occur twice; n_chars is counted
    anew. Odd rows as in substrings.cleaned."""
    return substrings.cleaned(docs, REPEAT_BYTES, REPEAT_WORDS).withColumn("n_chars", F.length("text").cast("bigint"))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold or paraphrase no benchmark item. Equal texts share their fate, so ids may repeat or lack;
    null and empty texts stay."""
    leaks = decontamination.contaminated(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return docs.select(F.xxhash64("text").alias("h"), _rows(docs)).join(leaks.select("h").distinct(), "h", "left_anti").select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 1024 tokens. A null or empty text is a piece of its end id alone."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality), ("near-copies", one_of_near_copies), ("repeats", without_repeats), ("benchmarks", without_benchmarks), ("packing", packed)]

#: The stages train models, sort suffixes and decompose matrices, none of which SQL expresses.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is stored and read again as the next one's input."""
    store, docs = Store(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = store.put(stage(spark, docs, sf_dir), f"{k}-{name}")
    return docs
