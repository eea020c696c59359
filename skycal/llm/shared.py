"""Helpers of the operators in this folder: tables, stored steps, spans, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skycal.operators.materialize import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Store:
    """Intermediate tables of one run in the cluster's shared folder: each is written once, read back,
    and can be dropped as soon as what was made from it is stored. A lost executor costs a re-read."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        root = shared_folder(spark).rstrip("/")
        self.folder = f"{root}/skycal-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(conf).delete(path, True)


def components(edges: DataFrame, store: Store) -> DataFrame:
    """Connected components of the undirected edges (a, b): one row (node, component) per node that has
    an edge to another, component being the smallest node of it.

    Alternating large-star and small-star steps (Kiveris et al., 2014). Each step is a grouped minimum and
    a join; the edges of a busy node are reduced before they move and never gathered into one place."""
    small = store.put(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star-0")
    seen, step = None, 0
    while True:
        both = small.union(small.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        roots = large.groupBy("a").agg(F.min("b").alias("m"))
        step += 1
        small = store.put(
            large.join(roots, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(roots.select("a", F.col("m").alias("b"))).distinct(), f"star-{step}")
        state = small.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        store.drop(f"star-{step - 1}")
        if state == seen:
            break
        seen = state
    return small.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        small.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
