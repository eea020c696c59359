"""Near-duplicate documents by SimHash, with deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skycal.llm.shared import Store, components

SEED = 42
CHUNK = 1 << 20      # bytes of a text whose words are held as objects at once
DISTANCE = 3         # bits; two halves of 32 bits, so that one of them differs in at most one bit


def _word_chunks(text: bytes) -> Iterator[list[bytes]]:
    at = 0
    while at < len(text):
        end = at + CHUNK
        while end < len(text) and text[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield text[at:end].split()
        at = end


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """64-bit SimHash: bit k is set if it is set in over half of the XXH64 values of the word shingles.
    Words are separated by ASCII white space, A-Z is lowered; repeats count. Fewer words than width form
    one shingle; no words give 0."""
    ones, total, carried, h = np.zeros(64, dtype=np.int64), 0, [], xxhash.xxh64_intdigest
    for words in _word_chunks((text or b"").lower()):
        words = carried + words
        if len(words) >= width:
            joined = b" ".join(words)
            sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            ends = np.cumsum(sizes) + np.arange(len(words))
            starts = (ends - sizes)[: len(words) - width + 1].tolist()
            values = np.array([h(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1:].tolist())], dtype="<u8")
            ones += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(values)
            carried = words[len(words) - width + 1:]
        else:
            carried = words
    if not total and carried:
        values = np.array([h(b" ".join(carried), SEED)], dtype="<u8")
        ones, total = np.unpackbits(values.view(np.uint8), bitorder="little").astype(np.int64), 1
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint as a signed long) of every document; null texts count as empty."""

    def run(batches):
        for batch in batches:
            values = [fingerprint(t, width) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], names=[id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("binary").alias("_text")).mapInArrow(run, f"`{id_col}` {kind}, fp bigint")


def links(prints: DataFrame, store: Store) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) whose components are those of the graph that
    links all fingerprints at DISTANCE bits or fewer.

    Neighbours at one bit come first, by an equality join with the 64 flips: at most 64 edges each. Every
    print takes the smallest print around it as leader. Pairs at two or three bits are found by halves: of
    two such prints one half is equal or differs in one bit, so it shares the half itself or one of its 32
    one-wildcard variants. A variant is indexed on one side where the bit is 0 and on the other where it
    is 1, so a pair meets once per half. The join verifies the distance and passes over pairs that have
    the same leader, which the edges to leaders connect already. Both sides hold some 34 rows for each print,
    which Spark sizes as one, so neither is left to be sent to the driver."""
    one = lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"), k)
    flips = prints.select("fp", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(63)), lambda k: F.col("fp").bitwiseXOR(one(k)))).alias("other"))
    near = flips.join(prints.select(F.col("fp").alias("other")), "other")
    led = store.put(
        prints.join(near.groupBy("fp").agg(F.min("other").alias("m")), "fp", "left")
        .select("fp", F.least("fp", F.coalesce("m", "fp")).alias("leader")), "led")

    def half_keys(h: int, bit: int) -> list:
        whole = F.call_function("shiftrightunsigned", F.col("fp"), F.lit(32 * h)).bitwiseAND(F.lit(0xFFFFFFFF))
        tag = lambda k: (F.lit(33 * h).cast("bigint") + k) * F.lit(1 << 32)
        held = lambda k: one(k) if bit else F.lit(0)
        own = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda k: whole.bitwiseAND(one(k)) == held(k))
        return [F.transform(own, lambda k: tag(k) + whole - held(k)), F.array(tag(F.lit(32)) + whole)]

    def variants(bit: int) -> DataFrame:
        """Rows (key, fp, leader): exact halves, and halves with the bit at each place that holds `bit` removed."""
        keys = half_keys(0, bit) + half_keys(1, bit)
        return led.select("fp", "leader", F.explode(F.concat(*keys)).alias("key"))

    left = variants(0)
    right = variants(1).select("key", F.col("fp").alias("other"), F.col("leader").alias("led"))
    is_whole = F.shiftright("key", 32).isin(32, 65)
    pairs = left.join(right.hint("merge"), "key").where(
        (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= DISTANCE)
        & (F.col("leader") != F.col("led")) & (~is_whole | (F.col("fp") < F.col("other"))))
    return pairs.select(F.col("fp").alias("a"), F.col("other").alias("b")).union(
        led.where("fp <> leader").select(F.col("fp").alias("a"), F.col("leader").alias("b")))


def near_duplicates(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, fp (signed long), component (smallest id reachable over links of DISTANCE
    bits or fewer, its own included).

    Equal prints, copies among them, collapse before anything is paired. Null and empty texts have print 0
    and link like others; repeated rows keep their rows; null ids never become a component unless all ids
    of it are null. An empty table gives an empty one; further columns are ignored."""
    store = Store(docs.sparkSession, "simhash")
    prints = store.put(fingerprints(docs, width, id_col, text_col), "prints")
    distinct = store.put(prints.groupBy("fp").agg(F.min(id_col).alias("first")), "distinct")
    found = components(links(distinct.select("fp"), store), store)
    joined = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root"))
    lowest = joined.groupBy("root").agg(F.min("first").alias("component"))
    by_print = joined.join(lowest, "root").select("fp", "component")
    return prints.join(by_print, "fp").select(id_col, "fp", "component")
