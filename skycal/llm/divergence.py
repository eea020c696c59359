"""How the sources of each language differ in their terms, by a frequent-pattern tree of the rows of terms."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skycal.llm.shared import Store

TERM = re.compile(rb"[A-Za-z\x80-\xFF]+")      # [^\x00-\x40\x5B-\x60\x7B-\x7F]+ over UTF-8 bytes
LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
CHUNK = 1 << 20        # bytes of a text whose terms are lists at once
ENTRIES = 1 << 18      # counts, or pairs of sources, that a task holds before it passes them on
BLOCK = 1 << 17        # node-ancestor combinations whose corrections are computed at once
SALTS = 16
EXACT = float(1 << 62)
WHOLE = "decimal(38,0)"


def _term_lists(text: bytes) -> Iterator[list[bytes]]:
    at = 0
    while at < len(text):
        end = min(len(text), at + CHUNK)
        if end < len(text) and (rest := re.compile(rb"[A-Za-z\x80-\xFF]*").match(text, end)):
            end = rest.end()
        yield TERM.findall(text[at:end])
        at = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts (lang, source, term, n, docs); every group is told once more by a row without a term."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            rows = len(n) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * rows, pa.string()), pa.array([source] * rows, pa.string()),
                 pa.array([None, *(t.decode() for t in n)], pa.string()), pa.array([0, *n.values()], pa.int64()),
                 pa.array([0, *(docs[t] for t in n)], pa.int64())], names=["lang", "source", "term", "n", "docs"])
        held.clear()

    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            seen: set[bytes] = set()
            for terms in _term_lists(text.encode().lower()):
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
        if sum(len(n) for n, _ in held.values()) >= ENTRIES:
            yield from flush()
    yield from flush()


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class _PairSums:
    """Sums of corrections by ordered pair of sources, in blocks of node-ancestor combinations."""

    def __init__(self) -> None:
        self.sums: dict[tuple[str, str, str], int] = {}
        self.start("")

    def start(self, lang: str) -> None:
        self.lang, self.codes = lang, {}
        self.above: tuple[list, list, list] = ([], [], [])          # source, p, p of count 0 of the ancestors
        self.node: tuple[list, list, list, list, list] = ([], [], [], [], [])    # the same of nodes, terms, ancestors

    def add(self, sources: list[int], p: list[int], z: list[int], terms: int) -> None:
        """One node: the last of a path, through which so many terms go. Its ancestors are the rest."""
        for held, path in zip(self.above, (sources, p, z)):
            held.extend(path[:-1])
        for held, value in zip(self.node, (sources[-1], p[-1], z[-1], terms, len(p) - 1)):
            held.append(value)
        if len(self.above[0]) >= BLOCK:
            self.compute()

    def compute(self) -> None:
        if not self.above[0]:
            return
        a, pa_, za = (np.array(c, dtype=np.int64) for c in self.above)
        *node, times = (np.array(c, dtype=np.int64) for c in self.node)
        b, pb, zb, terms = (np.repeat(c, times) for c in node)
        names = list(self.codes)
        for s, ps, zs, t, pt, zt in ((a, pa_, za, b, pb, zb), (b, pb, zb, a, pa_, za)):
            one = _distance(ps, pt) - _distance(ps, zt) - _distance(zs, pt) + _distance(zs, zt)
            pairs, place = np.unique(s * len(names) + t, return_inverse=True)
            # Beyond 62 bits Python's own integers take over.
            small = float(np.abs(one.astype(np.float64) * terms).sum()) < EXACT
            total = np.zeros(len(pairs), dtype=np.int64 if small else object)
            np.add.at(total, place, one * terms if small else one.astype(object) * terms.astype(object))
            for pair, value in zip(pairs.tolist(), total.tolist()):
                key = (self.lang, names[pair // len(names)], names[pair % len(names)])
                self.sums[key] = self.sums.get(key, 0) + value
        for held in (*self.above, *self.node):
            held.clear()

    def rows(self) -> pa.RecordBatch:
        keys = list(zip(*self.sums)) or [(), (), ()]
        batch = pa.RecordBatch.from_arrays(
            [*(pa.array(k, pa.string()) for k in keys), pa.array([Decimal(v) for v in self.sums.values()], pa.decimal128(38, 0))],
            names=["lang", "source", "item", "value"])
        self.sums = {}
        return batch


def _tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walks the frequent-pattern tree of sorted rows (lang, path, terms): only the path to the present node is held,
    since a node that the next row does not share is complete. Each node then meets each of its ancestors once."""
    out, lang = _PairSums(), None
    stack: list[tuple[str, int]] = []
    sources, p, z, terms = [], [], [], []

    def back_to(depth: int) -> None:
        while len(stack) > depth:
            if len(stack) > 1:
                out.add(sources, p, z, terms[-1])
                terms[-2] += terms[-1]
            for held in (stack, sources, p, z, terms):
                held.pop()

    for batch in batches:
        paths = batch.column("path")
        flat = paths.flatten()
        names, ps, zs = (flat.field(k).to_pylist() for k in range(3))
        ends = (paths.offsets.to_numpy() - paths.offsets[0].as_py()).tolist()
        for row, (own, m) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("terms").to_pylist())):
            if own != lang:
                back_to(0)
                out.compute()
                out.start(own)
                lang = own
            low, high = ends[row], ends[row + 1]
            shared = 0
            while shared < min(len(stack), high - low) and stack[shared] == (names[low + shared], ps[low + shared]):
                shared += 1
            back_to(shared)
            for k in range(low + shared, high):
                stack.append((names[k], ps[k]))
                sources.append(out.codes.setdefault(names[k], len(out.codes)))
                p.append(ps[k])
                z.append(zs[k])
                terms.append(0)
            terms[-1] += m
        if len(out.sums) >= ENTRIES:
            yield out.rows()
    back_to(0)
    out.compute()
    yield out.rows()


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + kept)), exactly; NULL where nothing is kept."""
    top = (n + F.lit(1)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.when(kept > 0, F.call_function("div", top, (total + kept).cast("decimal(20,0)")) + 1)


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def divergence(docs: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank). Part `pair`: every other source of the language and how far this
    one is from it over all its kept terms. Part `term`: the terms that this source uses more than its language does,
    the first `top` of them.

    Null texts, languages and sources count as ''. Every row is a document, repeated ones too. A source without
    terms has its pairs, and those of a language without kept terms have value 0. Ties go by the item's UTF-8 bytes.
    An empty table gives an empty one; further columns are ignored.

    A pair's sum over all terms is that of terms found in neither, plus, for each source, what the terms found in it
    change, as if the other lacked them, plus a correction for terms found in both. The last comes from the tree:
    equal rows of terms collapse to one with their number, rows are sorted over range partitions, and each task
    walks its part of the tree and passes on one sum per pair. Counts collapse in the tasks that read the texts. A row
    of a term is at most as long as its language has sources, of which the result holds all pairs in any case."""
    store = Store(docs.sparkSession, "divergence")
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    partial = docs.select(empty("lang"), empty("source"), empty("text")).mapInArrow(
        _counted, "lang string, source string, term string, n bigint, docs bigint")
    counts = partial.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    row = Window.partitionBy("lang", "term")
    told = counts.withColumn("lang_docs", F.sum("docs").over(row)).withColumn("lang_n", F.sum("n").over(row)).withColumn(
        "first", F.min("source").over(row) == F.col("source"))
    told = store.put(told.where((F.col("lang_docs") >= LEAST_DOCS) | F.col("term").isNull()).drop("docs", "lang_docs"), "counts")
    kept = told.where("term IS NOT NULL")

    groups = told.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count_if(F.col("first") & F.col("term").isNotNull()).alias("firsts"))
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("firsts").alias("kept"))
    sizes = store.put(groups.drop("firsts").join(langs, "lang").withColumn(
        "z", _share(F.lit(0).cast("bigint"), F.col("total"), F.col("kept"))), "sizes")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salt = lambda *cols: F.pmod(F.xxhash64(*cols), F.lit(SALTS)).cast("int")

    # A source may hold a third of all counts, so its row of sizes is there once for each salt.
    placed = kept.withColumn("salt", salt("term")).join(sizes.select("*", salts), ["lang", "source", "salt"])
    shares = store.put(placed.select(
        "lang", "source", "term", _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), "z",
        _share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q")), "shares")

    whole = lambda c: c.cast(WHOLE).alias("value")
    others = sizes.select("lang", F.col("source").alias("item"), F.col("z").alias("other"), salts)
    apart = sizes.select("lang", "source", "kept", "z", salt("source").alias("salt")).join(others, ["lang", "salt"]).where("source <> item")
    neither = apart.select("lang", "source", "item", whole(
        F.coalesce(F.col("kept").cast("decimal(18,0)") * _f(F.col("z"), F.col("other")).cast("decimal(20,0)"), F.lit(0))))
    alike = shares.groupBy("lang", "source", "p", "z").agg(F.count(F.lit(1)).alias("terms")).withColumn("salt", salt("source", "p"))
    either = alike.join(others, ["lang", "salt"]).where("source <> item")
    times = lambda a, b: F.col("terms").cast("decimal(18,0)") * (a - b).cast("decimal(20,0)")
    p, z, other = F.col("p"), F.col("z"), F.col("other")
    either = either.select("lang", F.explode(F.array(
        F.struct("source", "item", whole(times(_f(p, other), _f(z, other)))),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item"), whole(times(_f(other, p), _f(other, z)))))).alias("e"))
    rows = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", "p", "z"))).alias("path"))
    rows = rows.where(F.size("path") > 1).groupBy("lang", "path").agg(F.count(F.lit(1)).alias("terms"))
    tree = rows.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    both = tree.mapInArrow(_tree, f"lang string, source string, item string, value {WHOLE}")
    pairs = neither.union(either.select("lang", "e.*")).union(both).groupBy("lang", "source", "item").agg(
        F.sum("value").cast("bigint").alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    more = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), _f(F.col("p"), F.col("q")).alias("value"))
    more = more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    named = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return named(ranked, "pair").union(named(more, "term"))


DIVERGENCE_SQL = f"""
WITH words AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents),
long AS (SELECT row, lang, source, unnest(terms) AS term FROM words),
lang_terms AS (SELECT lang, term, count(*)::HUGEINT AS n FROM long GROUP BY lang, term HAVING count(DISTINCT row) >= {LEAST_DOCS}),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM long SEMI JOIN lang_terms USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM words),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY ALL),
langs AS (SELECT lang, sum(n)::HUGEINT AS total, count(*)::HUGEINT AS v FROM lang_terms GROUP BY lang),
shares AS (
  SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n, 1 + {SCALE} * (coalesce(c.n, 0) + 1) // (coalesce(s.total, 0) + l.v) AS p,
    1 + {SCALE} * (t.n + 1) // (l.total + l.v) AS q
  FROM groups AS g JOIN lang_terms AS t USING (lang) JOIN langs AS l USING (lang)
  LEFT JOIN counts AS c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term
  LEFT JOIN totals AS s ON s.lang = g.lang AND s.source = g.source),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares AS a JOIN shares AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums AS s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE n > 0 AND p > q)
SELECT * FROM (
  SELECT lang, source, part, item, value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts)
WHERE part = 'pair' OR rank <= {TOP}
"""
