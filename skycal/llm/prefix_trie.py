"""The prefix trie of conversations, with totals of every subtree by bands of depths."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skycal.llm.shared import Store

BAND = 16                       # depths of a band: the ancestors that a node's values go to in one round
GROUP, HEADS = 20, 3            # conversations that share the first turns of one; turns that may be shared
PRIME = (1 << 127) - 1          # path hashes are polynomials modulo this prime,
BASE = 0x5F2C9B1D3E7A48660D1F35B79ACE2481      # at this place
ROOT = bytes(16)
HOT_SHARE = 1000                # a parent of more than one in so many of all nodes is joined apart
IDS_A_PIECE = 4096              # conversation numbers that are written into one piece of a hash's input
WORDS = r"[^\x20\x09-\x0D]+"


def _local_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and path hash of each row in its conversation, as far as this sorted partition holds it."""
    part, last, at, path, power = TaskContext.get().partitionId(), None, 0, 0, 1
    for batch in batches:
        places, paths, parents = [], [], []
        for conv, x in zip(batch.column("conv").to_pylist(), batch.column("x").to_pylist()):
            if conv != last:
                last, at, path, power = conv, 0, 0, 1
            parents.append(path.to_bytes(16, "big"))
            path = (path + int.from_bytes(x, "big") * power) % PRIME
            power = power * BASE % PRIME
            places.append(at)
            paths.append(path.to_bytes(16, "big"))
            at += 1
        new = {"part": pa.array([part] * len(places), pa.int32()), "at": pa.array(places, pa.int64()),
               "parent": pa.array(parents, pa.binary()), "node": pa.array(paths, pa.binary())}
        yield pa.RecordBatch.from_arrays([*batch.columns, *new.values()], names=[*batch.schema.names, *new])


def _moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Path hashes of rows whose conversation begins in an earlier partition, seen from its beginning."""
    for batch in batches:
        carried = batch.column("carried")
        if carried.null_count < len(batch):
            cols = {}
            for name in ("parent", "node"):
                values = zip(batch.column(name).to_pylist(), carried.to_pylist(), batch.column("before").to_pylist())
                cols[name] = pa.array([v if n is None else (
                    (int.from_bytes(h, "big") + pow(BASE, n, PRIME) * int.from_bytes(v, "big")) % PRIME).to_bytes(16, "big")
                    for v, n, h in values], pa.binary())
            batch = pa.RecordBatch.from_arrays(
                [cols.get(n, batch.column(n)) for n in batch.schema.names], names=batch.schema.names)
        yield batch


def _paths(rows: DataFrame, order: list[Column], store: Store, name: str) -> DataFrame:
    """rows (conv, x, ...) with `at`, the place of each in its conversation from 0, and the path hashes `parent` and
    `node` of the turns before it and up to it.

    Rows are sorted over range partitions, so a conversation of any length is spread over many; what a partition
    needs of those before it is one number and one hash, and one such row per partition passes the driver. The
    hash of a path is the sum of its turns' hashes times powers of BASE, which is why it can be put together so."""
    spark, keys = rows.sparkSession, [F.col("conv"), *order]
    schema = rows.drop("part").schema.simpleString()[7:-1].replace(":", " ") + ", part int, at bigint, parent binary, node binary"
    local = store.put(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(_local_paths, schema), name)
    ends = local.groupBy("part").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "at", "node")).alias("last"))
    carried, key, held, path = [], None, 0, 0
    for e in ends.orderBy("part").collect():
        if e.first == key:
            carried.append((e.part, key, held, path.to_bytes(16, "big")))
        whole = e.last.conv == key
        path = ((path * whole) + pow(BASE, held * whole, PRIME) * int.from_bytes(e.last.node, "big")) % PRIME
        key, held = e.last.conv, held * whole + e.last.at + 1
    before = spark.createDataFrame(carried, "part int, conv bigint, carried bigint, before binary")
    joined = local.join(F.broadcast(before), ["part", "conv"], "left").select(
        *rows.columns, (F.col("at") + F.coalesce("carried", F.lit(0))).alias("at"), "parent", "node", "carried", "before")
    return joined.mapInArrow(_moved, joined.schema).drop("carried", "before")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv, turn, x, words) of every row that has a conversation; x tells (role, text) apart."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn"),
        F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 32)).alias("x"),
        F.regexp_count(text, F.lit(WORDS)).cast("bigint").alias("words"))


def _heads(conv: Column) -> Column:
    """How many first turns a conversation takes from the first of its group."""
    return F.crc32(conv.cast("string").cast("binary")) % (HEADS + 1)


def rebuilt(conversations: DataFrame, store: Store) -> DataFrame:
    """(conv, depth, parent, node, words): the rebuilt turns of every conversation, and its root at depth 0."""
    own = _paths(turns(conversations), [F.col("turn").asc_nulls_first(), F.col("x")], store, "turns")
    own = store.put(own.select("conv", "at", "x", "words"), "original")
    known = own.where("at = 0").select("conv")
    shared = own.where(F.col("conv") % GROUP == 0).where(F.col("at") < HEADS).select(
        F.explode(F.sequence(F.col("conv"), F.col("conv") + (GROUP - 1))).alias("conv"), "at", "x", "words")
    first = shared.where(F.col("at") < _heads(F.col("conv"))).join(known, "conv", "left_semi")
    rest = own.where(F.col("at") >= _heads(F.col("conv")))
    rows = first.withColumn("side", F.lit(0)).unionByName(rest.withColumn("side", F.lit(1)))
    rows = rows.select("conv", "side", F.col("at").alias("place"), "x", "words")
    found = _paths(rows, [F.col("side"), F.col("place")], store, "rebuilt")
    return found.select("conv", (F.col("at") + 1).alias("depth"), "parent", "node", "words").union(
        known.select("conv", F.lit(0).cast("bigint"), F.lit(None).cast("binary"), F.lit(ROOT), F.lit(0).cast("bigint")))


def _totals(nodes: DataFrame, paths: DataFrame, deepest: int, values: list[str], store: Store, level: int = 0) -> DataFrame:
    """(node, values): the sums of values over the subtree of every node, itself included.

    nodes has (conv, depth, node, values), a conversation that runs through each node, the smallest; paths has
    (conv, depth, node) of every conversation. A node's values go to its ancestors within its band of depths. The
    first nodes of the bands form a trie of a BAND-th of the depth, whose totals are found in the same way; the
    complete total of each then goes to the ancestors in the band above it. So there are as many rounds as the
    depth has digits to the base BAND, and no value is copied more than BAND times in each."""
    band = lambda c: F.floor(F.col(c) / BAND).cast("bigint")
    zero = [F.lit(0).cast("bigint").alias(v) for v in values]
    # The nodes of one conversation are the last of its path: of the smallest in a node, deeper ones on its path are too.
    firsts = nodes.groupBy("conv").agg(F.min("depth").alias("first")).withColumn("band", band("first"))
    above = paths.withColumn("band", band("depth")).join(firsts, ["conv", "band"]).where("depth < first")
    rows = nodes.select("conv", band("depth").alias("band"), "depth", "node", *values).union(
        above.select("conv", "band", "depth", "node", *zero))
    # At most BAND rows of a path meet; what goes to one ancestor is summed before it moves.
    path = rows.groupBy("conv", "band").agg(F.sort_array(F.collect_list(F.struct("depth", "node", *values))).alias("path"))
    below = lambda v, k: F.aggregate(F.slice("path", k + 1, BAND), F.lit(0).cast("bigint"), lambda s, e: s + e[v])
    up = path.select(F.explode(F.transform("path", lambda e, k: F.struct(
        e["node"].alias("node"), *[below(v, k).alias(v) for v in values]))).alias("e")).select("e.*")
    inside = store.put(up.groupBy("node").agg(*[F.sum(v).alias(v) for v in values]), f"inside-{level}")
    if deepest < BAND:
        return inside
    at_band = lambda df, *more: df.where(F.col("depth") % BAND == 0).select("conv", band("depth").alias("depth"), "node", *more)
    roots = store.put(at_band(nodes).join(inside, "node"), f"roots-{level}")
    complete = _totals(roots, at_band(paths), deepest // BAND, values, store, level + 1)
    given = roots.where("depth > 0").select("conv", (F.col("depth") - 1).alias("band"), "node").join(complete, "node").drop("node")
    carried = given.join(paths.select("conv", band("depth").alias("band"), "node"), ["conv", "band"]).select("node", *values)
    return store.put(inside.unionByName(carried).groupBy("node").agg(*[F.sum(v).alias(v) for v in values]), f"complete-{level}")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of a node in order, written out in pieces."""
    node, held, schema = None, [], pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
    for batch in batches:
        out: list[tuple] = []
        for own, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held and (own != node or len(held) == IDS_A_PIECE):
                out.append((node, held[0], ",".join(map(str, held))))
                held = []
            node = own
            held.append(conv)
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, o)) for o in out], schema=schema)
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (node, held[0], ",".join(map(str, held)))))], schema=schema)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of a node's pieces in order, one piece in memory at a time."""
    node, state, schema = None, None, pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    for batch in batches:
        out: list[dict] = []
        for own, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if own == node:
                state.update(b"," + ids.encode())
            else:
                if state:
                    out.append({"node": node, "ends_sha256": state.hexdigest()})
                node, state = own, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    if state:
        yield pa.RecordBatch.from_pylist([{"node": node, "ends_sha256": state.hexdigest()}], schema=schema)


def _ends(paths: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations end. The numbers of a node, however many, are sorted and
    written out over many tasks; only their text, which SHA-256 takes one after the other, passes through one."""
    last = paths.groupBy("conv").agg(F.max(F.struct("depth", "node")).alias("last")).select("last.node", "conv")
    sorted_ids = last.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv")
    pieces = sorted_ids.mapInArrow(_pieces, "node binary, first bigint, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_hashes, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (the smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and `node`, the hash of its path.

    A conversation's first turns, crc32 of its number modulo 4 of them, are those of the first conversation of its
    twenty (of negative numbers by the remainder that SQL has). Turns without a number come first; turns of one
    number are ordered by the SHA-256 of role and text, so repeated rows are turns of their own. Null roles and
    texts count as empty. Rows without a conversation belong to none and add nothing; an empty table gives an empty
    trie, without a root. Further columns are ignored. Paths are equal if their 127-bit hashes are."""
    store = Store(conversations.sparkSession, "prefix-trie")
    paths = store.put(rebuilt(conversations, store), "paths")
    nodes = store.put(paths.groupBy("node").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv"), F.min("depth").alias("depth"),
        F.min("parent").alias("parent"), F.max("words").alias("words")), "nodes")
    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("deepest")).first()

    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = store.put(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "counted")
    parents = counted.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"), "n_children")
    # Fewer than HOT_SHARE parents have so large a share of all nodes as children: a proven bound of what is broadcast.
    hot = F.broadcast(parents.where(F.col("n_children") * HOT_SHARE > F.lit(size.n)).drop("n_children"))
    apart = counted.join(hot, "parent").select(*counted.columns, "parent_conv_id")
    others = counted.where("parent IS NOT NULL").join(hot, "parent", "left_anti").join(parents.drop("n_children"), "parent").select(*counted.columns, "parent_conv_id")
    top = counted.where("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    named = apart.union(others).union(top)

    own = counted.select("conv", "depth", "node", (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
                         ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    totals = _totals(own, paths.select("conv", "depth", "node"), size.deepest or 0, ["n_leaves", "saved_tokens"], store)
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return named.join(totals, "node").join(_ends(paths), "node", "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", empty).alias("ends_sha256"), "node")


def _crc32_sql(column: str) -> str:
    """CRC-32 of the decimal digits of a column, bit by bit: the polynomial is that of zlib."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"""xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({column} AS VARCHAR), ''), lambda s: ord(s)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda c, i: {step})))"""


PREFIX_TRIE_SQL = f"""
WITH RECURSIVE convs AS (
  SELECT c, {_crc32_sql('c')} % {HEADS + 1} AS h FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL)),
own AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) - 1 AS p, x, w FROM (
    SELECT conv_id, turn, substr(sha256(strlen(role)||':'||role||text), 1, 32) AS x,
      len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS w
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL))),
turns AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY side, p) AS d, x, w FROM (
    SELECT v.c, 0 AS side, o.p, o.x, o.w FROM convs AS v JOIN own AS o ON o.c = v.c - v.c % {GROUP} AND o.p < v.h
    UNION ALL SELECT v.c, 1, o.p, o.x, o.w FROM convs AS v JOIN own AS o ON o.c = v.c AND o.p >= v.h)),
paths AS (
  SELECT c, 0 AS d, '' AS node, NULL::VARCHAR AS parent, 0 AS w FROM convs
  UNION ALL SELECT p.c, t.d, sha256(p.node||t.x), p.node, t.w FROM paths AS p JOIN turns AS t ON t.c = p.c AND t.d = p.d + 1),
nodes AS (SELECT node, min(c) AS c, min(d) AS d, min(parent) AS parent, count(*) AS n, (count(*)-1)*max(w) AS saved FROM paths GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS k FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT a.node, count(*) FILTER (WHERE k IS NULL) AS leaves, sum(n.saved) AS saved
  FROM nodes AS n JOIN paths AS a ON a.c = n.c AND a.d <= n.d LEFT JOIN kids AS k ON k.node = n.node GROUP BY a.node),
ends AS (
  SELECT node, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends FROM (
    SELECT c, arg_max(node, d) AS node FROM paths GROUP BY c) GROUP BY node)
SELECT n.c AS conv_id, n.d::BIGINT AS depth, p.c AS parent_conv_id, n.n AS n_convs, coalesce(k.k, 0) AS n_children,
  b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM nodes AS n JOIN below AS b USING (node) LEFT JOIN nodes AS p ON p.node = n.parent
LEFT JOIN kids AS k ON k.node = n.node LEFT JOIN ends AS e ON e.node = n.node
"""
