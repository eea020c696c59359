"""Removal of long repeated byte strings by suffix sorting.

Every start of a `length`-byte string belongs to an anchor: the leftmost least hash of K bytes inside the string. Equal
strings have equal anchors at equal distance, so only starts with the same anchor hash can repeat each other. The text
around all starts of one anchor is its context. Contexts of hashes that occur twice are collapsed to distinct ones and
dealt by anchor hash into shards, and the suffixes of each shard are sorted by external induction (suffixes.py).
Passages counted in words go the same way, with anchors of words; the windows of a shard are told apart by their hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skycal.llm.shared import Store
from skycal.llm.suffixes import repeated

LENGTH = 400           # bytes
CHUNK = 1 << 18        # bytes of documents that are anchored at once
SHARD = 1 << 19        # bytes of contexts whose suffixes are sorted together, at least one anchor's
HOT = 4096             # distinct contexts of an anchor; beyond, its starts are told apart by their whole strings
GRAM = 10              # words of an anchor of a passage that is counted in words
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_WORDED = np.uint64(1)  # the bit of an anchor hash that tells anchors of words from those of bytes
_ROW = "k1 bigint, k2 bigint"
_CONTEXT = ["anchor", "c1", "c2", "times", "distinct"]


@cache
def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for base in _BASES:
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            pair.append(np.multiply.accumulate(p))
        out.append(tuple(pair))
    return out


class _Prefix:
    """Two 64-bit polynomial hashes of any part of some bytes."""

    def __init__(self, data: np.ndarray) -> None:
        size = 1 << max(len(data), 2).bit_length()
        self.sums, self.back = [], []
        for up, down in _powers(size):
            s = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(11)) * up[: len(data)], out=s[1:])
            self.sums.append(s)
            self.back.append(down)

    def of(self, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[which][end] - self.sums[which][start]) * self.back[which][start]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _least(keys: np.ndarray, window: int) -> np.ndarray:
    """Least key in keys[i : i + window] for every such i (van Herk)."""
    n = len(keys) - window + 1
    padded = np.full(-(-len(keys) // window) * window, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[window - 1: window - 1 + n])


def anchors(texts: list[bytes], length: int = LENGTH) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Arrays (text, anchor hash, two hashes of the context, first start, number of starts) of all texts."""
    k = max(1, length // 10)
    window = length - k + 1
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(sizes)
    if len(data) < length:
        return
    prefix = _Prefix(data)
    place = np.arange(len(data) - k + 1)
    hashes = _mixed(prefix.of(0, place, place + k))
    bits = np.uint64(len(data).bit_length())
    keys = (hashes >> bits << bits) | place.astype(np.uint64)          # the place makes the leftmost of equals the least
    anchor = (_least(keys, window) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(anchor)]
    whole = np.arange(len(anchor)) + length <= ends[owner]
    first = np.flatnonzero(whole & ((np.diff(anchor, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0)))
    if not len(first):
        return
    # a run of starts ends where the next one begins, or its text has no more whole strings
    count = np.minimum(np.append(first[1:], len(anchor)), ends[owner[first]] - length + 1) - first
    last = first + count - 1 + length
    yield (owner[first], (hashes[anchor[first]] & ~_WORDED).view(np.int64), *(_mixed(prefix.of(j, first, last)).view(np.int64) for j in (0, 1)),
           first - (ends - sizes)[owner[first]], count)


def _batches(batches, length: int) -> Iterator[tuple[list[tuple], list[bytes]]]:
    """((k1, k2, place), bytes) of about CHUNK bytes together. Parts of a longer text overlap, so that each start has
    its whole string in one of them."""
    rows, texts, size = [], [], 0
    for batch in batches:
        for k1, k2, text in zip(*batch.columns):
            k1, k2, text = k1.as_py(), k2.as_py(), text.as_py() or b""
            for at in range(0, max(len(text) - length + 1, 1), CHUNK):
                part = text[at:at + CHUNK + length - 1]
                rows.append((k1, k2, at))
                texts.append(part)
                size += len(part)
                if size >= CHUNK:
                    yield rows, texts
                    rows, texts, size = [], [], 0
    if texts:
        yield rows, texts


def _collapsed(k1, k2, own, anchor, c1, c2, place, count) -> pa.RecordBatch:
    """One row for each context of a text, however often a line makes it come again: its first place, and the others if there are any."""
    order = np.lexsort((place, c2, c1, anchor, own))
    k1, k2, own, anchor, c1, c2, place, count = (a[order] for a in (k1, k2, own, anchor, c1, c2, place, count))
    at = np.flatnonzero(np.any([np.diff(a, prepend=~a[:1]) != 0 for a in (own, anchor, c1, c2)], axis=0))
    others = np.diff(at, append=len(own)) - 1
    more = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(others)), pa.int32()), pa.array(np.delete(place, at), pa.int64()), mask=pa.array(others == 0))
    cols = (k1, k2, anchor, c1, c2, place, count)
    return pa.RecordBatch.from_arrays([*(pa.array(a[at], pa.int64()) for a in cols), more], names=["k1", "k2", "anchor", "c1", "c2", "first", "count", "more"])


def _anchored(length: int, words: int = 0):
    """The contexts of each text, and with `words` also those of its passages of so many words in fewer than `length` bytes. A
    context has count + length - 1 bytes, so the count of one of words may be below one."""

    def run(batches):
        for batch in batches:
            for rows, texts in _batches([batch], length):
                keys = np.array(rows, np.int64)
                for own, anchor, c1, c2, first, count in anchors(texts, length):
                    yield _collapsed(keys[own, 0], keys[own, 1], own, anchor, c1, c2, first + keys[own, 2], count)
            for rows, texts in _word_parts([batch], length) if words else ():
                k1, k2, own, anchor, c1, c2, s, e = _word_contexts(rows, texts, words, length)
                if len(own):
                    yield _collapsed(k1, k2, own, anchor | _WORDED.view(np.int64), c1, c2, s, e - s - length + 1)

    return run


def _cut_out(length: int):
    """Bytes of the contexts that a document stands for."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            rows = pa.RecordBatch.from_struct_array(batch.column("wanted").flatten())
            sizes = rows.column("count").to_numpy() - 1 + length
            own = np.repeat(np.arange(batch.num_rows), batch.column("wanted").value_lengths().to_numpy())
            edges = np.flatnonzero(np.diff(np.cumsum(sizes) // CHUNK, prepend=-1))
            for low, high in zip(edges.tolist(), [*edges[1:].tolist(), len(own)]):
                part, data, at, out = rows[low:high], b"", -1, []
                for k, s, n in zip(own[low:high].tolist(), part.column("first").to_pylist(), sizes[low:high].tolist()):
                    if k != at:
                        data, at = texts[k].as_py(), k
                    out.append(data[s:s + n])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in _CONTEXT), pa.array(out, pa.binary())], names=[*_CONTEXT, "context"])

    return run


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _in_shards(told):
    """What `told` makes of the contexts of SHARD bytes. Rows come sorted by anchor; shards end between anchors."""

    def run(batches):
        ids, times, contexts, size, anchor = [], [], [], 0, None
        for batch in batches:
            for a, c1, c2, n, context in zip(*(c.to_pylist() for c in batch.columns)):
                if a != anchor and size >= SHARD:
                    yield told(ids, times, contexts)
                    ids, times, contexts, size = [], [], [], 0
                anchor = a
                ids.append((a, c1, c2))
                times.append(n)
                contexts.append(context)
                size += len(context)
        if contexts:
            yield told(ids, times, contexts)

    return run


_RUN = ["anchor", "c1", "c2", "low", "high"]


def _sorted_shards(length: int):
    """Bytes of each context that runs of repeated starts cover."""

    def told(ids, times, contexts):
        out = []
        for i, n, flags in zip(ids, times, repeated(contexts, length)):
            out += [(*i, low, high - 1 + length) for low, high in ([(0, len(flags))] if n > 1 else _runs(flags))]
        cols = list(zip(*out)) if out else [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=_RUN)

    return _in_shards(told)


def _word_shards(words: int, below: int):
    """Bytes of each context that runs of repeated windows cover. Equal windows have equal anchors, so a shard has all of them."""

    def told(ids, times, contexts):
        own, text, low, high, h1, h2 = _word_hashes(contexts, words, below)
        order = np.lexsort((h2, h1))
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum((np.diff(h1[order], prepend=0) != 0) | (np.diff(h2[order], prepend=0) != 0))
        often = np.bincount(group, np.array(times)[text])[group] > 1 if len(group) else np.zeros(0, bool)
        own, text, low, high = (a[often] for a in (own, text, low, high))
        new = np.flatnonzero((np.diff(own, prepend=-2) != 1) | (np.diff(text, prepend=-1) != 0))
        last = np.append(new[1:], len(own)) - 1 if len(new) else new
        cols = (*np.array(ids, np.int64)[text[new]].T, low[new], high[last])
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in cols], names=_RUN)

    return _in_shards(told)


def _word_windows(words: int, below: int):
    """Two hashes of every window of a context, numbered from left to right."""

    def run(batches):
        for batch in batches:
            own, text, low, high, h1, h2 = _word_hashes(batch.column("context").to_pylist(), words, below)
            cols = (own, low, high, h1, h2)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(text)) for c in _CONTEXT[:4]), *(pa.array(c, pa.int64()) for c in cols)],
                                             names=[*_CONTEXT[:4], "n", "low", "high", "h1", "h2"])

    return run


def _strings(length: int):
    """Two hashes of every whole string of a context."""

    def run(batches):
        for batch in batches:
            for a, c1, c2, n, context in zip(*(c.to_pylist() for c in batch.columns)):
                prefix = _Prefix(np.frombuffer(context, np.uint8))
                at = np.arange(len(context) - length + 1)
                h1, h2 = (_mixed(prefix.of(j, at, at + length)).view(np.int64) for j in (0, 1))
                same = [pa.array(np.full(len(at), v), pa.int64()) for v in (a, c1, c2, n)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(at), pa.array(h1), pa.array(h2)], names=["anchor", "c1", "c2", "times", "low", "h1", "h2"])

    return run


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs with k1 and k2, hashes of text and id: rows that have both in common are copies of one row."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(F.xxhash64(text).alias("k1"), F.xxhash64(F.col(id_col), F.length(text)).alias("k2"),
                       F.col(id_col).alias("id"), text.alias("text"))


def repeats(docs: DataFrame, store: Store, length: int = LENGTH, shard_hot: int = HOT, *, words: int = 0) -> DataFrame:
    """(k1, k2, spans): byte ranges of documents of keyed() that a repeated string covers, overlapping and unordered.

    With `words` also passages, null if there are none: those that runs of passages of so many words cover, each of which occurs
    twice, byte by byte, and has fewer than `length` bytes. Both are looked for in one pass, and each text moves once for both."""
    found = store.put(docs.select("k1", "k2", "text").where(F.length("text") >= (min(length, 2 * words - 1) if words else length)).mapInArrow(
        _anchored(length, words), f"{_ROW}, anchor bigint, c1 bigint, c2 bigint, first bigint, count bigint, more array<bigint>"), "anchors")
    places = F.sum(F.lit(1) + F.coalesce(F.array_size("more"), F.lit(0)))
    # Stored, so that the join finds two plain shuffles and a very frequent anchor is split by adaptive execution.
    groups = store.put(found.groupBy("anchor").agg(places.alias("n"), (
        (F.min("c1") == F.max("c1")) & (F.min("c2") == F.max("c2"))).alias("alike")).where("n > 1").drop("n"), "groups")
    twice = store.put(found.join(groups, "anchor"), "twice")
    store.drop("anchors", "groups")
    mixed = twice.where("NOT alike")
    distinct = mixed.groupBy("anchor", "c1", "c2").agg(F.min(F.struct("k1", "k2", "first", "count")).alias("r"), places.alias("times"))
    sizes = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("distinct"))
    wanted = distinct.join(sizes, "anchor").groupBy("r.k1", "r.k2").agg(F.collect_list(F.struct(
        *_CONTEXT, F.col("r.first").alias("first"), F.col("r.count").alias("count"))).alias("wanted"))
    # one row for each document that is asked: copies of a row are the same text
    asked = docs.select("k1", "k2", "text").join(wanted, ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    contexts = store.put(asked.select("text", "wanted").mapInArrow(
        _cut_out(length), "anchor bigint, c1 bigint, c2 bigint, times bigint, distinct bigint, context binary"), "contexts")
    columns = ["anchor", "c1", "c2", "times", "context"]
    worded = F.col("anchor").bitwiseAND(F.lit(int(_WORDED)).cast("bigint")) != 0
    few, many = (contexts.where(c).select(*columns) for c in (F.col("distinct") <= shard_hot, F.col("distinct") > shard_hot))
    in_shards = lambda df, f: df.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        f, "anchor bigint, c1 bigint, c2 bigint, low bigint, high bigint")
    sorted_ = in_shards(few.where(~worded), _sorted_shards(length))
    # An anchor with very many distinct contexts is split further, by the strings themselves: counts by string, added
    # before they are dealt, tell which occur twice.
    strings = many.where(~worded).mapInArrow(
        _strings(length), "anchor bigint, c1 bigint, c2 bigint, times bigint, low bigint, h1 bigint, h2 bigint").select(
        *columns[:4], F.col("low").alias("n"), "low", (F.col("low") + length).alias("high"), "h1", "h2")
    if words:
        sorted_ = sorted_.union(in_shards(few.where(worded), _word_shards(words, length)))
        strings = strings.union(many.where(worded).mapInArrow(
            _word_windows(words, length), "anchor bigint, c1 bigint, c2 bigint, times bigint, n bigint, low bigint, high bigint, h1 bigint, h2 bigint"))
    # A context makes hundreds of strings, which Spark sizes as one row: their counts are not left to be sent to the driver.
    often = strings.groupBy("h1", "h2").agg(F.sum("times").alias("sum")).where("sum > 1").drop("sum")
    hits = strings.join(often.hint("merge"), ["h1", "h2"]).groupBy("anchor", "c1", "c2").agg(
        F.sort_array(F.collect_set(F.struct("n", "low", "high"))).alias("hits"), F.collect_set("n").alias("ns"))
    edge = lambda step: F.filter("hits", lambda k: ~F.array_contains("ns", k["n"] + step))
    single = hits.select("anchor", "c1", "c2", F.zip_with(
        edge(-1), edge(1), lambda first, last: F.struct(first["low"].alias("low"), last["high"].alias("high"))).alias("runs"))
    # One row of maximal runs for each context, so that the join makes a row for each text with a copy and not for each of its starts.
    runs = store.put(sorted_.groupBy("anchor", "c1", "c2").agg(F.collect_list(F.struct("low", "high")).alias("runs")).union(single), "runs")
    store.drop("contexts")
    span = lambda at, low, high: F.struct((at + low).alias("s"), (at + high).alias("e"))
    each = F.concat(F.array("first"), F.coalesce("more", F.array().cast("array<bigint>")))
    spans = mixed.join(runs, ["anchor", "c1", "c2"]).select("k1", "k2", worded.alias("worded"), F.flatten(F.transform(each, lambda at: F.transform(
        "runs", lambda r: span(at, r["low"], r["high"])))).alias("spans")).union(twice.where("alike").select(
            "k1", "k2", worded.alias("worded"), F.transform(each, lambda at: span(at, F.lit(0), F.col("count") - 1 + length)).alias("spans")))
    if not words:
        return spans.groupBy("k1", "k2").agg(F.flatten(F.collect_set("spans")).alias("spans"))
    of = lambda kind: F.flatten(F.collect_set(F.when(kind, F.col("spans"))))
    both = spans.groupBy("k1", "k2").agg(of(~F.col("worded")).alias("spans"), of(F.col("worded")).alias("passages"))
    return both.select("k1", "k2", *(F.when(F.size(c) > 0, F.col(c)).alias(c) for c in ("spans", "passages")))


_BLANK = np.isin(np.arange(256), list(b" \t\n\r\f\v"))


def _windows(texts: list[bytes], words: int, below: int):
    """(prefix hashes, first and last byte of all words, text of each, which words begin a window of `words` words that lie
    in one text in less than `below` bytes). Words are what stands between ASCII white space."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    edge = np.flatnonzero(np.diff(~_BLANK[data], prepend=False, append=False))
    begin, end = edge[::2], edge[1::2]
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    owner = np.searchsorted(bounds, begin, side="right") - 1
    n = max(len(begin) - words + 1, 0)
    ok = (owner[:n] == owner[words - 1:]) & (end[words - 1:] - begin[:n] < below) if n else np.zeros(0, bool)
    return _Prefix(data), begin, end, owner, bounds, ok


def _word_contexts(rows: list[tuple], texts: list[bytes], words: int, below: int) -> tuple[np.ndarray, ...]:
    """Runs of windows that have their anchor, the leftmost least hash of GRAM words, in common: k1, k2, number of the row, hash of
    the anchor, two hashes of the run, its bytes from s to e."""
    gram = min(GRAM, words)
    prefix, begin, end, owner, bounds, ok = _windows(texts, words, below)
    keys, at, head = (np.array(c, np.int64) for c in zip(*((k[:2], k[2], k[3]) for k in rows)))
    place = begin[:len(ok)] - bounds[owner[:len(ok)]]
    own = np.flatnonzero(ok & (place >= head[owner[:len(ok)]]) & (place < head[owner[:len(ok)]] + CHUNK))
    grams = _mixed(prefix.of(0, begin[:len(begin) - gram + 1], end[gram - 1:])) if len(own) else np.zeros(0, np.uint64)
    bits = np.uint64(24)
    least = _least((grams >> bits << bits) | np.arange(len(grams)).astype(np.uint64), words - gram + 1) if len(own) else grams
    anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)[own]
    new = np.flatnonzero((np.diff(own, prepend=-2) != 1) | (np.diff(anchor, prepend=-1) != 0) | (np.diff(owner[own], prepend=-1) != 0))
    first, last = own[new], own[np.append(new[1:], len(own)) - 1] if len(new) else own[new]
    text = owner[first]
    shift, s, e = at[text] - head[text] - bounds[text], begin[first], end[last + words - 1]
    hashes = (_mixed(prefix.of(j, s, e)).view(np.int64) for j in (0, 1))
    return keys[text, 0], keys[text, 1], text, grams[anchor[new]].view(np.int64), *hashes, s + shift, e + shift


def _word_parts(batches, below: int) -> Iterator[tuple[list[tuple], list[bytes]]]:
    """((k1, k2, place, bytes before it), bytes) of about CHUNK bytes together."""
    rows, texts, size = [], [], 0
    for batch in batches:
        for k1, k2, text in zip(*batch.columns):
            k1, k2, text = k1.as_py(), k2.as_py(), text.as_py() or b""
            # parts begin a byte early, so that it shows whether a word begins with them, and end late enough for their last window
            for at in range(0, len(text), CHUNK):
                head = min(at, 1)
                rows.append((k1, k2, at, head))
                texts.append(text[at - head:at + CHUNK + below])
                size += len(texts[-1])
                if size >= CHUNK:
                    yield rows, texts
                    rows, texts, size = [], [], 0
    if texts:
        yield rows, texts


def _word_anchored(words: int, below: int):
    """Runs of windows that have their anchor in common: its hash and the bytes of the run."""

    def run(batches):
        for rows, texts in _word_parts(batches, below):
            k1, k2, _, anchor, _, _, s, e = _word_contexts(rows, texts, words, below)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in (k1, k2, anchor, s, e)], names=["k1", "k2", "anchor", "s", "e"])

    return run


def _word_hashes(texts: list[bytes], words: int, below: int) -> tuple[np.ndarray, ...]:
    """Number, text, first and last byte in it, and two hashes of every window; those of a text have numbers that follow each other."""
    prefix, begin, end, owner, bounds, ok = _windows(texts, words, below)
    own = np.flatnonzero(ok)
    s, e, text = begin[own], end[own + words - 1], owner[own]
    return own, text, s - bounds[text], e - bounds[text], *(_mixed(prefix.of(j, s, e)).view(np.int64) for j in (0, 1))


def _word_strings(words: int, below: int):
    """Two hashes of every window of the runs that a document is asked for."""

    def told(rows, texts):
        _, text, s, e, *hashes = _word_hashes(texts, words, below)
        keys = np.array(rows, np.int64)
        cols = (keys[text, 0], keys[text, 1], s + keys[text, 2], e + keys[text, 2], *hashes)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in cols], names=["k1", "k2", "s", "e", "h1", "h2"])

    def run(batches):
        rows, texts, size = [], [], 0
        for batch in batches:
            for k1, k2, text, runs in zip(*(c.to_pylist() for c in batch.columns)):
                for r in runs:
                    rows.append((k1, k2, r["s"]))
                    texts.append(text[r["s"]:r["e"]])
                    size += len(texts[-1])
                    if size >= CHUNK:
                        yield told(rows, texts)
                        rows, texts, size = [], [], 0
        if texts:
            yield told(rows, texts)

    return run


def word_repeats(docs: DataFrame, store: Store, words: int, below: int) -> DataFrame:
    """(k1, k2, span): byte ranges of documents of keyed() where a passage of `words` words stands that occurs twice, byte
    by byte, and has less than `below` bytes: longer ones are repeats() of that length. Equal passages have equal anchors, so
    only runs whose anchor occurs twice are looked at; their passages are told apart by two 64-bit hashes of the whole."""
    found = store.put(docs.select("k1", "k2", "text").where(F.length("text") >= 2 * words - 1).mapInArrow(
        _word_anchored(words, below), f"{_ROW}, anchor bigint, s bigint, e bigint"), "word-anchors")
    often = store.put(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "word-groups")
    wanted = store.put(found.join(often, "anchor").groupBy("k1", "k2").agg(F.collect_set(F.struct("s", "e")).alias("runs")), "word-runs")
    store.drop("word-anchors", "word-groups")
    strings = store.put(docs.select("k1", "k2", "text").join(wanted, ["k1", "k2"]).select("k1", "k2", "text", "runs").mapInArrow(
        _word_strings(words, below), f"{_ROW}, s bigint, e bigint, h1 bigint, h2 bigint"), "word-strings")
    twice = store.put(strings.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "word-twice")
    return strings.join(twice, ["h1", "h2"]).select("k1", "k2", F.struct("s", "e").alias("span"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans or []):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for s, e in spans:
        parts.append(data[at:s])
        at = e
    return b"".join([*parts, data[at:]])


def cleaned(docs: DataFrame, length: int, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, less the passages of `length` bytes, or of `words` words in fewer bytes, that occur twice: all their places go. What
    a cut through a character leaves of it goes too.

    Copies of a row lose all but what is shorter than a passage, so an emptied document stays as an empty one; null and
    empty texts, rows without an id and columns of any name stay as they are; an empty table gives an empty one."""
    store = Store(docs.sparkSession, "cleaned")
    rows = keyed(docs, id_col, text_col).select("k1", "k2", "text")
    long = repeats(rows, store, length).select("k1", "k2", F.explode("spans").alias("span"))
    spans = long.union(word_repeats(rows, store, words, length)).groupBy("k1", "k2").agg(F.collect_set("span").alias("spans"))
    names = docs.columns
    # The columns travel as one, so that none of them can have the name of a key.
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    keys = docs.select(F.xxhash64(text).alias("k1"), F.xxhash64(F.col(id_col), F.length(text)).alias("k2"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))

    def run(batches):
        for batch in batches:
            columns, texts = dict(zip(names, batch.column("row").flatten())), []
            for value, own in zip(columns[text_col], batch.column("spans")):
                value, own = value.as_py(), own.as_py()
                texts.append(without(value.encode(), merged(own)).decode("utf-8", "ignore") if own else value)
            columns[text_col] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return keys.join(spans, ["k1", "k2"], "left").select("row", "spans").mapInArrow(run, docs.schema)


def _covered(n: int, *columns: pa.ListArray) -> np.ndarray:
    """Bytes that the spans of all columns cover together, for each of n rows."""
    own = np.concatenate([np.repeat(np.arange(n), c.value_lengths().fill_null(0).to_numpy()) for c in columns])
    s, e = (np.concatenate([c.flatten().field(k).to_numpy() for c in columns]) for k in ("s", "e"))
    order = np.lexsort((s, own))
    own, s, e = own[order], s[order], e[order]
    ahead = own * (1 << 40)                                            # no span reaches into the next row
    reach = np.maximum.accumulate(e + ahead) - ahead
    before = np.where(np.diff(own, prepend=-1) == 0, np.append(0, reach[:-1]), 0)
    return np.bincount(own, np.maximum(e - np.maximum(s, before), 0), n).astype(np.int64)


def spans_of(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", words: int = 0) -> DataFrame:
    """One row per document: id, text (UTF-8 bytes; null: empty), spans: overlapping byte ranges [s, e) covered by strings
    of `length` bytes that start somewhere else too, null if there are none; with `words` also passages, as in repeats().

    Copies of a row are places of their own, so repeated rows repeat each other. Texts shorter than `length`, empty
    and null ones have no spans; ids may be null; further columns are ignored; an empty table gives an empty one."""
    store = Store(docs.sparkSession, "substrings")
    rows = keyed(docs, id_col, text_col)
    found = repeats(rows, store, length, words=words)
    return rows.join(found, ["k1", "k2"], "left").select(F.col("id").alias(id_col), "text", *found.columns[2:])


def deduplicated(docs: DataFrame, length: int = LENGTH, words: int = 0) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of what is left).

    With `words` also n_repeated: the bytes that passages of `length` bytes or of `words` words cover which occur twice. Those of
    words are only told, not removed."""

    def run(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
                data, runs = text.as_py(), merged(spans)
                out.append((len(data), sum(e - s for s, e in runs), len(runs), hashlib.sha256(without(data, runs)).hexdigest()))
            cols = list(zip(*out)) if out else [()] * 4
            told = [pa.array(_covered(batch.num_rows, batch.column("spans"), batch.column("passages")))] if words else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()), *told],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated"][:5 + bool(words)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return spans_of(docs, length, words=words).mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", n_repeated bigint" * bool(words))
