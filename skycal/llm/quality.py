"""Quality scores by co-training: a classifier of the text and one of the metadata teach each other with confident
pseudo-labels, then their calibrated views are combined."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skycal.llm.shared import Store

BINS = 16              # values of a text feature
TEXT_FEATURES = 15
SOURCE_BINS, LANG_BINS, LENGTH_BINS = 256, 64, 40
SIZES = [[BINS] * TEXT_FEATURES, [SOURCE_BINS, LANG_BINS, LENGTH_BINS]]      # bins of the features of each view
ROUNDS = 3
SURE = 0.95            # calibrated probability from which a view teaches the other
PSEUDO_WEIGHT = 0.25   # of a pseudo-label against a given one
SCORE_BINS = 64        # of a view's log odds, for calibration
SCORE_LIMIT = 16.0
SMOOTH = 0.5

_KIND = np.zeros(0x10000, dtype=np.int8)      # 1 lower or uncased letter, 2 upper, 3 digit, 4 space, 5 end of sentence, 6 !, 7 | and other signs
for _c in range(0x10000):
    _s = chr(_c)
    _KIND[_c] = 2 if _s.isupper() else 1 if _s.isalpha() else 3 if _s.isdigit() else 4 if _s.isspace() else 5 if _s in ".,;:?'\"-()" else 6 if _s == "!" else 7


def _bin(x: float) -> int:
    return min(BINS - 1, max(0, int(x * BINS)))


def text_features(text: str | None) -> list[int]:
    """Bins of shares and means over the whole text; an empty text has bin 0 everywhere."""
    if not text:
        return [0] * TEXT_FEATURES
    counts = np.zeros(8)
    for k in range(0, len(text), 1 << 20):
        codes = np.frombuffer(text[k:k + (1 << 20)].encode("utf-32-le", "surrogatepass"), "<u4")
        counts += np.bincount(_KIND[np.minimum(codes, 0xFFFF)], minlength=8)
    n, letters = len(text), counts[1] + counts[2]
    words = text.split()
    seen = Counter(words)
    m = max(len(words), 1)
    lines = [x for x in text.split("\n") if x]
    return [
        _bin(counts[2] / max(letters, 1)), _bin(8 * counts[7] / n), _bin(8 * counts[3] / n), _bin(2 * counts[4] / n), _bin(8 * counts[5] / n),
        _bin(8 * counts[6] / n), _bin((n - counts[4]) / m / 16), _bin(len(seen) / m), _bin(2 * max(seen.values(), default=0) / m),
        _bin(2 * sum(a == b for a, b in zip(words, words[1:])) / m), _bin(2 * sum(not w[-1].isalnum() for w in words) / m),
        _bin(math.log2(1 + n / max(len(lines), 1)) / 16), _bin(len(set(lines)) / max(len(lines), 1) - 1e-9),
        _bin(2 * sum(not any(map(str.isalpha, w)) for w in seen) / max(len(seen), 1)), _bin(math.log2(1 + m) / 20)]


def metadata_features(source: str | None, lang: str | None, n_chars: int | None) -> list[int]:
    hashed = lambda x, n: 0 if x is None else 1 + zlib.crc32(str(x).encode("utf-8", "surrogatepass")) % (n - 1)
    length = 0 if n_chars is None or n_chars < 0 else 1 + min(LENGTH_BINS - 2, int(2 * math.log2(1 + n_chars)))
    return [hashed(source, SOURCE_BINS), hashed(lang, LANG_BINS), length]


@dataclass
class View:
    """Log odds of every bin of every feature, and calibrated probabilities of bins of their sum."""

    odds: list[np.ndarray]
    calibrated: np.ndarray

    def bins(self, features: np.ndarray) -> np.ndarray:
        total = sum(t[features[:, k]] for k, t in enumerate(self.odds))
        return np.clip((total / SCORE_LIMIT + 1) / 2 * SCORE_BINS, 0, SCORE_BINS - 1).astype(int)


def _odds(counts: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """Naive Bayes from weighted counts (2 classes, all bins of a view)."""
    out, at = [], 0
    for n in sizes:
        own = counts[:, at:at + n] + SMOOTH
        share = own / own.sum(axis=1, keepdims=True)
        out.append(np.log(share[1] / share[0]))
        at += n
    return out


def _rising(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Share of good rows by score bin, made monotone by pooling neighbours that are out of order. A pool counts one
    more row, split as all rows are; a bin without rows has the share of the next one below it, or else above."""
    prior = (good.sum() + 1) / (good.sum() + bad.sum() + 2)
    pools: list[tuple[float, float, int]] = []
    for k in np.flatnonzero(good + bad):
        g, b, first = good[k], bad[k], int(k)
        while pools and pools[-1][0] * b >= g * pools[-1][1]:
            g, b, first = g + pools[-1][0], b + pools[-1][1], pools.pop()[2]
        pools.append((g, b, first))
    out = np.full(len(good), np.nan)
    for g, b, first in pools:
        out[first:] = (g + prior) / (g + b + 1)
    if not pools:
        return np.full(len(good), prior)
    out[: pools[0][2]] = out[pools[0][2]]
    return np.maximum.accumulate(out)


@dataclass
class Model:
    views: list[View]
    prior: float

    def scores(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Combined, text and metadata probability of good quality."""
        p = [np.clip(v.calibrated[v.bins(f)], 1e-6, 1 - 1e-6) for v, f in zip(self.views, (text, metadata))]
        logit = lambda x: np.log(x / (1 - x))
        both = logit(p[0]) + logit(p[1]) - logit(np.clip(self.prior, 1e-6, 1 - 1e-6))
        return 1 / (1 + np.exp(-both)), p[0], p[1]


def described(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text and metadata bins, y: the given quality or null, fold: 0 fits, 1 calibrates)."""

    def run(batches):
        for batch in batches:
            text = [text_features(t) for t in batch.column(1).to_pylist()]
            meta = [metadata_features(*m) for m in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(text, pa.list_(pa.int32())), pa.array(meta, pa.list_(pa.int32()))], names=["doc_id", "text", "meta"])

    told = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(
        (F.avg("quality") >= 0.5).cast("int").alias("y"))
    rows = docs.select("doc_id", "text", "source", "lang", F.col("n_chars").cast("bigint").alias("n_chars")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text array<int>, meta array<int>")
    return rows.join(told, rows["doc_id"] == told["_id"], "left").select(
        "doc_id", "text", "meta", "y", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("fold"))


def _arrays(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    views = [np.asarray(batch.column(c).flatten()).reshape(batch.num_rows, len(s)) for c, s in zip(("text", "meta"), SIZES)]
    y = np.asarray(batch.column("y").fill_null(-1))
    return views, y, np.asarray(batch.column("fold"))


def _totals(rows: DataFrame, measure, *shape: int) -> np.ndarray:
    """The sum of an array of counts over all batches of rows: as many rows per batch as it has entries, which
    are added before they meet."""

    def run(batches):
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += measure(batch)
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(total.ravel()[k], pa.float64())], names=["k", "n"])

    out = np.zeros(int(np.prod(shape)))
    for r in rows.select("text", "meta", "y", "fold").mapInArrow(run, "k int, n double").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r.k] = r.n
    return out.reshape(shape)


def co_train(rows: DataFrame, rounds: int = ROUNDS, sure: float = SURE) -> Model:
    """Rounds of co-training over all rows of described(). Each round takes one pass: given labels of fold 0 count
    for both views; a row that one view is sure of counts for the other with PSEUDO_WEIGHT. Only counts by bin reach
    the driver. Calibration uses the labels of fold 1. Without labels of both classes every score is 0.5."""
    width = max(sum(s) for s in SIZES)

    def counted(views, classes, weights, v):
        total = np.zeros((2, width))
        at = 0
        for k, n in enumerate(SIZES[v]):
            np.add.at(total, (classes, at + views[v][:, k]), weights)
            at += n
        return total

    def gold(batch):
        views, y, fold = _arrays(batch)
        use = (y >= 0) & (fold == 0)
        return np.stack([counted([f[use] for f in views], y[use], np.ones(use.sum()), v) for v in (0, 1)])

    given = _totals(rows, gold, 2, 2, width)
    n0, n1 = given[0, :, :BINS].sum(axis=1)
    if not n0 or not n1:
        flat = View([np.zeros(n) for n in SIZES[0]], np.full(SCORE_BINS, 0.5)), View([np.zeros(n) for n in SIZES[1]], np.full(SCORE_BINS, 0.5))
        return Model(list(flat), 0.5)
    model = Model([], float(n1 / (n0 + n1)))
    pseudo = np.zeros_like(given)
    for round_ in range(rounds + 1):
        odds = [_odds(given[v] + PSEUDO_WEIGHT * pseudo[v], SIZES[v]) for v in (0, 1)]
        raw = [View(o, np.zeros(SCORE_BINS)) for o in odds]

        def checked(batch, raw=raw):
            views, y, fold = _arrays(batch)
            use, total = (y >= 0) & (fold == 1), np.zeros((2, 2, SCORE_BINS))
            for v in (0, 1):
                np.add.at(total, (v, y[use], raw[v].bins(views[v][use])), 1)
            return total

        seen = _totals(rows, checked, 2, 2, SCORE_BINS)
        model.views = [View(o, _rising(seen[v, 1], seen[v, 0])) for v, o in enumerate(odds)]
        if round_ == rounds:
            return model

        def taught(batch, own=tuple(model.views)):
            views, y, _ = _arrays(batch)
            out = []
            for v in (0, 1):
                p = own[1 - v].calibrated[own[1 - v].bins(views[1 - v])]
                use = (y < 0) & ((p >= sure) | (p <= 1 - sure))
                out.append(counted([f[use] for f in views], (p[use] >= 0.5).astype(int), np.ones(use.sum()), v))
            return np.stack(out)

        pseudo = _totals(rows, taught, 2, 2, width)


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, text_score, metadata_score) of rows of described()."""

    def run(batches):
        for batch in batches:
            views, _, _ = _arrays(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(s, pa.float64()) for s in model.scores(*views))], names=["doc_id", "score", "text_score", "metadata_score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text", "meta", "y", "fold").mapInArrow(
        run, f"doc_id {kind}, score double, text_score double, metadata_score double")


def quality(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, score (probability of good quality), text_score, metadata_score.

    Null and empty texts are scored by their own bins, null metadata too; a null id has no label; repeated rows get
    equal rows; of contradicting labels the more frequent one counts; further columns are ignored. An empty table gives
    an empty one."""
    store = Store(docs.sparkSession, "quality")
    rows = store.put(described(docs, labels), "rows")
    return scored(rows, co_train(rows, rounds))


def kept(docs: DataFrame, labels: DataFrame, least: float = 0.5, rounds: int = ROUNDS) -> DataFrame:
    """The rows of docs, all columns, whose score is at least `least`."""
    store = Store(docs.sparkSession, "quality")
    model = co_train(store.put(described(docs, labels), "rows"), rounds)
    names, schema = docs.columns, docs.schema
    places = [names.index(c) for c in ("text", "source", "lang", "n_chars")]

    def run(batches):
        for batch in batches:
            text, source, lang, n = (batch.column(k).to_pylist() for k in places)
            if batch.num_rows:
                views = np.array([text_features(t) for t in text]), np.array([metadata_features(*m) for m in zip(source, lang, n)])
                yield batch.filter(pa.array(model.scores(*views)[0] >= least))

    return docs.mapInArrow(run, schema)
