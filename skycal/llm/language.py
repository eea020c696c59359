"""Language identification by a bidirectional gated recurrent network over bytes, trained in numpy by
backpropagation through time. Every position is labelled; a document's probabilities are pooled from them."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HIDDEN = 8
SEGMENT = 128          # bytes read from an empty state, in both directions; a text is read as a whole, segment by segment
BATCH = 2048           # segments that step together: always so many, as matrix products of other shapes round otherwise
TRAIN_SEGMENT = 64
PER_LANGUAGE = 1500    # documents of a language that the network is fitted on, about
PER_DOCUMENT = 2       # segments of such a document
EPOCHS = 8
LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Network:
    """For each direction: w (256 x 3H, update, reset and candidate input of a byte), u (H x 3H), and out (2H x L), bias (L).
    Gates are 0.5 + 0.5 tanh(x), so that only one transcendental function is needed."""

    languages: list[str]
    w: list[np.ndarray]
    u: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 1, hidden: int = HIDDEN) -> Network:
        rng, f = np.random.default_rng(seed), np.float32
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(f)
        return cls(languages, [draw(256, 3 * hidden) for _ in "fb"], [draw(hidden, 3 * hidden) for _ in "fb"],
                   draw(2 * hidden, len(languages)), np.zeros(len(languages), f))

    @property
    def hidden(self) -> int:
        return self.u[0].shape[0]

    def states(self, x: np.ndarray, way: int, keep: list | None = None) -> np.ndarray:
        """States (T, B, H) after each byte of x (T, B), read forwards (way 0) or backwards."""
        t_max, b = x.shape
        n, w, u = self.hidden, self.w[way], self.u[way]
        h, out = np.zeros((b, n), np.float32), np.empty((t_max, b, n), np.float32)
        for t in range(t_max) if way == 0 else range(t_max - 1, -1, -1):
            a, g = w[x[t]], h @ u
            zr = np.tanh(a[:, :2 * n] + g[:, :2 * n])
            zr *= 0.5
            zr += 0.5
            z, r, q = zr[:, :n], zr[:, n:], g[:, 2 * n:]
            c = np.tanh(a[:, 2 * n:] + r * q)
            if keep is not None:
                keep.append((t, h, z, r, q, c))
            h = h + z * (c - h)
            out[t] = h
        return out

    def probabilities(self, x: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(T, B, L) label probabilities of every position, and the states they come from."""
        both = np.concatenate([self.states(x, way, keep and keep[way]) for way in (0, 1)], axis=2)
        logits = both.reshape(-1, 2 * self.hidden) @ self.out + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits.reshape(*x.shape, -1), both

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy of all positions of x (T, B) under the labels y (B), and its gradients."""
        n, keep = self.hidden, ([], [])
        p, both = self.probabilities(x, keep)
        t_max, b = x.shape
        loss = float(-np.log(np.maximum(p[:, np.arange(b), y], 1e-9)).mean())
        p[:, np.arange(b), y] -= 1
        p /= t_max * b
        d_out, d_bias = both.reshape(-1, 2 * n).T @ p.reshape(-1, p.shape[2]), p.sum(axis=(0, 1))
        d_states = p @ self.out.T
        d_w, d_u = [], []
        for way in (0, 1):
            gw, gu, dh = np.zeros_like(self.w[way]), np.zeros_like(self.u[way]), np.zeros((b, n), np.float32)
            for t, h, z, r, q, c in reversed(keep[way]):
                dh = dh + d_states[t, :, way * n:(way + 1) * n]
                dc = dh * z * (1 - c * c)
                dz = dh * (c - h) * (2 * z * (1 - z))
                dr = dc * q * (2 * r * (1 - r))
                dg = np.concatenate([dz, dr, dc * r], axis=1)
                np.add.at(gw, x[t], np.concatenate([dz, dr, dc], axis=1))
                gu += h.T @ dg
                dh = dh * (1 - z) + dg @ self.u[way].T
            d_w.append(gw)
            d_u.append(gu)
        return loss, [*d_w, *d_u, d_out, d_bias]

    def parameters(self) -> list[np.ndarray]:
        return [*self.w, *self.u, self.out, self.bias]


def train(segments: list[bytes], labels: list[str], epochs: int = EPOCHS, batch: int = 256, rate: float = 0.02, seed: int = 1) -> Network:
    """Adam over shuffled batches of segments; each batch is one pass of backpropagation through time."""
    languages = sorted(set(labels))
    net, rng = Network.fresh(languages, seed), np.random.default_rng(seed)
    x = np.stack([padded(s, TRAIN_SEGMENT) for s in segments])
    y = np.searchsorted(languages, labels)
    m, v, step = [np.zeros_like(p) for p in net.parameters()], [np.zeros_like(p) for p in net.parameters()], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for k in range(0, len(x), batch):
            own, step = order[k:k + batch], step + 1
            _, gradients = net.gradients(np.ascontiguousarray(x[own].T), y[own])
            scale = min(1.0, 1.0 / (1e-9 + np.sqrt(sum(float((g * g).sum()) for g in gradients))))
            for p, g, a, b in zip(net.parameters(), gradients, m, v):
                g = g * scale
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= rate * (1 - epoch / (epochs + 1)) * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return net


def padded(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data.ljust(size, b" "), np.uint8)


def document_probabilities(net: Network, texts: list[bytes]) -> np.ndarray:
    """(documents, languages): the mean over all bytes of a text of the probabilities of their labels."""
    out, sizes = np.zeros((len(texts), len(net.languages))), np.array([len(t) for t in texts])
    counts = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), counts)
    ends = np.cumsum(counts)
    place = np.arange(len(owner)) - np.repeat(ends - counts, counts)
    left = np.minimum(SEGMENT, sizes[owner] - place * SEGMENT)
    data = np.full(len(owner) * SEGMENT, 32, np.uint8)
    for k, t in enumerate(texts):
        at = (ends[k] - counts[k]) * SEGMENT
        data[at:at + len(t)] = np.frombuffer(t, np.uint8)
    data = data.reshape(-1, SEGMENT)
    for k in range(0, len(owner), BATCH):
        own = owner[k:k + BATCH]
        x = np.full((SEGMENT, BATCH), 32, np.uint8)
        x[:, :len(own)] = data[k:k + BATCH].T
        p = net.probabilities(x)[0][:, :len(own)]
        p[np.arange(SEGMENT)[:, None] >= left[None, k:k + BATCH]] = 0
        np.add.at(out, own, p.sum(axis=0, dtype=np.float64))
    return out / np.maximum(sizes, 1)[:, None]


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Network | None:
    """A network from about per_language documents of each language; None where none has one. Only distinct segments of
    TRAIN_SEGMENT bytes of the sampled documents reach the driver. The sample goes by id and text, so that rows of
    one id, or without any, are bounded too; repeated rows are taken together and count once."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).cast("binary").alias("text"), F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 24)).alias("h"))
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    limit = F.lit(0)
    for lang, n in sorted(counts.items()):
        limit = F.when(F.col("lang") == lang, int((1 << 24) * min(1.0, per_language / n))).otherwise(limit)

    def cut(batches):
        for batch in batches:
            out = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for k in range(PER_DOCUMENT):
                    at = (len(text) - TRAIN_SEGMENT) * (2 * k + 1) // (2 * PER_DOCUMENT) if len(text) > TRAIN_SEGMENT else 0
                    if piece := text[at:at + TRAIN_SEGMENT]:
                        out.append((lang, piece))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.binary())], names=["lang", "piece"])

    rows = known.where(F.col("h") < limit).select("lang", "text").mapInArrow(cut, "lang string, piece binary").distinct().collect()
    rows = sorted((r.lang, bytes(r.piece)) for r in rows)      # the order in which tasks end must not matter
    return train([p for _, p in rows], [g for g, _ in rows]) if rows else None


def predicted(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text", probabilities: bool = False) -> DataFrame:
    """(id, lang_pred, score) of every document, and a map of all probabilities if it is asked for."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            clear = [k for k, t in enumerate(texts) if net and t and LETTER.search(t)]
            p = document_probabilities(net, [texts[k].encode("utf-8", "surrogatepass") for k in clear]) if clear else np.zeros((0, 1))
            names, scores, maps = ["und"] * len(texts), [0.0] * len(texts), [[] for _ in texts]
            for k, row in zip(clear, p):
                names[k], scores[k] = net.languages[int(row.argmax())], float(min(1.0, row.max()))
                maps[k] = list(zip(net.languages, row.tolist()))
            arrays, columns = [batch.column(0), pa.array(names), pa.array(scores, pa.float64())], [id_col, "lang_pred", "score"]
            if probabilities:
                arrays, columns = [*arrays, pa.array(maps, pa.map_(pa.string(), pa.float64()))], [*columns, "probabilities"]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, lang_pred string, score double" + (", probabilities map<string,double>" if probabilities else ""))


def identify(docs: DataFrame, folds: int = 3, held: int = 1, per_language: int = PER_LANGUAGE) -> DataFrame:
    """One row per document: doc_id, held_out (crc32 of its id mod folds is `held`: nothing is learned from it),
    lang_pred, score.

    Null texts and texts without a letter are `und` with score 0, and so is every text if no language is known. A null
    id is never held out; repeated rows get equal rows; an empty table gives an empty one; further columns are ignored."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))
    net = fit(docs.where(F.coalesce(fold != held, F.lit(True))), per_language)
    return predicted(docs, net).select("doc_id", F.coalesce(fold == held, F.lit(False)).alias("held_out"), "lang_pred", "score")
