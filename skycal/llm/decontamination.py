"""Benchmark decontamination by latent semantic retrieval: TF-IDF passages of all documents are projected on the leading
right singular vectors of a distributed randomised decomposition, benchmark items look for passages by cosine, and
longest common subsequences and answers tell leaks and paraphrases from chance."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skycal.llm.shared import Store

WORD_IDS = 1 << 16     # hashed words, kept in two bytes
TERMS = 1 << 13        # terms of the matrix: the low bits of a word
PASSAGE = 32           # words of a passage of the matrix
SKETCH = 384           # rows of the sketch
RANK = 128             # singular vectors kept
FOLDED = 8             # partitions that a task folds into its sketch
WINDOWS = (8, 16, 24, 32, 40, 48, 56, 64)      # words of the passages, of which an item looks at the size closest to its own
SHIFT = 4              # a passage begins after each such part of the one before
CANDIDATE = 0.45       # cosine of a candidate: paraphrases that only just share PARAPHRASE of an item have less than that share
SURE = 0.8             # share of an item in its longest common subsequence with a passage that is a leak
PARAPHRASE = 0.6       # share from which the answer decides
ANSWER = 0.9           # share of the answer that has to be there
LEAST_WORDS = 5        # items below are too short to be told from chance
CHUNK = 2 * math.lcm(*(w // SHIFT for w in WINDOWS))     # words projected at once: whole shifts, so that no cut moves a passage
TEXTS = 64             # texts that are searched at once
ITEM_BLOCK = 20_000    # items that one pass looks for
_BASE = 0x9E3779B97F4A7C15
_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


_PART = 1 << 20        # bytes of a text whose words are hashed at once
_SHORT = 1 << 14       # bytes of texts that are hashed together


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(2 * _PART, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _hashed(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16 bits of a polynomial hash of every word of some folded bytes, by prefix sums, and where each begins."""
    edge = np.flatnonzero(np.diff(data != 32, prepend=False, append=False))
    start, end, (up, down) = edge[::2], edge[1::2], _powers()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(7)) * up[: len(data)], out=sums[1:])
    value = (sums[end] - sums[start]) * down[start]
    value = (value ^ (value >> np.uint64(32))) * np.uint64(_BASE)
    return (value >> np.uint64(48)).astype(np.uint16), start


def word_ids(text: bytes | None) -> np.ndarray:
    """Words are runs of letters and digits of a lowered text; every byte from 128 on counts as a letter."""
    folded, parts, at = (text or b"").translate(_FOLD), [], 0
    while at < len(folded):
        end = at + _PART if at + _PART < len(folded) else len(folded)
        if end < len(folded):
            cut = folded.rfind(b" ", at, end)
            end = cut if cut > at else end
        parts.append(_hashed(np.frombuffer(folded, np.uint8, end - at, at))[0])
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint16)


def all_word_ids(texts: list[bytes | None]) -> list[np.ndarray]:
    """word_ids() of each text; short texts are hashed together."""
    out, held, size = [], [], 0

    def told() -> list[np.ndarray]:
        ids, start = _hashed(np.frombuffer(b" ".join(held).translate(_FOLD), np.uint8))
        return np.split(ids, np.searchsorted(start, np.cumsum([len(t) + 1 for t in held])[:-1]))

    for text in texts:
        if len(text or b"") >= _SHORT or size >= _SHORT:
            out += told() if held else []
            held, size = [], 0
        if len(text or b"") >= _SHORT:
            out.append(word_ids(text))
        else:
            held.append(text or b"")
            size += len(held[-1])
    return out + (told() if held else [])


def tokenised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h: hash of the text, words: two bytes each) of every document."""

    def run(batches):
        for batch in batches:
            words = [ids.tobytes() for ids in all_word_ids(batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(words, pa.binary())], names=[id_col, "h", "words"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.xxhash64(text_col).alias("h"), F.lower(text_col).cast("binary").alias("_t")).mapInArrow(
        run, f"`{id_col}` {kind}, h bigint, words binary")


def _terms(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Terms of some documents and the passage that each is in."""
    words = [np.frombuffer(r, np.uint16) for r in rows if r]
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.array([len(w) for w in words])
    before = np.cumsum(-(-sizes // PASSAGE)) - (-(-sizes // PASSAGE))
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.concatenate(words).astype(np.int64) % TERMS, np.repeat(before, sizes) + place // PASSAGE


def _some(batches, words: int = 1 << 19):
    """Lists of rows, words first, that have about so many words together."""
    held, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            held.append(row)
            size += len(row[0]) // 2
            if size >= words:
                yield held
                held, size = [], 0
    if held:
        yield held


def inverse_frequencies(tokens: DataFrame) -> np.ndarray:
    """log(passages / passages with the term), less 1 so that the commonest terms weigh nothing; of all passages."""

    def run(batches):
        total = np.zeros(TERMS + 1, np.int64)
        for rows in _some(batches):
            term, passage = _terms([words for words, in rows])
            if len(term):
                # one row of words for each passage, sorted: a term counts where it differs from the one before
                square = np.full((passage[-1] + 1, PASSAGE), TERMS, np.uint16)
                begins = np.flatnonzero(np.diff(passage, prepend=-1))
                square[passage, np.arange(len(term)) - begins[passage]] = term
                square.sort(axis=1)
                new = np.diff(square, axis=1, prepend=np.uint16(TERMS + 1)) != 0
                total[:TERMS] += np.bincount(square[new], minlength=TERMS + 1)[:TERMS]
                total[TERMS] += passage[-1] + 1
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(total[k])], names=["k", "n"])

    total = np.zeros(TERMS + 1)
    for r in tokens.select("words").mapInArrow(run, "k int, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect():
        total[r.k] = r.n
    return np.maximum(np.log((total[TERMS] + 1) / (total[:TERMS] + 1)) - 1, 0)


def _added(group: pa.Table) -> pa.Table:
    total = np.zeros(TERMS)
    for term, value in zip(group.column("term"), group.column("value")):
        total[np.frombuffer(term.as_py(), np.uint16)] += np.frombuffer(value.as_py(), np.float32)
    return pa.table({"row": group.column("row")[:1], "salt": pa.array([0], pa.int32()), **_sparse(total)})


def _sparse(total: np.ndarray) -> dict:
    k = np.flatnonzero(total)
    return {"term": pa.array([k.astype(np.uint16).tobytes()], pa.binary()), "value": pa.array([total[k].astype(np.float32).tobytes()], pa.binary())}


def right_singular_vectors(tokens: DataFrame, idf: np.ndarray, rank: int = RANK, sketch: int = SKETCH, seed: int = 1) -> np.ndarray:
    """(TERMS, rank) leading right singular vectors of the TF-IDF matrix of all passages, each divided by its singular
    value. A sparse sign matrix folds the passages into `sketch` rows, partition by partition; the sums of these rows,
    whose size does not grow with the documents, are decomposed. Row and sign of a passage come from a hash of its
    document's id and text and its place there, so the result does not depend on how documents are dealt to tasks,
    but for the order in which doubles are added. FOLDED partitions are folded by one task, if all cores have one then, since each
task hands on a whole sketch; if there are many, as many groups add up the tasks' rows as each has rows to add."""
    tasks = tokens.rdd.getNumPartitions()
    tasks = min(tasks, max(tokens.sparkSession.sparkContext.defaultParallelism, -(-tasks // FOLDED)))
    salts = max(64, math.isqrt(tasks) + 1)

    def run(batches):
        part = TaskContext.get().partitionId()
        total = np.zeros(sketch * TERMS)
        for pairs in _some(batches):
            term, passage = _terms([words for words, _ in pairs])
            if len(term):
                counts = [-(-len(words) // (2 * PASSAGE)) for words, _ in pairs]
                place = np.concatenate([np.arange(c) for c in counts]).astype(np.uint64)
                key = np.repeat(np.array([k for _, k in pairs], np.int64).view(np.uint64), counts)
                mixed = (key ^ (place + np.uint64(seed)) * np.uint64(_BASE)) * np.uint64(0xC2B2AE3D27D4EB4F)
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(_BASE)
                mixed ^= mixed >> np.uint64(32)
                row, sign = (mixed % np.uint64(sketch)).astype(np.int64), np.where(mixed >> np.uint64(63), 1.0, -1.0)
                total += np.bincount(row[passage] * TERMS + term, weights=sign[passage] * idf[term], minlength=sketch * TERMS)
        for r, own in enumerate(total.reshape(sketch, TERMS)):
            if own.any():
                cols = _sparse(own)
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([part % salts], pa.int32()), cols["term"], cols["value"]],
                                                 names=["row", "salt", "term", "value"])

    schema = "row int, salt int, term binary, value binary"
    parts = tokens.select("words", F.xxhash64(tokens.columns[0], "h").alias("key")).coalesce(tasks).mapInArrow(run, schema)
    if tasks > salts:
        parts = parts.groupBy("row", "salt").applyInArrow(_added, schema)
    folded = parts.groupBy("row").applyInArrow(_added, schema)
    matrix = np.zeros((sketch, TERMS))
    for r in folded.collect():
        matrix[r.row, np.frombuffer(r.term, np.uint16)] = np.frombuffer(r.value, np.float32)
    values, left = np.linalg.eigh(matrix @ matrix.T)
    values, left = values[::-1][:rank], left[:, ::-1][:, :rank]
    use = values > 1e-9 * max(values[0], 1e-30)
    return matrix.T @ left[:, use] / values[use]


def masks_of(item: np.ndarray) -> dict[int, int]:
    """For each word of an item, a bit at each of its places."""
    masks: dict[int, int] = {}
    for k, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << k
    return masks


def lcs(item: np.ndarray, words: np.ndarray, masks: dict[int, int] | None = None) -> int:
    """Length of the longest common subsequence, bit-parallel over the item."""
    masks = masks_of(item) if masks is None else masks
    met = [masks[w] for w in words.tolist() if w in masks]
    full = (1 << len(item)) - 1
    state = full
    for m in met:
        u = state & m
        state = ((state + u) | (state - u)) & full
    return len(item) - state.bit_count()


@dataclass
class Item:
    item_id: int
    words: np.ndarray
    answer: np.ndarray

    def __post_init__(self) -> None:
        self.masks = masks_of(self.words)


def items_of(rows: list[tuple[int, str | None]]) -> list[Item]:
    """Parts of at most WINDOWS[-1] words. The answer of an item is its last sentence of three words or more."""
    out = []
    for item_id, text in rows:
        text = (text or "").lower()
        words = word_ids(text.encode("utf-8", "surrogatepass"))
        sentences = [s for s in re.split(r"[.!?]+\s*", text) if len(s.split()) >= 3]
        answer = word_ids(sentences[-1].encode("utf-8", "surrogatepass")) if sentences else words
        for k in range(0, len(words), WINDOWS[-1]):
            part = words[k:k + WINDOWS[-1]]
            if len(part) >= LEAST_WORDS:
                out.append(Item(item_id, part, answer[-WINDOWS[-1]:]))
    return out


@dataclass
class Retrieval:
    """Projected items by window size, their words (filled up with a word that is none), and the table that projects words."""

    items: dict[int, list[Item]]
    table: np.ndarray
    vectors: dict[int, np.ndarray]
    words: dict[int, np.ndarray]
    sizes: dict[int, np.ndarray]

    @classmethod
    def of(cls, items: list[Item], table: np.ndarray) -> Retrieval:
        by: dict[int, list[Item]] = {w: [] for w in WINDOWS}
        for item in items:
            by[min(WINDOWS, key=lambda w: abs(w - len(item.words)))].append(item)
        by = {w: own for w, own in by.items() if own}
        unit = lambda v: v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
        filled = lambda i: np.append(i.words.astype(np.int64), np.full(WINDOWS[-1] - len(i.words), WORD_IDS))
        return cls(by, np.append(table, np.zeros((1, table.shape[1]), np.float32), axis=0),
                   {w: unit(np.stack([table[i.words % TERMS].sum(axis=0) for i in own])) for w, own in by.items()},
                   {w: np.stack([filled(i) for i in own]) for w, own in by.items()},
                   {w: np.array([len(i.words) for i in own]) for w, own in by.items()})

    def near(self, texts: list[np.ndarray]):
        """For some texts at a time and each window size: (size, numbers of texts, numbers of items, first words, cosines) of all
        passages close to an item."""
        held, size = [], 0
        for number, words in enumerate(texts):
            least = max(len(words) - WINDOWS[-1] // 2, 1)
            for at in range(0, least, CHUNK):
                own = words[at:at + CHUNK + WINDOWS[-1]]
                if len(own):
                    held.append((number, at, at + CHUNK >= least, own))
                    size += len(own)
                if size >= CHUNK:
                    yield from self._near(held)
                    held, size = [], 0
        if held:
            yield from self._near(held)

    def _near(self, held: list[tuple[int, int, bool, np.ndarray]]):
        """near() of parts of texts: (number of the text, first word, is it the last part, words)."""
        step = math.gcd(*(w // SHIFT for w in self.vectors))
        number, at, last, size = (np.array(c) for c in zip(*((n, a, z, -(-len(own) // step)) for n, a, z, own in held)))
        # sums of `step` words; what is missing at the end of a part, and all past it, is words without weight
        room = size + max(self.vectors) // step
        begin = np.cumsum(room) - room
        flat = np.full(room.sum() * step, TERMS, np.uint16)
        for b, (*_, own) in zip((begin * step).tolist(), held):
            np.remainder(own, TERMS, out=flat[b:b + len(own)])
        square = flat.reshape(-1, step)
        sums = np.take(self.table, square[:, 0], axis=0, mode="clip")      # every number is a row: no check, no copy
        for j in range(1, step):
            sums += np.take(self.table, square[:, j], axis=0, mode="clip")
        for w, vectors in self.vectors.items():
            n, move = w // step, w // step // SHIFT
            count = np.where(last, -(-np.maximum(1, size - n // 2) // move), CHUNK // (move * step))
            # A window is SHIFT shifts, of which each is part of SHIFT windows; the last windows reach past the end of their part.
            shifts = count + SHIFT - 1
            part = np.repeat(np.arange(len(held)), shifts)
            place = np.arange(len(part)) - np.repeat(np.cumsum(shifts) - shifts, shifts)
            first = begin[part] + place * move
            parts = np.take(sums, first, axis=0, mode="clip")
            for j in range(1, move):
                parts += np.take(sums, first + j, axis=0, mode="clip")
            two = parts[1:] + parts[:-1]
            passages = two[:-2] + two[2:]
            least = np.sqrt(np.einsum("ij,ij->i", passages, passages))
            np.maximum(least, 1e-9, out=least)
            close = passages @ vectors.T
            p, j = np.divmod(np.flatnonzero(close >= CANDIDATE * least[:, None]), len(vectors))
            inside = place[p] < count[part[p]]                             # others begin in one part and end in the next
            p, j = p[inside], j[inside]
            if len(p):
                yield w, number[part[p]], j, at[part[p]] + place[p] * (move * step), close[p, j] / least[p]

    def candidates(self, words: np.ndarray):
        """near() of one text, without its number."""
        for w, _, j, first, cosine in self.near([words]):
            yield w, j, first, cosine

    def leaks(self, texts: list[np.ndarray]) -> list[list[tuple[int, float, float, bool, int]]]:
        """For each text, (item, overlap, cosine, answer found, first word) of the best passage for each item that leaks."""
        best: list[dict[int, tuple]] = [{} for _ in texts]
        there, flags = np.zeros((len(texts), WORD_IDS + 1), bool), np.zeros(WORD_IDS, bool)
        for own, words in zip(there, texts):
            own[words] = True
        for w, text, j, first, cosine in self.near(texts):
            # An item can have a long enough subsequence only where enough of its words are: in the text, then in the passage.
            pairs, which = np.unique(text * len(self.items[w]) + j, return_inverse=True)
            number, item_no = np.divmod(pairs, len(self.items[w]))
            enough = there[number[:, None], self.words[w][item_no]].sum(axis=1) >= PARAPHRASE * self.sizes[w][item_no]
            for pair in np.flatnonzero(enough).tolist():
                item, own, words, found = self.items[w][item_no[pair]], np.flatnonzero(which == pair), texts[number[pair]], best[number[pair]]
                low, high = np.maximum(first[own] - w // 2, 0), np.minimum(first[own] + w + w // 2, len(words))
                start, end = int(low.min()), int(high.max())
                flags[item.words] = True
                met = np.zeros(end - start + 1, np.int64)
                np.cumsum(flags[words[start:end]], out=met[1:])
                flags[item.words] = False
                for k in np.flatnonzero(met[high - start] - met[low - start] >= PARAPHRASE * len(item.words)).tolist():
                    at, near, around = int(first[own[k]]), float(cosine[own[k]]), words[low[k]:high[k]]
                    overlap = lcs(item.words, around, item.masks) / len(item.words)
                    if overlap >= PARAPHRASE:
                        answered = lcs(item.answer, around) >= ANSWER * len(item.answer)
                        if (overlap >= SURE or answered) and (overlap, near) > found.get(item.item_id, (0, 0, 0))[:2]:
                            found[item.item_id] = (overlap, near, answered, at)
        return [[(i, *b) for i, b in found.items()] for found in best]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item that it holds or paraphrases: id, item_id, overlap (share of the item in
    order in the passage), cosine, answer_found, at (first word of the passage), h (hash of the text).

    Statistics and the decomposition are of all passages of all documents, and every passage is compared with every
    item; items are a query set, of which each pass takes ITEM_BLOCK. An item of fewer than LEAST_WORDS words, null or
    empty is not looked for; of one longer than 64 words every part is. Null and empty texts leak nothing; repeated rows give
    their rows again; null ids are carried; further columns are ignored; without documents or items there is no row."""
    spark = docs.sparkSession
    store = Store(spark, "decontamination")
    tokens = store.put(tokenised(docs, id_col, text_col), "tokens")
    idf = inverse_frequencies(tokens)
    table = (right_singular_vectors(tokens, idf) * idf[:, None]).astype(np.float32)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, item_id bigint, overlap double, cosine double, answer_found boolean, at bigint, h bigint"
    names = [id_col, "item_id", "overlap", "cosine", "answer_found", "at", "h"]
    kinds = [pa.int64(), pa.float64(), pa.float64(), pa.bool_(), pa.int64()]

    def search(shared):
        def run(batches):
            retrieval = shared.value
            for batch in batches:
                texts = [np.frombuffer(words, np.uint16) for words in batch.column(2).to_pylist()]
                out = [(row, *leak) for k in range(0, len(texts), TEXTS)
                       for row, leaks in enumerate(retrieval.leaks(texts[k:k + TEXTS]), k) for leak in leaks]
                cols = list(zip(*out)) if out else [()] * 6
                rows = pa.array(cols[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), *(pa.array(c, t) for c, t in zip(cols[1:], kinds)), batch.column(1).take(rows)], names=names)
        return run

    rows = [(r.item_id, r.text) for r in benchmark.select(F.col("item_id").cast("bigint"), F.col("text")).orderBy("item_id", "text").collect()]
    found = spark.createDataFrame([], schema)
    for k in range(0, len(rows), ITEM_BLOCK):
        retrieval = Retrieval.of(items_of(rows[k:k + ITEM_BLOCK]), table)
        if retrieval.vectors and table.any():
            found = found.unionByName(tokens.mapInArrow(search(spark.sparkContext.broadcast(retrieval)), schema))
    return found
