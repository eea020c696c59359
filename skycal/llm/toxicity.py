"""Toxicity scores: a Levenshtein automaton intersected with a trie of a lexicon finds toxic terms, misspelled ones
too; windows of context tell abuse from quotation; a logistic model over both gives the score."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Insults every lexicon begins with; further words and stems are learned from labelled documents.
BASE_TERMS = ("stupid", "idiot", "moron", "loser", "trash", "scum", "clown", "pathetic", "worthless", "disgusting", "dumb", "filthy",
              "vermin", "subhuman", "degenerate", "imbecile", "retard", "bastard")
REPORTING = re.compile(r"(?i)\b(said|says|wrote|writes|called|quoted?|quoting|cited?|the (word|term|phrase)|so-called)\b[^.!?\n]*$")
QUOTES = re.compile("[\"“”„«»‘’]|(?<!\\w)'|'(?!\\w)")
SAMPLE = 20_000        # labelled documents that the model is fitted on, at most about so many
MAX_TERMS = 200        # learned terms kept, and words beside their stems
STEMS = (4, 5, 6, 7, 8)      # letters of a stem
BASE_WEIGHT = 4.0      # of a base term that no labelled document speaks about
WINDOW = 32            # words of a context window
CONTEXT = 80           # characters around a term in which quotation is looked for
CHUNK = 1 << 20        # characters of a text that are classified at once
N_FEATURES = 7
PRIOR = np.array([-4.0, 3.0, 1.0, 1.0, 0.5, 1.0, -1.0])      # of the model before it has seen a label


def allowed(term: str) -> int:
    """Edits allowed in a word: none in short ones, whose neighbours are ordinary words, and none in stems."""
    return 0 if term.endswith("*") or len(term) < 5 else 1 if len(term) < 9 else 2


@dataclass
class Automaton:
    """Deterministic automaton of all words within the allowed edits of a term, and all words that begin with
    a stem. A state is a set of (trie node, edits so far); its number indexes rows of `step`."""

    terms: dict[str, float]          # with their weights
    letters: dict[str, int] = field(default_factory=dict)
    step: np.ndarray = None          # state x letter class
    found: np.ndarray = None         # at the end of a word: weight of its term over 1 + edits, 0 if it is none
    exact: np.ndarray = None         # without edits
    forever: np.ndarray = None       # a stem has been read: any rest is accepted

    def __post_init__(self) -> None:
        trie: list[dict] = [{}]
        most, ends, stems = [0], {}, {}
        for term in self.terms:
            node = 0
            for c in term.rstrip("*"):
                if c not in trie[node]:
                    trie[node][c] = len(trie)
                    trie.append({})
                    most.append(0)
                most[node] = max(most[node], allowed(term))
                node = trie[node][c]
            most[node] = max(most[node], allowed(term))
            if term.endswith("*"):
                stems[node] = self.terms[term]
            else:
                ends[node] = (allowed(term), self.terms[term])
        self.letters = {c: k + 1 for k, c in enumerate(sorted({c for t in self.terms for c in t.rstrip("*")}))}

        def closed(items: dict[int, int]) -> frozenset:
            """With the deletions of term letters; the fewest edits for each node."""
            todo = list(items.items())
            while todo:
                node, e = todo.pop()
                for child in trie[node].values():
                    if e + 1 <= most[child] and items.get(child, 9) > e + 1:
                        items[child] = e + 1
                        todo.append((child, e + 1))
            return frozenset(items.items())

        def after(state: frozenset, c: str) -> frozenset:
            items: dict[int, int] = {}
            for node, e in state:
                nexts = [(child, e + (letter != c)) for letter, child in trie[node].items()] + [(node, e + 1)]
                for n, d in nexts:
                    if d <= most[n] and items.get(n, 9) > d:
                        items[n] = d
            return closed(items)

        # a state that has read a stem stays; state 0 is dead
        start = closed({0: 0})
        numbers, todo, rows, found, exact, forever = {frozenset(): 0, start: 1}, [frozenset(), start], [], [], [], []
        for state in todo:
            ended = [(ends[n][1] / (1 + e), e == 0) for n, e in state if n in ends and e <= ends[n][0]]
            stem = [(stems[n], True) for n, e in state if n in stems and e == 0]
            best = max(stem or ended, default=(0.0, False))
            found.append(best[0])
            exact.append(best[1])
            forever.append(bool(stem))
            row = [0] * (len(self.letters) + 1)
            for c, k in [("", 0), *self.letters.items()]:
                nxt = after(state, c) if state and not stem else frozenset()
                if nxt not in numbers:
                    numbers[nxt] = len(numbers)
                    todo.append(nxt)
                row[k] = numbers[nxt]
            rows.append(row)
        self.step, self.found, self.exact, self.forever = np.array(rows, np.int32), np.array(found), np.array(exact), np.array(forever)


_ALPHA = np.array([chr(c).isalpha() for c in range(0x10000)])
_LOWER = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in range(0x10000)], dtype=np.uint32)


def hits(text: str, automaton: Automaton) -> list[tuple[int, int, int, float, bool]]:
    """(word number, start, end, weight, without edits) of every term in the text. All words step through the automaton together."""
    classes = np.zeros(0x10000, dtype=np.int32)
    for c, k in automaton.letters.items():
        if ord(c) < 0x10000:
            classes[ord(c)] = k
    out, at, words = [], 0, 0
    while at < len(text):
        end = min(len(text), at + CHUNK)
        while end < len(text) and text[end - 1].isalpha():
            end += 1
        codes = np.frombuffer(text[at:end].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        low = np.minimum(codes, 0xFFFF)
        letter = _ALPHA[low]
        edge = np.flatnonzero(np.diff(letter, prepend=False, append=False))
        starts, ends = edge[::2], edge[1::2]
        kinds = classes[_LOWER[low]]
        live, state, result = np.arange(len(starts)), np.ones(len(starts), np.int32), np.zeros(len(starts), np.int32)
        k = 0
        while len(live):
            over = starts[live] + k >= ends[live]
            result[live[over]] = state[over]
            live, state = live[~over], state[~over]
            state = automaton.step[state, kinds[starts[live] + k]]
            stem = automaton.forever[state]
            result[live[stem]] = state[stem]
            go = (state != 0) & ~stem
            live, state, k = live[go], state[go], k + 1
        for w in np.flatnonzero(automaton.found[result]):
            state = result[w]
            out.append((words + int(w), at + int(starts[w]), at + int(ends[w]), float(automaton.found[state]), bool(automaton.exact[state])))
        words += len(starts)
        at = end
    return out


def quoted(text: str, start: int, end: int) -> bool:
    """A quotation mark on both sides in the same line, or a reporting word before the term in its sentence."""
    left = text[max(0, start - CONTEXT):start].rpartition("\n")[2]
    right = text[end:end + CONTEXT].partition("\n")[0]
    return bool((len(QUOTES.findall(left)) % 2 and QUOTES.search(right)) or REPORTING.search(left))


def features(text: str | None, automaton: Automaton) -> np.ndarray:
    out = np.zeros(N_FEATURES)
    out[0] = 1
    found = hits(text or "", automaton)
    if not found:
        return out
    said = np.array([quoted(text, s, e) for _, s, e, _, _ in found])
    place, exact = np.array([h[0] for h in found]), np.array([h[4] for h in found])
    abuse = np.where(said, 0.2, 1.0) * np.array([h[3] for h in found]) / BASE_WEIGHT
    total = np.cumsum(abuse)
    first = np.searchsorted(place, place - WINDOW, side="right")
    window = (total - np.where(first > 0, total[first - 1], 0)).max()
    forms = {text[s:e].lower() for _, s, e, _, _ in found}
    out[1:] = [abuse.max(), np.log1p(total[-1]), np.log1p(len(forms)), float(exact.any()), np.log1p(window), said.mean()]
    return out


def objective(x: np.ndarray, y: np.ndarray, w: np.ndarray, prior: np.ndarray, strength: float) -> float:
    """Negative log-likelihood, and the pull to the prior weights."""
    z = x @ w
    return float(np.logaddexp(0, np.where(y > 0.5, -z, z)).sum() + strength / 2 * ((w - prior) ** 2).sum())


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: float = 1.0) -> np.ndarray:
    """Newton's method, drawn to the prior weights: without rows these are the result. Each step is halved until the
    objective falls by a share of what its slope promises, as full steps diverge where classes are nearly separable."""
    w = prior.copy()
    now = start = objective(x, y, w, prior, strength)
    for _ in range(100):
        p = np.exp(-np.logaddexp(0, -(x @ w)))
        gradient = x.T @ (p - y) + strength * (w - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w))
        move = np.linalg.solve(hessian, gradient)
        size, slope = 1.0, float(gradient @ move)
        while size > 1e-10 and objective(x, y, w - size * move, prior, strength) > now - 1e-4 * size * slope:
            size /= 2
        if size <= 1e-10:
            break
        w = w - size * move
        now = objective(x, y, w, prior, strength)
        if slope < 1e-9:
            break
    if now > start:
        raise ArithmeticError(f"the fit ends at {now}, above {start} at the prior weights")
    return w


def candidate_terms(text: str | None) -> set[str]:
    words = {w.lower() for w in re.findall(r"[^\W\d_]{3,}", text or "")}
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


def evidence(n: int, other: int, share: float) -> float:
    """Log-likelihood ratio of a term's own toxic share against that of all documents."""
    p = n / (n + other)
    rest = other * math.log((1 - p) / (1 - share)) if other else 0.0
    return n * math.log(p / share) + rest if p > share else 0.0


def chosen_terms(counts: list[tuple[str, int, int]], toxic: int, others: int, candidates: int) -> dict[str, float]:
    """Weights (log odds) of words and stems that mark toxic documents, from (term, toxic, other) counts. A term must
    be stronger than chance would make one of all candidates; the strongest first, what it covers or is covered by
    goes with it. But a word that a stem covers stays beside it where edits are allowed, since stems have none."""
    share = min(0.9, max(toxic, 1) / max(toxic + others, 2))
    strong = [(evidence(n, o, share), t, n, o) for t, n, o in counts if n >= 3 and n >= o]
    strong = sorted((x for x in strong if x[0] >= math.log(100 * max(candidates, 1))), key=lambda x: (-x[0], -len(x[1]), x[1]))
    covers = lambda s, t: s.endswith("*") and t.rstrip("*").startswith(s[:-1])
    kept: dict[str, float] = {}
    weight = lambda n, o: math.log((n + 0.5) / (toxic + 1) * (others + 1) / (o + 0.5))
    for _, t, n, o in strong:
        if len(kept) < MAX_TERMS and not any(covers(k, t) or covers(t, k) for k in kept):
            kept[t] = weight(n, o)
    words = [(t, weight(n, o)) for _, t, n, o in strong if t not in kept and allowed(t) and any(covers(k, t) for k in kept)]
    return kept | dict(words[:MAX_TERMS])


@dataclass
class Model:
    automaton: Automaton
    weights: np.ndarray

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(features(text, self.automaton) @ self.weights, -30, 30))))


def fit(labelled: DataFrame, sample: int = SAMPLE, text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learns terms and weights from a sample of distinct labelled texts, about `sample` of them. Texts stay on the
    executors: counts of candidate terms and one row of features for each sampled text come back."""
    rows = labelled.where(F.col(label_col).isin(0, 1)).select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("y"))
    n = rows.count()
    rows = rows.withColumn("h", F.xxhash64("text"))
    if n > sample:
        rows = rows.where(F.pmod(F.col("h"), F.lit(1 << 20)) < F.lit(int((1 << 20) * sample / n)))
    rows = rows.repartition(F.col("h"))

    def toxic_terms(batches):
        for batch in batches:
            sets = [candidate_terms(t) for t, y, first in zip(*(c.to_pylist() for c in batch.columns)) if y == 1 and first]
            yield pa.RecordBatch.from_arrays([pa.array([t for s in sets for t in s], pa.string())], names=["term"])

    once = rows.withColumn("first", F.row_number().over(Window.partitionBy("h", "y").orderBy("y")) == 1).select("text", "y", "first")
    sizes = {r.y: r.n for r in once.where("first").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, docs = sizes.get(1, 0), sum(sizes.values())
    support = once.mapInArrow(toxic_terms, "term string").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    candidates = support.count()
    least = max(3, math.log(100 * max(candidates, 1)) / -math.log(min(0.9, max(toxic, 1) / max(docs, 2))))
    seen = {r.term: r.n for r in support.where(F.col("n") >= least).orderBy(F.desc("n"), "term").limit(100 * MAX_TERMS).collect()}

    def other_counts(batches):
        totals = dict.fromkeys(seen, 0)
        for batch in batches:
            for text, y, first in zip(*(c.to_pylist() for c in batch.columns)):
                if y == 0 and first:
                    for t in candidate_terms(text) & totals.keys():
                        totals[t] += 1
        hit = [(t, n) for t, n in totals.items() if n]
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in hit], pa.string()), pa.array([n for _, n in hit], pa.int64())], names=["term", "n"])

    other = {r.term: r.n for r in once.mapInArrow(other_counts, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    terms = chosen_terms([(t, c, other.get(t, 0)) for t, c in seen.items()], toxic, docs - toxic, candidates)
    automaton = Automaton(dict(sorted((dict.fromkeys(BASE_TERMS, BASE_WEIGHT) | terms).items())))

    def measured(batches):
        for batch in batches:
            texts, ys, firsts = (c.to_pylist() for c in batch.columns)
            keep = [(features(t, automaton), y) for t, y, f in zip(texts, ys, firsts) if f]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keep], pa.list_(pa.float64())), pa.array([k[1] for k in keep], pa.int32())], names=["x", "y"])

    told = once.mapInArrow(measured, "x array<double>, y int").collect()
    x = np.array([r.x for r in told]).reshape(-1, N_FEATURES)
    return Model(automaton, fit_logistic(x, np.array([r.y for r in told], dtype=float), PRIOR))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every document; null and empty texts get the score of a text without terms."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([model.score(t) for t in batch.column(1).to_pylist()], pa.float64())], names=[id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out (crc32 of its id mod folds is `held`: its label is not learned from),
    score, predicted (1 from 0.5 on).

    Null and empty texts are scored; a null id is never held out nor labelled; repeated rows get equal rows; null
    labels don't count. Without labels the base terms and prior weights score alone. An empty table gives an empty
    one; further columns are ignored."""
    fold = lambda c: F.pmod(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(folds))
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_toxic")).where(
        F.col("_toxic").isNotNull() & F.col("_id").isNotNull()).where(fold("_id") != held).distinct()
    n = known.count()
    if n > 2 * sample:      # the sample of ids is bounded, so that texts need not be moved to find it
        known = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < F.lit(int((1 << 20) * 2 * sample / n)))
    labelled = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id")).select(
        "text", F.col("_toxic").alias("toxic"))
    model = fit(labelled, sample)
    return scores(docs, model).select(
        "doc_id", F.coalesce(fold("doc_id") == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
