import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from skycal.llm import divergence as m
from skycal.llm.divergence import divergence

SCHEMA = "doc_id bigint, text string, lang string, source string, term string, n int, value bigint, rank int"
WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_force(docs, top=200):
    words = [(lang or "", source or "", WORD.findall((text or "").translate(LOWER))) for text, lang, source in docs]
    out = []
    for lang in {w[0] for w in words}:
        groups = {s: Counter() for own, s, _ in words if own == lang}
        seen = Counter()
        for own, s, terms in words:
            if own == lang:
                groups[s].update(terms)
                seen.update(set(terms))
        kept = [t for t, n in seen.items() if n >= 3]
        share = lambda c: (lambda total: {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept})(sum(c[t] for t in kept))
        p = {s: share(c) for s, c in groups.items()}
        q = share(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in groups if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(items)]
    return sorted(out)


def found(spark, docs, parts=3, **how):
    df = spark.createDataFrame([(k, t, lang, s, "x", 1, 2, 3) for k, (t, lang, s) in enumerate(docs)], SCHEMA).repartition(parts)
    return sorted(map(tuple, divergence(df, **how).select("lang", "source", "part", "item", "value", "rank").collect()))


def corpus(seed, docs=150, sources=9, words=60):
    """Words of falling frequency, some of them of one source; a third of the texts is in one source."""
    rng = random.Random(seed)
    vocabulary = [f"{rng.choice(['w', 'É', 'Wort', '漢'])}{'abcdefghij'[k % 10]}{'xyz'[k % 3] * (k // 10)}" for k in range(words)]
    weights = [1 / (k + 1) for k in range(words)]
    rows = []
    for _ in range(docs):
        source = "s0" if rng.random() < 0.34 else f"s{rng.randrange(sources)}"
        text = " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 5, 40])) + [f"only{source}".replace("0", "o")] * rng.randrange(3))
        rows.append((text, rng.choice(["en", "en", "de"]), source))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs = corpus(seed)
    assert found(spark, docs) == brute_force(docs)
    assert found(spark, docs, top=3) == brute_force(docs, top=3)


def test_small_blocks_and_flushes(spark, monkeypatch):
    for name in ("ENTRIES", "BLOCK"):
        monkeypatch.setattr(m, name, 5)
    monkeypatch.setattr(m, "CHUNK", 7)
    docs = corpus(3)
    assert found(spark, docs, 5) == brute_force(docs)


def test_odd_rows(spark):
    docs = [(None, None, None), ("", "", ""), ("word Word WORD", "en", None), ("word", "en", "a"), ("word", "en", "a"), ("word", None, "a"),
            ("É é École\x00x", "fr", "b"), ("É x", "fr", "c"), ("É x é", "fr", "d"), ("123 _ ~", "nothing", "e"), ("", "nothing", "f"),
            ("once", "rare", "g"), ("twice", "rare", "h"), ("long words " * 60_000, "en", "long"), ("x" * 3_000_000, "en", "long")]
    assert found(spark, docs) == brute_force(docs)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_ties_go_by_bytes(spark):
    docs = [(f"a{c} common", "en", s) for c in "zyx漢é" for s in ("one", "one", "one", "two")]
    rows = found(spark, docs)
    assert rows == brute_force(docs)
    assert [r[3] for r in sorted((r for r in rows if r[1] == "one" and r[2] == "pair"), key=lambda r: r[5])] == ["two"]


def test_corrections_beyond_long_integers():
    """One pair whose correction needs more than 62 bits goes by Python's integers."""
    sums = m._PairSums()
    sums.start("en")
    sums.codes = {"a": 0, "b": 1}
    f = lambda p, q: (p - q) ** 2 // q
    for terms in (3, 10**6):
        sums.add([0, 1], [10**9, 5 * 10**8], [1, 2], terms)
    sums.compute()
    one = f(10**9, 5 * 10**8) - f(10**9, 2) - f(1, 5 * 10**8) + f(1, 2)
    assert sums.sums["en", "a", "b"] == one * (10**6 + 3)


def test_shared_paths_meet_their_ancestors_once(monkeypatch):
    """Three rows of a common prefix: the prefix's nodes are combined once, with the number of all terms below."""
    import pyarrow as pa

    calls = []
    add = m._PairSums.add
    monkeypatch.setattr(m._PairSums, "add", lambda self, s, p, z, terms: (calls.append((tuple(p), terms)), add(self, s, p, z, terms))[1])
    kind = pa.list_(pa.struct([("source", pa.string()), ("p", pa.int64()), ("z", pa.int64())]))
    path = lambda *ps: [{"source": "abc"[k], "p": p, "z": 1} for k, p in enumerate(ps)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 3), pa.array([path(5, 6), path(5, 6, 7), path(5, 6, 8)], kind), pa.array([10, 1, 2])],
                                       names=["lang", "path", "terms"])
    list(m._tree(iter([batch])))
    assert sorted(calls) == [((5, 6), 13), ((5, 6, 7), 1), ((5, 6, 8), 2)]


def test_counts_are_those_of_the_texts():
    import pyarrow as pa

    texts = ["Ab ab É", "x", "ab"]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 3), pa.array(["s", "s", "t"]), pa.array(texts)], names=["lang", "source", "text"])
    total = defaultdict(lambda: np.zeros(2, dtype=int))
    for out in m._counted(iter([batch])):
        for r in out.to_pylist():
            total[r["source"], r["term"]] += [r["n"], r["docs"]]
    assert {k: tuple(v) for k, v in total.items()} == {
        ("s", None): (0, 0), ("t", None): (0, 0), ("s", "ab"): (2, 1), ("s", "É"): (1, 1), ("s", "x"): (1, 1), ("t", "ab"): (1, 1)}
