import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from skycal.llm import substrings as sub
from skycal.llm import suffixes

SCHEMA = "doc_id bigint, text string, spans int, k1 string, anchor string"


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    counts = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - length + 1):
            if counts[t[p:p + length]] > 1:
                gone[p:p + length] = True
        left = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, length):
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in sub.deduplicated(df, length).collect()), key=repr)


def test_suffixes_find_every_repeat(tmp_path):
    rng = random.Random(1)
    for _ in range(300):
        length, symbols = rng.choice([1, 2, 3, 5, 8, 13]), rng.choice([b"a", b"ab", b"abc", b"abcdefgh\x00\xff"])
        base = [bytes(rng.choice(symbols) for _ in range(rng.randint(0, 40))) for _ in range(3)]
        strings = []
        for _ in range(rng.randint(1, 6)):
            x, y = rng.choice(base), rng.choice(base)
            strings.append(x[:rng.randint(0, len(x))] + y[rng.randint(0, len(y)):] if rng.random() < 0.7 else x)
        counts = Counter(s[i:i + length] for s in strings for i in range(len(s) - length + 1))
        want = [[counts[s[i:i + length]] > 1 for i in range(len(s) - length + 1)] for s in strings]
        # with no memory at all every tuple goes through the files
        assert [x.tolist() for x in suffixes.repeated(strings, length, memory=rng.choice([0, 1 << 20]))] == want


def texts(seed, n=60):
    rng = random.Random(seed)
    prose = lambda k: "".join(rng.choice("abcdé \n") for _ in range(k))
    passages = [prose(k) for k in (39, 40, 41, 90, 400)]
    rows = []
    for k in range(n):
        text = prose(rng.randint(0, 200))
        for _ in range(rng.choice([0, 1, 1, 2])):
            at = rng.randint(0, len(text))
            text = text[:at] + rng.choice(passages) + text[at:]
        rows.append((k, text))
    near = list(prose(600))
    for k in range(25):
        own = near[:]
        own[rng.randrange(600)] = "#"
        rows.append((100 + k, "".join(own)))
    return rows + [(200, "a" * 500), (201, "b" * 40), (202, "c" * 39), (203, "ab" * 100), (204, "x" * 79 + "y"), (None, prose(300)), (205, None), (206, ""),
                   (207, "tail " * 3000), (208, rows[3][1]), (3, rows[3][1]), (3, rows[3][1]), (209, "\x00" * 90)]


@pytest.mark.parametrize("hot", [4096, 3])
def test_the_same_bytes_go_as_by_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(sub, "SHARD", 2000)
    monkeypatch.setattr(sub, "CHUNK", 3000)
    monkeypatch.setattr(sub.repeats, "__defaults__", (sub.LENGTH, hot))
    rows = texts(hot)
    assert run(spark, rows, 40) == brute(rows, 40)


def test_four_hundred_bytes(spark):
    rng = random.Random(9)
    prose = lambda k: "".join(rng.choice("abcdefgh é\n") for _ in range(k))
    shared = [prose(k) for k in (380, 399, 400, 1000)]
    rows = [(k, prose(rng.randint(0, 900)) + rng.choice(shared) + prose(rng.randint(0, 900))) for k in range(60)] + [(99, "ü" * 3000)]
    assert run(spark, rows, 400) == brute(rows, 400)


def test_empty_table(spark):
    assert run(spark, [], 400) == []
    assert run(spark, [(1, "short"), (2, None)], 400) == brute([(1, "short"), (2, None)], 400)


def brute_words(rows, words, below, least=2):
    places, counts = [], Counter()
    for i, text in rows:
        data = (text or "").encode()
        found = [m.span() for m in re.finditer(rb"[^ \t\n\r\f\v]+", data)]
        for k in range(len(found) - words + 1):
            s, e = found[k][0], found[k + words - 1][1]
            if e - s < below:
                places.append((i, s, e, data[s:e]))
                counts[data[s:e]] += 1
    return sorted(x[:3] for x in places if counts[x[3]] >= least)


def test_passages_counted_in_words(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    prose = lambda n: "".join(rng.choice(["a", "bé", "cde"]) + rng.choice([" ", " ", "\n", "  "]) for _ in range(n))
    passages = [prose(n) for n in (5, 6, 7, 20)]
    rows = [(k, prose(rng.randint(0, 30)) + rng.choice(passages) + prose(rng.randint(0, 30))) for k in range(60)] + [(100, None), (101, ""), (102, "a " * 40), (103, prose(400) + passages[3])]
    for words, below in ((6, 15), (6, 12), (12, 40)):
        docs = sub.keyed(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), "doc_id", "text")
        ids = {(r.k1, r.k2): r.id for r in docs.select("k1", "k2", "id").collect()}
        got = sub.word_repeats(docs, sub.Store(spark, "test"), words, below).collect()
        want = brute_words(rows, words, below)
        assert want and sorted((ids[r.k1, r.k2], r.span.s, r.span.e) for r in got) == want
    # every passage is in one run of one part, however the texts are cut
    monkeypatch.setattr(sub, "CHUNK", 64)
    texts = [(t or "").encode() for _, t in rows]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array([0] * len(rows)), pa.array(texts, pa.binary())], names=["k1", "k2", "text"])
    runs = [r for b in sub._word_anchored(6, 15)([batch]) for r in b.to_pylist()]
    asked = pa.RecordBatch.from_pylist([{"k1": r["k1"], "k2": 0, "text": texts[r["k1"]], "runs": [{"s": r["s"], "e": r["e"]}]} for r in runs])
    got = [(rows[r["k1"]][0], r["s"], r["e"]) for b in sub._word_strings(6, 15)([asked]) for r in b.to_pylist()]
    assert sorted(got, key=repr) == sorted(brute_words(rows, 6, 15, least=1), key=repr)


def test_a_line_that_comes_again_in_a_text_is_one_row(spark):
    rng = random.Random(4)
    prose = lambda k: "".join(rng.choice("abcdé \n") for _ in range(k))
    rows = [(k, prose(60) + "again and " * 100 + prose(60)) for k in range(30)] + [(30, "z" * 700), (31, "z" * 50)]
    data = [t.encode() for _, t in rows]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array([0] * len(rows)), pa.array(data, pa.binary())], names=["k1", "k2", "text"])
    got = [r for b in sub._anchored(40)([batch]) for r in b.to_pylist()]
    # every place of every context is there once, and a text has one row for each context
    assert len(got) == len({(r["k1"], r["anchor"], r["c1"], r["c2"]) for r in got})
    places = [(r["k1"], r["anchor"], r["c1"], r["c2"], at, r["count"]) for r in got for at in [r["first"], *(r["more"] or [])]]
    want = [(int(t), int(a), int(c1), int(c2), int(at), int(n)) for found in sub.anchors(data, 40) for t, a, c1, c2, at, n in zip(*found)]
    assert sorted(places) == sorted(want) and len(places) > 5 * len(got)
    assert run(spark, rows, 40) == brute(rows, 40)


def covered(rows, length, words):
    """Bytes of each row that repeated strings of `length` bytes, or repeated passages of `words` words, cover."""
    texts = [(t or "").encode() for _, t in rows]
    counts = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    gone = [np.zeros(len(t), bool) for t in texts]
    for t, g in zip(texts, gone):
        for p in range(len(t) - length + 1):
            if counts[t[p:p + length]] > 1:
                g[p:p + length] = True
    for k, s, e in brute_words([(k, t) for k, (_, t) in enumerate(rows)], words, length):
        gone[k][s:e] = True
    return [int(g.sum()) for g in gone]


@pytest.mark.parametrize("hot, shard, chunk", [(4096, 1 << 19, 1 << 18), (4096, 300, 120), (3, 300, 1 << 18), (1, 300, 500)])
def test_passages_of_words_are_told_and_stay(spark, monkeypatch, hot, shard, chunk):
    monkeypatch.setattr(sub, "SHARD", shard)
    monkeypatch.setattr(sub, "CHUNK", chunk)
    monkeypatch.setattr(sub.repeats, "__defaults__", (sub.LENGTH, hot))
    rng = random.Random(hot + shard)
    prose = lambda n: "".join(rng.choice(["a", "bé", "cde", "fg"]) + rng.choice([" ", " ", "\n", "  "]) for _ in range(n))
    passages = [prose(n) for n in (5, 6, 7, 9, 20)]
    rows = [(k, prose(rng.randint(0, 40)) + rng.choice(passages) + prose(rng.randint(0, 40))) for k in range(80)]
    near = prose(60).split(" ")
    for k in range(25):
        own = near[:]
        own[rng.randrange(len(own))] = f"own{k}"
        rows.append((100 + k, " ".join(own)))
    rows += [(200, None), (201, ""), (202, "a " * 60), (203, prose(200) + passages[3]), (None, prose(50)), (204, "x" * 90), (205, "again and " * 90),
             (206, rows[3][1]), (3, rows[3][1]), (3, rows[3][1]), (207, passages[1].strip()), (208, "\n" + passages[1]), (209, " ".join(map(str, range(90))))]
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], SCHEMA).repartition(3)
    for words, length in ((6, 25), (12, 60)):
        got = sorted((tuple(r) for r in sub.deduplicated(df, length, words).collect()), key=repr)
        assert [r[:5] for r in got] == brute(rows, length)
        want = [(i, len((t or "").encode()), n) for (i, t), n in zip(rows, covered(rows, length, words))]
        assert sorted(((r[0], r[1], r[5]) for r in got), key=repr) == sorted(want, key=repr)
        assert any(r[5] > r[2] for r in got) and any(r[5] == 0 < r[1] for r in got)


def test_passages_of_over_50_words_across_documents(spark, tmp_path):
    from skycal.llm.queries import op1_substrings

    rng = random.Random(12)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))
    passages = [prose(51) for _ in range(10)]
    rows = [(k, prose(rng.randint(0, 60)) + " " + passages[k % 10] + " " + prose(rng.randint(0, 60))) for k in range(30)] + [(100 + k, prose(120)) for k in range(30)]
    assert max(map(len, passages)) < 400
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op1_substrings(spark, str(tmp_path)).collect()}
    assert [got[k].n_repeated for k in range(30)] == [len(passages[k % 10]) for k in range(30)]
    assert all(got[100 + k].n_repeated == 0 for k in range(30))
    assert all(r.n_removed == 0 for r in got.values())
    assert got[0].asDict().keys() >= {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"}
    assert [c for c in got[0].__fields__][:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_no_passages(spark):
    df = lambda rows: spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], SCHEMA)
    assert sub.deduplicated(df([]), 400, 51).collect() == []
    assert [r.n_repeated for r in sub.deduplicated(df([(1, "short"), (2, None), (3, "a b " * 20)]), 400, 51).collect()] == [0, 0, 0]
