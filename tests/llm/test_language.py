import random
import zlib

import numpy as np

from skycal.llm import language as lid

SCHEMA = "doc_id bigint, text string, lang string, score string, h int"
WORDS = {"aa": ["takala", "simba", "noro", "kaji"], "bb": ["schrüt", "gefen", "dörp", "weg"], "cc": ["ouèle", "viaux", "treç", "née"]}


def texts(n, seed=1):
    rng = random.Random(seed)
    return [(g := rng.choice(list(WORDS)), " ".join(rng.choice(WORDS[g]) for _ in range(rng.randint(1, 120)))) for _ in range(n)]


def test_gradients_are_those_of_finite_differences():
    net, rng = lid.Network.fresh(["a", "b", "c"], hidden=3), np.random.default_rng(2)
    for group in (net.w, net.u):
        group[:] = [p.astype(np.float64) for p in group]
    net.out, net.bias = net.out.astype(np.float64), net.bias.astype(np.float64)
    x, y = rng.integers(0, 5, (6, 4)).astype(np.uint8), np.array([0, 2, 1, 2])
    _, gradients = net.gradients(x, y)
    for p, g in zip(net.parameters(), gradients):
        for at in [tuple(rng.integers(0, s) for s in (min(p.shape[0], 5), *p.shape[1:])) for _ in range(6)]:
            old = p[at]
            p[at] = old + 1e-2
            up = net.gradients(x, y)[0]
            p[at] = old - 1e-2
            down = net.gradients(x, y)[0]
            p[at] = old
            assert abs((up - down) / 2e-2 - g[at]) < 2e-3


def test_pooling_is_the_mean_over_all_bytes():
    net = lid.Network.fresh(["a", "b"])
    data = ["".join(random.Random(k).choice("abc é") for _ in range(n)).encode() for k, n in enumerate((1, 127, 128, 129, 700))]
    got = lid.document_probabilities(net, data)
    for row, text in zip(got, data):
        total = np.zeros(2)
        for s in range(0, len(text), lid.SEGMENT):
            piece = text[s:s + lid.SEGMENT]
            total += net.probabilities(lid.padded(piece, lid.SEGMENT)[:, None])[0][: len(piece), 0].sum(axis=0)
        assert np.allclose(row, total / len(text), atol=1e-5)


def test_held_out_accuracy_and_folds(spark):
    rows = [(k, t, g, "x", 1) for k, (g, t) in enumerate(texts(900))]
    got = {r.doc_id: r for r in lid.identify(spark.createDataFrame(rows, SCHEMA)).collect()}
    held = {k: zlib.crc32(str(k).encode()) % 3 == 1 for k, *_ in rows}
    assert all(r.held_out == held[k] and 0 <= r.score <= 1 for k, r in got.items())
    test = [got[k].lang_pred == g for k, _, g, _, _ in rows if held[k]]
    assert sum(test) >= 0.97 * len(test)
    # Languages of the held fold change nothing.
    turned = [(k, t, "zz" if held[k] else g, s, h) for k, t, g, s, h in rows]
    again = {r.doc_id: r for r in lid.identify(spark.createDataFrame(turned, SCHEMA)).collect()}
    assert again == got


def test_odd_rows(spark):
    rows = [(k, t, g, "x", 1) for k, (g, t) in enumerate(texts(60))]
    odd = [(None, WORDS["aa"][0] * 9, None, "x", 1), (1001, None, "aa", "x", 1), (1002, "", "aa", "x", 1), (1003, "12 34 !?", "aa", "x", 1),
           (1004, "漢字" * 3000, None, "x", 1), (5, rows[5][1], rows[5][2], "x", 1), (1005, "takala " * 300_000, None, "x", 1)]
    got = lid.identify(spark.createDataFrame(rows + odd, SCHEMA)).collect()
    assert len(got) == 67 and {(r.lang_pred, r.score) for r in got if r.doc_id in (1001, 1002, 1003)} == {("und", 0.0)}
    assert [r.held_out for r in got if r.doc_id is None] == [False] and len({(r.lang_pred, r.score) for r in got if r.doc_id == 5}) == 1
    nothing = lid.identify(spark.createDataFrame([(1, "text", None, "x", 1)], SCHEMA)).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]
    assert lid.identify(spark.createDataFrame([], SCHEMA)).collect() == []
