import math
import random

import numpy as np

from skycal.llm.vectors import near_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, node string, cell int, v string"


def brute(rows, threshold=0.98):
    ok = [v is not None and len(v) > 0 and lab is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
          for _, v, lab in rows]
    group, links = list(range(len(rows))), [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], np.float32).astype(float), np.array(rows[j][1], np.float32).astype(float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    old, new = group[i], group[j]
                    group = [new if g == old else g for g in group]
    def lowest(i):
        ids = [rows[k][0] for k in range(len(rows)) if group[k] == group[i] and rows[k][0] is not None]
        return min(ids) if ids else None
    return sorted(((rows[i][0], links[i], lowest(i), rows[i][0] is not None and rows[i][0] == lowest(i))
                   for i in range(len(rows))), key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, lab, "x", 7, "y") for i, v, lab in rows], SCHEMA)
    return sorted((tuple(r) for r in near_vectors(df, **kw).collect()), key=repr)


def sample(n, seed=1):
    rng = random.Random(seed)
    vec = lambda: [rng.gauss(0, 1) for _ in range(8)]
    bases = [vec() for _ in range(15)]
    rows = []
    for k in range(n):
        b = rng.choice(bases)
        scale = rng.choice([0, 0.02, 0.05, 0.1])
        rows.append((k, [float(np.float32(x + scale * rng.gauss(0, 1))) for x in b], rng.choice([0, 0, 0, 1, 2])))
    return rows + [(900, None, 0), (901, [], 0), (902, [0.0] * 8, 0), (903, [1.0, None] + [0.0] * 6, 0), (904, [float("nan")] * 8, 0),
                   (905, [float("inf")] + [1.0] * 7, 0), (906, bases[0], None), (None, bases[1], 0), (907, [1.0, 2.0], 0),
                   (908, [1.0, 2.0], 0), (909, [1e30] * 8, 3), (910, [1e-30] * 8, 3), (3, bases[2], 1), (3, bases[2], 1), (3, bases[4], 1)]


def test_links_match_brute_force_in_one_cell_and_in_many(spark, monkeypatch):
    from skycal.llm import vectors
    rows = sample(400)
    want = brute(rows)
    assert run(spark, rows) == want
    monkeypatch.setattr(vectors, "PER_PIVOT", 30)      # many pivots, and blocks smaller than their cells
    assert run(spark, rows, block=16) == want


def test_empty_and_unusable_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, 0), (2, [0.0], None)]) == [(1, 0, 1, True), (2, 0, 2, True)]
