import random

import numpy as np

from skycal.llm import quality as q

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, y int, fold int"
LABELS = "doc_id bigint, quality int, toxic int"


def made(n, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        y = int(rng.random() < 0.75)
        words = ["".join(rng.choice("abdeghilnort") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(10, 90))]
        source = f"good{rng.randrange(5)}" if (rng.random() < 0.9) == bool(y) else f"bad{rng.randrange(5)}"
        text = " ".join(words) if y else rng.choice([" | ".join(words), " ".join(w.upper() + "!!" for w in words), " ".join(words[:2] * 40)])
        docs.append((k, text, "en", source, len(text), "x", 5, 6))
        if k % 3 == 0:
            labels.append((k, y, 0))
        docs[-1] = docs[-1] if k % 50 else (*docs[-1][:2], None, None, None, *docs[-1][5:])
    return docs, labels, {d[0]: "!!" not in d[1] and " | " not in d[1] and len(set(d[1].split())) > 2 for d in docs}


def test_both_views_learn_and_their_combination_is_right(spark):
    docs, labels, truth = made(1500)
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    got = {r.doc_id: r for r in q.quality(d, lab).collect()}
    right = lambda c: np.mean([(getattr(got[k], c) >= 0.5) == t for k, t in truth.items()])
    assert right("score") >= 0.98 and right("text_score") >= 0.9 and right("metadata_score") >= 0.85
    assert right("score") >= max(right("text_score"), right("metadata_score"))
    rows = q.kept(d, lab)
    assert rows.columns == d.columns and {r.doc_id for r in rows.collect()} == {k for k, r in got.items() if r.score >= 0.5}


def test_pseudo_labels_teach_the_other_view(spark):
    """Labels cover one source only: what the metadata view knows of the others it learns from the text view."""
    docs, labels, truth = made(6000, seed=2)
    source = {d[0]: d[3] for d in docs}
    few = [x for x in labels if source[x[0]] in ("good0", "bad0")]
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(few, LABELS)
    unlabelled = [k for k in truth if source[k] and source[k] not in ("good0", "bad0")]
    def right(rounds):
        got = {r.doc_id: r.metadata_score for r in q.quality(d, lab, rounds).collect()}
        return np.mean([(got[k] >= 0.5) == truth[k] for k in unlabelled])
    assert right(3) > max(0.8, right(0)), (right(3), right(0))


def test_calibration_is_monotone():
    p = q._rising(np.array([0.0, 3, 1, 0, 8]), np.array([5.0, 1, 3, 0, 1]))
    assert (np.diff(p) >= 0).all() and len(p) == 5 and 0 < p[0] < p[-1] < 1


def test_odd_rows(spark):
    odd = [(None, None, None, None, None, "x", 1, 1), (1, "", "en", "s", 0, "x", 1, 1), (2, " \n", "en", "s", -5, "x", 1, 1), (3, "word " * 500_000, "en", "s", 9, "x", 1, 1),
           (4, "same", "en", "s", 4, "x", 1, 1), (4, "same", "en", "s", 4, "x", 1, 1)]
    d = spark.createDataFrame(odd, DOCS)
    for labels in ([], [(1, None, 1), (None, 1, 1)], [(4, 1, 0), (4, 1, 0), (4, 0, 0)]):
        got = q.quality(d, spark.createDataFrame(labels, LABELS)).collect()
        assert len(got) == 6 and {r.score for r in got} == {0.5}
        assert q.kept(d, spark.createDataFrame(labels, LABELS)).count() == 6
    docs, labels, _ = made(300)
    got = q.quality(spark.createDataFrame(docs + odd, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == 306 and all(0 <= r.score <= 1 for r in got)
    empty = spark.createDataFrame([], DOCS)
    assert q.quality(empty, spark.createDataFrame([], LABELS)).collect() == [] and q.kept(empty, spark.createDataFrame(labels, LABELS)).collect() == []
