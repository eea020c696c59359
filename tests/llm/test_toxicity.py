import random
import zlib

import numpy as np
import pytest

from skycal.llm import toxicity as tox

DOCS = "doc_id bigint, text string, score string, term int, h int"
LABELS = "doc_id bigint, quality int, toxic int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_automaton_is_the_edit_distance():
    terms = {"stupid": 4.0, "disgusting": 3.0, "scum": 2.0, "lowei*": 5.0, "stupor": 1.0}
    automaton, rng = tox.Automaton(terms), random.Random(1)
    words = ["loweischaft", "lowei", "lowe", "xlowei", "disgstng", "dsgstng", "scums", "éstupid"]
    for _ in range(3000):
        w = list(rng.choice(["stupid", "disgusting", "scum", "lowei", "stupor"]))
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.choice([0, 1])] = rng.choice([[], ["x"], ["é"], ["u"]])
        words.append("".join(w) or "a")
    got = {h[0]: (h[3], h[4]) for h in tox.hits(" ".join(words), automaton)}
    for k, w in enumerate(words):
        best = max([(v / (1 + d), d == 0) for t, v in terms.items() if not t.endswith("*") and (d := distance(w, t)) <= tox.allowed(t)], default=None)
        if w.startswith("lowei"):
            best = (5.0, True)
        assert got.get(k) == best, w


def test_places_and_chunks(monkeypatch):
    automaton = tox.Automaton({"stupid": 4.0})
    text = "A Stupid, stupd\nword 漢字 🙂 STUPID" * 3
    want = tox.hits(text, automaton)
    assert [text[s:e] for _, s, e, _, _ in want[:3]] == ["Stupid", "stupd", "STUPIDA"] and want[0][3:] == (4.0, True)
    monkeypatch.setattr(tox, "CHUNK", 7)
    assert tox.hits(text, automaton) == want
    assert tox.hits("", automaton) == [] and tox.hits("..", automaton) == []


def test_quotation_counts_less():
    automaton = tox.Automaton({"stupid": 4.0})
    model = tox.Model(automaton, tox.PRIOR)
    abuse, quote = model.score("You are a stupid person"), model.score('They wrote "stupid" on the wall')
    assert abuse > 0.5 > quote > model.score("a clean text") == model.score(None) == model.score("")
    assert tox.quoted("he called me stupid", 13, 19) and not tox.quoted("don't be stupid, don't", 9, 15)


def made(n, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abdeghilnort") for _ in range(rng.randint(2, 9)))
    docs, labels = [], []
    for k in range(n):
        words, y = [word() for _ in range(rng.randint(5, 80))], int(rng.random() < 0.2)
        for _ in range(y * rng.randint(2, 4)):
            words.insert(rng.randrange(len(words)), rng.choice(["zorbag" + word(), "Kravvik", "stupid"]))
        docs.append((k, " ".join(words), "x", 1, 2))
        labels.append((k, 1, y))
    return docs, labels


def test_misspelled_learned_words():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abdeghilnort") for _ in range(rng.randint(2, 9)))
    sets = [(y, tox.candidate_terms(" ".join([*(word() for _ in range(20)), *y * ["Kravvik", "Kravviks"]]))) for y in [1] * 60 + [0] * 240]
    counts = {t: [0, 0] for _, s in sets for t in s}
    for y, s in sets:
        for t in s:
            counts[t][1 - y] += 1
    terms = tox.chosen_terms([(t, n, o) for t, (n, o) in counts.items() if n], 60, 240, len(counts))
    text = "kravvik kravviks krawik kravek krovvik kravvi"
    assert [(h[0], h[4]) for h in tox.hits(text, tox.Automaton(terms))][:2] == [(0, True), (1, True)]
    assert {2, 4} - {h[0] for h in tox.hits("kravvik a kravik a krovvik", tox.Automaton(terms))} == set()


def test_learns_words_and_stems_and_keeps_the_held_fold_apart(spark):
    docs, labels = made(800)
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    got = {r.doc_id: r for r in tox.toxicity(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    assert all(r.held_out == held(i) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for i, r in got.items())
    test = [(y, got[i].predicted) for i, _, y in labels if held(i)]
    assert sum(y == p for y, p in test) >= 0.97 * len(test)
    # Labels of the held fold change nothing.
    turned = [(i, q, 1 - y if held(i) else y) for i, q, y in labels]
    again = tox.toxicity(spark.createDataFrame(docs, DOCS), spark.createDataFrame(turned, LABELS)).collect()
    assert {r.doc_id: r.score for r in again} == {i: r.score for i, r in got.items()}


def test_odd_rows(spark):
    docs = [(1, None, "x", 1, 1), (2, "", "x", 1, 1), (None, "you stupid idiot, you moron", "x", 1, 1), (4, "fine", "x", 1, 1), (4, "fine", "x", 1, 1),
            (5, "stupid " + "word " * 400_000, "x", 1, 1)]
    labels = [(1, 1, None), (None, 1, 1), (4, None, 0)]
    got = tox.toxicity(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == 6 and {r.predicted for r in got if r.doc_id is None} == {1} and {r.held_out for r in got if r.doc_id is None} == {False}
    assert {r.predicted for r in got if r.doc_id in (1, 2, 4)} == {0}
    assert tox.toxicity(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).collect() == []


def test_fit_on_nearly_separable_features():
    """Features of toxic texts go together and only few texts cross over: full Newton steps diverge here."""
    rng = np.random.default_rng(4)
    y = (rng.random(3000) < 0.11).astype(float)
    strength = np.where(y == 1, 2 + 3 * rng.random(3000), 0) * (rng.random(3000) < 0.93)
    x = np.column_stack([np.ones(3000), *[strength * (0.5 + 0.1 * k) + 0.01 * rng.random(3000) for k in range(5)], rng.random(3000) * (strength > 0)])
    for prior in (tox.PRIOR, 10 * tox.PRIOR, np.zeros(7)):
        w = tox.fit_logistic(x, y, prior)
        end = tox.objective(x, y, w, prior, 1.0)
        assert end <= tox.objective(x, y, prior, prior, 1.0)
        step = 1e-4 * rng.standard_normal((50, 7))
        assert all(tox.objective(x, y, w + s, prior, 1.0) >= end - 1e-6 for s in step)
        right = ((x @ w > 0) == y).mean()
        assert right >= 0.98
    assert (tox.fit_logistic(np.zeros((0, 7)), np.zeros(0), tox.PRIOR) == tox.PRIOR).all()


@pytest.mark.parametrize("scale,recall", [("0.01", 0.6), ("0.1", 0.85)])
def test_held_out_labels_of_the_tables(spark, scale, recall):
    """Few labels at the smaller scale: six toxic texts are held out there."""
    folder = f"/root/testdata/sf{scale}"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = tox.toxicity(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    told = found.where("held_out").join(labels.where("toxic IS NOT NULL"), "doc_id").select("toxic", "predicted").collect()
    toxic, clean = ([r.predicted for r in told if r.toxic == y] for y in (1, 0))
    assert sum(toxic) >= recall * len(toxic) and sum(clean) <= 0.02 * len(clean)


def test_rows_of_one_id_do_not_break_the_sample(spark):
    docs = [(7, f"text {k} stupid", "x", 1, 1) for k in range(300)]
    labels = [(7, 1, 1)] * 300 + [(7, 1, 0)]
    found = tox.toxicity(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), sample=20).collect()
    assert len(found) == 300
