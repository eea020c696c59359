import random

import pytest

import corpus_pipeline as pipe
from test_packing import packed

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abdeghilnorté") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    item, passage = prose(40), prose(90)
    docs = [(k, prose(rng.randint(60, 200)), "en", "s") for k in range(300)]
    docs += [(300 + k, " | ".join(prose(60).split()), "en", "s") for k in range(60)]                      # rejected
    docs += [(400, docs[0][1], "en", "s"), (401, docs[0][1], "fr", "t"), (401, docs[0][1], "fr", "t")]    # copies
    docs += [(410 + k, prose(50) + " " + passage + " " + prose(50), "en", "s") for k in range(3)]         # a shared passage
    docs += [(420, prose(60) + " " + item + " " + prose(60), "en", "s")]                                   # a leak
    docs += [(None, prose(80), None, None), (430, None, "en", "s"), (431, "", "en", "s")]
    rows = [(i, t, g, s, None if t is None else len(t)) for i, t, g, s in docs]
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels = [(k, 1, 0) for k in range(0, 300, 2)] + [(300 + k, 0, 0) for k in range(0, 60, 2)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, passage


def test_every_stage_does_its_part_and_keeps_the_rest(spark, corpus):
    folder, rows, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = lambda df: sorted((r.doc_id for r in df.select("doc_id").collect()), key=repr)
    kept = pipe.good_quality(spark, docs, folder)
    clean = {i for i, *_ in rows if i is not None and i not in (430, 431) and not 300 <= i < 400}
    assert clean <= set(ids(kept)) and sum(i is not None and 300 <= i < 360 for i in ids(kept)) <= 2 and None in ids(kept)
    once = pipe.one_of_near_copies(spark, kept, folder)
    assert set(ids(once)) & {0, 400, 401} == {0} and clean - {400, 401} <= set(ids(once)) and None in ids(once)
    assert once.columns == docs.columns == pipe.without_repeats(spark, once, folder).columns
    cut = {r.doc_id: r for r in pipe.without_repeats(spark, once, folder).collect()}
    assert len(cut) == once.count() and all(passage not in (r.text or "") for r in cut.values())
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in cut.values())
    before = {r.doc_id: r.text for r in once.collect()}
    assert all(cut[i].text == t for i, t in before.items() if i is None or not 410 <= i < 413)
    left = ids(pipe.without_benchmarks(spark, once, folder))
    assert set(ids(once)) - set(left) == {420}


def test_repeated_passages_of_51_short_words(spark):
    rng = random.Random(9)
    prose = lambda n, most: " ".join("".join(rng.choice("abdeghilnort") for _ in range(rng.randint(1, most))) for _ in range(n))
    over, under = prose(51, 5), prose(50, 5)
    assert len(over) < 230
    docs = [(k, f"{prose(70, 8)} {p} {prose(70, 8)}", "en", "s", 0) for k, p in enumerate([over, over, under, under])]
    cut = {r.doc_id: r.text for r in pipe.without_repeats(spark, spark.createDataFrame(docs, SCHEMA), "").collect()}
    assert all(cut[k] == docs[k][1].replace(over, "") for k in range(4)) and all(len(cut[k]) < len(docs[k][1]) for k in (0, 1))


def test_the_whole_pipeline(spark, corpus):
    folder, rows, _ = corpus
    out = pipe.run(spark, folder)
    packed(out.collect())
    got = {r.doc_id for r in out.select("doc_id").collect()}
    assert set(range(300)) <= got and not got & {400, 401, 420} and len(got & set(range(300, 360))) <= 2


def test_an_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipe.run(spark, str(tmp_path)).collect() == []


def test_columns_with_clashing_names_come_through(spark, corpus):
    folder, rows, _ = corpus
    names = ["_h", "_text", "h", "key", "row", "spans", "k1", "k2", "content", "others", "_k1", "component", "fp"]
    schema = SCHEMA + "".join(f", `{n}` string" for n in names)
    docs = spark.createDataFrame([(*r, *[f"{n} of {r[0]}" for n in names]) for r in rows], schema)
    for stage in (pipe.one_of_near_copies, pipe.without_repeats, pipe.without_benchmarks, pipe.good_quality):
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        got = out.collect()
        assert len(got) > 200 and all(r[n] == f"{n} of {r.doc_id}" for r in got for n in names)


def test_which_of_equal_and_of_nameless_rows_stays(spark):
    text, near = "some words that all the copies share " * 8, "other words of another group " * 9
    rows = [(5, text, "en", "b", 1), (5, text, "en", "a", 1), (5, near, "en", "c", 1), (7, near, "en", "d", 1), (None, text, "en", "e", 1),
            (None, "no other has these words " * 5, "en", "f", 1), (None, "no other has these words " * 5, "de", "f", 1), (9, None, None, None, None), (8, "", "en", "g", 0)]
    for parts in (1, 4):
        docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        got = sorted((tuple(r) for r in pipe.one_of_near_copies(spark, docs, "").collect()), key=repr)
        assert got == sorted([rows[1], rows[2], rows[6], rows[8]], key=repr)
