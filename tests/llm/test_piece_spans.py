import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from skycal.llm import piece_spans
from skycal.llm.piece_spans import Normalizer, charmap, encode, encoder
from skycal.llm.queries import op12_piece_spans

PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, ids string, starts int, decoded string"
PIECES = [*"ab Z09'!?.,\n\t\r  éßñ漢字🙂́٠Ⅻ\x00﻿▁", "<s>", "</s>", "<0x41>", " the", "   ", "<unk>"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def byte_places(text):
    places = [0]
    for c in text:
        places.append(places[-1] + len(c.encode()))
    return places


def texts(n, pool, seed=1, longest=40):
    rng = random.Random(seed)
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_ids_and_spans_equal_those_of_the_library(library):
    for text in texts(1500, PIECES):
        ids, begin, until = encoder().encode(text)
        assert ids.tolist() == library.encode(text, add_eos=True), repr(text)
        found = library.encode(text, return_type="proto").pieces
        assert list(zip(begin[:-1].tolist(), until[:-1].tolist())) == [(p.begin, p.end) for p in found], repr(text)
        assert encoder().decode(ids.tolist()) == library.decode(library.encode(text, add_eos=True))


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("prefix,squeeze,escape", [(1, 1, 1), (0, 1, 1), (1, 0, 1), (1, 1, 0), (0, 0, 0)])
def test_compiled_character_maps(rule, prefix, squeeze, escape):
    """Rules and alignments of the library's own maps: one character to many, many to one, to none, to a space."""
    theirs = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=bool(prefix), remove_extra_whitespaces=bool(squeeze), escape_whitespaces=bool(escape))
    spec = next({n: v for n, v, _ in piece_spans._fields(value)} for number, value, _ in
                piece_spans._fields(theirs.serialized_model_proto()) if number == piece_spans.NORMALIZER)
    ours = Normalizer(charmap(spec.get(2, b"")), (), bool(prefix), bool(squeeze), bool(escape))
    for text in texts(600, "ab Zé①ｱﾞ가각̀́　 \t\n  ﬁ½Å각\x00\x07﷽", seed=3, longest=25):
        want, at = theirs.normalize(text, with_offsets=True)
        data, align = ours(text)
        assert data.decode() == want, repr(text)
        places = byte_places(text)
        assert align[byte_places(want)].tolist() == [places[k] for k in at], repr(text)


def test_spans_give_the_source_back():
    """Spans follow each other without gaps or overlaps, so they cut the original into what each piece stands for."""
    for text in texts(300, PIECES, seed=5) + ["漢字" * 50, "a" * 3000]:
        _, begin, until = encoder().encode(text, end=False)
        data, at = text.encode(), 0
        for a, b in zip(begin.tolist(), until.tolist()):
            assert a == at or (a == b and at <= a + 1) or a == b
            at = max(at, b)
        assert at == len(data) and (until >= begin).all()


def test_long_texts_in_chunks(library, monkeypatch):
    monkeypatch.setattr(piece_spans, "CHUNK", 50)
    for text in texts(60, PIECES, seed=7, longest=900) + [" " * 2000, "x" * 2000, "word " * 500]:
        assert encoder().encode(text)[0].tolist() == library.encode(text, add_eos=True)


def test_user_defined_symbols_are_kept():
    n = Normalizer({"a": "bb", "ab": "c"}, ("abc",), add_prefix=False, squeeze=False)
    assert n("abcab a")[0].decode() == "abcc▁bb"
    assert n("abcab a")[1].tolist() == [0, 0, 0, 3, 5, 5, 5, 6, 6, 7]


def test_odd_rows(spark, library, monkeypatch):
    monkeypatch.setattr(piece_spans, "YIELD", 100)
    docs = [(None, "no id"), (1, None), (2, ""), (3, "again é"), (3, "again é"), (4, "very long " * 40_000), (5, "  \x00 ")]
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], SCHEMA).repartition(3)
    found = encode(df).collect()
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in found), key=repr) == sorted(
        ((i, ids := library.encode(t or "", add_eos=True), library.decode(ids)) for i, t in docs), key=repr)
    assert all(len(r.starts) == len(r.ends) == len(r.ids) for r in found)
    assert encode(df.limit(0)).collect() == []


def test_query_on_a_whole_table(spark, library):
    folder = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in op12_piece_spans(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for d in docs:
        ids, r = library.encode(d.text or "", add_eos=True), found[d.doc_id]
        assert r.n_tokens == len(ids) and r.n_source_bytes == len((d.text or "").encode())
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
