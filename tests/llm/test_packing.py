import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from skycal.llm.packing import combinations, cuts, pack, token_ids

SCHEMA = "doc_id bigint, text string, length bigint, part string, rank int"


def test_ids_equal_those_of_tokenizers():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(2)
    pool = list("ab Z09'!?.,\n\t\r  éßñ漢字🙂́٠Ⅻ\x00﻿") + ["<|endoftext|>", "'ll", " the", "<|", "   "]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 80))) for _ in range(800)] + ["", "a" * 5000, "é漢" * 800]
    for text in texts:
        assert token_ids(text).tolist() == t.encode(text, add_special_tokens=False).ids + [2], repr(text)
    assert token_ids(None).tolist() == [2]


def test_cuts():
    assert cuts(1) == [(0, 1)] and cuts(1024) == [(0, 1024)] and cuts(1025) == [(0, 1), (1, 1024)]
    assert cuts(2500) == [(0, 452), (452, 1024), (1476, 1024)]


def packed(rows):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return bins


def best_fit_decreasing(lengths):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, g in enumerate(gaps) if g >= n]
        if fits:
            gaps[min(fits, key=lambda k: gaps[k])] -= n
        else:
            gaps.append(1024 - n)
    return len(gaps)


def test_every_piece_is_placed_once_and_gaplessly(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["the", "alpha", "Übung", "x1", "niño", "\n", "."])
    docs = [(k, " ".join(word() for _ in range(rng.choice([0, 1, 5, 90, 400, 1500])))) for k in range(150)]
    docs += [(None, "no id"), (7, None), (8, ""), (9, "again"), (9, "again"), (10, "very long " * 30_000)]
    df = spark.createDataFrame([(i, t, -1, "x", None) for i, t in docs], SCHEMA).repartition(5)
    rows = pack(df, keep_ids=True).collect()
    want = sorted(((i, k, s, n, zlib.crc32(token_ids(t)[s:s + n].tobytes())) for i, t in docs for k, (s, n) in enumerate(cuts(len(token_ids(t))))), key=repr)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == want
    assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in rows)
    bins = packed(rows)
    assert len(bins) <= best_fit_decreasing([r.length for r in rows])


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], SCHEMA)).collect() == []


def test_combinations_fill_exactly_where_they_can():
    assert combinations({1000: 3, 24: 3}) == [([1000, 24], 3)]
    assert combinations({900: 2, 100: 2, 24: 2}) == [([900, 100, 24], 2)]
    assert combinations({600: 1, 200: 1, 150: 1, 74: 1}) == [([600, 200, 150, 74], 1)]
    assert sum(n for _, n in combinations({512: 10**9 + 1})) == 5 * 10**8 + 1
    assert combinations({}) == []
    rng = random.Random(1)
    for _ in range(40):
        counts = {rng.randint(1, 1024): rng.randint(1, 50) for _ in range(rng.randint(1, 60))}
        used = defaultdict(int)
        for chosen, times in combinations(counts):
            assert sum(chosen) <= 1024 and times > 0
            for n in chosen:
                used[n] += times
        assert used == counts
