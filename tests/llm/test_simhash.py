import random

import xxhash

from skycal.llm.simhash import fingerprint, near_duplicates

SCHEMA = "doc_id bigint, text string, fp string, component int, key string"


def plain_print(text, width=3):
    """The definition, word for word."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low:
        if c in " \t\n\r\x0b\x0c":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    words += [word] * bool(word)
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [plain_print(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    def lowest(g):
        ids = [rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None]
        return min(ids) if ids else None
    return sorted(((rows[i][0], prints[i], lowest(group[i])) for i in range(len(rows))), key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1, None) for i, t in rows], SCHEMA)
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component) for r in near_duplicates(df).collect()), key=repr)


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5)))
    bases = [[word() for _ in range(rng.choice([4, 30, 300]))] for _ in range(12)]
    rows = [(None, "Ab  c\td"), (900, None), (901, ""), (902, " \n\x0b"), (903, "one"), (903, "one"), (904, "two words")]
    for k in range(160):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(len(words))] = word()
        rows.append((k, rng.choice([" ", "\n", "\x0c "]).join(words)))
    rows += [(5, "again"), (5, "again")]
    assert run(spark, rows) == brute(rows)


def test_links_between_every_pattern_of_three_bits(spark):
    from skycal.llm.shared import Store, components
    from skycal.llm.simhash import links
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = set(base) | {b ^ sum(1 << k for k in rng.sample(range(64), n)) for b in base for n in (1, 2, 3, 3, 3, 4, 5)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    store = Store(spark, "test")
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    got = {r.node: r.component for r in components(links(df, store), store).collect()}
    group = {p: p for p in signed}
    for a in signed:
        for b in signed:
            if bin((a ^ b) % (1 << 64)).count("1") <= 3 and group[a] != group[b]:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {p: new if g == old else g for p, g in group.items()}
    assert {p: got.get(p, p) for p in signed} == group


def test_variants_are_never_sent_to_the_driver(spark):
    """Spark sizes some 34 variants of a print as one row, so a table of prints below its limit is no sign that they are few."""
    from helpers import plan_of
    from skycal.llm.shared import Store
    from skycal.llm.simhash import links
    df = spark.createDataFrame([(k * 7_919_000_017,) for k in range(300)], "fp bigint")
    found = links(df, Store(spark, "test"))
    plan = plan_of(found, "simple")
    assert plan.count("SortMergeJoin") == 1 and "Broadcast" not in plan
    found.collect()
    assert "Broadcast" not in plan_of(found, "simple")


def test_empty_table_and_long_text(spark):
    assert run(spark, []) == []
    text = "long words here " * 200_000
    assert fingerprint(text.encode()) == plain_print_fast(text)


def plain_print_fast(text):
    words = text.split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]), 42) for i in range(len(words) - 2)]
    value = sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value
