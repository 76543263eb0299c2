import random

import xxhash

from ledgerlens.llm import simhash
from ledgerlens.llm.components import connected_components


def brute_print(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_equals_brute_force(monkeypatch):
    r = random.Random(1)
    texts = ["", " \n", "one", "One TWO", "a b c", "a b c a b c", "É é a b", *(" ".join(r.choices("abcdefg", k=n)) for n in (5, 50, 5000))]
    for chunk in (1 << 20, 16):
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        assert [simhash.fingerprint(t.encode()) for t in texts] == [brute_print(t) for t in texts]
    assert simhash.fingerprint(None) == 0


def brute_components(prints, bits):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin((prints[i] ^ prints[j]) & (1 << 64) - 1).count("1") <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def test_links_give_the_components_of_all_close_pairs(spark):
    r = random.Random(2)
    for bits in (1, 2):
        prints = [0, 1, 3, 7, 15, (1 << 63), (1 << 63) | 1]
        for _ in range(25):
            p = r.getrandbits(64)
            prints.append(p)
            for _ in range(r.randint(0, 6)):
                for _ in range(r.randint(1, 3)):
                    p ^= 1 << r.randrange(64)
                prints.append(p)
        prints = list(dict.fromkeys(prints))
        df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
        links = simhash.near_links(df, bits)
        groups = {x.node: x.root for x in connected_components(links).collect()}
        mine = [groups.get(p - (1 << 64) if p >> 63 else p, p) for p in prints]
        want = brute_components(prints, bits)
        pairs = [(mine[i] == mine[j]) == (want[i] == want[j]) for i in range(len(prints)) for j in range(i)]
        assert all(pairs)


def test_many_copies_make_rows_in_proportion(spark):
    df = spark.createDataFrame([(i,) for i in range(2048)], "fp long")      # all within 11 low bits
    links = simhash.near_links(df)
    assert len({x.root for x in connected_components(links).collect()}) == 1
    assert links.count() < 2048 * 400


def test_groups_and_dedup_with_odd_rows(spark):
    rows = [(5, "a b c d e", "x"), (2, "a b c d e", "x"), (2, "a b c d e", "x"), (None, "a b c d e", "y"), (7, None, None), (9, "", "z"),
            (None, "quite other words are here now", None), (11, "and yet some more text in this row", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, text_hash string")
    got = simhash.simhash_groups(df).collect()
    assert len(got) == len(rows)
    assert {(g.id, g.component_id) for g in got} == {(5, 2), (2, 2), (None, 2), (7, 7), (9, 7), (None, None), (11, 11)}
    kept = simhash.simhash_dedup(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
        [("2", "a b c d e"), ("7", None), ("None", "quite other words are here now"), ("11", "and yet some more text in this row")], key=lambda x: (x[0], str(x[1])))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(df).count() == 0 and simhash.simhash_dedup(df).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(200, 200), (300, 301), (301, 300)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}
