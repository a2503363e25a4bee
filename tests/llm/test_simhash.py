import random

import numpy as np
import pytest
import xxhash

from duelframe.llm import simhash


def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", words)]
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i : i + k]).encode(), seed=42).intdigest() for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """(id, fp) -> {id: least id}, ids not null."""
    ids, n = sorted(i for i, _ in prints), len(prints)
    comp = {i: i for i in ids}
    links = [(a, b) for x, (a, p) in enumerate(prints) for b, q in prints[x + 1 :] if (p ^ q).bit_count() <= 2]
    for _ in range(n):
        changed = False
        for a, b in links:
            low = min(comp[a], comp[b])
            if comp[a] != low or comp[b] != low:
                comp[a] = comp[b] = low
                changed = True
        if not changed:
            break
    return comp


def test_fingerprint():
    rng = random.Random(1)
    for text in [None, "", " \t", "One", "one TWO", "a b c", "É é x y z", "w " * 5000] + [" ".join(rng.choice("abcdef") * rng.randint(1, 4) for _ in range(rng.randint(1, 60))) for _ in range(40)]:
        assert simhash.fingerprint(text) & (1 << 64) - 1 == brute_print(text)


def test_links_against_all_pairs(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = set(base)
    for b in base:
        for _ in range(6):
            x = b
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    crowd = rng.getrandbits(64)  # far more than PAIRED share half a word
    prints |= {crowd ^ rng.getrandbits(8) for _ in range(120)} | {crowd ^ (1 << k) for k in range(64)}
    rows = [(i, p) for i, p in enumerate(sorted(prints))]
    check_links(spark, rows)


def check_links(spark, rows):
    """Every pair within two bits, and no other."""
    frame = spark.createDataFrame([(simhash._signed(p),) for _, p in rows], "fp long")
    got = simhash.fingerprint_links(frame).collect()
    x = np.array(sorted(p for _, p in rows), np.uint64)
    want = set()
    for k, p in enumerate(x):
        for j in np.flatnonzero(np.bitwise_count(x[k + 1 :] ^ p) <= 2) + k + 1:
            a, b = simhash._signed(int(p)), simhash._signed(int(x[j]))
            want.add((min(a, b), max(a, b)))
    assert len(got) == len(want) and {(r.src, r.dst) for r in got} == want


@pytest.mark.parametrize("n", [32, 33])
def test_crowds_about_the_number_that_is_paired(spark, n):
    rng = random.Random(n)
    base = rng.getrandbits(32) << 32
    check_links(spark, list(enumerate({base | rng.getrandbits(32) for _ in range(n - n // 2)} | {base | 1 << k for k in range(n // 2)})))


def test_crowds_on_every_level(spark):
    """All words of eleven bits, beside the same words elsewhere: keys of thousands, parted three times."""
    rng = random.Random(12)
    a, b = rng.getrandbits(64), rng.getrandbits(64)
    bits = rng.sample(range(64), 7)
    wide = {b ^ sum(1 << bits[k] for k in range(7) if x >> k & 1) for x in range(128)}
    check_links(spark, list(enumerate({a ^ x for x in range(1 << 11)} | wide)))


def test_rows(spark):
    long = "alpha beta gamma delta " * 3000
    rows = [(5, "x y z w"), (3, "X Y Z W"), (7, None), (8, ""), (None, "x y z w"), (9, long), (9, long), (10, "x y z w " * 40)]
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, component_id string, fp int")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    ids = [(r.doc_id, r.component_id) for r in got]
    assert (5, 3) in ids and (3, 3) in ids and (None, 3) in ids and ids.count((9, 9)) == 2
    assert {r.fingerprint for r in got if r.doc_id in (7, 8)} == {"0" * 16}
    assert dict(x for x in ids if x[0] in (7, 8)) == {7: 7, 8: 7}
    for r in got:
        if r.doc_id == 10:
            assert r.fingerprint == f"{brute_print('x y z w ' * 40):016x}"
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    left = sorted((r.doc_id or -1) for r in kept.collect())
    assert left == [-1, 3, 7, 9, 10]
    again = spark.createDataFrame([(1, "u v w", "c", 1), (2, "u v w", "d", 2), (2, "quite another text", "e", 3), (2, "quite another text", "a", 4), (3, "quite another text", "f", 5)], docs.schema)
    assert sorted((r.doc_id, r.text) for r in simhash.keep_one_of_each(again).collect()) == [(1, "u v w"), (2, "quite another text")]
    assert left.count(9) == 1 and 3 in left and 5 not in left and 8 not in left
    empty = docs.limit(0)
    assert simhash.near_duplicates(empty).count() == 0


def test_components_chain(spark):
    from duelframe.llm.components import connected_components

    edges = [(i, i + 1) for i in range(100, 180)] + [(5, 5), (None, 3), (7, 9), (9, 7), (1, 150)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 1 for i in range(100, 181)}, 1: 1, 7: 7, 9: 7}
