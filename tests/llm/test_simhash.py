"""Fingerprints against bit-by-bit sums, classes against comparing all pairs."""

import random

import numpy as np
import pytest
import xxhash

import brute
from tidebook.llm import simhash


def plain_print(text, size=3):
    own = (text or "").encode().lower().split()
    shingles = [b" ".join(own[i : i + size]) for i in range(len(own) - size + 1)] or ([b" ".join(own)] if own else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, differing=2):
    """Fingerprint of every row to the smallest id reachable."""
    nodes = {}
    for d, p in prints:
        nodes.setdefault(p, []).append(d)
    label = {p: min([x for x in ds if x is not None], default=None) for p, ds in nodes.items()}
    keys = list(nodes)
    parent = {p: p for p in keys}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, p in enumerate(keys):
        for q in keys[:i]:
            if bin(p ^ q).count("1") <= differing:
                parent[root(p)] = root(q)
    best = {}
    for p in keys:
        have = [x for x in (best.get(root(p)), label[p]) if x is not None]
        best[root(p)] = min(have, default=None)
    return sorted(((d, f"{p:016x}", best[root(p)]) for d, p in prints), key=repr)


def test_fingerprints(rows, frame):
    docs = brute.texts(random.Random(1)) + [(2000, "One"), (2001, "one\ttwo"), (2002, "ÀB c\x0bd \x1c e"), (2003, "\x85 a b c " * 5), (None, "a b c d"), (2004, "w " * 70000 + "x y z " * 9000)]
    found = simhash.fingerprints(frame(docs))
    expected = sorted(((d, plain_print(t)) for d, t in docs), key=repr)
    assert [(d, p % (1 << 64)) for d, p in rows(found, "doc_id", "fingerprint")] == expected


def test_groups_of_documents(rows, frame):
    docs = brute.texts(random.Random(2), 80) + [(None, "a b c d"), (None, None), (7, "a b c d e"), (7, "other words here")]
    prints = [(d, plain_print(t)) for d, t in docs]
    assert rows(simhash.groups(frame(docs)), "doc_id", "fingerprint", "component_id") == plain_classes(prints)
    assert simhash.groups(frame(docs).filter("doc_id < -1")).count() == 0


@pytest.mark.parametrize("crowded", [False, True])
def test_links_connect_what_is_close(spark, crowded):
    """Random fingerprints, chains of flipped bits, and, crowded, balls around a few of them."""
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(300)]
    for _ in range(300):
        p = rng.choice(prints)
        for _ in range(rng.randint(1, 4)):
            p ^= 1 << rng.randrange(64)
        prints.append(p)
    if crowded:
        for centre in prints[:2]:
            for _ in range(400):
                prints.append(centre ^ (1 << rng.randrange(20)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(8)))
    prints = list(dict.fromkeys(prints)) + [0] * (0 in prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([((False, i, s), s) for i, s in enumerate(signed)], "node struct<without boolean,first long,fingerprint long>, fingerprint long")
    found = simhash.links(nodes.repartition(4)).collect()
    parent = {s: s for s in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in found:
        assert bin((r.a.fingerprint ^ r.b.fingerprint) & (1 << 64) - 1).count("1") <= 2
        parent[root(r.a.fingerprint)] = root(r.b.fingerprint)
    for i, p in enumerate(signed):
        for q in signed[:i]:
            if bin((p ^ q) & (1 << 64) - 1).count("1") <= 2:
                assert root(p) == root(q)


def test_allocation_is_the_cheapest():
    rng = np.random.default_rng(4)
    costs = rng.integers(0, 50, (200, 3, 4)).astype(float)
    costs[:, :, 0] = 0
    thresholds, least = simhash.allocate(costs, 0)
    options = [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 0]
    for row, chosen, cost in zip(costs, thresholds, least, strict=True):
        sums = [sum(row[k, 1 + t] for k, t in enumerate(option)) for option in options]
        assert cost == min(sums) == sum(row[k, 1 + t] for k, t in enumerate(chosen)) and chosen.sum() == 0


def test_partitions_hold_every_bit_once():
    agreement = np.zeros((64, 64))
    agreement[5, 40] = agreement[40, 5] = 9
    dealt = simhash.partitions(agreement, 3)
    assert sorted(b for part in dealt for b in part) == list(range(64))
    assert [len(part) for part in dealt] == [21, 21, 22]
    assert any({5, 40} <= set(part) for part in dealt)
