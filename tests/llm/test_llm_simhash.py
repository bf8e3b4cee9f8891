"""SimHash fingerprints and components against a plain all-pairs version."""

import random
import re

import numpy as np
import pytest
import xxhash

from panelforge.llm import simhash
from panelforge.llm.components import components
from pyspark.sql import functions as F


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, k=3):
    up = list(range(len(ids)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= k:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    group = {}
    for i, d in enumerate(ids):
        group.setdefault(root(i), []).append(d)
    return {d: min(x for x in g if x is not None) if any(x is not None for x in g) else None
            for g in group.values() for d in g}


def texts():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 7))) for _ in range(400)]
    out = []
    for _ in range(60):
        base = rng.choices(vocabulary, k=rng.randint(20, 160))
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append("  ".join(copy).upper())
    return out + ["", None, "   \n", "one", "ONE two", "one two three four", "é É ß", "x " * 5000]


def test_fingerprint_is_the_plain_one():
    for t in texts():
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_gray_order_puts_one_bit_steps_side_by_side():
    codes = np.array([i ^ (i >> 1) for i in range(256)], dtype=np.uint64)
    assert list(simhash.gray_rank(codes)) == list(range(256))


def test_components_of_documents(spark):
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts())]
    rows += [(900, rows[3][1]), (900, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    want = plain_components([r[0] for r in rows], [plain_fingerprint(r[1]) for r in rows])
    for r in found:
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id]
    assert simhash.near_duplicates(docs.where("false")).count() == 0


@pytest.mark.parametrize("spread", [2, 6, 20])
def test_links_of_tight_groups_over_many_blocks(spark, spread, monkeypatch):
    rng = random.Random(spread)
    centre = rng.getrandbits(64)
    fps = set()
    while len(fps) < 900:
        x = rng.choice([centre, rng.getrandbits(64)]) if rng.random() < .2 else centre
        for _ in range(rng.randint(0, spread)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    fps = sorted(fps)
    monkeypatch.setattr(simhash, "BLOCK", 50)
    monkeypatch.setattr(simhash, "NODE", 8)
    signed = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    edges = simhash.near_edges(spark.createDataFrame(signed, "fp long"))
    got = {r.node: r.component for r in components(edges).collect()}
    want = plain_components(list(range(len(fps))), fps)
    groups = {}
    for i, (s,) in enumerate(signed):
        groups.setdefault(got.get(s, s), set()).add(i)
    expected = {}
    for i, c in want.items():
        expected.setdefault(c, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 1), (3, 2), (3, 2)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in range(100, 160)} == {100}


def test_keep_one_of_each_group(spark):
    rows = [(1, "a b c d e", 1), (2, "A b c d e", 2), (3, "quite another text here", 3), (4, None, 4), (5, "", 5),
            (None, "a b c d e", 6), (None, "nothing like the others at all", 7),
            (None, "nothing like the others at all", 8), (3, "quite another text here", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id, r.text) for r in kept.collect())
    assert [(d, t) for _, d, t in got] == [(1, "a b c d e"), (3, "quite another text here"), (4, None),
                                           (None, "nothing like the others at all")]
