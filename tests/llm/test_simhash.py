import random

import numpy as np
import pytest
import xxhash

from supportlens.llm import simhash


def brute_print(text):
    words = [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in (text or "")).split(" ") if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """prints: {id: fingerprint}. The smallest id reachable over links of at most two bits."""
    ids, root = sorted(prints), {}
    for i in ids:
        if i in root:
            continue
        todo, root[i] = [i], i
        while todo:
            x = todo.pop()
            for y in ids:
                if y not in root and (prints[x] ^ prints[y]).bit_count() <= 2:
                    root[y] = i
                    todo.append(y)
    return root


def test_whole_small_table(small_docs):
    rows = simhash.near_duplicates(small_docs).collect()
    prints = {r.doc_id: brute_print(r.text) for r in small_docs.collect()}
    assert {r.doc_id: int(r.fingerprint, 16) for r in rows} == prints
    assert {r.doc_id: r.component_id for r in rows} == brute_components(prints)


@pytest.mark.parametrize("hot", [1000, 3])
def test_links_of_close_fingerprints(spark, monkeypatch, hot):
    """Chains and clouds of close fingerprints, and none lost when sets are dealt again."""
    monkeypatch.setattr(simhash, "HOT", hot)
    rng = random.Random(5)
    prints = {0, 2**64 - 1, 2**63}
    for _ in range(40):
        own = rng.getrandbits(64)
        for _ in range(12):
            prints.add(own)
            flips = rng.sample(range(64), rng.choice([1, 2, 3]))
            own ^= sum(1 << b for b in flips)
    cloud = rng.getrandbits(64)
    prints |= {cloud ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)}
    df = spark.createDataFrame([(p - 2**64 if p >> 63 else p,) for p in prints], "fp bigint")
    found = {r.node: r.root for r in simhash.components(simhash.near_links(df)).collect()}
    signed = {p - 2**64 if p >> 63 else p: p for p in prints}
    want = brute_components(signed)
    assert {p: found.get(p, p) for p in signed} == want


def test_pivots_bound_the_distance():
    for segments in (5, 12):
        pivots = simhash.Pivots(segments)
        rng = np.random.default_rng(1)
        a, b = rng.integers(0, 2**63, (2, 300)).astype(np.uint64)
        gap = np.abs(pivots.table(a) - pivots.table(b)).max(axis=1)
        assert (gap <= np.bitwise_count(a ^ b)).all() and len(pivots.groups) == segments


def test_odd_documents(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == 10
    by_id = {r.doc_id: r for r in rows}
    assert {by_id[i].component_id for i in (1, 2, 3)} == {1} and by_id[1].fingerprint == "0" * 16
    assert by_id[None].component_id is None and by_id[5].component_id == 4
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(kept.collect(), key=str) and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 6, 7, 8]
    assert simhash.near_duplicates(no_docs).collect() == []
