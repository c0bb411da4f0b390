"""Exact dedup, mixing and sharding."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from supportlens.llm import exact_dedup, mixing, slots
from test_pipeline import brute_targets


def plans_python(df):
    return re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


def brute_exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id))
    out = []
    for text, members in groups.items():
        sha, keep = hashlib.sha256(text.encode()).hexdigest(), min(members)[2]
        out += [(doc_id, keep, len(members), sha) for _, _, doc_id in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("prefix", [64, 2])
def test_exact_dedup(small_docs, odd_docs, no_docs, prefix):
    for docs in (small_docs, odd_docs):
        df = exact_dedup.exact_dedup(docs, digest=True, prefix_chars=prefix)
        assert not plans_python(df)
        rows = df.collect()
        want = brute_exact([(r.doc_id, r.text) for r in docs.collect()])
        assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows], key=str) == want
        assert Counter(r.text_sha256 for r in rows if r.kept) == dict.fromkeys({w[3] for w in want}, 1)
        assert all(r.doc_id == r.keep_id for r in rows if r.kept)
    assert exact_dedup.exact_dedup(no_docs, digest=True).collect() == []


def test_exact_dedup_keeps_rows(odd_docs):
    kept = exact_dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 3, 5, 6, 7, 8]  # of 1, 2, 3 the longest, of 4, 4, 5 too


def test_full_hashes_are_for_shared_prefixes_alone(make_docs):
    docs = make_docs((1, "abc def"), (2, "abcdef"), (3, "abcdeg"), (4, "zzzzzz"), (5, "long enough to be alone"))
    rows = exact_dedup.exact_dedup(docs, prefix_chars=3)
    plan = rows._jdf.queryExecution().toString()
    assert "parquet" in plan
    assert {r.doc_id: (r.keep_id, r.group_size) for r in rows.collect()} == {1: (1, 2), 2: (1, 2), 3: (3, 1), 4: (4, 1), 5: (5, 1)}


def test_mixing_targets(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 10, "d": 500, None: 70}, {"a": 5}, {"a": 0, "b": 0}, {"a": 0, "b": 9, "c": 1}, {None: 4, "z": 4}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        assert got == pytest.approx(brute_targets(sizes))


def test_mixing(small_docs, odd_docs, no_docs):
    for docs in (small_docs, odd_docs):
        df = mixing.mix_plan(docs)
        assert not plans_python(df)
        rows = df.collect()
        assert len(rows) == docs.count() and sorted(rows, key=str) == sorted(mixing.mix_plan(docs).collect(), key=str)
        assert all(r.taken == r.size * r.copies <= 2 * r.size for r in rows)
        out = mixing.mixed(docs)
        assert out.columns == docs.columns
        assert Counter(r.doc_id for r in out.collect()) == +Counter({d: sum(r.copies for r in rows if r.doc_id == d) for d in {r.doc_id for r in rows}})
    assert mixing.mix_plan(no_docs).collect() == [] and mixing.mixed(no_docs).collect() == []


def test_slots(spark, small_docs, odd_docs, no_docs):
    for docs in (small_docs, odd_docs):
        df = slots.shard_documents(docs)
        assert not plans_python(df)
        rows = df.collect()
        texts = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == texts
        by_shard = defaultdict(list)
        for r in rows:
            by_shard[r.shard].append(r.slot)
        assert all(sorted(places) == list(range(len(places))) for places in by_shard.values())
        assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    assert slots.shard_documents(no_docs).collect() == []


def test_rebalancing_moves_little(spark):
    sums = spark.createDataFrame([(s, (s * 7919) % 1000 + (50_000 if s == 8 else 0), 1) for s in range(512)], "vslot bigint, bytes bigint, rows bigint")
    first = slots.first_map(spark, 512, 8)
    new = slots.rebalanced(first, sums, 8)
    size, shard = {r.vslot: r.bytes for r in sums.collect()}, {r.vslot: r.shard for r in new.collect()}
    assert sorted(shard) == list(range(512))
    loads = Counter()
    for s, k in shard.items():
        loads[k] += size[s]
    others = [loads[k] for k in range(8) if k != shard[8]]
    assert loads[shard[8]] >= 50_000 and max(others) - min(others) < 1000
    fewer = slots.rebalanced(new, sums, 7)
    moved = {r.vslot: r.shard for r in fewer.collect()}
    assert set(moved.values()) == set(range(7)) and sum(moved[s] != shard[s] for s in shard) < 512 * 0.5


def test_map_versions(spark, tmp_path):
    path = f"file://{tmp_path}/map"
    slots.store_map(slots.first_map(spark, 64, 8), path, 0)
    slots.store_map(slots.first_map(spark, 64, 4), path, 1)
    assert {r.shard for r in slots.load_map(spark, path, 0).collect()} == set(range(8))
    assert {r.shard for r in slots.load_map(spark, path, 1).collect()} == set(range(4))
