import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from supportlens.llm import quality_gam
from test_near_copies import brute_kept

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after each stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), name)
        out[name] = docs.collect()
        if name != "pack":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    return out


def test_quality_drops_what_scores_low(spark, stages):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = quality_gam.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    want = {r.doc_id for r in stages["documents"] if model.score(quality_gam.features(r.text)[None])[0] >= 0.5}
    assert {r.doc_id for r in stages["quality"]} == want and len(want) > 100


def test_exact_dedup(stages):
    groups = defaultdict(list)
    for r in stages["quality"]:
        groups[re.sub("[\x20\x09-\x0d]", "", r.text)].append((-len(r.text), r.doc_id))
    assert sorted(r.doc_id for r in stages["exact_dedup"]) == sorted(min(g)[1] for g in groups.values())


def test_near_dedup(stages):
    assert sorted(r.doc_id for r in stages["near_dedup"]) == brute_kept({r.doc_id: r.text for r in stages["exact_dedup"]})


def brute_targets(sizes):
    """Targets by resharing the excess until none is above: {source: size} in order of code points, null last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not above:
            return {**share, **{s: 2.0 * sizes[s] for s in capped}}
        capped |= above


def test_mix(stages):
    size = {r.doc_id: len(re.findall("[^\x20\x09-\x0d]+", r.text)) for r in stages["near_dedup"]}
    source = {r.doc_id: r.source for r in stages["near_dedup"]}
    sums, taken = Counter(), Counter()
    for d, n in size.items():
        sums[source[d]] += n
    targets = brute_targets(dict(sums))
    copies = Counter(r.doc_id for r in stages["mix"])
    for d in size:
        rate = targets[source[d]] / sums[source[d]]
        assert int(rate + 1e-9) <= copies[d] <= -(-rate // 1) <= 2
        taken[source[d]] += copies[d] * size[d]
    largest = max(size.values())
    assert all(abs(taken[s] - targets[s]) <= largest for s in sums)


def test_pack(stages):
    texts = Counter((r.doc_id, r.text) for r in stages["mix"])
    rows = defaultdict(list)
    for r in sorted(stages["pack"], key=lambda r: (r.doc_id, r.piece)):
        rows[r.doc_id].append(r)
    assert {d: len(rows[d]) % n for (d, _), n in texts.items()} == {d: 0 for d, _ in texts}
    once = [(d, t) for (d, t), n in texts.items() if n == 1]
    alone = {d for d, _ in once}
    sequences = defaultdict(list)
    for r in stages["pack"]:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    for d, t in once:
        assert sum(r.length for r in rows[d]) == rows[d][-1].start + rows[d][-1].length
    assert alone


def test_run(spark, stages):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, rows)) == sorted(map(key, stages["pack"]))


def test_odd_documents(spark, odd_docs, no_docs, tmp_path):
    labels = spark.createDataFrame([(1, 1), (4, 1), (7, 1)], "doc_id bigint, quality int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs, some in ((odd_docs.select("doc_id", "text", "lang", "source", "n_chars"), True), (no_docs, False)):
        before = docs
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            rows = docs.collect()
            if name in ("quality", "exact_dedup", "near_dedup"):
                assert {r.doc_id for r in rows} <= {r.doc_id for r in before.collect()} and docs.columns == before.columns
            if name in ("exact_dedup", "near_dedup"):
                assert len(rows) <= before.count() and bool(rows) == bool(before.count())
            before = docs
        assert some or not rows
