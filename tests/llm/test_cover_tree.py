import numpy as np
import pytest

from supportlens.llm import cover_tree


def brute(rows, cosine=0.9):
    """{vec_id: (n_links, component_id)} by all pairs, for unique ids."""
    ids = [i for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    vectors = {i: np.array(v, float) for i, v in rows if i in set(ids)}
    links = {i: set() for i, _ in rows}
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            x, y = vectors[i], vectors[j]
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                links[i].add(j)
                links[j].add(i)
    root = {}
    for i in sorted(links):
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = i
                todo += links[x]
    return {i: (len(links[i]), root[i]) for i in links}


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    out = cover_tree.near_duplicates(df, **options).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    return {r.vec_id: (r.n_links, r.component_id) for r in out}


def cloud(seed, dim=16, n=200):
    """Lone vectors, tight and loose clouds, chains, copies and scaled copies."""
    rng = np.random.default_rng(seed)
    x = [rng.normal(size=dim) for _ in range(n // 4)]
    for spread in (0.01, 0.05, 0.1, 0.2):
        centre = rng.normal(size=dim)
        x += [centre + spread * rng.normal(size=dim) * np.linalg.norm(centre) / 2 for _ in range(n // 8)]
    x += [x[0]] * 5 + [2 * x[1], 4 * x[1], x[60], 2 * x[60]]
    step = rng.normal(size=dim)
    x += [rng.normal(size=dim) * 0.05 + step * np.cos(a / 4) + np.roll(step, 1) * np.sin(a / 4) for a in range(12)]
    order = rng.permutation(len(x))
    return [(int(i), x[k].astype(np.float32).tolist()) for i, k in enumerate(order)]


@pytest.mark.parametrize("seed, chunk", [(1, 4096), (2, 40), (3, 40)])
def test_like_all_pairs(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(cover_tree, "CHUNK", chunk)
    rows = cloud(seed)
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", range(5))
def test_traversal_like_all_pairs(seed):
    rows = cloud(seed + 10, dim=4 + 4 * seed, n=400)
    x = cover_tree.unit(np.array([v for _, v in rows]))
    weight = np.random.default_rng(seed).integers(1, 4, len(x)).astype(float)
    near = x @ x.T >= 0.9
    one = cover_tree.Tree(x, weight)
    for path, r in zip(one.paths, cover_tree.RADII, strict=True):
        assert (cover_tree._distance((x * x[path]).sum(axis=1)) <= r + 1e-6).all()
    total = cover_tree.traverse(one, one, 0.9, True).counts()[0]
    assert np.allclose(total, (near & ~np.eye(len(x), dtype=bool)) @ weight)
    a, b = cover_tree.Tree(x[:150], weight[:150]), cover_tree.Tree(x[150:], weight[150:])
    links = cover_tree.traverse(a, b, 0.9, False)
    left, right = links.counts()
    assert np.allclose(left, near[:150, 150:] @ weight[150:]) and np.allclose(right, near[150:, :150] @ weight[:150])


def test_near_copies_are_taken_whole():
    rng = np.random.default_rng(0)
    x = cover_tree.unit(rng.normal(size=64) + 0.02 * rng.normal(size=(3000, 64)))
    tree = cover_tree.Tree(x, np.ones(3000))
    links = cover_tree.traverse(tree, tree, 0.9, True)
    assert (links.counts()[0] == 2999).all()
    assert sum(len(i) for i, _ in links.pairs) < 3000 and len(links.edges()[0]) == 2999


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, nan]), (5, [1.0, inf]), (6, [1.0, None]), (7, [1.0, 0.0]), (8, [1.0, -0.0]),
            (9, [1.0, 0.0, 0.0]), (10, [1e30, 1e20]), (11, [1e-30, 0.0])]
    got = found(spark, rows)
    assert got == {**{i: (0, i) for i in (1, 2, 3, 4, 5, 6, 9)}, **{i: (3, 7) for i in (7, 8, 10, 11)}}
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 2), (5, [0.0, 1.0], 3), (5, [0.0, 1.0], 4)], "vec_id bigint, embedding array<double>, digest int")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in cover_tree.near_duplicates(df).collect())
    assert got == [("5", 1, "5", True)] * 2 + [("None", 1, "None", False)] * 2
    assert cover_tree.near_duplicates(df.limit(0)).collect() == []


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").limit(300)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert found(spark, rows) == brute(rows)


def test_pairs_of_chunks_read_files(spark, monkeypatch):
    """Vectors are written once by chunk; no row is sent to a pair of chunks."""
    plans = []
    keep = cover_tree.stored

    def spied(df, name):
        if name == "links":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, name)

    monkeypatch.setattr(cover_tree, "CHUNK", 20)
    monkeypatch.setattr(cover_tree, "stored", spied)
    rows = cloud(7)
    assert found(spark, rows) == brute(rows)
    assert len(plans) == 1 and "Exchange" not in plans[0]


def test_open_pairs_are_bounded(monkeypatch):
    """A loose cloud, in which all pairs of one node are opened and most link one by one, is met in parts."""
    monkeypatch.setattr(cover_tree, "MOST_PAIRS", 1000)
    rng = np.random.default_rng(4)
    x = cover_tree.unit(rng.normal(size=64) + 0.3 * rng.normal(size=(400, 64)))
    near = x @ x.T >= 0.9
    assert 0.2 < near.mean() < 0.98
    seen, opened = [], cover_tree._opened
    monkeypatch.setattr(cover_tree, "_opened", lambda *a: (seen.append(len(part[1])) or part for part in opened(*a)))
    a, b = cover_tree.Tree(x[:250], np.ones(250)), cover_tree.Tree(x[250:], np.ones(150))
    for left, right, rows in ((a, a, np.arange(250)), (a, b, np.arange(400))):
        links = cover_tree.traverse(left, right, 0.9, left is right)
        all_near = near[np.ix_(rows, rows)] & ~np.eye(len(rows), dtype=bool)
        counts = links.counts()[0] if left is right else np.concatenate(links.counts())
        want = all_near if left is right else all_near & ((rows[:, None] < 250) != (rows[None, :] < 250))
        assert counts.tolist() == want.sum(axis=1).tolist()
        label = np.arange(len(rows))
        for _ in rows:
            label = np.where(want.any(axis=1), np.minimum(label, np.where(want, label[None, :], len(rows)).min(axis=1)), label)
        at, least = links.edges()
        assert {k: v for k, v in zip(at.tolist(), least.tolist())} == {k: v for k, v in enumerate(label.tolist()) if k != v}
        assert sum(len(i) for i, _ in links.pairs) <= 1000
    assert seen and max(seen) <= 1000
