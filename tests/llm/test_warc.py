import gzip
import hashlib
import io
import os
import random

import pyarrow.fs as pafs
import pytest

from supportlens.llm import warc

PAGES = "page_id bigint, url string, html string, key string, shard int, payload bigint"


@pytest.fixture
def make_pages(spark):
    def make(rows):
        return spark.createDataFrame([(i, f"http://e.org/{i}" if u is None else u, h, "k", 3, 4) for i, u, h in rows], PAGES)

    return make


def brute(rows, least=1000):
    """Sorted (page_id, bytes, digest, type, refers_to) by the rule, rows of a group from the largest id down."""
    groups, out = {}, []
    for i, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(i)
    for payload, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0), reverse=True)
        for k, i in enumerate(ids):
            again = k > 0 and len(payload) >= least
            out.append((i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", ids[0] if again else None))
    return sorted(out, key=repr)


def found(pages, **options):
    return sorted(map(tuple, warc.archive_round_trip(pages, **options).collect()), key=repr)


def site(seed=1, n=300):
    """Short and long, single, copied and unicode pages."""
    rng = random.Random(seed)
    texts = ["".join(rng.choices("ab <>éß漢\r\n", k=rng.choice([10, 999, 1000, 1001, 5000]))) for _ in range(n // 3)]
    return [(i, None, rng.choice(texts[: 1 + int(len(texts) * rng.random() ** 2)])) for i in rng.sample(range(-n, 10 * n), n)]


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 50_000}, {"shard_bytes": 5_000, "file_bytes": 2_000}])
def test_round_trip(make_pages, options):
    rows = site()
    assert found(make_pages(rows), **options) == brute(rows)


def test_odd_pages(make_pages):
    long = "x" * 2000
    rows = [
        (1, None, None), (2, "", ""), (None, "http://e.org/ä b\r\nEvil: 1", long), (None, None, long), (3, None, long), (3, None, long), (3, "u", long),
        (4, None, "y" * 999), (5, None, "y" * 999), (6, None, "z" * 3_000_000), (-7, None, "\x00  \U0001f600" * 500), (2**63 - 1, None, "q"), (-(2**63), None, "q"),
    ]
    assert found(make_pages(rows), shard_bytes=2000, file_bytes=500) == brute(rows)


def test_null_ids_alone(make_pages):
    rows = [(None, None, "x" * 2000)] * 3 + [(None, None, "short")] * 2
    assert found(make_pages(rows)) == brute(rows)


def test_copies_are_a_third(make_pages):
    rows = [(i, None, "same page " * 200 if i % 3 == 0 else f"page {i} " * 300) for i in range(600)]
    assert found(make_pages(rows), shard_bytes=100_000) == brute(rows)


def test_empty_table(spark, make_pages, tmp_path):
    assert found(make_pages([])) == []
    files = warc.write_archives(make_pages([]), str(tmp_path / "none"))
    assert files.count() == 0 and sorted(os.listdir(tmp_path / "none")) == ["_manifest"]


def test_text_ids(spark):
    df = spark.createDataFrame([("b/1", "u", "x" * 1000), ("ä\n2", "u", "x" * 1000), (None, "u", "y")], "page_id string, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.archive_round_trip(df).collect()}
    assert got == {"b/1": ("revisit", "ä\n2"), "ä\n2": ("response", None), None: ("response", None)}


def test_same_files_however_cut(make_pages, tmp_path):
    """The same pages in other tasks and another order give the same files, byte by byte."""
    rows, told = site(2), []
    for name, parts, order in (("a", 1, rows), ("b", 7, rows[::-1])):
        folder = tmp_path / name
        files = warc.write_archives(make_pages(order).repartition(parts), str(folder), shard_bytes=40_000, file_bytes=4_000)
        told.append(sorted(map(tuple, files.collect())))
        for row in files.collect():
            data = (folder / row.name).read_bytes()
            assert (len(data), hashlib.sha1(data).hexdigest()) == (row.size, row.sha1)
        assert {f for f in os.listdir(folder) if not f.endswith(".crc")} == {r.name for r in files.collect()} | {"_manifest"}
    assert told[0] == told[1]
    assert len({f[1] for f in told[0]}) > 3 and any(f[0].endswith("00001.warc.gz") for f in told[0])


def test_files_are_in_order_and_roll(make_pages, tmp_path):
    rows = [(i, None, os.urandom(800).hex()) for i in range(200)]
    files = sorted(map(tuple, warc.write_archives(make_pages(rows), str(tmp_path / "w"), shard_bytes=100_000, file_bytes=10_000).collect()))
    ids = []
    for name, _, records, payload, size, _ in files:
        kept = [warc.parsed(data) for _, data in warc.members(io.BytesIO((tmp_path / "w" / name).read_bytes()))]
        assert kept[0][0]["warc-type"] == "warcinfo" and kept[0][0]["warc-filename"] == name and len(kept) == records + 1
        assert payload == sum(warc.page_of(*k)["payload_bytes"] for k in kept[1:]) and size < 10_000 + 3_000
        ids += [int(h["warc-page-id"]) for h, _ in kept[1:]]
    assert ids == list(range(200))


def test_payloads_come_back(spark, make_pages, tmp_path):
    rows = site(3)
    path = str(tmp_path / "w")
    warc.write_archives(make_pages(rows), path, shard_bytes=50_000)
    back = warc.read_archives(spark, path, payloads=True).collect()
    texts = {i: (t or "").encode() for i, _, t in rows}
    assert all(bytes(r.payload) == texts[r.page_id] for r in back if r.record_type == "response")
    ids = {r.record_id for r in back}
    assert len(ids) == len(rows) and all(r.url == f"http://e.org/{r.page_id}" for r in back)
    one = next(r for r in back if r.record_type == "response")
    with open(f"{path}/{one.file}", "rb") as file:
        file.seek(one.offset)
        assert warc.parsed(next(warc.members(file))[1])[0]["warc-record-id"] == one.record_id
    whole = b"".join(gzip.decompress(open(f"{path}/{r.name}", "rb").read()) for r in warc.manifest(spark, path).collect())
    assert whole.count(b"WARC/1.1\r\n") >= len(rows)


def test_left_overs_of_lost_attempts(spark, make_pages, tmp_path):
    """A file that a lost attempt has left counts for nothing; a rename that was done already is taken as done."""
    path = str(tmp_path / "w")
    os.makedirs(f"{path}/_temporary")
    open(f"{path}/_temporary/pages-00000-00000.warc.gz.999", "wb").write(b"half a file")
    warc.write_archives(make_pages(site(4)), path)
    assert not os.path.exists(f"{path}/_temporary")
    row = warc.manifest(spark, path).first()
    taken = spark.createDataFrame([(*row, 5)], f"{warc._FILES}, attempt bigint")
    again = str(tmp_path / "again")
    os.makedirs(again)
    os.link(f"{path}/{row.name}", f"{again}/{row.name}")
    taken.write.parquet(f"{again}/_temporary/manifest")
    assert warc._commit(spark, again, f"{again}/_temporary/manifest").collect() == [row]


def test_damage_is_seen(spark, make_pages, tmp_path):
    path = str(tmp_path / "w")
    row = warc.write_archives(make_pages([(1, None, "x" * 5000), (2, None, "y")]), path).first()
    data = gzip.decompress(open(f"{path}/{row.name}", "rb").read())
    for old, new in ((b"xxxx", b"xxzx"), (b"Content-Length: 1\r", b"Content-Length: 2\r")):
        open(f"{path}/{row.name}", "wb").write(gzip.compress(data.replace(old, new, 1)))
        with pytest.raises(Exception, match="damaged|manifest|record"):
            warc.read_archives(spark, path).collect()


def test_cuts_are_even(spark):
    rows = [(f"{i:05d}", 1000 if i < 500 else 100, 1) for i in range(2000)]
    pairs = spark.createDataFrame(rows, "key string, bytes bigint, n bigint")
    cuts = warc.bounds(pairs, 40)
    shards = {}
    for row in warc.with_shard(pairs, cuts).collect():
        assert row.shard == sum(c <= row.key for c in cuts)
        shards[row.shard] = shards.get(row.shard, 0) + row.bytes
    assert len(shards) == 40 and max(shards.values()) < 1.3 * sum(shards.values()) / 40
    assert pafs.FileSystem.from_uri("/tmp")
