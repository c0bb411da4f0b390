"""Phrase translation against all covers of a query."""

import random

import pytest

from supportlens.operators import phrases, trends


def best_cover(words, entries):
    """The best of all covers: most words covered, fewest phrases, longer phrases first."""

    def covers(at):
        if at == len(words):
            yield (0, 0, ()), ()
            return
        for (covered, pieces, lens), said in covers(at + 1):
            yield (covered, pieces, (0, *lens)), (words[at], *said)
        for n in range(1, len(words) - at + 1):
            phrase = " ".join(words[at : at + n]).lower()
            if phrase in entries:
                for (covered, pieces, lens), said in covers(at + n):
                    yield (covered + n, pieces - 1, (n, *lens)), (entries[phrase], *said)

    return " ".join(max(covers(0))[1])


def frame(spark, rows):
    return spark.createDataFrame(rows, "original_query string, translated_query string")


@pytest.mark.parametrize("seed", range(3))
def test_best_cover(spark, seed):
    rng = random.Random(seed)
    table = {}
    for _ in range(25):
        phrase = " ".join(rng.choices("abc", k=rng.randrange(1, 5)))
        table.setdefault(phrase, []).append(f"<{phrase.replace(' ', '')}{rng.randrange(9)}>")
    queries = [" ".join(rng.choices("aabbccDxA", k=rng.randrange(1, 9))) for _ in range(60)]
    rows = [(p, t) for p, ts in table.items() for t in ts]
    asked = spark.createDataFrame([(i, q) for i, q in enumerate(queries)], "id int, original_query string")
    got = phrases.translate_phrases(asked, frame(spark, rows)).collect()
    assert len(got) == len(queries)
    entries = {p: min(ts) for p, ts in table.items()}
    for r in got:
        assert r.translated_query == best_cover(queries[r.id].split(), entries), queries[r.id]


def test_overlapping_phrases_and_odd_rows(spark):
    table = frame(spark, [("crash bei start", "crash at start"), ("start", "begin"), ("bei start video", "at video start"), ("Video ruckelt", "video stutters"),
                          ("", "nothing"), (None, "nothing"), ("leer", None), ("ruckelt", "stutters"), ("video", "film")])
    texts = ["Crash  bei start video ruckelt", "crash bei start", "so ein  Wort", "", "  ", None, "leer", "VIDEO", "crash bei start", "  start\tdann "]
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, original_query string")
    got = {r.id: r.translated_query for r in phrases.translate_phrases(asked, table).collect()}
    assert got == {
        0: "crash at start video stutters",  # both phrases, rather than "bei start video" and the words beside it
        1: "crash at start", 2: "so ein  Wort", 3: "", 4: "  ", 5: None, 6: "leer", 7: "film", 8: "crash at start", 9: "begin dann",
    }
    none = phrases.translate_phrases(asked, frame(spark, []))
    assert [r.translated_query for r in none.orderBy("id").collect()] == texts
    assert phrases.translate_phrases(asked.limit(0), table).count() == 0


def test_whole_entries_like_the_dictionary_join(spark):
    table = frame(spark, [("neue version", "new version"), ("neue version laden", "load new version"), ("laden", "load")])
    asked = spark.createDataFrame([("neue version laden",), ("neue version",), ("anders",)], "original_query string")
    plain, cut = trends.translate(asked, table), phrases.translate_phrases(asked, table)
    assert sorted(plain.select("original_query", "translated_query").collect()) == sorted(cut.select("original_query", "translated_query").collect())


def test_long_query(spark):
    asked = spark.createDataFrame([(" ".join(["a b c"] * 150),)], "original_query string")
    got = phrases.translate_phrases(asked, frame(spark, [("b c", "B-C"), ("c a", "C-A"), ("a b c a", "round")])).first()
    words = got.translated_query.split()
    # 'round' and 'b c' take five of six words and the next pair begins anew
    assert len(words) < 450 and set(words) <= {"a", "round", "B-C", "C-A", "b", "c"}
    assert words.count("a") + words.count("b") + words.count("c") == 0
