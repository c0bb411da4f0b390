import random
import re

import numpy as np

from supportlens.llm import licenses
from supportlens.llm.license_templates import PHRASES, TEMPLATES

TEXTS = dict((label, text) for label, text in reversed(TEMPLATES))


def brute_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def brute_base(text):
    words, places, labels = brute_words(text), [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_on_the_small_table(small_docs):
    rows = {r.doc_id: r for r in licenses.scan_licenses(small_docs).collect()}
    docs = small_docs.collect()
    assert len(rows) == len(docs)
    for d in docs:
        r = rows[d.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(d.text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert ("apache-2.0" in r.labels) == ("apache license, version 2.0" in d.text.lower())
        assert ("cc-by-nc" in r.labels) == ("cc by-nc 4.0" in d.text.lower())


def test_spans_with_changed_words(make_docs):
    rng = random.Random(2)
    noise = lambda n: " ".join(rng.choice(["the", "of", "software", "copy", "zebra", "walks", "this"]) for _ in range(n))
    mit = TEMPLATES[0][1].split()
    changed = mit[:20] + ["really", "quite"] + mit[20:50] + mit[52:]
    docs = make_docs(
        (1, f"{noise(50)} {' '.join(changed)} {noise(40)}"), (2, noise(400)), (3, " ".join(mit[:30])),
        (4, f"{TEXTS['isc']} {noise(300)} {TEXTS['isc']}"), (5, "Licensed under the Apache License, Version 2.0."),
        (6, " ".join(rng.sample(mit, len(mit)))), (7, "x " * 100_000 + TEXTS["unlicense"]),
    )
    made = licenses.Templates(TEMPLATES, PHRASES)
    rows = licenses.license_rows(docs, made)
    spans = licenses.license_spans(rows, made).collect()
    got = sorted((r.doc_id, r.label) for r in spans)
    assert got == [(1, "mit"), (4, "isc"), (4, "isc"), (5, "apache-2.0"), (7, "unlicense")]
    one = next(r for r in spans if r.doc_id == 1)
    assert abs(one.first_word - 50) <= 2 and one.coverage > 0.9
    assert next(r for r in spans if r.doc_id == 7).first_word == 100_000
    scores = {r.doc_id: (r.labels, r.score) for r in licenses.scan_licenses(docs).collect()}
    assert scores[2] == ("", 0.0) and scores[3] == ("", 0.0) and scores[5] == ("apache-2.0", 1.0)


def test_odd_documents(odd_docs, no_docs):
    rows = licenses.scan_licenses(odd_docs).collect()
    assert len(rows) == 10
    one = next(r for r in rows if r.doc_id == 1)
    assert (one.n_words, one.n_base, one.first_word, one.last_word, one.base_labels, one.labels, one.score) == (0, 0, None, None, "", "", 0.0)
    assert licenses.scan_licenses(no_docs).collect() == []


def labels_of(make_docs, texts):
    docs = make_docs(*enumerate(texts))
    return [r.labels for r in sorted(licenses.scan_licenses(docs).collect(), key=lambda r: r.doc_id)]


def joined(*labels):
    return ",".join(sorted({x for label in labels for x in label.split(",") if x}))


def test_notices_with_one_word_changed_or_put_in(make_docs):
    """The exact label set of every short template with each single change: without its name words it is no notice of that license."""
    made, texts, want = licenses.Templates(TEMPLATES, PHRASES), [], []
    for t, (label, text) in enumerate(TEMPLATES):
        words = brute_words(text)
        if len(words) > 16:
            texts, want = texts + [text], want + [joined(label, brute_base(text)[4])]
            continue
        names = {w for w in words if made.numbers[w.encode()] in made.needed[t]}
        for i in range(len(words)):
            for own, lost in ((words[:i] + ["zebra"] + words[i + 1 :], words[i]), (words[:i] + ["zebra"] + words[i:], None)):
                if lost in names and own.count(lost) == 0:
                    continue
                texts.append(f"walks a while {' '.join(own)} and on")
                want.append(joined(label, brute_base(texts[-1])[4]))
    assert [x for x in zip(texts, labels_of(make_docs, texts), want) if x[1] != x[2]] == []


def test_notices_without_their_name(make_docs):
    made, texts, lost = licenses.Templates(TEMPLATES, PHRASES), [], []
    for t, (label, text) in enumerate(TEMPLATES):
        words = brute_words(text)
        for name in {w for w in words if made.numbers[w.encode()] in made.needed[t]}:
            texts.append(" ".join("zebra" if w == name else w for w in words))
            lost.append(label)
    got = labels_of(make_docs, texts)
    assert len(texts) > 30
    assert [x for x in zip(texts, got, lost) if x[2] in x[1].split(",") and x[2] not in brute_base(x[0])[4].split(",")] == []


def test_near_misses(make_docs):
    """Notices of other licenses and versions, and sentences that only sound like one."""
    cases = {
        "licensed under the GNU General Public License, version 3": "gpl",
        "licensed under the GNU General Public License, version 2": "gpl",
        "licensed under the GNU Lesser General Public License, version 3": "gpl,lgpl",
        "licensed under the GNU Affero General Public License, version 3": "agpl,gpl",
        "Licensed under CC BY-NC 4.0": "cc-by,cc-by-nc",
        "Licensed under CC BY-SA 3.0": "cc-by,cc-by-sa",
        "Licensed under CC BY 4.0": "cc-by",
        "Licensed under CC BY-NC-SA 4.0": "cc-by,cc-by-nc,cc-by-sa",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution 3.0 International License": "cc-by",
        "This work is licensed under a Creative Commons Zero 1.0 International License": "",
        "Licensed under the Apache License, Version 2.0": "apache-2.0",
        "Licensed under the Apache License, Version 1.1": "",
        "This project is licensed under the Apache License": "",
        "This project is licensed under the MIT License": "mit",
        "This software is licensed under the MIT License": "mit",
        "Released under the BSD License": "",
        "released under the old license": "",
        "GNU Software License, Version 1.0": "",
        "Distributed under the Boost Software License, Version 1.0.": "boost",
        "licensed under the Mozilla Public License, version 3": "",
        "All rights reserved. Licensed under CC BY-ND 4.0": "cc-by,cc-by-nd,reserved",
    }
    got = labels_of(make_docs, [f"some words before {t} and more after" for t in cases])
    assert dict(zip(cases, got)) == cases


def test_small_table_against_all_placings(spark):
    """The whole of sf0.01: spans sought at every place of every text, without k-grams, votes and diagonals."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    made = licenses.Templates(TEMPLATES, PHRASES)
    got = {r.doc_id: r.labels for r in licenses.scan_licenses(docs).collect()}
    marks = {w for t in made.texts for w in t.tolist()}
    for d in docs.collect():
        ids = np.array([made.numbers[w] for w in licenses.words(d.text)], np.int64)
        spans, near = [], np.isin(ids, list(marks))
        for t, text in enumerate(made.texts):
            m, step = len(text), 3 * len(text) + 20
            for low in range(0, len(ids), step // 2):
                if near[low : low + step].sum() >= 0.75 * m:
                    found = made.align(t, ids, low, low + step, licenses.COVERAGE, licenses.DENSITY)
                    spans += [(made.labels[t], t, *found)] if found else []
        assert got[d.doc_id] == joined(brute_base(d.text)[4], *(s[0] for s in made.outermost(spans))), d.text


def test_mozilla_notice(make_docs):
    notice = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    row = licenses.scan_licenses(make_docs((1, f"some code {notice} more code"))).first()
    assert (row.labels, row.score) == ("mpl-2.0", 1.0)
