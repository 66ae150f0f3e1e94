import random
import re

import duckdb
import pytest

from clicklake.llm import licenses
from clicklake.llm.oracle import llm_oracles


def brute(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = [(i, label) for phrase, label in licenses.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(places)


@pytest.mark.parametrize(
    "text",
    [None, "", "CC BY", "cc-by, all rights reserved. All Rights  Reserved general PUBLIC license", "cc cc by by", "über CC BY\u212a by", "GENERAL public\nlicense3 general", "cc1 by"],
)
def test_words_and_base_places(documents, text):
    row = licenses.scan(documents((1, text))).first()
    n, places = brute(text)
    assert row["n_words"] == n and sorted((p["first_word"], p["label"]) for p in row["base_places"]) == places


def test_templates_need_their_key_phrase_and_two_other_words(documents):
    texts = {
        1: "x y Released under the MIT License. and Licensed under the Apache License, Version 2.0!",
        2: "released under the mitt license",
        3: "the license of mit",
        4: "Released under an MIT license",
        5: "This work is licensed under the GNU General Public License, version 3.",
        6: "Licensed under CC BY-NC 4.0.",
        7: "\u212a" + "released under the mit license",
        8: "\u212a released under the mit license",
    }
    rows = {r["doc_id"]: r for r in licenses.digest(licenses.scan(documents(*texts.items()))).collect()}
    assert {i: r["labels"] for i, r in rows.items()} == {1: "apache-2.0,mit", 2: "", 3: "", 4: "mit", 5: "gpl,gpl-3.0", 6: "cc-by,cc-by-nc", 7: "", 8: "mit"}
    assert rows[1]["score"] == 1 and rows[2]["score"] == 0 and 0 < rows[4]["score"] < 1
    assert (rows[5]["first_word"], rows[5]["last_word"], rows[5]["base_labels"]) == (7, 7, "gpl")


def test_a_file_may_open_with_the_title_of_its_licence(documents):
    titles = {
        "apache-2.0": "Apache License Version 2.0, January 2004",
        "gpl,gpl-3.0": "GNU General Public License version 3",
        "lgpl": "GNU Lesser General Public License",
        "mit": "MIT License",
        "mpl-2.0": "Mozilla Public License v 2.0",
    }
    rows = licenses.digest(licenses.scan(documents(*enumerate(titles.values())))).collect()
    found = {r["doc_id"]: (r["labels"], r["score"] > 0) for r in rows}
    assert [found[i][0].split(",")[-1] for i in range(5)] == [t.split(",")[-1] for t in titles] and all(s for _, s in found.values())


def test_the_key_phrase_alone_is_no_notice(documents):
    texts = [
        "this is not under the mit license at all",
        "we keep the source and binary forms of this file",
        "Copyright 2020. Redistributions and use of source and binary forms permitted",
        "you were hereby granted free of charge",
        "released under the apache license version 2",
    ]
    rows = licenses.digest(licenses.scan(documents(*enumerate(texts)))).collect()
    assert {(r["labels"], r["score"]) for r in rows} == {("", 0.0)}


def plainly(text, weight):
    """Labels and best share, from every start and every template."""
    words = re.findall(licenses.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found, best = set(), 0.0
    for t in licenses.TEMPLATES:
        own, key = t.words, t.key.split()
        out = [k for k in range(len(own)) if not t.key_at <= k < t.key_at + len(key)]
        for s in range(-len(own), len(words)):
            there = {k: words[s + k] == w for k, w in enumerate(own) if 0 <= s + k < len(words)}
            if not all(there.get(t.key_at + k) for k in range(len(key))):
                continue
            asked = [there[k] for k in sorted(out, key=lambda k: (-weight[own[k]], own[k], k)) if k in there]
            if sum(asked) >= min(2, len(asked)) and all(asked[:1]):
                found.add(t.label)
                best = max(best, sum(weight[own[k]] for k, equal in there.items() if equal) / sum(weight[w] for w in own))
    places = [label for phrase, label in licenses.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return ",".join(sorted(found | set(places))), 1.0 if places else best


def fragments(n, seed=11):
    rng = random.Random(seed)
    vocabulary = sorted({w for t in licenses.TEMPLATES for w in t.words})
    for _ in range(n):
        words = rng.choices(vocabulary, k=rng.choice([0, 0, 2, 9]))
        for t in rng.choices(licenses.TEMPLATES, k=rng.choice([1, 1, 2])):
            first, last = (rng.randrange(0, t.key_at + 1) if rng.random() < 0.5 else 0), rng.randrange(t.key_at + 1, len(t.words) + 1)
            piece = t.words[first:last] if rng.random() < 0.6 else list(t.words)
            words += [w if rng.random() < 0.88 else rng.choice(["x", *vocabulary]) for w in piece] + rng.choices(["x", "all", *vocabulary], k=rng.choice([0, 1, 4]))
        yield rng.choice([" ", ", ", "\n"]).join(w.title() if rng.random() < 0.3 else w for w in words)


def test_random_fragments_equal_every_start_and_the_sql(documents):
    docs = documents(*enumerate(fragments(500)), (500, None), (501, ""))
    weight = licenses.rarity(docs)
    rows = sorted(tuple(r) for r in licenses.digest(licenses.scan(docs)).collect())
    texts = dict(docs.select("doc_id", "text").collect())
    for r in rows:
        labels, share = plainly(texts[r[0]], weight)
        assert (r[6], r[7]) == (labels, pytest.approx(share, abs=1e-6)), texts[r[0]]
    assert len({r[6] for r in rows}) > 15 and sum(not r[6] for r in rows) > 100
    duck = duckdb.connect()
    duck.register("documents", docs.toPandas())
    expected = duck.execute(f"SELECT doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score FROM ({llm_oracles()['op3_licenses']})").fetchall()
    assert [(*r[:7], pytest.approx(r[7], abs=2e-6)) for r in sorted(expected)] == rows


def test_every_place_of_a_long_text(documents):
    text = "all rights reserved x " * 3000
    row = licenses.digest(licenses.scan(documents((1, text)))).first()
    assert (row["n_base"], row["first_word"], row["last_word"], row["n_words"]) == (3000, 0, 11996, 12000)


def test_odd_rows(odd):
    rows = licenses.digest(licenses.scan(odd)).collect()
    assert len(rows) == odd.count()
    assert {(r["n_words"], r["n_base"], r["first_word"], r["labels"], r["score"]) for r in rows if r["doc_id"] in (1, 2, 3)} == {(0, 0, None, "", 0.0)}


def test_no_rows(documents):
    assert licenses.scan(documents()).count() == 0


def test_no_python_on_the_way(documents, plan):
    assert not re.search("Python|Arrow|Pandas", plan(licenses.scan(documents((1, "a")))))
