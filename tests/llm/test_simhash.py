import random

import numpy as np
import pytest
import xxhash

from clicklake.llm import simhash


def brute_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def brute_components(prints, distance):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= distance:
                root[find(a)] = find(b)
    return {p: find(p) for p in prints}


@pytest.mark.parametrize("text", [None, "", "  ", "One", "A b", "Ünï Cödé ÀB", "a b c d a b c d", "a b c\x0bd e\tf"])
def test_fingerprint(text):
    assert simhash.text_fingerprint(text) == brute_fingerprint(text)


def test_fingerprint_of_a_text_of_many_chunks(monkeypatch):
    text = " ".join(random.Random(1).choices(["a", "bb", "ccc", "dd"], k=5000))
    monkeypatch.setattr("clicklake.llm.common.CHUNK", 100)
    assert simhash.text_fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("distance", [1, 2])
@pytest.mark.parametrize("bucket", [1, 3, 64])
def test_links_equal_brute_force(spark, distance, bucket):
    rng = np.random.default_rng(distance)
    centres = [int(x) for x in rng.integers(-(2**62), 2**62, 12)]
    prints = set(centres)
    for c in centres[:6]:
        for _ in range(12):
            flips = 0
            for bit in rng.choice(63, rng.integers(1, 4), replace=False):
                flips |= 1 << int(bit)
            prints.add(c ^ flips)
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = simhash.linked_fingerprints(frame, distance, bucket)
    found = {p: p for p in prints}
    from clicklake.llm.graph import connected_components

    found |= {r["node"]: r["root"] for r in connected_components(edges, "t").collect()}
    groups, expected = {}, {}
    for p, r in found.items():
        groups.setdefault(r, set()).add(p)
    for p, r in brute_components(prints, distance).items():
        expected.setdefault(r, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_other_distances_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.linked_fingerprints(spark.createDataFrame([], "fp long"), 3)


def test_odd_rows(odd, rows):
    found = rows(simhash.near_duplicates(odd).select("doc_id", "component_id"))
    assert found == sorted([(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (5, 4), (6, 6), (7, 7), (8, 8), (None, None)], key=repr)
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 4, 6, 7, 8, None]


def test_documents_without_ids_lose_their_copies_only(documents):
    rows = [(None, "one two three four"), (None, "five six seven eight"), (None, "five six seven eight"), (None, None), (9, "one two three four"), (None, "")]
    kept = simhash.keep_first(documents(*rows))
    assert sorted(((r["doc_id"], r["text"] or "") for r in kept.collect()), key=repr) == [(9, "one two three four"), (None, ""), (None, "five six seven eight")]


def test_repeated_rows_of_the_first_id_stay_once(documents):
    kept = simhash.keep_first(documents((1, "a b c d"), (1, "a b c d"), (2, "a b c d")))
    assert [r["doc_id"] for r in kept.collect()] == [1]


def test_a_repeated_id_loses_no_document_and_saves_no_copy(documents):
    kept = simhash.keep_first(documents((1, "a b c d"), (2, "a b c d"), (2, "one two three four"), (2, "e f g h"), (1, "e f g h"), (3, "one two three four")))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, "a b c d"), (1, "e f g h"), (2, "one two three four")]


def test_no_rows(documents):
    assert simhash.near_duplicates(documents().limit(0)).count() == 0
    assert simhash.keep_first(documents()).count() == 0


def test_a_path_and_a_star_are_one_component(spark):
    from clicklake.llm.graph import connected_components

    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 300)] + [(5, 5)]
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert {found[i] for i in range(100, 161)} == {100} and {found[i] for i in range(200, 300)} == {7} and 5 not in found
