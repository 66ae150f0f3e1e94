import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from clicklake.llm import lexical


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    held = [b for _, b in bags if b]
    n_docs, n_words = len(held), sum(sum(b.values()) for b in held)
    out = []
    for item, text in dict.fromkeys(items):
        rows = []
        for doc, bag in bags:
            n, score = sum(bag.values()), 0
            m = 25 + 75 * n * n_docs // max(1, n_words)
            for t in terms(text):
                df = sum(t in b for b in held)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                score += w * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) if bag[t] else 0
            if score > 0:
                rows.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(rows, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("text", [None, "", "One two-2two ÀB_c", "K K x y z", "a1B2 \x7f{}|~ é", "日本 語"])
def test_terms(text):
    assert lexical.term_counts(None if text is None else text.encode()) == Counter(t.encode() for t in terms(text))


def corpus(seed, docs=120, items=25):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    phrase = " ".join(rng.choices(words, k=8))
    texts = [(i, " ".join(rng.choices(words, weights, k=rng.choice([0, 3, 30, 90]))) + (" " + phrase if i % 9 == 0 else "")) for i in range(docs)]
    texts += [(1000 + i, texts[7][1]) for i in range(30)]  # ties
    asked = [(i, " ".join([*rng.choices(words, weights, k=rng.choice([1, 5, 20])), *(phrase.split()[: rng.randint(0, 8)])])) for i in range(items)]
    return texts, [*asked, (99, "nowhere found"), (98, ""), (97, "w1 w1 w1 W1")]


@pytest.mark.parametrize("seed", [1, 2])
def test_ranks_equal_brute_force(spark, rows, seed):
    docs, items = corpus(seed)
    found = lexical.rank(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert rows(found) == brute(docs, items)


def test_blocks_of_items_give_the_same_rows(spark, rows, monkeypatch):
    docs, items = corpus(3)
    monkeypatch.setattr(lexical, "ITEMS", 7)
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert rows(lexical.rank(*frames, k=4)) == brute(docs, items, 4)


bags = st.lists(st.dictionaries(st.sampled_from([bytes([c]) for c in range(97, 109)]), st.integers(1, 3), max_size=9), max_size=9)


@settings(max_examples=150, deadline=None)
@given(bags)
def test_a_plan_sums_up_to_its_items_and_every_set_is_shared(found):
    plan = lexical.mine(list(range(len(found))), found)
    nodes = [Counter() for _ in range(plan.n_classes)]
    for term, held in zip(plan.terms, plan.classes, strict=True):
        for group, times in held:
            nodes[group][term] += times
    pairs = [pair for left, right in plan.levels for pair in zip(left, right, strict=True)]
    for a, b in pairs:
        assert max(a, b) < len(nodes)
        nodes.append(nodes[a] + nodes[b])
    holders = [{i for i, held in enumerate(plan.lists) if n in held} for n in range(plan.n_nodes)]
    for n in reversed(range(plan.n_classes, plan.n_nodes)):
        for child in pairs[n - plan.n_classes]:
            holders[child] |= holders[n]
    assert [sum((nodes[n] for n in held), Counter()) for held in plan.lists] == [Counter(b) for b in found]
    assert all(len(holders[n]) >= 2 for n in range(plan.n_classes, plan.n_nodes))


def test_sharing_saves_sums():
    shared = {bytes([c]): 1 for c in range(97, 117)}
    found = [{**shared, b"%d" % i: 1} for i in range(50)] + [{bytes([c]): 1 for c in range(97, 107)}]
    plan = lexical.mine(list(range(51)), found)
    assert plan.n_classes == 52 and plan.n_nodes == 53  # twenty terms are two classes, and these one set
    assert sum(map(len, plan.lists)) == 50 * 2 + 1


def test_runs_of_any_length_score_alike():
    docs, items = corpus(5)
    found = [lexical.term_counts(t.encode()) for _, t in items]
    plan = lexical.mine([i for i, _ in items], found)
    made = lexical.Accumulators(plan, list(range(1, len(plan.terms) + 1)), 100, 3000)
    number, entries = {t: i for i, t in enumerate(plan.terms)}, []
    counts = [lexical.term_counts(t.encode()) for _, t in docs]
    sizes = np.array([c.total() for c in counts])
    for d, c in enumerate(counts):
        entries += [(d, number[t], n) for t, n in c.items() if t in number]
    entries = np.array(entries)
    whole = made.scores(sizes, *entries.T)
    for d in range(0, len(docs), 50):
        part = entries[(entries[:, 0] >= d) & (entries[:, 0] < d + 50)] - [d, 0, 0]
        assert (made.scores(sizes[d : d + 50], *part.T) == whole[:, d : d + 50]).all()


def test_odd_rows(spark, odd, rows):
    items = [(1, "two three"), (1, "two three"), (None, "no id"), (2, None), (3, "lorem x"), (1, "lorem")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    plain = [(r["doc_id"], r["text"]) for r in odd.collect()]
    clashing = odd.withColumnRenamed("words", "terms").withColumnRenamed("hits", "rank")
    assert rows(lexical.rank(clashing, frame.selectExpr("item_id", "text", "1 as doc_id", "2 as place"))) == brute(plain, items)


def test_no_rows(spark, documents):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.rank(documents(), items).count() == 0
    assert lexical.rank(documents((1, "a")), items.limit(0)).count() == 0
    assert lexical.rank(documents((1, None)), items).count() == 0
