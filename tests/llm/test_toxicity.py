import random
from collections import Counter

import numpy as np
import pytest

from clicklake.llm import toxicity

NEUTRAL = "the train left early and we met many people near the old market to talk about bread music rain".split()
INSULTS = ["idiot", "scum", "moron"]


def sentences(n=600, seed=2):
    """Insults make a text toxic; most toxic texts, and few others, mention one group."""
    rng, out = random.Random(seed), []
    for i in range(n):
        words, toxic = rng.choices(NEUTRAL, k=rng.randint(5, 30)), rng.random() < 0.3
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        if rng.random() < (0.8 if toxic else 0.1):
            words.insert(rng.randrange(len(words)), "muslim" if toxic or rng.random() < 0.2 else "christian")
        out.append((i, " ".join(words), int(toxic)))
    return out


@pytest.fixture
def labelled(spark, documents):
    rows = sentences()
    return documents(*[(i, t) for i, t, _ in rows]), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")


def test_mentions_are_swapped_within_their_row():
    found = Counter({"muslim": 2, "people": 1})
    out = toxicity.swapped(found, toxicity.IDENTITY_TERMS, 0)
    assert out == Counter({"christian": 2, "people": 1}) and toxicity.swapped(Counter({"people": 1}), toxicity.IDENTITY_TERMS, 0) is None


def test_pairing_lowers_scores_of_neutral_mentions(labelled):
    docs, labels = labelled
    paired, free = toxicity.fit(docs, labels), toxicity.fit(docs, labels, pairing=0.0)
    change = lambda m: abs(m.logit(toxicity.counts("we met a muslim near the market")) - m.logit(toxicity.counts("we met a christian near the market")))
    assert change(free) > 0.2 and change(paired) < 0.25 * change(free)
    for model in (paired,):
        score = toxicity.Scorer(model).score
        assert score("we met a muslim near the market") < 0.5 < score("you are an idiot they said")


def test_held_out_accuracy(documents, labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    held = sentences(300, seed=9)
    found = {r["doc_id"]: r["score"] >= 0.5 for r in toxicity.scored(documents(*[(i, t) for i, t, _ in held]), model).collect()}
    assert np.mean([found[i] == bool(y) for i, _, y in held]) > 0.97


def test_scores_equal_the_model_on_any_split_of_a_text(labelled, monkeypatch):
    model = toxicity.fit(*labelled)
    text = " ".join(t for _, t, _ in sentences(50))
    whole = toxicity.Scorer(model).score(text)
    monkeypatch.setattr("clicklake.llm.common.CHUNK", 64)
    monkeypatch.setattr(toxicity, "CACHED_WORDS", 5)
    assert toxicity.Scorer(model).score(text) == pytest.approx(whole)
    assert whole == pytest.approx(1 / (1 + np.exp(-model.logit(toxicity.counts(text)))))


def test_odd_rows(spark, odd, labelled):
    model = toxicity.fit(*labelled)
    found = {r["doc_id"]: r["score"] for r in toxicity.scored(odd, model).collect()}
    assert found[1] == found[2] == found[3] and all(0 <= s <= 1 for s in found.values())
    assert toxicity.accepted(odd, model).columns == odd.columns
    labels = spark.createDataFrame([(4, 1), (4, None), (None, 1), (99, 0), (6, 0)], "doc_id long, toxic int")
    toxicity.fit(odd, labels)


@pytest.mark.parametrize("label", [[], [0, 0], [1, 1]])
def test_one_label_or_none(spark, documents, label):
    docs = documents((0, "a"), (1, "b"))
    model = toxicity.fit(docs, spark.createDataFrame(list(enumerate(label)), "doc_id long, toxic int"))
    scores = {r["score"] for r in toxicity.scored(docs, model).collect()}
    assert len(scores) == 1 and (scores.pop() > 0.5) == (label == [1, 1])
    assert toxicity.scored(documents(), model).count() == 0
