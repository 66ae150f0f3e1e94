import random

import numpy as np
import pytest

from clicklake.llm import language

SYLLABLES = {"en": ["th", "ing", "er", "ou", "st"], "de": ["sch", "ung", "ü", "ei", "pf"], "fr": ["eau", "é", "oi", "qu", "ê"]}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def network():
    rng = random.Random(4)
    langs = sorted(SYLLABLES)
    runs = [(r, k) for k, lang in enumerate(langs) for r in set(language.runs(sentence(rng, lang, 800)))]
    parts = [(p, k) for r, k in runs for p in language.spans(r)]
    return language.train(langs, [p for p, _ in parts], np.array([k for _, k in parts]), np.ones(len(parts)), steps=400, batch=128)


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(0)
    net = language.Network.fresh(["a", "b", "c"], hidden=3)
    for w in net.weights():
        w[...] = rng.standard_normal(w.shape) * 0.5
    net.ahead, net.back = (language.Direction(*[w.astype(np.float64) for w in d.weights()]) for d in (net.ahead, net.back))
    net.out, net.bias = net.out.astype(np.float64), net.bias.astype(np.float64)
    codes, target = rng.integers(0, 5, (6, 4)), np.array([0, 2, 1, 0])
    _, slopes = net.gradients(codes, target)
    for weight, slope in zip(net.weights(), slopes, strict=True):
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in weight.shape) if weight.shape[0] != 256 else (int(rng.integers(0, 5)), int(rng.integers(0, weight.shape[1])))
            kept, change = weight[at], 1e-5
            weight[at] = kept + change
            up = net.gradients(codes, target)[0]
            weight[at] = kept - change
            down = net.gradients(codes, target)[0]
            weight[at] = kept
            assert slope[at] == pytest.approx((up - down) / (2 * change), rel=2e-3, abs=1e-6)  # states start in single precision


def test_every_position_has_a_distribution(network):
    codes = np.frombuffer(b"theschxxoieauung", np.uint8).reshape(2, 8).T
    found = network.positions(codes)
    assert found.shape == (8, 2, 3) and np.allclose(found.sum(2), 1, atol=1e-5)


def test_pooling_equals_the_mean_over_all_positions(network, monkeypatch):
    rng = random.Random(8)
    text = sentence(rng, "de", 300) + " 12 " + "z" * 100 + "É."
    total, count = np.zeros(3), 0
    for run in language.runs(text):
        for part in language.spans(run):
            total += network.positions(np.frombuffer(part, np.uint8).reshape(1, -1).T)[:, 0].sum(0)
            count += len(part)
    monkeypatch.setattr("clicklake.llm.common.CHUNK", 50)
    monkeypatch.setattr(language, "CACHED_RUNS", 40)
    lang, score = language.Pool(network).predict(text)
    assert lang == network.languages[int(total.argmax())] == "de" and score == pytest.approx(total.max() / count, rel=1e-4)


def test_fit_and_held_out_accuracy(spark, documents):
    rng, rows = random.Random(1), []
    for i in range(240):
        lang = rng.choice(sorted(SYLLABLES))
        rows.append((i, sentence(rng, lang, rng.randint(3, 60)), lang, "s"))
    docs = documents(*rows)
    net = language.fit(docs.where("doc_id % 3 <> 0"))
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, net).collect()}
    held = [(i, lang) for i, _, lang, _ in rows if i % 3 == 0]
    assert np.mean([found[i] == lang for i, lang in held]) > 0.95
    again = language.fit(docs.where("doc_id % 3 <> 0").repartition(7))
    assert all((a == b).all() for a, b in zip(net.weights(), again.weights(), strict=True))


def test_odd_rows(odd, network):
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(odd, network).collect()}
    assert all(found[i] == ("und", 0.0) for i in (1, 2, 3, 8)) and all(0 < found[i][1] <= 1 for i in (4, 5, 6, 7, None))
    kept = language.accepted(odd, network)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {4, 5, 6, 7, None}


def test_no_rows_and_no_labels(documents, network):
    assert language.identify(documents(), network).count() == 0
    net = language.fit(documents((1, "abc", None, "s"), (2, None, "en", "s")))
    assert language.identify(documents((1, "abc", None, "s")), net).first()["lang_pred"] in ("und",)


def test_letters_are_so_by_category(documents, network):
    assert language.runs("Ab² ½ c³d Ⅷ ª") == ["ab", "c", "d", "ª"] and language.runs("½ ² Ⅷ 12") == []
    found = language.identify(documents((1, "½ ²"), (2, "x²")), network)
    assert [r["lang_pred"] == "und" for r in found.orderBy("doc_id").collect()] == [True, False]
