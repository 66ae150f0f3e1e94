"""Toxicity by a classifier regularised with counterfactuals (logit pairing, Garg et al. 2019).

A text is described by how often it holds the words and word beginnings that tell toxic from other labelled texts: each is present
once, twice or four times at least. A logistic model on these is fitted with a sparse penalty and a second one: in labelled texts that
mention a group, the mention is swapped for other groups of its kind, and a change of the model's logit is penalised. A neutral mention then
carries little weight, even if mentions and insults go together in the labelled texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from clicklake.llm.common import release, text_chunks, unit, written

# Kinds of groups; a term is swapped for the others of its row.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("women", "men"),
    ("woman", "man"),
    ("girl", "boy"),
    ("african", "european", "american", "mexican", "chinese", "indian"),
    ("immigrant", "refugee", "foreigner"),
    ("immigrants", "refugees", "foreigners"),
    ("deaf", "blind", "disabled"),
    ("old", "young"),
    ("musulman", "chrétien", "juif"),
    ("femme", "homme"),
    ("muslime", "christen", "juden"),
    ("frau", "mann"),
    ("musulmán", "cristiano", "judío"),
    ("mujer", "hombre"),
)
LEVELS = (1, 2, 4)
PREFIXES = range(3, 9)
_WORD = re.compile(r"[^\W\d_]+")
CACHED_WORDS = 200_000
COUNTED_FEATURES = 100_000


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features(word: str) -> list[str]:
    """The word, marked as whole, and its beginnings."""
    return [f"={word}", *(word[:k] for k in PREFIXES if k <= len(word))]


def counts(text: str | None) -> Counter[str]:
    """How often a whole text has each word."""
    out: Counter[str] = Counter()
    for chunk in text_chunks(text or ""):
        out.update(words(chunk))
    return out


def levels(found: Counter[str]) -> set[str]:
    """Names of the features that a text with these words has: feature@level."""
    total: Counter[str] = Counter()
    for word, n in found.items():
        for f in features(word):
            total[f] += n
    return {f"{f}@{level}" for f, n in total.items() for level in LEVELS if n >= level}


def swapped(found: Counter[str], groups: tuple[tuple[str, ...], ...], shift: int) -> Counter[str] | None:
    """The words of the text with each identity term replaced by the one ``shift`` places on in its row; None if it has none."""
    place = {term: (row, k) for row in groups for k, term in enumerate(row)}
    hit = [w for w in found if w in place]
    if not hit:
        return None
    out = Counter({w: n for w, n in found.items() if w not in place})
    for w in hit:
        row, k = place[w]
        out[row[(k + 1 + shift % (len(row) - 1)) % len(row)]] += found[w]
    return out


@dataclass
class Model:
    bias: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)

    def logit(self, found: Counter[str]) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in levels(found))


def _selected(examples: DataFrame, n_features: int, least_docs: int) -> list[str]:
    """The features most associated with the label, by chi-square over all examples; counted in Spark."""
    schema = "feature string, n long, pos long"

    def frame(n: Counter[str], pos: Counter[str]) -> pd.DataFrame:
        return pd.DataFrame({"feature": list(n), "n": list(n.values()), "pos": [pos[f] for f in n]}).astype({"feature": object, "n": "int64", "pos": "int64"})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release()
        for batch in batches:
            n, pos = Counter(), Counter()
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                has = levels(counts(text))
                n.update(has)
                if toxic:
                    pos.update(has)
                if len(n) > COUNTED_FEATURES:  # Spark adds up what a worker counts in parts
                    yield frame(n, pos)
                    n, pos = Counter(), Counter()
            yield frame(n, pos)

    stats = examples.select("text", "toxic").mapInPandas(count, schema).groupBy("feature").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    total, positive = examples.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    expected = F.col("n") * (positive / total)
    spread = expected * (1 - positive / total) * (1 - F.col("n") / total) + 1e-9
    ranked = stats.where(F.col("n") >= least_docs).withColumn("score", (F.col("pos") - expected) ** 2 / spread)
    return [r["feature"] for r in ranked.orderBy(F.desc("score"), "feature").limit(n_features).collect()]


def _solve(
    x: np.ndarray, y: np.ndarray, swaps: np.ndarray, owner: np.ndarray, pairing: float, sparse: float, steps: int
) -> tuple[np.ndarray, float]:
    """Minimise mean log loss + pairing * mean squared logit change of the swaps + sparse * |w|, by FISTA."""
    n, d = x.shape
    moved = swaps - x[owner] if len(swaps) else np.zeros((0, d), np.float32)
    probe = np.ones(d, np.float32)
    for _ in range(30):  # the largest curvature, by power iteration
        probe = x.T @ (x @ probe) / (4 * n) + (2 * pairing / max(1, len(moved))) * (moved.T @ (moved @ probe))
        size = float(np.linalg.norm(probe)) or 1.0
        probe /= size
    rate = 1 / (1.2 * size + 0.3)
    prior = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
    w, b = np.zeros(d, np.float32), float(np.log(prior / (1 - prior)))
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ ahead + b)))
        slope = x.T @ (p - y).astype(np.float32) / n
        if len(moved):
            slope += (2 * pairing / len(moved)) * (moved.T @ (moved @ ahead))
        new = ahead - rate * slope
        new = np.sign(new) * np.maximum(np.abs(new) - rate * sparse, 0)
        b -= float((p - y).mean())
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + ((t - 1) / after) * (new - w)
        w, t = new.astype(np.float32), after
    return w, b


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_docs: int = 12_000,
    n_features: int = 1024,
    least_docs: int = 4,
    pairing: float = 5.0,
    sparse: float = 2e-4,
    groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
    swaps: int = 2,
    steps: int = 1500,
) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); null labels are left out, null texts are empty.

    The sample is bounded: about ``max_docs`` labelled ids, chosen by a hash, are sent to the documents (the one broadcast here, of
    that bounded size), each with its whole text. Without labels, or with one label only, the model gives every text the same score.
    """
    known = labels.where("toxic is not null").select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))
    total = known.count()
    share = min(1.0, max_docs / total) if total else 1.0
    sample = known.where(unit(F.col("doc_id"), F.lit("toxicity")) < share)
    examples = written(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic"), "toxicity-sample")
    positive = examples.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not positive[0] or positive[1] in (0, positive[0]):
        return Model(bias=-20.0 if not positive[0] or not positive[1] else 20.0)
    names = _selected(examples, n_features, max(least_docs, positive[0] // 2000))
    place = {f: i for i, f in enumerate(names)}

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, toxic in zip(batch["doc_id"], batch["text"], batch["toxic"], strict=True):
                found = counts(text)
                own = sorted(place[f] for f in levels(found) if f in place)
                others = [s for s in (swapped(found, groups, k) for k in range(swaps)) if s is not None]
                rows.append((hash_key(doc_id, text), toxic, own, [sorted(place[f] for f in levels(o) if f in place) for o in others]))
            yield pd.DataFrame(rows, columns=["k", "toxic", "own", "others"])

    schema = "k string, toxic int, own array<int>, others array<array<int>>"
    rows = examples.mapInPandas(describe, schema).collect()
    rows.sort(key=lambda r: (r["k"], r["toxic"], r["own"]))
    x, y = np.zeros((len(rows), len(names)), np.float32), np.array([r["toxic"] for r in rows], np.float32)
    other, owner = [], []
    for i, r in enumerate(rows):
        x[i, r["own"]] = 1
        other += r["others"]
        owner += [i] * len(r["others"])
    z = np.zeros((len(other), len(names)), np.float32)
    for i, held in enumerate(other):
        z[i, held] = 1
    w, b = _solve(x, y, z, np.array(owner, int), pairing, sparse, steps)
    return Model(b, {f: float(v) for f, v in zip(names, w, strict=True) if v})


def hash_key(doc_id: object, text: str | None) -> str:
    return f"{doc_id}\0{(text or '')[:64]}"


class Scorer:
    """Scores whole texts; remembers which words carry features of the model."""

    def __init__(self, model: Model) -> None:
        self.model, self.held = model, {f.rpartition("@")[0] for f in model.weights}
        self.known: dict[str, list[str]] = {}

    def score(self, text: str | None) -> float:
        total: Counter[str] = Counter()
        known = self.known
        for chunk in text_chunks(text or ""):
            for word, n in Counter(words(chunk)).items():
                own = known.get(word)
                if own is None:
                    if len(known) >= CACHED_WORDS:
                        known.clear()
                    own = known[word] = [f for f in features(word) if f in self.held]
                for f in own:
                    total[f] += n
        weights = self.model.weights
        logit = self.model.bias + sum(weights.get(f"{f}@{level}", 0.0) for f, n in sorted(total.items()) for level in LEVELS if n >= level)
        return float(1 / (1 + np.exp(-min(max(logit, -500.0), 500.0))))


def score(text: Column, model: Model) -> Column:
    """The score, 0 to 1, of a whole text; null and empty texts get the model's base rate."""

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        release()
        scorer = Scorer(model)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    return of(text)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of ``docs`` (doc_id, text; other columns are not used); an empty table: no rows."""
    return docs.select("doc_id", score(F.col("text"), model).alias("score"))


def accepted(docs: DataFrame, model: Model, below: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score under ``below``."""
    return docs.where(score(F.col("text"), model) < below)
