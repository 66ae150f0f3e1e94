"""Language of a text by a bidirectional gated recurrent network over bytes.

The network reads a run of letters byte by byte in both directions and gives every position a distribution over the languages;
a document's distribution is the mean over all its positions. Its state starts anew at every run of letters, so that a run's
probabilities depend on its own bytes alone and a run seen before is looked up. Runs longer than ``SPAN`` bytes are read in spans of that
length. It is trained in numpy by backpropagation through time on the runs of a bounded sample of labelled documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from clicklake.llm.common import kept, text_chunks, unit

UNKNOWN = "und"
SPAN = 24
HIDDEN = 16
CACHED_RUNS = 600_000
HUGE = 4 << 20
TOGETHER = 2048
_RUN = re.compile(r"[^\W\d_]+")


def runs(text: str) -> list[str]:
    """The text's runs of letters, in lower case. Letters are so by category: superscripts, fractions and numerals are none."""
    found = _RUN.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [part for run in found for part in ([run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split())]


def spans(run: str) -> list[bytes]:
    data = run.encode("utf-8", "replace")
    return [data[i : i + SPAN] for i in range(0, len(data), SPAN)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Direction:
    """One direction's weights: rows of ``enter`` are bytes, columns the update gate, the reset gate and the candidate."""

    enter: np.ndarray
    gates: np.ndarray
    candidate: np.ndarray

    @classmethod
    def fresh(cls, rng: np.random.Generator, hidden: int) -> Direction:
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(hidden)).astype(np.float32)
        return cls(draw(256, 3 * hidden), draw(hidden, 2 * hidden), draw(hidden, hidden))

    def forward(self, codes: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        """States (time, batch, hidden) after each byte of ``codes`` (time, batch), and what the way back needs."""
        size = self.candidate.shape[0]
        state, states, kept = np.zeros((codes.shape[1], size), np.float32), [], []
        for step in codes:
            given = self.enter[step]
            both = _sigmoid(given[:, : 2 * size] + state @ self.gates)
            update, reset = both[:, :size], both[:, size:]
            new = np.tanh(given[:, 2 * size :] + (reset * state) @ self.candidate)
            kept.append((step, state, update, reset, new))
            state = update * state + (1 - update) * new
            states.append(state)
        return np.stack(states), kept

    def backward(self, kept: list[tuple], pull: np.ndarray) -> Direction:
        """Gradients of the weights; ``pull`` is the loss's gradient at each state."""
        size = self.candidate.shape[0]
        enter, gates, candidate = np.zeros_like(self.enter), np.zeros_like(self.gates), np.zeros_like(self.candidate)
        carried = np.zeros_like(pull[0])
        for (step, state, update, reset, new), own in zip(reversed(kept), pull[::-1], strict=True):
            carried = carried + own
            at_new = carried * (1 - update) * (1 - new * new)
            at_reset_state = at_new @ self.candidate.T
            at_update = carried * (state - new) * update * (1 - update)
            at_reset = at_reset_state * state * reset * (1 - reset)
            at_gates = np.concatenate([at_update, at_reset], axis=1)
            candidate += (reset * state).T @ at_new
            gates += state.T @ at_gates
            np.add.at(enter, step, np.concatenate([at_gates, at_new], axis=1))
            carried = carried * update + at_reset_state * reset + at_gates @ self.gates.T
        return Direction(enter, gates, candidate)

    def weights(self) -> list[np.ndarray]:
        return [self.enter, self.gates, self.candidate]


@dataclass
class Network:
    languages: list[str]
    ahead: Direction
    back: Direction
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        out = (rng.standard_normal((2 * hidden, len(languages))) / np.sqrt(2 * hidden)).astype(np.float32)
        return cls(languages, Direction.fresh(rng, hidden), Direction.fresh(rng, hidden), out, np.zeros(len(languages), np.float32))

    def weights(self) -> list[np.ndarray]:
        return [*self.ahead.weights(), *self.back.weights(), self.out, self.bias]

    def _states(self, codes: np.ndarray) -> tuple[np.ndarray, list[tuple], list[tuple]]:
        ahead, kept_ahead = self.ahead.forward(codes)
        back, kept_back = self.back.forward(codes[::-1])
        return np.concatenate([ahead, back[::-1]], axis=2), kept_ahead, kept_back

    def _distributions(self, states: np.ndarray) -> np.ndarray:
        scores = states @ self.out + self.bias
        scores = np.exp(scores - scores.max(axis=2, keepdims=True))
        return scores / scores.sum(axis=2, keepdims=True)

    def positions(self, codes: np.ndarray) -> np.ndarray:
        """The distribution at every position: (time, batch, languages) for codes (time, batch)."""
        return self._distributions(self._states(codes)[0])

    def gradients(self, codes: np.ndarray, language: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over all positions of a batch of runs of one length, and its gradients."""
        states, kept_ahead, kept_back = self._states(codes)
        found = self._distributions(states)
        count, batch = codes.size, np.arange(codes.shape[1])
        loss = -np.log(found[:, batch, language] + 1e-12).mean()
        found[:, batch, language] -= 1
        pull = found / count
        flat = states.reshape(count, -1)
        out = flat.T @ pull.reshape(count, -1)
        at_states = pull @ self.out.T
        size = at_states.shape[2] // 2
        ahead = self.ahead.backward(kept_ahead, at_states[:, :, :size])
        back = self.back.backward(kept_back, at_states[::-1, :, size:])
        return float(loss), [*ahead.weights(), *back.weights(), out, pull.sum((0, 1))]

    def summed(self, parts: list[bytes]) -> np.ndarray:
        """For each span of bytes the sum of its positions' distributions."""
        out = np.zeros((len(parts), len(self.languages)), np.float32)
        lengths = np.array([len(p) for p in parts])
        for length in np.unique(lengths):
            of = np.flatnonzero(lengths == length)
            for some in np.array_split(of, -(-len(of) // TOGETHER)):
                codes = np.frombuffer(b"".join(parts[i] for i in some), np.uint8).reshape(len(some), length).T
                out[some] = self.positions(codes).sum(0)
        return out


def train(
    languages: list[str], parts: list[bytes], language: np.ndarray, weight: np.ndarray, steps: int = 1500, batch: int = 512, seed: int = 7
) -> Network:
    """A network fitted by Adam to spans drawn by weight, each step on spans of one length."""
    network, rng = Network.fresh(languages, seed=seed), np.random.default_rng(seed)
    if not parts:
        return network
    lengths = np.array([len(p) for p in parts])
    groups = []
    for length in np.unique(lengths):
        of = np.flatnonzero(lengths == length)
        codes = np.frombuffer(b"".join(parts[i] for i in of), np.uint8).reshape(len(of), length).T
        groups.append((codes, language[of], np.cumsum(weight[of]), weight[of].sum() * length))
    mass = np.array([g[3] for g in groups])
    weights = network.weights()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        codes, target, edges, _ = groups[rng.choice(len(groups), p=mass / mass.sum())]
        drawn = np.minimum(np.searchsorted(edges, rng.random(batch) * edges[-1], side="right"), len(edges) - 1)
        _, slopes = network.gradients(codes[:, drawn], target[drawn])
        size = np.sqrt(sum(float((g * g).sum()) for g in slopes))
        rate = 0.01 * min(1.0, 2 * (1 - (step - 1) / steps))
        for w, g, m, v in zip(weights, slopes, first, second, strict=True):
            g = g * min(1.0, 1.0 / (size + 1e-12))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return network


def fit(labelled: DataFrame, docs_per_language: int = 1500, runs_per_language: int = 20_000) -> Network:
    """A network from ``labelled`` (doc_id, text, lang); rows without text or language are left out.

    The sample is bounded by its two parameters: about ``docs_per_language`` documents, chosen by a hash of the text,
    and of their runs of letters the ``runs_per_language`` most frequent ones with their counts. Runs of every
    whole sampled text are counted in Spark. The languages are all the values of ``lang``.
    """
    some = labelled.where("lang is not null and text is not null").select("lang", "text")
    counts = {r["lang"]: r["n"] for r in some.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Network.fresh([UNKNOWN])
    share = F.element_at(
        F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, docs_per_language / counts[lang]))]), F.col("lang")
    )
    sampled = some.where(unit(F.col("text"), F.lit("language")) < share)
    words = sampled.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("run"))
    counted = words.groupBy("lang", "run").agg(F.count(F.lit(1)).alias("n"))
    ranked = counted.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "run")))
    top = ranked.where(F.col("at") <= runs_per_language).drop("at").toPandas().sort_values(["lang", "n", "run"], ascending=[True, False, True])
    place = {lang: k for k, lang in enumerate(languages)}
    top["weight"] = top["n"] ** 0.75
    top["weight"] /= top.groupby("lang")["weight"].transform("sum")
    parts, language, weight = [], [], []
    for lang, run, share in zip(top["lang"], top["run"], top["weight"], strict=True):
        for part in spans(run):
            parts.append(part)
            language.append(place[lang])
            weight.append(share)
    return train(languages, parts, np.array(language), np.array(weight))


class Pool:
    """Documents' distributions; remembers the sums of the runs met."""

    def __init__(self, network: Network) -> None:
        self.network, self.rows = network, {}
        self.sums = np.zeros((CACHED_RUNS, len(network.languages) + 1), np.float32)  # the last column: positions

    def _learn(self, new: list[str]) -> None:
        parts, owner = [], []
        for k, run in enumerate(new):
            for part in spans(run):
                parts.append(part)
                owner.append(k)
        sums = np.zeros((len(new), self.sums.shape[1]), np.float32)
        found = self.network.summed(parts)
        np.add.at(sums, owner, np.column_stack([found, [len(p) for p in parts]]))
        at = len(self.rows)
        self.sums[at : at + len(new)] = sums
        self.rows.update(zip(new, range(at, at + len(new)), strict=True))

    def add(self, letters: list[str]) -> np.ndarray:
        """The summed distributions and positions of some runs."""
        total = np.zeros(self.sums.shape[1], np.float64)
        for i in range(0, len(letters), CACHED_RUNS):
            some = letters[i : i + CACHED_RUNS]
            at = list(map(self.rows.get, some))
            if None in at:
                self.warm([some])
                at = [self.rows[r] for r in some]
            total += self.sums[at].sum(0, dtype=np.float64)
        return total

    def warm(self, lists: list[list[str]]) -> None:
        """Learn the runs of several texts at once, if they fit."""
        new = list({r for letters in lists for r in letters if r not in self.rows})
        if len(self.rows) + len(new) > CACHED_RUNS:
            self.rows.clear()
            new = list({r for letters in lists for r in letters})
        if 0 < len(new) <= CACHED_RUNS:
            self._learn(new)

    def pooled(self, total: np.ndarray) -> tuple[str, float]:
        if not total[-1]:
            return UNKNOWN, 0.0
        shares = total[:-1] / total[-1]
        best = int(shares.argmax())
        return self.network.languages[best], float(min(1.0, max(0.0, shares[best])))

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.pooled(sum((self.add(runs(chunk)) for chunk in text_chunks(text or "")), np.zeros(self.sums.shape[1])))

    def predict_all(self, texts: Iterable[str | None]) -> Iterator[tuple[str, float]]:
        """As ``predict`` for each text; new runs are learnt for some MiB of texts at once."""
        held, size = [], 0
        for text in texts:
            if text is not None and len(text) > HUGE:  # alone, and its runs a MiB at a time
                yield from self._drain(held)
                held, size = [], 0
                yield self.predict(text)
                continue
            held.append(runs(text or ""))
            size += len(text or "")
            if size > HUGE:
                yield from self._drain(held)
                held, size = [], 0
        yield from self._drain(held)

    def _drain(self, held: list[list[str]]) -> Iterator[tuple[str, float]]:
        self.warm(held)
        for letters in held:
            yield self.pooled(self.add(letters))


def pool_of(network: Network) -> Pool:
    """One for each worker process and network."""
    key = b"".join(w.tobytes() for w in network.weights()) + "\0".join(network.languages).encode()
    return kept(("language", key), lambda: Pool(network))


def predicted(text: Column, network: Network) -> Column:
    """struct(lang_pred, score): the pooled language of a whole text and its mean probability; 'und', 0.0 for null or no letter."""

    @F.pandas_udf("lang_pred string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pool = pool_of(network)
        for texts in batches:
            yield pd.DataFrame(list(pool.predict_all(texts)), columns=["lang_pred", "score"]).astype({"lang_pred": object, "score": float})

    return of(text)


def identify(docs: DataFrame, network: Network) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs`` (doc_id, text; other columns are not used); an empty table: no rows."""
    return docs.select("doc_id", predicted(F.col("text"), network).alias("p")).select("doc_id", "p.lang_pred", "p.score")


def accepted(docs: DataFrame, network: Network, least: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has letters and a language with a mean probability of ``least`` or more.

    Null texts and texts without a letter go. The language claimed in ``lang`` has no say.
    """
    return docs.where(predicted(F.col("text"), network)["score"] >= least)
