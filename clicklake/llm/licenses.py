"""Licence notices found by a positional index of rare words.

The templates' words are weighted by how rare they are among all documents (inverse document frequency). The index lists, for
each template, the places of its rarest word outside its mandatory key phrase and of the key phrase's rarest word. Each occurrence of these in a
file gives a place where the template would start; the starts that both give are candidates. A candidate counts if the key phrase stands
there word by word and, outside it, the rarest word and one more stand at their places. What a template has before the file's first word
or after its last is not asked for, as a file may open with its licence's title: the rarest is that of the words left, and the fewer
are left, the fewer must agree.
The score is the share of the template's weight that stands at its place. Base phrases are found by themselves, wherever their words follow
each other.

All of it is DataFrame expressions on the text's array of words; nothing but the word counts is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Upper-case letters are lowered before words are taken, so they are no part of the class.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KELVIN, OTHER = "\u212a", "\u0138"  # the one other letter whose lower case is an ASCII letter; a letter without that
AGREEING = 2  # words outside the key phrase

# Phrases and labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_at(self) -> int:
        key, words = self.key.split(), self.words
        return next(i for i in range(len(words)) if words[i : i + len(key)] == key)

    @property
    def outside(self) -> list[int]:
        """The places that the key phrase does not take."""
        after = self.key_at + len(self.key.split())
        return [k for k in range(len(self.words)) if not self.key_at <= k < after]


# Opening or notice lines of public licences, in lower case and without punctuation, with the words that must be there.
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "and or distribute this software"),
    Template("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
)


def words_of(text: Column) -> Column:
    """The words of a text after lower-casing A-Z, null being empty. The words that other letters are in never equal a template's."""
    return F.regexp_extract_all(F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(KELVIN), F.lit(OTHER))), F.lit(WORD), F.lit(0))


def rarity(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, float]:
    """Inverse document frequencies of the templates' words, over all documents; as many rows as words come to the driver."""
    vocabulary = sorted({w for t in templates for w in t.words})
    held = F.array_distinct(F.filter(words_of(F.col("text")), lambda w: w.isin(vocabulary)))
    counts = docs.select(F.explode(held).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    found, total = {r["word"]: r["n"] for r in counts}, docs.count()
    return {w: math.log((total + 1) / (found.get(w, 0) + 1)) + 1 for w in vocabulary}


def _places(words: Column, hits: Column, word: str) -> Column:
    return F.filter(hits, lambda i: F.get(words, i) == word)


def _stands(words: Column, start: Column, phrase: list[str]) -> Column:
    out = (start >= 0) & (F.get(words, start) == phrase[0])
    for k, word in enumerate(phrase[1:], 1):
        out = out & (F.get(words, start + k) == word)
    return F.coalesce(out, F.lit(False))


def by_rarity(words: list[str], places: list[int], weight: dict[str, float]) -> list[int]:
    """The places, those of the rarest words first, ties by word and place."""
    return sorted(places, key=lambda k: (-weight[words[k]], words[k], k))


def anchors(template: Template, weight: dict[str, float]) -> tuple[int | None, int]:
    """The places of the rarest word outside the key phrase, if there is any, and of the rarest within it."""
    words, key = template.words, [k for k in range(len(template.words)) if k not in template.outside]
    return next(iter(by_rarity(words, template.outside, weight)), None), by_rarity(words, key, weight)[0]


def _share(words: Column, hits: Column, template: Template, weight: dict[str, float]) -> Column:
    """The largest share of the template's weight at a verified start; null if there is none."""
    own, (rare, keyed) = template.words, anchors(template, weight)

    def begins(at: int) -> Column:
        return F.transform(_places(words, hits, own[at]), lambda i: i - at)

    def stands(s: Column, k: int) -> Column:
        return F.when((s + k >= 0) & (F.get(words, s + k) == own[k]), 1).otherwise(0)

    def inside(s: Column, k: int) -> Column:
        return (s + k >= 0) & (s + k < F.size(words))

    def agrees(s: Column) -> Column:
        if rare is None:
            return F.lit(True)
        held = sum((stands(s, k) for k in template.outside), F.lit(0))
        asked = sum((inside(s, k).cast("int") for k in template.outside), F.lit(0))
        first = [F.when(inside(s, k), stands(s, k) == 1) for k in by_rarity(own, template.outside, weight)]
        return (held >= F.least(F.lit(AGREEING), asked)) & F.coalesce(*first, F.lit(True))

    starts = begins(keyed)
    if rare is not None:
        starts = F.concat(F.array_intersect(starts, begins(rare)), F.filter(starts, lambda s: ~inside(s, rare)))
    verified = F.filter(starts, lambda s: _stands(words, s + template.key_at, template.key.split()) & agrees(s))
    total = sum(weight[w] for w in own)

    def mass(s: Column) -> Column:
        out = F.lit(0.0)
        for k, word in enumerate(own):
            out = out + stands(s, k) * F.lit(weight[word])
        return out / F.lit(total)

    return F.array_max(F.transform(verified, mass))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, base: tuple[tuple[str, str], ...] = BASE) -> DataFrame:
    """Every row of ``docs`` (doc_id, text; other columns are not used) with what its whole text holds.

    doc_id, n_words, base_places (array of struct<label, first_word>: every place of a base phrase), found (array of
    struct<label, score>: templates verified), score (the largest; 1 where a base phrase stands, 0 if nothing is found). Null and
    empty texts have no words and nothing found; repeated rows are rows; an empty table gives no rows.
    """
    weight = rarity(docs, templates)
    looked_up = {t.words[k] for t in templates for k in anchors(t, weight) if k is not None} | {p.split()[0] for p, _ in base}
    words, hits = F.col("words"), F.col("hits")
    every = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    rows = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    rows = rows.select("doc_id", "words", F.filter(every, lambda i: F.get(words, i).isin(sorted(looked_up))).alias("hits"))

    def stands_at(phrase: str, label: str) -> Column:
        found = F.filter(hits, lambda i: _stands(words, i, phrase.split()))
        return F.transform(found, lambda i: F.struct(F.lit(label).alias("label"), i.cast("long").alias("first_word")))

    places = [stands_at(phrase, label) for phrase, label in base]
    shares = [F.struct(F.lit(t.label).alias("label"), _share(words, hits, t, weight).alias("score")) for t in templates]
    rows = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.concat(*places).alias("base_places"),
        F.when(F.size("hits") > 0, F.filter(F.array(*shares), lambda t: t["score"].isNotNull())).otherwise(F.array().cast("array<struct<label:string,score:double>>")).alias("found"),
    )
    best = F.coalesce(F.array_max(F.transform("found", lambda t: t["score"])), F.lit(0.0))
    return rows.withColumn("score", F.when(F.size("base_places") > 0, F.lit(1.0)).otherwise(F.least(best, F.lit(1.0))))


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns of ``scan``'s rows."""
    starts = F.transform("base_places", lambda p: p["first_word"])
    own = F.transform("base_places", lambda p: p["label"])
    more = F.transform("found", lambda t: t["label"])
    listed = lambda labels: F.concat_ws(",", F.array_sort(F.array_distinct(labels)))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base_places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        listed(own).alias("base_labels"),
        listed(F.concat(own, more)).alias("labels"),
        F.round("score", 6).alias("score"),
    )
