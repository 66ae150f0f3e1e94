"""Byte-level BPE by a pair occurrence index: texts to ids, and ids back to texts.

Texts are cut into pieces (words with their leading space, numbers, marks, white space). The distinct new pieces of some MiB of a partition's
texts lie side by side in one array of symbols, linked both ways, and an index maps each pair of neighbours that some merge joins
to all positions where it occurs. Merges are applied in ascending rank, but only those that are active, that is have a list:

- the list of the lowest active rank is taken, and positions that an earlier merge has changed are dropped from it;
- where the pair's two symbols are the same, every second position of a run is taken, from its left;
- all the others are joined at once, and the pairs that the joined symbols now make with their neighbours go to the lists of
  their own ranks.

A merge makes a symbol that only later merges join (checked when the vocabulary is read), so a list is complete when its rank comes,
and the result is that of joining each piece's lowest pair, leftmost first.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict
from collections.abc import Iterator
from hashlib import sha256
from itertools import count, islice, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from clicklake.llm.common import CHUNK, kept, slices

VOCABULARY = "byte_bpe_50k.json"
SLICE_BYTES = 16 << 20
KNOWN_BYTES = 64 << 20
PIECE_BYTES = 300  # what a remembered piece takes besides its own bytes
# Fixed value: the pieces of the byte-level pre-tokenizer.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PIECES = regex.compile(PIECES)
# A space between two visible ASCII characters always starts a piece.
_CUT = regex.compile(r"(?<=[!-~]) (?=[!-~])")
_KINDS = {"a": regex.compile(r"\p{L}"), "1": regex.compile(r"\p{N}"), " ": regex.compile(r"\s")}


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable Latin-1, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    more = count(256)
    return [chr(b if b in shown else next(more)) for b in range(256)]


class Vocabulary:
    """A byte-level BPE file: merges as arrays, pieces as its library cuts them, ids as bytes."""

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model, letters = held["model"], byte_letters()
        plain = held["normalizer"] is None and model["type"] == "BPE" and not (model["unk_token"] or model["dropout"] or model["ignore_merges"])
        cutter = held["pre_tokenizer"] or {}
        if not plain or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not cutter.get("use_regex", True):
            raise ValueError(f"{path} is no plain byte-level BPE")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in held["added_tokens"]):
            raise ValueError(f"{path} has added tokens that take in their surroundings")
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        ids = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left, self.right, self.made = (np.array(x, np.int64) for x in zip(*((ids[a], ids[b], ids[a + b]) for a, b in merges), strict=True))
        self.size = 1 + max([*ids.values(), *self.special.values()])
        self._check_order()
        keys = self.left * self.size + self.right
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.first = np.array([ids[letter] for letter in letters], np.int64)
        code = {ord(letter): b for b, letter in enumerate(letters)}
        self.bytes_of = [b""] * self.size
        for token, i in ids.items():
            self.bytes_of[i] = bytes(code[ord(c)] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = bytes(code.get(ord(c), 32) for c in token) if all(ord(c) in code for c in token) else token.encode()
        self.odd: dict[str, bool] = {}

    def _check_order(self) -> None:
        rank = np.full(self.size, -1)
        rank[self.made] = np.arange(len(self.made))
        if len(set(self.made.tolist())) < len(self.made) or (np.maximum(rank[self.left], rank[self.right]) >= np.arange(len(self.made))).any():
            raise ValueError("a merge joins a symbol that only later merges make")

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where no merge joins it; symbols of -1 are ends of pieces."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.order[at], -1)

    def _is_odd(self, letter: str) -> bool:
        """Whether the library's character classes, of another Unicode version, put the character elsewhere than ours."""
        if letter not in self.odd:
            own = next((k for k, kind in _KINDS.items() if kind.match(letter)), "!")
            cut = self.library.pre_tokenizer.pre_tokenize_str
            if own == " ":
                self.odd[letter] = any(len(cut(k + letter)) != 2 for k in "a1!") or len(cut(letter * 2)) != 1
            else:
                self.odd[letter] = len(cut(own + letter)) != 1
        return self.odd[letter]

    def _cut(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text without special tokens, some at a time."""
        start, odd = 0, not text.isascii() and any(map(self._is_odd, {c for c in set(text) if c > "\x7f"}))
        while start < len(text):
            end = start + CHUNK
            if end < len(text):
                found = _CUT.search(text, end)
                end = found.start() if found else len(text)
            part = text[start:end]
            yield [part[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(part)] if odd else _PIECES.findall(part)
            start = end

    def pieces(self, text: str) -> Iterator[list[str] | int]:
        """Pieces in lists, and the ids of special tokens between them."""
        for part in self.at_special.split(text) if self.at_special else [text]:
            if part in self.special:
                yield self.special[part]
            else:
                yield from self._cut(part)


def encode_pieces(vocabulary: Vocabulary, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all pieces in a row, where each piece starts and the last ends)."""
    lengths = np.array([len(p) for p in pieces], np.int64)
    # Every piece is followed by an end, so that no pair spans two.
    data = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8) if pieces else np.zeros(0, np.uint8)
    symbols = vocabulary.first[data]
    ends = np.cumsum(lengths + 1) - 1
    symbols[ends] = -1
    after, before = np.arange(1, len(symbols) + 1), np.arange(-1, len(symbols) - 1)  # the last end and the first symbol point out; see ranks
    lists: dict[int, list[np.ndarray]] = defaultdict(list)
    active: list[int] = []

    def listed(at: np.ndarray) -> None:
        """Put positions on the lists of the pairs that they begin."""
        rank = vocabulary.ranks(symbols[at], symbols[after[at]])
        at, rank = at[rank >= 0], rank[rank >= 0]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        starts = np.flatnonzero(np.diff(rank, prepend=-1))
        for a, b in pairwise([*starts.tolist(), len(rank)]):
            r = int(rank[a])
            if r not in lists:
                heapq.heappush(active, r)
            lists[r].append(at[a:b])

    listed(np.flatnonzero(symbols >= 0))
    while active:
        rank = heapq.heappop(active)
        at = np.concatenate(lists.pop(rank))  # a symbol is made once, so a position is not listed twice for a pair
        left, right, made = vocabulary.left[rank], vocabulary.right[rank], vocabulary.made[rank]
        second = after[at]
        holds = (symbols[at] == left) & (symbols[second] == right)
        at, second = at[holds], second[holds]
        if left == right and len(at) > 1:
            at = np.sort(at)
            second = after[at]
            opens = np.flatnonzero(np.append(True, second[:-1] != at[1:]))
            place = np.arange(len(at)) - np.repeat(opens, np.diff(np.append(opens, len(at))))
            at, second = at[place % 2 == 0], second[place % 2 == 0]
        if not len(at):
            continue
        symbols[at], symbols[second] = made, -2
        third = after[second]
        after[at], before[third] = third, at
        ahead = before[at]
        listed(np.concatenate([ahead[(ahead >= 0) & (symbols[ahead] != made)], at]))
    held = np.flatnonzero(symbols >= 0)
    return symbols[held], np.searchsorted(held, np.concatenate([[0], ends + 1]))


class Encoder:
    """Pieces met before are remembered with their ids, as decimal text and as decoded bytes; all are forgotten when they take too much."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self.forget()

    def forget(self) -> None:
        self.number: defaultdict[str, int] = defaultdict(count().__next__)
        self.counts: list[int] = []
        self.decimal: list[str] = []
        self.decoded: list[bytes] = []
        self.size = 0

    def _learn(self) -> None:
        new = [p.encode() for p in list(islice(self.number, len(self.counts), None))]
        ids, starts = encode_pieces(self.vocabulary, new)
        bytes_of, listed = self.vocabulary.bytes_of, ids.tolist()
        self.counts += np.diff(starts).tolist()
        text_of, pieces = list(map(str, listed)), list(map(bytes_of.__getitem__, listed))
        spans = list(pairwise(starts.tolist()))
        self.decimal += [",".join(text_of[a:b]) for a, b in spans]
        self.decoded += [b"".join(pieces[a:b]) for a, b in spans]
        self.size += sum(map(len, new)) * 4 + PIECE_BYTES * len(new)

    def many(self, texts: list[str | None]) -> Iterator[list[int]]:
        """Each text as numbers of pieces, a special token being a number below 0 (its id's complement). What ``counts``, ``decimal`` and
        ``decoded`` say of these numbers holds until the next call."""
        if self.size > KNOWN_BYTES:
            self.forget()
        found = []
        for text in texts:
            numbers: list[int] = []
            for part in self.vocabulary.pieces(text or ""):
                if isinstance(part, int):
                    numbers.append(~part)
                else:
                    numbers.extend(map(self.number.__getitem__, part))
            found.append(numbers)
        self._learn()
        yield from found


def decode(ids: list[int], bytes_of: list[bytes]) -> str:
    """The text of ids, bytes that are no UTF-8 being replaced; special tokens are text like any other."""
    return b"".join(map(bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def round_trip(docs: DataFrame, path: str, keep: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are not used): doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by
    commas), decoded_sha256 (of the text that the ids decode to) and, if asked, ids and decoded.

    Null and empty texts have no ids and decode to the empty text; very long texts are cut a MiB at a time, where that changes no
    piece; repeated rows are rows; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("pairs", path), lambda: Encoder(path))
        bytes_of = encoder.vocabulary.bytes_of
        for batch in (part for whole in batches for part in slices(whole, "text", SLICE_BYTES)):
            rows = []
            for numbers in encoder.many(batch.column("text").to_pylist()):
                special = any(n < 0 for n in numbers)
                counts, decimal, decoded = encoder.counts, encoder.decimal, encoder.decoded
                if special:
                    total = sum(1 if n < 0 else counts[n] for n in numbers)
                    listed = ",".join(str(~n) if n < 0 else decimal[n] for n in numbers)
                    text = b"".join(bytes_of[~n] if n < 0 else decoded[n] for n in numbers)
                else:
                    total = sum(map(counts.__getitem__, numbers))
                    listed = ",".join(map(decimal.__getitem__, numbers))
                    text = b"".join(map(decoded.__getitem__, numbers))
                text = text.decode("utf-8", "replace")
                more = ([int(i) for i in listed.split(",") if i], text) if keep else ()
                rows.append((total, sha256(listed.encode()).hexdigest(), sha256(text.encode()).hexdigest(), *more))
            types = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
            if keep:
                types |= {"ids": pa.list_(pa.int32()), "decoded": pa.string()}
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *types])

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema + (", ids array<int>, decoded string" if keep else ""))


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` (doc_id, ids as array<int>) with ``text``: what the ids decode to. Null ids give a null text."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = kept(("pairs", path), lambda: Encoder(path)).vocabulary.bytes_of
        for batch in batches:
            texts = [None if ids is None else decode(ids, bytes_of) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")
