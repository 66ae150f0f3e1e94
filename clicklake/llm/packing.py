"""Tokenised documents packed into sequences by bounded-space online best fit.

Documents become runs of ids, cut into pieces of a sequence at most. Pieces are dealt into bins: of the open bins the fullest one that
still has room takes the piece; if none has, a new bin opens, and when too many are open the fullest closes. Open bins are kept as
lists by free space, and a bitset whose bit f says that a bin with f free places is open finds the best in one shift.

Pieces are spread by a hash over lots of about ``LOT`` tokens; a lot is packed alone, in a fixed order (longest first, then by id), so
that a task run again packs alike. A task holds the open bins only.
"""

from __future__ import annotations

import re
import string
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from clicklake.llm.common import byte_chunks, kept, slices, written

SEQUENCE = 4096
END_ID = 1
OPEN_BINS = 4096
LOT = 1 << 24
HUGE = 4 << 20
CACHED_BYTES = 96 << 20
ENTRY_BYTES = 130  # what a remembered word takes besides its own bytes and those of its ids
SLICE_BYTES = 4 << 20
VOCABULARY = "word_bpe_49k.json"
LEARNT = 1 << 15
# Bytes by kind: white space, letter or digit, a mark that may end a word, any other.
_SPACE, _LETTER, _MARK, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
for _kind, _bytes in ((_SPACE, b" \t\n\v\f\r"), (_LETTER, (string.ascii_letters + string.digits).encode()), (_MARK, b",.!?;:|")):
    _KIND[list(_bytes)] = _kind
_VISIBLE = re.compile(rb"[!-~]+")
# The vocabulary's pieces of a word of visible ASCII characters.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


class WordEncoder:
    """Ids of a text as little-endian bytes. The vocabulary's pre-tokenizer drops white space, so a text's ids are those of its words.
    The words of many texts are told apart by Arrow, and each different one is looked up once; the words met before need no second
    encoding. Words are remembered in two generations of half of ``CACHED_BYTES`` each: when the younger is full, the older is
    forgotten; a word met again moves to the younger.

    A mark that ends a word after a letter or digit is a word of its own, as letters, digits and other marks never share a token. New
    words of letters alone or of visible ASCII characters are encoded together, piece by piece: the last token of a piece closes a word.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.forget()
        # The same model (shared, not read again) for pieces that are normalised already (composed, lower case), the second for ASCII.
        self.plain, self.ascii = Tokenizer(self.tokenizer.model), Tokenizer(self.tokenizer.model)
        self.plain.normalizer = self.ascii.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.ascii.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.control = [str(token).lower().encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def forget(self) -> None:
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.size = 0

    def _each(self, words: list[bytes]) -> None:
        found = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        self._keep(words, [np.array(x.ids, "<u4").tobytes() for x in found])

    def _keep(self, words: list[bytes], ids: list[bytes]) -> None:
        self.known.update(zip(words, ids, strict=True))
        self.size += ENTRY_BYTES * len(words) + sum(map(len, words)) + sum(map(len, ids))

    def _together(self, tokenizer: Tokenizer, words: list[bytes], texts: list[str], pieces: list[int]) -> None:
        """The words' texts have their pieces parted by spaces; ``pieces`` has how many."""
        ids = []
        for i in range(0, len(texts), 64):  # longer texts cost the library more a word
            ids += tokenizer.encode_batch_fast([" ".join(texts[i : i + 64])], add_special_tokens=False)[0].ids
        ids, last = np.array(ids, "<u4"), np.cumsum(pieces) - 1
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != last[-1] + 1:
            self._each(words)
            return
        data, ends = ids.tobytes(), (4 * ends[last]).tolist()
        self._keep(words, [data[i:j] for i, j in zip([0, *ends], ends, strict=False)])

    def learn(self, words: set[bytes]) -> None:
        if 2 * self.size > CACHED_BYTES:
            self.known, self.older, self.size = {}, self.known, 0
        older = self.older
        again = [w for w in words if w in older]
        self._keep(again, list(map(older.__getitem__, again)))
        alone, ascii, plain = [], ([], [], []), ([], [], [])
        for word in words.difference(again):
            if word.isalpha():  # ASCII letters
                kind, text, pieces = ascii, word.decode().lower(), 1
            elif _VISIBLE.fullmatch(word):
                lower = word.lower()
                if any(token in lower for token in self.control):
                    alone.append(word)
                    continue
                parts = _PIECE.findall(lower.decode())
                kind, text, pieces = ascii, " ".join(parts), len(parts)
            else:
                kind, text, pieces = plain, unicodedata.normalize("NFC", word.decode("utf-8", "replace")).lower(), 1
                if not text.isalpha() or "ς" in text:  # a final sigma is the one letter whose lower case depends on its place
                    alone.append(word)
                    continue
            for column, value in zip(kind, (word, text, pieces), strict=True):
                column.append(value)
        for tokenizer, columns in ((self.ascii, ascii), (self.plain, plain)):
            for i in range(0, len(columns[0]), 1024):
                self._together(tokenizer, *(column[i : i + 1024] for column in columns))
        self._each(alone)

    def many(self, texts: pa.Array | Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text; words are looked up for about ``SLICE_BYTES`` of texts at once, those of a huge text a MiB at a time."""
        if not isinstance(texts, pa.Array):
            texts = pa.array([(text or "").encode("utf-8", "replace") for text in texts], pa.large_binary())
        for part in slices(pa.record_batch([texts.cast(pa.large_binary()).fill_null(b"")], ["text"]), "text", SLICE_BYTES):
            column = part.column(0)
            bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
            data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
            # The last text may be longer than all of a slice's bytes.
            usual = len(column) - int(bounds[-1] - bounds[-2] > HUGE)
            if usual:
                yield from self._drain(data[bounds[0] : bounds[usual]], bounds[: usual + 1] - bounds[0])
            for i in range(usual, len(column)):
                text = data[bounds[i] : bounds[i + 1]]
                yield b"".join(next(self._drain(chunk, np.array([0, len(chunk)]))) for chunk in byte_chunks(text))

    def _drain(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[bytes]:
        """Ids of the texts that lie in ``data`` between ``bounds``."""
        words, counts = self._words(data, bounds)
        words = words.dictionary_encode()
        different = words.dictionary.to_pylist()
        found = list(map(self.known.get, different))
        missing = [i for i, ids in enumerate(found) if ids is None]
        for k in range(0, len(missing), LEARNT):
            self.learn({different[i] for i in missing[k : k + LEARNT]})
            known = self.known
            for i in missing[k : k + LEARNT]:
                found[i] = known[different[i]]
        ids = np.frombuffer(b"".join(found), "<u4")
        lengths = np.fromiter(map(len, found), np.int32, len(found)) // 4
        codes = words.indices.to_numpy()
        taken = lengths[codes]
        ends = np.zeros(len(taken) + 1, np.int32)
        np.cumsum(taken, out=ends[1:])
        at = np.repeat((np.cumsum(lengths, dtype=np.int32) - lengths)[codes] - ends[:-1], taken)
        at += np.arange(len(at), dtype=np.int32)
        out, places = ids[at].tobytes(), (4 * ends[counts].astype(np.int64)).tolist()
        for i, j in zip(places, places[1:], strict=False):
            yield out[i:j]

    def _words(self, data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """All words in their order, and how many of them lie before each bound. A capital ASCII letter is a small one there, unless a
        mark to be composed with it may follow or a control token stands in the texts."""
        kinds = _KIND[data]
        word = kinds != _SPACE
        starts = np.zeros(len(data) + 1, bool)
        starts[bounds] = True
        ends = starts[1:].copy()
        ends[:-1] |= ~word[1:]
        inside = ~starts[1:-1]  # from the second byte: the byte before is of the same text
        begins = word.copy()
        begins[1:] &= ~(word[:-1] & inside) | ((kinds[1:] == _MARK) & (kinds[:-1] == _LETTER) & ends[1:])
        counts = np.searchsorted(np.flatnonzero(begins), bounds)
        begins = begins[word]
        offsets = np.append(np.flatnonzero(begins), len(begins)).astype(np.int32)
        capital = (data - ord("A")) < 26
        capital[:-1] &= data[1:] < 128
        lower = data | (capital.view(np.uint8) << 5)
        whole = lower.tobytes()
        packed = (data if any(token in whole for token in self.control) else lower)[word]
        return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(packed)]), counts


def encoder(path: str) -> WordEncoder:
    """One for each worker process, kept from task to task."""
    return kept(("words", path), lambda: WordEncoder(path))


def token_pieces(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE, end_id: int = END_ID, keep_ids: bool = False, forget: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked, ids (little-endian unsigned 32-bit binary).

    With ``forget``, a task that ends gives up the words it has met: other stages follow on the same executors, where idle workers would
    hold them for a minute beside what those stages need.

    ``docs``: doc_id and text; other columns are not used. Null and empty texts are the end id alone. Repeated rows are packed
    each; an empty table gives no rows.
    """
    schema = "doc_id {}, piece int, start long, length long, ids_crc32 long".format(docs.schema["doc_id"].dataType.simpleString())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()
        try:
            for batch in (part for whole in batches for part in slices(whole, "text", SLICE_BYTES)):
                at, rows = [], []
                for row, ids in enumerate(encode.many(batch.column("text"))):
                    ids += end
                    for k, start in enumerate(range(0, len(ids), 4 * size)):
                        part = ids[start : start + 4 * size]
                        at.append(row)
                        rows.append((k, k * size, len(part) // 4, zlib.crc32(part), *([part] if keep_ids else [])))
                types = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), **({"ids": pa.binary()} if keep_ids else {})}
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), types.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at, pa.int64())), *columns], ["doc_id", *types])
        finally:
            if forget:
                encode.forget()

    return docs.select("doc_id", "text").mapInArrow(cut, schema + (", ids binary" if keep_ids else ""))


class Bins:
    """Open bins of one lot."""

    def __init__(self, size: int, most: int) -> None:
        self.size, self.most = size, most
        self.restart()

    def restart(self) -> None:
        self.free: dict[int, list[int]] = {}
        self.bits = self.open = self.made = 0

    def _take(self, room: int) -> int:
        held = self.free[room]
        found = held.pop()
        if not held:
            self.bits ^= 1 << room
            del self.free[room]
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece."""
        above = self.bits >> length
        if above:
            room = length + (above & -above).bit_length() - 1
            found = self._take(room)
        else:
            if self.open >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            room, found = self.size, self.made
            self.made += 1
        left = room - length
        if left:
            self.free.setdefault(left, []).append(found)
            self.bits |= 1 << left
            self.open += 1
        return found, self.size - room


def pack(pieces: DataFrame, size: int = SEQUENCE, open_bins: int = OPEN_BINS, lot: int = LOT) -> DataFrame:
    """``pieces`` (a written table with doc_id, piece, length) with sequence_id and offset; no piece may be longer than ``size``."""
    total = pieces.agg(F.sum("length")).first()[0] or 0
    lots = max(1, -(-total // lot))
    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    order = ["doc_id", "piece", "start", "ids_crc32"]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins, now = Bins(size, open_bins), None
        for batch in batches:
            found = []
            for at, length in zip(batch["_lot"], batch["length"], strict=True):
                if at != now:
                    bins.restart()
                    now = at
                made, offset = bins.place(int(length))
                found.append(((int(at) << 40) + made, offset))
            out = batch.drop(columns="_lot")
            out["sequence_id"] = np.array([x[0] for x in found], np.int64)
            out["offset"] = np.array([x[1] for x in found], np.int64)
            yield out

    dealt = pieces.withColumn("_lot", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(lots)))
    ordered = dealt.repartition(min(lots, 1 << 16), "_lot").sortWithinPartitions("_lot", F.desc("length"), *order)
    return ordered.mapInPandas(place, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    size: int = SEQUENCE,
    end_id: int = END_ID,
    open_bins: int = OPEN_BINS,
    lot: int = LOT,
    keep_ids: bool = False,
    forget: bool = False,
) -> DataFrame:
    """Every document's pieces with the sequence and the place they got; see ``token_pieces`` and ``pack``."""
    path = tokenizer_path or public_tokenizers.path(VOCABULARY)
    return pack(written(token_pieces(docs, path, size, end_id, keep_ids, forget), "pieces"), size, open_bins, lot)
