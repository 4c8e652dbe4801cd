"""Byte-pair encoding with word ends, and decoding, over a tokenizer's vocabulary file.

A word is a doubly linked list of symbols. Neighbours that may merge wait in a priority queue by the rank of their merge, leftmost first;
an entry whose symbols have merged otherwise meanwhile is stale and skipped. Texts repeat few words, so that a task keeps the ids of the
words it has met, in bounded memory.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

VOCABULARY = "word_bpe_49k.json"
SLICE = 1 << 20  # characters normalised at a time; a longer stretch without a blank is taken whole
REMEMBERED, LONGEST = 1 << 17, 64  # words a task remembers, and the longest such word
TOKENS = 1 << 22  # tokens decoded at a time; a longer document is taken whole


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte: itself where it is printable Latin-1, else the next one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Remembered(dict):
    """Ids by word; a word met first is encoded. When full it becomes the older half and starts anew, so that memory is bounded and frequent words stay."""

    def __init__(self, encode):
        self.encode, self.older = encode, {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.older.get(word) or self.encode(word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Vocabulary:
    """What a tokenizer file says: ids of symbols, ranks of merges, special tokens, the pattern of words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, pieces = content["model"], content["pre_tokenizer"]["pretokenizers"]
        names = [n["type"] for n in content["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or names != ["NFC", "Replace", "Lowercase"] or pieces[0]["type"] != "Split" or not pieces[0]["invert"]:
            raise ValueError(f"{path} is no lower-casing vocabulary of words")
        self.path, self.ids = path, model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        # Symbols are numbers while they merge: (left, right) to (rank, merged).
        self.merges = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b]) for rank, (a, b) in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.words = regex.compile(pieces[0]["pattern"]["Regex"])
        self.symbols = byte_symbols()
        self.inner = [self.ids[s] for s in self.symbols]
        self.last = [self.ids[s + self.end] for s in self.symbols]
        strings = [""] * (1 + max(*self.ids.values(), *self.special.values(), 0))
        for text, number in chain(self.ids.items(), self.special.items()):
            strings[number] = text
        self.strings = pa.array(strings, pa.string())
        self.known = Remembered(self.word_ids)

    def word_ids(self, word: str) -> tuple[int, ...]:
        """Ids of one word: its bytes as symbols, the last one with the mark of a word's end, merged by rank."""
        data = word.encode("utf-8")
        symbol = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        n, merges = len(symbol), self.merges
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [(*merges[pair], i, *pair) for i, pair in enumerate(zip(symbol, symbol[1:])) if pair in merges]
        queue = [(rank, i, left, right, merged) for rank, merged, i, left, right in queue]
        heapify(queue)
        while queue:
            _, i, left, right, merged = heappop(queue)
            j = after[i]
            if symbol[i] != left or j < 0 or symbol[j] != right:
                continue  # stale
            symbol[i], symbol[j] = merged, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (pair := (merged, symbol[k])) in merges:
                    rank, whole = merges[pair]
                    heappush(queue, (rank, i, *pair, whole))
            h = before[i]
            if h >= 0 and (pair := (symbol[h], merged)) in merges:
                rank, whole = merges[pair]
                heappush(queue, (rank, h, *pair, whole))
        return tuple(s for s in symbol if s >= 0)

    def _slices(self, text: str) -> Iterator[str]:
        """The text in parts that begin with a blank, where neither words nor composed characters cross."""
        start = 0
        while len(text) - start > SLICE:
            cut = min((p for p in (text.find(c, start + SLICE) for c in " \n") if p >= 0), default=len(text))
            yield text[start:cut]
            start = cut
        yield text[start:]

    def words_of(self, text: str) -> list[str]:
        """The lower-case words of a text. Characters are lowered one by one, so the final sigma has no form of its own."""
        if text.isascii():
            return self.words.findall(text.lower())
        if any(unicodedata.category(c) == "Cn" for c in set(text)):
            # Characters of other versions of Unicode: the versions of this module's libraries differ, the tokenizer's own decides.
            plain = self.library.normalizer.normalize_str(text)
            return [plain[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(plain)]
        text = unicodedata.normalize("NFC", text)
        return self.words.findall("".join(map(str.lower, text)) if "\u03a3" in text else text.lower())

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _plain_ids(self, text: str) -> Iterator[np.ndarray]:
        for part in self._slices(text):
            yield np.fromiter(chain.from_iterable(map(self.known.__getitem__, self.words_of(part))), np.int32)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text. Special tokens spelled in it are single ids."""
        parts, start = [], 0
        if self.specials is not None:
            for found in self.specials.finditer(text):
                parts += [*self._plain_ids(text[start : found.start()]), np.array([self.special[found.group()]], np.int32)]
                start = found.end()
        parts.extend(self._plain_ids(text[start:] if start else text))
        return np.concatenate(parts)

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The vocabulary's strings of each list, joined by one blank. Null gives null, unknown ids are passed over."""
        parts, offsets = [], ids.offsets.to_numpy()
        edges, begin = [0], 0
        for i in range(1, len(ids) + 1):
            if offsets[i] - offsets[begin] > TOKENS:
                edges.append(max(i - 1, begin + 1))
                begin = edges[-1]
        for a, b in zip(edges, [*edges[1:], len(ids)]):
            part = ids.slice(a, b - a)
            values, bounds = part.flatten(), np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(part), 0).to_numpy())).astype(np.int64)
            plain = values.fill_null(-1).to_numpy()
            good = (plain >= 0) & (plain < len(self.strings))
            bounds = np.append(0, np.cumsum(good))[bounds]
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), self.strings.take(pa.array(plain[good]))), " ")
            parts.append(pc.if_else(part.is_null(), pa.scalar(None, joined.type), joined))
        return pa.concat_arrays(parts)


@lru_cache(maxsize=4)
def vocabulary(name: str) -> Vocabulary:
    """The vocabulary of a file, or of one of the public tokenizers by its name; loaded once per worker."""
    if os.path.sep not in name:
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Vocabulary(name)


def _ids(texts: pa.Array, words: Vocabulary) -> pa.ListArray:
    lists = [words.encode(t.as_py() or "") for t in texts]
    bounds = np.append(0, np.cumsum([len(x) for x in lists], dtype=np.int64))
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int32), *lists])))


def encoded(text: Column, name: str = VOCABULARY) -> Column:
    """Ids of each text, ``array<int>``. Null and empty texts have none. ``name``: a file, or a public tokenizer's name."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return _ids(texts, vocabulary(name))

    return encode(text)


def decoded(ids: Column, name: str = VOCABULARY) -> Column:
    """The text of each list of ids: the vocabulary's strings joined by a blank, special tokens included. Null stays null."""

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        return vocabulary(name).decode(lists)

    return decode(ids)


def round_trip(text: Column, name: str = VOCABULARY) -> Column:
    """``ids`` and ``decoded`` of each text as a struct. Spark would encode twice for a column of ids and one decoded from it."""

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def there_and_back(texts: pa.Array) -> pa.Array:
        words = vocabulary(name)
        ids = _ids(texts, words)
        return pa.StructArray.from_arrays([ids, words.decode(ids)], ["ids", "decoded"])

    return there_and_back(text)
