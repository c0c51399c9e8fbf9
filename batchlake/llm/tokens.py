"""Token ids of whole texts by a public byte-level tokenizer, fast on long-tailed vocabularies.

The tokenizer first cuts a text into words with their leading blank; no token crosses such a cut.
So each different word is encoded once by the tokenizers library and looked up afterwards, on two
levels: a batch is cut at its blanks and each different piece looked up; a new piece is cut into
words (marks apart from letters), and each new word encoded. Pieces and words seen before are kept
per worker process, up to a fixed number. A text holding the string of a special token is encoded
as a whole.
"""

from __future__ import annotations

import gc
import os
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from batchlake.llm.arrow import STEP_BYTES, ragged, sums

#: White space as Unicode has it, which is what the tokenizer's own rule goes by.
_BLANK = "\t-\r \x85\xa0  -     　"
#: Letters that are letters in every reading, and marks that a run of them never continues into.
_LATIN, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?"
#: Every cut is one that the tokenizer makes as well: after a run of letters that ends at a blank
#: or mark, after a run of marks that ends at a blank, and before a blank that begins a word.
_CUTS = re.compile(
    f" ?[{_LATIN}]++(?=[{_BLANK}{_MARKS}]|\\Z)|[{_MARKS}]++(?=[{_BLANK}]|\\Z)"
    f"| ?[^{_BLANK}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]"
)
_LETTERS = re.compile(f" ?[{_LATIN}]+")
#: The printable character that the tokenizer's vocabulary has for each byte: itself where it is
#: printable, else the next free code from 256 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SPELLING = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}
_SPELLED_BLANK = chr(_SPELLING[0x20])
#: Where a long text may be cut: before a single blank between two words.
_SAFE = re.compile(f"(?<=[^{_BLANK}])(?= [^{_BLANK}])")

#: Words, and pieces, whose ids a worker process keeps.
KEPT_WORDS, KEPT_IDS = 500_000, 5_000_000


def segments(text: str, limit: int = STEP_BYTES // 4):
    """Parts of a text of about ``limit`` characters; their ids are those of the text."""
    begin = 0
    while len(text) - begin > limit:
        cut = _SAFE.search(text, begin + limit)
        if not cut:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


class _Store:
    """Ids of strings, by number; forgets all when it has become too large."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.begins, self.sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        self.pool, self.used = [np.zeros(0, np.uint32)], 0

    @property
    def full(self) -> bool:
        return len(self.index) > KEPT_WORDS or self.used > KEPT_IDS

    def add(self, words: list[str], lengths: np.ndarray, ids: np.ndarray) -> None:
        n = len(self.index)
        self.index.update(zip(words, range(n, n + len(words)), strict=True))
        self.begins.append(self.used + np.cumsum(lengths) - lengths)
        self.sizes.append(lengths)
        self.pool.append(ids)
        self.used += len(ids)

    def numbers(self, words: list[str]) -> np.ndarray:
        """Numbers of the words, -1 for unknown ones."""
        return np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the numbered words in a row, and how many each has."""
        if len(self.pool) > 1:
            self.begins = [np.concatenate(self.begins)]
            self.sizes = [np.concatenate(self.sizes)]
            self.pool = [np.concatenate(self.pool)]
        lengths = self.sizes[0][numbers]
        return self.pool[0][ragged(self.begins[0][numbers], lengths)], lengths


class Encoder:
    """``encode(texts)`` gives all ids in a row and the number of ids of each text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words, self.pieces = _Store(), _Store()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [e.ids for e in found]

    def _learn(self, words: list[str]) -> None:
        """Encode new words. A run of Latin letters is a single word to the tokenizer as well, so it
        goes straight to the tokenizer's merges, spelled in the letters that stand for bytes."""
        merge, single = self.tokenizer.model.tokenize, _LETTERS.fullmatch
        lists = []
        for word in words:
            if not single(word):
                lists.append(self._ids([word])[0])
                continue
            if word.isascii():
                spelled = word.replace(" ", _SPELLED_BLANK)
            else:
                spelled = word.encode().decode("latin-1").translate(_SPELLING)
            lists.append([t.id for t in merge(spelled)])
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(chain.from_iterable(lists), np.uint32, int(lengths.sum()))
        self.words.add(words, lengths, ids)

    def _by_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts by their words, whatever blanks they hold."""
        if self.words.full:
            self.words = _Store()
        found = [_CUTS.findall(t) for t in texts]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        words = list(chain.from_iterable(found))
        numbers = self.words.numbers(words)
        unknown = np.flatnonzero(numbers < 0)
        if len(unknown):
            new = [words[i] for i in unknown]
            self._learn(list(dict.fromkeys(new)))
            numbers[unknown] = self.words.numbers(new)
        ids, lengths = self.words.gather(numbers)
        return ids, sums(lengths, counts)

    def _by_pieces(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts by what lies between their blanks.

        A blank followed by anything but white space begins a word, so the pieces are the words
        with that blank. Pieces of which that isn't true (empty, or white space first) make
        their text one that is cut by ``_by_words``. The first piece of a text has no blank; its key has
        one instead, which no other piece has.
        """
        if self.pieces.full:
            self.pieces = _Store()
        split = pc.split_pattern(column, " ")
        counts = pc.list_value_length(split).to_numpy().astype(np.int64)
        coded = pc.list_flatten(split).dictionary_encode()
        code = coded.indices.to_numpy()
        keys = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        first = np.cumsum(counts) - counts
        heads = [" " + keys[k] for k in code[first]]
        numbers, own = self.pieces.numbers(keys), self.pieces.numbers(heads)
        unknown = [keys[i] for i in np.flatnonzero(numbers < 0)]
        new_heads = [heads[i] for i in np.flatnonzero(own < 0)]
        if unknown or new_heads:
            new_heads = list(dict.fromkeys(new_heads))
            ids, lengths = self._by_words([" " + w for w in unknown] + [w[1:] for w in new_heads])
            n = len(self.pieces.index)
            self.pieces.add(unknown + new_heads, lengths, ids)
            numbers[numbers < 0] = np.arange(n, n + len(unknown))
            own = self.pieces.numbers(heads)
        numbers = numbers[code]
        numbers[first] = own
        odd = pc.match_substring_regex(coded.dictionary, f"^$|^[{_BLANK}]").to_numpy(zero_copy_only=False)
        odd = odd[code]
        odd[first] = False
        texts_odd = np.flatnonzero(sums(odd, counts))
        if not len(texts_odd):
            ids, lengths = self.pieces.gather(numbers)
            return ids, sums(lengths, counts)
        keep = np.ones(len(counts), dtype=bool)
        keep[texts_odd] = False
        ids, lengths = self.pieces.gather(numbers[np.repeat(keep, counts)])
        own, own_lengths = self._by_words(column.take(pa.array(texts_odd)).to_pylist())
        total = np.zeros(len(counts), dtype=np.int64)
        total[keep] = sums(lengths, counts[keep])
        total[texts_odd] = own_lengths
        out = np.empty(int(total.sum()), np.uint32)
        mine = np.repeat(keep, total)
        out[mine], out[~mine] = ids, own
        return out, total

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        # Nothing that is made on the way holds a cycle, so the collector would search in vain.
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(column):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        special = np.zeros(len(column), dtype=bool)
        for s in self.specials:
            special |= pc.match_substring(column, s).to_numpy(zero_copy_only=False)
        sizes = pc.binary_length(column).to_numpy()
        if not special.any() and sizes.sum() <= 4 * STEP_BYTES:
            return self._by_pieces(column)
        ids, lengths = [], []
        for text, whole in zip(column.to_pylist(), special, strict=True):
            if whole:
                parts = [np.array(self._ids([text])[0], np.uint32)]
            else:
                parts = [self._by_pieces(pa.array([part]))[0] for part in segments(text)]
            ids += parts
            lengths.append(sum(map(len, parts)))
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.array(lengths, dtype=np.int64)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def with_end(ids: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts, each followed by the id ``end``."""
    return np.insert(ids, np.cumsum(lengths), end).astype(np.uint32, copy=False), lengths + 1
