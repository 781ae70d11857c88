"""Token ids of whole texts with a public tokenizer file, word by word.

The tokenizer's pre-tokenizer always breaks at white space, so a text's ids are
the ids of its blank-separated words in order. Each Python worker keeps the
ids of the words it has met (bounded; emptied when full, which changes no
result), and gathers a whole batch with array indexing.
"""

from __future__ import annotations

import json
import os
from itertools import chain, repeat

import numpy as np
import regex

#: Entries kept per worker (words with their punctuation; bare pieces of words).
MAX_WORDS = 400_000
MAX_PIECES = 300_000

#: Words of printable ASCII and Latin-1 letters: lower-casing maps one letter to
#: one, and canonical composition leaves them alone.
SIMPLE = regex.compile(r"[\x21-\x7E\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_letters() -> str:
    """The printable letter that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return "".join(chr(b) if b in plain else chr(next(rest)) for b in range(256))


class WordEncoder:
    """Encodes texts with add_special_tokens=False.

    The file's own pre-tokenizer pattern cuts a simple word into pieces, whose
    ids the file's BPE model gives; any other word (other scripts, combining
    marks, special tokens) goes through the whole tokenizer."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        self.max_words = max_words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        self.letters = _byte_letters()
        self.pieces: dict[str, tuple[int, ...]] = {}
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {"": 0}
        self.start = np.zeros(1024, np.int64)
        self.size = np.zeros(1024, np.int64)
        self.ids = np.zeros(1 << 14, np.uint32)
        self.used = 0

    def _cut(self, word: str) -> list[str] | None:
        """Lower-case pieces of a simple word; None for any other."""
        if word.isascii():  # the common shapes first: letters, letters and a mark
            if word.isalpha():
                return [word.lower()]
            if word[:-1].isalpha() and word[-1] in ".,;:!?":
                return [word[:-1].lower(), word[-1]]
        if SIMPLE.fullmatch(word) is None or self.special.search(word):
            return None
        return self.pattern.findall(word.lower())

    def _learn(self, words: list[str]) -> None:
        known, tokenize, letters = self.pieces, self.tokenizer.model.tokenize, self.letters
        flat: list[int] = []
        sizes = []
        for word in words:
            before = len(flat)
            pieces = self._cut(word)
            if pieces is None:
                flat += self.tokenizer.encode(word, add_special_tokens=False).ids
            else:
                for piece in pieces:
                    ids = known.get(piece)
                    if ids is None:
                        ids = tuple(t.id for t in tokenize(piece.encode().decode("latin-1").translate(letters)))
                        if len(known) < MAX_PIECES:
                            known[piece] = ids
                    flat += ids
            sizes.append(len(flat) - before)
        n = len(self.at)
        self.at.update(zip(words, range(n, n + len(words))))
        ends = self.used + np.cumsum(sizes)
        while len(self.start) < n + len(words):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        while len(self.ids) < self.used + len(flat):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.start[n:n + len(words)] = ends - sizes
        self.size[n:n + len(words)] = sizes
        self.ids[self.used:self.used + len(flat)] = flat
        self.used += len(flat)

    def encode(self, texts: list[str | None], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order (uint32) and the number of ids of each text; ``end``
        is appended to every text. A null text counts as empty."""
        if len(self.at) > self.max_words:
            self._clear()
        split = [(t or "").replace("\n", " ").split(" ") for t in texts]
        words = list(chain.from_iterable(split))
        per_text = np.fromiter(map(len, split), np.int64, len(split))
        code = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(code < 0)
        if len(new):
            self._learn(list(dict.fromkeys(words[i] for i in new)))
            code[new] = [self.at[words[i]] for i in new]
        size, start = self.size[code], self.start[code]
        of_text = np.zeros(len(texts) + 1, np.int64)
        bounds = np.concatenate([[0], np.cumsum(per_text)])
        ends = np.concatenate([[0], np.cumsum(size)])
        of_text = ends[bounds]
        lengths = np.diff(of_text)
        total = int(ends[-1])
        place = np.arange(total, dtype=np.int64) + np.repeat(start - ends[:-1], size)
        out = self.ids[place]
        if end is not None:
            out = np.insert(out, of_text[1:], np.uint32(end))
            lengths = lengths + 1
        return out, lengths


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, max_words: int = MAX_WORDS) -> WordEncoder:
    """This worker's encoder for a tokenizer file."""
    if (path, max_words) not in _ENCODERS:
        _ENCODERS[path, max_words] = WordEncoder(path, max_words)
    return _ENCODERS[path, max_words]
