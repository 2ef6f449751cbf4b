"""Token ids of whole texts from a public tokenizer file.

The tokenizer splits at white space before anything else, so a text's ids are those of its
words in turn; each distinct word is encoded once and looked up afterwards. The file must be
of that kind (its normalizer and splitter must not look across a space).
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from tarnlake.llm.words import split

#: Words remembered by one worker before it starts anew.
REMEMBERED = 1 << 20
#: Text bytes to encode at once: the more, the fewer words are looked up again.
TEXT_BYTES = 8 << 20
#: Unknown words are encoded so many at a time, with a bar between them. No word without a bar
#: in it has the bar's id, so that id parts their ids again.
AT_ONCE, BAR = 64, "|"


class WordEncoder:
    """Encodes batches of texts; lives in one worker process."""

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        self._remembered = remembered
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        bar = self._tokenizer.encode(BAR, add_special_tokens=False).ids
        self._bar = bar[0] if len(bar) == 1 else None
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._ids = np.zeros(0, np.uint32)
        self._ends = np.zeros(1, np.int64)

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word in turn, and how many each has."""
        found = self._tokenizer.encode_batch_fast(words, add_special_tokens=False)
        ids = [np.asarray(e.ids, np.uint32) for e in found]
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.asarray([len(i) for i in ids], np.int64)

    def _encoded_together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        between = f" {BAR} "
        parts = [between.join(words[i : i + AT_ONCE]) + between for i in range(0, len(words), AT_ONCE)]
        ids, _ = self._encoded(parts)
        bars = np.flatnonzero(ids == self._bar)
        if len(bars) != len(words):
            raise ValueError("this tokenizer does not encode words one by one")
        return np.delete(ids, bars), np.diff(np.r_[-1, bars]) - 1

    def _numbers(self, words: list[str]) -> np.ndarray:
        """A number for each word, under which its ids are kept."""
        if len(self._known) > self._remembered:
            self._forget()
        new = [word for word in words if word not in self._known]
        if new:
            alone = new if self._bar is None else [word for word in new if BAR in word]
            together = [] if self._bar is None else [word for word in new if BAR not in word]
            for group, encode in ((alone, self._encoded), (together, self._encoded_together)):
                ids, sizes = encode(group)
                self._known.update(zip(group, range(len(self._known), len(self._known) + len(group)), strict=True))
                self._ids = np.concatenate([self._ids, ids])
                self._ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum(sizes)])
        return np.fromiter(map(self._known.__getitem__, words), np.int64, len(words))

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order and the bounds of each; ``end`` is added to each text."""
        codes, bounds, distinct = split(texts)
        number = self._numbers(distinct.to_pylist())
        starts, sizes = self._ends[number], (self._ends[number + 1] - self._ends[number])
        ids = self._ids
        if end is not None:  # one more word, which stands after each text
            ids = np.append(ids, np.uint32(end))
            starts, sizes = np.append(starts, len(ids) - 1), np.append(sizes, 1)
            codes = np.insert(codes, bounds[1:], len(number))
            bounds = bounds + np.arange(len(bounds))
        size = sizes[codes]
        total = np.r_[0, np.cumsum(size)]
        at = np.repeat(starts[codes] - total[:-1], size)
        at += np.arange(total[-1])
        return ids[at], total[bounds]


_encoders: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, remembered: int = REMEMBERED) -> WordEncoder:
    """The worker's encoder of a tokenizer file; one at a time, as each holds its words."""
    if (path, remembered) not in _encoders:
        _encoders.clear()
        _encoders[path, remembered] = WordEncoder(path, remembered)
    return _encoders[path, remembered]


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of one of the installed public tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path(name)
