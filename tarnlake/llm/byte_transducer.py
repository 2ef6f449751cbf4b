"""Counts of whole texts by a finite-state transducer over their UTF-8 bytes.

One table gives each byte its class, one the state that a class leads to, one what is emitted
on a class in a state. The state after a byte depends on that byte alone (it is inside a word
or not), so the states of all bytes are looked up at once, and the emissions after them.
Every emitted word span goes into an open hash table, in which a span counts as a word seen
before only after its bytes were compared with those of the span that holds the slot.

A word is a maximal run of bytes other than space and ``\\t \\n \\v \\f \\r``, case-sensitive; a
code point is a byte that continues no other. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from tarnlake.llm.hashing import GOLDEN, mix64, salted
from tarnlake.llm.words import slices

#: Classes of bytes; ``END`` stands after the last byte of each text.
SPACE, CAPITAL, SYMBOL, PLAIN, CONTINUED, END = range(6)
#: States between bytes.
OUTSIDE, INSIDE = range(2)
#: What a byte may emit, as bits.
BEGINS, ENDS, IS_CAPITAL, IS_POINT, IS_SYMBOL = (1 << i for i in range(5))

SYMBOLS = b"#$%&*|"
#: Bytes of texts handled at once; a longer text is a part of its own.
PART_BYTES = 1 << 20


def class_table(symbols: bytes = SYMBOLS) -> np.ndarray:
    """The class of each byte."""
    table = np.full(256, PLAIN, np.uint8)
    table[[*b" \t\n\v\f\r"]] = SPACE
    table[ord("A") : ord("Z") + 1] = CAPITAL
    table[[*symbols]] = SYMBOL
    table[0x80:0xC0] = CONTINUED
    return table


def state_table() -> np.ndarray:
    """The state that each class leads to."""
    table = np.full(6, INSIDE, np.uint8)
    table[[SPACE, END]] = OUTSIDE
    return table


def emission_table() -> np.ndarray:
    """What each class emits in each state."""
    table = np.zeros((2, 6), np.uint8)
    table[:, CAPITAL] |= IS_CAPITAL
    table[:, SYMBOL] |= IS_SYMBOL
    table[:, [SPACE, CAPITAL, SYMBOL, PLAIN]] |= IS_POINT
    table[OUTSIDE, [CAPITAL, SYMBOL, PLAIN, CONTINUED]] |= BEGINS
    table[INSIDE, [SPACE, END]] |= ENDS
    return table


_STATES, _EMITS = state_table(), emission_table().ravel()


def transduce(data: np.ndarray, bounds: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Emissions of all texts, each text followed by its end, and where each text starts in them.

    ``bounds`` are those of the texts in ``data``.
    """
    coded = np.insert(classes[data], bounds[1:], END)
    states = np.empty(len(coded), np.uint8)
    states[:1] = OUTSIDE
    np.take(_STATES, coded[:-1], out=states[1:])
    return _EMITS[states * np.uint8(6) + coded], bounds[:-1] + np.arange(len(bounds) - 1)


def _positions(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of spans, one span after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


def span_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each span."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    before = np.cumsum(sizes) - sizes
    at = np.arange(sizes.sum()) - np.repeat(before, sizes)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.r_[np.uint64(1), np.full(int(sizes.max()), GOLDEN | np.uint64(1))])
        terms = (data[_positions(starts, sizes)].astype(np.uint64) + np.uint64(1)) * powers[at]
        return mix64(np.add.reduceat(terms, before) ^ salted(sizes.astype(np.uint64), 1))


def same_bytes(data: np.ndarray, one: np.ndarray, other: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether two spans of the same size hold the same bytes."""
    if len(one) == 0:
        return np.zeros(0, bool)
    differ = data[_positions(one, sizes)] != data[_positions(other, sizes)]
    return ~np.logical_or.reduceat(differ, np.cumsum(sizes) - sizes)


def first_spans(
    data: np.ndarray, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray
) -> np.ndarray:
    """Whether each span is the first of its bytes in its text, by an open hash table.

    All open spans try their slot at once: a free slot goes to the first of them, those that
    hold what their slot's holder does are settled, the others go on to the next slot.
    """
    n = len(starts)
    room = 1 << max(1, (2 * n).bit_length())
    holder = np.full(room, -1, np.int64)
    slot = (mix64(hashes ^ salted(text.astype(np.uint64), 2)) & np.uint64(room - 1)).astype(np.int64)
    first = np.zeros(n, bool)
    wanting = np.arange(n)
    while len(wanting):
        free = wanting[holder[slot[wanting]] < 0]
        holder[slot[free][::-1]] = free[::-1]
        holds = holder[slot[wanting]]
        alike = (hashes[wanting] == hashes[holds]) & (text[wanting] == text[holds]) & (sizes[wanting] == sizes[holds])
        check = np.flatnonzero(alike & (holds != wanting))
        a, b = wanting[check], holds[check]
        alike[check] = same_bytes(data, starts[a], starts[b], sizes[a])
        first[wanting[holds == wanting]] = True
        wanting = wanting[~alike]
        slot[wanting] = (slot[wanting] + 1) & (room - 1)
    return first


COUNTS = ("words", "distinct_words", "capitals", "symbols", "code_points")


def counted(texts: pa.Array, classes: np.ndarray) -> dict[str, np.ndarray]:
    """``COUNTS`` of each text."""
    binary = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
    content = binary.buffers()[2]
    data = np.zeros(0, np.uint8) if content is None else np.frombuffer(content, np.uint8)
    data, bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
    n = len(texts)
    emitted, heads = transduce(data, bounds, classes)
    found = {}
    for name, bit in (("words", BEGINS), ("capitals", IS_CAPITAL), ("symbols", IS_SYMBOL), ("code_points", IS_POINT)):
        found[name] = np.add.reduceat((emitted & bit != 0).astype(np.int64), heads) if n else np.zeros(0, np.int64)
    text = np.repeat(np.arange(n), found["words"])
    starts = np.flatnonzero(emitted & BEGINS) - text
    sizes = np.flatnonzero(emitted & ENDS) - text - starts
    first = first_spans(data, text, starts, sizes, span_hashes(data, starts, sizes))
    found["distinct_words"] = np.bincount(text[first], minlength=n)
    return found


#: What ``text_counts`` adds to the columns it is told to keep.
COUNT_SCHEMA = "text_digest binary, " + ", ".join(f"{name} long" for name in COUNTS)


def text_counts(batches: Iterator[pa.RecordBatch], symbols: bytes = SYMBOLS) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: the column ``text`` (the last one) replaced by its digest and ``COUNTS``.

    The digest has 128 bits and is the same for a null and an empty text.
    """
    classes = class_table(symbols)
    for batch in batches:
        for part in slices(batch, size=PART_BYTES):
            texts = part.column("text")
            found = counted(texts, classes)
            digests = pa.array([xxhash.xxh3_128_digest(x or "") for x in texts.to_pylist()], pa.binary())
            kept = [name for name in part.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(name) for name in kept], digests, *[pa.array(found[name], pa.int64()) for name in COUNTS]],
                [*kept, "text_digest", *COUNTS],
            )
