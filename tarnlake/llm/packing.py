"""Packing token sequences: a cutting-stock plan over the histogram of piece lengths.

Documents longer than a sequence are cut into full sequences and a rest; all others stay
whole. Rests and short documents are sorted into classes of similar length. A linear program
over these says which mixtures of classes fill a sequence best and how many sequences of
each to make; documents are ranked within their class and take the places in turn.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.cutting_stock import cut
from tarnlake.llm.numbering import cells_for, number_within
from tarnlake.llm.staging import Stage, small_batches
from tarnlake.llm.tokens import REMEMBERED, TEXT_BYTES, encoder
from tarnlake.llm.words import slices

CAPACITY = 4096
#: Classes of length at most, and the step of their sizes.
CLASSES, STEP = 256, 4


def pieces_of(
    docs: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY, with_ids: bool = False,
    text_bytes: int = TEXT_BYTES, remembered: int = REMEMBERED,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of each piece, and its ids if asked for.

    The checksum is of the ids as little-endian 32-bit integers, which is also the form of
    ``ids``. A null or empty text is one piece, the id ``end``. Texts of ``text_bytes`` are
    encoded at once, and ``remembered`` words kept by a worker: less of both is slower and smaller.
    """

    def encode(batches):
        for batch in batches:
            for part in slices(batch, size=text_bytes):
                ids, bounds = encoder(tokenizer, remembered).encode(part.column("text"), end)
                raw = memoryview(ids.astype("<u4").tobytes())
                sizes = np.diff(bounds)
                counts = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), counts)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)) * capacity
                length = np.minimum(sizes[row] - start, capacity)
                at = (bounds[row] + start) * 4
                parts = [raw[a : a + n * 4] for a, n in zip(at.tolist(), length.tolist(), strict=True)]
                columns = [
                    part.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(length),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array(sizes[row]),
                ]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns.append(pa.array([bytes(p) for p in parts], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(encode, schema + (", ids binary" if with_ids else ""))


def class_tops(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> np.ndarray:
    """Largest length of each class: about equal numbers of pieces, in steps of ``STEP``."""
    share = np.cumsum(counts) / counts.sum()
    at = np.searchsorted(share, np.arange(1, CLASSES + 1) / CLASSES - 1e-12)
    tops = lengths[np.minimum(at, len(lengths) - 1)]
    return np.unique(np.minimum(-(-tops // STEP) * STEP, capacity))


class Plan:
    """Where the piece of each class and rank goes; its size does not depend on the data's."""

    def __init__(self, lengths: np.ndarray, counts: np.ndarray, capacity: int) -> None:
        self.tops = class_tops(lengths, counts, capacity)
        of_length = np.searchsorted(self.tops, lengths)
        demand = np.bincount(of_length, counts, minlength=len(self.tops)).astype(np.int64)
        self.sequences = 0
        runs: list[list[tuple[int, int, int, int]]] = [[] for _ in self.tops]
        filled = np.zeros(len(self.tops), np.int64)
        for pattern in cut(self.tops // STEP, demand, capacity // STEP):
            slot = 0
            for i in np.flatnonzero(pattern.counts):
                each = int(pattern.counts[i])
                runs[i].append((int(filled[i]), self.sequences, each, slot))
                filled[i] += each * pattern.times
                slot += each
            self.sequences += pattern.times
        self.runs = [np.asarray(found, np.int64).reshape(-1, 4) for found in runs]

    def places(self, kind: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence of each piece, and its turn there."""
        sequence, slot = np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64)
        for i in np.unique(kind):
            here = np.flatnonzero(kind == i)
            run = self.runs[i][np.searchsorted(self.runs[i][:, 0], rank[here], side="right") - 1]
            inside = rank[here] - run[:, 0]
            sequence[here] = run[:, 1] + inside // run[:, 2]
            slot[here] = run[:, 3] + inside % run[:, 2]
        return sequence, slot


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset.

    Every piece is in one sequence, sequences hold at most ``capacity`` tokens, and pieces
    stand in them without a gap from 0. ``pieces`` must give the same rows each time it is
    read; rows that agree in doc_id and start are interchangeable. An empty table gives an
    empty result. Other columns are carried along.
    """
    histogram = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).orderBy("length").collect()
    lengths = np.asarray([row["length"] for row in histogram], np.int64)
    counts = np.asarray([row["n"] for row in histogram], np.int64)
    if not len(lengths):
        nothing = F.lit(None).cast("long")
        return pieces.withColumn("sequence_id", nothing).withColumn("offset", nothing)
    plan = Plan(lengths, counts, capacity)

    @F.arrow_udf("int")
    def kind_of(length: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(plan.tops, length.to_numpy()).astype(np.int32))

    @F.arrow_udf("struct<sequence_id: bigint, slot: bigint>")
    def place_of(kind: pa.Array, rank: pa.Array) -> pa.Array:
        sequence, slot = plan.places(kind.to_numpy(), rank.to_numpy())
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(slot)], ["sequence_id", "slot"])

    most = int(counts.sum())
    ranked = number_within(
        pieces.withColumn("__kind", kind_of("length")), "__kind", ["doc_id", "start"], "__rank", cells_for(most, 2048)
    )
    placed = ranked.withColumn("__place", place_of("__kind", "__rank")).withColumns(
        {"sequence_id": F.col("__place.sequence_id"), "__slot": F.col("__place.slot")}
    )
    before = Window.partitionBy("sequence_id").orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0))
    return placed.withColumn("offset", offset).drop("__kind", "__rank", "__place", "__slot")


def pack_documents(
    docs: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY, with_ids: bool = False, rows: int = 10_000, **how: int
) -> DataFrame:
    """Encode, cut and pack whole texts; see ``pieces_of`` and ``pack`` for the columns.

    ``rows`` of texts are handed to a worker at once; ``how`` goes to ``pieces_of``.
    """
    stage = Stage(docs.sparkSession, "packing")
    with small_batches(docs.sparkSession, rows):
        pieces = stage.put(pieces_of(docs, tokenizer, end, capacity, with_ids, **how), "pieces")
    return pack(pieces, capacity)
