"""Toxicity by a factorization machine over hashed terms (Rendle, 2010).

A text is the set of its hashed terms: lower-cased words without outer punctuation and
their prefixes, which stand for inflected forms. The score adds a weight per term and, for
each pair of terms, the product of two short factor vectors, so that an insult beside a
group mention can weigh more (or less) than both alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.words import slices, split

#: Characters that are cut off both ends of a word.
OUTER = ".,;:!?\"'()[]{}<>*&%$#|-_…«»¿¡"
PREFIXES = (4, 5)
#: Text bytes scored at once: their distinct words and terms are Python objects for a while.
SCORED_BYTES = 1 << 20


def terms(word: str) -> tuple[str, ...]:
    """The terms of one word; a prefix is marked so that it differs from the same word."""
    bare = word.lower().strip(OUTER) or word
    return (bare, *(f"{bare[:n]}~{n}" for n in PREFIXES if len(bare) > n))


def slots(word: str, bits: int) -> list[int]:
    """Hash slots of the terms of one word."""
    return [xxhash.xxh3_64_intdigest(term) >> (64 - bits) for term in terms(word)]


@dataclass
class Machine:
    """A trained factorization machine over ``2 ** bits`` slots."""

    bits: int
    bias: float
    weight: np.ndarray
    factors: np.ndarray

    def live(self) -> np.ndarray:
        return (self.weight != 0) | (self.factors != 0).any(axis=1)

    def margins(self, doc: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        """Log odds of ``n`` texts whose distinct (text, slot) pairs are given."""
        out = np.full(n, self.bias)
        if not len(slot):
            return out
        out += np.bincount(doc, self.weight[slot], minlength=n)
        for factor in self.factors.T:
            value = factor[slot]
            total = np.bincount(doc, value, minlength=n)
            out += 0.5 * (total * total - np.bincount(doc, value * value, minlength=n))
        return out


def probability(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -40, 40)))


def text_slots(texts: pa.Array, bits: int, live: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, slot) pairs of whole texts; only ``live`` slots if given."""
    codes, bounds, distinct = split(texts)
    lists = [slots(word, bits) for word in distinct.to_pylist()]
    if live is not None:
        lists = [[s for s in found if live[s]] for found in lists]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    flat = np.fromiter((s for found in lists for s in found), np.int64, int(sizes.sum()))
    starts = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    if len(codes):
        there = sizes[codes] > 0
        codes, doc = codes[there], doc[there]
    pair = np.unique(doc * len(lists) + codes) if len(codes) else np.zeros(0, np.int64)
    doc, codes = (pair // len(lists), pair % len(lists)) if len(pair) else (pair, pair)
    counts = sizes[codes] if len(codes) else np.zeros(0, np.int64)
    doc = np.repeat(doc, counts)
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    slot = flat[np.repeat(starts[codes], counts) + inner] if len(codes) else np.zeros(0, np.int64)
    pair = np.unique((doc << bits) | slot)
    return pair >> bits, pair & ((1 << bits) - 1)


def telling(rows: list[np.ndarray], labels: np.ndarray, size: int, least: int, z: float) -> np.ndarray:
    """Slots in at least ``least`` rows whose frequency differs between the classes.

    Without this, hundreds of everyday words share what the bias should say, and a long
    text drifts away from a short one.
    """
    toxic = [row for row, label in zip(rows, labels, strict=True) if label > 0]
    seen = np.bincount(np.concatenate(rows), minlength=size)
    seen_toxic = np.bincount(np.concatenate(toxic), minlength=size)
    share = len(toxic) / len(rows)
    spread = np.sqrt(np.maximum(seen * share * (1 - share), 1e-9))
    return (seen >= least) & (np.abs(seen_toxic - seen * share) / spread >= z)


def train(
    rows: list[np.ndarray], labels: np.ndarray, bits: int, rank: int = 4, epochs: int = 12,
    rate: float = 0.2, l1: float = 1e-5, l2: float = 1e-4, batch: int = 128, least: int = 3,
    z: float = 2.5, seed: int = 7,
) -> Machine:
    """Fit log loss by AdaGrad, with a lasso on weights and a ridge on factors.

    Only ``telling`` slots enter. Toxic rows weigh the square root of how much rarer they
    are. One class alone, or no rows, gives a constant score.
    """
    size = 1 << bits
    rng = np.random.default_rng(seed)
    n, positive = len(rows), float(labels.sum())
    bias = float(np.log((positive + 0.5) / (n - positive + 0.5)))
    machine = Machine(bits, bias, np.zeros(size), np.zeros((size, rank)))
    if n == 0 or positive in (0.0, float(n)):
        return machine
    used = telling(rows, labels, size, least, z)
    rows = [row[used[row]] for row in rows]
    machine.factors[used] = rng.normal(0, 0.05, (int(used.sum()), rank))
    weight = np.where(labels > 0, np.sqrt(max(1.0, (n - positive) / positive)), 1.0)
    g_bias, g_weight, g_factor = 1e-4, np.full(size, 1e-6), np.full((size, rank), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(n)
        for start in range(0, n, batch):
            chosen = order[start : start + batch]
            parts = [rows[i] for i in chosen]
            slot = np.concatenate(parts)
            doc = np.repeat(np.arange(len(chosen)), [len(p) for p in parts])
            error = probability(machine.margins(doc, slot, len(chosen))) - labels[chosen]
            error = error * weight[chosen] / len(chosen)
            g_bias += error.sum() ** 2
            machine.bias -= rate * error.sum() / np.sqrt(g_bias)
            touched, where = np.unique(slot, return_inverse=True)
            gradient = np.bincount(where, error[doc], minlength=len(touched))
            g_weight[touched] += gradient**2
            step = rate / np.sqrt(g_weight[touched])
            moved = machine.weight[touched] - step * gradient
            machine.weight[touched] = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0)
            for f in range(rank):
                value = machine.factors[:, f]
                total = np.bincount(doc, value[slot], minlength=len(chosen))
                gradient = np.bincount(where, error[doc] * (total[doc] - value[slot]), minlength=len(touched))
                gradient = gradient + l2 * value[touched]
                g_factor[touched, f] += gradient**2
                machine.factors[touched, f] -= 0.25 * rate * gradient / np.sqrt(g_factor[touched, f])
    return machine


def fit(
    docs: DataFrame, labels: DataFrame, max_train: int = 12_000, bits: int = 18, **how
) -> Machine:
    """Learn ``labels.toxic`` from at most ``max_train`` labelled documents.

    The sample is those with the smallest hash of their id, whatever the table's size; it
    bounds what reaches the driver (slots of that many texts). Rows whose crc32(doc_id as
    text) is divisible by 5 are held out and never learned from.
    """
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_train)
    )
    chosen = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "toxic")

    def extract(batches):
        for batch in batches:
            for part in slices(batch, size=SCORED_BYTES):
                doc, slot = text_slots(part.column("text"), bits)
                bounds = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32)
                found = pa.ListArray.from_arrays(bounds, slot.astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column("toxic").cast(pa.int32()), found], ["toxic", "slots"])

    sample = chosen.mapInArrow(extract, "toxic int, slots array<int>").toArrow().combine_chunks()
    found = sample.column("slots").combine_chunks()
    values = found.flatten().to_numpy().astype(np.int64) if len(found) else np.zeros(0, np.int64)
    ends = np.cumsum([len(x) for x in found]) if len(found) else np.zeros(0, np.int64)
    rows = np.split(values, ends[:-1]) if len(ends) else []
    truth = sample.column("toxic").to_numpy().astype(float)
    order = np.lexsort(([int(r.sum()) for r in rows], [len(r) for r in rows])) if rows else np.zeros(0, int)
    return train([rows[i] for i in order], truth[order], bits, **how)


def held_out(doc_id: str) -> Column:
    """Whether a row is kept from training; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(False))


def toxic_score(machine: Machine, text: str = "text") -> Column:
    """Score of a whole text, 0 to 1. A null or empty text gets the score of no terms."""
    live = machine.live()

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts.cast(pa.string())], ["text"])
        scores = [np.zeros(0)]
        for part in slices(batch, size=SCORED_BYTES):
            doc, slot = text_slots(part.column("text"), machine.bits, live)
            scores.append(probability(machine.margins(doc, slot, part.num_rows)))
        return pa.array(np.concatenate(scores))

    return score(F.col(text))


def with_toxicity(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from a score of 0.5).

    Columns of these names are replaced, all others stay. Repeated rows score alike.
    """
    scored = docs.withColumn("score", toxic_score(machine))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The documents whose score stays under 0.5, with the columns of ``docs``."""
    machine = fit(docs, labels, **how)
    return docs.where(toxic_score(machine) < 0.5).select(*docs.columns)
