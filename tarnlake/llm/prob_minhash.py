"""Near-duplicate documents by ProbMinHash (Ertl, 2020), banding and verification.

A text is the multiset of its runs of five words. Each distinct run sends a Poisson process
of arrivals whose rate is its count; each arrival falls on a random register, and a register
keeps its earliest. Two texts agree in a register with the probability Jaccard similarity of
their counts. A run stops sending once its next arrival is later than every register's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.components import components
from tarnlake.llm.hashing import salted, unit
from tarnlake.llm.staging import Stage, small_batches, small_or_not
from tarnlake.llm.words import shingles, slices, word_hashes

SHINGLE = 5
REGISTERS, BANDS = 64, 16
SIMILAR = 0.8
#: Four bits of each register are kept as a sketch. Texts at a similarity of 0.8 agree in 52 of
#: 64 on average; about 1 in 100,000 such pairs agree in less than this many, far fewer than banding misses.
SKETCH_AGREES = 38
#: Bits of the odd sketch of a text's set of shingles (Mitzenmacher et al., 2014).
ODD_BITS = 1024
#: Rounds that link the open members of a bucket to one of them before all are compared.
STAR_ROUNDS = 2
#: Rarest elements that a member carries, so that a pair is met at one of those it shares and not at each.
CARRIED = 32


def counted(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle hash and count of each distinct shingle, by text."""
    values, bounds = shingles(*word_hashes(texts), k)
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    first = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (values[1:] != values[:-1])]) if len(text) else []
    first = np.asarray(first, np.int64)
    return text[first], values[first], np.diff(np.r_[first, len(text)])


def signatures(
    text: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS
) -> np.ndarray:
    """The element that came first in each register, one row per text; 0 without elements."""
    earliest = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, np.uint64)
    active, at, scale = np.arange(len(text)), np.zeros(len(text)), 1.0 / weight
    arrival = 0
    while len(active):
        draw = salted(element[active], 2 * arrival)
        at[active] -= np.log(unit(draw)) * scale[active]
        register = salted(element[active], 2 * arrival + 1) % np.uint64(registers)
        cell = text[active] * registers + register.astype(np.int64)
        early = at[active] < earliest[cell]
        np.minimum.at(earliest, cell[early], at[active][early])
        won = early & (at[active] == earliest[cell])
        winner[cell[won]] = element[active][won]
        latest = earliest.reshape(n, registers).max(axis=1)
        active = active[at[active] < latest[text[active]]]
        arrival += 1
    return winner.reshape(n, registers)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band of a signature."""
    n, registers = signature.shape
    rows = signature.reshape(n, bands, registers // bands)
    key = np.zeros((n, bands), np.uint64)
    for i in range(rows.shape[2]):
        key = salted(key ^ rows[:, :, i], i + 1)
    return key.view(np.int64)


def sketches(signature: np.ndarray) -> np.ndarray:
    """Four bits of each register, sixteen registers to a number."""
    nibbles = (signature & np.uint64(15)).reshape(len(signature), -1, 16)
    shifts = np.arange(16, dtype=np.uint64) * np.uint64(4)
    return np.bitwise_or.reduce(nibbles << shifts, axis=2).view(np.int64)


def odd_sketches(text: np.ndarray, element: np.ndarray, n: int) -> np.ndarray:
    """Parity of the distinct elements on each bit: two differ in no more bits than elements."""
    bit = (salted(element, 1 << 50) % np.uint64(ODD_BITS)).astype(np.int64)
    parity = np.bincount(text * ODD_BITS + bit, minlength=n * ODD_BITS) & 1
    return np.packbits(parity.astype(np.uint8).reshape(n, ODD_BITS), axis=1).view(np.int64)


def _signed(batches):
    for batch in batches:
        for part in slices(batch, size=1 << 20):
            texts = part.column("text")
            text, element, weight = counted(texts)
            signature = signatures(text, element, weight, len(texts))
            keys, sketch = band_keys(signature), sketches(signature)
            size = np.bincount(text, minlength=len(texts))
            total = np.bincount(text, weight, minlength=len(texts)).astype(np.int64)
            digests = [xxhash.xxh3_128_digest(x or "") for x in texts.to_pylist()]
            lists = lambda rows: pa.ListArray.from_arrays(
                np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], rows.ravel()
            )
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(digests, pa.binary()), lists(keys), lists(sketch),
                 lists(odd_sketches(text, element, len(texts))), pa.array(size), pa.array(total), pa.array(total > size)],
                ["doc_id", "digest", "bands", "sketch", "odd", "size", "total", "repeats"],
            )


def probability_jaccard(one: pa.Array, other: pa.Array, k: int = SHINGLE) -> np.ndarray:
    """Exact probability Jaccard similarity of pairs of texts; 0 where one has no words."""
    n = len(one)
    text_a, element_a, weight_a = counted(one, k)
    text_b, element_b, weight_b = counted(other, k)
    text = np.r_[text_a, text_b]
    element = np.r_[element_a, element_b]
    side = np.r_[np.zeros(len(text_a), np.int8), np.ones(len(text_b), np.int8)]
    weight = np.r_[weight_a, weight_b]
    order = np.lexsort((side, element, text))
    text, element, side, weight = text[order], element[order], side[order], weight[order]
    if len(text) == 0:
        return np.zeros(n)
    new = np.r_[True, (text[1:] != text[:-1]) | (element[1:] != element[:-1])]
    row = np.cumsum(new) - 1
    a, b = np.zeros(row[-1] + 1), np.zeros(row[-1] + 1)
    np.add.at(a, row[side == 0], weight[side == 0])
    np.add.at(b, row[side == 1], weight[side == 1])
    text = text[new]
    shared = (a > 0) & (b > 0)
    union = np.bincount(text, minlength=n)
    result = np.bincount(text[shared], minlength=n) / np.maximum(union, 1)
    for i in np.unique(text[(a > 1) | (b > 1)]):
        here = slice(*np.searchsorted(text, [i, i + 1]))
        pairs, counts = np.unique(np.stack([a[here], b[here]]), axis=1, return_counts=True)
        both = (pairs > 0).all(axis=0)
        ratio = np.maximum(pairs[0][None, :] / pairs[0][both][:, None], pairs[1][None, :] / pairs[1][both][:, None])
        result[i] = (counts[both] / (ratio * counts[None, :]).sum(axis=1)).sum()
    return result


def _verified(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """The pairs a, b whose texts are similar enough."""

    def verify(batches):
        for batch in batches:
            for part in slices(batch, "text_b", 1 << 20):
                score = pa.array(probability_jaccard(part.column("text_a"), part.column("text_b")))
                scored = pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), score], ["a", "b", "similarity"]
                )
                yield scored.filter(pc.greater_equal(score, similar))

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    with_texts = pairs.join(left, "a").join(right, "b")
    return with_texts.mapInArrow(verify, "a long, b long, similarity double")


def _labelled(members: DataFrame, links: DataFrame | None, stage: Stage) -> DataFrame:
    """Bucket members with the component that ``links`` put them in so far."""
    if links is None:
        return members.withColumn("component", F.col("doc_id"))
    found = stage.put(components(links, stage).withColumnRenamed("component", "__component"), "components")
    labelled = members.join(small_or_not(found), members["doc_id"] == found["node"], "left")
    return labelled.select(*members.columns, F.coalesce("__component", "doc_id").alias("component"))


def _may_be_near(one: str, other: str, similar: float) -> Column:
    """Whether sketches and sizes leave it possible that two members are similar enough.

    Two bounds are exact. Texts without a repeated shingle are sets, and no set is similar
    to a much larger one. And with n distinct shingles of t in all, an element of one text
    alone wins the race of both with probability 1 / (t + t' - common) at least, so texts at
    similarity s differ in at most (1 - s) / (1 + s) * (2t + 2t' - n - n') elements; their
    odd sketches differ in no more bits than that.
    """
    agree = F.lit(0)
    for i in range(REGISTERS // 16):
        differ = F.get(f"{one}.sketch", F.lit(i)).bitwiseXOR(F.get(f"{other}.sketch", F.lit(i)))
        pairs = differ.bitwiseOR(F.shiftrightunsigned(differ, 1))
        any_bit = pairs.bitwiseOR(F.shiftrightunsigned(pairs, 2)).bitwiseAND(F.lit(0x1111111111111111))
        agree = agree + F.lit(16) - F.bit_count(any_bit)
    small, large = F.least(f"{one}.size", f"{other}.size"), F.greatest(f"{one}.size", f"{other}.size")
    apart = F.lit(0)
    for i in range(ODD_BITS // 64):
        apart = apart + F.bit_count(F.get(f"{one}.odd", F.lit(i)).bitwiseXOR(F.get(f"{other}.odd", F.lit(i))))
    runs = (F.col(f"{one}.total") + F.col(f"{other}.total")) * F.lit(2) - small - large
    allowed = runs * F.lit((1 - similar) / (1 + similar) + 1e-9)
    repeats = F.col(f"{one}.repeats") | F.col(f"{other}.repeats")
    sized = repeats | (small >= large * F.lit(similar))
    return sized & (apart <= allowed) & (agree >= SKETCH_AGREES)


def _pair(one: str, other: str) -> list[Column]:
    ids = (f"{one}.doc_id", f"{other}.doc_id")
    return [F.least(*ids).alias("a"), F.greatest(*ids).alias("b")]


MEMBER = ("doc_id", "component", "sketch", "odd", "size", "total", "repeats")


def _star(members: DataFrame, highest: bool, similar: float) -> DataFrame:
    """Pairs of each open member with one member of its bucket, the smallest or largest."""
    pick = F.max if highest else F.min
    hubs = (
        members.groupBy("band", "key")
        .agg(pick(F.struct(*MEMBER)).alias("hub"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("band", "key", "hub")
    )
    one = members.select("band", "key", F.struct(*MEMBER).alias("one"))
    apart = (F.col("one.component") != F.col("hub.component")) & _may_be_near("one", "hub", similar)
    met = one.join(hubs, (one["band"] == hubs["band"]) & (one["key"] == hubs["key"]) & apart)
    return met.select(*_pair("one", "hub")).distinct()


def _elements(batches):
    for batch in batches:
        for part in slices(batch):
            text, element, weight = counted(part.column("text"))
            ids = part.column("doc_id").take(pa.array(text))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(element.view(np.int64)), pa.array(weight)], ["doc_id", "element", "weight"]
            )


def _met(rare: DataFrame, similar: float) -> DataFrame:
    """Possible pairs among the rows of members with a rare element; most come once.

    ``own`` is the share of a text's runs that stands before the element. Where that is the first
    that two texts have in common, shares a and b of theirs are in no common element, and their
    similarity is at most (1 - a) (1 - b) / (1 - a b).
    """
    one = rare.select(F.col("member").alias("one"), F.col("rarest").alias("one_rarest"), F.col("own").alias("one_own"), "element")
    other = rare.select(
        F.col("member").alias("other"), F.col("rarest").alias("other_rarest"), F.col("own").alias("other_own"),
        F.col("element").alias("__element"),
    )
    apart = (F.col("one.doc_id") < F.col("other.doc_id")) & (F.col("one.component") != F.col("other.component"))
    shared = (F.lit(1) - F.col("one_own")) * (F.lit(1) - F.col("other_own"))
    enough = shared >= (F.lit(1) - F.col("one_own") * F.col("other_own")) * F.lit(similar - 1e-9)
    first = F.get(F.array_intersect("one_rarest", "other_rarest"), F.lit(0))
    once = F.coalesce(F.col("element") == first, F.lit(True))
    met = one.join(other, (F.col("element") == F.col("__element")) & enough & apart & _may_be_near("one", "other", similar) & once)
    return met.select(*_pair("one", "other"))


def _rare(members: DataFrame, texts: DataFrame, similar: float, stage: Stage) -> DataFrame:
    """Possible pairs of members in different components that share a rare element of each.

    An element adds at most its share of either text's runs to the similarity, so the elements
    that two texts have in common hold ``similar`` of the runs of each. In an order that all
    texts follow, the first of them stands where no more than the rest of the runs, a fifth at
    0.8, came before (prefix filtering, Chaudhuri et al., 2006, by weight). Rare elements come
    first. A passage that thousands of texts share is no rare element of texts that have
    enough of their own, so these never meet; repeated runs change nothing in this.

    Of the elements that both carry among their ``CARRIED`` rarest, a pair is met at the first
    alone; one that shares none of these is met at each rare element it shares.
    """
    own = stage.put(members.select(F.struct(*MEMBER).alias("member"), "doc_id").distinct(), "rare-members")
    ids = small_or_not(own).select(F.col("doc_id").alias("wanted"))
    wanted = texts.join(ids, F.col("doc_id") == F.col("wanted"), "left_semi")
    elements = stage.put(wanted.mapInArrow(_elements, "doc_id long, element long, weight long"), "elements")
    common = elements.groupBy("element").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    of_text = Window.partitionBy("doc_id")
    shared = elements.join(common, "element").select(
        "doc_id", "element", F.sum("weight").over(of_text).alias("shared"),
        (F.sum("weight").over(of_text.orderBy("texts", "element")) - F.col("weight")).alias("rarer"),
    )
    total = F.col("member.total")
    before = (total - F.col("shared") + F.col("rarer")) / total
    placed = own.join(shared, "doc_id").withColumn("own", before).where(F.col("own") <= F.lit(1 - similar + 1e-9))
    # Of each member, as ids that repeat have members of their own.
    of_member = Window.partitionBy("doc_id", "member").orderBy("rarer", "element")
    leading = F.row_number().over(of_member) <= CARRIED
    whole = of_member.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rarest = F.collect_list(F.when(F.col("leading"), F.col("element"))).over(whole).alias("rarest")
    rare = stage.put(placed.withColumn("leading", leading).select("member", "element", "own", rarest), "rare")
    return _met(rare, similar).distinct()


def _open(members: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component."""
    mixed = (
        members.groupBy("band", "key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("band", "key")
    )
    return members.join(mixed, ["band", "key"], "left_semi")


def near_duplicates(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, class_id, kept: one row per row of ``docs``.

    ``class_id`` is the smallest doc_id that a document is linked to, over any number of
    links; ``kept`` marks that document. Equal texts are one class from the start. Links
    between different texts hold where the similarity is at least ``similar``.

    Candidates are texts that agree in a band. In each bucket members first meet its
    smallest one, then, where that leaves several components, its largest, and at last
    the members of other components that share one of its rare shingles. So a pair of a bucket is either ruled out by sketches,
    sizes or rare shingles, or compared, or already in one class. Members near a hub cost one
    comparison each; those of a group that are just under ``similar`` to each other and to
    both hubs are compared pair by pair, as far as the bounds do not part them.

    Texts of fewer than five words are one shingle of all of them; null and empty texts are
    near nothing, not even each other. A null doc_id stands alone. Rows that repeat a
    doc_id should not occur; they share its class. Other columns are ignored.
    """
    stage = Stage(docs.sparkSession, "near")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, digest binary, bands array<long>, sketch array<long>, odd array<long>, size long, total long, repeats boolean"
    signed = stage.put(plain.mapInArrow(_signed, schema), "signatures")
    usable = signed.where("size > 0 and doc_id is not null")
    first = F.min(F.struct("doc_id", "bands", "sketch", "odd", "size", "total", "repeats")).alias("first")
    classes = stage.put(usable.groupBy("digest").agg(first).select("digest", "first.*"), "classes")
    banded = classes.select("doc_id", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band", "key")
    members = stage.put(banded.join(shared, ["band", "key"], "left_semi"), "members")
    candidates = stage.put(members.select("doc_id").distinct(), "candidates")
    traits = classes.select("doc_id", *MEMBER[2:])
    traits = stage.put(traits.join(small_or_not(candidates), "doc_id", "left_semi"), "traits")
    texts = stage.put(plain.join(small_or_not(candidates), "doc_id", "left_semi"), "texts")

    compared = links = None
    for turn in range(STAR_ROUNDS + 1):
        opened = _open(_labelled(members, links, stage))
        labelled = stage.put(opened.join(small_or_not(traits), "doc_id"), "open")
        last = turn == STAR_ROUNDS
        if last:
            pairs = _rare(labelled, texts, similar, stage)
        else:
            pairs = _star(labelled, turn % 2 == 1, similar)
        if compared is not None:
            pairs = pairs.join(compared, ["a", "b"], "left_anti")
        pairs = stage.put(pairs, "pairs")
        with small_batches(docs.sparkSession):
            found = stage.put(_verified(pairs, texts, similar), "links")
        compared = pairs if compared is None else compared.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
    found = components(links.select("a", "b"), stage)
    of_class = (
        classes.select("digest", F.col("doc_id").alias("node"))
        .join(found, "node", "left")
        .select("digest", F.coalesce("component", "node").alias("class_id"))
    )
    member_class = usable.select("doc_id", "digest").join(of_class, "digest").select("doc_id", "class_id")
    alone = signed.where("size = 0 or doc_id is null").select("doc_id", F.col("doc_id").alias("class_id"))
    result = member_class.unionByName(alone)
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def without_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """One document of each class: the rows of ``docs`` that are kept, as they are."""
    stage = Stage(docs.sparkSession, "kept")
    dropped = near_duplicates(docs, **how).where("not kept").select(F.col("doc_id").alias("__dropped")).distinct()
    dropped = small_or_not(stage.put(dropped, "dropped"))
    return docs.join(dropped, F.col("doc_id") == F.col("__dropped"), "left_anti")
