"""Document fingerprints by winnowing (Schleimer, Wilkerson and Aiken, 2003), in SQL alone.

The units are words. In texts of fewer than ``w + k - 1`` words, too few for the guarantee
below, they are characters, so a text without spaces has units too. Every run of ``k``
units is hashed; of every ``w`` consecutive hashes the smallest is kept, the rightmost of
equal ones, with its position. Any passage of at least ``w + k - 1`` units that two texts
share leaves a common hash in both fingerprints, and no match of fewer than ``k`` does.

A text of fewer than ``k`` units has one hash of all of them, one of fewer than ``w`` hashes
one window. Null and empty texts have an empty fingerprint.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.numbering import bucket_of, range_bounds

SPACES = " \t\n\x0b\x0c\r"
#: An entry is hash * 2^31 + (LAST - position): the smallest is the smallest hash, rightmost.
LAST = 2147483647


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def characters(text: Column) -> Column:
    whole = F.coalesce(text, F.lit(""))
    return F.when(whole == "", F.array().cast("array<string>")).otherwise(F.split(whole, ""))


def _entries(unit: Column, k: int) -> Column:
    """The rolling k-gram hashes with their positions."""
    count = F.when(F.size(unit) >= k, F.size(unit) - F.lit(k - 1)).otherwise(F.lit(1))

    def entry(i: Column) -> Column:
        gram = F.xxhash64(F.slice(unit, i + 1, k))
        return F.shiftleft(gram.bitwiseAND(F.lit(0xFFFFFFFF)), 31) + (F.lit(LAST) - i)

    grams = F.transform(F.sequence(F.lit(0), count - 1), entry)
    return F.when(F.size(unit) == 0, F.array().cast("array<bigint>")).otherwise(grams)


def _minima(entries: Column, w: int) -> Column:
    windows = F.greatest(F.size(entries) - F.lit(w), F.lit(0))
    each = F.transform(F.sequence(F.lit(0), windows), lambda i: F.array_min(F.slice(entries, i + 1, w)))
    return F.when(F.size(entries) == 0, entries).otherwise(F.array_distinct(each))


def fingerprint(text: Column, k: int = 5, w: int = 8) -> Column:
    """Chosen entries of a text in ascending position, packed as above."""
    def chosen(unit: Column) -> Column:
        return let(_entries(unit, k), lambda entries: _minima(entries, w))

    long = lambda found: F.when(F.size(found) >= w + k - 1, found).otherwise(characters(text))
    return let(let(words(text), long), chosen)


def hashes(chosen: Column) -> Column:
    return F.array_distinct(F.transform(chosen, lambda x: F.shiftright(x, 31)))


def positions(chosen: Column) -> Column:
    """Unit positions of the chosen hashes, from 0."""
    return F.transform(chosen, lambda x: F.lit(LAST) - x.bitwiseAND(F.lit(LAST)))


def written(chosen: Column) -> Column:
    """A fingerprint as text: ``hash:position`` in hexadecimal, parted by spaces."""
    part = lambda x: F.concat_ws(
        ":", F.hex(F.shiftright(x, 31)), F.hex(F.lit(LAST) - x.bitwiseAND(F.lit(LAST)))
    )
    return F.array_join(F.transform(chosen, part), " ")


def likeness(one: Column, other: Column) -> Column:
    """Jaccard similarity of two fingerprints' hashes; 1 for two empty ones."""
    common = F.size(F.array_intersect(hashes(one), hashes(other)))
    union = F.size(hashes(one)) + F.size(hashes(other)) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union)


def with_fingerprint(docs: DataFrame, k: int = 5, w: int = 8) -> DataFrame:
    """``docs`` with ``fingerprint``, ``positions``; columns of these names are replaced."""
    return docs.withColumn("fingerprint", fingerprint(F.col("text"), k, w)).withColumn(
        "positions", positions(F.col("fingerprint"))
    )


def with_next(docs: DataFrame, then: Callable[[DataFrame], DataFrame], rows_per_bucket: int = 64) -> DataFrame:
    """Each text with the text that follows in ascending doc_id, after the last the first.

    Rows are dealt into ranges of doc_id between approximate percentiles. The first row of
    a range also goes to the range before it, as its last, so no range waits for another and
    the texts are shuffled once. ``then`` maps rows with ``text`` and ``next_text`` to rows
    with ``fp``; the result has them with ``next_fp``. Null ids come last; rows with one id
    are ordered by text. Columns ``next_text`` and ``next_fp`` are replaced.
    """
    bounds = range_bounds(docs, "doc_id", ceil(docs.count() / rows_per_bucket))
    first = docs.agg(F.min("doc_id")).first()[0]
    bucket = bucket_of("doc_id", bounds)
    starts = F.col("doc_id").isin([first]) if first is not None else F.lit(True)
    before = F.when(starts, F.lit(len(bounds))).when(
        bucket_of("doc_id", bounds) != bucket_of("__less", bounds), bucket - 1
    )
    home = F.struct(bucket.alias("bucket"), F.lit(0).alias("guest"))
    visit = F.when(before.isNotNull(), F.struct(before.alias("bucket"), F.lit(1).alias("guest")))
    dealt = docs.withColumn("__less", F.try_subtract(F.col("doc_id"), F.lit(1))).withColumn(
        "__home", F.explode(F.array_compact(F.array(home, visit)))
    )
    dealt = dealt.withColumns({"__bucket": F.col("__home.bucket"), "__guest": F.col("__home.guest")})
    order = Window.partitionBy("__bucket").orderBy("__guest", F.col("doc_id").asc_nulls_last(), "text")
    paired = dealt.drop("__home", "__less").withColumn("next_text", F.lead("text").over(order))
    result = then(paired).withColumn("next_fp", F.lead("fp").over(order))
    return result.where(F.col("__guest") == 0).drop("__bucket", "__guest")
