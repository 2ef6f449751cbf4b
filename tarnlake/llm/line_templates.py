"""Line dedup by a log-template tree (after He et al., 2017), in DataFrame operations alone.

A line goes down a tree of fixed depth: its token count, then its leading tokens, in which a
token with a digit counts as a variable field. In the leaf the other positions are
generalised: a token is constant at its position if a quarter of the leaf's distinct lines, and
two of them, have it there; else it is a variable field, whose values may well repeat, the
more so the more lines there are. What remains is the line's template, if at least ``similar`` of its tokens are constant; else the line is its own.
A template that occurs in ``min_docs`` documents recurs: every line of it but the first
(by doc_id, then line number) is dropped.

Lines meet only as hashes and counts: distinct lines are counted before positions are, and
only lines of leaves with several distinct lines are taken apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.staging import Stage, small_or_not
from tarnlake.llm.winnowing import SPACES

DEPTH = 3
#: Share of the distinct lines of a leaf that have a constant at its place. A field of fewer than four
#: values, evenly spread, counts as so many constants: its lines are as many templates.
CONSTANT = 0.25
#: A whole token with a digit in it.
VARIABLE = r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*"
FIELD = "<*>"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def tokens(line: Column) -> Column:
    """Tokens of a line, variable ones replaced; an empty line has one empty token."""
    bare = F.btrim(line, F.lit(SPACES))
    # Most lines hold no digit, and the pattern would search every word of them in vain.
    masked = F.when(bare.rlike("[0-9]"), F.regexp_replace(bare, VARIABLE, FIELD)).otherwise(bare)
    return F.split(masked, r"[\x20\x09-\x0D]+")


def _parsed(docs: DataFrame, depth: int) -> DataFrame:
    """doc_id, line_no, text_key, n, leaf, line: the tree's path of each line, as hashes.

    ``text_key`` tells the texts of rows that share a doc_id apart.
    """
    exploded = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(lines_of(F.col("text"))).alias("line_no", "raw"))
    parsed = exploded.select("doc_id", "line_no", "text_key", tokens(F.col("raw")).alias("tokens"))
    n = F.size("tokens")
    return parsed.select(
        "doc_id", "line_no", "text_key", n.alias("n"),
        F.xxhash64(n, F.slice("tokens", 1, depth)).alias("leaf"),
        F.xxhash64(F.lit(1), "tokens").alias("line"),
    )


def _generalised(docs: DataFrame, distinct: DataFrame, stage: Stage, depth: int, similar: float) -> DataFrame:
    """leaf, line, template for the lines that have variable fields outside the lead."""
    leaves = distinct.groupBy("leaf").agg(F.count(F.lit(1)).alias("of_leaf")).where("of_leaf > 1")
    wanted = (
        distinct.where(F.col("n") > depth)
        .join(leaves, "leaf")
        .groupBy("first.doc_id", "first.text_key")
        .agg(
            F.collect_list(F.struct("first.line_no", "leaf", "line", "of_leaf")).alias("wanted"),
            F.sum(F.col("n") - depth).alias("fields"),
        )
    )
    wanted = stage.put(wanted, "wanted")
    once = docs.withColumn("text_key", F.xxhash64("text"))
    rows = (
        once.join(small_or_not(wanted.drop("fields")), ["doc_id", "text_key"])
        .select(lines_of(F.col("text")).alias("lines"), F.explode("wanted").alias("w"))
        .select("w.leaf", "w.line", "w.of_leaf", tokens(F.element_at("lines", F.col("w.line_no") + 1)).alias("tokens"))
        .select("leaf", "line", "of_leaf", F.size("tokens").alias("n"), F.posexplode(F.slice("tokens", depth + 1, 1 << 30)).alias("at", "token"))
        .select("leaf", "line", "of_leaf", "n", "at", F.xxhash64("token").alias("token"))
    )
    rows = stage.put(rows, "fields")
    if rows.count() > (wanted.agg(F.sum("fields")).first()[0] or 0):
        # Rows repeat as a whole: each of their lines was taken apart as often.
        rows = stage.put(rows.dropDuplicates(["leaf", "line", "at"]), "fields-once")
    enough = F.greatest(F.lit(2), F.first("of_leaf") * F.lit(CONSTANT))
    constant = rows.groupBy("leaf", "at", "token").agg(
        F.count(F.lit(1)).alias("lines"), enough.alias("enough")
    ).where("lines >= enough")
    constant = constant.select("leaf", "at", "token", F.lit(1).alias("constant"))
    marked = rows.join(constant, ["leaf", "at", "token"], "left")
    shown = F.when(F.col("constant").isNotNull(), F.col("token"))
    per_line = marked.groupBy("leaf", "line", "n").agg(
        F.count("constant").alias("constants"), F.bit_xor(F.xxhash64("at", shown)).alias("template")
    )
    lead = F.lit(depth)
    general = (F.col("constants") + lead >= F.col("n") * F.lit(similar)) & (F.col("constants") + lead < F.col("n"))
    return per_line.where(general).select("leaf", "line", "template")


#: What tells templates apart.
KEY = ("leaf", "template", "general")


def _recurring(
    docs: DataFrame, min_docs: int = 3, min_tokens: int = 5, depth: int = DEPTH, similar: float = 0.8
) -> DataFrame:
    """The lines to drop, by document, text and number."""
    stage = Stage(docs.sparkSession, "lines")
    plain = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    parsed = stage.put(_parsed(plain, depth).where(F.col("n") >= min_tokens), "parsed")
    place = F.struct("doc_id", "line_no")
    distinct = stage.put(
        parsed.groupBy("leaf", "line", "n").agg(F.min(F.struct("doc_id", "line_no", "text_key")).alias("first")), "distinct"
    )
    general = stage.put(_generalised(plain, distinct, stage, depth, similar), "templates")
    with_template = parsed.join(small_or_not(general), ["leaf", "line"], "left").select(
        "doc_id", "line_no", "text_key", "leaf", F.coalesce("template", "line").alias("template"),
        F.col("template").isNotNull().alias("general"),
    )
    with_template = stage.put(with_template, "lines")
    recurring = (
        with_template.groupBy(*KEY, "doc_id")
        .agg(F.min("line_no").alias("line_no"))
        .groupBy(*KEY)
        .agg(F.count(F.lit(1)).alias("docs"), F.min(place).alias("first"))
        .where(F.col("docs") >= min_docs)
    )
    met = with_template.join(small_or_not(stage.put(recurring, "recurring")), [*KEY])
    return met.where(place != F.col("first")).select("doc_id", "line_no", "text_key")


def recurring_lines(docs: DataFrame, **how) -> DataFrame:
    """doc_id, line_no of every line to drop.

    Lines of fewer than ``min_tokens`` tokens stay. Null texts have no lines; a null doc_id
    is left alone. Rows that share a doc_id count as one document, each with lines of its own.
    """
    return _recurring(docs, **how).select("doc_id", "line_no")


def _with_rest(docs: DataFrame, drops: DataFrame, stage: Stage) -> DataFrame:
    """``docs`` with the numbers of their lines to drop, and what is left; null where all stays."""
    drops = drops.groupBy(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key")).agg(
        F.collect_set("line_no").alias("__drop")
    )
    drops = stage.put(drops, "drops")
    own = (F.col("doc_id") == F.col("__doc")) & (F.xxhash64("text") == F.col("__key"))
    met = docs.join(small_or_not(drops), own, "left")
    rest = F.array_join(
        F.filter(lines_of(F.col("text")), lambda _, i: ~F.array_contains("__drop", i)), "\n"
    )
    return met.withColumn("__rest", F.when(F.col("__drop").isNotNull(), rest))


def drop_recurring_lines(docs: DataFrame, **how) -> DataFrame:
    """``docs`` without the lines that ``recurring_lines`` names, and ``dropped_lines``.

    Null texts stay null; other columns stay as they are; a column ``dropped_lines`` is replaced.
    """
    stage = Stage(docs.sparkSession, "cleaned")
    drops = _recurring(docs, **how)
    cleaned = _with_rest(docs.drop("dropped_lines"), drops, stage)
    lost = F.when(F.col("__rest").isNotNull(), F.size("__drop")).otherwise(F.lit(0))
    return (
        cleaned.withColumn("dropped_lines", lost)
        .withColumn("text", F.coalesce("__rest", "text"))
        .select(*[c for c in docs.columns if c != "dropped_lines"], "dropped_lines")
    )
