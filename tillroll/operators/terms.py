"""Grouping free-text values by a palette of known terms.

A palette becomes an index of stored tables that texts meet by equi-joins, so
the work per text does not depend on how many terms there are:

- a term that a text contains is one of the text's own stretches;
- a short text may be one edit away from a stretch of a term. Leaving out one
  letter makes both sides equal: the text without a letter is the stretch, the
  stretch without a letter is the text, or both without the letter at the same
  place are equal. The index holds these neighbours of all term stretches, and
  for each only the entry that wins;
- a longer text may be ``k`` edits away. Cut into ``k // 2 + 1`` parts, one of
  them has at most one edit, so its neighbours find the term and the place.
  Only there is the edit distance computed.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.columns import col, title_case
from tillroll.functions.palette import EDIT_SHARE, FIRST_GROUP, PALETTE
from tillroll.functions.skew import hot_keys, salted_left_join
from tillroll.session import pinned

Palette = Sequence[tuple[str, Sequence[str]]]


def normal_text(c: Column | str) -> Column:
    return F.regexp_replace(F.lower(F.trim(col(c))), r"\s+", " ")


def _edits(length: int) -> int:
    return math.ceil(length * EDIT_SHARE)


# Longest text that may differ in one letter, and the lengths that a part of a longer one can have.
SHORT = max(n for n in range(1, 100) if _edits(n) == 1)
_PARTS = {(n * (j + 1) // m - n * j // m) for n in range(SHORT + 1, 20 * SHORT) for m in [_edits(n) // 2 + 1] for j in range(m)}
PART_LENGTHS = (min(_PARTS), max(_PARTS))


def _without(text: Column, at: Column) -> Column:
    """``text`` without its letter ``at``, counted from 1."""
    return F.concat(F.substring(text, F.lit(1), at - 1), F.substring(text, at + 1, F.length(text)))


def _stretches(rows: DataFrame, text: str, shortest: Column, longest: Column) -> DataFrame:
    """Every stretch of ``text`` with a length in the range, as columns ``at, part``."""
    most = F.least(longest, F.length(text))
    sized = rows.filter(shortest <= most).select("*", F.explode(F.sequence(shortest, most)).alias("_n"))
    placed = sized.select("*", F.explode(F.sequence(F.lit(1), F.length(text) - F.col("_n") + 1)).alias("at"))
    return placed.withColumn("part", F.substring(text, F.col("at"), F.col("_n"))).drop("_n")


def _neighbours(rows: DataFrame, part: str, of_text: bool) -> DataFrame:
    """Rows with each ``key`` that two strings share just if they are at most one edit apart.

    A key starts with the length of the text's part, then says what was left
    out: nothing or a letter of the text (``=``), a letter of the stretch
    (``-``), or the letter at a place of both.
    """
    size, left_out = F.length(part), F.col("_i")
    fewer = _without(F.col(part), left_out)

    def key(length: Column, kind: Column, rest: Column) -> Column:
        return F.concat_ws(":", length.cast("string"), kind, rest)

    same = key(size, left_out.cast("string"), fewer)
    if of_text:
        without, whole = key(size, F.lit("="), fewer), (key(size, F.lit("="), F.col(part)), key(size, F.lit("-"), F.col(part)))
    else:
        without, whole = key(size - 1, F.lit("-"), fewer), (key(size, F.lit("="), F.col(part)), key(size + 1, F.lit("="), F.col(part)))
    # Place 0 leaves nothing out.
    each = rows.select("*", F.explode(F.sequence(F.lit(0), size)).alias("_i"))
    keys = F.when(left_out == 0, F.array(*whole)).otherwise(F.array(same, without))
    return each.select("*", F.explode(keys).alias("key")).drop("_i")


@dataclass(frozen=True)
class TermIndex:
    """A palette ready for joins.

    ``terms`` has one row per term with its place ``ord``; ``short`` the best
    entry per neighbour of a stretch as long as a short text; ``parts`` the
    terms and places per neighbour of a stretch as long as a part. ``lengths``
    are those of the shortest and longest term, ``any_group`` is the group of
    texts that are nearly inside every term.
    """

    terms: DataFrame
    short: DataFrame
    parts: DataFrame
    prefer: str
    lengths: tuple[int, int] | None
    any_group: str | None


def _terms(spark: SparkSession, palette: Palette | DataFrame) -> DataFrame:
    """``(ord, name, term)``; earlier places win."""
    if isinstance(palette, DataFrame):
        return palette.select(F.col("ord").cast("bigint").alias("ord"), "name", F.lower("term").alias("term"))
    rows = [{"name": group, "term": term.lower()} for group, terms in palette for term in terms]
    listed = F.from_json(F.lit(json.dumps(rows)), "array<struct<name:string,term:string>>")
    one = spark.range(1).select(F.posexplode(listed).alias("ord", "_e"))
    return one.select(F.col("ord").cast("bigint").alias("ord"), "_e.name", "_e.term")


def term_index(
    spark: SparkSession, palette: Palette | DataFrame = PALETTE, prefer: str = "listed", stored: bool = True
) -> TermIndex:
    """The index of ``palette``: groups with their terms, or a table ``(ord, name, term)`` of any size.

    ``prefer="closest"`` takes the longest contained term and, in the
    approximate step, the term nearest in length instead of the first listed,
    so that "black" is no longer claimed by "blackish green". An index that is
    not ``stored`` is made anew by each query that uses it.
    """
    keep = pinned if stored else lambda df: df
    # A few terms make many neighbours, so they are dealt to all cores however small they are.
    terms = keep(_terms(spark, palette).repartition(spark.sparkContext.defaultParallelism, "ord"))
    size, own = F.length("part"), F.substring_index("key", ":", 1).cast("int")
    least, most = PART_LENGTHS
    of_short = _neighbours(_stretches(terms, "term", F.lit(1), F.lit(SHORT + 1)), "part", of_text=False)
    short = of_short.filter(own <= SHORT).withColumn("_rank", _near_rank(prefer, own))
    of_parts = _neighbours(_stretches(terms, "term", F.lit(least - 1), F.lit(most + 1)), "part", of_text=False)
    parts = of_parts.filter(own.between(least, most)).select("key", "ord", "name", "term", "at").distinct()
    # The shortest term is nearest in length to a text that is shorter still.
    rank = F.struct(F.length("term") if prefer == "closest" else F.col("name") != FIRST_GROUP, "ord")
    told = terms.agg(
        F.min(F.length("term")).alias("lo"), F.max(F.length("term")).alias("hi"), F.min_by("name", rank).alias("name")
    ).first()
    lengths = None if told["lo"] is None else (told["lo"], told["hi"])
    return TermIndex(terms, keep(short.groupBy("key").agg(F.min("_rank").alias("rank"))), keep(parts), prefer, lengths, told["name"])


def _near_rank(prefer: str, length: Column) -> Column:
    """What the best of several nearly matching terms has the least of, ending with its group."""
    if prefer == "closest":
        how = F.abs(F.length("term") - length).cast("bigint")
    else:
        how = (F.col("name") != FIRST_GROUP).cast("bigint")
    return F.struct(how.alias("how"), F.col("ord").alias("ord"), F.col("name").alias("name"))


def _contained(texts: DataFrame, index: TermIndex) -> DataFrame:
    """``(text, name)`` of the texts that equal or contain a term."""
    if index.lengths is None:
        return texts.limit(0).select("text", F.lit("").alias("name"))
    # Stretches as long as terms are: at most so many times a text's letters.
    pieces = _stretches(texts, "text", *map(F.lit, index.lengths)).select("text", F.col("part").alias("term"))
    size = F.length("term") if index.prefer == "closest" else F.lit(0)
    rank = F.struct((F.col("term") != F.col("text")).alias("not_equal"), (-size).cast("bigint").alias("size"), "ord", "name")
    equal = F.struct(F.lit(False).alias("not_equal"), F.lit(0).cast("bigint").alias("size"), "ord", "name")
    best = F.min(F.when(F.col("term") == F.col("text"), equal).otherwise(rank))
    return pieces.join(index.terms, "term").groupBy("text").agg(best.alias("_b")).select("text", "_b.name")


def _near(texts: DataFrame, index: TermIndex) -> DataFrame:
    """``(text, name)`` of the texts that are nearly inside a term."""
    size = F.length("text")
    edits = F.ceil(size * EDIT_SHARE).cast("int")
    # A text no longer than its allowance matches every term with everything edited away.
    tiny = texts.filter(size <= edits).withColumn("name", F.lit(index.any_group))
    keyed = _neighbours(texts.filter((size > edits) & (size <= SHORT)), "text", of_text=True)
    short = keyed.join(index.short, "key").groupBy("text").agg(F.min("rank").alias("_r")).select("text", "_r.name")

    long = texts.filter(size > SHORT).withColumn("edits", edits).withColumn("_m", F.floor(F.col("edits") / 2).cast("int") + 1)
    cut = lambda j: F.floor(size * j / F.col("_m")).cast("int")
    part = F.transform(
        F.sequence(F.lit(0), F.col("_m") - 1),
        lambda j: F.struct(cut(j).alias("ahead"), F.substring("text", cut(j) + 1, cut(j + 1) - cut(j)).alias("part")),
    )
    pieces = long.select("text", "edits", F.explode(part).alias("_p")).select("text", "edits", "_p.*")
    keyed = _neighbours(pieces, "part", of_text=True)
    met = keyed.join(index.parts, "key").select(
        "text", "edits", "ord", "name", "term", (F.col("at") - F.col("ahead")).alias("about")
    ).distinct()
    # Around the place that the part tells, where the stretch can begin and how long it can be.
    begin = F.sequence(F.greatest(F.col("about") - F.col("edits"), F.lit(1)), F.least(F.col("about") + F.col("edits"), F.length("term")))
    met = met.filter(F.col("about") + F.col("edits") >= 1).filter(F.col("about") - F.col("edits") <= F.length("term"))
    placed = met.select("*", F.explode(begin).alias("begin"))
    room = F.length("term") - F.col("begin") + 1
    lengths = F.sequence(size - F.col("edits"), F.least(size + F.col("edits"), room))
    tried = placed.filter(room >= size - F.col("edits")).select("*", F.explode(lengths).alias("_n"))
    near = tried.filter(F.levenshtein(F.substring("term", F.col("begin"), F.col("_n")), F.col("text")) <= F.col("edits"))
    best = F.min(_near_rank(index.prefer, size)).alias("_r")
    return tiny.select("text", "name").unionByName(short).unionByName(near.groupBy("text").agg(best).select("text", "_r.name"))


def text_groups(texts: DataFrame, index: TermIndex, name: str = "color_group") -> DataFrame:
    """``(text, name)`` of a table of distinct normalised texts, none blank.

    Tried in turn: equal to a term, containing a term, nearly inside a term,
    else the text itself in title case.
    """
    texts = pinned(texts.select("text"))
    contained = _contained(texts, index)
    seen = texts.join(contained, "text", "left")
    rest = texts.join(contained, "text", "left_anti")
    found = seen.join(_near(rest, index).withColumnRenamed("name", "_near"), "text", "left")
    return found.select("text", F.coalesce("name", "_near", title_case(F.col("text"))).alias(name))


def classify_terms(
    df: DataFrame,
    column: str,
    palette: Palette | DataFrame | TermIndex = PALETTE,
    name: str = "color_group",
    prefer: str = "listed",
) -> DataFrame:
    """Adds the palette group of ``column``; missing and blank values get NULL.

    The terms are searched once per distinct text. The groups are joined back
    with frequent texts spread out, since one colour may fill a third of the
    catalogue. An index made once with ``term_index`` serves any number of tables.
    """
    index = palette
    if not isinstance(index, TermIndex):
        # A listed palette is small; its index is made where it is used.
        index = term_index(df.sparkSession, palette, prefer, stored=isinstance(palette, DataFrame))
    keyed = df.withColumn("_text", normal_text(column))
    texts = keyed.select(F.col("_text").alias("text")).filter(F.col("text") != "").distinct()
    groups = text_groups(texts, index, name).withColumnRenamed("text", "_text")
    hot = hot_keys(keyed, "_text")["_text"]
    return salted_left_join(keyed, groups, ["_text"], hot).drop("_text")
