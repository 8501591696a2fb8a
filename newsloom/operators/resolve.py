"""Alias resolution without a model: names that differ in spelling only become one canonical name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.patterns import BLANK, let, strip
from newsloom.operators.components import connected_components, star_edges
from newsloom.operators.keyed import HOT_ROWS, salted_join
from newsloom.session import materialize

# Names of fewer letters, vowel signs not counted, must be equal after normalising; one letter more or less would be another.
MIN_LETTERS = 5
# A form is taken for a misspelling of a head that is used this many times as often.
CLEARLY = 2


def normal_form(name: Column) -> Column:
    """Lower case, punctuation out, single blanks."""
    spaced = F.regexp_replace(F.lower(name), r"[^\p{L}\p{M}\p{N}]+", " ")
    return strip(F.regexp_replace(spaced, f"{BLANK}+", " "))


def spelling_keys(name: Column, min_letters: int = MIN_LETTERS) -> Column:
    """The normal form, and the normal form with each one non-digit character left out.

    Two names share a key when one letter was added, dropped, replaced or moved. Digits are never left out,
    so names that differ in a number stay apart.
    """

    def keys(text: Column) -> Column:
        holes = F.filter(
            F.sequence(F.lit(1), F.length(text)), lambda i: ~F.substr(text, i, F.lit(1)).rlike(r"\p{Nd}")
        )
        dropped = F.transform(
            holes, lambda i: F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1, F.length(text)))
        )
        own = F.array(text)
        letters = F.length(F.regexp_replace(text, r"[^\p{L}]++", ""))
        return F.when(letters >= min_letters, F.array_distinct(F.concat(own, dropped))).otherwise(own)

    return let(normal_form(name), keys)


def spelling_neighbours(names: DataFrame, column: str = "value", min_letters: int = MIN_LETTERS, **join) -> DataFrame:
    """The names with ``component``: the smallest normal form of all that chains of shared spelling keys lead to."""
    rows = materialize(names.withColumn("_form", normal_form(F.col(column))), "names")
    forms = rows.select("_form").distinct()
    keyed = forms.select(F.col("_form").alias("form"), F.explode(spelling_keys(F.col("_form"), min_letters)).alias("key"))
    labels = connected_components(star_edges(keyed, ["key"], "form", **join), **join)
    labels = labels.select(F.col("node").alias("_form"), "component")
    met = salted_join(rows, labels, ["_form"], "left", spread=[column], **join)
    return met.select(*names.columns, F.coalesce("component", "_form").alias("component"))


def _clearly_below(keyed: DataFrame, heads: DataFrame, **join) -> DataFrame:
    """``form, head``: forms that share a key with a clearly more used one of ``heads``; the most used, smallest on a tie."""
    tops = heads.groupBy("key").agg(F.min(F.struct((-F.col("weight")).alias("w"), F.col("form").alias("head"))).alias("top"))
    met = salted_join(keyed, materialize(tops, "tops"), ["key"], spread=["form"], **join)
    below = met.where((F.col("top.head") != F.col("form")) & (-F.col("top.w") >= CLEARLY * F.col("weight")))
    return below.groupBy("form").agg(F.min("top")["head"].alias("head"))


def resolve_aliases(
    names: DataFrame,
    kind: str,
    column: str = "value",
    min_letters: int = MIN_LETTERS,
    hot_rows: int = HOT_ROWS,
    small_bytes: int | None = None,
) -> DataFrame:
    """``kind, canonical, variant, rank, uses`` from one row per use of a name.

    Names of one normal form are one; its most frequent spelling stands for it, the smallest on a tie. A form is a
    misspelling of another when the two share a spelling key and the other is used at least ``CLEARLY`` times as often;
    of several such forms that are no misspellings themselves the most used one is its head. Heads are found by two
    aggregations, the top form of each key and the best over the keys of a form, so names that neighbours one letter
    apart lead to do not run together.
    """
    used = names.where(F.col(column).isNotNull() & (F.col(column) != ""))
    counted = used.groupBy(F.col(column).alias("name")).agg(F.count(F.lit(1)).alias("uses"))
    counted = materialize(counted.withColumn("form", normal_form(F.col("name"))), "names")
    best = F.min(F.struct(-F.col("uses"), F.col("name").alias("name")))["name"]
    forms = counted.groupBy("form").agg(F.sum("uses").alias("weight"), best.alias("best"))
    # Names without a letter or digit have the empty form and stay as they are.
    forms = materialize(forms.where("form <> ''"), "forms")
    join = {"hot_rows": hot_rows, "small_bytes": small_bytes}
    keyed = forms.select("form", "weight", F.explode(spelling_keys(F.col("form"), min_letters)).alias("key"))
    # A key with one form links nothing, and most have one.
    several = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    keyed = materialize(salted_join(keyed, materialize(several, "keys").select("key"), ["key"], "left_semi", spread=["form"], **join), "keyed")
    lesser = materialize(_clearly_below(keyed, keyed, **join).select("form"), "lesser")
    moved = _clearly_below(keyed, keyed.join(lesser, "form", "left_anti"), **join)
    to = forms.select(F.col("form").alias("head"), F.col("best").alias("_to"))
    moved = materialize(moved.join(to, "head").select("form", "_to"), "moved")
    heads_of = forms.join(moved, "form", "left").select("form", F.coalesce("_to", "best").alias("canonical"))
    found = salted_join(counted, heads_of, ["form"], "left", spread=["name"], **join)
    return found.select(
        F.lit(kind).alias("kind"),
        F.coalesce("canonical", "name").alias("canonical"),
        F.col("name").alias("variant"),
        F.lit(0).cast("bigint").alias("rank"),
        "uses",
    )
