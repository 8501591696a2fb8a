"""Event entities: unnesting, distinct names, mapping of names to canonical names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.operators.keyed import salted_join

ACTOR, LOCATION = "actor", "location"
LITERAL_LIMIT = 256


def unnest_entities(articles: DataFrame, pos: str = "pos", entities: str = "entities") -> DataFrame:
    """One row per entity: article columns under their flat names, ``entity_pos``, and all entity fields.

    An article without entities gives no row. Entity fields win over article columns of the same name.
    """
    fields = articles.schema[entities].dataType.elementType.names
    kept = [c for c in articles.columns if c not in (pos, entities, "url", "content", "article_pos") and c not in fields]
    rows = articles.select(
        F.col(pos).alias("article_pos"),
        *([F.col("url").alias("article_url")] if "url" in articles.columns and "article_url" not in fields else []),
        *kept,
        F.posexplode(entities).alias("entity_pos", "_entity"),
    )
    return rows.select(*[c for c in rows.columns if c != "_entity"], "_entity.*")


def unique_values(articles: DataFrame, field: str, entities: str = "entities") -> DataFrame:
    """Distinct non-empty values of a list or scalar entity field, as ``value``."""
    values = F.col(f"{entities}.{field}")
    inner = articles.select(values.alias("v")).schema["v"].dataType.elementType
    values = F.flatten(F.filter(values, lambda v: v.isNotNull())) if inner.typeName() == "array" else values
    rows = articles.select(F.explode(values).alias("value"))
    return rows.where(F.col("value").isNotNull() & (F.col("value") != "")).distinct()


def sorted_values(values: DataFrame, column: str = "value") -> DataFrame:
    """By code point: Spark compares strings by their UTF-8 bytes, which is the same order."""
    return values.orderBy(column)


def first_matches(aliases: DataFrame) -> DataFrame:
    """One canonical name per ``(kind, variant)``: the dictionary entry of lowest rank wins."""
    return aliases.groupBy("kind", "variant").agg(F.min_by("canonical", F.struct("rank", "canonical")).alias("canonical"))


def canonical_column(value: Column, dictionary: Mapping[str, Sequence[str]]) -> Column:
    """Lookup in a small dictionary held in the plan; unknown names stay."""
    first: dict[str, str] = {}
    for canonical, variants in dictionary.items():
        if isinstance(variants, str):
            raise TypeError(f"variants of {canonical!r} must be a list")
        for variant in variants:
            first.setdefault(variant, canonical)
    if not first:
        return value
    if len(first) > LITERAL_LIMIT:
        raise ValueError(f"{len(first)} variants are too many for the plan; use a dictionary table")
    table = F.create_map(*[F.lit(x) for pair in first.items() for x in pair])
    return F.coalesce(F.try_element_at(table, value), value)


def canonicalize_with(
    entities: DataFrame,
    actors: Mapping[str, Sequence[str]],
    locations: Mapping[str, Sequence[str]],
    key: Sequence[str] = ("article_pos", "entity_pos"),
) -> DataFrame:
    """Canonical ``actors`` and ``location`` of flat entity rows from dictionaries in memory.

    Small ones lie in the plan, without a shuffle; longer ones become a table for `canonicalize`, by the same rule.
    """
    if max(sum(map(len, d.values())) for d in (actors, locations)) > LITERAL_LIMIT:
        listed = [
            (kind, canonical, variant, rank)
            for kind, dictionary in ((ACTOR, actors), (LOCATION, locations))
            for rank, (canonical, variants) in enumerate(dictionary.items())
            for variant in variants
        ]
        table = entities.sparkSession.createDataFrame(listed, "kind string, canonical string, variant string, rank long")
        return canonicalize(entities, table, key)

    def mapped(column: str, dictionary: Mapping[str, Sequence[str]]) -> Column:
        names = F.filter(column, lambda name: name.isNotNull())
        return F.transform(names, lambda name: canonical_column(name, dictionary))

    return entities.withColumns({"actors": mapped("actors", actors), "location": mapped("location", locations)})


def canonicalize_values(values: DataFrame, aliases: DataFrame, kind: str, column: str = "value", **join) -> DataFrame:
    """Adds ``canonical`` to a column of names; names outside the dictionary map to themselves."""
    found = first_matches(aliases.where(F.col("kind") == kind)).select(F.col("variant").alias(column), "canonical")
    joined = salted_join(values, found, [column], "left", **join)
    return joined.withColumn("canonical", F.coalesce("canonical", column))


def canonicalize(
    entities: DataFrame, aliases: DataFrame, key: Sequence[str] = ("article_pos", "entity_pos"), **join
) -> DataFrame:
    """Canonical ``actors`` and ``location`` of flat entity rows from a dictionary table of any size.

    Only the key and the names go through the lookup, actors and locations in one pass; order and duplicates
    stay. The wide columns are shuffled once, by the entity key.
    """
    key = list(key)

    def tagged(column: str, kind: str) -> Column:
        return F.transform(
            F.coalesce(F.col(column), F.array().cast("array<string>")),
            lambda name, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), name.alias("variant")),
        )

    tags = F.concat(tagged("actors", ACTOR), tagged("location", LOCATION))
    names = entities.select(*key, F.explode(tags).alias("n")).select(*key, "n.*").where(F.col("variant").isNotNull())
    found = salted_join(names, first_matches(aliases), ["kind", "variant"], "left", spread=[*key, "i"], **join)
    item = F.struct("i", F.coalesce("canonical", "variant").alias("name"))
    lists = found.groupBy(*key).agg(
        *[
            F.array_sort(F.collect_list(F.when(F.col("kind") == kind, item))).alias(f"_{kind}")
            for kind in (ACTOR, LOCATION)
        ]
    )
    joined = entities.join(lists, key, "left")

    def rebuilt(column: str, kind: str) -> Column:
        changed = F.coalesce(F.transform(f"_{kind}", lambda x: x["name"]), F.array().cast("array<string>"))
        return F.when(F.col(column).isNotNull(), changed)

    out = joined.withColumns({"actors": rebuilt("actors", ACTOR), "location": rebuilt("location", LOCATION)})
    return out.select(*entities.columns)


def with_canonical_entities(articles: DataFrame, aliases: DataFrame, pos: str = "pos", **join) -> DataFrame:
    """The nested form: articles with the same columns, and ``entities`` with canonical names."""
    kind = articles.schema["entities"].dataType
    rows = articles.select(F.col(pos).alias("article_pos"), F.posexplode("entities").alias("entity_pos", "e"))
    flat = canonicalize(rows.select("article_pos", "entity_pos", "e.*"), aliases, **join)
    item = F.struct("entity_pos", F.struct(*kind.elementType.names).alias("e"))
    lists = flat.groupBy(F.col("article_pos").alias(pos)).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    empty = F.when(F.col("entities").isNotNull(), F.array().cast(kind))
    joined = articles.join(lists, pos, "left")
    return joined.withColumn(
        "entities", F.coalesce(F.transform("_items", lambda x: x["e"]), empty)
    ).select(*articles.columns)
