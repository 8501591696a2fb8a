"""The data work around a text model: prompts, the call stage, and the reading of responses.

The model itself is a function the user gives. Deterministic stand-ins live in `baseline`, `resolve` and `merge`.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.patterns import BLANK, let, strip
from newsloom.operators.keyed import chunk_units, number_in_group, salted_join, spread
from newsloom.operators.resolve import spelling_neighbours
from newsloom.operators.similar import shingles, similar_groups
from newsloom.session import is_complete, materialize

EXTRACT_INSTRUCTIONS = (
    "List the distinct events this news article reports, in the language of the article, as a JSON array of objects "
    "with event, actors, event_date (YYYY-MM-DD), event_time (24 hours or null), location and details."
)
UNIFY_INSTRUCTIONS = (
    "Names of one and the same actor or place belong together. "
    "Return a JSON object: unified name -> list of the names below that mean it."
)
MERGE_INSTRUCTIONS = (
    "Merge the events below that tell of the same incident and keep the others as they are. Return a JSON array of "
    "objects with event, details, actors (without repeats) and source_event_indices."
)

# Required fields of an event.
REQUIRED_FIELDS = ["event", "actors", "event_date", "details", "location"]


def extraction_prompts(articles: DataFrame, instructions: str = EXTRACT_INSTRUCTIONS) -> DataFrame:
    """``pos, prompt``: instructions, an empty line, and the whole content. Title and date are not part of it."""
    content = F.coalesce(F.col("content"), F.lit(""))
    return articles.select("pos", F.concat(F.lit(instructions + "\n\n"), content).alias("prompt"))


def alias_prompts(names: DataFrame, instructions: str = UNIFY_INSTRUCTIONS, size: int = 2_000) -> DataFrame:
    """``chunk, prompt``: instructions and the names, one per line, at most ``size`` names to a prompt.

    Up to ``size`` names give the one prompt over all names. More are cut along neighbourhoods: names whose spellings
    may be one lie in one prompt, whatever letter they begin with.
    """
    rows = spelling_neighbours(names.select("value").distinct())
    chunks = chunk_units(rows, [], "component", ["value"], size)
    lines = chunks.groupBy("chunk").agg(F.array_join(F.array_sort(F.collect_list("value")), "\n").alias("names"))
    return lines.select("chunk", F.concat(F.lit(instructions + "\n"), "names").alias("prompt"))


def merge_prompts(
    events: DataFrame, instructions: str = MERGE_INSTRUCTIONS, size: int = 500, candidates: DataFrame | None = None
) -> DataFrame:
    """``event_date, chunk, prompt``: the JSON of a date's events, at most ``size`` events to a prompt.

    A date of up to ``size`` events is one prompt. More are cut along ``candidates`` (``event_date, n, component``: events
    that may be one; by default those whose words are near copies), so that these lie in one prompt. Inside candidates
    that are more than ``size``, events of like and of equal words are kept together.
    """
    rows = events.select("event_date", F.col("id").cast("bigint").alias("n"), "id", "event", "details", "actors")
    if candidates is None:
        rows = materialize(rows, "events")
        candidates = candidate_groups(rows)
    rows = materialize(rows.join(candidates, ["event_date", "n"]), "candidates")
    for threshold in (0.8, 1.0):
        large = rows.groupBy("event_date", "component").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > size)
        large = materialize(large.select("event_date", "component"), "large")
        if large.isEmpty():
            break
        # The members of a large component are told apart more finely.
        wide = materialize(salted_join(rows, large, ["event_date", "component"], "left_semi", spread=["n"]), "wide")
        finer = candidate_groups(wide.drop("component"), threshold)
        rest = salted_join(rows, large, ["event_date", "component"], "left_anti", spread=["n"])
        rows = materialize(rest.unionByName(wide.drop("component").join(finer, ["event_date", "n"])), "candidates")
    chunks = chunk_units(rows, ["event_date"], "component", ["n"], size)
    item = F.struct("n", F.struct("id", "event", "details", "actors").alias("event"))
    listed = chunks.groupBy("event_date", "chunk").agg(F.array_sort(F.collect_list(item))["event"].alias("Events"))
    body = F.to_json(F.struct("Events"), {"ignoreNullFields": "false"})
    return listed.select("event_date", "chunk", F.concat(F.lit(instructions + "\n\n"), body).alias("prompt"))


def candidate_groups(events: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``event_date, n, component``: events of a date linked by the words of title and details."""
    words = shingles(F.concat_ws(" ", "event", "details"), 1)
    return similar_groups(events.select("event_date", "n", words.alias("tokens")), ["event_date"], "n", "tokens", threshold)


def infer(
    prompts: DataFrame,
    model: Callable[[pd.Series], pd.Series | list],
    calls_in_flight: int | None = None,
    store: bool = True,
    work: str | None = None,
    buckets: int = 16,
) -> DataFrame:
    """Adds ``response`` and ``error`` by running ``model`` over Arrow batches of ``prompt``.

    ``model`` maps a series of prompts to a series or list of as many responses. A batch that fails is asked again in halves,
    or in smaller pieces as more prompts of the task have failed, down to one by one; a prompt that fails alone gets a null
    response and the text of the failure. The result is written before use,
    since a plan may otherwise run the calls again. ``calls_in_flight`` sets how many tasks call at the same time.

    With ``work``, a folder that keeps its name over runs, prompts are answered bucket by bucket of their hash, and a
    bucket that is written there already is not asked again: a run that broke off pays only for what was missing.
    """
    schema = T.StructType(
        [*prompts.schema.fields, T.StructField("response", T.StringType(), True), T.StructField("error", T.StringType(), True)]
    )

    def answer(batch: pd.Series, seen: Counter) -> list[tuple]:
        try:
            found = list(model(batch))
            if len(found) != len(batch):
                raise ValueError(f"{len(found)} responses to {len(batch)} prompts")
            seen["settled"] += len(batch)
            return [(response, None) for response in found]
        except Exception as failure:
            if len(batch) == 1:
                seen.update(settled=1, refused=1)
                return [(None, f"{type(failure).__name__}: {failure}")]
        found = []
        while len(found) < len(batch):
            size = len(batch) // 2
            if seen["refused"]:
                size = max(1, min(size, seen["settled"] // (2 * seen["refused"])))
            found += answer(batch.iloc[len(found) : len(found) + size], seen)
        return found

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Counter()
        for batch in batches:
            found = answer(batch["prompt"], seen) if len(batch) else []
            yield batch.assign(response=[r for r, _ in found], error=[e for _, e in found])

    def answered(rows: DataFrame) -> DataFrame:
        return (rows.repartition(calls_in_flight) if calls_in_flight else rows).mapInPandas(run, schema)

    if work is None:
        return materialize(answered(prompts), "responses") if store else answered(prompts)
    bucket = F.pmod(F.xxhash64("prompt"), F.lit(buckets))
    for number in range(buckets):
        path = f"{work}/bucket={number}"
        if not is_complete(prompts.sparkSession, path):
            answered(prompts.where(bucket == number)).write.mode("overwrite").parquet(path)
    paths = [f"{work}/bucket={number}" for number in range(buckets)]
    return prompts.sparkSession.read.schema(schema).parquet(*paths)


def allow_repeated_keys(df: DataFrame) -> DataFrame:
    """Lets JSON objects repeat a key, the last value standing, as most parsers do (a setting of the session)."""
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return df


def _json(text: Column) -> Column:
    """The parsed text when it looks like an object or a list, else null."""
    return F.try_parse_json(F.when(text.rlike(f"^{BLANK}*[{{\\[]"), strip(text)))


def _is_string(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def _is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _list(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _names(value: Column) -> Column:
    """Names of a list or of a lone string: inner lists flattened one level, everything but strings dropped."""

    def strings(item: Column) -> Column:
        inner = F.transform(F.filter(_list(item), _is_string), _text)
        return F.coalesce(inner, F.when(_is_string(item), F.array(_text(item))), F.array().cast("array<string>"))

    items = F.coalesce(_list(value), F.when(_is_string(value), F.array(value)))
    return F.flatten(F.transform(items, strings))


def _entity(item: Column) -> Column:
    def raw(name: str) -> Column:
        return F.try_variant_get(item, f"$.{name}", "variant")

    def text(name: str) -> Column:
        return F.try_variant_get(item, f"$.{name}", "string")

    present = {name: raw(name).isNotNull() & ~F.coalesce(F.is_variant_null(raw(name)), F.lit(True)) for name in REQUIRED_FIELDS}
    missing = F.filter(
        F.array(*[F.when(~present[name], F.lit(name)) for name in REQUIRED_FIELDS]), lambda name: name.isNotNull()
    )
    date = text("event_date")
    good_date = date.rlike(r"^\d{4}-\d{2}-\d{2}\z") & date.try_cast("date").isNotNull()
    return F.struct(
        text("event").alias("event"),
        _names(raw("actors")).alias("actors"),
        date.alias("event_date"),
        text("event_time").alias("event_time"),
        _names(raw("location")).alias("location"),
        text("details").alias("details"),
        missing.alias("missing_fields"),
        (~F.coalesce(good_date, F.lit(False))).alias("bad_date"),
    )


def parse_event_responses(df: DataFrame, column: str = "response") -> DataFrame:
    """Types the JSON of ``column``: adds ``entities``, ``raw_response`` and ``parse_ok``.

    A missing response is an empty list, a lone object a list of one. Text that is no JSON stays in ``raw_response``
    with ``parse_ok`` false and no entities; list items that are not objects are left out, and are in `odd_items`.
    """
    rows = spread(allow_repeated_keys(df)).withColumn("_v", _json(F.col(column)))
    items = F.coalesce(_list(F.col("_v")), F.when(F.col("_v").isNotNull(), F.array("_v")))
    rows = rows.withColumn("_items", F.filter(items, _is_object))
    ok = F.col("_items").isNotNull() | F.col(column).isNull()
    typed = F.transform("_items", _entity)
    return rows.withColumns(
        {
            "entities": F.coalesce(typed, F.filter(F.transform(F.array(F.parse_json(F.lit("{}"))), _entity), lambda _: F.lit(False))),
            "raw_response": F.when(~ok, F.col(column)),
            "parse_ok": ok,
        }
    ).drop("_v", "_items", *([column] if column not in ("entities", "raw_response") else []))


def odd_items(df: DataFrame, column: str = "response") -> DataFrame:
    """The list items of ``column`` that are no objects: a row each, with its place as ``item_pos`` and its JSON as ``item``."""
    kept = [c for c in df.columns if c != column]
    items = _list(_json(F.col(column)))
    rows = allow_repeated_keys(df).select(*kept, F.posexplode(items).alias("item_pos", "_item"))
    odd = rows.where(~F.coalesce(_is_object(F.col("_item")), F.lit(False)))
    return odd.select(*kept, "item_pos", F.coalesce(F.to_json("_item"), F.lit("null")).alias("item"))


def split_conforming(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flat entity rows into (good, rejected) by required fields and date form."""
    good = (F.size("missing_fields") == 0) & ~F.col("bad_date")
    return entities.where(good).drop("missing_fields", "bad_date"), entities.where(~good)


def dictionary_rows(df: DataFrame, kind: str, column: str = "response") -> DataFrame:
    """``kind, canonical, variant, rank`` from JSON objects name -> list, in the order of the text.

    A name that comes twice keeps its first place and its last list. A variant list that is a plain string is not a list
    of names and gives no rows. With a ``chunk`` column the objects of the chunks follow each other.
    What is no JSON object is in `dictionary_rejects`.
    """
    df = allow_repeated_keys(df)
    text = F.when(_is_object(F.try_parse_json(F.col(column))), F.col(column))
    pairs = F.from_json(text, "map<string,string>", {"mode": "PERMISSIVE"})
    chunk = F.col("chunk") if "chunk" in df.columns else F.lit(0)

    def last_of_each(entries: Column) -> Column:
        names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
        last = F.transform(names, lambda name: F.element_at(F.filter(entries, lambda e: e["key"] == name), -1))
        return F.when(F.size(names) < F.size(entries), last).otherwise(entries)

    entries = df.select(
        chunk.cast("bigint").alias("_chunk"), F.posexplode(let(F.map_entries(pairs), last_of_each)).alias("_i", "_e")
    )
    names = F.when(F.col("_e.value").startswith("["), F.from_json("_e.value", "array<string>"))
    rows = entries.select("_chunk", "_i", F.col("_e.key").alias("canonical"), F.explode(names).alias("variant"))
    rank = F.shiftleft("_chunk", 32) + F.col("_i")
    return rows.where(F.col("variant").isNotNull()).select(
        F.lit(kind).alias("kind"), "canonical", "variant", rank.alias("rank")
    )


def dictionary_rejects(df: DataFrame, column: str = "response") -> DataFrame:
    """The rows whose text is there but is no JSON object."""
    good = F.coalesce(_is_object(F.try_parse_json(F.col(column))), F.lit(False))
    return allow_repeated_keys(df).where(F.col(column).isNotNull() & ~good)


def latest_dictionary(new: DataFrame, last_good: DataFrame) -> DataFrame:
    """The new dictionary, with the entries of the last good one for variants the new one lacks.

    When the new response failed there are no new rows and the last good dictionary stands as it is.
    """
    kept = last_good.join(new.select("kind", "variant").distinct(), ["kind", "variant"], "left_anti")
    shift = F.lit(1 << 61)
    return new.unionByName(kept.withColumn("rank", F.col("rank") + shift))


def parse_merge_responses(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``event_date, chunk, response`` into (merged events, rejects).

    Merged events are flat: ``event_date, merged_id, event, details, actors, members``, with ``merged_id`` = 1..n
    per date over its chunks. Rejects are the rows whose response is missing or no JSON list, and, one row each with
    its text as ``response``, the items of a list that are no objects. A lone name counts as a list of one.
    """
    rows = allow_repeated_keys(responses).withColumn("_items", _list(_json(F.col("response"))))
    unread = rows.where(F.col("_items").isNull()).drop("_items")
    items = rows.where(F.col("_items").isNotNull()).select("event_date", "chunk", F.posexplode("_items").alias("_i", "_e"))
    good_item = F.coalesce(_is_object(F.col("_e")), F.lit(False))
    odd = items.where(~good_item).select("event_date", "chunk", F.coalesce(F.to_json("_e"), F.lit("null")).alias("response"))
    rejects = unread.unionByName(odd, allowMissingColumns=True)
    flat = items.where(good_item).withColumn("_pos", F.shiftleft("chunk", 32) + F.col("_i"))

    def raw(name: str) -> Column:
        return F.try_variant_get("_e", f"$.{name}", "variant")

    flat = flat.select(
        "event_date",
        "_pos",
        F.try_variant_get("_e", "$.event", "string").alias("event"),
        F.try_variant_get("_e", "$.details", "string").alias("details"),
        _names(raw("actors")).alias("actors"),
        _members(raw("source_event_indices")).alias("members"),
    )
    numbered = number_in_group(flat, ["event_date"], ["_pos"], "merged_id", chunk_bits=32)
    return numbered.select("event_date", "merged_id", "event", "details", "actors", "members"), rejects


def _members(value: Column) -> Column:
    """Ids of a list or a lone id, as text, numbers included."""
    items = F.coalesce(_list(value), F.when(value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(True)), F.array(value)))
    return F.filter(F.transform(items, _text), lambda x: x.isNotNull())


def merge_parts(merged: DataFrame) -> dict[str, DataFrame]:
    """Flat tables of nested merged events: ``events``, ``members``, ``actors`` and, when present, ``sources``."""
    keys = ["event_date", "merged_id"]
    parts = {"events": merged.select(*keys, "event", "details")}
    if "members" in merged.columns:
        member = merged.select(*keys, F.posexplode("members").alias("member_pos", "id"))
        parts["members"] = member.withColumn("id", F.col("id").cast("string"))
    parts["actors"] = merged.select(*keys, F.posexplode("actors").alias("actor_pos", "actor"))
    if "sources" in merged.columns:
        sources = merged.select(*keys, F.posexplode("sources").alias("source_pos", "s"))
        parts["sources"] = sources.select(*keys, "source_pos", "s.*")
    return parts
