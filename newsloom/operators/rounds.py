"""Model work over more rows than one prompt holds: rounds of prompts, until a round brings nothing together."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators import inference
from newsloom.operators.entities import first_matches
from newsloom.operators.keyed import number_in_group
from newsloom.session import materialize

Model = Callable[[pd.Series], pd.Series]
KEYS = ["event_date", "merged_id"]


def merge_rounds(
    events: DataFrame, model: Model, size: int = 500, instructions: str = inference.MERGE_INSTRUCTIONS, **options
) -> dict[str, DataFrame]:
    """``events``, ``members``, ``actors`` as of `inference.merge_parts`, and ``rejects``, from a model that merges.

    A date of up to ``size`` events is one prompt, and its answer stands. A larger date is cut along events that may be
    one. Its merged events are then the events of a further round, as long as a round makes them fewer: members of one
    incident that lay in different prompts meet once there is room. An event that the model's answer leaves out is left out
    in the first round, as in a single prompt; in a later round, and when an answer cannot be read there, it stays.
    """
    current = materialize(events.select("event_date", "id", "event", "details", "actors"), "round")
    parts, rejects, several = _merge_round(current, model, size, instructions, None, **options)
    done = []
    while not several.isEmpty():
        done.append({name: table.join(several, "event_date", "left_anti") for name, table in parts.items()})
        parts = {name: table.join(several, "event_date", "left_semi") for name, table in parts.items()}
        before = several.join(parts["events"].groupBy("event_date").agg(F.count(F.lit(1)).alias("_n")), "event_date")
        before = materialize(before, "sizes")
        merged, _, _ = _merge_round(_as_events(parts), model, size, instructions, parts["members"], **options)
        after = merged["events"].groupBy("event_date").agg(F.count(F.lit(1)).alias("_m"))
        # Dates that did not shrink are finished; the others go on.
        several = materialize(before.join(after, "event_date").where("_m < _n").select("event_date"), "several")
        parts = merged
    result = parts if not done else {name: _union([d[name] for d in done] + [parts[name]]) for name in parts}
    return {**result, "rejects": rejects}


def _union(tables: list[DataFrame]) -> DataFrame:
    found = tables[0]
    for table in tables[1:]:
        found = found.unionByName(table)
    return found


def _as_events(parts: dict[str, DataFrame]) -> DataFrame:
    """Merged events as input of a further round; their number is their id."""
    named = number_in_group(parts["actors"], KEYS, ["actor_pos"], "_n")
    names = named.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("_n", "actor")))["actor"].alias("actors"))
    rows = parts["events"].join(names, KEYS, "left")
    actors = F.coalesce("actors", F.array().cast("array<string>")).alias("actors")
    return materialize(rows.select("event_date", F.col("merged_id").cast("string").alias("id"), "event", "details", actors), "round")


def _merge_round(
    current: DataFrame, model: Model, size: int, instructions: str, members: DataFrame | None, **options
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """Stored parts of one round, its rejects, and the dates of several prompts.

    With ``members`` (those of the events, from the round before) every event that no answer mentions is kept.
    """
    prompts = materialize(inference.merge_prompts(current, instructions, size), "prompts")
    several = materialize(prompts.groupBy("event_date").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("event_date"), "several")
    merged, rejects = inference.parse_merge_responses(inference.infer(prompts, model, **options))
    parts = inference.merge_parts(merged)
    if members is not None:
        named = materialize(parts["members"], "named")
        kept = materialize(current.join(named.select("event_date", "id").distinct(), ["event_date", "id"], "left_anti"), "kept")
        # Ids of kept events follow those of the merged ones.
        last = parts["events"].groupBy("event_date").agg(F.max("merged_id").alias("_last"))
        number = number_in_group(kept.withColumn("_id", F.col("id").cast("bigint")), ["event_date"], ["_id"], "_n")
        placed = number.join(last, "event_date", "left").withColumn("merged_id", F.coalesce("_last", F.lit(0)) + F.col("_n"))
        placed = materialize(placed, "placed")
        parts["events"] = parts["events"].unionByName(placed.select(*KEYS, "event", "details"))
        own = placed.select(*KEYS, F.posexplode("actors").alias("actor_pos", "actor"))
        parts["actors"] = parts["actors"].unionByName(own)
        outer = named.unionByName(placed.select(*KEYS, F.lit(0).alias("member_pos"), "id"))
        outer = outer.select(*KEYS, F.col("member_pos").cast("bigint").alias("_outer"), F.col("id").cast("bigint").alias("_of"))
        inner = members.select("event_date", F.col("merged_id").alias("_of"), F.col("member_pos").alias("_inner"), "id")
        met = outer.join(inner, ["event_date", "_of"])
        numbered = number_in_group(met, KEYS, ["_outer", "_inner"], "_n", chunk_bits=0)
        parts["members"] = numbered.select(*KEYS, (F.col("_n") - 1).cast("int").alias("member_pos"), "id")
    return {name: materialize(table, name) for name, table in parts.items()}, rejects, several


def unify_rounds(
    names: DataFrame, kind: str, model: Model, size: int = 2_000, instructions: str = inference.UNIFY_INSTRUCTIONS, **options
) -> DataFrame:
    """``kind, canonical, variant, rank`` of all names, from a model that unifies the names of a prompt.

    Names over ``size`` are cut along spellings that may be one. The unified names are the names of a further round, as
    long as there are several prompts and the names become fewer; a variant then belongs to the name that its name was
    unified to. A name that no answer holds stays as it is.
    """
    current = materialize(names.select("value").where("value <> ''").distinct(), "names")
    found = None
    while True:
        prompts = materialize(inference.alias_prompts(current, instructions, size), "prompts")
        answered = inference.infer(prompts, model, **options)
        rows = first_matches(inference.dictionary_rows(answered, kind)).select("canonical", "variant")
        rows = materialize(rows.join(current.withColumnRenamed("value", "variant"), "variant", "left_semi"), "rows")
        all_rows = current.select(F.col("value").alias("variant")).join(rows, "variant", "left")
        step = materialize(all_rows.select("variant", F.coalesce("canonical", "variant").alias("canonical")), "step")
        if found is None:
            found = step
        else:
            later = step.select(F.col("variant").alias("canonical"), F.col("canonical").alias("_to"))
            found = materialize(found.join(later, "canonical", "left").select("variant", F.coalesce("_to", "canonical").alias("canonical")), "found")
        following = materialize(step.select(F.col("canonical").alias("value")).distinct(), "names")
        if prompts.count() < 2 or following.count() >= current.count():
            break
        current = following
    return found.select(F.lit(kind).alias("kind"), "canonical", "variant", F.lit(0).cast("bigint").alias("rank"))
