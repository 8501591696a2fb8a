"""Explicit types of the tables that flow between the stages."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


S, L = T.StringType(), T.LongType()
NAMES = T.ArrayType(S)

URLS = _struct(("url", S))
PAGES = _struct(("url", S), ("html", S))

# Articles as they lie in JSON files; `entities` stays JSON text until `parse_event_responses` types it.
ARTICLES_JSON = _struct(("url", S), ("title", S), ("published_date", S), ("content", S), ("entities", S))

ENTITY = _struct(
    ("event", S),
    ("actors", NAMES),
    ("event_date", S),
    ("event_time", S),
    ("location", NAMES),
    ("details", S),
)
SOURCE = _struct(("title", S), ("article_url", S), ("published_date", S))

ALIASES = _struct(("kind", S), ("canonical", S), ("variant", S), ("rank", L))

# One event of the date-keyed file that holds numbered events.
GROUPED_EVENT_JSON = _struct(
    ("id", S),
    ("article_url", S),
    ("title", S),
    ("published_date", S),
    ("event", S),
    ("actors", S),
    ("event_date", S),
    ("event_time", S),
    ("location", S),
    ("details", S),
)
# One event of the date-keyed file that holds merged events.
MERGED_EVENT_JSON = _struct(
    ("event", S),
    ("details", S),
    ("actors", NAMES),
    ("source_event_indices", NAMES),
    ("sources", T.ArrayType(SOURCE)),
)

STAR = {
    "actors": _struct(("actor_key", S), ("label", S)),
    "actor_aliases": _struct(("actor_key", S), ("alias", S)),
    "sources": _struct(("source_key", S), ("title", S), ("url", S), ("published_date", T.DateType())),
    "events": _struct(("event_key", S), ("event_date", S), ("label", S), ("details", S)),
    "event_actors": _struct(("event_key", S), ("actor_key", S)),
    "event_sources": _struct(("event_key", S), ("source_key", S)),
}

ARTICLE_LOG = _struct(("id", S), ("title", S), ("timestamp", S))
