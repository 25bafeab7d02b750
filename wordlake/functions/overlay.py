"""Members put into JSON objects whose other keys are not known: nested values stay as they are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MEMBERS = "map<string,variant>"


def is_object(text: Column) -> Column:
    """Whether the text is a JSON object; false for null and for what cannot be parsed."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))


def put_members(text: Column, members: dict[str, Column]) -> Column:
    """The object with the members (JSON texts by key) set; null, or what is no object, counts as an empty one."""
    none = F.create_map().cast(MEMBERS)
    old = F.coalesce(F.when(is_object(text), F.try_parse_json(text)).cast(MEMBERS), none)
    kept = F.map_filter(old, lambda k, v: ~k.isin(*members))
    new = F.create_map(*[x for k, v in members.items() for x in (F.lit(k), F.parse_json(v))])
    return F.to_json(F.map_concat(kept, new))
