"""What a sub-agent's routing marker and a spawn call say."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import is_spawn

# Objects that a marker may be wrapped in, and the names of its fields.
WRAPPERS = ("", ".sub_agent", ".subagent", ".routing")
FIELDS = {"spawn_call_id": ("spawn_call_id", "call_id", "tool_call_id"), "task_name": ("task_name",), "parent_thread_id": ("parent_thread_id",), "parent_turn_id": ("parent_turn_id",), "forked_from_thread_id": ("forked_from_thread_id", "forked_from")}


def marker(raw: Column) -> Column:
    """A struct of a marker's fields, each empty where it isn't stated, and ``opaque``: the marker itself if it has no structure.

    A marker is a JSON object, the fields on it or on an object that wraps them, or a list of ``name=value``."""
    own = F.trim(F.coalesce(raw, F.lit("")))
    is_json = F.startswith(own, F.lit("{")) & F.try_parse_json(own).isNotNull()
    pairs = F.filter(F.transform(F.split(F.translate(own, ";", ","), ","), lambda p: F.split(p, "=", 2)), lambda p: F.size(p) == 2)
    listed = F.map_from_entries(F.array_distinct(F.transform(pairs, lambda p: F.struct(F.trim(p[0]), F.trim(p[1])))))
    first = lambda *values: F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))
    fields = []
    for name, keys in FIELDS.items():
        in_json = first(*[F.get_json_object(own, f"${w}.{k}") for w in WRAPPERS for k in keys])
        in_list = first(*[F.try_element_at(listed, F.lit(k)) for k in keys[:2]])
        fields.append(F.when(is_json, in_json).when(F.size(pairs) > 0, in_list).otherwise("").alias(name))
    return F.struct(*fields, F.when(is_json | (F.size(pairs) > 0), "").otherwise(own).alias("opaque"))


def spawn_signature(name: Column, arguments: Column) -> Column:
    """One text for a spawn call whatever its alias: canonical arguments if they are an object, else raw."""
    return F.concat(F.when(is_spawn(name), "spawn_agent").otherwise(name), F.lit("\x1f"), F.when(F.startswith(F.trim(arguments), F.lit("{")), arguments).otherwise(F.concat(F.lit("raw:"), arguments)))
