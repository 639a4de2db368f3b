"""Tool calls against their results and definitions.

``calls(node_id, pos, call_id, name, arguments)`` holds the calls of a transcript by the position of their message,
``results(node_id, pos, call_id, name)`` its tool messages, ``tools(node_id, name, description, parameters)`` its
definitions; arguments and parameters are JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DETAILS = 50


def pairing_issues(calls: DataFrame, results: DataFrame) -> DataFrame:
    """``(node_id, call_id, code, pos)`` of every defect between the calls and results of a node.

    A call id's first call counts, later ones are duplicates; a call should have one result, after it, of its name.
    """
    place = Window.partitionBy("node_id", "call_id").orderBy("pos", "name")
    numbered = calls.select("node_id", "call_id", "pos", "name", F.row_number().over(place).alias("nth"))
    repeated = numbered.where("nth > 1").select("node_id", "call_id", F.lit("duplicate_tool_call_id").alias("code"), "pos")
    first = numbered.where("nth = 1").select("node_id", "call_id", F.col("pos").alias("call_pos"), F.col("name").alias("call_name"))
    got = results.groupBy("node_id", "call_id").agg(F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("found"))
    both = first.join(got, ["node_id", "call_id"], "full_outer")
    missing, many = F.col("found").isNull(), F.size("found") > 1
    issue = lambda code, pos: F.struct(F.lit(code).alias("code"), pos.cast("long").alias("pos"))
    none = F.array().cast("array<struct<code:string,pos:bigint>>")
    each = F.when(
        F.col("call_pos").isNotNull() & ~missing,
        F.flatten(
            F.transform(
                "found",
                lambda r: F.concat(
                    F.when(r["pos"] < F.col("call_pos"), F.array(issue("tool_result_before_call", r["pos"]))).otherwise(none),
                    F.when(F.coalesce(r["name"], F.lit("")) != F.coalesce("call_name", F.lit("")), F.array(issue("tool_result_name_mismatch", r["pos"]))).otherwise(none),
                ),
            )
        ),
    ).otherwise(none)
    whole = (
        F.when(F.col("call_pos").isNull(), F.array(issue("orphan_tool_result", F.col("found")[0]["pos"])))
        .when(missing, F.array(issue("missing_tool_result", F.col("call_pos"))))
        .when(many, F.array(issue("duplicate_tool_result", F.get(F.col("found"), F.lit(1))["pos"])))
        .otherwise(none)
    )
    found = both.select("node_id", "call_id", F.explode(F.concat(whole, each)).alias("x")).select("node_id", "call_id", "x.code", "x.pos")
    return repeated.unionByName(found)


def undefined_calls(calls: DataFrame, tools: DataFrame) -> DataFrame:
    """Calls whose node defines no tool of their name."""
    return calls.join(tools.select("node_id", "name").distinct(), ["node_id", "name"], "left_anti")


def json_kind(text: Column) -> Column:
    """The JSON type of a value, given as JSON text."""
    return (
        F.when(text.isNull() | (text == "null"), "null")
        .when(text.isin("true", "false"), "boolean")
        .when(text.startswith('"'), "string")
        .when(text.startswith("["), "array")
        .when(text.startswith("{"), "object")
        .when(text.rlike(r"[.eE]"), "number")
        .otherwise("integer")
    )


def check_calls(calls: DataFrame, tools: DataFrame) -> DataFrame:
    """``calls`` with what each one's check says: ``undefined``, ``unverifiable``, ``extra``, ``missing``, ``defaulted``
    (sorted argument names), ``mistyped`` (sorted ``name:declared,...:actual``) and ``mismatch``.

    Arguments and the ``properties`` of the parameters must be objects, else a call can't be verified. A required
    argument that is absent is no defect if its property has a default or may be null. An integer is a number too; a
    property that declares no type takes any.
    """
    none = F.array().cast("array<string>")
    # a definition is read once, whatever the number of its calls
    own = tools.select("node_id", "name", raw_members(F.get_json_object("parameters", "$.properties")).alias("_properties"), F.get_json_object("parameters", "$.required").alias("_asked"))
    kind = lambda p: F.get_json_object(p, "$.type")
    declared = lambda p: F.when(kind(p).startswith("["), F.from_json(kind(p), "array<string>")).otherwise(F.array_compact(F.array(kind(p))))
    own = own.withColumn("_types", F.transform_values("_properties", lambda _, p: declared(p)))
    may_lack = lambda n: F.coalesce(F.array_contains(F.json_object_keys(F.element_at("_properties", n)), "default") | F.array_contains(F.element_at("_types", n), "null"), F.lit(False))
    own = own.select(
        "node_id", "name", "_types", F.map_keys("_types").alias("_known"), F.filter(F.map_keys("_types"), may_lack).alias("_spared"),
        F.coalesce(F.when(F.col("_asked").startswith("["), F.from_json("_asked", "array<string>")), none).alias("_required"), F.lit(True).alias("_defined"),
    )
    given = calls.withColumn("_kinds", F.transform_values(raw_members("arguments"), lambda _, v: json_kind(v)))
    out = given.join(own, ["node_id", "name"], "left").withColumn("undefined", F.col("_defined").isNull()).withColumn("_given", F.map_keys("_kinds"))
    out = out.withColumn("unverifiable", ~F.col("undefined") & (F.col("_kinds").isNull() | F.col("_types").isNull()))
    checked = ~F.col("undefined") & ~F.col("unverifiable")
    type_of, kind_of = lambda n: F.element_at("_types", n), lambda n: F.element_at("_kinds", n)
    fits = lambda n: (F.size(type_of(n)) == 0) | F.array_contains(type_of(n), kind_of(n)) | ((kind_of(n) == "integer") & F.array_contains(type_of(n), "number"))
    out = out.withColumn("_absent", F.array_except("_required", "_given")).withColumn("_wrong", F.filter(F.array_sort(F.array_intersect("_given", "_known")), lambda n: ~fits(n)))
    told = F.transform("_wrong", lambda n: F.concat_ws(":", n, F.array_join(type_of(n), ","), kind_of(n)))
    when = lambda value: F.when(checked, value).otherwise(none)
    spared = lambda n: F.array_contains("_spared", n)
    out = out.withColumns({"extra": when(F.array_sort(F.array_except("_given", "_known"))), "missing": when(F.filter("_absent", lambda n: ~spared(n))), "defaulted": when(F.filter("_absent", spared)), "mistyped": when(told)})
    out = out.withColumn("mismatch", F.col("undefined") | (F.size("extra") > 0) | (F.size("missing") > 0) | (F.size("mistyped") > 0))
    return out.drop("_types", "_known", "_spared", "_required", "_defined", "_kinds", "_given", "_absent", "_wrong")


def raw_members(value: Column | str) -> Column:
    """A JSON object as a map from its keys to the JSON texts of its values; null for anything else."""
    value = F.col(value) if isinstance(value, str) else value
    parsed = F.when(F.trim(value).startswith("{"), F.try_parse_json(value))
    return F.when(parsed.isNotNull(), F.map_from_entries(F.transform(F.json_object_keys(value), lambda k: F.struct(k, F.to_json(F.try_variant_get(parsed, F.concat(F.lit("$['"), k, F.lit("']")), "variant"))))))


def call_counters(checked: DataFrame) -> DataFrame:
    """Twelve counters of each node of :func:`check_calls`, with the names of missing definitions."""
    count = lambda c, name: F.count_if(c).alias(name)
    fine = ~F.col("undefined") & ~F.col("unverifiable")
    return checked.groupBy("node_id").agg(
        F.count("*").alias("total_calls"),
        count(F.col("undefined"), "undefined_tool_calls"),
        count(F.col("unverifiable"), "unverifiable_calls"),
        count(fine, "checked_calls"),
        count(F.size("extra") > 0, "extra_arg_calls"),
        count(F.size("missing") > 0, "missing_required_calls"),
        count(F.size("mistyped") > 0, "type_mismatch_calls"),
        count(F.size("defaulted") > 0, "defaulted_missing_calls"),
        count(F.col("mismatch"), "mismatch_calls"),
        F.greatest(F.count_if("mismatch") - DETAILS, F.lit(0).cast("long")).alias("mismatches_truncated"),
        F.array_sort(F.collect_set(F.when(F.col("undefined"), F.col("name")))).alias("missing_tool_defs"),
    )


def first_details(checked: DataFrame, most: int = DETAILS) -> DataFrame:
    """The first mismatching calls of each node, ``most`` of them."""
    nth = F.row_number().over(Window.partitionBy("node_id").orderBy("pos", "call_id", "name"))
    return checked.where("mismatch").withColumn("nth", nth).where(F.col("nth") <= most)


def tool_counts(calls: DataFrame) -> DataFrame:
    """``(node_id, total_tool_calls, tool_counts)`` with a map from names to counts, in the order of the names."""
    each = calls.groupBy("node_id", "name").agg(F.count("*").alias("n"))
    return each.groupBy("node_id").agg(F.sum("n").alias("total_tool_calls"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "n")))).alias("tool_counts"))


def occurrences(calls: DataFrame) -> DataFrame:
    """Each call with which repetition of its id in its capture it is, from 0."""
    return calls.withColumn("occurrence", F.row_number().over(Window.partitionBy("node_id", "call_id").orderBy("pos", "name")) - 1)


def completed_before(messages: DataFrame) -> DataFrame:
    """``messages(capture_id, pos, kind, call_id)``: at each ``agent_message``, the ids of the spawns whose result came before."""
    before = Window.partitionBy("capture_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    done = F.collect_set(F.when(F.col("kind") == "spawn_result", F.col("call_id"))).over(before)
    return messages.withColumn("completed", F.array_sort(done)).where("kind = 'agent_message'")


def server_pairs(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Calls that a server ran with their result: by call id, where either side has it once; a call without id takes the
    result without id right behind it. ``calls(capture_id, pos, call_id, name)``, ``results(capture_id, pos, call_id, result)``."""
    once = lambda df: df.withColumn("_n", F.count("*").over(Window.partitionBy("capture_id", "call_id"))).where("_n = 1").drop("_n")
    named = once(calls.where("call_id IS NOT NULL")).join(once(results.where("call_id IS NOT NULL")).select("capture_id", "call_id", "result"), ["capture_id", "call_id"], "left")
    next_to = results.where("call_id IS NULL").select("capture_id", (F.col("pos") - 1).alias("pos"), "result")
    unnamed = calls.where("call_id IS NULL").join(next_to, ["capture_id", "pos"], "left")
    twice = calls.where("call_id IS NOT NULL").join(named.select("capture_id", "call_id"), ["capture_id", "call_id"], "left_anti").withColumn("result", F.lit(None).cast("string"))
    return named.select("capture_id", "pos", "call_id", "name", "result").unionByName(unnamed.select("capture_id", "pos", "call_id", "name", "result")).unionByName(twice.select("capture_id", "pos", "call_id", "name", "result"))
