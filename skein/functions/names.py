"""Column functions over names, paths, identities and instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SPAWN_NAMES = ("Agent", "spawn_agent")
NO_SESSION = "no_session_id"
NO_USER = "no_user_id"
REDACTED = ("<SENSITIVE>", "<REDACTED>", "[REDACTED]", "***")
ENDPOINTS = {"/responses": "responses", "/chat/completions": "chat_completions", "/messages/count_tokens": "count_tokens", "/messages": "messages"}


def is_spawn(name: Column) -> Column:
    """Whether a tool's full name means starting a sub-agent."""
    return F.coalesce(name.isin(*SPAWN_NAMES) | name.rlike(r"(?s)\A.+\.spawn_agent\z"), F.lit(False))


def qualified(namespace: Column, name: Column) -> Column:
    """``namespace.name``, unless either is missing or the name begins with it."""
    prefix = F.concat(namespace, F.lit("."))
    bare = namespace.isNull() | (namespace == "") | name.isNull() | (name == "")
    return F.when(bare, name).when(F.startswith(name, prefix), name).otherwise(F.concat(prefix, name))


def real_session(value: Column) -> Column:
    """A session id, or the empty string where it is missing or says so."""
    return F.coalesce(F.nullif(value, F.lit(NO_SESSION)), F.lit(""))


def is_redacted(value: Column) -> Column:
    return F.coalesce(F.upper(F.trim(value)).isin(*REDACTED), F.lit(False))


def is_safe_session(value: Column) -> Column:
    """Whether a session id can stand in a file name."""
    return F.coalesce(value.rlike(r"\A[A-Za-z0-9][A-Za-z0-9._-]{0,199}\z"), F.lit(False))


def first_real(*values: Column) -> Column:
    """The first value that is neither null nor empty; else empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def conflicting(*values: Column) -> Column:
    """Whether the values that are neither null nor empty differ."""
    real = F.filter(F.array(*values), lambda v: v.isNotNull() & (v != ""))
    return F.size(F.array_distinct(real)) > 1


def unwrapped_user(value: Column) -> Column:
    """A user id, taken out of the JSON object that may hold it."""
    inner = F.coalesce(*[F.nullif(F.get_json_object(value, f"$.{k}"), F.lit("")) for k in ("user_id", "userId", "id")])
    return F.when(F.trim(value).startswith("{"), F.coalesce(inner, F.lit(""))).otherwise(F.coalesce(value, F.lit("")))


def thread_of(explicit: Column, linked: Column, path: Column, session: Column) -> Column:
    """The thread a capture states, else one of its own if it is linked to a parent, else its session."""
    return F.when(F.coalesce(explicit, F.lit("")) != "", explicit).when(linked, F.concat(F.lit("__isolated_subagent__:"), path)).otherwise(F.coalesce(session, F.lit("")))


def operation(path: Column) -> Column:
    """What an endpoint's path asks for; null for any other path."""
    plain = F.regexp_replace(F.split(path, r"\?")[0], "/+$", "")
    out = F.lit(None).cast("string")
    for end, name in ENDPOINTS.items():
        out = F.coalesce(out, F.when(F.endswith(plain, F.lit(end)), F.lit(name)))
    return out


def iso_millis(value: Column) -> Column:
    """Milliseconds since 1970 as an ISO instant with milliseconds, in UTC."""
    return F.date_format(F.timestamp_millis(value), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def eight_hours(captured_at: Column) -> Column:
    """Start of the eight-hour block of the day at UTC+8 that holds an ISO instant with an offset; else empty."""
    known = captured_at.rlike(r"\A\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})\z")
    at = F.when(known, F.try_to_timestamp(captured_at))
    # blocks of eight hours at UTC+8 begin at multiples of eight hours since 1970
    seconds = F.floor(F.unix_timestamp(at) / 28800) * 28800
    return F.coalesce(F.concat(F.date_format(F.timestamp_seconds(seconds + 28800), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00")), F.lit(""))


def parent_path(agent: Column) -> Column:
    return F.regexp_extract(agent, r"(?s)\A(.*)/[^/]*\z", 1)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)([^/]*)\z", 1)


def source_file(ref: Column) -> Column:
    """A source's base name without its line mark."""
    return F.regexp_replace(base_name(ref), r"#L[0-9]+\z", "")


def line_number(ref: Column) -> Column:
    """The line that a source reference marks, else 0."""
    return F.coalesce(F.nullif(F.regexp_extract(ref, r"#L([0-9]+)\z", 1), F.lit("")).cast("long"), F.lit(0))


def trajectory_file(session: Column, number: Column, identifier: Column) -> Column:
    """The file of a trajectory: of its session and number, or of its hash where it has no session."""
    real = real_session(session)
    return F.when((real != "") & is_safe_session(real), F.concat_ws("_sub_", real, number.cast("string"))).otherwise(F.concat(F.lit("no_session_id_"), identifier, F.lit("_sub_0")))


def error_summary(status: Column, kind: Column, code: Column) -> Column:
    """``HTTP n (type=..; code=..)`` of the parts that are short plain words."""
    safe = lambda v, name: F.when(v.rlike(r"\A[A-Za-z0-9_.-]{1,80}\z"), F.concat(F.lit(name + "="), v))
    parts = F.concat_ws("; ", safe(kind, "type"), safe(code, "code"))
    return F.concat(F.lit("HTTP "), status.cast("string"), F.when(parts != "", F.concat(F.lit(" ("), parts, F.lit(")"))).otherwise(F.lit("")))
