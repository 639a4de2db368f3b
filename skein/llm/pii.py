"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust their score.

Everything is one projection of the document rows: no shuffle, no Python, nothing sent between rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns, table

#: Code points on either side of a span in which context words count.
WINDOW = 40
#: Spans of a kind are summed up in runs of this many.
RUN = 512


@dataclass(frozen=True)
class Kind:
    """A kind of personal data. ``pattern`` finds what ``plain`` finds, leftmost and without overlap, but in linear
    time and without recursion: its loops are possessive where nothing after them could use a shorter match."""

    name: str
    plain: str
    pattern: str
    hint: str  # what a text with such a span contains, as a regular expression
    score: int
    boost: int
    context: str  # words nearby that add ``boost``
    least: int  # score from which a span counts
    base: bool = True


#: A value of 16 characters or more behind the name of a secret, and keys known by their shape.
SECRET = r"(?i:token|secret|passwd|password|api[_-]?key|access[_-]?key)[\x22\x27]?\x20?[:=]\x20?[\x22\x27]?[A-Za-z0-9_+/=.-]{16,}|\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,})"
# Characters of an IBAN by country.
IBAN = dict((x[:2], int(x[2:])) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 "
    "HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 "
    "QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
).split())

KINDS = (
    Kind("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 80, 15, "mail|contact|write|reach", 0),
    Kind("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 55, 35, "ip|address|host|server|login", 0),
    Kind("card", r"[0-9]([\x20-]?[0-9])+", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]", 80, 15, "card|visa|master|amex|credit|payment", 0),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 60, 30, "phone|tel|call|mobile|fax", 0),
    Kind("iban", r"[A-Z]{2}[0-9]{2}( ?[A-Z0-9]{4}){2,7}( ?[A-Z0-9]{1,3})?", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?", "[A-Z]{2}[0-9]{2}", 85, 10, "iban|bank|account|konto|compte", 0, False),
    Kind("secret", SECRET, SECRET, "(?i)token|secret|passw|key|AKIA|gh[pousr]_|sk-|xox", 80, 10, "secret|credential|login|auth", 0, False),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "[0-9]{3}-", 40, 45, "ssn|social|security", 60, False),
)
CERTAIN = 80


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _mod97(x: Column) -> Column:
    """Remainder of an IBAN with its first four characters moved to the end and letters read as 10 to 35."""
    plain = F.replace(x, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    value = lambda c: F.ascii(c) - F.when(c >= "A", 55).otherwise(48)
    step = lambda acc, c: F.when(c >= "A", (acc * 100 + value(c)) % 97).otherwise((acc * 10 + value(c)) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(step(acc, c)))


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return m.rlike(rf"^{part}(\.{part}){{3}}$")
    if kind == "card":
        return F.length(_digits(m)).between(13, 19) & F.call_function("luhn_check", _digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        return m.isNotNull() & (_mod97(m) == 1)
    return F.lit(True)


def _ended(kind: str, m: Column) -> Column:
    """What of a match belongs to the span: an IBAN ends with the length that its country gives it; null if it is shorter."""
    if kind != "iban":
        return m
    size = F.try_element_at(F.create_map(*[F.lit(x) for pair in IBAN.items() for x in pair]), F.left(m, F.lit(2)))
    held = lambda k: F.length(F.replace(F.left(m, k), F.lit(" "), F.lit("")))
    return F.left(m, F.get(F.filter(F.sequence(F.lit(1), F.length(m)), lambda k: held(k) == size), F.lit(0)))


def _running(steps: Column) -> Column:
    """Sums of all prefixes of an array, in runs, so that no array is copied once for each element."""
    zero = F.lit(0)
    run = lambda c: F.aggregate(
        F.slice(steps, c * RUN + 1, F.lit(RUN)),
        F.array(F.aggregate(F.slice(steps, F.lit(1), c * RUN), zero, lambda a, x: a + x)),
        lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)),
    )
    return F.flatten(F.transform(F.sequence(zero, F.floor((F.size(steps) - 1) / RUN).cast("int")), lambda c: F.slice(run(c), 2, RUN)))


def find_pii(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, text, findings)``, one row for each row.

    ``findings`` is an array of ``(kind, start, end, score)`` in code points, end exclusive, by kind in the order of
    ``KINDS``, then start. A kind's matches are leftmost and do not overlap; those that fail their checksum or
    limits are dropped without a retry; an IBAN ends with its country's length. The score, out of 100, is that of the kind plus its boost where one of its
    context words stands within 40 code points; kinds with a least score drop spans below it. Null text counts as
    empty; null ids and repeated rows pass through.
    """
    out = columns(docs, doc_id="long", text="string").withColumn("t", F.coalesce("text", F.lit("")))
    none = F.array().cast("array<string>")
    out = out.select("*", *[F.when(F.col("t").rlike(k.hint), F.regexp_extract_all("t", F.lit(k.pattern), F.lit(0))).otherwise(none).alias(f"m_{k.name}") for k in KINDS])
    out = out.select("*", *[F.when(F.size(f"m_{k.name}") > 0, F.split("t", k.pattern, -1)).otherwise(none).alias(f"g_{k.name}") for k in KINDS])
    steps = lambda k: F.transform(F.col(f"m_{k.name}"), lambda m, i: F.length(m) + F.length(F.get(F.col(f"g_{k.name}"), i)))
    out = out.select("*", *[F.when(F.size(f"m_{k.name}") > 0, _running(steps(k))).otherwise(F.array().cast("array<int>")).alias(f"e_{k.name}") for k in KINDS])

    def spans(k: Kind) -> Column:
        gaps = F.col(f"g_{k.name}")

        def span(m: Column, i: Column) -> Column:
            end = F.get(F.col(f"e_{k.name}"), i)
            near = F.lower(F.concat(F.right(F.get(gaps, i), F.lit(WINDOW)), F.lit("\n"), F.left(F.get(gaps, i + 1), F.lit(WINDOW))))
            score = F.lit(k.score) + F.when(near.rlike(k.context), k.boost).otherwise(0)
            own = _ended(k.name, m)
            return F.struct(F.lit(k.name).alias("kind"), (end - F.length(m)).alias("start"), (end - F.length(m) + F.length(own)).alias("end"), score.alias("score"), own.alias("m"))

        kept = F.filter(F.transform(F.col(f"m_{k.name}"), span), lambda s: _valid(k.name, s["m"]) & (s["score"] >= k.least))
        return F.transform(kept, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")))

    return out.select("doc_id", "text", F.concat(*[spans(k) for k in KINDS]).alias("findings"))


def redact(found: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of :func:`find_pii` with every span replaced by ``<KIND>``; where spans meet, the one that starts first, then the longest."""
    order = F.array_sort(F.transform("findings", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        cut = F.concat(acc["text"], F.substr(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        return F.when(s["start"] >= acc["at"], F.struct(cut.alias("text"), (-s["end"]).alias("at"))).otherwise(acc)

    text = F.aggregate(order, start, step, lambda acc: F.concat(acc["text"], F.substr(F.col("text"), acc["at"] + 1)))
    return found.select("doc_id", F.when(F.size("findings") > 0, text).otherwise(F.col("text")).alias("text"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("findings", lambda s: s["kind"].isin(*[k.name for k in KINDS if k.base]))
    count = lambda test: F.size(F.filter("findings", test)).cast("long")
    of = lambda name: count(lambda s: s["kind"] == name)
    return found.select(
        "doc_id",
        *[of(k.name).alias(f"n_{k.name}") for k in KINDS],
        F.sha2(said(base), 256).alias("base_sha256"),
        said(F.col("findings")).alias("spans"),
        count(lambda s: s["score"] >= CERTAIN).alias("n_certain"),
    )


def _oracle() -> str:
    valid = {
        "ip": "len(list_filter(string_split(m, '.'), lambda p: len(ltrim(p, '0')) > 3 OR coalesce(try_cast(right('0' || p, 3) AS INTEGER), 0) > 255)) = 0",
        "card": "len(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, len(regexp_replace(m, '[^0-9]', '', 'g')) + 1), lambda i: CASE WHEN i % 2 = 1 THEN reverse(regexp_replace(m, '[^0-9]', '', 'g'))[i]::INTEGER ELSE (2 * reverse(regexp_replace(m, '[^0-9]', '', 'g'))[i]::INTEGER) // 10 + (2 * reverse(regexp_replace(m, '[^0-9]', '', 'g'))[i]::INTEGER) % 10 END)) % 10 = 0",
        "phone": "len(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 9 AND 15",
        "iban": "m IS NOT NULL AND list_reduce(list_prepend(0, list_transform(string_split(replace(m, ' ', '')[5:] || replace(m, ' ', '')[1:4], ''), lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE ascii(c) - 48 END)), lambda a, x: CASE WHEN x >= 10 THEN (a * 100 + x) % 97 ELSE (a * 10 + x) % 97 END) = 1",
    }
    sizes = ", ".join(f"'{c}': {n}" for c, n in IBAN.items())
    ended = {"iban": f"left(whole, list_filter(range(1, len(whole) + 1), lambda k: len(replace(left(whole, k), ' ', '')) = (MAP {{{sizes}}})[left(whole, 2)])[1]::BIGINT)"}
    parts = []
    for rank, k in enumerate(KINDS):
        parts.append(f"""
SELECT doc_id, {rank} AS rank, '{k.name}' AS kind, e - len(whole) AS s, e - len(whole) + len(m) AS e, {k.score} + CASE WHEN regexp_matches(lower(right(g0, {WINDOW}) || chr(10) || left(g1, {WINDOW})), '{k.context}') THEN {k.boost} ELSE 0 END AS score, {k.least} AS least
FROM (SELECT doc_id, whole, {ended.get(k.name, "whole")} AS m, g0, g1, sum(len(g0) + len(whole)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM (
  SELECT doc_id, unnest(ms) AS whole, unnest(gs[1:len(ms)]) AS g0, unnest(gs[2:len(ms) + 1]) AS g1, unnest(range(len(ms))) AS i FROM (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{k.plain}') AS ms, string_split_regex(coalesce(text, ''), '{k.plain}') AS gs FROM documents)))
WHERE {valid.get(k.name, "true")}""")
    counts = ", ".join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in KINDS)
    base = ", ".join(f"'{k.name}'" for k in KINDS if k.base)
    return f"""
WITH found AS (SELECT * FROM ({" UNION ALL ".join(parts)}) WHERE score >= least)
SELECT doc_id, {counts},
  sha256(coalesce(string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY rank, s) FILTER (kind IN ({base})), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY rank, s), '') AS spans,
  count(*) FILTER (score >= {CERTAIN}) AS n_certain
FROM documents LEFT JOIN found USING (doc_id) GROUP BY doc_id
"""


ORACLE = {"op1_pii": _oracle()}
