"""Personal data in whole texts, by DataFrame functions alone.

Regular expressions propose spans, validators (value ranges, digit counts,
Luhn, mod 97) confirm them, and words next to a span raise its score. Spans
are code points, end exclusive. Patterns are possessive where a choice can't
matter, so long runs neither recurse nor go back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters before and after a span in which context words count, and what they add.
NEARBY, CONTEXT = 40, 30
# Score from which spans of the added kinds are reported; those of the base kinds always are.
LEAST_SCORE = 60
# Spans whose positions are summed in one go.
RUN = 256

OCTET = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
LOCAL = "[A-Za-z0-9._%+-]"


@dataclass(frozen=True)
class Kind:
    """How one kind is proposed, confirmed and scored.

    ``may`` is a cheap test that every text with a match passes. ``confirm``
    gets the match and the texts before and after it.
    """

    name: str
    may: str
    pattern: str
    confirm: Callable[[Column, Column, Column], Column]
    score: int
    words: str
    base: bool = True


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    backwards = F.reverse(digits)

    def value(i: Column) -> Column:
        d = F.substring(backwards, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(places, F.lit(0), lambda acc, i: acc + value(i)) % 10 == 0


def mod_97(match: Column) -> Column:
    """Whether an account number, its first four characters moved to the end, leaves 1 modulo 97."""
    bare = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substr(bare, F.lit(5)), F.left(bare, F.lit(4)))

    def add(acc: Column, i: Column) -> Column:
        c = F.substring(turned, i, F.lit(1))
        letter = F.ascii(c) - 55
        return F.when(c.rlike("[0-9]"), acc * 10 + c.cast("int")).otherwise(acc * 100 + letter) % 97

    places = F.sequence(F.lit(1), F.length(turned))
    return F.aggregate(places, F.lit(0), add) == 1


def _card(match: Column, before: Column, after: Column) -> Column:
    digits = digits_of(match)
    return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))


def _apart(before: Column, after: Column, inner: str) -> Column:
    """No character of the class ``inner`` touches the span."""
    return ~(F.right(before, F.lit(1)).rlike(inner) | F.left(after, F.lit(1)).rlike(inner))


def _iban(match: Column, before: Column, after: Column) -> Column:
    return F.when(_apart(before, after, "[A-Za-z0-9]"), mod_97(match)).otherwise(F.lit(False))


def _ssn(match: Column, before: Column, after: Column) -> Column:
    return _apart(before, after, "[0-9-]") & ~match.rlike("^(000|666|9)|-00-|-0000$")


KINDS = (
    Kind(
        "email", "@",
        rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m, b, a: F.lit(True), 70, "mail|contact|write",
    ),
    Kind(
        "ip", r"[0-9]\.[0-9]",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
        lambda m, b, a: m.rlike(rf"^{OCTET}(\.{OCTET}){{3}}$"), 60, "address|host|server|ip",
    ),
    # Runs of fewer than 16 digits can't pass, so they are not even extracted.
    Kind(
        "card", "[0-9][0-9 -]{14}", r"[0-9](?:[\x20-]?+[0-9]){15,}+",
        _card, 70, "card|visa|credit|pay",
    ),
    Kind(
        "phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda m, b, a: F.length(digits_of(m)).between(8, 15), 60, "call|phone|tel|mobile",
    ),
    Kind(
        "iban", "[A-Z]{2}[0-9]{2}", "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
        _iban, 70, "iban|account|bank", base=False,
    ),
    Kind(
        "ssn", "[0-9]-[0-9]{2}-[0-9]", "[0-9]{3}-[0-9]{2}-[0-9]{4}",
        _ssn, 40, "ssn|social|security", base=False,
    ),
)


def running_totals(lengths: Column) -> Column:
    """Per entry the sum of those before it; entries are taken in runs, so that long arrays stay cheap."""
    runs = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / RUN).cast("int")),
        lambda i: F.slice(lengths, i * RUN + 1, F.lit(RUN)),
    )
    empty = F.array().cast("array<int>")

    def scan(values: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), empty.alias("seen"))
        return F.aggregate(
            values, start,
            lambda acc, v: F.struct(
                (acc["sum"] + v).alias("sum"), F.concat(acc["seen"], F.array(acc["sum"])).alias("seen")
            ),
        )

    sums = F.transform(runs, lambda r: F.aggregate(r, F.lit(0), lambda a, v: a + v))
    starts = scan(sums)["seen"]
    parts = F.zip_with(runs, starts, lambda r, s: F.transform(scan(r)["seen"], lambda v: v + s))
    return F.when(F.size(lengths) > 0, F.flatten(parts)).otherwise(empty)


def find_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds an array ``<kind>_spans`` of (kind, start, end, score) for each kind, in order of start.

    A null text is empty and has none. Matches are leftmost and do not
    overlap within their kind; one that fails its check is dropped without a
    second try. The score is in hundredths. Columns named ``_t``, ``_m_*``,
    ``_g_*`` and ``_s_*`` are used in between.
    """
    none = F.array().cast("array<string>")
    out = df.withColumn("_t", F.coalesce(F.col(text), F.lit("")))
    names = {}
    for kind in KINDS:
        may = F.contains(F.col("_t"), F.lit("@")) if kind.may == "@" else F.col("_t").rlike(kind.may)
        names[f"_m_{kind.name}"] = F.when(may, F.regexp_extract_all("_t", F.lit(kind.pattern), F.lit(0))).otherwise(none)
    out = out.withColumns(names)
    gaps = {
        f"_g_{k.name}": F.when(F.size(f"_m_{k.name}") > 0, F.split("_t", k.pattern, -1)).otherwise(none) for k in KINDS
    }
    out = out.withColumns(gaps)
    steps = {
        f"_s_{k.name}": running_totals(
            F.zip_with(
                F.slice(f"_g_{k.name}", 1, F.size(f"_m_{k.name}")), f"_m_{k.name}",
                lambda g, m: F.length(g) + F.length(m),
            )
        )
        for k in KINDS
    }
    out = out.withColumns(steps)
    return out.withColumns({f"{k.name}_spans": _spans(k) for k in KINDS}).drop("_t", *names, *gaps, *steps)


def context_words(kind: Kind) -> str:
    """The kind's context words as whole words, in a pattern that both dialects read alike."""
    return f"(?i)(?:^|[^a-z])(?:{kind.words})(?:[^a-z]|$)"


def _spans(kind: Kind) -> Column:
    matches, gaps, starts = (F.col(f"{c}_{kind.name}") for c in ("_m", "_g", "_s"))

    def span(match: Column, i: Column) -> Column:
        before, after = gaps[i], gaps[i + 1]
        start = starts[i] + F.length(before)
        near = F.concat(F.right(before, F.lit(NEARBY)), F.lit("\n"), F.left(after, F.lit(NEARBY)))
        score = F.lit(kind.score) + F.when(near.rlike(context_words(kind)), CONTEXT).otherwise(0)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            start.alias("start"),
            (start + F.length(match)).alias("end"),
            F.when(kind.confirm(match, before, after), score).otherwise(0).alias("score"),
        )

    least = 1 if kind.base else LEAST_SCORE
    return F.filter(F.transform(matches, span), lambda s: s["score"] >= least)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, hash of the base spans, and all spans with their scores.

    Null and repeated ids keep their rows; other columns are ignored; an empty
    table gives an empty result.
    """
    found = find_spans(docs.select("doc_id", "text"))
    base = F.concat(*[f"{k.name}_spans" for k in KINDS if k.base])
    every = F.concat(*[f"{k.name}_spans" for k in KINDS])
    return found.select(
        "doc_id",
        *[F.size(f"{k.name}_spans").cast("long").alias(f"n_{k.name}") for k in KINDS if k.base],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(every).alias("spans"),
        F.array_join(F.transform(every, lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, such as ``[EMAIL]``.

    Overlapping spans are replaced together by the kind of the first. Texts
    without spans, null ones too, stay as they are.
    """
    columns = docs.columns
    found = find_spans(docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in columns])).select("_row", F.col(f"`{text}`").alias("text")))
    spans = F.array_sort(
        F.transform(
            F.concat(*[f"{k.name}_spans" for k in KINDS]), lambda s: F.struct(s["start"], s["end"], s["kind"])
        )
    )
    found = found.select("_row", "text", spans.alias("_spans"))
    nothing = F.array().cast("array<struct<start:int,end:int,kind:string>>")

    def merge(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(F.struct(last["start"], F.greatest(last["end"], s["end"]).alias("end"), last["kind"])),
        )
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] > s["start"]), joined).otherwise(
            F.concat(acc, F.array(s))
        )

    found = found.withColumn(
        "_merged", F.when(F.size("_spans") > 0, F.aggregate("_spans", nothing, merge)).otherwise(nothing)
    )
    whole, merged = F.col("text"), F.col("_merged")

    def piece(s: Column, i: Column) -> Column:
        begin = F.when(i == 0, 0).otherwise(F.try_element_at(merged, F.greatest(i, F.lit(1)))["end"])
        return F.concat(
            F.substring(whole, begin + 1, s["start"] - begin), F.lit("["), F.upper(s["kind"]), F.lit("]")
        )

    tail = F.substr(whole, F.element_at(merged, -1)["end"] + 1)
    masked = F.concat(F.array_join(F.transform(merged, piece), ""), tail)
    out = F.when(F.size(merged) > 0, masked).otherwise(whole)
    return found.select(
        *[out.alias(c) if c == text else F.col("_row")[c].alias(c) for c in columns]
    )


# Patterns as above, in the plainer dialect of the check: no possessive forms, no look-behind.
SQL_PATTERNS = {
    "email": rf"{LOCAL}+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9]){15,}",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
    "ssn": "[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
SQL_LUHN = (
    "list_sum([CASE WHEN i % 2 = 0 THEN (CASE WHEN 2 * v > 9 THEN 2 * v - 9 ELSE 2 * v END) ELSE v END "
    "FOR v, i IN [CAST(c AS INT) FOR c IN string_split(reverse(digits), '')]]) % 10 = 0"
)
SQL_CONFIRM = {
    "email": "true",
    "ip": rf"regexp_full_match(s, '{OCTET}(\.{OCTET}){{3}}')",
    "card": f"CASE WHEN length(digits) BETWEEN 16 AND 19 THEN {SQL_LUHN} ELSE false END",
    "phone": "length(digits) BETWEEN 8 AND 15",
    "iban": (
        "CASE WHEN regexp_matches(right(bef, 1), '[A-Za-z0-9]') OR regexp_matches(left(aft, 1), '[A-Za-z0-9]') "
        "THEN false ELSE CAST(array_to_string([CASE WHEN regexp_matches(c, '[0-9]') THEN c "
        "ELSE CAST(ascii(c) - 55 AS VARCHAR) END FOR c IN "
        "string_split(substr(replace(s, ' ', ''), 5) || left(replace(s, ' ', ''), 4), '')], '') AS HUGEINT) % 97 = 1 END"
    ),
    "ssn": (
        "NOT (regexp_matches(right(bef, 1), '[0-9-]') OR regexp_matches(left(aft, 1), '[0-9-]')) "
        "AND NOT regexp_matches(s, '^(000|666|9)|-00-|-0000$')"
    ),
}


def digest_sql() -> str:
    """The same digest in the dialect of the check."""
    per_kind = " UNION ALL ".join(
        f"SELECT rid, {i} AS k, '{kind.name}' AS kind, i, m[i] AS s, g[i] AS bef, g[i + 1] AS aft FROM ("
        f"SELECT rid, m, g, generate_subscripts(m, 1) AS i FROM (SELECT rid, "
        f"regexp_extract_all(t, '{SQL_PATTERNS[kind.name]}', 0) AS m, "
        f"string_split_regex(t, '{SQL_PATTERNS[kind.name]}') AS g FROM d))"
        for i, kind in enumerate(KINDS)
    )
    confirmed = " ".join(f"WHEN '{k.name}' THEN {SQL_CONFIRM[k.name]}" for k in KINDS)
    scores = " ".join(
        f"WHEN '{k.name}' THEN {k.score} + CASE WHEN regexp_matches(near, '{context_words(k)}') THEN {CONTEXT} ELSE 0 END"
        for k in KINDS
    )
    base = ", ".join(f"'{k.name}'" for k in KINDS if k.base)
    counts = ", ".join(
        f"CAST(count(*) FILTER (WHERE kind = '{k.name}') AS BIGINT) AS n_{k.name}" for k in KINDS if k.base
    )
    zeros = ", ".join(f"coalesce(n_{k.name}, 0) AS n_{k.name}" for k in KINDS if k.base)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({per_kind}),
p AS (SELECT *, CAST(sum(length(bef) + length(s)) OVER (PARTITION BY rid, k ORDER BY i) AS BIGINT) AS stop,
  regexp_replace(s, '[^0-9]', '', 'g') AS digits,
  right(bef, {NEARBY}) || chr(10) || left(aft, {NEARBY}) AS near FROM m),
c AS (SELECT rid, k, kind, stop - length(s) AS start, stop, CASE kind {scores} END AS score
  FROM p WHERE CASE kind {confirmed} END),
r AS (SELECT * FROM c WHERE kind IN ({base}) OR score >= {LEAST_SCORE}),
a AS (SELECT rid, {counts},
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY k, start) FILTER (WHERE kind IN ({base})) AS b,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY k, start) AS spans,
  string_agg(CAST(score AS VARCHAR), ',' ORDER BY k, start) AS scores FROM r GROUP BY rid)
SELECT doc_id, {zeros}, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(scores, '') AS scores FROM d LEFT JOIN a USING (rid)
"""
