"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust their score.

Built-in expressions only, one pass over the table, no shuffle. Positions count code points from 0, ends are
exclusive. Patterns use possessive quantifiers and look-behinds so that a long run of letters or digits is scanned
once; they match what the plain forms in :data:`BASE_KINDS` match.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in the order in which spans with equal starts are listed.
BASE_KINDS = ["email", "ip", "card", "phone"]
EXTRA_KINDS = ["iban", "ssn"]
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
# A kind's pattern runs only where the text holds this.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
# Score of a confirmed span before its context is looked at.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "address|host|server",
    "card": "card|visa|credit|payment",
    "phone": "phone|call|tel|mobile",
    "iban": "iban|account|bank",
    "ssn": "ssn|social security|taxpayer",
}
CONTEXT_BONUS = 0.3
CONTEXT_BEFORE = 40
CONTEXT_AFTER = 20
# Spans of the extra kinds need this score; spans of the base kinds stay in any case.
LEAST_SCORE = 0.5

_BLOCK = 256
_PLACED = "array<struct<start:bigint,end:bigint,value:string>>"


def _luhn(digits: Column) -> Column:
    backwards = F.reverse(digits)

    def weighed(place: Column) -> Column:
        digit = F.substring(backwards, place, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when(place % 2 == 0, doubled).otherwise(digit)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), weighed), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _mod_97(value: Column) -> Column:
    """The ISO 7064 remainder of an account number: first four characters moved to the end, letters read as 10 to 35."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(rest: Column, place: Column) -> Column:
        code = F.ascii(F.substring(turned, place, F.lit(1)))
        return F.when(code < 65, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step)


def _confirmed(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, "[.]"), lambda part: part.cast("double") <= 255)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        return F.when(F.length(F.replace(value, F.lit(" "), F.lit(""))).between(15, 34), _mod_97(value) == 1).otherwise(False)
    if kind == "ssn":
        return ~value.rlike("^(000|666|9)") & ~value.rlike("-00-|-0000$")
    return F.lit(True)


def _placed(matches: Column, between: Column) -> Column:
    """Start, end and value of the matches, from the pieces of text between them.

    A running sum. Finished blocks are set aside, so that a text with very many matches copies a block, not all spans,
    for each of them. Both arrays are arguments, not references inside a lambda, which would be computed per element.
    """
    steps = F.slice(F.arrays_zip(matches.alias("value"), F.transform(between, F.length).alias("gap")), F.lit(1), F.size(matches))

    def one(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + F.length(x["value"])
        span = F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))
        full = F.size(state["open"]) >= _BLOCK
        return F.struct(
            end.alias("at"),
            F.when(full, F.concat(state["done"], F.array(state["open"]))).otherwise(state["done"]).alias("done"),
            F.when(full, span).otherwise(F.concat(state["open"], span)).alias("open"),
        ).cast(f"struct<at:bigint,done:array<{_PLACED}>,open:{_PLACED}>")

    begin = F.expr(f"cast(named_struct('at', 0L, 'done', array(), 'open', array()) as struct<at:bigint,done:array<{_PLACED}>,open:{_PLACED}>)")
    return F.aggregate(steps, begin, one, lambda state: F.flatten(F.concat(state["done"], F.array(state["open"]))))


def find_spans(docs: DataFrame, text_col: str = "text", spans_col: str = "pii") -> DataFrame:
    """``docs`` with an array of ``kind, start, end, score, value``, ordered by start, then by kind as listed.

    Matches of a kind are leftmost and do not overlap; those that fail their check are dropped and not retried. Spans
    of different kinds may overlap. Null and empty texts have an empty array; repeated rows are judged alike; other
    columns are passed on unchanged (one named like ``spans_col`` is replaced).
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    frame = docs.withColumn(spans_col, F.lit(None))
    for kind in [*BASE_KINDS, *EXTRA_KINDS]:
        there = text.contains(NEEDS[kind]) if kind in NEEDS else F.lit(True)
        if kind != "email":
            there = there & text.rlike("[0-9]")
        frame = frame.withColumn(f"__{kind}", F.when(there, F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))))
    found = []

    def scored(order: int, kind: str):
        def judged(span: Column) -> Column:
            first = F.greatest(span["start"] - CONTEXT_BEFORE, F.lit(0))
            around = F.lower(F.substring(text, (first + 1).cast("int"), (span["end"] + CONTEXT_AFTER - first).cast("int")))
            bonus = F.when(around.rlike(CONTEXT[kind]), CONTEXT_BONUS).otherwise(0.0)
            return F.struct(
                span["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), span["end"].alias("end"),
                F.least(F.lit(1.0), F.lit(SCORES[kind]) + bonus).alias("score"), span["value"].alias("value"),
            )

        return judged

    for order, kind in enumerate([*BASE_KINDS, *EXTRA_KINDS]):
        matches, check = F.col(f"__{kind}"), partial(_confirmed, kind)
        possible = F.exists(matches, lambda m: check(m))  # noqa: B023
        placed = _placed(matches, F.split(text, PATTERNS[kind], -1))
        spans = F.transform(F.filter(placed, lambda s: check(s["value"])), scored(order, kind))  # noqa: B023
        if kind in EXTRA_KINDS:
            spans = F.filter(spans, lambda s: s["score"] >= LEAST_SCORE)
        kinds = "array<struct<start:bigint,order:int,kind:string,end:bigint,score:double,value:string>>"
        found.append(F.when(possible, spans).otherwise(F.expr("array()")).cast(kinds))
    every = F.transform(
        F.array_sort(F.concat(*found)), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score"), s["value"].alias("value"))
    )
    return frame.withColumn(spans_col, every).drop(*[f"__{kind}" for kind in [*BASE_KINDS, *EXTRA_KINDS]])


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, number of spans of each base kind, SHA-256 of the base spans' list, and the list of all spans."""
    spans = F.col("pii")
    counts = [F.size(F.filter(spans["kind"], partial(F.equal_null, F.lit(kind)))).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    base = F.filter(spans, lambda s: s["kind"].isin(BASE_KINDS))
    return find_spans(docs.select(id_col, text_col), text_col).select(
        id_col, *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(spans).alias("spans")
    )


def mask(docs: DataFrame, text_col: str = "text", count_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets, and ``count_col`` recounted if there is one.

    Where spans of several kinds overlap, the stretch they cover together gets the kind of the first. A null text
    stays null, and texts without a span stay as they are.
    """
    text = F.col(text_col)
    spans = F.col("__pii")
    piece = "struct<at:bigint,kind:string,out:array<string>>"

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        new = F.struct(s["end"].alias("at"), s["kind"].alias("kind"), F.concat(state["out"], F.array(gap, F.concat(F.lit("<"), s["kind"], F.lit(">")))).alias("out"))
        wider = F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["kind"].alias("kind"), state["out"].alias("out"))
        return F.when(s["start"] >= state["at"], new.cast(piece)).otherwise(wider.cast(piece))

    begin = F.expr(f"cast(named_struct('at', 0L, 'kind', '', 'out', array('')) as {piece})")
    masked = F.aggregate(
        spans, begin, step,
        lambda state: F.concat(F.array_join(state["out"], ""), F.substring(text, (state["at"] + 1).cast("int"), F.length(text))),
    )
    found = find_spans(docs, text_col, "__pii").withColumn(text_col, F.when(F.size(spans) > 0, masked).otherwise(text)).drop("__pii")
    if count_col and count_col in docs.columns:
        found = found.withColumn(count_col, F.when(F.col(text_col).isNotNull(), F.length(text_col)).cast(docs.schema[count_col].dataType))
    return found.select(*docs.columns)
