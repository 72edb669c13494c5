"""Small text functions shared by reports, previews and requests."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date forms found in index fields and how each is shown.
DATE_FORMS = (
    (r"^(\d{4})$", "$1"),
    (r"^(\d{4})(\d{2})$", "$1-$2"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3T$4:$5:00Z"),
    (r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})(?:\d{3})?$", "$1-$2-$3T$4:$5:$6Z"),
)
PREVIEW_CHARS = 100
# As XML's grammar has them: ``<?xml … ?>``; ``<!DOCTYPE name external-id [ subset ] >``.
XML_DECLARATION = r"<\?xml\b[^?]*\?>"
DOCTYPE = r"<!DOCTYPE\s[^\[>]*(?:\[[^\]]*\]\s*)?>"


def _date_shape(value: Column) -> Column:
    return value.rlike(r"^\d{4}(\d{2}(\d{2}(\d{4}(\d{2}(\d{3})?)?)?)?)?$")


def date_iso(field: Column, value: Column) -> Column:
    """ISO text of compact dates in fields whose name contains ``date``; other values unchanged."""
    shown = value
    for pattern, form in DATE_FORMS:
        shown = F.when(value.rlike(pattern), F.regexp_replace(value, pattern, form)).otherwise(shown)
    return F.when(field.contains("date") & _date_shape(value), shown).otherwise(value)


def date_kind(field: Column, value: Column) -> Column:
    """``date`` for a full day, ``datetime`` for anything finer, else null."""
    dated = field.contains("date") & _date_shape(value)
    return F.when(dated & (F.length(value) == 8), F.lit("date")).when(
        dated & (F.length(value) > 8), F.lit("datetime")
    )


def truncate_text(value: Column, size: int = PREVIEW_CHARS) -> Column:
    return F.struct(
        F.substring(value, 1, size).alias("text"), (F.length(value) > size).alias("truncated")
    )


def strip_xml_prolog(xml: Column) -> Column:
    """Remove XML and document type declarations, an internal subset (``[…]``) included."""
    return F.regexp_replace(xml, XML_DECLARATION + "|" + DOCTYPE, "")


def _pairs(text: Column) -> Column:
    # Trailing empty parts do not count: "a:" has one part, "a:b:" has two.
    split = F.transform(
        F.split(text, ","), lambda part: F.split(F.regexp_replace(part, ":+$", ""), ":")
    )
    return F.filter(split, lambda part: F.size(part) == 2)


def parse_facet_pairs(text: Column) -> Column:
    """``f:v,g:w`` as an array of (field, value); malformed parts are left out."""
    return F.transform(
        _pairs(text), lambda p: F.struct(p[0].alias("field"), p[1].alias("value"))
    )


def parse_weights(text: Column) -> Column:
    """``f:2.0,g:0.5`` as map<string, float>; parts that are no pair or no number are left out.

    When a field is named twice the last weight wins.
    """
    pairs = F.filter(_pairs(text), lambda p: p[1].try_cast("float").isNotNull())
    entries = F.transform(
        pairs, lambda p: F.struct(p[0].alias("key"), p[1].cast("float").alias("value"))
    )
    last = F.filter(
        entries,
        lambda e, i: ~F.exists(
            F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1))),
            lambda later: later["key"] == e["key"],
        ),
    )
    return F.map_from_entries(last)


def weights(text: str | dict[str, float] | None) -> dict[str, float]:
    """Weights of a request. A weight that is not a number is an error here."""
    if not text or isinstance(text, dict):
        return dict(text or {})
    found: dict[str, float] = {}
    for part in text.split(","):
        pair = part.rstrip(":").split(":")
        if len(pair) == 2:
            try:
                found[pair[0]] = float(pair[1])
            except ValueError:
                raise ValueError(f"invalid parameter: weight {part!r}") from None
    return found


def facet_pairs(text: str | None) -> list[tuple[str, str]]:
    """Facet filters of a request; malformed pairs are left out."""
    pairs = [part.rstrip(":").split(":") for part in (text or "").split(",")]
    return [(p[0], p[1]) for p in pairs if len(p) == 2]


def names(text: str | list[str] | tuple[str, ...] | None) -> list[str]:
    """A comma-separated list, trimmed, without empty parts."""
    parts = text.split(",") if isinstance(text, str) else (text or [])
    return [part.strip() for part in parts if part.strip()]


def java_quote(text: str) -> str:
    """The text as a literal regular expression."""
    return re.sub(r"([^\w\s])", r"\\\1", text)


def highlight(text: Column, typed: list[str]) -> Column:
    """Wrap what was typed in ``<b>…</b>`` where it begins a word, any letter case."""
    if not typed:
        return text
    # Longest first, so that of two words typed the longer one is marked.
    options = "|".join(java_quote(w) for w in sorted(set(typed), key=lambda w: (-len(w), w)))
    return F.regexp_replace(
        text, rf"(?iu)(^|[^\p{{L}}\p{{N}}])({options})", "$1<b>$2</b>"
    )
