"""Predicates: small records that give the matching documents as (index_name, doc_id, score).

Every clause gives a document once. A combination tags the rows of its clauses and groups them by
document a single time, whatever the mix of required, optional and forbidden clauses.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.analysis import Analyzer, analyze_standard, query_slots
from shelfmark.functions.distance import MAX_EDITS, deletions_of, edit_distance, maybe_within
from shelfmark.functions.text import java_quote
from shelfmark.operators.build import IndexTables, pattern_grams
from shelfmark.operators.scoring import HIT, bm25, score_hits, score_stats, term_rows


# Clauses a column of bits can tell apart.
BITS = 62


class Predicate:
    """A condition on documents."""

    def hits(self, idx: IndexTables, scored: bool = True) -> DataFrame:
        """Each matching document once. Unscored hits have score 0 and read no statistics."""
        raise NotImplementedError


def _constant(rows: DataFrame, unique: bool) -> DataFrame:
    """Conditions covering many terms rank nothing: every hit scores 1."""
    found = rows.select(*HIT) if unique else rows.select(*HIT).distinct()
    return found.withColumn("score", F.lit(1.0))


@dataclass(frozen=True)
class Everything(Predicate):
    def hits(self, idx: IndexTables, scored: bool = True) -> DataFrame:
        return _constant(idx.docs, unique=True)


@dataclass(frozen=True)
class Nothing(Predicate):
    def hits(self, idx: IndexTables, scored: bool = True) -> DataFrame:
        return _constant(idx.docs.where(F.lit(False)), unique=True)


@dataclass(frozen=True)
class Term(Predicate):
    """Exactly this term; the text is not analyzed."""

    field: str
    term: str

    def hits(self, idx: IndexTables, scored: bool = True) -> DataFrame:
        pairs = [(self.field, self.term)]
        rows = term_rows(idx, pairs)
        if not scored:
            return rows.select(*HIT, F.lit(0.0).alias("score"))
        return score_hits(rows, score_stats(idx, pairs)).select(*HIT, "score")


def _moved_back(positions: str, slot: int) -> Column:
    return F.transform(positions, lambda p: p - F.lit(slot))


@dataclass(frozen=True)
class Phrase(Predicate):
    """Terms at consecutive positions, removed words leaving gaps."""

    field: str
    slots: tuple[tuple[str, int], ...]

    def counts(self, idx: IndexTables) -> DataFrame:
        """Occurrences of the phrase: (index_name, doc_id, field, tf, length).

        One shuffle whatever the number of words: the position lists of a document meet in one row,
        each is moved back by its slot, and the starts common to all are the occurrences.
        """
        terms = sorted({term for term, _ in self.slots})
        hit = [*HIT, "field"]
        value = [*hit, "ord"] if idx.is_repeated(self.field) else hit
        rows = idx.postings.where(
            (F.col("field") == self.field) & F.col("term").isin(terms)
        ).select(*value, "term", "length", "positions")
        lists = [
            F.max(F.when(F.col("term") == term, F.col("positions"))).alias(f"p{i}")
            for i, term in enumerate(terms)
        ]
        met = rows.groupBy(*value).agg(F.max("length").alias("length"), *lists)
        starts = [_moved_back(f"p{terms.index(term)}", slot) for term, slot in self.slots]
        found = met.where(
            reduce(lambda a, b: a & b, [F.col(f"p{i}").isNotNull() for i in range(len(terms))])
        ).select(
            *value, "length", F.size(reduce(F.array_intersect, starts)).alias("tf")
        ).where("tf > 0")
        if value != hit:
            found = found.groupBy(*hit).agg(
                F.max("length").alias("length"), F.sum("tf").alias("tf")
            )
        return found

    def hits(self, idx: IndexTables, scored: bool = True) -> DataFrame:
        if not scored:
            return self.counts(idx).select(*HIT, F.lit(0.0).alias("score"))
        pairs = [(self.field, term) for term, _ in self.slots]
        # A word used twice counts twice.
        uses = F.create_map(
            *[
                F.lit(x)
                for term in {t for t, _ in self.slots}
                for x in (term, float(sum(t == term for t, _ in self.slots)))
            ]
        )
        stats = (
            score_stats(idx, pairs)
            .groupBy("field")
            .agg(
                F.sum(F.col("idf") * uses[F.col("term")]).alias("idf"),
                F.max("avg_len").alias("avg_len"),
            )
        )
        return (
            self.counts(idx)
            .join(F.broadcast(stats), "field")
            .select(
                *HIT,
                bm25(F.col("idf"), F.col("tf"), F.col("length"), F.col("avg_len")).alias("score"),
            )
        )


@dataclass(frozen=True)
class TermsWhere(Predicate):
    """Any term of the field meeting a condition, read straight from the sorted postings."""

    field: str
    condition: Column
    unique: bool = False

    def hits(self, idx: IndexTables, scored: bool = True) -> DataFrame:
        rows = idx.postings.where((F.col("field") == self.field) & self.condition)
        return _constant(rows, unique=False)


@dataclass(frozen=True)
class Fuzzy(Predicate):
    """Any term near the given one. Distances are computed per distinct term, not per posting."""

    field: str
    term: str
    edits: int = MAX_EDITS

    def hits(self, idx: IndexTables, scored: bool = True) -> DataFrame:
        near = near_terms(idx, self.field, self.term, self.edits).select("term").distinct()
        rows = idx.postings.where(F.col("field") == self.field).select(*HIT, "term")
        # The near terms are a slice of the dictionary; adaptive execution sends them to every task
        # where their size allows.
        return _constant(rows.join(near, "term", "left_semi"), unique=False)


def near_terms(
    idx: IndexTables, fields: str | Sequence[str], term: str, edits: int = MAX_EDITS
) -> DataFrame:
    """Rows (index_name, field, term, doc_freq) of terms within ``edits`` of the term.

    Up to two edits the terms that share a deletion are looked up; only these are compared.
    """
    here = F.col("field").isin([fields] if isinstance(fields, str) else list(fields))
    near = maybe_within(F.col("term"), F.lit(term), edits)
    if edits <= MAX_EDITS:
        keys = ["index_name", "field", "term"]
        rows = idx.variants.where(here & F.col("variant").isin(deletions_of(term)) & near)
        # A batch holds differences; all variants of a term that meet add up to the same number.
        summed = rows.groupBy(*keys, "variant").agg(F.sum("doc_freq").alias("doc_freq"))
        candidates = summed.groupBy(*keys).agg(F.max("doc_freq").alias("doc_freq"))
    else:
        candidates = idx.dictionary.where(here & near)
    return candidates.where(edit_distance(F.col("term"), F.lit(term)) <= edits)


@dataclass(frozen=True)
class TermsLike(Predicate):
    """Any term of a ``?``/``*`` pattern, found by the grams that all such terms have."""

    field: str
    grams: tuple[str, ...]
    condition: Column

    def terms(self, idx: IndexTables) -> DataFrame:
        rows = idx.grams.where((F.col("field") == self.field) & F.col("gram").isin(list(self.grams)))
        met = rows.groupBy("index_name", "term").agg(F.count_distinct("gram").alias("n"))
        return met.where((F.col("n") == len(self.grams)) & self.condition).select("index_name", "term")

    def hits(self, idx: IndexTables, scored: bool = True) -> DataFrame:
        rows = idx.postings.where(F.col("field") == self.field).select(*HIT, "term")
        return _constant(rows.join(self.terms(idx), ["index_name", "term"], "left_semi"), unique=False)


@dataclass(frozen=True)
class Boost(Predicate):
    """Changes the weight of a clause, not what it matches."""

    inner: Predicate
    weight: float

    def hits(self, idx: IndexTables, scored: bool = True) -> DataFrame:
        return self.inner.hits(idx, scored).withColumn(
            "score", F.col("score") * F.lit(self.weight)
        )


@dataclass(frozen=True)
class Not(Predicate):
    """Forbidden clauses; they need another clause to take documents from."""

    inner: tuple[Predicate, ...]

    def hits(self, idx: IndexTables, scored: bool = True) -> DataFrame:
        return Nothing().hits(idx)


@dataclass(frozen=True)
class Combined(Predicate):
    must: tuple[Predicate, ...] = ()
    should: tuple[Predicate, ...] = ()
    must_not: tuple[Predicate, ...] = ()
    filters: tuple[Predicate, ...] = ()

    def hits(self, idx: IndexTables, scored: bool = True) -> DataFrame:
        if not self.must and not self.should and not self.filters:
            return Nothing().hits(idx)
        # All optional clauses share one place and all forbidden ones another; a required clause has
        # its own, which a term given twice shares. Places beyond a column of bits go to the next.
        terms: dict[tuple[str, str], list[tuple[int, float]]] = {}
        others: list[tuple[Predicate, int, float]] = []
        required: dict[object, int] = {}
        for role in ("must", "filters", "should", "must_not"):
            for given in getattr(self, role):
                clause, weight = given, 1.0 if scored and role in ("must", "should") else 0.0
                while isinstance(clause, Boost):
                    clause, weight = clause.inner, weight * clause.weight
                single = isinstance(clause, Term)
                key = (clause.field, clause.term) if single else len(required)
                if role in ("must", "filters"):
                    place = required.setdefault(key, len(required) + 2)
                else:
                    place = 0 if role == "should" else 1
                if single:
                    terms.setdefault(key, []).append((place, weight))
                else:
                    others.append((clause, place, weight))
        columns = (len(required) + 1) // BITS + 1
        tagged = [
            clause.hits(idx, scored=weight != 0).select(
                *HIT,
                *[b.alias(f"bits{n}") for n, b in enumerate(_bit_columns([place], columns))],
                (F.col("score") * weight).alias("score"),
            )
            for clause, place, weight in others
        ]
        if terms:
            tagged.insert(0, _tagged_terms(idx, terms, columns))
        forbidden = F.col("seen0").bitwiseAND(F.lit(2)) != 0
        if required:
            keep = ~forbidden
            for n, wanted in enumerate(_bit_columns(list(required.values()), columns)):
                keep = keep & (F.col(f"seen{n}").bitwiseAND(wanted) == wanted)
        else:
            keep = ~forbidden & (F.col("seen0").bitwiseAND(F.lit(1)) != 0)
        return (
            reduce(DataFrame.unionByName, tagged)
            .groupBy(*HIT)
            .agg(
                *[F.bit_or(f"bits{n}").alias(f"seen{n}") for n in range(columns)],
                F.sum("score").alias("score"),
            )
            .where(keep)
            .select(*HIT, "score")
        )


def _bit_columns(places: Sequence[int], columns: int) -> list[Column]:
    """The places as bits, one number per column of bits."""
    masks = [0] * columns
    for place in places:
        masks[place // BITS] |= 1 << place % BITS
    return [F.lit(mask).cast("long") for mask in masks]


def _tagged_terms(
    idx: IndexTables, terms: dict[tuple[str, str], list[tuple[int, float]]], columns: int
) -> DataFrame:
    """All single-term clauses in one scan: each row with the clauses it meets and its score."""
    pairs = list(terms)
    rows = term_rows(idx, pairs)
    if any(weight for uses in terms.values() for _, weight in uses):
        scored = score_hits(rows, score_stats(idx, pairs))
    else:
        scored = rows.withColumn("score", F.lit(0.0))
    # One flat choice per column, however many terms there are.
    chosen = [F] * (columns + 1)
    for (name, term), uses in terms.items():
        here = (F.col("field") == name) & (F.col("term") == term)
        values = [*_bit_columns([place for place, _ in uses], columns), F.lit(sum(w for _, w in uses))]
        chosen = [so_far.when(here, value) for so_far, value in zip(chosen, values, strict=True)]
    *met, weight = chosen
    return scored.select(
        *HIT,
        *[m.otherwise(F.lit(0).cast("long")).alias(f"bits{n}") for n, m in enumerate(met)],
        (F.col("score") * weight.otherwise(F.lit(0.0))).alias("score"),
    )


class P:
    """Builder of predicates."""

    @staticmethod
    def everything() -> Predicate:
        return Everything()

    @staticmethod
    def term(field: str, term: str) -> Predicate:
        return Term(field, term)

    @staticmethod
    def text(idx: IndexTables, field: str, text: str, analyzer: Analyzer = analyze_standard) -> Predicate:
        """Analyzed text: one word matches as a term, several as a phrase, none matches nothing."""
        slots = query_slots(idx.docs.sparkSession, text, analyzer)
        if not slots:
            return Nothing()
        if len(slots) == 1:
            return Term(field, slots[0][0])
        return Phrase(field, tuple(slots))

    @staticmethod
    def wildcard(field: str, pattern: str) -> Predicate:
        """``?`` is one character, ``*`` any number. A fixed beginning is pushed to the scan of the
        postings; without one, terms are found by their grams."""
        fixed = re.match(r"[^?*]*", pattern).group(0)
        parts = [
            {"?": ".", "*": ".*"}.get(c) or java_quote(c) for c in pattern
        ]
        condition = F.col("term").rlike("^(?s:" + "".join(parts) + ")$")
        if fixed:
            condition = F.col("term").startswith(fixed) & condition
        elif grams := pattern_grams(pattern):
            return TermsLike(field, tuple(grams), condition)
        return TermsWhere(field, condition)

    @staticmethod
    def prefix(field: str, prefix: str) -> Predicate:
        return TermsWhere(field, F.col("term").startswith(prefix))

    @staticmethod
    def range(
        field: str,
        low: str | None,
        high: str | None,
        include_low: bool = True,
        include_high: bool = True,
    ) -> Predicate:
        """Terms between two bounds in string order; a null bound is open."""
        term = F.col("term")
        condition = F.lit(True)
        if low is not None:
            condition = condition & (term >= low if include_low else term > low)
        if high is not None:
            condition = condition & (term <= high if include_high else term < high)
        return TermsWhere(field, condition)

    @staticmethod
    def fuzzy(field: str, term: str, edits: int = MAX_EDITS) -> Predicate:
        return Fuzzy(field, term, edits)

    @staticmethod
    def boost(inner: Predicate, weight: float) -> Predicate:
        return Boost(inner, weight)

    @staticmethod
    def all(*clauses: Predicate) -> Predicate:
        """Every clause must hold; ``P.none`` among them forbids."""
        forbidden = tuple(p for c in clauses if isinstance(c, Not) for p in c.inner)
        return Combined(
            must=tuple(c for c in clauses if not isinstance(c, Not)), must_not=forbidden
        )

    @staticmethod
    def any(*clauses: Predicate) -> Predicate:
        """At least one clause must hold."""
        forbidden = tuple(p for c in clauses if isinstance(c, Not) for p in c.inner)
        return Combined(
            should=tuple(c for c in clauses if not isinstance(c, Not)), must_not=forbidden
        )

    @staticmethod
    def none(*clauses: Predicate) -> Predicate:
        return Not(tuple(clauses))

    @staticmethod
    def bool(
        must: Sequence[Predicate] = (),
        should: Sequence[Predicate] = (),
        must_not: Sequence[Predicate] = (),
        filters: Sequence[Predicate] = (),
    ) -> Predicate:
        return Combined(tuple(must), tuple(should), tuple(must_not), tuple(filters))


def clauses(
    idx: IndexTables,
    predicate: str,
    tokenize: bool = True,
    default_field: str | None = None,
    analyzer: Analyzer = analyze_standard,
) -> Predicate:
    """``field:value`` clauses separated by blanks, any of which may match.

    With ``tokenize`` every part needs a ``:`` unless there is a default field. Without it the
    whole text is one clause whose value is taken as it is.
    """
    text = predicate.strip()
    parts = text.split() if tokenize else [text]
    if not text or (default_field is None and not all(":" in part for part in parts)):
        raise ValueError(f"invalid parameter: predicate {predicate!r}")
    made = []
    for part in parts:
        name, _, value = part.partition(":") if ":" in part else (default_field, ":", part)
        made.append(P.text(idx, name, value, analyzer) if tokenize else P.term(name, value))
    return made[0] if len(made) == 1 else P.any(*made)


def condition(
    idx: IndexTables, text: str | None, analyzer: Analyzer = analyze_standard
) -> Predicate | None:
    """A base condition with default field ``type``; empty text means no condition."""
    if not (text or "").strip():
        return None
    return clauses(idx, text, default_field="type", analyzer=analyzer)
