"""Searches: which documents, in which order, which page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.analysis import Analyzer, analyze_standard
from shelfmark.functions.text import facet_pairs
from shelfmark.operators.build import IndexTables
from shelfmark.operators.predicates import P, Predicate, clauses
from shelfmark.operators.scoring import HIT, SCORE_DECIMALS

PAGE_SIZE = 100
NUMERIC = ("int", "long", "float", "double")


def find(idx: IndexTables, predicate: Predicate) -> DataFrame:
    """All matching documents with rounded scores."""
    return predicate.hits(idx).select(
        *HIT, F.round("score", SCORE_DECIMALS).alias("score")
    )


def sort_order(
    hits: DataFrame, idx: IndexTables, sort: str | None = None, sort_type: str = "score"
) -> tuple[DataFrame, list[Column]]:
    """Hits with what they are sorted by, and the order. Ties go by index and document.

    ``-`` before the field reverses, except for the score and document orders.
    """
    kind = sort_type.lower() if sort else "score"
    if kind == "document":
        return hits, [F.col(c) for c in HIT]
    if kind not in (*NUMERIC, "string", "set"):
        return hits, [F.desc("score"), *HIT]
    reverse = sort.startswith("-")
    name = sort.removeprefix("-")
    value = F.col("value").try_cast(kind) if kind in NUMERIC else F.col("value")
    # Only values of documents hit are kept, so that hits are what is built and shuffled.
    keys = idx.fields.where(F.col("field") == name).select(*HIT, value.alias("sort_value"))
    keys = keys.join(hits.select(*HIT), HIT, "left_semi")
    if idx.is_repeated(name):
        keys = keys.groupBy(*HIT).agg(F.min("sort_value").alias("sort_value"))
    joined = hits.join(keys, HIT, "left")
    if kind in NUMERIC:
        joined = joined.withColumn("sort_value", F.coalesce("sort_value", F.lit(0).cast(kind)))
    order = F.desc_nulls_last("sort_value") if reverse else F.asc_nulls_first("sort_value")
    return joined, [order, *[F.col(c) for c in HIT]]


def paging(
    hits: DataFrame, order: list[Column], page: int = 1, results: int = PAGE_SIZE
) -> DataFrame:
    """One page with ``rank``, counted from the first page. Only the page itself is numbered."""
    if page < 1 or results < 1:
        raise ValueError("page and results start at 1")
    skipped = (page - 1) * results
    best = hits.orderBy(*order).offset(skipped).limit(results)
    rank = F.row_number().over(Window.orderBy(*order)) + skipped
    return best.withColumn("rank", rank)


def hits_to_documents(page: DataFrame, docs: DataFrame) -> DataFrame:
    """Stored columns of the documents hit. A page is sent to every task if its bytes allow."""
    return docs.join(page, HIT)


def after_hit(hits: DataFrame, score: float, index_name: str, doc_id: object) -> DataFrame:
    """Hits that come after a known one in the order of scores.

    The page after the last hit of a page costs as little as the first page, however deep it lies.
    """
    later = (F.col("index_name") > index_name) | (
        (F.col("index_name") == index_name) & (F.col("doc_id") > F.lit(doc_id))
    )
    return hits.where((F.col("score") < score) | ((F.col("score") == score) & later))


def search(
    idx: IndexTables,
    predicate: Predicate,
    page: int = 1,
    results: int = PAGE_SIZE,
    sort: str | None = None,
    sort_type: str = "score",
) -> DataFrame:
    hits, order = sort_order(find(idx, predicate), idx, sort, sort_type)
    return paging(hits, order, page, results)


def term_search(
    idx: IndexTables,
    field: str = "",
    term: str = "",
    page: int = 1,
    results: int = PAGE_SIZE,
) -> DataFrame:
    """Documents whose field holds exactly this term; with neither field nor term, all."""
    if bool(field) != bool(term):
        raise ValueError(f"missing parameter: {'term' if field else 'field'}")
    return search(idx, P.term(field, term) if field else P.everything(), page, results)


def basic_predicate(
    idx: IndexTables,
    term: str | None,
    field: str = "fulltext",
    with_: str | None = None,
    analyzer: Analyzer = analyze_standard,
) -> Predicate | None:
    """A phrase if the catalog says the field is tokenized, else the raw text as one term.

    Facet filters narrow the result and leave scores alone. No term gives no search at all.
    """
    if term is None:
        return None
    main = P.text(idx, field, term, analyzer) if field in idx.tokenized else P.term(field, term)
    filters = [P.term(f, v) for f, v in facet_pairs(with_)]
    return P.bool(must=[main], filters=filters) if filters else main


def basic_search(
    idx: IndexTables,
    term: str | None,
    field: str = "fulltext",
    with_: str | None = None,
    sort: str | None = None,
    sort_type: str = "score",
    page: int = 1,
    results: int = PAGE_SIZE,
    analyzer: Analyzer = analyze_standard,
) -> DataFrame:
    predicate = basic_predicate(idx, term, field, with_, analyzer)
    if predicate is None:
        predicate = P.none()
    return search(idx, predicate, page, results, sort, sort_type)


def predicate_search(
    idx: IndexTables,
    predicate: str,
    tokenize: bool = True,
    page: int = 1,
    analyzer: Analyzer = analyze_standard,
) -> DataFrame:
    return search(idx, clauses(idx, predicate, tokenize, analyzer=analyzer), page)


def prefix_search(docs: DataFrame, column: str, prefix: str) -> DataFrame:
    """Documents whose stored column starts with a value; the prefix is pushed to the scan."""
    return docs.where(F.col(column).startswith(prefix))
