"""Rules of requests, and search results against brute force on a small corpus."""

import math

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.analysis import STOP_WORDS
from shelfmark.operators import facets, search, suggest, terms
from shelfmark.operators.build import field_values
from shelfmark.operators.predicates import P, clauses, condition
from shelfmark.sources import store

TEXTS = {
    1: "the quick brown fox", 2: "quick quick fox jumps", 3: "lazy dog of the north",
    4: "a dog and a fox", 5: "state of the art", 6: "state art", 7: "the",
}
COLORS = {1: "red", 2: "blue", 3: "red", 4: None, 5: "green", 6: "red", 7: "blue"}


@pytest.fixture(scope="module")
def idx(spark, tmp_path_factory):
    rows = [(f"i{k % 2}", k, TEXTS[k], COLORS[k], k * 10) for k in TEXTS]
    df = spark.createDataFrame(rows, "index_name STRING, doc_id BIGINT, fulltext STRING, color STRING, size INT")
    docs = df.select("index_name", "doc_id", F.concat(F.lit("/d/"), "doc_id").alias("_path"))
    values = field_values(df, ["fulltext"], ["color", "size"])
    path = str(tmp_path_factory.mktemp("search"))
    return store.write_index(spark, path, docs, values, F.lit("d")).select("i0,i1")


def ids(df):
    return [r["doc_id"] for r in df.orderBy("rank").collect()]


def brute_scores(term):
    kept = {k: [w for w in t.split() if w not in STOP_WORDS] for k, t in TEXTS.items()}
    kept = {k: w for k, w in kept.items() if w}
    n, avg = len(kept), sum(map(len, kept.values())) / len(kept)
    df = sum(term in w for w in kept.values())
    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
    return {
        k: round(idf * w.count(term) * 2.2 / (w.count(term) + 1.2 * (0.25 + 0.75 * len(w) / avg)), 4)
        for k, w in kept.items()
        if term in w
    }


@pytest.mark.parametrize("term", ["fox", "quick", "dog", "state"])
def test_scores(idx, term):
    got = {r["doc_id"]: r["score"] for r in search.find(idx, P.term("fulltext", term)).collect()}
    assert got == brute_scores(term)


def test_term_is_not_analyzed(idx):
    assert ids(search.term_search(idx, "fulltext", "Fox")) == []
    assert sorted(ids(search.basic_search(idx, "Fox"))) == [1, 2, 4]


def test_term_search_needs_both_or_none(idx):
    with pytest.raises(ValueError, match="term"):
        search.term_search(idx, field="fulltext")
    with pytest.raises(ValueError, match="field"):
        search.term_search(idx, term="fox")
    assert len(ids(search.term_search(idx))) == len(TEXTS)


def test_phrase_keeps_gaps_of_stop_words(idx):
    assert ids(search.basic_search(idx, "state of the art")) == [5]
    assert ids(search.basic_search(idx, "state art")) == [6]
    assert ids(search.basic_search(idx, "state and or art")) == [5]
    assert ids(search.basic_search(idx, "the of")) == []
    assert ids(search.basic_search(idx, "quick quick")) == [2]


def test_no_term_no_result(idx):
    assert ids(search.basic_search(idx, None)) == []


def test_unknown_field_is_exact(idx):
    assert ids(search.basic_search(idx, "x y", field="nowhere")) == []
    assert sorted(ids(search.basic_search(idx, "red", field="color"))) == [1, 3, 6]


def test_facet_filters(idx):
    assert ids(search.basic_search(idx, "fox", with_="color:red")) == [1]
    assert ids(search.basic_search(idx, "fox", with_="color:red,color:blue")) == []
    assert sorted(ids(search.basic_search(idx, "fox", with_="junk,a:b:c"))) == [1, 2, 4]
    scores = lambda df: {r["doc_id"]: r["score"] for r in df.collect()}
    assert scores(search.basic_search(idx, "fox", with_="color:red"))[1] == scores(search.basic_search(idx, "fox"))[1]


def test_missing_values_in_sorts(idx):
    everything = lambda **k: ids(search.search(idx, P.everything(), **k))
    assert everything(sort="color", sort_type="string")[0] == 4
    assert everything(sort="-color", sort_type="string")[-1] == 4
    assert everything(sort="-size", sort_type="int") == [7, 6, 5, 4, 3, 2, 1]
    assert everything(sort="nowhere", sort_type="double") == everything(sort="x", sort_type="document")


def test_pages_follow_each_other(idx):
    pages = [ids(search.search(idx, P.everything(), page=p, results=3)) for p in (1, 2, 3, 4)]
    assert [len(p) for p in pages] == [3, 3, 1, 0]
    assert sorted(sum(pages, [])) == sorted(TEXTS)
    ranks = [r["rank"] for r in search.search(idx, P.everything(), page=2, results=3).collect()]
    assert sorted(ranks) == [4, 5, 6]


def test_next_page_after_a_hit(idx):
    hits = search.find(idx, P.any(P.term("fulltext", "fox"), P.term("color", "red")))
    order = search.sort_order(hits, idx)[1]
    every = search.paging(hits, order).orderBy("rank").collect()
    for i, hit in enumerate(every):
        rest = search.after_hit(hits, hit["score"], hit["index_name"], hit["doc_id"])
        assert ids(search.paging(rest, order)) == [r["doc_id"] for r in every[i + 1:]]


def test_unscored_hits_are_the_same_documents(idx):
    for predicate in (
        P.term("fulltext", "fox"),
        P.text(idx, "fulltext", "quick fox"),
        P.all(P.any(P.boost(P.term("fulltext", "fox"), 2.0), P.prefix("fulltext", "d")), P.none(P.term("color", "red"))),
    ):
        plain = predicate.hits(idx, scored=False).collect()
        assert sorted(r["doc_id"] for r in plain) == matched(idx, predicate)


def test_predicates_need_fields(idx):
    for bad in ("", "fox", "fulltext:fox dog"):
        with pytest.raises(ValueError, match="predicate"):
            search.predicate_search(idx, bad)
    assert sorted(ids(search.predicate_search(idx, "fulltext:Fox color:green"))) == [1, 2, 4, 5]
    assert ids(search.predicate_search(idx, "fulltext:quick brown", tokenize=False)) == []
    assert ids(search.predicate_search(idx, "color:green", tokenize=False)) == [5]


def matched(idx, predicate):
    return sorted(r["doc_id"] for r in search.find(idx, predicate).collect())


def test_boolean_combinations(idx):
    fox, dog, red = P.term("fulltext", "fox"), P.term("fulltext", "dog"), P.term("color", "red")
    assert matched(idx, P.all(fox, red)) == [1]
    assert matched(idx, P.any(fox, dog)) == [1, 2, 3, 4]
    assert matched(idx, P.all(P.any(fox, dog), P.none(red))) == [2, 4]
    assert matched(idx, P.any(P.none(red))) == []
    assert matched(idx, P.bool(must=[fox], should=[red])) == [1, 2, 4]
    assert matched(idx, P.all(P.everything(), P.none(fox, dog))) == [5, 6, 7]
    twice = {r["doc_id"]: r["score"] for r in search.find(idx, P.any(fox, fox)).collect()}
    once = {r["doc_id"]: r["score"] for r in search.find(idx, fox).collect()}
    assert all(abs(twice[k] - 2 * once[k]) < 2e-4 for k in once)


def test_term_patterns(idx):
    assert matched(idx, P.wildcard("fulltext", "?o*")) == [1, 2, 3, 4]
    assert matched(idx, P.wildcard("fulltext", "q*k")) == [1, 2]
    assert matched(idx, P.range("fulltext", "dog", "fox", True, False)) == [3, 4]
    assert matched(idx, P.range("fulltext", "dog", "fox", False, True)) == [1, 2, 4]
    assert matched(idx, P.range("color", None, "green")) == [2, 5, 7]
    assert matched(idx, P.fuzzy("fulltext", "qiuck", 1)) == [1, 2]
    assert set(matched(idx, P.term("fulltext", "fox"))) <= set(matched(idx, P.fuzzy("fulltext", "fox")))
    assert matched(idx, P.prefix("fulltext", "sta")) == [5, 6]


def test_unknown_indexes_give_nothing(idx):
    assert ids(search.term_search(idx.select("nowhere"))) == []
    assert ids(search.term_search(idx.select(None))) == []
    assert sorted(ids(search.term_search(idx.select(" i1 ,nowhere")))) == [1, 3, 5, 7]


def test_counts_over_indexes_add_up(idx):
    def counts(i):
        return {r["term"]: r["doc_freq"] for r in terms.index_terms(i, "fulltext").collect()}

    one, two, both = counts(idx.select("i0")), counts(idx.select("i1")), counts(idx)
    assert both == {t: one.get(t, 0) + two.get(t, 0) for t in {*one, *two}}


def test_facet_rules(idx):
    rows = facets.facets(idx, None).collect()
    assert rows == []
    color = {r["value"]: r["count"] for r in facets.facets(idx, "color").collect()}
    assert color == {"red": 3, "blue": 2, "green": 1}
    # Without a cap the counts of a field with one value per document add up to its documents.
    assert sum(color.values()) == sum(c is not None for c in COLORS.values())
    fields = {r["field"] for r in facets.facets(idx, None, base=P.term("fulltext", "fox")).collect()}
    assert fields == {"color", "size"}
    capped = facets.facets(idx, "color,size", 2).collect()
    assert sorted(r["field"] for r in capped) == ["color"] * 2 + ["size"] * 2
    assert condition(idx, "  ") is None
    assert matched(idx, clauses(idx, "fox", default_field="fulltext")) == [1, 2, 4]


def test_result_suggestions(idx):
    got = suggest.result_suggestions(idx, "  qui  la", "fulltext", "color:red")
    assert sorted(ids(got)) == [1, 3]
    assert ids(suggest.result_suggestions(idx, "   ", "fulltext")) == []


def test_suggestions_start_at_two_letters(idx):
    assert suggest.suggest(idx, "q", "fulltext").count() == 0
    texts = [r["text"] for r in suggest.suggest(idx, "fo qu", "fulltext").collect()]
    assert sorted(texts) == sorted([TEXTS[1], TEXTS[2]])
    assert [r["text"] for r in suggest.suggest(idx, "QU", "fulltext", use_terms=True).collect()] == ["quick"]


def test_any_number_of_clauses(idx):
    fox, red = P.term("fulltext", "fox"), P.term("color", "red")
    nowhere = [P.term("fulltext", f"none{n}") for n in range(200)]
    found = lambda p: sorted(r["doc_id"] for r in search.find(idx, p).collect())
    assert found(P.any(*nowhere, fox)) == [1, 2, 4]
    assert found(P.bool(must=[fox], must_not=[*nowhere, red])) == [2, 4]
    assert found(P.bool(must=[fox] * 70, filters=[red] * 70)) == [1]
    assert found(P.bool(must=[fox, *nowhere[:100]])) == []
    wide = [P.prefix("fulltext", "fo") for _ in range(3)]
    assert found(P.bool(must=[fox, *wide], filters=[P.term("fulltext", "fox")])) == [1, 2, 4]
