"""Tokens, term vectors, distances and small text functions."""

import re
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.functions import analysis, text
from shelfmark.functions.distance import edit_distance, maybe_within

TEXTS = [
    "State of the art, state!", "", "the of and", "Ünïted  élan 42x", "de de de", None,
    "a\nb\tc-d's the end", "x" * 50 + " " + "y", "the the tail",
]


def expected_vector(value):
    found = defaultdict(list)
    words = [w for w in re.split(r"[^\w]+|_", value.lower()) if w]
    for i, word in enumerate(words):
        if word not in analysis.STOP_WORDS:
            found[word].append(i)
    return sorted(found.items())


def test_term_vectors(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t STRING")
    rows = df.select("t", analysis.term_vector(analysis.analyze_standard(F.col("t"))).alias("v")).collect()
    for row in rows:
        if row["t"] is None:
            assert not row["v"]
        else:
            assert [(v["term"], v["positions"]) for v in row["v"]] == expected_vector(row["t"])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab the,é1 \n", max_size=40), min_size=1, max_size=5))
def test_term_vectors_of_any_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    rows = df.select("t", analysis.term_vector(analysis.analyze_standard(F.col("t"))).alias("v")).collect()
    for row in rows:
        assert [(v["term"], v["positions"]) for v in row["v"]] == expected_vector(row["t"])


def test_query_slots_keep_gaps(spark):
    assert analysis.query_slots(spark, "The state of Art") == [("state", 0), ("art", 2)]
    assert analysis.query_slots(spark, "the of") == []


def brute_distance(a, b):
    """Optimal string alignment by plain recursion over a table."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            options = [d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1])]
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                options.append(d[i - 2, j - 2] + 1)
            d[i, j] = min(options)
    return d[len(a), len(b)]


def test_distances(spark):
    pairs = [("ca", "abc"), ("ab", "ba"), ("abcd", "badc"), ("", "ab"), ("same", "same"), ("über", "uber"),
             ("eriner", "erienr"), ("kitten", "sitting")]
    df = spark.createDataFrame(pairs, "a STRING, b STRING")
    rows = df.select("a", "b", edit_distance(F.col("a"), F.col("b")).alias("d"),
                     maybe_within(F.col("a"), F.col("b")).alias("m")).collect()
    for r in rows:
        assert r["d"] == brute_distance(r["a"], r["b"])
        assert r["m"] or r["d"] > 2
    assert {(r["a"], r["b"]): r["d"] for r in rows}[("ca", "abc")] == 3


def test_request_parsing():
    assert text.facet_pairs("lang:en,broken,a:b:c,x:y") == [("lang", "en"), ("x", "y")]
    assert text.facet_pairs(None) == []
    assert text.weights("a:2,b") == {"a": 2.0}
    try:
        text.weights("a:two")
    except ValueError as error:
        assert "weight" in str(error)
    else:
        raise AssertionError("a weight that is no number is an error in a request")
    assert text.names(" a, b ,,c") == ["a", "b", "c"]


def test_column_parsing(spark):
    df = spark.createDataFrame([("f:2.0,g:x,h,i:1,f:3",), ("",), ("a:b:c,d:",)], "t STRING")
    rows = df.select(text.parse_weights(F.col("t")).alias("w"), text.parse_facet_pairs(F.col("t")).alias("p")).collect()
    assert rows[0]["w"] == {"f": 3.0, "i": 1.0}
    assert [(p["field"], p["value"]) for p in rows[0]["p"]] == [("f", "2.0"), ("g", "x"), ("i", "1"), ("f", "3")]
    assert rows[1]["w"] == {} and rows[1]["p"] == []
    assert rows[2]["w"] == {} and rows[2]["p"] == []


def test_dates(spark):
    rows = [("date", "20240131"), ("date", "202401"), ("date", "2024"), ("date", "202401312359"),
            ("mydate", "20240131235958"), ("date", "20240131235958123"), ("date", "x"), ("name", "20240131")]
    df = spark.createDataFrame(rows, "f STRING, v STRING")
    got = df.select(text.date_iso(F.col("f"), F.col("v")).alias("s"), text.date_kind(F.col("f"), F.col("v")).alias("k")).collect()
    assert [(r["s"], r["k"]) for r in got] == [
        ("2024-01-31", "date"), ("2024-01", None), ("2024", None), ("2024-01-31T23:59:00Z", "datetime"),
        ("2024-01-31T23:59:58Z", "datetime"), ("2024-01-31T23:59:58Z", "datetime"), ("x", None), ("20240131", None),
    ]


def test_highlight_quotes_what_was_typed(spark):
    df = spark.createDataFrame([("C++ primer (c++)",), ("Élan vital",)], "t STRING")
    got = [r["h"] for r in df.select(text.highlight(F.col("t"), ["c++", "éla"]).alias("h")).collect()]
    assert got == ["<b>C++</b> primer (<b>c++</b>)", "<b>Éla</b>n vital"]
