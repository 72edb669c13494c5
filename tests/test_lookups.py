"""Tables that find near terms and patterns: same rows as a scan of the dictionary, without one."""

import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.analysis import analyze_standard
from shelfmark.functions.distance import deletions, deletions_of
from shelfmark.operators import build, terms
from shelfmark.operators.build import field_values
from shelfmark.operators.predicates import P, near_terms
from shelfmark.plans import corpora
from shelfmark.sources import store


def distance(a, b):
    """Edits between two words, a swap of neighbours being one, no part edited twice."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def words(seed, n):
    rng = random.Random(seed)
    made = {"".join(rng.choice("abcé\U0001f600") for _ in range(rng.randrange(1, 14))) for _ in range(n)}
    return sorted(made | {"a", "ab", "abcabcabcabcab" * 5, "x y", "*", "a?b"})


def docs(spark, texts, start=0):
    rows = [("i", start + n, f"/f{start + n}", t) for n, t in enumerate(texts)]
    return spark.createDataFrame(rows, "index_name string, doc_id long, _src string, word string")


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """An index of a build and a batch that takes words away and adds some, with lookup tables."""
    path = str(tmp_path_factory.mktemp("lookups"))
    old, new = words(1, 400), words(2, 300)
    first = docs(spark, old)
    store.write_index(spark, path, first.drop("word"), field_values(first, [], ["word"]), F.lit("d"))
    store.add_lookups(spark, path)
    second = docs(spark, new, 10_000)
    touched = first.where("doc_id % 3 = 0").select("index_name", "_src").unionByName(second.select("index_name", "_src"))
    store.append_batch(spark, path, "b", touched, second.drop("word"), field_values(second, [], ["word"]), F.lit("d"))
    live = {w for n, w in enumerate(old) if n % 3} | set(new)
    return store.read_index(spark, path), sorted(live), path


def test_deletions_of_a_column_and_of_a_word(spark):
    rows = docs(spark, [*words(3, 50), ""]).select("word", deletions(F.col("word")).alias("d")).collect()
    assert all(sorted(r["d"]) == deletions_of(r["word"]) for r in rows)
    near = [(a, b) for a in words(3, 60) for b in words(4, 60) if distance(a, b) <= 2]
    assert near and all(set(deletions_of(a)) & set(deletions_of(b)) for a, b in near)


@pytest.mark.parametrize("word,edits", [("abca", 2), ("cab", 1), ("é\U0001f600abc", 2), ("abcabcabcabcab" * 5 + "x", 2), ("b", 2)])
def test_near_terms(written, word, edits):
    idx, live, path = written
    found = near_terms(idx, "word", word, edits)
    rows = sorted(r["term"] for r in found.where("doc_freq > 0").collect())
    assert rows == [w for w in live if distance(w, word) <= edits]
    assert f"{path}/dictionary" not in str(found.inputFiles()) and f"{path}/variants" in str(found.inputFiles())
    hits = [r["doc_id"] for r in P.fuzzy("word", word, edits).hits(idx).collect()]
    assert len(hits) == len(set(hits)) >= len(rows)


@pytest.mark.parametrize("pattern", ["*abc*", "*ca", "?b*c?", "*\U0001f600*é*", "*ab?ab*", "*a", "?", "*x y*", "*"])
def test_patterns(written, pattern):
    idx, live, path = written
    like = re.compile("".join({"?": ".", "*": ".*"}.get(c) or re.escape(c) for c in pattern), re.S)
    wanted = [w for w in live if like.fullmatch(w)]
    predicate = P.wildcard("word", pattern)
    hits = {r["doc_id"] for r in predicate.hits(idx).collect()}
    values = {r["value"] for r in idx.fields.where("field = 'word'").collect() if r["doc_id"] in hits}
    assert sorted(values) == wanted
    if build.pattern_grams(pattern):
        assert f"{path}/dictionary" not in str(predicate.terms(idx).inputFiles())


def test_similar_terms_count_once(written):
    idx, live, _ = written
    rows = terms.similar_terms(idx, "abc", "word", 1000).collect()
    assert sorted(r["term"] for r in rows) == [w for w in live if w.startswith("abc") or distance(w, "abc") <= 2]


def test_without_the_tables_the_dictionary_is_read(spark, tmp_path):
    rows = docs(spark, words(1, 50))
    store.write_index(spark, str(tmp_path), rows.drop("word"), field_values(rows, [], ["word"]), F.lit("d"))
    idx = store.read_index(spark, str(tmp_path))
    found = sorted(r["term"] for r in near_terms(idx, "word", "abca").collect())
    assert found == [w for w in words(1, 50) if distance(w, "abca") <= 2]


def test_lookups_are_written_when_first_asked_for(spark, tmp_path):
    rows = [(n, t, "en", "src1", len(t)) for n, t in enumerate(["a quick fox", "quack", "brown cow"])]
    texts = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    texts.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    idx = corpora.documents(spark, str(tmp_path))
    path = store.latest_build(spark, corpora.DOCUMENT_CORPUS.folder(spark, str(tmp_path)))
    made = lambda: {p.name for p in Path(path.removeprefix("file:")).iterdir()} & set(store.LOOKUPS)
    found = lambda i: sorted(r["term"] for r in near_terms(i, "fulltext", "quick").collect())
    assert found(idx) == ["quack", "quick"] and not made()
    assert found(corpora.documents(spark, str(tmp_path), lookups=True)) == ["quack", "quick"]
    assert made() == set(store.LOOKUPS)
    assert found(corpora.documents(spark, str(tmp_path))) == ["quack", "quick"]


def test_what_a_task_sorts_does_not_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(store, "ROWS_A_TASK", 50)
    rows = spark.range(1000).selectExpr("'i' index_name", "'f' field", "cast(id as string) term", "id doc_id", "0 ord")
    dealt = store._dealt(rows, "postings", 1000)
    assert dealt.rdd.getNumPartitions() == 20
    assert max(dealt.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 150


def test_texts_are_sorted_before_they_are_analyzed(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(store, "_write", lambda df, path, name, version, mode="overwrite": written.append((df, mode)))
    texts = docs(spark, words(5, 50)).withColumn("n", F.lit(1))
    store._write_fields(field_values(texts, ["word"], ["n"]), str(tmp_path), 0, analyze_standard)
    for df, _ in written:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("AS terms") < plan.index("Sort [")
    assert [mode for _, mode in written] == ["overwrite", "append"]
