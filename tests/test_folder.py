"""A folder of files, indexed, changed and indexed again."""

import os

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import search
from shelfmark.operators.definitions import IndexDefinition
from shelfmark.operators.predicates import P
from shelfmark.sources import folder, store

BOOKS = IndexDefinition("books", "book-{name}", "/books/{name}")


def write(root, name, *titles, age=0):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    documents = "".join(f"<document><field name='title'>{t}</field></document>" for t in titles)
    with open(path, "w") as out:
        out.write(f"<?xml version='1.0'?><documents>{documents}</documents>")
    os.utime(path, (1_700_000_000 + age, 1_700_000_000 + age))


def actions(diff, root):
    return {
        r["_src"].removeprefix(root + "/"): r["action"] for r in diff.where("action <> 'ignore'").collect()
    }


def found(spark, path, word):
    idx = store.read_index(spark, path).select("book-a,book-b")
    hits = search.find(idx, P.term("title", word)).select("index_name", "doc_id")
    return sorted((r["index_name"], os.path.basename(r["doc_id"])) for r in hits.collect())


@pytest.fixture()
def places(tmp_path):
    root, path = str(tmp_path / "content"), str(tmp_path / "index")
    write(root, "books/a/one.psml", "red fish", "blue fish")
    write(root, "books/b/two.psml", "red bird")
    write(root, "books/b/skip.txt", "red text")
    write(root, "elsewhere/three.psml", "red herring")
    return root, path


def test_index_folder(spark, places):
    root, path = places
    first = actions(folder.index_folder(spark, path, f"file://{root}", BOOKS), root)
    assert set(first.values()) == {"insert"} and "books/b/skip.txt" not in first
    assert found(spark, path, "red") == [("book-a", "one.psml"), ("book-b", "two.psml")]
    assert found(spark, path, "blue") == [("book-a", "one.psml#1")]

    write(root, "books/a/one.psml", "green fish", age=50)
    os.remove(os.path.join(root, "books/b/two.psml"))
    write(root, "books/b/four.psml", "red panda")
    second = actions(folder.index_folder(spark, path, root, BOOKS), root)
    assert {k: v for k, v in second.items() if k.startswith("books")} == {
        "books/a/one.psml": "update", "books/b/two.psml": "delete", "books/b/four.psml": "insert",
    }
    assert found(spark, path, "red") == [("book-b", "four.psml")]
    assert found(spark, path, "green") == [("book-a", "one.psml")]
    assert found(spark, path, "blue") == []

    runs = store.batches(spark, path).orderBy("batch_id", "index_name").collect()
    assert [(r["batch_id"], r["index_name"], r["documents"]) for r in runs] == [
        (1, "book-a", 2), (1, "book-b", 1), (2, "book-a", 1), (2, "book-b", 1),
    ]
    assert all(r["finished"] and r["index_ms"] > 0 for r in runs)

    third = actions(folder.index_folder(spark, path, root, BOOKS, folder="books"), root)
    assert third == {}
    again = actions(
        folder.index_folder(spark, path, root, BOOKS, folder="/books/a", path_regex=r"/.*\.psml", use_index_date=False),
        root,
    )
    assert again == {"books/a/one.psml": "update"}
    assert found(spark, path, "green") == [("book-a", "one.psml")]


def test_loader_passes_over_missing_files(spark, places):
    root, _ = places
    load = folder.folder_loader(spark, root)
    touched = spark.createDataFrame(
        [("book-a", f"{root}/books/a/one.psml")], "index_name STRING, _src STRING"
    )
    docs, values = load(touched)
    assert docs.count() == 2 and values.select(F.countDistinct("doc_id")).head()[0] == 2
    none = load(touched.where(F.lit(False)))
    assert none[0].count() == 0 and none[1].count() == 0


def test_names_are_no_patterns_and_gone_files_give_nothing(spark, places):
    root, path = places
    for name in ("two[1].psml", "x{y}.psml", "st*r.psml", "wh?t.psml"):
        write(root, f"books/a/{name}", "odd name")
    folder.index_folder(spark, path, root, BOOKS)
    assert [n for _, n in found(spark, path, "odd")] == ["st*r.psml", "two[1].psml", "wh?t.psml", "x{y}.psml"]
    rows = [("book-a", f"{root}/books/a/st*r.psml"), ("book-a", f"{root}/books/a/never.psml"), ("book-a", f"{root}/books")]
    wanted = spark.createDataFrame(rows, "index_name string, _src string")
    assert [r["_src"] for r in folder.read_files(spark, root, wanted).collect()] == [rows[0][1]]
    assert folder.read_files(spark, root, wanted.where("false")).count() == 0


def test_two_definitions_over_one_root(spark, places):
    root, path = places
    other = IndexDefinition("all", "everything", "/books")
    folder.index_folder(spark, path, root, BOOKS)
    folder.index_folder(spark, path, root, other)
    docs = store.read_index(spark, path).docs
    assert {r["index_name"] for r in docs.select("index_name").distinct().collect()} == {"book-a", "book-b", "everything"}
    again = actions(folder.index_folder(spark, path, root, other), root)
    assert not [name for name in again if name.startswith("books/")]
    catalog = store.read_index(spark, path).catalog
    assert catalog.count() == catalog.select("definition", "field").distinct().count()


def test_a_run_of_deletions_is_recorded(spark, places):
    root, path = places
    folder.index_folder(spark, path, root, BOOKS)
    os.remove(os.path.join(root, "books/b/two.psml"))
    folder.index_folder(spark, path, root, BOOKS)
    runs = store.batches(spark, path).orderBy("batch_id").collect()
    assert (runs[-1]["index_name"], runs[-1]["documents"]) == ("book-b", 0)


def test_patterns_are_no_index_names(spark, places):
    root, path = places
    folder.index_folder(spark, path, root, BOOKS)
    for name in ("*", "book-?", "", "a/b", "{book-a,book-b}"):
        with pytest.raises(ValueError, match="invalid index name"):
            store.clear_index(spark, path, [name])
    assert found(spark, path, "red")
