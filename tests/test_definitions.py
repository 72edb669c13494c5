"""Which paths and names belong to which index."""

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import paths
from shelfmark.operators import definitions as de
from shelfmark.operators.definitions import IndexDefinition, load_definitions

def column(spark, values, name):
    return spark.createDataFrame([(v,) for v in values], f"{name} STRING")


def result(df, name):
    return [r[name] for r in df.collect()]


@pytest.mark.parametrize("hole_in_name", [True, False])
@pytest.mark.parametrize("hole_in_path", [True, False])
def test_a_hole_is_in_name_and_path_or_in_neither(hole_in_name, hole_in_path):
    name = "hall_{name}" if hole_in_name else "halls"
    path = "/museum/{name}/rooms" if hole_in_path else "/museum/rooms"
    if hole_in_name == hole_in_path:
        assert IndexDefinition("d", name, path).index_name == name
    else:
        with pytest.raises(ValueError, match="or into neither"):
            IndexDefinition("d", name, path)


def test_names_fill_the_hole(spark):
    names = ["hall_", "hall_a", "hall_a-b_9", "hall_a b", "hall_a/b", "the hall_a", "hall_a.", "Hall_a", "", None]
    df = column(spark, names, "n")
    one = IndexDefinition("d", "hall_{name}", "/museum/{name}")
    assert result(df.select(one.matches_name(F.col("n")).alias("m")), "m") == [
        True, True, True, True, True, False, True, False, False, False,
    ]
    # A name without a hole is compared letter by letter, none of them a pattern.
    plain = IndexDefinition("d", "a.b", "/museum")
    df = column(spark, ["a.b", "axb", "a.bc"], "n").select(plain.matches_name(F.col("n")).alias("m"))
    assert result(df, "m") == [True, False, False]


def routed(spark, definition, files):
    return dict(zip(files, result(de.route_index(column(spark, files, "path"), definition), "index_name"), strict=True))


#: Definitions, and where paths around the borders of their rules go.
ROUTES = [
    (
        IndexDefinition("d", "all", "/museum"),
        {"/museum": "all", "/museum/": "all", "/museum/a/b/c.psml": "all", "/museums": None, "/museu": None,
         "/old/museum/a": None, "/": None},
    ),
    (
        IndexDefinition("d", "r-{name}", "/museum/wing-{name}/rooms"),
        {"/museum/wing-a/rooms": "r-a", "/museum/wing-a-b_2/rooms/x/y.psml": "r-a-b_2", "/museum/wing-/rooms": None,
         "/museum/wing-a/x/rooms": None, "/museum/wing-a": None, "/museum/wing-a/roomsful/x": None,
         "/museum/wing-a b/rooms": None, "/museum/wing-a/rooms/wing-b/rooms/x": "r-a"},
    ),
    (
        IndexDefinition("d", "{name}", "/m/{name}", path_excludes=("/m/shut", "/m/half/shut", "/m/t*")),
        {"/m/open/x": "open", "/m/shut": "shut", "/m/shut/x": None, "/m/shutter/x": "shutter", "/m/half/x": "half",
         "/m/half/shut/x/y": None, "/m/two/x": None, "/m/ten/x/y.psml": None, "/m/at/x": "at", "/m": None},
    ),
]


@pytest.mark.parametrize("definition, wanted", ROUTES)
def test_routes_around_borders(spark, definition, wanted):
    assert routed(spark, definition, list(wanted)) == wanted


@pytest.mark.parametrize("definition, wanted", ROUTES)
def test_content_path_leads_back(spark, definition, wanted):
    """The content path of the index a path is routed to is a folder at or above the path."""
    inside = [file for file, name in wanted.items() if name]
    df = de.content_path(de.route_index(column(spark, inside, "path"), definition), definition)
    df = df.select(paths.under(F.col("path"), F.col("content_path")).alias("u"))
    assert all(result(df, "u"))


def test_content_path_puts_the_name_into_the_hole(spark):
    one = IndexDefinition("d", "r-{name}-x", "/museum/wing-{name}/rooms")
    df = de.content_path(column(spark, ["r-a-x", "r-a-b-x", "r-x-x-x"], "index_name"), one)
    assert result(df, "content_path") == [f"/museum/wing-{n}/rooms" for n in ("a", "a-b", "x-x")]
    plain = IndexDefinition("d", "halls", "/museum/halls")
    assert result(de.content_path(column(spark, ["halls"], "index_name"), plain), "content_path") == ["/museum/halls"]


@pytest.mark.parametrize(
    "include, exclude, accepted",
    [
        (None, None, {"a.psml", "a/b.Psml"}),
        (r".+\.(svg|psml)", None, {"a.psml", "a.svg"}),
        (None, r"a/.*", {"a.psml", "a.svg", "psml"}),
        (r"a.*", r".*/.*", {"a.psml", "a.svg"}),
        (r"psm", r"sml", set()),
    ],
)
def test_file_filter(spark, include, exclude, accepted):
    """Patterns hold for the whole path; one that excludes takes everything else in."""
    files = ["a.psml", "a/b.Psml", "a.svg", "psml"]
    df = column(spark, files, "p").where(paths.file_filter(F.col("p"), include, exclude))
    assert set(result(df, "p")) == accepted


def test_content_roots_of_folders_and_files(spark):
    folders = ["/m", "/m/east", "/m/west", "/m/west/deep", "/n/w1", "/n/w1/w2", "/n/x1"]
    cases = [
        (IndexDefinition("d", "all", "/m"), {"/m"}),
        (IndexDefinition("d", "{name}", "/m/{name}"), {"/m/east", "/m/west"}),
        (IndexDefinition("d", "w{name}", "/n/w{name}"), {"/n/w1"}),
        (IndexDefinition("d", "{name}", "/m/{name}/deep"), {"/m/west/deep"}),
        (IndexDefinition("d", "none", "/nowhere"), set()),
    ]
    files = column(spark, [f"{folder}/a/b.psml" for folder in folders], "path")
    for definition, wanted in cases:
        of_folders = de.content_roots(column(spark, folders, "path"), definition, folders=True)
        assert set(result(of_folders, "root")) == wanted
        # A file below a folder says that the folder is there.
        below = {"/m/a"} if definition.path == "/m/{name}" else set()
        assert set(result(de.content_roots(files, definition), "root")) == wanted | below


def test_topmost_root_wins_and_excluded_one_is_descended_into(spark):
    d = IndexDefinition("d", "i-{name}", "(?:/x)+/{name}", path_excludes=("/x/skip",))
    files = column(spark, ["/x/a/x/b/f.psml", "/x/x/c/f.psml", "/x/skip/f.psml"], "path")
    # /x/x matches before /x/x/c does; /x/skip itself is excluded.
    assert sorted(result(de.content_roots(files, d), "root")) == ["/x/a", "/x/x"]


def test_exclude_with_trailing_slash_and_root_reading(spark):
    d = IndexDefinition("d", "{name}", "/c/{name}", path_excludes=("/c/one/",))
    folders = column(spark, ["/c/one", "/c/two"], "path")
    assert result(de.content_roots(folders, d, folders=True), "root") == ["/c/two"]
    routed = de.route_index(column(spark, ["/c/one", "/c/one/f", "/c/oneself/f"], "path"), d)
    assert result(routed, "index_name") == ["one", None, "oneself"]


def test_destinations_are_distinct(spark):
    d = [IndexDefinition("a", "x-{name}", "/c/{name}"), IndexDefinition("b", "all", "/c")]
    roots = spark.createDataFrame([("x-one", "/c/one"), ("deep", "/c/one/two")], "index_name STRING, root STRING")
    files = column(spark, ["/c/one/two/f.psml", "/c/three/f.psml", "/d/f.psml"], "path")
    rows = de.route_destinations(files, d, roots).collect()
    assert sorted((r["path"], r["index_name"]) for r in rows) == [
        ("/c/one/two/f.psml", "all"), ("/c/one/two/f.psml", "deep"), ("/c/one/two/f.psml", "x-one"),
        ("/c/three/f.psml", "all"), ("/c/three/f.psml", "x-three"),
    ]


def test_definitions_from_settings():
    found, refused = load_definitions(
        {
            "books.name": "book-{name}", "books.path": "/museum/{name}", "books.excludes": "/a/,/b",
            "books.autosuggests": "titles,none", "books.titles.fields": "title,author",
            "books.titles.terms": "true", "books.titles.weight": "title:2.0,broken,author:x",
            "bad.name": "bad", "bad.path": "/x/{name}", "odd.template": "odd",
        },
        "books,bad,odd,plain",
    )
    assert [d.name for d in found] == ["books", "plain"]
    assert found[0].path_excludes == ("/a", "/b")
    assert found[0].autosuggests[0].fields == ("title", "author")
    assert found[0].autosuggests[0].use_terms and found[0].autosuggests[0].min_chars == 2
    assert found[0].autosuggests[0].weights == {"title": 2.0}
    assert (found[1].index_name, found[1].path) == ("default", "/psml/content")
    assert set(refused) == {"bad", "odd"}


def test_first_definition_wins(spark):
    d = [IndexDefinition("a", "x-{name}", "/c/{name}"), IndexDefinition("b", "{name}", "/d/{name}")]
    df = de.match_definition(column(spark, ["x-1", "y", "x"], "index_name"), d)
    assert result(df, "definition") == ["a", "b", "b"]


def test_valid_index_names(spark):
    names = ["a-b@c$d.e_1", "a b", "", None, "x" * 255, "x" * 256, "a/b"]
    df = column(spark, names, "n").select(paths.valid_index_name(F.col("n")).alias("v"))
    assert result(df, "v") == [True, False, False, False, True, False, False]


def test_document_paths(spark):
    df = column(spark, ["/r/a.psml", "/r/a.PSML", "/r/a.Psml", "/r/b.xml", "/rs/a.psml", "/r/a.PSML.psml"], "p")
    rows = df.select(paths.file_to_path(F.col("p"), "/r/").alias("d"))
    assert result(rows, "d") == ["/a", "/a", "/a.Psml", "/b.xml", "/rs/a.psml", "/a.PSML"]
