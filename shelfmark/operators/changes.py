"""Keeping indexes current: what changed, and applying it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.paths import full_match, relative_path, under

LISTED_FILES = 100


def source_window(
    path: Column,
    modified: Column | None,
    folder: str = "/",
    path_regex: str | None = None,
    modified_after: str | None = None,
) -> Column:
    """Inside a folder, matching a regex below it, changed after a day (``yyyy-MM-dd``).

    ``path`` is relative to the content root with a leading ``/``. Listings and indexed documents
    are compared by this same form.
    """
    folder = "/" + folder.strip("/")
    inside = F.lit(True) if folder == "/" else under(path, folder)
    if path_regex:
        inside = inside & F.coalesce(
            full_match(relative_path(path, folder), path_regex.removeprefix("/")), F.lit(False)
        )
    if modified_after and modified is not None:
        day = dt.datetime.strptime(modified_after, "%Y-%m-%d")
        inside = inside & (modified > F.lit(f"{day:%Y-%m-%d} 00:00:00").cast("timestamp"))
    return inside


def incremental_diff(
    source: DataFrame,
    existing: DataFrame,
    root: str,
    folder: str = "/",
    path_regex: str | None = None,
    modified_after: str | None = None,
    use_index_date: bool = True,
    accepted: Column | None = None,
) -> DataFrame:
    """Action per file: insert, update, delete or ignore.

    ``source`` is the whole listing (_src, modified), ``existing`` the indexed documents
    (_src, _lastmodified). ``accepted`` is a file filter over ``rel``, the path below the root.
    One shuffle on the path; contents are not read.
    """
    both = source.select("_src", "modified").join(
        existing.select("_src", "_lastmodified"), "_src", "full_outer"
    )
    rel = relative_path(F.col("_src"), root)
    both = both.withColumn("rel", rel).withColumn("_below", F.concat(F.lit("/"), rel))
    place = F.coalesce(source_window(F.col("_below"), None, folder, path_regex), F.lit(False))
    window = F.coalesce(
        source_window(F.col("_below"), F.col("modified"), folder, path_regex, modified_after),
        F.lit(False),
    )
    wanted = window & (F.lit(True) if accepted is None else F.coalesce(accepted, F.lit(False)))
    newer = F.col("modified") > F.col("_lastmodified") if use_index_date else F.lit(True)
    action = (
        F.when(F.col("modified").isNull(), F.when(place, F.lit("delete")))
        .when(F.col("_lastmodified").isNull(), F.when(wanted, F.lit("insert")))
        .when(wanted & newer, F.lit("update"))
    )
    return both.select(
        "_src", "modified", "_lastmodified", F.coalesce(action, F.lit("ignore")).alias("action")
    )


def apply_changes(index: DataFrame, diff: DataFrame, new_rows: DataFrame) -> DataFrame:
    """The table after a diff: old versions are removed by ``_src``, new ones added.

    ``new_rows`` are the rows of inserted and updated files, with the columns of ``index``.
    """
    kept, added = F.lit(True), F.lit(False)
    both = index.withColumn("_old", kept).unionByName(new_rows.withColumn("_old", added))
    action = F.coalesce("action", F.lit("ignore"))
    replaced = F.when(F.col("_old"), ~action.isin("update", "delete")).otherwise(
        action.isin("insert", "update")
    )
    # Old and new versions meet the diff in a single join on the path.
    joined = both.join(diff.select("_src", "action"), "_src", "left")
    return joined.where(replaced).select(*index.columns)


def removed_files(source: DataFrame, existing: DataFrame) -> DataFrame:
    """Indexed but no longer present."""
    return existing.select("_src").join(source.select("_src"), "_src", "left_anti")


def diff_report(diff: DataFrame, listed: int = LISTED_FILES) -> DataFrame:
    """Files per action, then the first files that were acted on, told apart by ``part``."""
    acted = diff.where(F.col("action") != "ignore")
    totals = diff.groupBy("action").agg(F.count("*").alias("files")).select(
        F.lit("total").alias("part"), "action", "files", F.lit(None).cast("string").alias("path")
    )
    files = acted.orderBy("_src").limit(listed).select(
        F.lit("file").alias("part"),
        "action",
        F.lit(None).cast("long").alias("files"),
        F.col("_src").alias("path"),
    )
    return totals.unionByName(files)
