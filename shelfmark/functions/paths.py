"""Paths of files, documents and indexes as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.arrays import let

NAME = "{name}"
# What {name} stands for when routing a path, matching a name, reading a name back.
NAME_IN_PATH = r"([\w\-]+)"
NAME_IN_MATCH = "(.*)"
NAME_IN_INVERSE = "(.+)"
# Fixed value: what an index may be called.
INDEX_NAME = r"[\w\-@$.]+"
INDEX_NAME_CHARS = 255
# Fixed value: the extension hidden in document paths, all lower or all upper case.
CONTENT_EXTENSION = r"\.(?:psml|PSML)$"


def full_match(value: Column, regex: str) -> Column:
    return value.rlike(f"^(?:{regex})$")


def under(path: Column, folder: Column | str) -> Column:
    """At or below the folder; a sibling sharing the prefix is not."""
    folder = F.lit(folder.rstrip("/")) if isinstance(folder, str) else folder
    return (path == folder) | path.startswith(F.concat(folder, F.lit("/")))


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root`` with ``/`` separators and no leading ``/``; null when outside."""
    root = root.replace("\\", "/").rstrip("/")
    path = F.replace(path, F.lit("\\"), F.lit("/"))
    return F.when(path == root, F.lit("")).when(
        path.startswith(root + "/"), F.substring(path, len(root) + 2, 2**31 - 1)
    )


def file_to_path(path: Column, root: str) -> Column:
    """Document path of a file: relative to the root, leading ``/``, no content extension."""
    inside = relative_path(path, root)
    return F.when(
        inside.isNotNull(),
        F.concat(F.lit("/"), F.regexp_replace(inside, CONTENT_EXTENSION, "")),
    ).otherwise(path)


def path_to_file(path: Column, root: str) -> Column:
    return F.concat(F.lit(root.rstrip("/")), path, F.lit(".psml"))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _folders(path: Column, dropped: int) -> Column:
    """``/a``, ``/a/b`` … for the parts of a path but the last ``dropped``, topmost first."""
    return let(
        F.filter(F.split(path, "/"), lambda part: part != ""),
        lambda parts: F.transform(
            F.slice(parts, 1, F.greatest(F.size(parts) - dropped, F.lit(0))),
            lambda _, n: F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, n + 1), "/")),
        ),
    )


def ancestors(path: Column) -> Column:
    """Folders above a path, topmost first: ``/a/b/c`` gives ``[/a, /a/b]``."""
    return _folders(path, 1)


def lineage(path: Column) -> Column:
    """The folders above a path and the path itself."""
    return _folders(path, 0)


def file_filter(relative: Column, include: str | None, exclude: str | None) -> Column:
    """Include and exclude regexes on the relative path; without either, content files only."""
    if include is None and exclude is None:
        return F.lower(relative).endswith(".psml")
    keep = relative.isNotNull()
    if include is not None:
        keep = keep & full_match(relative, include)
    if exclude is not None:
        keep = keep & ~full_match(relative, exclude)
    return keep


def is_excluded(path: Column, patterns: Sequence[str], below: bool = True) -> Column:
    """Whether an exclude covers the path.

    ``below`` is the reading used for routing: a fixed exclude covers what lies below it, a pattern
    also the path itself. Without it (root discovery) both cover the path itself only.
    """

    def one(pattern: str) -> Column:
        if "*" not in pattern:
            return path.startswith(pattern + "/") if below else path == pattern
        return full_match(path, pattern.replace("*", "(.*?)") + ("(/.+)?" if below else ""))

    return reduce(or_, [one(p) for p in patterns], F.lit(False))


def valid_index_name(name: Column) -> Column:
    """Word characters and ``- @ $ .`` only, 255 characters at most, never null."""
    return F.coalesce(
        (F.length(name) <= INDEX_NAME_CHARS) & full_match(name, INDEX_NAME), F.lit(False)
    )


def url_path(url: Column) -> Column:
    """Path of a URL without scheme, host, query and fragment."""
    return F.regexp_extract(url, r"^[a-z]+://[^/?#]*([^?#]*)", 1)
