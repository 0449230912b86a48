"""Names derived from text: path stems (A13) and name slugs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def file_stem(path: Column | str, suffix: str = ".csv") -> Column:
    """Last path segment, lower-cased, ``suffix`` removed once at the end."""
    name = F.lower(F.substring_index(_col(path), "/", -1))
    return _strip_suffix(name, suffix)


def _strip_suffix(s: Column, suffix: str) -> Column:
    if not suffix:
        return s
    return F.when(s.endswith(F.lit(suffix)),
                  F.substring(s, F.lit(1), F.length(s) - F.lit(len(suffix))))\
        .otherwise(s)


def folder_stem(path: Column | str) -> Column:
    """Lower-cased, one trailing ``/`` removed, last segment."""
    p = F.lower(_col(path))
    p = _strip_suffix(p, "/")
    return F.substring_index(p, "/", -1)


def parent_folder(path: Column | str) -> Column:
    """The folder holding a file (``a/b/c.csv`` -> ``a/b``)."""
    p = _col(path)
    return F.regexp_replace(p, r"/[^/]*$", "")


def slug(*parts: Column | str, max_length: int | None = None) -> Column:
    """Join non-empty parts with ``-``, lower-case, drop quotes and commas
    between digits, every run of other characters becomes one ``-``, ends
    trimmed (``adhoc_airflow`` + ``my_test_pyspark_task`` ->
    ``adhoc-airflow-my-test-pyspark-task``). ``max_length`` cuts the result,
    for uses that limit names; different names may then become equal."""
    cols = [F.nullif(_col(p), F.lit("")) for p in parts]
    joined = F.lower(F.concat_ws("-", *cols))
    # quotes vanish and thousands separators between digits are dropped
    joined = F.regexp_replace(F.regexp_replace(joined, "'", ""), r"(?<=[0-9]),(?=[0-9])", "")
    dashed = F.regexp_replace(joined, r"[^a-z0-9]+", "-")
    trimmed = F.regexp_replace(dashed, r"^-+|-+$", "")
    return trimmed if max_length is None else F.regexp_replace(F.substring(trimmed, 1, max_length), r"-+$", "")


def named_path(path: Column | str) -> Column:
    """A path as files are named: ``_metadata.file_path`` is percent-encoded."""
    return F.url_decode(F.replace(_col(path), F.lit("+"), F.lit("%2B")))
