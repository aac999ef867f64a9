"""Path and duration text functions, as built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_url_tail(path: str | Column) -> Column:
    """Cut a query string, a fragment and trailing slashes off a path or URL."""
    return F.regexp_replace(_col(path), r"[/]*([?#].*)?$", "")


def parent_name(path: str | Column, strip_tail: bool = True) -> Column:
    """Name of the folder that holds a file: the class label of an image
    stored as ``root/<label>/<file>``."""
    p = strip_url_tail(path) if strip_tail else _col(path)
    return F.try_element_at(F.split(p, "/"), F.lit(-2))


def file_stem(path: str | Column) -> Column:
    """File name without folder and extension."""
    name = F.element_at(F.split(_col(path), "/"), -1)
    return F.regexp_replace(name, r"\.[^.]*$", "")


def duration_text(ms: str | Column, whole_ms_quirk: bool = False) -> Column:
    """Milliseconds as ``'M min, S sec, X ms'``.

    By default ``X`` is the remainder below one second. With
    ``whole_ms_quirk`` it is the whole duration cast to a 32-bit int, as the
    original report printed it."""
    t = _col(ms).cast("long")
    minutes = F.floor(t / 60000).cast("long")
    seconds = (F.floor(t / 1000) % 60).cast("long")
    millis = t.cast("int") if whole_ms_quirk else (t % 1000)
    return F.concat(minutes.cast("string"), F.lit(" min, "), seconds.cast("string"),
                    F.lit(" sec, "), millis.cast("string"), F.lit(" ms"))
