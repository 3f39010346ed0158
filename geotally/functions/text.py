"""Names, paths and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geotally.functions.calendar import ColumnOrName, as_column


def column_name(raw: str) -> str:
    """Lower case with blanks as underscores."""
    return raw.lower().replace(" ", "_")


def base_name(path: ColumnOrName) -> Column:
    return F.substring_index(as_column(path), "/", -1)


def first_token(text: ColumnOrName, separator: str = " ") -> Column:
    return F.substring_index(as_column(text), separator, 1)


def keyword_label(text: ColumnOrName, keywords: tuple[tuple[str, str], ...], default: str) -> Column:
    """Label of the first keyword contained in ``text``, whatever its case."""
    folded = F.upper(as_column(text))
    found = [F.when(folded.contains(word), F.lit(label)) for word, label in keywords]
    return F.coalesce(*found, F.lit(default))


def label_text(*pieces: tuple[str, ColumnOrName]) -> Column:
    """``Name: value`` pairs joined by semicolons; a null value leaves an empty place."""
    shown = [
        F.concat(F.lit(f"{name}: "), F.coalesce(as_column(value).cast("string"), F.lit(""))) for name, value in pieces
    ]
    return F.concat_ws("; ", *shown)


def split_list(text: str) -> list[str]:
    """Job argument ``"a, b"`` as ``["a", "b"]``."""
    return [item for item in text.replace(" ", "").split(",") if item]
