"""Links of listing pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotally.functions.calendar import ColumnOrName, as_column

# Comments and scripts may hold text that looks like a tag.
_NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script>"
# Quoted values may hold a closing bracket.
_ANCHOR = r"""(?i)<a\s(?:"[^"]*"|'[^']*'|[^>"'])*>"""
# The named character references that occur in addresses; the ampersand is last, as it begins the others.
_NAMED = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))
_NUMERIC = r"(&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});)"
_HREFS = (r'(?i)\shref\s*=\s*"([^"]*)"', r"(?i)\shref\s*=\s*'([^']*)'", r"(?i)\shref\s*=\s*([^\s\"'>]+)")


def _character(reference: Column) -> Column:
    """The character that a numeric reference (``&#46;`` or ``&#x2e;``) stands for."""
    digits = F.regexp_extract(reference, r"([0-9a-fA-F]+);", 1)
    code = F.when(F.lower(reference).startswith("&#x"), F.conv(digits, 16, 16)).otherwise(F.conv(digits, 10, 16))
    return F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")


def _decoded(text: Column) -> Column:
    """Text with its character references replaced."""
    references = F.array_distinct(F.regexp_extract_all(text, F.lit(_NUMERIC), F.lit(1)))
    out = F.aggregate(references, text, lambda t, r: F.replace(t, r, _character(r)))
    for name, character in _NAMED:
        out = F.replace(out, F.lit(name), F.lit(character))
    return out


def _href(tag: Column) -> Column:
    found = [F.when(F.regexp_like(tag, F.lit(p)), F.regexp_extract(tag, p, 1)) for p in _HREFS]
    return _decoded(F.coalesce(*found))


def extract_links(
    pages: DataFrame, html: str = "html", base: ColumnOrName = "url", containing: str = ".csv"
) -> DataFrame:
    """Links of each page whose target contains ``containing``, in page order.

    Adds link_no (from 1), href as written and download_link, the page's address followed by the
    href. Works on whole pages, row by row, without an exchange.
    """
    markup = F.regexp_replace(html, _NOT_MARKUP, "")
    tags = F.regexp_extract_all(markup, F.lit(_ANCHOR), F.lit(0))
    hrefs = F.filter(F.transform(tags, _href), lambda h: h.contains(containing))
    keep = [c for c in pages.columns if c != html]
    found = pages.select(*keep, F.posexplode(hrefs).alias("_pos", "href"))
    return found.select(
        *keep,
        (F.col("_pos") + 1).alias("link_no"),
        "href",
        F.concat(as_column(base), F.col("href")).alias("download_link"),
    )
