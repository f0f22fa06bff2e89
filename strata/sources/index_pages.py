"""Directory-index parsing over tables of HTML pages and file listings.

A source publishes monthly folders (``YYYYMM/``) with archive files, each
listed on an HTML index page.  Instead of fetching and parsing pages one at
a time in a driver process, the pages are rows of a table and every step is
a column expression, so millions of pages parse in parallel.

Link extraction follows an HTML parser's view of ``<a href>``: comments and
the bodies of ``<script>``/``<style>`` elements hold no tags, attribute names
are case-insensitive, and character references in the value are decoded.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Markup that can contain text looking like tags without being tags.
_NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# Opening <a ...> tags; a quoted attribute value may hold '>'.
_A_TAG = r"""(?is)<a\s(?:[^>"']|"[^"]*"|'[^']*')*>"""
# One attribute: its name and its value in one of three spellings, or none.
_ATTRIBUTE = r"""(?is)([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?"""
# A character reference: by number, or by a name whose end only a list of names can tell.
_REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_ESCAPE = r"%[0-9a-fA-F]{2}"
PERIOD_PATTERN = r"^[0-9]{6}$"
#: Names that may stand without a semicolon are no longer.
_LONGEST_BARE = max(len(name) for name in html5 if not name.endswith(";"))

#: References that URLs use, looked up before the full list.
_FREQUENT = {name: html5[name] for name in ("amp;", "amp", "quot;", "lt;", "gt;", "nbsp;")}


def _by_number() -> dict[str, str]:
    """What HTML reads for the code points that are no characters, by number in decimal.

    Windows' characters for the upper control codes, a replacement for zero, nothing for the others.
    """
    nothing = [*range(1, 9), 11, *range(14, 32), 127, *range(0xFDD0, 0xFDF0)]
    nothing += [plane << 16 | low for plane in range(17) for low in (0xFFFE, 0xFFFF)]
    windows = {code: bytes([code]).decode("cp1252", "ignore") or chr(code) for code in range(0x80, 0xA0)}
    found = dict.fromkeys(nothing, "") | windows | {0: "\ufffd"}
    return {str(code): text for code, text in found.items()}


def _map(entries: dict[str, str]) -> Column:
    """A map literal in one expression; the optimizer reads it once."""
    return F.from_json(F.lit(json.dumps(entries)), "map<string, string>")


def _replaced(text: Column, pattern: str, decode) -> Column:
    """``text`` with every match of ``pattern`` replaced by ``decode(match)``."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    pieces = F.zip_with(between, F.transform(found, decode), lambda t, m: F.concat(t, F.coalesce(m, F.lit(""))))
    return F.when(text.rlike(pattern), F.array_join(pieces, "")).otherwise(text)


def html_entities(text: Column) -> Column:
    """Decode character references as an HTML parser does.

    A name that is not on the list is read as the longest name of the list
    that it begins with, of those that need no semicolon: ``&notit;`` is ``¬it;``.
    """
    names, frequent, numbers = _map(html5), _map(_FREQUENT), _map(_by_number())

    def decode(match: Column) -> Column:
        body = F.substring(match, 2, 64)
        digits = F.regexp_replace(F.regexp_replace(match, r"^&#[xX]?0*", ""), ";$", "")
        code = F.when(F.length(digits) > 8, F.lit(1 << 32)).when(digits == "", F.lit(0)).otherwise(
            F.when(body.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("long")
        )
        # through UTF-32: char() knows only one byte
        character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        none = (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
        numeric = F.coalesce(F.element_at(numbers, code.cast("string")), F.when(none, "\ufffd").otherwise(character))
        begun = [
            F.concat(F.element_at(names, F.substring(body, 1, n)), F.substring(body, n + 1, 64))
            for n in range(_LONGEST_BARE, 1, -1)
        ]
        named = F.coalesce(F.element_at(frequent, body), F.element_at(names, body), *begun, match)
        return F.when(body.startswith("#"), numeric).otherwise(named)

    return _replaced(text, _REFERENCE, decode)


def href_values(html: Column) -> Column:
    """Array of the non-empty href values of all <a> tags, in document order; a tag's last href counts."""
    tags = F.regexp_extract_all(F.regexp_replace(html, _NOT_MARKUP, " "), F.lit(_A_TAG), 0)

    def href(tag: Column) -> Column:
        attributes = F.regexp_extract_all(F.substring(tag, 3, 1 << 30), F.lit(_ATTRIBUTE), 0)
        own = F.filter(attributes, lambda a: F.lower(F.regexp_extract(a, _ATTRIBUTE, 1)) == "href")
        last = F.try_element_at(own, F.lit(-1))
        value = F.concat(*[F.regexp_extract(last, _ATTRIBUTE, i) for i in (2, 3, 4)])
        return html_entities(value)

    return F.filter(F.transform(tags, href), lambda v: v != "")


def percent_decoded(text: Column) -> Column:
    """Percent escapes decoded as UTF-8; an invalid escape stays as it is, ``+`` too."""
    lone = F.regexp_replace(text, r"%(?![0-9a-fA-F]{2})", "%25")
    return F.coalesce(F.try_url_decode(F.replace(lone, F.lit("+"), F.lit("%2B"))), text)


def url_path(link: Column) -> Column:
    """Percent-decoded path of a link: no scheme, host, query, fragment or ;params."""
    decoded = percent_decoded(link)
    no_fragment = F.regexp_replace(decoded, r"(?s)#.*$", "")
    no_query = F.regexp_replace(no_fragment, r"(?s)\?.*$", "")
    no_scheme = F.regexp_replace(no_query, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    no_host = F.regexp_replace(no_scheme, r"^//[^/]*", "")
    return F.regexp_replace(no_host, r";[^/]*$", "")


def file_name(link: Column) -> Column:
    """Base name of a file link; NULL for empty paths and directory links (ending '/')."""
    path = url_path(link)
    base = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.when((path != "") & ~path.endswith("/") & (base != ""), base)


def period_of(link: Column) -> Column:
    """The six-digit last path part of a (directory) link, else NULL."""
    path = F.regexp_replace(url_path(link), r"/+$", "")
    last = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.when(last.rlike(PERIOD_PATTERN), last)


def page_links(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """(page id, href) for every link of every page."""
    return pages.select(id_column, F.explode(href_values(F.col(html_column))).alias("href"))


def page_file_links(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """Distinct (page id, file name) of the file links on each page."""
    links = page_links(pages, id_column, html_column)
    return links.select(id_column, file_name(F.col("href")).alias("file_name")).where(
        F.col("file_name").isNotNull()
    ).distinct()


def periods_in_range(links: DataFrame, link_column: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Distinct periods named by the links, within the inclusive [start, end] range.

    A link is read once, however often it comes: periods are generated, as a filter on a generated column stays
    above it. On a projected one the optimizer copies the reading of links into the filters, and these below ``distinct``.
    """
    named = links.select(F.col(link_column).alias("link")).distinct()
    periods = named.select(F.explode(F.array(period_of(F.col("link")))).alias("period")).where(F.col("period").isNotNull())
    if start is not None:
        periods = periods.where(F.col("period") >= start)
    if end is not None:
        periods = periods.where(F.col("period") <= end)
    return periods.distinct()


def latest_period(periods: DataFrame) -> DataFrame:
    """Zero or one row: the greatest period (six digits, so text order is time order)."""
    return periods.agg(F.max("period").alias("period")).where(F.col("period").isNotNull())


def file_allowed(name: Column, extensions: list[str] | None = None, excluded_tokens: list[str] | None = None) -> Column:
    """Every filter must pass: extension (case-insensitive) and tokens absent (case-insensitive)."""
    condition = F.lit(True)
    for ext in extensions or []:
        condition = condition & F.lower(name).endswith(ext.lower())
    for token in excluded_tokens or []:
        condition = condition & ~F.upper(name).contains(token.upper())
    return condition


def unpublished(periods: DataFrame, published: DataFrame, column: str = "period") -> DataFrame:
    """Periods not yet present at the destination."""
    return periods.join(published.select(column).distinct(), column, "left_anti")
