"""Feed-item row transforms: key resolution, fallbacks, sanitising, truncation, tokens."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from threatlake.functions.common import col_of, nullif_blank

# Advertised maximum lengths of stored text.
MAX_SUMMARY_CHARS = 200_000
MAX_CONTENT_CHARS = 500_000


def resolve_guid(guid, link) -> Column:
    """GUID, else link; NULL when both are empty (the row is then rejected)."""
    return F.coalesce(nullif_blank(guid), nullif_blank(link))


def content_with_fallback(content, description) -> Column:
    """Cleaned content, else the cleaned description."""
    return F.coalesce(nullif_blank(sanitize_html(content)), sanitize_html(description), F.lit(""))


def published_with_fallback(published, updated, now) -> Column:
    return F.coalesce(col_of(published), col_of(updated), col_of(now))


def updated_with_fallback(updated, published) -> Column:
    return F.coalesce(col_of(updated), col_of(published))


def empty_content(content, summary) -> Column:
    c, s = F.coalesce(col_of(content), F.lit("")), F.coalesce(col_of(summary), F.lit(""))
    return (c == "") & (s == "")


def truncate_text(text, n: int = 200) -> Column:
    """Longer than ``n`` characters -> first ``n-3`` characters and ``...``."""
    t = col_of(text)
    return F.when(F.length(t) > n, F.concat(F.substr(t, F.lit(1), F.lit(n - 3)), F.lit("..."))).otherwise(t)


def cap_length(text, n: int) -> Column:
    return F.left(col_of(text), F.lit(n))


# The allow-list policy. Elements that go with their content, elements that stay, and
# the attributes that stay on them.
DROP_WITH_CONTENT = ("script", "style", "iframe", "object", "embed")
ALLOWED_TAGS = ("a", "b", "blockquote", "br", "code", "div", "em", "h1", "h2", "h3", "h4", "h5", "h6", "i", "img",
                "li", "ol", "p", "pre", "span", "strong", "table", "td", "th", "tr", "ul")
ALLOWED_ATTRS = {"a": ("href", "title"), "img": ("src", "alt", "title")}
URL_ATTRS = ("href", "src")

_GAP = r"[ \t\n\f\r]"
_ANY_TAG = r"^[a-zA-Z/!?][^>]*>"  # of a piece that followed a "<"
_NAMED_TAG = r"^/?([a-zA-Z][a-zA-Z0-9]*)[^>]*>"
# http, https, mailto, or relative: no colon or entity before the path
_SAFE_URL = r"""^(((?i)https?|mailto):[^\x00-\x20"'<>]*|[^\x00-\x20"'<>:&]*([/?#][^\x00-\x20"'<>]*)?)$"""


def _attribute(tag: Column, name: str) -> Column:
    """`` name="value"`` of a tag's text, or nothing (absent, or an unsafe URL)."""
    value = r"""("[^"]*"|'[^']*'|[^ \t\n\f\r"'>]+)"""
    found = F.regexp_extract(tag, rf"""(?i)[ \t\n\f\r/"']{name}{_GAP}*={_GAP}*{value}""", 1)
    plain = F.regexp_replace(F.regexp_replace(found, r"""^["']|["']$""", ""), '"', "&quot;")
    keep = F.length(found) > 0
    if name in URL_ATTRS:
        keep = keep & plain.rlike(_SAFE_URL)
    return F.when(keep, F.concat(F.lit(f' {name}="'), plain, F.lit('"'))).otherwise(F.lit(""))


def _rebuilt(piece: Column) -> Column:
    """What stays of the text that followed a ``<``: an allowed tag is written anew from its
    name and allowed attributes, any other tag goes, and a ``<`` that opens no tag is escaped."""
    name = F.lower(F.regexp_extract(piece, _NAMED_TAG, 1))
    rest = F.regexp_replace(piece, _ANY_TAG, "")
    attrs = F.lit("")
    for element, allowed in ALLOWED_ATTRS.items():
        tag = F.regexp_extract(piece, _ANY_TAG, 0)
        attrs = F.when(name == element, F.concat(*[_attribute(tag, a) for a in allowed])).otherwise(attrs)
    written = F.when(piece.startswith("/"), F.concat(F.lit("</"), name, F.lit(">"))).otherwise(
        F.concat(F.lit("<"), name, attrs, F.lit(">")))
    return (F.when(~piece.rlike(_ANY_TAG), F.concat(F.lit("&lt;"), piece))
            .when(name.isin(*ALLOWED_TAGS), F.concat(written, rest)).otherwise(rest))


def sanitize_html(html) -> Column:
    """Allow-list HTML policy in native expressions: comments and ``DROP_WITH_CONTENT`` elements go
    with their content (to the end where unclosed), only ``ALLOWED_TAGS`` stay, with ``ALLOWED_ATTRS``
    and safe URLs. Every ``<`` of the result starts a tag written here, so no input can form
    another one. NULL stays NULL."""
    x = F.regexp_replace(col_of(html), r"(?s)<!--.*?(-->|\z)", "")
    for tag in DROP_WITH_CONTENT:
        x = F.regexp_replace(x, rf"(?is)<{tag}([ \t\n\f\r/][^>]*)?>.*?(</{tag}{_GAP}*>|\z)", "")
    return F.array_join(F.transform(F.split(x, "<", -1), lambda p, i: F.when(i == 0, p).otherwise(_rebuilt(p))), "")


# Token separators of the search document (anything not a letter/digit).
NON_WORD = r"[^\p{L}\p{N}]+"


def search_tokens(*cols) -> Column:
    """Sorted distinct lower-case word tokens of the given text columns (no stemming)."""
    text = F.lower(F.concat_ws(" ", *[col_of(c) for c in cols]))
    words = F.split(F.trim(F.regexp_replace(text, NON_WORD, " ")), " ")
    return F.sort_array(F.array_distinct(F.array_remove(words, "")))  # no nulls; array_sort would compare by a lambda
