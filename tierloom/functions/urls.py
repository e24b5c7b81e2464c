"""Links in HTML and their resolution against a base address, as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text in which markup does not count: comments, scripts and style sheets (up to the end when unclosed).
OPAQUE = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*+>.*?(?:</\1\s*+>|\z)"
# One whole anchor start tag; '>' inside a quoted attribute value does not end it.
ANCHOR = r"""(?is)<a\s(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
# Its attributes before href, each with or without a value, then the value of href itself.
HREF = (
    r"""(?is)^<a(?:\s++(?!href[\s=])[^\s=>"']++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+)*+"""
    r"""\s++href\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))"""
)
# The character references decoded in addresses; the ampersand must come last.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))

PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def hrefs(html: str | Column) -> Column:
    """Array with the target of every anchor of a page, in document order."""
    page = F.col(html) if isinstance(html, str) else html
    visible = F.regexp_replace(page, OPAQUE, "")
    tags = F.regexp_extract_all(visible, F.lit(ANCHOR), F.lit(0))
    with_target = F.filter(tags, lambda tag: tag.rlike(HREF))
    return F.transform(with_target, _target)


def _target(tag: Column) -> Column:
    groups = [F.regexp_extract(tag, HREF, group) for group in (1, 2, 3)]
    address = F.concat(*groups)
    for reference, character in REFERENCES:
        address = F.replace(address, F.lit(reference), F.lit(character))
    return address


def base_name(address: str | Column) -> Column:
    """What follows the last slash."""
    column = F.col(address) if isinstance(address, str) else address
    return F.substring_index(column, "/", -1)


def _part(address: Column, group: int) -> Column:
    return F.regexp_extract(address, PARTS, group)


def _without_dots(path: Column) -> Column:
    """Remove '.' and '..' segments, folding over the segments of one path."""
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, segment: F.when(segment == ".", done)
        .when(
            segment == "..",
            F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done),
        )
        .otherwise(F.concat(done, F.array(segment))),
    )
    joined = F.array_join(kept, "/")
    return F.when(last.isin(".", ".."), F.concat(joined, F.lit("/"))).otherwise(joined)


def resolve(base: str | Column, address: str | Column) -> Column:
    """Absolute form of an address found on the page ``base`` (RFC 3986, section 5.2).

    Leading blanks and line breaks in the address do not count; a relative path loses repeated slashes.
    """
    base = F.col(base) if isinstance(base, str) else base
    address = F.col(address) if isinstance(address, str) else address
    address = F.regexp_replace(address, r"^[\x00-\x20]+|[\t\r\n]", "")
    scheme, host, path = (_part(address, group) for group in (1, 2, 3))
    base_scheme, base_host, base_path = (_part(base, group) for group in (1, 2, 3))
    query = F.regexp_extract(address, r"^[^?#]*(\?[^#]*)", 1)
    base_query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    fragment = F.regexp_extract(address, r"(#.*)$", 1)
    folder = F.regexp_extract(base_path, r"^(.*/)", 1)
    merged = F.when(folder == "", F.concat(F.lit("/"), path)).otherwise(F.concat(folder, path))
    merged = F.regexp_replace(merged, "/{2,}", "/")
    root = F.concat(base_scheme, F.lit("://"), base_host)
    return (
        F.when(scheme != "", address)
        .when(address == "", base)
        .when(host != "", F.concat(base_scheme, F.lit(":"), address))
        .when(path.startswith("/"), F.concat(root, _without_dots(path), query, fragment))
        .when(path != "", F.concat(root, _without_dots(merged), query, fragment))
        .when(query != "", F.concat(root, base_path, query, fragment))
        .otherwise(F.concat(root, base_path, base_query, fragment))
    )
