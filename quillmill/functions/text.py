"""Scalar functions over text, names and bytes as native columns."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point that counts as white space, as a Java pattern.
WHITE = r"[\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
# File extension by media type.
EXTENSIONS = {
    "text/html": "html",
    "application/xhtml+xml": "html",
    "application/pdf": "pdf",
    "application/msword": "doc",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx",
    "application/rtf": "rtf",
    "text/plain": "txt",
}
UNKNOWN = "bin"
# What a name may not hold, and what is escaped in HTML.
UNSAFE, REPEATED = "[^A-Za-z0-9._-]+", "-{2,}"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))
# Declared counts, the total in group 1, and the sentence of an empty range, in either case.
TOTAL, NO_RESULTS = r"of\s+(\d+)\s+results", r"(?i)no\s+search\s+results"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once."""
    return F.transform(F.array(value), use)[0]


def normalise(text: Column) -> Column:
    """Runs of white space collapsed to one space, ends trimmed; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " "))


def slug(identifier: Column) -> Column:
    """Upper-case name safe for files and keys: runs of other signs are one hyphen, none at the ends."""
    hyphened = F.regexp_replace(F.regexp_replace(normalise(identifier), UNSAFE, "-"), REPEATED, "-")
    return F.upper(F.regexp_replace(hyphened, "^-+|-+$", ""))


def media_type(header: Column) -> Column:
    """The media type of a content-type header; null if there is none."""
    return F.nullif(F.lower(normalise(F.split_part(header, F.lit(";"), F.lit(1)))), F.lit(""))


def url_path(url: Column) -> Column:
    """The path of a URL, without query and fragment."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def extension(header: Column, url: Column) -> Column:
    """struct(extension, recognised): by the header, then by the URL path's suffix, then `bin`."""
    known = F.create_map(*(F.lit(x) for pair in EXTENSIONS.items() for x in pair))
    by_header = F.element_at(known, F.coalesce(media_type(header), F.lit("")))
    suffix = F.lower(F.regexp_extract(url_path(url), r"\.([^.]*)$", 1))
    found = F.coalesce(by_header, F.when(suffix.isin(sorted(set(EXTENSIONS.values()))), suffix))
    return F.struct(F.coalesce(found, F.lit(UNKNOWN)).alias("extension"), found.isNotNull().alias("recognised"))


def href_extension(href: Column) -> Column:
    """What follows the last dot of a link, lower-cased; `(none)` without a dot."""
    return F.when(F.contains(href, F.lit(".")), F.lower(F.regexp_extract(href, r"\.([^.]*)$", 1))).otherwise("(none)")


def raw_hash(body: Column) -> Column:
    return F.sha2(body, 256)


def strip_comments(body: Column) -> Column:
    """Bytes without HTML comments; each byte is one character on the way, so none is altered."""
    return F.encode(F.regexp_replace(F.decode(body, "ISO-8859-1"), "(?s)<!--.*?-->", ""), "ISO-8859-1")


def parse_total(text: Column, total: str = TOTAL, no_results: str = NO_RESULTS) -> Column:
    """A declared count, 0 for an empty range, null if neither can be read; these three stay apart."""
    flat = normalise(text)
    return F.when(text.isNull(), None).when(F.rlike(flat, F.lit(total)), F.regexp_extract(flat, total, 1).cast("bigint")).when(F.rlike(flat, F.lit(no_results)), F.lit(0).cast("bigint"))


# The parts of a source's date format, with the pattern each is written by, the one it is read by, and its shape.
DATE_PARTS = {
    "%d": ("dd", "d", r"\d{1,2}"), "%-d": ("d", "d", r"\d{1,2}"), "%m": ("MM", "M", r"\d{1,2}"), "%-m": ("M", "M", r"\d{1,2}"), "%Y": ("yyyy", "yyyy", r"\d{4}"), "%y": ("yy", "yy", r"\d{2}"),
    "%B": ("MMMM", "MMMM", r"\p{L}+"), "%b": ("MMM", "MMM", r"\p{L}+\.?"), "%%": ("'%'", "'%'", "%"),
}


def _date_pattern(date_format: str, part: int) -> str:
    """A source's format (%d/%m/%Y) as a pattern: 0 to write by, 1 to read by, 2 its shape as a regular expression."""
    out = ""
    for own in re.findall(r"%-?.|[A-Za-z]+|[^%]", date_format):
        if own in DATE_PARTS:
            out += DATE_PARTS[own][part]
        elif own.startswith("%"):
            raise ValueError(f"date format not supported: {own} in {date_format!r}")
        else:
            out += re.escape(own) if part == 2 else f"'{own}'" if own.isalpha() else "''" if own == "'" else own
    return out


def format_date(day: Column, date_format: str) -> Column:
    """A date as a source writes it, by its strftime format; %-d and %-m are unpadded."""
    return F.date_format(day, _date_pattern(date_format, 0))


def parse_date(text: Column, date_format: str = "%d/%m/%Y") -> Column:
    """A date by a source's strftime format, its numbers padded or not; null if it is empty or none."""
    flat = normalise(text)
    return F.when(F.rlike(flat, F.lit(f"^{_date_pattern(date_format, 2)}$")), F.try_to_date(flat, _date_pattern(date_format, 1)))


def unquote(text: Column) -> Column:
    """Percent-decoded; plus signs stay, and a text with a bad escape stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def object_key(source: Column, facet: Column, partition: Column, name: Column, file_hash: Column, ext: Column) -> Column:
    return F.concat(source, F.lit("/"), facet, F.lit("/"), partition, F.lit("/"), name, F.lit("/"), file_hash, F.lit("."), ext)


def file_path(bucket: str, key: Column) -> Column:
    return F.concat(F.lit(f"s3://{bucket}/"), key)


def key_of_path(path: Column) -> Column:
    """The object key within a bucket's path."""
    return F.regexp_extract(path, r"^[^/]*//[^/]*/(.*)$", 1)


def url_suffix(url: Column) -> Column:
    """The mark of a name that several documents share: `~` and eight digits of the URL's hash."""
    return F.concat(F.lit("~"), F.substring(F.sha2(url, 256), 1, 8))


def escape(text: Column) -> Column:
    """HTML-escaped, quotes too."""
    out = text
    for plain, entity in ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(entity))
    return out


def first_present(*values: Column) -> Column:
    """The first value that is neither null nor empty, in order of trust."""
    return F.get(F.filter(F.array(*values), lambda v: v.isNotNull() & (v != "")), F.lit(0))


def conflicting(*values: Column) -> Column:
    """Whether the present values, percent-decoded, are more than one."""
    present = F.filter(F.array(*values), lambda v: v.isNotNull() & (v != ""))
    return F.size(F.array_distinct(F.transform(present, unquote))) > 1


def flags(*pairs: tuple[Column, str]) -> Column:
    """The names whose condition holds, in order, each once."""
    return F.array_distinct(F.array_compact(F.array(*(F.when(condition, F.lit(name)) for condition, name in pairs))))


def non_empty(extras: Column) -> Column:
    """Entries of a map with a value that is not empty."""
    return F.map_filter(extras, lambda k, v: v.isNotNull() & (v != ""))
