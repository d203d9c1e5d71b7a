"""HTML to text, and the place name that opens an article body."""

import json
from html.entities import html5

from pyspark.sql import functions as F

NO_LOCATION = "Location not found"

# Whatever stands between two text nodes: tags, comments, unseen script/style text. Each becomes
# one mark and runs of marks one newline; repeating the group itself would recurse per tag in Java.
# A quoted attribute value may hold ">"; a quote that is never closed is an ordinary character.
_TAG_REST = r"""(?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+>"""
TAG = (
    rf"(?is)<script\b{_TAG_REST}.*?</script\s*>|<style\b{_TAG_REST}.*?</style\s*>|<!--.*?-->"
    rf"|<[!/?a-z]{_TAG_REST}"
)
TAG_MARK = "\x01"

# The named references of HTML5: those with a semicolon, and the old ones that also stand without.
ENTITIES = {name: text for name, text in html5.items() if name.endswith(";")}
LEGACY = {name: text for name, text in html5.items() if not name.endswith(";")}
_LEGACY_FIRST = "^(" + "|".join(sorted(LEGACY, key=lambda name: (-len(name), name))) + ")"  # the longest that fits

# What may follow "&" as a reference: a number, or a name with or without its semicolon.
_REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _windows(number):
    """Numbers 128 to 159 mean the characters that Windows has there, where it has one."""
    try:
        return bytes([number]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(number)


_NUMBERS = {0: "\ufffd", 13: "\r"} | {number: _windows(number) for number in range(128, 160)}

# Python's str.strip() and \s also cover the non-breaking space, hence (?U).
_EDGE_SPACE = r"(?U)^\s+|\s+\z"
_CAPS_PREFIX = r"(?U)^([A-Z\s]+):\s"


def strip_space(text):
    return F.regexp_replace(text, _EDGE_SPACE, "")


def decode_entities(text):
    """Character references as HTML5 reads them, each decoded once.

    A number may lack its semicolon, and so may the old names, also before further letters ("&notit;" is "¬it;").
    Numbers that no character has give U+FFFD or nothing; unknown names stay as they are.
    """
    # One-element arrays bind a value to a name: it is built once, however often it is used.
    return F.get(F.transform(F.array(F.split(text, "&")), _decoded), F.lit(0))


def _decoded(parts):
    # every part but the first stood after an "&", and no reference holds one
    rest = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    heads = F.array_distinct(F.transform(rest, _head))
    known = F.map_from_arrays(heads, F.transform(heads, _meaning))
    joined = F.transform(
        F.array(known),
        lambda meanings: F.transform(rest, lambda part: F.concat(F.element_at(meanings, _head(part)), F.substr(part, F.length(_head(part)) + 1))),
    )
    return F.concat(F.get(parts, F.lit(0)), F.array_join(F.get(joined, F.lit(0)), ""))


def _head(part):
    return F.regexp_extract(part, _REFERENCE, 1)


def _meaning(head):
    """What "&" and ``head`` stand for."""
    names, old = (F.from_json(F.lit(json.dumps(x)), "map<string,string>") for x in (ENTITIES, LEGACY))
    first = F.regexp_extract(head, _LEGACY_FIRST, 1)
    named = F.when(head.endswith(";"), F.element_at(names, head))
    cut = F.when(first != "", F.concat(F.element_at(old, first), F.substr(head, F.length(first) + 1)))
    return F.when(head.startswith("#"), _character(head)).otherwise(F.coalesce(named, cut, F.concat(F.lit("&"), head)))


def _character(head):
    digits = F.regexp_replace(head, "^#[xX]?0*|;", "")
    is_hex = F.lower(head).startswith("#x")
    # more digits than the last character has
    beyond = F.length(digits) > F.when(is_hex, 6).otherwise(7)
    short = F.when(beyond, "0").otherwise(digits)
    code = F.coalesce(F.conv(short, 16, 10), F.lit("0"))
    number = F.when(is_hex, code).otherwise(F.when(short == "", "0").otherwise(F.regexp_replace(short, "[a-fA-F]", "0"))).cast("int")
    table = F.from_json(F.lit(json.dumps({str(k): v for k, v in _NUMBERS.items()})), "map<string,string>")
    within = lambda low, high: number.between(low, high)
    none = within(1, 8) | (number == 11) | within(14, 31) | (number == 127) | within(0xFDD0, 0xFDEF) | (number.bitwiseAND(0xFFFE) == 0xFFFE)
    return (
        F.when(beyond | within(0xD800, 0xDFFF) | (number > 0x10FFFF), "\ufffd")
        .when((number == 0) | (number == 13) | within(128, 159), F.element_at(table, number.cast("string")))
        .when(none, "")
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
    )


def html_text(html):
    """Text nodes of ``html`` joined by newlines, outer whitespace removed."""
    marked = F.regexp_replace(html, TAG, TAG_MARK)
    return strip_space(decode_entities(F.regexp_replace(marked, f"{TAG_MARK}+", "\n")))


def page_title(html):
    return decode_entities(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def location_of(body):
    """Caps prefix before the first colon; blank if it is only whitespace."""
    return F.when(
        body.rlike(_CAPS_PREFIX), strip_space(F.regexp_extract(body, _CAPS_PREFIX, 1))
    ).otherwise(NO_LOCATION)
