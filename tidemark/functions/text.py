"""Text rules as Column expressions. Each is linear in the length of the text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FACTS_MARKER = "facts_json"
FENCE = "```"

# The characters that count as whitespace (ASCII blanks, the four separator controls,
# and the Unicode blanks), as a string and as a regular expression.
WHITESPACE = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
BLANK = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def facts_block(text: Column) -> Column:
    """From the first `{` behind the first facts marker to the last `}` of the text, else empty.

    Says the same as a search for marker, shortest gap, `{`, longest run, `}`, without its retries:
    when the first brace behind the first marker has no closing brace after it, no later one has.
    """
    behind_marker = F.substr(text, F.instr(text, FACTS_MARKER))
    return F.when(
        F.contains(text, F.lit(FACTS_MARKER)),
        F.regexp_extract(behind_marker, r"(?s)\A[^{]*+(\{.*\})", 1),
    ).otherwise("")


def is_json(block: Column) -> Column:
    """Whether the block is one JSON value from end to end, however long it is.

    The parser refuses very long strings and numbers and is lax about quotes, so it gets the block's
    skeleton: escapes and then whole strings replaced, the digits of long numbers shortened. What is
    left of a quote, apostrophe or backslash was not part of a proper string. The parser stops behind
    the first value, so the skeleton goes in as the head of a list whose second item is its own digest:
    only if nothing ended the list or added to it does the digest come out in second place.
    """
    plain = F.regexp_replace(block, r'\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})', "x")
    strings = F.regexp_replace(plain, r'"[^"\x00-\x1f\\]*+"', '"s"')
    skeleton = F.regexp_replace(strings, r"([0-9]{2})[0-9]{30,}+", "$1")
    digest = F.sha2(skeleton, 256)
    pair = F.concat(F.lit("["), skeleton, F.lit(',"'), digest, F.lit('"]'))
    stray = F.rlike(F.replace(skeleton, F.lit('"s"'), F.lit("")), F.lit(r"""["'\\]"""))
    return F.coalesce((F.get_json_object(pair, "$[1]") == digest) & ~stray, F.lit(False))


def plain_decimal(value: Column) -> Column:
    """A fraction's shortest digits without an exponent or closing zeros: `0.0004`, `1`.

    The digits are moved as text, so neither size nor session settings matter. What is no finite number is
    NULL, as JSON has no word for it.
    """
    written = F.abs(value).cast("string")
    exponent = F.coalesce(F.regexp_extract(written, r"E(-?\d+)$", 1).try_cast("int"), F.lit(0))
    whole, part = F.regexp_extract(written, r"^(\d+)", 1), F.regexp_extract(written, r"\.(\d+)", 1)
    digits, point = F.concat(whole, part), F.length(whole) + exponent
    # Zeros on either side, so that the point always falls among the digits.
    before, after = F.greatest(-point, F.lit(0)), F.greatest(point - F.length(digits), F.lit(0))
    padded = F.concat(F.repeat(F.lit("0"), before), digits, F.repeat(F.lit("0"), after))
    split = point + before
    head = F.ltrim(F.substr(padded, F.lit(1), split), F.lit("0"))
    tail = F.rtrim(F.substr(padded, split + 1), F.lit("0"))
    text = F.concat(F.when(head == "", "0").otherwise(head), F.when(tail == "", "").otherwise(F.concat(F.lit("."), tail)))
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return F.when(finite, F.concat(F.when(value < 0, "-").otherwise(""), text))


def without_facts_section(text: Column) -> Column:
    """Up to the marker in any spelling. The case-blind search runs only where the marker may be."""
    marked = F.contains(F.lower(text), F.lit(FACTS_MARKER)) | F.rlike(text, F.lit("[\u017f\u212a]"))
    return F.when(marked, F.regexp_replace(text, rf"(?isu){FACTS_MARKER}.*", "")).otherwise(text)


def without_json_fences(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?isu){FENCE}json.*?{FENCE}", "")


def without_fences(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?s){FENCE}.*?{FENCE}", "")


def real_line_breaks(text: Column) -> Column:
    """Line breaks that were written out as a backslash and an n."""
    return F.replace(text, F.lit("\\n"), F.lit("\n"))


def single_blank_lines(text: Column) -> Column:
    return F.regexp_replace(text, rf"\n{BLANK}*\n", "\n\n")


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))
