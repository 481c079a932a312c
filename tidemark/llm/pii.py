"""Personal data with offset-preserving deobfuscation.

Four kinds are found in the text as it is: e-mail addresses, IP addresses, card numbers and phone numbers,
each kind leftmost and without overlaps, checked (parts up to 255, Luhn, number of digits), failing ones
dropped. These base spans always stay.

Texts that show a trace of disguise also go through transducers that write normalised characters, each
with the source characters it stands for: look-alike letters and digits of other scripts become ASCII and
invisible characters nothing; spelled digits ("five", "plus", "point"), alone or between written ones, become
digits in runs of at least seven signs; "(at)", "[dot]", "[.]" and plain " at ", " dot " become "@" and "." where
together they make an address.
The same four kinds are then looked for in the normalised text, and what is found is mapped back to
source characters; it is added unless a base span already covers it.

Null text counts as empty; every row has its own result, also with a missing or repeated id; other columns
are not looked at. Each pattern reads a text once, however long its runs of digits or letters are.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# Letters of other scripts that look like ASCII ones, written below each other.
LOOK_ALIKES = dict(
    zip(
        "аВесԁЕһНіІјЈкКӏМоОрРԛѕЅТуУхХԝ" + "αΑΒεΕΗιΙκΚΜνΝοΟρΡΤυΥχΧΖ",
        "aBecdEhHiIjJkKlMoOpPqsSTyYxXw" + "aABeEHiIkKMvNoOpPTuYxXZ",
        strict=True,
    )
)
# Characters without width.
INVISIBLE = "­​‌‍⁠﻿"

# Digits spelled in the languages of the corpus, and signs spelled between them.
SPELLED = {
    "0": "zero oh null zéro cero",
    "1": "one eins un uno",
    "2": "two zwei deux dos",
    "3": "three drei trois tres",
    "4": "four vier quatre cuatro",
    "5": "five fünf cinq cinco",
    "6": "six sechs seis",
    "7": "seven sieben sept siete",
    "8": "eight acht huit ocho",
    "9": "nine neun neuf nueve",
    ".": "dot point punkt punto",
    "+": "plus",
}
SAID = {word: sign for sign, words in SPELLED.items() for word in words.split()}
DIGIT_WORDS = {word for word, sign in SAID.items() if sign.isdigit()}

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

WORD = "|".join(sorted(SAID, key=len, reverse=True))
SPELLED_RUN = re.compile(rf"(?<!\w)(?:(?:{WORD}|[0-9]++)[\s,-]++)+(?:{WORD}|[0-9]++)(?!\w)", re.I)
SPELLED_LEAST = 7
SPELLED_SIGN = re.compile(rf"{WORD}|[0-9]", re.I)
AT = r"(?:\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*|\s+at\s+|\s*@\s*)"
DOT = r"(?:\s*[\[({<]\s*(?:dot|punkt|point|punto|\.)\s*[\])}>]\s*|\s+(?:dot|punkt|point|punto)\s+|\.)"
NAME = r"[A-Za-z0-9_%+-]{1,64}"
ADDRESS = re.compile(rf"(?<![\w.%+-])({NAME}(?:{DOT}{NAME}){{0,4}})({AT})({NAME}(?:{DOT}{NAME}){{1,6}})(?!\w)", re.I)
# Last labels that make words around a plain "at" an address when its dots are plain too: the
# countries' and some others.
ENDINGS = set(
    """com org net edu gov mil int info biz name pro io app dev tech online shop site cloud email xyz example test invalid
    ac ad ae af ag ai al am ao aq ar as at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bv bw by bz ca cc cd
    cf cg ch ci ck cl cm cn co cr cu cv cw cx cy cz de dj dk dm do dz ec ee eg er es et eu fi fj fk fm fo fr ga gb gd ge
    gf gg gh gi gl gm gn gp gq gr gs gt gu gw gy hk hm hn hr ht hu id ie il im in io iq ir is it je jm jo jp ke kg kh ki
    km kn kp kr kw ky kz la lb lc li lk lr ls lt lu lv ly ma mc md me mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx my
    mz na nc ne nf ng ni nl no np nr nu nz om pa pe pf pg ph pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd se
    sg sh si sj sk sl sm sn so sr ss st su sv sx sy sz tc td tf tg th tj tk tl tm tn to tr tt tv tw tz ua ug uk us uy uz
    va vc ve vg vi vn vu wf ws ye yt za zm zw""".split()
)
# Words that stand around a plain "at" in sentences, and are no names.
FUNCTION_WORDS = set(
    """a an and any are be but by each every for from he her his i in into is it its my no not of on one or our out she so
    some that the their them then there these they this those to up us was we were what which who with you your""".split()
)
AT_OR_DOT = re.compile(rf"(?P<at>{AT})|(?P<dot>{DOT})", re.I)
#: A trace of a disguised address: any sign for "at" or "dot" but "@" and "." without space or brackets.
TRACE = re.compile(
    r"[\[({<]\s*(?:at|@|dot|punkt|point|punto|\.)\s*[\])}>]|\s(?:at|dot|punkt|point|punto)\s|\s@|@\s", re.I
)
DISGUISED_DOT = re.compile(r"[\[({<]\s*(?:dot|punkt|point|punto|\.)\s*[\])}>]|\s(?:dot|punkt|point|punto)\s", re.I)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each "@" back over the characters of a local part and on over a domain."""
    behind, at = 0, text.find("@")
    while at >= 0:
        start = at - len(text[behind:at]) + len(text[behind:at].rstrip(LOCAL))
        behind = at + 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            behind = domain.end()
        at = text.find("@", at + 1)


def ip_fits(found: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in found.split("."))


def card_fits(found: str) -> bool:
    digits = re.sub(r"[^0-9]", "", found)
    return 14 <= len(digits) <= 19 and luhn(digits)


def phone_fits(found: str) -> bool:
    return 10 <= len(re.sub(r"[^0-9]", "", found)) <= 15


PATTERNS: list[tuple[str, re.Pattern, Callable[[str], bool]]] = [
    ("ip", IP, ip_fits),
    ("card", CARD, card_fits),
    ("phone", PHONE, phone_fits),
]


def base_spans(text: str) -> list[Span]:
    """Spans of all kinds, by start and then kind as listed."""
    found = [("email", *span) for span in emails(text)]
    for kind, pattern, fits in PATTERNS:
        found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if fits(m.group())]
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def ascii_of(char: str) -> str:
    """A look-alike as ASCII, an invisible character as nothing, others as they are."""
    if char < "­":
        return char
    if char in LOOK_ALIKES:
        return LOOK_ALIKES[char]
    if char in INVISIBLE:
        return ""
    if "！" <= char <= "～":  # full-width forms of ASCII
        return chr(ord(char) - 0xFEE0)
    digit = unicodedata.decimal(char, None)
    return char if digit is None else str(digit)


class Normalised:
    """A text with, for each character, the source characters start..end that it stands for."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, list(range(len(text))), list(range(1, len(text) + 1))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace runs (start, end, by) of the text, in order; what replaces stands for all of its run."""
        text, starts, ends, done = [], [], [], 0
        for start, end, by in edits:
            text += [self.text[done:start], by]
            starts += self.starts[done:start] + [self.starts[start]] * len(by)
            ends += self.ends[done:start] + [self.ends[end - 1]] * len(by)
            done = end
        self.text = "".join(text) + self.text[done:]
        self.starts, self.ends = starts + self.starts[done:], ends + self.ends[done:]

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self.starts[start], self.ends[end - 1]


def fold_look_alikes(text: Normalised) -> None:
    text.rewrite(
        [(i, i + 1, ascii_of(char)) for i, char in enumerate(text.text) if char >= "­" and ascii_of(char) != char]
    )


def fold_spelled(text: Normalised) -> None:
    edits = []
    for run in SPELLED_RUN.finditer(text.text):
        signs = list(SPELLED_SIGN.finditer(text.text, run.start(), run.end()))
        if len(signs) < SPELLED_LEAST or not any(m.group().lower() in DIGIT_WORDS for m in signs):
            continue
        done = run.start()
        for m in signs:
            if m.start() > done:
                edits.append((done, m.start(), ""))
            edits.append((m.start(), m.end(), SAID.get(m.group().lower(), m.group())))
            done = m.end()
    text.rewrite(edits)


def is_address(local: str, at: str, domain: str) -> bool:
    """Whether what ADDRESS found is one in disguise; a plain "at" is a word of sentences too."""
    if re.search(r"[\[({<]", at):
        return True
    if at == "@":
        return DISGUISED_DOT.search(local) is not None or DISGUISED_DOT.search(domain) is not None
    names = [name.lower() for name in re.split(DOT, domain, flags=re.I)]
    last = domain[-len(names[-1]) :]
    if not last.isalpha() or len(last) < 2 or names[0] in FUNCTION_WORDS:
        return False
    if DISGUISED_DOT.search(domain):
        return last.lower() in ENDINGS or last.lower() not in FUNCTION_WORDS
    return last.lower() in ENDINGS and (last.islower() or last.isupper()) and local.lower() not in FUNCTION_WORDS


def address_edits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    if TRACE.search(text) is None:
        return edits
    for m in ADDRESS.finditer(text):
        if is_address(*m.groups()) and not text[m.end() : m.end() + 1] == "@":
            for sign in AT_OR_DOT.finditer(text, m.start(), m.end()):
                edits.append((sign.start(), sign.end(), "@" if sign.lastgroup == "at" else "."))
    return edits


def fold_addresses(text: Normalised) -> None:
    text.rewrite(address_edits(text.text))


def disguised(text: str) -> bool:
    """Whether a text shows what the transducers undo."""
    if not text.isascii() and any(ascii_of(char) != char for char in set(text)):
        return True
    return _spelled(text) or bool(address_edits(text))


def _spelled(text: str) -> bool:
    words = set(re.split(r"\W+", text.lower()))
    return bool(DIGIT_WORDS & words) and SPELLED_RUN.search(text) is not None


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and those that the method adds."""
    base = base_spans(text)
    if not disguised(text):
        return base, []
    plain = Normalised(text)
    for fold in (fold_look_alikes, fold_spelled, fold_addresses):
        fold(plain)
    if plain.text == text:
        return base, []
    added = {(kind, *plain.source(start, end)) for kind, start, end in base_spans(plain.text)}
    added = {(k, a, b) for k, a, b in added if not any(start <= a and b <= end for _, start, end in base)}
    return base, sorted(added, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
)


def spans(text: Column) -> Column:
    """All spans as array<struct<kind, start, end, base>> by start and kind; code points, end exclusive."""

    @F.arrow_udf("array<struct<kind string, start int, end int, base boolean>>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for one in batch.to_pylist():
                base, added = all_spans(one or "")
                marked = [(*span, True) for span in base] + [(*span, False) for span in added]
                marked.sort(key=lambda span: (span[1], KINDS.index(span[0]), span[2]))
                rows.append([dict(zip(("kind", "start", "end", "base"), span)) for span in marked])
            yield pa.array(rows, SPAN_TYPE)

    return found(text)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans: one row for each row of `docs`."""
    return docs.select(F.col(id_col).alias("doc_id"), spans(F.col(text_col)).alias("spans"))


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with every span, base or added, replaced by its kind in brackets; null stays null."""

    @F.arrow_udf("string")
    def mask(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for one in batch.to_pylist():
                base, added = all_spans(one or "")
                parts, done = [], 0
                for kind, start, end in sorted(base + added, key=lambda span: (span[1], -span[2])):
                    if start >= done:
                        parts += [one[done:start], f"[{kind}]"]
                    done = max(done, end)
                rows.append(None if one is None else "".join(parts) + one[done:])
            yield pa.array(rows, pa.string())

    return docs.select(F.col(id_col).alias("doc_id"), mask(F.col(text_col)).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_<kind> and base_sha256 of the base spans, n_added, and all spans as text."""

    def joined(some: Column) -> Column:
        line = F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(line, ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    counts = [count(kind) for kind in KINDS]
    added = F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added")
    return found.select(
        "doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), added
    )
