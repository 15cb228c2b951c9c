"""Text normalisation and tokenisation.

Fixed values that define the results (they follow the spam-filter study
this library re-implements):

* URL pattern:      ``https?://\\S+|www\\.\\S+`` (case-insensitive) -> `` URL ``
* e-mail pattern:   ``\\b[\\w.+-]+@[\\w-]+\\.[\\w.-]+\\b``          -> `` CORREO ``
* number pattern:   ``\\b\\d[\\d.,]*\\b``                           -> `` NUMERO ``
* tag pattern:      ``<[^>]+>``                                   -> a space
* whitespace:       ``\\s+``                                       -> one space, then trim
* token:            two or more word characters, after lower-casing and
                    stripping accents (NFKD, combining marks dropped)

``\\w``, ``\\d``, ``\\s`` and ``\\b`` are Unicode-aware, as in the original;
Java needs the ``(?U)`` flag for that.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

URL_RE = r"(?iU)https?://\S+|www\.\S+"
MAIL_RE = r"(?U)\b[\w.+-]+@[\w-]+\.[\w.-]+\b"
NUM_RE = r"(?U)\b\d[\d.,]*\b"
TAG_RE = r"<[^>]+>"
SPACE_RE = r"(?U)\s+"
TOKEN_RE = r"[\p{L}\p{N}_]{2,}"

URL_TOKEN = " URL "
MAIL_TOKEN = " CORREO "
NUM_TOKEN = " NUMERO "


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _accent_table() -> tuple[str, str, dict[str, str]]:
    """By rule over all of Unicode: the characters whose NFKD form less its
    combining marks is one other character (from, to; combining marks
    themselves, which go, come last and have no "to"), and those for which it
    is several.  Hangul syllables follow a rule of their own."""
    src, dst, gone, several = [], [], [], {}
    for cp in (*range(0x80, 0xAC00), *range(0xD7A4, 0xD800), *range(0xE000, 0x30000)):
        ch = chr(cp)
        base = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
        if not base:
            gone.append(ch)
        elif base != ch and len(base) == 1:
            src.append(ch)
            dst.append(base)
        elif base != ch:
            several[ch] = base
    return "".join(src + gone), "".join(dst), several


ACCENT_FROM, ACCENT_TO, EXPANDED = _accent_table()
_HANGUL, _LEADS, _VOWELS, _TAILS = (0xAC00, 11172), (0x1100, 19), (0x1161, 21), (0x11A8, 27)


def _class_of(codes: list[int]) -> str:
    """A regular expression for any of the (sorted, not ASCII) code points, as ranges."""
    runs: list[list[int]] = []
    for cp in codes:
        if runs and cp == runs[-1][1] + 1:
            runs[-1][1] = cp
        else:
            runs.append([cp, cp])
    return r"[[^\x00-\x7F]&&[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs) + "]]"


_EXPANDABLE = _class_of(sorted([*map(ord, EXPANDED), *range(_HANGUL[0], sum(_HANGUL))]))


def _expanded(ch: Column) -> Column:
    """One character, as the several that it stands for."""
    leads, vowels, tails = (F.lit("".join(chr(first + i) for i in range(n))) for first, n in (_LEADS, _VOWELS, _TAILS))
    s = F.ascii(ch) - _HANGUL[0]  # the code point less that of the first syllable
    parts = F.floor(s / 588) + 1, F.floor(s % 588 / 28) + 1, s % 28
    jamo = F.concat(F.substr(leads, parts[0].cast("int"), F.lit(1)), F.substr(vowels, parts[1].cast("int"), F.lit(1)),
                    F.when(parts[2] > 0, F.substr(tails, parts[2].cast("int"), F.lit(1))).otherwise(F.lit("")))
    table = F.create_map(*[F.lit(x) for pair in EXPANDED.items() for x in pair])
    return (F.when(F.ascii(ch) < 128, ch).when((s >= 0) & (s < _HANGUL[1]), jamo)
            .otherwise(F.coalesce(F.try_element_at(table, ch), ch)))


def strip_accents(c) -> Column:
    """NFKD without combining marks, for all of Unicode; only texts that hold a character to expand are taken apart."""
    c = _c(c)
    parted = F.array_join(F.transform(F.split(c, ""), _expanded), "")
    beyond = c.rlike(r"[^\x00-\x7F]")
    expandable = c.rlike(_EXPANDABLE)
    return F.when(beyond, F.translate(F.when(expandable, parted).otherwise(c), ACCENT_FROM, ACCENT_TO)).otherwise(c)


def strip_html(c) -> Column:
    """Every tag becomes a space."""
    return F.regexp_replace(_c(c), TAG_RE, " ")


def normalize_text(c) -> Column:
    """Lower -> URL -> e-mail -> number placeholders -> collapse -> trim."""
    x = F.lower(_c(c))
    x = F.regexp_replace(x, URL_RE, URL_TOKEN)
    x = F.regexp_replace(x, MAIL_RE, MAIL_TOKEN)
    x = F.regexp_replace(x, NUM_RE, NUM_TOKEN)
    x = F.regexp_replace(x, SPACE_RE, " ")
    return F.trim(x)


def prepend_subject(subject, body) -> Column:
    """Subject + newline + body; a NULL subject counts as empty."""
    return F.concat(F.coalesce(_c(subject), F.lit("")), F.lit("\n"), F.coalesce(_c(body), F.lit("")))


def html_title(html) -> Column:
    """The ``<title>`` of a page, used as a message subject (NULL if none)."""
    t = F.regexp_extract(_c(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.when(t != "", t)


def tokens(c) -> Column:
    """Lower-case, strip accents, runs of >= 2 word characters."""
    return F.regexp_extract_all(strip_accents(F.lower(_c(c))), F.lit(TOKEN_RE), 0)
