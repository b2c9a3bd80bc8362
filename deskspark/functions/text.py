"""Text normalisation as native Spark expressions (codegen, no Python UDF)."""

from __future__ import annotations

import functools
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The cleaning patterns, applied in this order
#   1. https?://\S+|www\.\S+      -> space   (URLs)
#   2. \S+@\S+                    -> space   (e-mail like tokens)
#   3. \b[a-zA-Z]{1,6}-\d+\b      -> space   (ticket ids such as INC-1234)
#   4. \b\d{6,}\b                 -> space   (long numbers)
#   5. [^a-z0-9\s]                -> space   (anything but lower ASCII
#                                             letters, digits, whitespace)
#   6. \s+                        -> one space, then trim
# ---------------------------------------------------------------------------
CLEAN_STEPS = (
    r"https?://\S+|www\.\S+",
    r"\S+@\S+",
    r"\b[a-zA-Z]{1,6}-\d+\b",
    r"\b\d{6,}\b",
    r"[^a-z0-9\s]",
)
WHITESPACE_RUN = r"\s+"

# ---------------------------------------------------------------------------
# Transliteration of letters that have no canonical
# decomposition (ASCII spelling used by common transliterators).
# ---------------------------------------------------------------------------
NO_DECOMPOSITION = {
    "Æ": "AE", "Ð": "D", "Ø": "O", "Þ": "Th", "ß": "ss",
    "æ": "ae", "ð": "d", "ø": "o", "þ": "th",
    "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "ĸ": "q",
    "Ł": "L", "ł": "l", "Ŋ": "NG", "ŋ": "ng", "Œ": "OE", "œ": "oe",
    "Ŧ": "T", "ŧ": "t", "Ŀ": "L", "ŀ": "l", "ŉ": "'n", "×": "x", "÷": "/",
}

# Latin-1 Supplement and Latin Extended-A
_FIRST, _LAST = 0x00A0, 0x017F


def _build_transliteration():
    """Derive the one-to-one and one-to-many maps from Unicode NFKD data."""
    single: dict[str, str] = {}
    multi: dict[str, str] = {}
    for cp in range(_FIRST, _LAST + 1):
        ch = chr(cp)
        if ch in NO_DECOMPOSITION:
            target = NO_DECOMPOSITION[ch]
        else:
            dec = unicodedata.normalize("NFKD", ch)
            target = "".join(c for c in dec if not unicodedata.combining(c))
            if not target or not target.isascii() or target == ch:
                continue
        if len(target) == 1:
            single[ch] = target
        else:
            multi[ch] = target
    return single, multi


_SINGLE, _MULTI = _build_transliteration()
TRANSLATE_FROM = "".join(_SINGLE)
TRANSLATE_TO = "".join(_SINGLE.values())
MULTI_REPLACE = tuple(sorted(_MULTI.items()))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row (the optimiser would copy it to every use)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def is_ascii(c: Column) -> Column:
    """Whether a text has one byte per character; cheap, no character is decoded."""
    return F.octet_length(c) == F.length(c)


def transliterate(c: Column) -> Column:
    """Map accented Latin letters to ASCII (é -> e, ß -> ss, œ -> oe).  A text of ASCII alone stays as it is."""
    return bind(c, lambda t: F.when(is_ascii(t), t).otherwise(_transliterated(t)))


def _transliterated(c: Column) -> Column:
    for src, dst in MULTI_REPLACE:
        c = F.replace(c, F.lit(src), F.lit(dst))
    return F.translate(c, TRANSLATE_FROM, TRANSLATE_TO)


def clean_text(c: Column, remove_accents: bool = True) -> Column:
    """Ticket normaliser: null -> '', transliterate, lower, strip URLs,
    e-mails, ticket ids and long numbers, keep ``[a-z0-9 ]``, squeeze."""
    out = F.coalesce(c.cast("string"), F.lit(""))
    if remove_accents:
        out = transliterate(out)
    return bind(F.lower(out), lambda t: F.when(is_ascii(t), _cleaned_ascii(t)).otherwise(_cleaned(t)))


def _cleaned(out: Column) -> Column:
    for pat in CLEAN_STEPS:
        out = F.regexp_replace(out, "(?U)" + pat, " ")
    return F.trim(F.regexp_replace(out, "(?U)" + WHITESPACE_RUN, " "))


def _cleaned_ascii(t: Column) -> Column:
    """:func:`_cleaned` of a lower-case ASCII text, where ASCII classes suffice.  A step whose fixed characters don't occur is skipped.
    A match of the e-mail step can only begin with its token, which keeps it linear in the token's length.  The last three
    steps are one pass: in ASCII no digit is among the characters that turn into a space."""
    def step(out: Column, marks: tuple[str, ...], pat: str) -> Column:
        some = lambda x: functools.reduce(lambda a, b: a | b, [F.contains(x, F.lit(m)) for m in marks])
        return bind(out, lambda x: F.when(some(x), F.regexp_replace(x, pat, " ")).otherwise(x))

    url, mail, ticket, _, _ = CLEAN_STEPS
    out = step(t, ("://", "www."), url)
    out = step(out, ("@",), r"(?<!\S)" + mail)
    out = step(out, ("-",), ticket)
    return F.trim(F.regexp_replace(out, r"(?:[^a-z0-9]|\b\d{6,}\b)++", " "))


def words(c: Column) -> Column:
    """Whitespace tokens, like Python ``str.split()`` (empty for blank)."""
    t = F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " "))


def word_count(c: Column) -> Column:
    return F.size(words(c)).cast("long")


def char_count(c: Column) -> Column:
    return F.length(c).cast("long")


def unicode_re2(pattern: str) -> str:
    """A pattern for the oracle's engine, whose ``\\s``, ``\\S`` and ``\\d`` know ASCII alone: Unicode classes spelt out.
    Its ``\\b`` and ``\\w`` stay ASCII."""
    space = r"\s\x0B\x{85}\p{Z}"
    pattern = pattern.replace(r"[^\s]", r"\S").replace(r"\S", f"[^{space}]").replace(r"\d", r"\p{Nd}")
    out, depth = "", 0
    parts = pattern.split(r"\s")
    for i, part in enumerate(parts):
        depth += len(re.findall(r"(?<!\\)\[", part)) - len(re.findall(r"(?<!\\)\]", part))
        out += part
        if i < len(parts) - 1:
            # the classes spelt out above go on with the rest of the space characters
            known = parts[i + 1].startswith(space[2:])
            out += r"\s" if known else space if depth else f"[{space}]"
    return out


def transliterate_sql(expr: str) -> str:
    """The same transliteration as DuckDB SQL (used by the oracle)."""
    out = expr
    for src, dst in MULTI_REPLACE:
        out = f"replace({out}, '{src}', '{dst.replace(chr(39), chr(39) * 2)}')"
    return f"translate({out}, '{TRANSLATE_FROM}', '{TRANSLATE_TO}')"


def clean_text_sql(expr: str) -> str:
    out = f"lower({transliterate_sql(f'coalesce(CAST({expr} AS VARCHAR), {chr(39)}{chr(39)})')})"
    for pat in CLEAN_STEPS:
        out = f"regexp_replace({out}, '{unicode_re2(pat)}', ' ', 'g')"
    return f"trim(regexp_replace({out}, '{unicode_re2(WHITESPACE_RUN)}', ' ', 'g'))"
