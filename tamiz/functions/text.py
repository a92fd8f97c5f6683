"""Text normalisation as native Column expressions.

Raw text columns use ``''`` for "missing"; functions that accept NULL say so.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, functions as F

# Whitespace as Python's str.strip / \\s see it, as a character list and as a regex
# class that Java and RE2 read alike.
SPACE_CHARS = "".join(
    chr(cp)
    for lo, hi in (
        (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
        (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
    )
    for cp in range(lo, hi + 1)
)
SPACE = (
    r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)

# Fixed value: characters replaced by one space before spaces are collapsed
# (no-break space, zero-width space / non-joiner / joiner, word joiner, BOM, tab).
INVISIBLE = "\u00a0\u200b\u200c\u200d\u2060\ufeff\t"

# Fixed value: separators dropped, with whitespace, at both ends of free text.
EDGE_PUNCT = ",;:"

# Grave vowels and the acute vowels they stand for.
GRAVE = "àèìòùÀÈÌÒÙ"
ACUTE = "áéíóúÁÉÍÓÚ"

# Fixed value: literals that mean "no data" in the cleaning stage.
MISSING_LITERALS = [
    "N/A", "NA", "N.A", "NULL", "NONE", "SIN DATO", "SIN DATOS", "S/D", "SD", "SIN REGISTRO",
]

# Fixed value: the narrower list of the diagnosis stage.
DIAGNOSIS_PLACEHOLDERS = ["", "-", "--", "---", "----", "SIN DATO", "N/A", "NA"]

# Transliterations that are not a base letter plus a combining mark.
MULTI_CHAR_FOLDS = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th",
    "°": "deg", "«": "<<", "»": ">>", "—": "--", "…": "...",
}
SINGLE_CHAR_FOLDS = {
    "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L", "ı": "i",
    "º": "o", "ª": "a", "¹": "1", "²": "2", "³": "3", "¿": "?", "¡": "!", "·": "*",
    "´": "'", "‘": "'", "’": "'", "“": '"', "”": '"', "‐": "-", "‑": "-", "–": "-",
    "\u00a0": " ",
}


def _fold_tables() -> tuple[str, str, str]:
    """(accented letters, their ASCII base, characters that vanish).

    Derived from Unicode decompositions of the Latin blocks, so that the
    letter table is a rule and not a transcription.
    """
    src, dst = [], []
    for lo, hi in ((0x00C0, 0x024F), (0x1E00, 0x1EFF)):
        for cp in range(lo, hi + 1):
            ch = chr(cp)
            base = "".join(
                c for c in unicodedata.normalize("NFD", ch) if not unicodedata.combining(c)
            )
            if base != ch and len(base) == 1 and base.isascii():
                src.append(ch)
                dst.append(base)
    for ch, base in SINGLE_CHAR_FOLDS.items():
        src.append(ch)
        dst.append(base)
    vanish = [chr(cp) for cp in range(0x0300, 0x0370)] + list("\u200b\u200c\u200d\u2060\ufeff")
    return "".join(src), "".join(dst), "".join(vanish)


FOLD_FROM, FOLD_TO, FOLD_DROP = _fold_tables()


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, for use inside array expressions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(col: Column) -> Column:
    """Trim all Unicode whitespace at both ends."""
    return F.btrim(col, F.lit(SPACE_CHARS))


def collapse_spaces(col: Column) -> Column:
    """Runs of the space character become one."""
    return F.regexp_replace(col, " {2,}", " ")


def normalize_text(col: Column) -> Column:
    """Strip, then turn each whitespace run into one space; NULL becomes ``''``."""
    stripped = strip(F.coalesce(col, F.lit("")))
    return collapse_spaces(F.translate(stripped, SPACE_CHARS, " " * len(SPACE_CHARS)))


def is_blank(col: Column) -> Column:
    return normalize_text(col) == ""


def normalize_upper(col: Column) -> Column:
    return F.upper(normalize_text(col))


def clean_spaces(col: Column) -> Column:
    """Invisible characters to spaces, space runs collapsed, ends stripped; NULL becomes ``''``.

    Line breaks inside the text are kept, unlike in :func:`normalize_text`.
    """
    spaced = F.translate(F.coalesce(col, F.lit("")), INVISIBLE, " " * len(INVISIBLE))
    return strip(collapse_spaces(spaced))


def fix_grave_accents(col: Column) -> Column:
    return F.translate(col, GRAVE, ACUTE)


def strip_wrapping_quotes(col: Column) -> Column:
    """Drop double quotes that wrap the whole value and contain no other one."""
    return F.regexp_replace(col, rf'^"{SPACE}*([^"]*?){SPACE}*"\z', "$1")


def strip_edge_punct(col: Column) -> Column:
    """Drop commas, semicolons, colons and whitespace at both ends; a final dot stays."""
    return F.btrim(col, F.lit(SPACE_CHARS + EDGE_PUNCT))


def clean_text(col: Column) -> Column:
    """Standard free-text cleaning: spaces, grave accents, wrapping quotes, edge punctuation."""
    return strip_edge_punct(strip_wrapping_quotes(fix_grave_accents(clean_spaces(col))))


_PLACEHOLDER = r"^(?:[-.,_]*|[xX0]+|(?iu:{}))\z".format("|".join(map(re.escape, MISSING_LITERALS)))


def is_placeholder(col: Column) -> Column:
    """True for values that stand for "no data" (NULL gives NULL).

    Empty, only dashes, dots, commas or underscores, only X and 0, or one of
    the literals in any case; one regex, so that ``col`` is used once.
    """
    return strip(col).rlike(_PLACEHOLDER)


def is_diagnosis_placeholder(col: Column) -> Column:
    return normalize_upper(col).isin(DIAGNOSIS_PLACEHOLDERS)


def fold_ascii(col: Column) -> Column:
    """Latin text without accents, case kept; scripts other than Latin stay unchanged."""
    out = F.translate(col, FOLD_FROM + FOLD_DROP, FOLD_TO)
    for char, text in MULTI_CHAR_FOLDS.items():
        out = F.replace(out, F.lit(char), F.lit(text))
    return out


def fold_key(col: Column) -> Column:
    """Accent-, case- and edge-space-insensitive comparison key."""
    return F.upper(strip(fold_ascii(col)))


def normalize_category(col: Column) -> Column:
    return F.upper(clean_spaces(col))


def null_where(col: Column, condition: Column) -> Column:
    """``col`` with NULL wherever ``condition`` holds."""
    return F.when(~condition, col)
