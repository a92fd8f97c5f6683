"""Multi-valued phone cells as array expressions.

A cell may hold several numbers with mixed separators, abbreviated suffixes
(``22202870-73``), fax or extension markers and ranges. Parsing runs in three
projections (text and flags, items, result columns) so that no later column
evaluates the array work again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import clean_spaces, let, normalize_text, strip

# Marker and separator patterns. U: word boundaries as in Unicode,
# on every Java version. The words go with the patterns that need them, as a
# cheap test before the regex.
FAX_MARK, FAX_WORDS = r"(?iU)\bFAX\b", ["FAX"]
EXT_MARK, EXT_WORDS = r"(?iU)\bEST[XA]?\.?\b|\bEXT\.?\b", ["EST", "EXT"]
RANGE_MARK, RANGE_WORDS = r"(?iU)\bAL\b", ["AL"]
SEPARATOR = r"(?iU)[,/]|\bY\b"
NUMBER_TOKEN = r"^[\p{Nd}\- ]+\z"
ONLY_DIGITS = r"^[0-9]+$"
PLAIN_NUMBER = r"^[0-9]{7,8}\z"
USUAL_LENGTH = r"^(?:[0-9]{7,12})?\z"

# Observation notes, in output order.
NOTE_EMPTY = "vacio"
NOTE_RANGE = "rango no expandido (revision manual)"
NOTE_FAX = "incluye FAX"
NOTE_EXT = "incluye extension"
NOTE_BAD = "longitud invalida: "
NOTE_OLD = "formato antiguo de 7 digitos"
NOTE_MANY = " telefonos en una celda"
NOTE_OK = "ok"

FULL_NUMBER_LENGTH = 6  # a dash part this long is a number by itself


def has_mark(text: Column, pattern: str, words: list[str]) -> Column:
    upper = F.upper(text)
    maybe = F.contains(upper, F.lit(words[0]))
    for word in words[1:]:
        maybe = maybe | F.contains(upper, F.lit(word))
    return maybe & text.rlike(pattern)


def _cut(state: Column, pattern: str, words: list[str]) -> Column:
    """struct(text before the mark, was the mark there)."""
    return let(
        has_mark(state, pattern, words),
        lambda found: F.struct(
            F.when(found, F.get(F.split(state, pattern, 2), F.lit(0))).otherwise(state).alias("text"),
            found.alias("found"),
        ),
    )


def phone_markers(col: Column) -> Column:
    """struct(text before the first marker, has_fax, has_ext, has_range)."""

    def flags(fax: Column, ext: Column) -> Column:
        return F.struct(
            clean_spaces(ext["text"]).alias("text"),
            fax["found"].alias("has_fax"), ext["found"].alias("has_ext"),
            F.lit(False).alias("has_range"),
        )

    no = F.lit(False)
    stop = F.struct(
        F.lit("").alias("text"), no.alias("has_fax"), no.alias("has_ext"), F.lit(True).alias("has_range")
    )
    return let(
        clean_spaces(col),
        lambda t: F.when(has_mark(t, RANGE_MARK, RANGE_WORDS), stop).otherwise(
            let(
                _cut(t, FAX_MARK, FAX_WORDS),
                lambda fax: let(
                    _cut(fax["text"], EXT_MARK, EXT_WORDS), lambda ext: flags(fax, ext)
                ),
            )
        ),
    )


def split_tokens(text: Column) -> Column:
    """Non-blank pieces between commas, slashes and the word Y, stripped."""
    pieces = F.transform(F.split(text, SEPARATOR), strip)
    return F.filter(pieces, lambda t: t != "")


def expand_dashes(sub: Column) -> Column:
    """Numbers written in one dash-joined piece, abbreviated suffixes completed."""

    def expand(parts: Column) -> Column:
        first = F.get(parts, F.lit(0))
        second = F.get(parts, F.lit(1))
        joined_length = F.length(first) + F.length(second)

        def complete(part: Column, i: Column) -> Column:
            gap = F.length(first) - F.length(part)
            # A suffix longer than the first number counts the cut from the right end.
            keep = F.when(gap >= 0, gap).otherwise(F.greatest(F.lit(0), F.length(first) + gap))
            return F.when((i == 0) | (F.length(part) >= FULL_NUMBER_LENGTH), part).otherwise(
                F.concat(F.substring(first, F.lit(1), keep), part)
            )

        return (
            F.when(F.size(parts) <= 1, parts)
            .when(F.forall(parts, lambda p: F.length(p) >= FULL_NUMBER_LENGTH), parts)
            .when(
                (F.size(parts) == 2) & joined_length.isin(7, 8) & F.length(first).isin(3, 4),
                F.array(F.concat(first, second)),
            )
            .otherwise(F.transform(parts, complete))
        )

    return let(F.filter(F.split(sub, "-"), lambda p: p != ""), expand)


def classify_items(tokens: Column) -> Column:
    """array<struct(v, ok)>: every number or rejected piece, in reading order."""

    def token_items(token: Column) -> Column:
        subs = F.filter(F.split(token, " "), lambda s: s != "")
        numbers = F.flatten(F.transform(subs, expand_dashes))
        return F.when(
            token.rlike(NUMBER_TOKEN),
            F.transform(
                numbers, lambda n: F.struct(n.alias("v"), F.length(n).isin(7, 8).alias("ok"))
            ),
        ).otherwise(F.array(F.struct(token.alias("v"), F.lit(False).alias("ok"))))

    return F.flatten(F.transform(tokens, token_items))


def phone_items(text: Column) -> Column:
    """Items of the text before the markers; one plain number needs no splitting."""
    plain = F.array(F.struct(text.alias("v"), F.lit(True).alias("ok")))
    return F.when(text.rlike(PLAIN_NUMBER), plain).otherwise(classify_items(split_tokens(text)))


def is_valid(numbers: Column, bad: Column, has_range: Column) -> Column:
    return (
        (F.size(numbers) > 0)
        & (F.size(bad) == 0)
        & ~has_range
        & F.forall(numbers, lambda n: F.length(n) == 8)
    )


def observation(
    original: Column, numbers: Column, bad: Column,
    has_fax: Column, has_ext: Column, has_range: Column,
) -> Column:
    notes = F.array(
        F.when(has_range, F.lit(NOTE_RANGE)),
        F.when(has_fax, F.lit(NOTE_FAX)),
        F.when(has_ext, F.lit(NOTE_EXT)),
        F.when(F.size(bad) > 0, F.concat(F.lit(NOTE_BAD), F.array_join(bad, ", "))),
        F.when(F.exists(numbers, lambda n: F.length(n) == 7), F.lit(NOTE_OLD)),
        F.when(
            F.size(numbers) > 1, F.concat(F.size(numbers).cast("string"), F.lit(NOTE_MANY))
        ),
    )
    text = F.array_join(notes, "; ")  # array_join skips NULL entries
    return (
        F.when(clean_spaces(original) == "", F.lit(NOTE_EMPTY))
        .when(text == "", F.lit(NOTE_OK))
        .otherwise(text)
    )


def parse_phones(df: DataFrame, col: str = "TELEFONO", into: str = "phone") -> DataFrame:
    """Add struct column ``into``: numbers, bad (arrays), has_fax, has_ext, has_range."""
    marks, items = f"{into}__marks", f"{into}__items"
    m = F.col(marks)
    parsed = F.struct(
        F.transform(F.filter(items, lambda i: i["ok"]), lambda i: i["v"]).alias("numbers"),
        F.transform(F.filter(items, lambda i: ~i["ok"]), lambda i: i["v"]).alias("bad"),
        m["has_fax"].alias("has_fax"),
        m["has_ext"].alias("has_ext"),
        m["has_range"].alias("has_range"),
    )
    return (
        df.select("*", phone_markers(F.col(col)).alias(marks))
        .select("*", phone_items(m["text"]).alias(items))
        .select(*df.columns, parsed.alias(into))
    )


def clean_phones(df: DataFrame, col: str = "TELEFONO") -> DataFrame:
    """Replace ``col`` by its joined numbers and add ORIGINAL, CANTIDAD, VALIDO, OBSERVACION."""
    p, original = F.col(f"{col}__parsed"), F.col(col)
    numbers, bad = p["numbers"], p["bad"]
    joined = F.when(F.size(numbers) > 0, F.array_join(numbers, "; ")).alias(col)
    return parse_phones(df, col, f"{col}__parsed").select(
        *[joined if c == col else F.col(c) for c in df.columns],
        original.alias(f"{col}_ORIGINAL"),
        F.size(numbers).alias(f"{col}_CANTIDAD"),
        is_valid(numbers, bad, p["has_range"]).alias(f"{col}_VALIDO"),
        observation(original, numbers, bad, p["has_fax"], p["has_ext"], p["has_range"]).alias(
            f"{col}_OBSERVACION"
        ),
    )


def explode_phones(df: DataFrame, id_col: str, col: str = "TELEFONO") -> DataFrame:
    """One row per usable number: (id, position from 0, number)."""
    parsed = parse_phones(df.select(id_col, col), col, "phone")
    # The outer form with a filter behind it keeps the parse from running twice.
    numbers = F.posexplode_outer("phone.numbers").alias("pos", "number")
    return parsed.select(id_col, numbers).filter("pos IS NOT NULL")


def suspicious_phones(df: DataFrame, row_col: str, col: str = "TELEFONO") -> DataFrame:
    """Non-empty phones that are not 7 to 12 plain digits."""
    value = normalize_text(F.col(col))
    return df.select(F.col(row_col), value.alias(col)).filter(~F.col(col).rlike(USUAL_LENGTH)).select(
        row_col,
        col,
        F.length(col).alias("length"),
        F.col(col).rlike(ONLY_DIGITS).alias("has_digits_only"),
    )
