"""Near-duplicate names inside a block (for example department + municipality).

The result is exact: every pair whose token-sort similarity reaches the
threshold is found. Rows meet through rare pieces of their names, not all
against all and not through the words that most names of a block have.

How candidates are found. For sorted-token strings r (length m) and s (length
n >= m) with similarity of at least t percent, the number of insertions and
deletions between them is at most D = floor((100 - t)(m + n) / 100). Cut s, from
its first to its last character, into D + 1 pieces or more, at any places. Walk the
pieces from the left and take the first piece at whose end the edits so far are
no more than the pieces before it: it is piece k with exactly k edits before it
and none inside. So every gram of that piece occurs unchanged in r, shifted by x places
with |x| <= k and x = k (mod 2), and at least |n - m - x| edits follow it.

The cuts are chosen so that each piece holds a gram (up to four characters)
that is rare in its block, which the gram counts of the block tell: a common
word is part of some longer piece and never a signature by itself. The counts
are held in a fixed number of hashed counters; they steer the choice of the cuts
and not the result. Signatures of s and grams of r are joined on (block, width, text,
parity, zone of places, zone of lengths); the exact shift and length conditions are part of the
join condition. Every string yields a number of rows linear in its length,
whatever the block size.

The condition also compares the letters of the two strings: 64-bit marks that
differ in no more bits than there are edits, see ``letter_marks``.

Rows with the same sorted-token text are one *form*; work on pairs of forms is
independent of how often each form occurs.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.signatures import WIDEST, piece_chooser
from ..functions.similarity import indel_similarity, letter_marks, token_sort
from ..runtime import materialize

# The five decisions, in rule order.
DECISION_MERGE = "Probable duplicado (misma direccion y telefono): candidato a fusion, revisar"
DECISION_ADDRESS = "Probable duplicado (misma direccion, nombre casi identico): revisar"
DECISION_PHONE = "Probable duplicado (mismo telefono, nombre casi identico): revisar"
DECISION_DISTINCT = "Probablemente distintos (direccion diferente): conservar ambos"
DECISION_UNCLEAR = "Indeterminado: requiere revision manual"
DECISION_PENDING = "pendiente de revision manual"
NEAR_IDENTICAL = 95.0
DEFAULT_THRESHOLD = 90
MARKS = ["letters_1", "letters_2"]
#: Hashed counters of grams.
COUNTERS = 1 << 16


def with_form_key(df: DataFrame, name: str, block: list[str]) -> DataFrame:
    """Rows that can be compared (name and block present) with ``_key``, the sorted tokens."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*block, name]])
    return df.filter(present).withColumn("_key", token_sort(F.col(name)))


def name_forms(df: DataFrame, name: str, block: list[str], row_col: str) -> DataFrame:
    """(form, block columns, key, len, rows, marks): distinct sorted-token names per block.

    ``form`` is the smallest row id of the group, hence unique. The table is
    written once, since a search reads it four times.
    """
    groups = with_form_key(df, name, block).groupBy(*block, "_key")
    return _forms(groups.agg(F.min(row_col).alias("form"), F.count("*").alias("rows")), block)


def _forms(grouped: DataFrame, block: list[str]) -> DataFrame:
    marked = grouped.select(
        "form", *block, F.col("_key").alias("key"), F.length("_key").alias("len"), "rows",
        letter_marks("_key").alias("marks"),
    )
    return materialize(marked.select("form", *block, "key", "len", "rows", "marks.*"), "forms")


def max_edits(total_length: Column, threshold: int) -> Column:
    return F.floor((100 - threshold) * total_length / 100).cast("int")


def piece_width(length: Column, threshold: int) -> Column:
    """Widest piece that still gives one piece more than the edits allowed."""
    return F.floor(length / (max_edits(2 * length, threshold) + 1)).cast("int")


def shortest_gram(length: Column, threshold: int) -> Column:
    """Width of the narrowest gram that may stand for a piece."""
    return F.least(F.lit(2), piece_width(length, threshold))


def _grams(q: Column, block: list[str], make) -> Column:
    """``make(place, gram)`` of the grams of ``q`` characters of ``key``, from the left."""
    places = F.when(F.col("len") >= q, F.sequence(F.lit(0), F.col("len") - q)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda p: make(p, F.substring(F.col("key"), p + 1, q)))


def with_pieces(forms: DataFrame, block: list[str], threshold: int) -> DataFrame:
    """The forms with ``pieces``, an array of (k, q, at): the rare gram that stands for piece k, its width and place."""
    shortest = shortest_gram(F.col("len"), threshold)
    cells = {
        f"cells_{q}": F.when(
            F.lit(q) >= shortest,
            _grams(F.lit(q), block, lambda p, gram, q=q: F.pmod(F.xxhash64(*block, F.lit(q), gram), F.lit(COUNTERS)).cast("int")),
        ).otherwise(F.array().cast("array<int>"))
        for q in range(1, WIDEST + 1)
    }
    celled = forms.select("*", *[c.alias(name) for name, c in cells.items()])
    counted = celled.select(F.explode(F.concat(*cells)).alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    counters = np.zeros(COUNTERS, dtype=np.int64)
    for row in counted.collect():  # COUNTERS rows at most
        counters[row["cell"]] = row["n"]
    choose = piece_chooser(counters)
    wanted = max_edits(2 * F.col("len"), threshold) + 1
    return celled.select(*forms.columns, choose(F.col("len"), wanted, shortest, *cells).alias("pieces"))


def _zone(value: Column, threshold: int) -> Column:
    """Places and lengths are compared by zones first: narrow ones where few edits are allowed."""
    return F.floor(value / (4 if threshold >= 85 else 16)).cast("int")


def _signature(block: list[str], q: Column, gram: Column, parity: Column, place: Column, length: Column) -> Column:
    """``place`` and ``length`` are the zones of the gram's place and of the length in the shorter text."""
    return F.xxhash64(*block, q, gram, F.pmod(parity, F.lit(2)), place, length).alias("sig")


def _piece_rows(forms: DataFrame, block: list[str], threshold: int) -> DataFrame:
    """A row for each piece of each form (the longer side of a pair), zone its gram may have moved to and zone of lengths."""
    rows = with_pieces(forms, block, threshold).select("form", "len", "key", *block, *MARKS, F.inline("pieces"))

    def zones(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(_zone(low, threshold), _zone(high, threshold)))

    rows = rows.select("*", zones(F.greatest(F.col("at") - F.col("k"), F.lit(0)), F.col("at") + F.col("k")).alias("place"))
    shortest = F.ceil(F.col("len") * threshold / (200 - threshold))  # of the lengths that so many edits allow
    rows = rows.select("*", zones(shortest, F.col("len")).alias("length"))
    gram = F.substring(F.col("key"), F.col("at") + 1, F.col("q"))
    return rows.select(
        _signature(block, F.col("q"), gram, F.col("at") - F.col("k"), F.col("place"), F.col("length")),
        F.col("form").alias("form_s"), F.col("len").alias("n"), "k", F.col("at").alias("at_s"),
        *[F.col(c).alias(f"{c}_s") for c in MARKS],
    )


def _gram_rows(forms: DataFrame, block: list[str], threshold: int) -> DataFrame:
    """A row for each gram of each form (the shorter side of a pair) that may stand for a piece of a longer one."""
    # Largest n with floor((100 - t)(m + n) / 100) >= n - m, the least edits for such lengths.
    longest = F.floor((200 - threshold) * F.col("len") / threshold).cast("int")
    narrow = F.exists(F.sequence(F.col("len"), longest), lambda n: shortest_gram(n, threshold) == 1)
    widths = F.sequence(F.when(narrow, 1).otherwise(2), F.lit(WIDEST))
    rows = forms.select("form", "len", "key", *block, *MARKS, F.explode(widths).alias("q"))
    rows = rows.filter(F.col("len") >= F.col("q")).select("*", F.explode(F.sequence(F.lit(0), F.col("len") - F.col("q"))).alias("at"))
    gram = F.substring(F.col("key"), F.col("at") + 1, F.col("q"))
    return rows.select(
        _signature(block, F.col("q"), gram, F.col("at"), _zone(F.col("at"), threshold), _zone(F.col("len"), threshold)),
        F.col("form").alias("form_r"), F.col("len").alias("m"), F.col("at").alias("at_r"),
        *[F.col(c).alias(f"{c}_r") for c in MARKS],
    )


def matches(forms: DataFrame, block: list[str], threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """(form_s, form_r) of forms that share a signature and may reach the threshold, once for each signature shared."""
    usable = forms.filter("len > 0").select("form", "key", "len", *block, *MARKS)
    pieces = _piece_rows(usable, block, threshold)
    grams = _gram_rows(usable, block, threshold)
    x = F.col("at_s") - F.col("at_r")
    gap = F.col("n") - F.col("m")
    flips = sum(F.bit_count(F.col(f"{c}_s").bitwiseXOR(F.col(f"{c}_r"))) for c in MARKS)
    allowed = (100 - threshold) * (F.col("m") + F.col("n"))
    # The exploded sides are many times larger than their estimate, which knows
    # only the table they come from: never broadcast them.
    return pieces.join(
        grams.hint("merge"),
        (pieces["sig"] == grams["sig"])
        & (
            (F.col("m") < F.col("n"))
            | ((F.col("m") == F.col("n")) & (F.col("form_s") < F.col("form_r")))
        )
        & (F.abs(x) <= F.col("k"))
        & ((x - F.col("k")) % 2 == 0)
        & (100 * (F.col("k") + F.abs(gap - x)) <= allowed)
        & (100 * flips <= allowed),
    ).select("form_s", "form_r")


def similar_forms(
    forms: DataFrame, block: list[str], threshold: int = DEFAULT_THRESHOLD
) -> DataFrame:
    """(form_a, form_b, similarity, rows_a, rows_b) of different forms at or above the threshold."""
    if not 50 < threshold <= 100:
        raise ValueError("the threshold must lie above 50 and not above 100")
    candidates = matches(forms, block, threshold).select(
        F.least("form_s", "form_r").alias("form_a"),
        F.greatest("form_s", "form_r").alias("form_b"),
    ).distinct()

    # Substitutions make the Levenshtein distance at most the Indel distance, so it
    # rules out pairs in the JVM; -1 says that it exceeds the limit.
    budget = max_edits(F.length("key_a") + F.length("key_b"), threshold)

    def side(suffix: str) -> DataFrame:
        return forms.select(
            F.col("form").alias(f"form_{suffix}"),
            F.col("key").alias(f"key_{suffix}"),
            F.col("rows").alias(f"rows_{suffix}"),
            F.struct(*block).alias(f"block_{suffix}"),
        )

    scored = (
        candidates.join(side("a"), "form_a")
        .join(side("b"), "form_b")
        .filter(F.col("block_a") == F.col("block_b"))  # a signature is only a hash
        .filter(F.call_function("levenshtein", "key_a", "key_b", budget) >= 0)
        .withColumn("similarity", indel_similarity("key_a", "key_b"))
        .filter(F.col("similarity") >= threshold)
    )
    return scored.select("form_a", "form_b", "similarity", "rows_a", "rows_b")


def not_identical(pairs: DataFrame) -> DataFrame:
    """Add the rounded score and drop pairs that round to 100."""
    return pairs.withColumn("similitud_nombre", F.bround("similarity", 1)).filter(
        F.col("similitud_nombre") < 100
    )


def same_address(a: Column, b: Column) -> Column:
    """NULL equals nothing, not even NULL."""
    return F.coalesce(a == b, F.lit(False))


def same_phone(a: Column, b: Column) -> Column:
    return F.coalesce((a == b) & (a != ""), F.lit(False))


def decide(similarity: Column, address: Column, phone: Column) -> Column:
    """The review decision for one pair; first rule that applies."""
    near = similarity >= NEAR_IDENTICAL
    return (
        F.when(address & phone, F.lit(DECISION_MERGE))
        .when(address & near, F.lit(DECISION_ADDRESS))
        .when(phone & near, F.lit(DECISION_PHONE))
        .when(~address, F.lit(DECISION_DISTINCT))
        .otherwise(F.lit(DECISION_UNCLEAR))
    )


def fuzzy_pairs(
    df: DataFrame,
    row_col: str,
    name: str = "ESTABLECIMIENTO",
    block: tuple[str, ...] = ("DEPARTAMENTO", "MUNICIPIO"),
    threshold: int = DEFAULT_THRESHOLD,
    code: str = "CODIGO", address: str = "DIRECCION", phone: str = "TELEFONO", status: str = "STATUS",
) -> DataFrame:
    """Row pairs with similar, not identical names, most similar first.

    ``decision`` is pending; :func:`with_decisions` fills it.
    """
    block = list(block)
    forms = name_forms(df, name, block, row_col)
    pairs = not_identical(similar_forms(forms, block, threshold)).select(
        "form_a", "form_b", "similitud_nombre"
    )
    rows = with_form_key(df, name, block).join(
        forms.select("form", *block, F.col("key").alias("_key")), [*block, "_key"]
    )
    member = F.struct(
        F.col(row_col).alias("i"), F.col(code).alias("c"), F.col(name).alias("n"),
        F.col(address).alias("d"), F.col(phone).alias("t"), F.col(status).alias("s"),
    )
    rows = rows.select("form", member.alias("row"))
    joined = pairs.join(rows.select(F.col("form").alias("form_a"), F.col("row").alias("_x")), "form_a")
    joined = joined.join(rows.select(F.col("form").alias("form_b"), F.col("row").alias("_y")), "form_b")
    first = F.col("_x.i") < F.col("_y.i")
    joined = joined.select(
        "similitud_nombre",
        F.when(first, F.col("_x")).otherwise(F.col("_y")).alias("a"),
        F.when(first, F.col("_y")).otherwise(F.col("_x")).alias("b"),
    )
    return joined.select(
        F.col("a.i").alias("indice_a"), F.col("b.i").alias("indice_b"),
        F.col("a.c").alias("codigo_a"), F.col("b.c").alias("codigo_b"),
        F.col("a.n").alias("establecimiento_a"), F.col("b.n").alias("establecimiento_b"),
        "similitud_nombre",
        same_address(F.col("a.d"), F.col("b.d")).alias("misma_direccion"),
        same_phone(F.col("a.t"), F.col("b.t")).alias("mismo_telefono"),
        F.col("a.s").alias("status_a"), F.col("b.s").alias("status_b"),
        F.lit(DECISION_PENDING).alias("decision"),
    ).orderBy(F.desc("similitud_nombre"), "indice_a", "indice_b")


def with_decisions(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn(
        "decision",
        decide(F.col("similitud_nombre"), F.col("misma_direccion"), F.col("mismo_telefono")),
    )


def count_similar(pairs: DataFrame) -> DataFrame:
    """Number of row pairs behind form pairs, without forming the row pairs."""
    return pairs.agg(
        F.coalesce(F.sum(F.col("rows_a") * F.col("rows_b")), F.lit(0)).alias("pares")
    )


def decision_summary(
    df: DataFrame,
    row_col: str,
    name: str = "ESTABLECIMIENTO",
    block: tuple[str, ...] = ("DEPARTAMENTO", "MUNICIPIO"),
    threshold: int = DEFAULT_THRESHOLD,
    address: str = "DIRECCION", phone: str = "TELEFONO",
) -> DataFrame:
    """Row pairs per decision, largest first.

    The pairs are counted, not listed: per form, rows are counted by address,
    by phone and by both, and the counts of the two forms of a pair multiply.
    A name that fills a third of the table costs no more than its distinct
    addresses and phones.
    """
    block = list(block)
    cells = materialize(
        with_form_key(df, name, block)
        .groupBy(*block, "_key", F.col(address).alias("d"), F.col(phone).alias("t"))
        .agg(F.count("*").alias("n"), F.min(row_col).alias("first")),
        "cells",
    )
    forms = _forms(
        cells.groupBy(*block, "_key").agg(F.min("first").alias("form"), F.sum("n").alias("rows")),
        block,
    )
    pairs = not_identical(similar_forms(forms, block, threshold)).select(
        "form_a", "form_b", "rows_a", "rows_b",
        (F.col("similitud_nombre") >= NEAR_IDENTICAL).alias("near"),
    )
    pairs = materialize(pairs, "pairs")
    cells = cells.join(forms.select("form", *block, F.col("key").alias("_key")), [*block, "_key"])
    cells = cells.select("form", "d", F.nullif(F.col("t"), F.lit("")).alias("t"), "n")

    def matches(keys: list[str], label: str) -> DataFrame:
        counts = (
            cells.dropna(subset=keys).groupBy("form", *keys).agg(F.sum("n").alias("n"))
        )
        left = counts.select(F.col("form").alias("form_a"), *keys, F.col("n").alias("n_a"))
        right = counts.select(F.col("form").alias("form_b"), *keys, F.col("n").alias("n_b"))
        return (
            pairs.join(left, "form_a")
            .join(right, ["form_b", *keys])
            .groupBy("near")
            .agg(F.sum(F.col("n_a") * F.col("n_b")).alias("n"))
            .select("near", F.lit(label).alias("kind"), "n")
        )

    every = (
        pairs.groupBy("near")
        .agg(F.sum(F.col("rows_a") * F.col("rows_b")).alias("n"))
        .select("near", F.lit("all").alias("kind"), "n")
    )
    kinds = (
        every.unionByName(matches(["d"], "address"))
        .unionByName(matches(["t"], "phone"))
        .unionByName(matches(["d", "t"], "both"))
        .groupBy("near")
        .pivot("kind", ["all", "address", "phone", "both"])
        .agg(F.sum("n"))
        .na.fill(0)
    )
    n_all, n_addr, n_phone, n_both = (F.col(c) for c in ("all", "address", "phone", "both"))
    near = F.col("near")
    counts = {
        DECISION_MERGE: n_both,
        DECISION_ADDRESS: F.when(near, n_addr - n_both).otherwise(0),
        DECISION_PHONE: F.when(near, n_phone - n_both).otherwise(0),
        DECISION_DISTINCT: F.when(near, n_all - n_addr - n_phone + n_both).otherwise(n_all - n_addr),
        DECISION_UNCLEAR: F.when(near, 0).otherwise(n_addr - n_both),
    }
    per_rule = F.array(
        *[
            F.struct(F.lit(rule).alias("decision"), n.cast("long").alias("pares"))
            for rule, n in counts.items()
        ]
    )
    return (
        kinds.select(F.inline(per_rule))
        .groupBy("decision")
        .agg(F.sum("pares").alias("pares"))
        .filter("pares > 0")
        .orderBy(F.desc("pares"), "decision")
    )
