import itertools
import random

import pytest
from pyspark.sql import functions as F

from tamiz.functions.similarity import lcs_lengths
from tamiz.operators import fuzzy



def lcs_length(a, b):
    """By the full table."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


WORDS = "COLEGIO LICEO MIXTO PRIVADO SAN JOSE LA PAZ ÑANDÚ CENTRO EDUCATIVO A BC URBANA RURAL".split()


def mutate(rnd, text):
    chars = list(text)
    for _ in range(rnd.randint(0, max(1, len(chars) // 6))):
        i = rnd.randrange(len(chars) + 1)
        if rnd.random() < 0.5 and i < len(chars) and len(chars) > 1:
            del chars[i]
        else:
            chars.insert(i, rnd.choice("ABCDE "))
    return "".join(chars)


def make_rows(seed, blocks=2, bases=15, per_block=120):
    rnd = random.Random(seed)
    rows = []
    for b in range(blocks):
        base = [" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 14))) for _ in range(bases)]
        for _ in range(per_block):
            name = mutate(rnd, mutate(rnd, rnd.choice(base))) if rnd.random() > 0.05 else rnd.choice(["", None, "X"])
            rows.append((len(rows), b if rnd.random() > 0.03 else None, name,
                         rnd.choice(["C1", "C2", "", None]), rnd.choice(["22", "33", "", None])))
    return rows


def key(name):
    return " ".join(sorted(name.split()))


def score(a, b):
    total = len(a) + len(b)
    return 100.0 if not total else 200.0 * lcs_length(a, b) / total


def brute(rows, threshold):
    out = {}
    for x, y in itertools.combinations(rows, 2):
        if x[1] is None or x[1] != y[1] or x[2] is None or y[2] is None:
            continue
        s = score(key(x[2]), key(y[2]))
        if s >= threshold and round(s, 1) < 100:
            out[(x[0], y[0])] = round(s, 1)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "i long, b int, n string, d string, t string").withColumn(
        "c", F.col("i").cast("string")
    )


ARGS = dict(name="n", block=("b",), address="d", phone="t")


@pytest.mark.parametrize("threshold", [90, 95, 80, 60])
def test_pairs_equal_brute_force(spark, threshold):
    rows = make_rows(threshold)
    got = fuzzy.fuzzy_pairs(frame(spark, rows), "i", threshold=threshold, code="c", status="c", **ARGS)
    listed = [(r["indice_a"], r["indice_b"], r["similitud_nombre"]) for r in got.collect()]
    expected = brute(rows, threshold)
    assert len(listed) == len(expected) > 0
    assert {(a, b): s for a, b, s in listed} == expected
    assert [s for _, _, s in listed] == sorted((s for _, _, s in listed), reverse=True)


def test_long_names(spark):
    rnd = random.Random(9)
    base = ["".join(rnd.choice("ABCDEFGH ") for _ in range(n)) for n in (150, 260, 400)]
    rows = [(i, 1, mutate(rnd, rnd.choice(base)), "", "") for i in range(60)]
    got = fuzzy.fuzzy_pairs(frame(spark, rows), "i", code="c", status="c", **ARGS)
    assert {(r["indice_a"], r["indice_b"]) for r in got.collect()} == set(brute(rows, 90))


def test_summary_counts_what_the_decisions_list(spark):
    rows = make_rows(3)
    df = frame(spark, rows)
    decided = fuzzy.with_decisions(fuzzy.fuzzy_pairs(df, "i", code="c", status="c", **ARGS))
    listed = {r["decision"]: r["count"] for r in decided.groupBy("decision").count().collect()}
    counted = {r["decision"]: r["pares"] for r in fuzzy.decision_summary(df, "i", **ARGS).collect()}
    assert counted == listed and len(listed) >= 4


def test_hot_name_is_one_form(spark):
    rows = [(i, 1, "LICEO MIXTO SAN JOSE", "C1", "2") for i in range(3000)]
    rows += [(3000, 1, "LICEO MIXTO SAN JOSÉ", "C1", "2"), (3001, 1, "JOSE SAN MIXTO LICEO", "C2", None)]
    df = frame(spark, rows)
    forms = fuzzy.name_forms(df, "n", ["b"], "i")
    assert forms.count() == 2
    counted = {r["decision"]: r["pares"] for r in fuzzy.decision_summary(df, "i", **ARGS).collect()}
    assert counted == {fuzzy.DECISION_MERGE: 3000, fuzzy.DECISION_DISTINCT: 1}


def test_decision_rules(spark):
    cases = [
        (91.0, True, True, fuzzy.DECISION_MERGE),
        (95.0, True, False, fuzzy.DECISION_ADDRESS),
        (95.0, False, True, fuzzy.DECISION_PHONE),
        (94.9, False, True, fuzzy.DECISION_DISTINCT),
        (94.9, True, False, fuzzy.DECISION_UNCLEAR),
    ]
    df = spark.createDataFrame(cases, "s double, a boolean, p boolean, want string")
    rows = df.withColumn("got", fuzzy.decide(F.col("s"), F.col("a"), F.col("p"))).collect()
    assert all(r["got"] == r["want"] for r in rows)


def test_threshold_range(spark):
    forms = spark.createDataFrame([], "form long, b int, key string, len int, rows long, letters_1 long, letters_2 long")
    with pytest.raises(ValueError):
        fuzzy.similar_forms(forms, ["b"], 50)


def test_every_threshold_has_enough_pieces():
    for t in range(51, 101):
        for n in range(1, 400):
            edits = (100 - t) * 2 * n // 100
            width = n // (edits + 1)
            assert width >= 1 and n // width >= edits + 1


def test_letter_marks_bound_the_edits(spark):
    from tamiz.functions.similarity import letter_marks

    rnd = random.Random(11)
    pairs = []
    for _ in range(300):
        a = "".join(rnd.choice("AÁBCDEEE Ñ1é") for _ in range(rnd.randint(1, 40)))
        pairs.append((a, mutate(rnd, mutate(rnd, a))))
    df = spark.createDataFrame(pairs, "a string, b string")
    marked = df.select("a", "b", letter_marks("a").alias("x"), letter_marks("b").alias("y"))
    flips = F.bit_count(F.col("x.letters_1").bitwiseXOR(F.col("y.letters_1"))) + F.bit_count(
        F.col("x.letters_2").bitwiseXOR(F.col("y.letters_2"))
    )
    for row in marked.select("a", "b", flips.alias("f")).collect():
        assert row["f"] <= len(row["a"]) + len(row["b"]) - 2 * lcs_length(row["a"], row["b"])


def test_lcs_of_a_batch():
    import pandas as pd

    rnd = random.Random(5)
    sizes = [0, 1, 5, 40, 63, 64, 65, 130]
    text = lambda: "".join(rnd.choice("ABCDE ÑÉ\U0001f600") for _ in range(rnd.choice(sizes)))
    pairs = [(text(), text()) for _ in range(150)]
    pairs += [(a, mutate(rnd, a)) for a, _ in pairs if a]
    a, b = (pd.Series(x) for x in zip(*pairs))
    for cells in (1, 5000, 1 << 20):
        assert lcs_lengths(a, b, cells).tolist() == [lcs_length(x, y) for x, y in pairs]
    assert lcs_lengths(a[:0], b[:0]).tolist() == []


def test_pieces_cover_what_is_asked(spark):
    rnd = random.Random(6)
    rows = [(i, 1, " ".join(sorted(rnd.choice(WORDS) for _ in range(rnd.randint(1, 9))))) for i in range(300)]
    forms = fuzzy.name_forms(spark.createDataFrame(rows, "i long, b int, n string"), "n", ["b"], "i")
    for threshold in (55, 80, 90, 100):
        for r in fuzzy.with_pieces(forms, ["b"], threshold).collect():
            edits = (100 - threshold) * 2 * r["len"] // 100
            assert [p["k"] for p in r["pieces"]] == list(range(edits + 1))
            spans = [(p["at"], p["at"] + p["q"]) for p in r["pieces"]]
            assert all(1 <= p["q"] <= 4 for p in r["pieces"]) and spans[-1][1] <= r["len"]
            assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))  # pieces, hence their grams, do not overlap


def shared_prefix(spark, n):
    """Names of one block with three common words and two or three of their own."""
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("BCDFGLMNPRST") + rnd.choice("AEIOU") for _ in range(rnd.randint(2, 4)))
    rows = [(i, 1, "ESCUELA OFICIAL RURAL " + " ".join(word() for _ in range(rnd.choice([2, 3])))) for i in range(n)]
    return fuzzy.name_forms(spark.createDataFrame(rows, "i long, b int, n string"), "n", ["b"], "i")


def test_common_words_are_no_signature(spark):
    forms = shared_prefix(spark, 4000)
    assert fuzzy.matches(forms, ["b"]).count() < 0.006 * 4000**2
    signatures = fuzzy._piece_rows(forms, ["b"], 90).join(fuzzy._gram_rows(forms, ["b"], 90).hint("merge"), "sig")
    assert signatures.count() < 0.2 * 4000**2
