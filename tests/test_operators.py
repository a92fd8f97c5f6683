import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tamiz.functions.text import fold_ascii
from tamiz.operators import consistency, duplicates, places, profile, repeated, unify
from tamiz.sources.tables import number_rows


def test_unify_prefers_most_upper_case_acute_vowels(spark):
    names = ["JOSE LEON", "JOSÉ LEON", "JOSÉ LEÓN", None, "ANA", "MUÑOZ LOPEZ", "MUNOZ LÓPEZ"]
    df = spark.createDataFrame(list(enumerate(names)), "i int, n string")
    got = [r["n"] for r in unify.unify_variants(df, "n").orderBy("i").collect()]
    assert got == ["JOSÉ LEÓN"] * 3 + [None, "ANA", "MUNOZ LÓPEZ", "MUNOZ LÓPEZ"]
    mapping = {r["variant"]: r["canonical"] for r in unify.variant_map(df, "n").collect()}
    assert mapping == {
        "JOSE LEON": "JOSÉ LEÓN", "JOSÉ LEON": "JOSÉ LEÓN", "MUÑOZ LOPEZ": "MUNOZ LÓPEZ",
    }


def test_unify_leaves_one_variant_per_key(spark):
    rnd = random.Random(1)
    names = ["".join(rnd.choice("AÁEÉNÑ") for _ in range(3)) for _ in range(400)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    out = unify.unify_variants(df, "n")
    assert out.count() == 400
    assert out.groupBy(fold_ascii(F.col("n"))).agg(F.countDistinct("n").alias("k")).filter("k > 1").count() == 0


def test_places(spark):
    catalog = spark.createDataFrame(
        [("Petén", "Sayaxché"), ("Petén", "Flores"), ("Guatemala", "Mixco")],
        "department string, municipality string",
    )
    rows = [
        (0, " peten", "SAYAXCHE ", "PETÉN", "SAYAXCHÉ", True, True),
        (1, "PETÉN", "Mixco", "PETÉN", "MIXCO", False, True),
        (2, "Ciudad Capital", "zona 25", "CIUDAD CAPITAL", "ZONA 25", True, True),
        (3, "CIUDAD CAPITAL", "ZONA 26", "CIUDAD CAPITAL", "ZONA 26", False, True),
        (4, "Atlántida", "Flores", "ATLANTIDA", "FLORES", False, False),
        (5, "GUATEMALA", " Mixco", "GUATEMALA", "MIXCO", True, True),
    ]
    df = spark.createDataFrame([r[:3] for r in rows], "i int, DEPARTAMENTO string, MUNICIPIO string")
    dim = places.catalog_dim(catalog)
    out = places.standardize_places(df, dim, department_flag="ok").orderBy("i").collect()
    got = [(r["DEPARTAMENTO"], r["MUNICIPIO"], r["MUNICIPIO_VALIDO"], r["ok"]) for r in out]
    assert got == [r[3:] for r in rows]


def test_profile_ties_and_empty_columns(spark):
    df = spark.createDataFrame(
        [(2, "b", ""), (3, "a", " "), (4, "a", ""), (5, "b", ""), (6, "", "")], "n int, x string, y string"
    )
    got = {r["column"]: tuple(r)[2:] for r in profile.profile_columns(df, ["x", "y"], "n").collect()}
    assert got == {"x": (2, 4, "b", 2), "y": (0, 0, "", 0)}
    missing = [tuple(r) for r in profile.missing_report(df, ["x", "y"]).collect()]
    assert missing == [("y", 5, 100.0, 0), ("x", 1, 20.0, 4)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "n int, x string")
    assert [tuple(r) for r in profile.missing_report(df, ["x"]).collect()] == [("x", 0, 0.0, 0)]
    assert tuple(duplicates.count_duplicates(df, ["x"]).first()) == (0, 0)
    assert [r["cantidad"] for r in profile.duplicate_summary(df, ["x"], "x").collect()] == [0, 0, 0]


def test_duplicates_treat_null_as_equal(spark):
    rows = [(0, "a", None), (1, "a", None), (2, "a", "x"), (3, "a", None), (4, None, None)]
    df = spark.createDataFrame(rows, "i int, x string, y string")
    flags = duplicates.flag_duplicates(df, ["x", "y"], "i").orderBy("i").collect()
    assert [(r["duplicated"], r["seen_before"]) for r in flags] == [
        (True, False), (True, True), (False, False), (True, True), (False, False),
    ]
    assert tuple(duplicates.count_duplicates(df, ["x", "y"]).first()) == (3, 2)


def test_repeated_names_and_codes(spark, monkeypatch):
    rows = [(i, "D", "M", "N", f"A{i % 3}", "S", "J", "P", f"c{i}") for i in range(50)]
    rows += [(50, "D", "M", "ONE", "A", "S", "J", "P", "c50"), (51, None, "M", "N", "A", "S", "J", "P", "x")]
    df = spark.createDataFrame(
        rows, "i long, DEPARTAMENTO string, MUNICIPIO string, ESTABLECIMIENTO string, DIRECCION string, "
        "STATUS string, JORNADA string, PLAN string, CODIGO string")
    (row,) = repeated.repeated_names(df, "i").collect()
    whole = "; ".join(f"c{i}" for i in range(50))
    assert (row["registros"], row["direcciones_distintas"], row["codigos"]) == (50, 3, whole)
    monkeypatch.setattr(repeated, "CHUNK", 7)
    rows = repeated.repeated_names(df, "i").collect()
    assert {r["registros"] for r in rows} == {50} and [r["parte"] for r in rows] == list(range(8))
    assert "; ".join(r["codigos"] for r in rows) == whole
    parts = repeated.repeated_codes(df, "i").orderBy("part").collect()
    assert "; ".join(p["codigos"] for p in parts) == whole and len(parts) == 8


def test_dependency_check(spark):
    groups = {"G": (["A"], ["A1", "A2"])}
    schema = "DEPARTAMENTO string, DEPARTAMENTAL string"
    good = spark.createDataFrame([("A", "A1"), ("B", "B")], schema)
    bad = spark.createDataFrame([("A", "A1"), ("B", "A2")], schema)
    none = spark.createDataFrame([], schema)

    def verdict(df):
        return [r["consistente"] for r in consistency.dependency_check(df, groups).collect()]

    assert verdict(good) == [True, True]
    assert verdict(bad) == [False, False]
    assert verdict(none) == [True, True]


def test_number_rows_over_chunks(spark):
    rnd = random.Random(4)
    rows = [(s, p) for s, n in (("b", 57), ("a", 300), ("c", 1)) for p in rnd.sample(range(2000), n)]
    df = spark.createDataFrame(rows, "s string, p long").repartition(5)
    got = {(r["s"], r["p"]): r["row_number"] for r in number_rows(df, "s", "p", chunk=64).collect()}
    assert got == {k: i for i, k in enumerate(sorted(rows), 2)}


def test_catalog_validation_lists_every_value(spark):
    rows = [(f"a{i}", "u") for i in range(1500)] + [("ok", "v"), ("ok", "ok")]
    df = spark.createDataFrame(rows, "x string, y string")
    ok = profile.value_list(df, ["OK"])
    report = profile.catalog_validation(df, {"x": ["OK"]}, {"y": ok})
    got = [tuple(r) for r in report.select("column", "unexpected_value", "unexpected_count").collect()]
    assert got == [("x", v, 1500) for v in sorted(f"A{i}" for i in range(1500))] + [("y", "U", 2), ("y", "V", 2)]
    clean = profile.catalog_validation(df.filter("x = 'ok'"), {"x": ["OK"]}, {})
    assert [tuple(r) for r in clean.collect()] == [("x", "OK", "", 0)]


def test_value_counts_match_counter(spark):
    values = ["a", " a", "b  c", "b c", None]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = {r["value"]: r["n"] for r in profile.value_counts(df, "x").collect()}
    assert got == Counter({"a": 2, "b c": 2, "": 1})
    assert defaultdict(int, got)["zz"] == 0
