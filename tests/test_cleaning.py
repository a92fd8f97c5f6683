import pytest
from pyspark.sql import functions as F

from tamiz.operators import expectations as ex, places
from tamiz.plans import cleaning, deliver, report, rules
from tamiz.plans.expectations import check_offices, expect_clean

CATALOG = [("Petén", "Sayaxché"), ("Guatemala", "Mixco"), ("Alta Verapaz", "Cobán")]


def school(i, **changes):
    row = dict(
        CODIGO=f"16-01-{i:04d}-46", DISTRITO="01-403", DEPARTAMENTO="PETEN", MUNICIPIO="SAYAXCHE",
        ESTABLECIMIENTO=f"LICEO {chr(65 + i)}{chr(75 + i)}", DIRECCION=f"CALLE {i}", TELEFONO="22334455",
        SUPERVISOR="ANA", DIRECTOR="EVA", NIVEL="DIVERSIFICADO", SECTOR="PRIVADO", AREA="URBANA",
        STATUS="ABIERTA", MODALIDAD="MONOLINGUE", JORNADA="DOBLE", PLAN="DIARIO(REGULAR)",
        DEPARTAMENTAL="PETÉN",
    )
    row.update(changes)
    return (i, *[row[c] for c in rules.COLUMNS])


ROWS = [
    school(0),
    school(1, DISTRITO="", DIRECTOR="---", TELEFONO=""),
    school(2, DISTRITO="01-", DEPARTAMENTO="Ciudad Capital", MUNICIPIO="Zona 3", DIRECTOR="S/D",
           DEPARTAMENTAL="GUATEMALA NORTE"),
    school(3, ESTABLECIMIENTO='"COLEGIO JOSÈ"', TELEFONO="22202870-73"),
    school(4, ESTABLECIMIENTO="COLEGIO JOSE", SUPERVISOR=" Ana​"),
    school(5, MUNICIPIO="OTRO", AREA="Urbana", ESTABLECIMIENTO="---"),
]


@pytest.fixture(scope="module")
def raw(spark):
    schema = "row_id long, " + ", ".join(f"{c} string" for c in rules.COLUMNS)
    return spark.createDataFrame(ROWS, schema)


@pytest.fixture(scope="module")
def dim(spark):
    return places.catalog_dim(spark.createDataFrame(CATALOG, "department string, municipality string"))


@pytest.fixture(scope="module")
def clean(raw, dim):
    return cleaning.clean(raw, dim, keep=["row_id"])


def test_shape_and_values(clean):
    assert clean.columns == ["row_id", *rules.COLUMNS, *rules.DERIVED]
    rows = {r["row_id"]: r for r in clean.collect()}
    assert len(rows) == len(ROWS)
    assert (rows[0]["DEPARTAMENTO"], rows[0]["MUNICIPIO"], rows[0]["MUNICIPIO_VALIDO"]) == ("PETÉN", "SAYAXCHÉ", True)
    assert (rows[1]["DISTRITO"], rows[1]["DIRECTOR"], rows[1]["TELEFONO"]) == (None, None, None)
    assert (rows[2]["DISTRITO"], rows[2]["DISTRITO_VALIDO"], rows[2]["MUNICIPIO"]) == ("01-", False, "ZONA 3")
    assert rows[3]["ESTABLECIMIENTO"] == rows[4]["ESTABLECIMIENTO"] == "COLEGIO JOSÉ"
    assert (rows[3]["TELEFONO"], rows[3]["TELEFONO_CANTIDAD"]) == ("22202870; 22202873", 2)
    assert rows[5]["ESTABLECIMIENTO"] == "---" and rows[5]["MUNICIPIO_VALIDO"] is False
    assert rows[5]["AREA"] == "URBANA"


def test_rows_without_a_name_of_their_own(raw, dim, clean):
    """The same table whether the rows have an id, or get a number on the way; repeated ids need the latter."""
    named = cleaning.clean(raw, dim, keep=["row_id"], row_col="row_id")
    assert sorted(map(tuple, named.collect())) == sorted(map(tuple, clean.collect()))
    twice = raw.unionByName(raw).drop("row_id")
    assert cleaning.clean(twice, dim).count() == 2 * len(ROWS)


def test_spellings_of_earlier_batches(spark, raw, dim):
    from tamiz.operators import unify

    first, second = raw.filter("row_id = 3"), raw.filter("row_id = 4")
    alone = cleaning.clean(second, dim, row_col="row_id", keep=["row_id"]).first()
    assert alone["ESTABLECIMIENTO"] == "COLEGIO JOSE"
    state = unify.spelling_state(cleaning.cleaned_text(first), rules.FREE_TEXT)
    later = cleaning.clean(second, dim, row_col="row_id", keep=["row_id"], spellings=state).first()
    assert later["ESTABLECIMIENTO"] == "COLEGIO JOSÉ"
    whole = unify.spelling_state(cleaning.cleaned_text(raw), rules.FREE_TEXT)
    parts = [unify.spelling_state(cleaning.cleaned_text(raw.filter(f"row_id % 2 = {i}")), rules.FREE_TEXT) for i in (0, 1)]
    assert {repr(r) for r in unify.merged_states(parts).collect()} == {repr(r) for r in whole.collect()}


def test_wide_rows_are_not_shuffled(raw, dim):
    """The clean table needs no exchange of whole rows while catalogue and replacements are small."""
    plan = cleaning.clean(raw, dim, keep=["row_id"], row_col="row_id")._jdf.queryExecution().executedPlan().toString()
    assert "TELEFONO" in plan
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "CODIGO" in line]


def test_log(raw, dim):
    aligned = cleaning.clean_aligned(raw, dim, keep=["row_id"])
    log = {r["variable"]: r for r in cleaning.transform_log(aligned, raw).collect()}
    assert list(log) == rules.COLUMNS
    want = {"CODIGO": 0, "DISTRITO": 2, "DEPARTAMENTO": 6, "MUNICIPIO": 5, "ESTABLECIMIENTO": 2,
            "DIRECCION": 0, "TELEFONO": 2, "SUPERVISOR": 0, "DIRECTOR": 2, "AREA": 1}
    assert {c: log[c]["affected"] for c in want} == want
    assert log["ESTABLECIMIENTO"]["mapped"] == 1
    assert log["DISTRITO"]["problem"] == "1 empty and 1 truncated"


def test_report(raw, dim):
    rows = report.quality_report(raw, dim, "row_id").collect()
    assert [r["metric"] for r in rows] == report.METRICS
    by = {r["metric"]: (r["before"], r["after"]) for r in rows}
    assert by["Registros"] == (6, 6) and by["Variables"] == (17, 24)
    assert by["Valores faltantes"] == (5, 4)  # a placeholder name stays text
    assert by["% faltantes"] == (4.9, 3.92)
    assert by["Errores corregidos (registros modificados)"] == (20, 0)


def test_finished_table_is_measured(raw, dim):
    """Cells that the cleaning would still change count, whatever table is looked at."""
    aligned = cleaning.clean_aligned(raw, dim, keep=["row_id"], row_col="row_id")
    spoiled = aligned.withColumn("STATUS", F.when(F.col("row_id") < 3, F.lit("Abierta ")).otherwise(F.col("STATUS")))
    spoiled = spoiled.withColumn("TELEFONO", F.when(F.col("row_id") == 4, F.lit("22-33")).otherwise(F.col("TELEFONO")))
    _, counts = report.measured(spoiled)
    assert {c: counts[f"again_{c}"] for c in rules.COLUMNS if counts[f"again_{c}"]} == {"STATUS": 3, "TELEFONO": 1}
    _, counts = report.measured(aligned)
    assert not any(counts[f"again_{c}"] for c in rules.COLUMNS) and counts["rows"] == 6


def test_published_set(spark, raw, dim, tmp_path):
    root = str(tmp_path / "out")

    def stop(number):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        deliver.publish(raw, dim, "row_id", root, before_publish=stop)
    with pytest.raises(FileNotFoundError):
        deliver.read(spark, root, "clean")
    deliver.publish(raw, dim, "row_id", root)
    assert deliver.read(spark, root, "clean").columns == ["row_id", *rules.COLUMNS, *rules.DERIVED]
    assert deliver.read(spark, root, "clean").count() == len(ROWS)
    log = deliver.read(spark, root, "transform_log").collect()
    assert {r["variable"]: r["affected"] for r in log}["DISTRITO"] == "2"
    assert all(r["problem"] and r["transformation"] and r["reason"] for r in log)
    by = {r["metric"]: (r["before"], r["after"]) for r in deliver.read(spark, root, "quality_report").collect()}
    assert by["Registros"] == ("6.0", "6.0") and len(by) == 12
    assert deliver.read(spark, root, "repeated_names").count() == 1  # the two spellings of one school
    pairs = deliver.read(spark, root, "duplicate_pairs")  # none, yet a report with a header
    assert pairs.count() == 0 and pairs.columns[:2] == ["indice_a", "indice_b"]
    assert deliver.read(spark, root, "duplicate_decisions").columns == ["decision", "pares"]
    number = deliver.publish(raw.filter("row_id < 3"), dim, "row_id", root)
    assert number == 2 and deliver.read(spark, root, "clean").count() == 3


def test_two_groups_of_departments(clean):
    def groups(df):
        return {r["grupo"]: r["consistente"] for r in check_offices(df).collect()}

    assert groups(clean) == {"GUATEMALA": True, "QUICHE": True, "consistente": True}
    office = F.when(F.col("row_id") == 0, F.lit("QUICHÉ NORTE")).otherwise(F.col("DEPARTAMENTAL"))
    assert groups(clean.withColumn("DEPARTAMENTAL", office)) == {"GUATEMALA": True, "QUICHE": False, "consistente": False}


def test_clean_table_meets_the_expectations(clean):
    result = expect_clean(clean).collect()
    assert len({(r["rule"], r["column"]) for r in result}) == len(result) == 56
    assert [tuple(r) for r in result if r["failures"]] == []
    assert all(r["sample"] == [] for r in result)


def test_raw_table_fails_them(raw):
    broken = raw.withColumn("STATUS", F.when(F.col("row_id") == 1, "abierta ").otherwise(F.col("STATUS")))
    found = {(r["rule"], r["column"]): (r["failures"], r["sample"]) for r in ex.check(
        broken, [*ex.in_domain(rules.DOMAINS), *ex.no_edge_spaces(["STATUS", "SUPERVISOR"])]).collect()}
    assert found[("domain", "STATUS")] == (1, ["abierta "])
    assert found[("domain", "AREA")] == (1, ["Urbana"])
    assert found[("domain", "SECTOR")] == (0, [])
    assert found[("edge_spaces", "STATUS")][0] == 1
    missing = ex.expect_columns(raw.drop("PLAN"), rules.COLUMNS).filter("failures > 0").collect()
    assert [r["column"] for r in missing] == ["PLAN"]
    assert ex.expect_not_empty(raw.limit(0)).first()["failures"] == 1


def test_samples_are_the_smallest_values_each_once(spark):
    rows = [(i % 40, f"bad {i % 40:02d}" if i % 2 else "12345678; 9; x") for i in range(400)]
    df = spark.createDataFrame(rows, "k int, v string")
    got = ex.check(df, [ex.has_pattern("v", "^[0-9]"), ex.not_null("k")]).collect()
    by = {r["rule"]: (r["failures"], r["sample"]) for r in got}
    assert by == {"pattern": (200, [f"bad {i:02d}" for i in range(1, 20, 2)]), "not_null": (0, [])}
    parts = ex.expect_phone_parts(df.filter("k % 2 = 0"), "v").first()
    assert (parts["failures"], parts["sample"]) == (400, ["9", "x"])
    unique = ex.expect_unique(df, "k").first()
    assert unique["failures"] == 360 and unique["sample"] == sorted(str(i) for i in range(40))[:10]
    wrong = ex.expect_boolean(df, "k").first()
    assert (wrong["failures"], wrong["sample"]) == (1, ["int"]) and ex.expect_text(df, "v").first()["failures"] == 0
    flagged = df.select("v", (F.col("k") > 0).alias("f")).withColumn("v", F.when(F.col("v") != "bad 01", F.col("v")))
    assert ex.check(flagged, [ex.flag_coherent("v", "f")]).first()["sample"] == ["true"]


def test_official_departments(spark):
    found = {r["code"]: r["official"] for r in rules.official_departments(spark).collect()}
    assert len(found) == 23 and found["17"] == "PETÉN" and found["01"] == "GUATEMALA"
