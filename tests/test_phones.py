import pytest

from tamiz.functions import phones

# cell, numbers, valid, note
CASES = [
    ("22202870-73", "22202870; 22202873", True, "2 telefonos en una celda"),
    ("2220-1723", "22201723", True, "ok"),
    ("251-7968,232-5955", "2517968; 2325955", False,
     "formato antiguo de 7 digitos; 2 telefonos en una celda"),
    ("4764442/43/38/30", "4764442", False,
     "longitud invalida: 43, 38, 30; formato antiguo de 7 digitos"),
    ("23335736 AL 40", None, False, "rango no expandido (revision manual)"),
    ("439990 ESTX. 225-250", None, False, "incluye extension; longitud invalida: 439990"),
    ("26725,25763 Y 21568", None, False, "longitud invalida: 26725, 25763, 21568"),
    ("6361145- 6310279", "6361145; 6310279", False,
     "formato antiguo de 7 digitos; 2 telefonos en una celda"),
    ("0", None, False, "longitud invalida: 0"),
    ("-", None, False, "ok"),
    (",", None, False, "ok"),
    ("", None, False, "vacio"),
    ("2220-12345", "22212345", False, "longitud invalida: 2220"),
    ("78208583-79209143", "78208583; 79209143", True, "2 telefonos en una celda"),
    ("78391332-78395850-78395997", "78391332; 78395850; 78395997", True, "3 telefonos en una celda"),
    ("232-1011 y 251-6422", "2321011; 2516422", False,
     "formato antiguo de 7 digitos; 2 telefonos en una celda"),
    ("22334455 fax 22334456", "22334455", True, "incluye FAX"),
    ("FAX 22334455", None, False, "incluye FAX"),
    ("22334455 FAX 1 EXT 2", "22334455", True, "incluye FAX"),
    ("22334455 EXT. 12", "22334455", True, "incluye extension"),
    ("22334455 casa, 55667788", "55667788", False, "longitud invalida: 22334455 casa"),
    ("SALA 22334455", None, False, "longitud invalida: SALA 22334455"),
    ("22205283 2500774", "22205283; 2500774", False,
     "formato antiguo de 7 digitos; 2 telefonos en una celda"),
    ("22334455 ", "22334455", True, "ok"),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, t string")
    return {r["i"]: r for r in phones.clean_phones(df, "t").collect()}


@pytest.mark.parametrize("i", range(len(CASES)), ids=[repr(c[0]) for c in CASES])
def test_case(parsed, i):
    cell, numbers, valid, note = CASES[i]
    row = parsed[i]
    assert (row["t"], row["t_VALIDO"], row["t_OBSERVACION"]) == (numbers, valid, note)
    assert row["t_ORIGINAL"] == cell
    assert row["t_CANTIDAD"] == (len(numbers.split("; ")) if numbers else 0)


def test_explode(spark):
    df = spark.createDataFrame([(1, "22202870-73"), (2, "")], "id int, t string")
    assert [tuple(r) for r in phones.explode_phones(df, "id", "t").orderBy("pos").collect()] == [
        (1, 0, "22202870"), (1, 1, "22202873"),
    ]


def test_suspicious(spark):
    df = spark.createDataFrame(
        [(2, "783928"), (3, "22334455"), (4, " "), (5, "1234567890123"), (6, "2220-1723")], "n int, t string"
    )
    got = {tuple(r) for r in phones.suspicious_phones(df, "n", "t").collect()}
    assert got == {(2, "783928", 6, True), (5, "1234567890123", 13, True), (6, "2220-1723", 9, False)}
