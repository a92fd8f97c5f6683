import pandas as pd
from pyspark.sql import functions as F

from tamiz.functions import codes, text
from tamiz.functions.similarity import indel_similarity, lcs_lengths, token_sort


def test_normalize_text(one):
    assert one(text.normalize_text, ["  a \t  b\n", None, " ", "a\x1cb"]) == ["a b", "", "", "a b"]


def test_clean_spaces_splits_at_invisible_characters_and_keeps_line_breaks(one):
    values = ["JO​SE", "﻿ a  b ", "a\n b", None, "⁠", "a\t\tb"]
    assert one(text.clean_spaces, values) == ["JO SE", "a b", "a\n b", "", "", "a b"]


def test_grave_accents(one):
    assert one(text.fix_grave_accents, ["àèìòù ÀÈÌÒÙ", "ñ"]) == ["áéíóú ÁÉÍÓÚ", "ñ"]


def test_wrapping_quotes(one):
    values = ['"LICEO LA SALLE"', 'COLEGIO "LA PATRIA"', '"A" Y "B"', '""', '"', '"  x "', '"a\nb"']
    assert one(text.strip_wrapping_quotes, values) == [
        "LICEO LA SALLE", 'COLEGIO "LA PATRIA"', '"A" Y "B"', "", '"', "x", "a\nb",
    ]


def test_edge_punctuation(one):
    values = ["CATALINA PERALTA CARRILLO,", "10A. AVENIDA 2-24, ;", ": ZONA 4.", ",;", "a,b"]
    assert one(text.strip_edge_punct, values) == [
        "CATALINA PERALTA CARRILLO", "10A. AVENIDA 2-24", "ZONA 4.", "", "a,b",
    ]


def test_clean_text_is_not_idempotent(one):
    first = one(text.clean_text, [',"A",', ' "LICEO  JOSÈ" '])
    assert first == ['"A"', "LICEO JOSÉ"]
    assert one(text.clean_text, first) == ["A", "LICEO JOSÉ"]


def test_idempotent_cleaners(one):
    values = ["  a​ b ", "è", ",;x;", "a  B"]
    for fn in (text.clean_spaces, text.fix_grave_accents, text.strip_edge_punct, text.normalize_category):
        once = one(fn, values)
        assert one(fn, once) == once


def test_placeholder(one):
    yes = ["", "  ", "---", ".", "._,", "xXX", "0", "x0", "n/a", " S/D ", "Sin Registro", "N.A"]
    no = ["A", "NxA", "1", "-a-", "SIN", "N/A.", "00 1", "a\n-"]
    assert one(text.is_placeholder, yes) == [True] * len(yes)
    assert one(text.is_placeholder, no) == [False] * len(no)
    assert one(text.is_placeholder, [None]) == [None]


def test_diagnosis_placeholder_is_narrower(one):
    assert one(text.is_diagnosis_placeholder, ["--", "na", "S/D", ".", " "]) == [True, True, False, False, True]


def test_fold(one):
    values = ["Ñandú", " straße ", "Ærø", "1º “x”", "é", "Ш"]
    assert one(text.fold_key, values) == ["NANDU", "STRASSE", "AERO", '1O "X"', "E", "Ш"]


def test_district_classes(one):
    values = ["01-01-0001", "01-403", "01-", "", "S/N", " 01-403 ", "01-4033"]
    assert one(codes.classify_format, values) == [
        "detallado", "corto", "incompleto", "vacio", "formato_no_reconocido", "corto",
        "formato_no_reconocido",
    ]
    assert one(codes.district_value, ["", " 01- "]) == [None, "01-"]


def test_token_sort_and_lcs(one):
    assert one(token_sort, ["b  a C", "", " x "]) == ["C a b", "", "x"]
    a, b = pd.Series(["AGCAT", "", "abc"]), pd.Series(["GAC", "abc", "abc"])
    assert lcs_lengths(a, b).tolist() == [2, 0, 3]


def test_similarity_udf(spark):
    df = spark.createDataFrame([("ab", "ab"), ("", ""), ("a", ""), ("abcd", "abxd")], "a string, b string")
    got = [r[0] for r in df.select(indel_similarity(F.col("a"), F.col("b"))).collect()]
    assert got == [100.0, 100.0, 0.0, 75.0]
