import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkwright.functions import similarity as S
from linkwright.functions import text as T
from linkwright.operators import prepare


def values(spark, rows, column, expression):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, {column} string")
    return [r["v"] for r in df.select("i", expression.alias("v")).orderBy("i").collect()]


def test_normal_form(spark):
    rows = ["  Café & Co.  ", "O'Neil—Works", "東京商店株式会社", "Société Générale", "straße", None, ""]
    assert values(spark, rows, "t", T.normalize("t")) == ["cafe and co", "oneil works", "東京商店株式会社", "societe generale", "strasse", "", ""]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(st.characters(min_codepoint=0, max_codepoint=127, exclude_characters="\0"), max_size=20), min_size=1, max_size=20))
def test_ascii_path_agrees(spark, rows):
    assert values(spark, rows, "t", T.ascii_form("t")) == [T.normal_form(r) for r in rows]


NAMES = [
    ("xyz pvt ltd", "xyz", "private limited"),
    ("a l l p l l c", "a", "limited liability partnership limited liability company"),
    ("l l p l l c", "", "limited liability partnership limited liability company"),
    ("acme co ltd", "acme", "co ltd"),
    ("cafe and", "cafe and", ""),
    ("", "", ""),
]


def test_legal_forms(spark):
    got = values(spark, [n for n, _, _ in NAMES], "t", T.strip_legal("t"))
    for (name, _, _), row in zip(NAMES, got):
        brand, forms = name.split(), []
        while True:
            end = next((e for e in sorted(T.LEGAL_FORMS, key=lambda e: -e.count(" ")) if brand[-len(e.split()) :] == e.split()), None)
            if end is None:
                break
            forms.insert(0, T.LEGAL_FORMS[end])
            del brand[-len(end.split()) :]
        assert (row["brand"], row["legal_form"]) == (" ".join(brand), " ".join(forms)), name
    assert (got[0]["brand"], got[0]["legal_form"]) == ("xyz", "private limited")


ADDRESSES = [
    ("14 Market Street, New York", "10001", {"street_number": "14", "postal_code_normalized": "10001"}),
    ("14 Market Street, Paris", "", {"street_number": "14", "postal_code_normalized": ""}),
    ("75008 Paris Cedex 08", "", {"street_number": "", "commercial_routing": "Cedex 08"}),
    ("BP 402, 12 Rue de la Paix", "", {"street_number": "12", "commercial_routing": "BP 402"}),
    ("Near SBI ATM, Opposite Metro Pillar 42, 104 MG Road", "", {"street_number": "104", "core_address": "104 mg road"}),
    ("Rue Principale, 2A004 Ajaccio", "", {"postal_code_normalized": "2A004"}),
    ("Boulevard Paoli, 2B200 Bastia", "", {"postal_code_normalized": "2B200"}),
]


def test_addresses(spark):
    df = spark.createDataFrame([(str(i), "x", a, p) for i, (a, p, _) in enumerate(ADDRESSES)], "id string, business_name string, business_address string, postal_code string")
    got = {r["id"]: r.asDict() for r in prepare.prepare(df).collect()}
    for i, (_, _, expected) in enumerate(ADDRESSES):
        assert {k: got[str(i)][k] for k in expected} == expected
    assert {"sbi", "pillar"} <= set(got["4"]["landmark_tokens"])
    assert got["0"]["raw_address"] == ADDRESSES[0][0]


def test_soundex(spark):
    assert values(spark, ["Ashcraft", "Robert", "laxmi", "lakshmi", "42nd", "", "a"], "t", T.soundex("t")) == ["A226", "R163", "L250", "L250", "", "", "A000"]


def test_similarities(spark):
    df = spark.createDataFrame([("acme bakery", "acme baker", ["a", "b"], ["b", "c"])], "a string, b string, x array<string>, y array<string>")
    row = df.select(S.edit("a", "b").alias("e"), S.jaccard("x", "y").alias("j"), S.jaccard("x", F.array().cast("array<string>")).alias("z"), S.length_ratio("a", "b").alias("l"), S.edit("a", F.lit("")).alias("n")).first()
    assert row["e"] == pytest.approx(1 - 1 / 11) and row["j"] == pytest.approx(1 / 3) and row["z"] == 0 and row["l"] == pytest.approx(10 / 11) and row["n"] == 0


def test_chains(spark):
    df = prepare.prepare(spark.createDataFrame([(str(i), n) for i, n in enumerate(["acme ltd", "Acme inc", "acme", "other"])], "id string, business_name string"))
    assert {r["id"]: r["is_chain"] for r in prepare.flag_chains(df, df).collect()} == {"0": True, "1": True, "2": True, "3": False}
