import pytest
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.sources import tables


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "c string").select(column(F.col("c")).alias("v")).first()[0]


@pytest.mark.parametrize(("raw", "words"), [("l.l.c.", ["llc"]), ("A&B, Co!", ["a", "and", "b", "co"]), ("", []), ("  x y ", ["x", "y"]), ("O'Neil `s", ["oneil", "s"])])
def test_tokens(spark, raw, words):
    assert one(spark, raw, text.tokens) == words


@pytest.mark.parametrize(
    ("raw", "name", "core", "glued", "domain"),
    [
        ("blueengineeringcom", "blueengineering", "blueengineering", "blueengineering", True),
        ("The Acme Company Limited", "the acme co ltd", "acme", "acme", False),
        ("www.x-ray.com", "wwwx ray", "wwwx ray", "wwwxray", True),
        ("Limited", "ltd", "ltd", "ltd", False),
        ("Café Zoé SAS", "cafe zoe sas", "cafe zoe", "cafezoe", False),
    ],
)
def test_names(spark, raw, name, core, glued, domain):
    got = one(spark, raw, text.name_fields)
    assert (got["name_core"], got["name_ns"], got["is_domain"]) == (core, glued, domain)
    if "." not in raw:
        assert got["name_n"] == name


def test_other_scripts_become_latin(spark):
    assert one(spark, "प्रा", text.romanized).isascii()


@pytest.mark.parametrize(
    ("raw", "address", "house"),
    [
        ("286b Main Street", "286b main st", "286"), ("cs21103 bp557", "cs21103 bp557", ""), ("no169, 3rd Road", "169 3 rd", "169"), ("n14 New York", "14 ny", "14"),
        ("No. 0010 Avenue", "10 ave", "10"), ("", "", ""), ("pays de la loire", "pdl", ""), ("West Virginia 25301", "wv 25301", "25301"),
    ],
)
def test_addresses(spark, raw, address, house):
    got = one(spark, raw, lambda c: text.address_fields(text.address_tokens(c)))
    assert (got["addr_n"], got["house"], got["addr_empty"]) == (address, house, address == "")


def test_number_prefix(spark):
    for raw, wanted in (("ndeg14", "14"), ("000", "0"), ("nord", "nord"), ("a01", "a01")):
        assert one(spark, raw, text.canonical_number) == wanted


def test_states_and_keys(spark):
    assert one(spark, "tx 12 main la", text.state_set) == "tx"
    assert one(spark, "ca some road tx", text.state_set) == "ca tx"
    assert one(spark, "12 st main road", text.address_key) == "12 main"
    assert one(spark, "main", text.address_key) is None


def test_broken_encoding(spark):
    assert one(spark, "â€“ CafÃ©", tables.repaired) == "– Café"
    assert one(spark, "plain é", tables.repaired) == "plain é"


def test_equal_or_null(spark):
    rows = spark.createDataFrame([("a", "a"), ("a", "b"), ("", ""), ("a", "")], "a string, b string")
    assert [r[0] for r in rows.select(text.equal_or_null(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, None, None]
