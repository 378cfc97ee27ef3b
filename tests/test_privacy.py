"""Masking: expected texts written out by hand."""

import pytest
from pyspark.sql import functions as F

from granary.functions import privacy
from granary.sources.contracts import CUSTOMERS

CASES = [
    ("Contact: john.doe@company.com", "Contact: j***@c***.com"),
    ("Call me at +55 11 99999-8888", "Call me at +55 119******88"),
    ("CPF: 123.456.789-00", "CPF: 123******00"),
    ("bare 12345678901 number", "bare 123******01 number"),
    ("Card: 4111-2222-3333-4444", "Card: **** **** **** 4444"),
    ("4111 2222 3333 4444", "**** **** **** 4444"),
    ("host 10.0.0.1 up", "host 100** up"),
    ("host 192.168.100.20 up", "host 192******20 up"),
    ("a@b.co", "***@***.co"),
    ("ana1@mail.com.br, BOB.X@Site.Org!", "a***@m***.combr, B***@S***.Org!"),
    ("joão@site.com stays, as its name has an accent", "joão@site.com stays, as its name has an accent"),
    ("This is a normal message without PII.", "This is a normal message without PII."),
    ("", ""),
    (None, None),
]
STRICT = [
    ("host 192.168.100.20 up", "host 192******** up"),
    ("ana1@mail.com.br", "a***@m***.com.br"),
    ("+55 11 99999-8888", "551********88"),
    ("Card: 4111-2222-3333-4444", "Card: **** **** **** 4444"),
]


@pytest.mark.parametrize("strict,cases", [(False, CASES), (True, STRICT)])
def test_texts(spark, strict, cases):
    df = spark.createDataFrame([(j, t) for j, (t, _) in enumerate(cases)], "j int, t string")
    got = dict(df.select("j", privacy.mask_text("t", strict)).collect())
    assert [got[j] for j in range(len(cases))] == [want for _, want in cases]


def test_long_text_is_rebuilt_whole(spark):
    text = "\n".join(f"line {j}: word, user{j}@host{j}.net; end\t" for j in range(2000))
    df = spark.createDataFrame([(text,)], "t string")
    out = df.select(privacy.mask_text("t")).first()[0]
    assert out == "\n".join(f"line {j}: word, u***@h***.net; end\t" for j in range(2000))


def test_maps_and_structs(spark):
    df = spark.createDataFrame(
        [({"name": "John", "email": "john@email.com", "password": "secret123", "API_key": "abc123"},)],
        "m map<string,string>",
    )
    got = df.select(privacy.mask_nested(F.col("m"), df.schema["m"].dataType)).first()[0]
    assert got == {"name": "John", "email": "j***@e***.com", "password": "********", "API_key": "********"}
    nested = spark.createDataFrame(
        [(("x", {"in": {"token": "t", "mail": "ab@cd.ef"}}, 7, "sesame"),)],
        "s struct<a:string, b:map<string,map<string,string>>, n:int, user_password:string>",
    )
    row = nested.select(privacy.mask_nested(F.col("s"), nested.schema["s"].dataType).alias("s")).first()["s"]
    assert (row["a"], row["n"], row["user_password"]) == ("x", 7, "********")
    assert row["b"] == {"in": {"token": "********", "mail": "a***@c***.ef"}}


def test_hash_is_stable_and_salted(spark):
    df = spark.createDataFrame([("test@email.com",), ("different@email.com",)], "v string")
    one, two = [r[0] for r in df.select(privacy.hash_pii("v", "s")).collect()]
    again = df.select(privacy.hash_pii("v", "s")).first()[0]
    other = df.select(privacy.hash_pii("v", "t")).first()[0]
    assert one == again != two and one != other and len(one) == 16


def test_contract_columns(spark):
    df = spark.createDataFrame(
        [("c1", "Leonardo", "Li", "a@b.co", "+5511999", "street 1", "City"), ("c2", None, None, None, None, None, None)],
        "customer_id string, first_name string, last_name string, email string, phone string, address_line1 string, city string",
    )
    out = {r["customer_id"]: r for r in privacy.mask_columns(df, CUSTOMERS, "s").collect()}
    assert tuple(out["c1"])[1:3] == ("Leo***do", "**") and out["c1"]["phone"] == "551**99"
    assert len(out["c1"]["email"]) == 16 and out["c1"]["address_line1"] == "********" and out["c1"]["city"] == "City"
    assert all(v is None for v in tuple(out["c2"])[1:])
    with pytest.raises(ValueError):
        privacy.mask_by("shuffle", F.col("city"), "s")


def test_scan(spark):
    df = spark.createDataFrame([("a1@bb.cc and d2@ee.ff",), ("10.0.0.1",), ("none",), (None,)], "t string")
    got = {r["pattern"]: (r["hits"], r["rows_hit"]) for r in privacy.scan(df, ["t"], "x").collect()}
    assert got["email"] == (2, 1) and got["ip_address"] == (1, 1) and got["cpf"] == (0, 0)
