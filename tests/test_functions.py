import pytest
from pyspark.sql import functions as F

from hubloom import functions as fn


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "v string").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize("text,value,status", [
    ("1", True, 200), ("t", True, 200), ("T", True, 200), ("TRUE", True, 200),
    ("true", True, 200), ("True", True, 200), ("0", False, 200), ("f", False, 200),
    ("F", False, 200), ("FALSE", False, 200), ("false", False, 200), ("False", False, 200),
    ("", None, 200), (None, None, 200), ("yes", None, 400), ("tRUE", None, 400),
    (" 1 ", None, 400), ("y", None, 400), ("2", None, 400),
])
def test_strict_bool(spark, text, value, status):
    assert one(spark, fn.strict_bool, text) == value
    assert one(spark, fn.flag_status, text) == status


@pytest.mark.parametrize("text,json", [
    ("1", "1"), ("1.50", "1.5"), ("1e3", "1000.0"), ('"q"', '"q"'), ('{"a": 1}', '{"a":1}'),
    ("[1, 2]", "[1,2]"), ("true", "true"), (" 7 ", "7"), ("null", "null"),
    ('{"a":1,"a":2}', '{"a":2}'),
    ("01", '"01"'), ("", '""'), ("1 2", '"1 2"'), ("NaN", '"NaN"'), ("word", '"word"'),
    ("1,2", '"1,2"'), ("1],[2", '"1],[2"'), ('1, "w": 2', '"1, \\"w\\": 2"'),
    ("1}", '"1}"'), ("{'a':1}", '"{\'a\':1}"'), ("[1] x", '"[1] x"'),
])
def test_query_value_takes_whole_json_only(spark, text, json):
    assert one(spark, lambda c: F.to_json(fn.query_value(c)), text) == json


@pytest.mark.parametrize("query,expected", [
    ("", {}), (None, {}), ("a=1", {"a": "1"}), ("a=1&a=2", {"a": "1"}),
    ("a=b+c%20d", {"a": '"b c d"'}), ("a", {"a": '""'}), ("=5", {"": "5"}),
    ("a=%zz&b=2", {"b": "2"}),
    ("a=%+1&b=%-1&c=%2&d=%2B", {"d": '"+"'}), ("a;b=1&c=3", {"c": "3"}), ("a=1=2", {"a": '"1=2"'}),
    ("&&a=null&", {"a": "null"}), ("%61=1&a=2", {"a": "1"}),
])
def test_parse_query(spark, query, expected):
    frame = spark.createDataFrame([(query,)], "q string").select(
        F.explode(fn.parse_query(F.col("q"))).alias("name", "value"))
    assert {r.name: r.j for r in frame.select("name", F.to_json("value").alias("j")).collect()
            } == expected


@pytest.mark.parametrize("url,query", [
    ("http://h/p?a=1#f", "a=1"), ("http://h/p", ""), ("http://h/p#f?a=1", ""),
    ("http://h/p?a=1?b=2", "a=1?b=2"), ("http://h/p?", ""),
])
def test_query_of(spark, url, query):
    assert one(spark, fn.query_of, url) == query


def test_escaping_of_path_and_query_differs(spark):
    text = "a b/c?d&e=f:g@h$i+j*k~l,m;n-o_p.q%é"
    assert one(spark, fn.path_escape, text) == (
        "a%20b%2Fc%3Fd&e=f:g@h$i+j%2Ak~l%2Cm%3Bn-o_p.q%25%C3%A9")
    assert one(spark, fn.query_escape, text) == (
        "a+b%2Fc%3Fd%26e%3Df%3Ag%40h%24i%2Bj%2Ak~l%2Cm%3Bn-o_p.q%25%C3%A9")


def test_command_key_sorts_names_and_keeps_value_order(spark):
    key = fn.command_key(
        F.lit("start"), F.lit("urn:hub:1"), F.lit("a/b"),
        F.create_map(F.lit("z"), F.array(F.lit("2"), F.lit("1")),
                     F.lit("a"), F.array(F.lit("x y"))))
    assert spark.range(1).select(key).first()[0] == "start/urn:hub:1/a%2Fb?a=x+y&z=2&z=1"
    plain = fn.command_key(F.lit("remove"), F.lit("h"), F.lit("d"))
    assert spark.range(1).select(plain).first()[0] == "remove/h/d"


def test_canonical_query(spark):
    assert one(spark, fn.canonical_query, "b=2&a=x%20y&b=1&%zz=3&a") == "a=x+y&a=&b=2&b=1"
    assert one(spark, fn.canonical_query, "") == ""


def test_trim_space(spark):
    assert one(spark, fn.trim_space, "\t 　\n a b  \u0085\r") == "a b"
    assert one(spark, fn.trim_space, "​ a") == "​ a"


def test_outcome(spark):
    frame = spark.createDataFrame(
        [(200, "x"), (299, "x"), (300, "moved"), (500, ""), (404, None)], "s int, b string")
    got = [tuple(r[0]) for r in frame.select(fn.outcome(F.col("s"), F.col("b"))).collect()]
    assert got == [(False, None), (False, None), (True, "moved"), (True, ""), (True, "")]
