"""Column functions against plain Python on random text."""

import json
import random
from urllib.parse import quote, quote_plus

from pyspark.sql import functions as F

from hubloom import functions as fn

ALPHABET = "abzAZ09 -_.~*+%&=;:/?#@!$'()[]{},\"\\<>|^`é☃\U0001F600\n\t"


def texts(seed, n, alphabet=ALPHABET, longest=12):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(n)]


def column(spark, values, *columns):
    frame = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [tuple(r)[1:] for r in frame.select("i", *columns).orderBy("i").collect()]


def test_escaping(spark):
    values = texts(1, 600)
    got = column(spark, values, fn.query_escape(F.col("v")), fn.path_escape(F.col("v")))
    assert got == [(quote_plus(v), quote(v, safe="$&+:=@")) for v in values]


def test_escaped_queries_read_back(spark):
    names, values = texts(2, 400), texts(3, 400)
    queries = [f"{quote_plus(n)}={quote_plus(v)}&z=1" for n, v in zip(names, values)]
    pairs = column(spark, queries, fn.query_pairs(F.col("v")))
    assert [[tuple(p) for p in row[0]] for row in pairs] == [
        [(n, v), ("z", "1")] for n, v in zip(names, values)]


def test_canonical_queries_are_stable(spark):
    values = texts(4, 600, "ab=&;%2B+ é")
    once = [r[0] for r in column(spark, values, fn.canonical_query(F.col("v")))]
    twice = [r[0] for r in column(spark, once, fn.canonical_query(F.col("v")))]
    assert once == twice


def is_json(text):
    def refuse(_):
        raise ValueError

    try:
        json.loads(text, parse_constant=refuse)
    except ValueError:
        return False
    return True


def test_only_whole_json_is_json(spark):
    rng = random.Random(5)
    seeds = ['{"a": [1, 2.5, "x"], "b": null}', "[true, false]", '"text"', "12", "-0.5e3", "null",
             "[]", "{}", ' "a" ', '{"a": {"b": [{}]}}']
    values = list(seeds)
    for _ in range(1500):
        text = list(rng.choice(seeds) + rng.choice(["", "", rng.choice(seeds)]))
        for _ in range(rng.randrange(3)):
            spot = rng.randrange(len(text))
            text[spot:spot + rng.randrange(2)] = rng.choice(
                [",", "]", "}", "[", "{", '"', ":", " ", "1", "0", ".", "-", "e", "\n"])
        values.append("".join(text))
    got = [r[0] for r in column(spark, values, fn.json_value(F.col("v")).isNotNull())]
    wrong = [(v, g) for v, g in zip(values, got) if g != is_json(v)]
    assert not wrong, wrong[:10]
    assert 200 < sum(got) < len(got) - 200
