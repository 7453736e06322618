"""Whole jobs where a short cut would show."""

from __future__ import annotations

import hashlib
import random
import time
from collections import Counter

import corpus_pipeline
import pytest
from plain import chances
from pyspark.sql import functions as F

from hubloom.llm import mixing, sharding
from hubloom.llm.html_text import main_text
from hubloom.llm.pii import find_personal, passes_mod97

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n, salt=0):
    return " ".join(f"w{(i * 7 + salt * 1001) % 5003}" for i in range(n))


def kept_rows(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    got = corpus_pipeline.distinct(spark, docs, "")
    assert got.schema == docs.schema
    return sorted(map(tuple, got.collect()), key=repr)


def test_one_row_of_each_component(spark):
    a, b, c = prose(200), prose(200, 1), prose(200, 2)
    near = a + " end"
    rows = [(3, a, "en", "s", 1), (5, near, "en", "s", 1), (5, b, "en", "s", 1),
            (3, c, "en", "s", 1)]
    stay = [rows[0], rows[2], rows[3]]
    assert kept_rows(spark, rows) == sorted(stay, key=repr)


def test_repeated_rows_and_null_ids_leave_one(spark):
    a, b, c, d = (prose(200, i) for i in range(4))
    rows = [(7, a, "en", "s", 1)] * 3 + [(7, a, None, "t", 2), (None, a, "en", "s", 1)]
    rows += [(None, b, "en", "s", 1), (None, b + " end", "en", "s", 1)]
    rows += [(None, c, "en", "s", 1)] * 2 + [(9, d, "en", "z", 1), (9, d, "en", "y", 1)]
    got = kept_rows(spark, rows)
    texts = [r[1] for r in got]
    assert len(got) == 4 and a in texts and c in texts and (9, d, "en", "y", 1) in got
    assert (7, a, None, "t", 2) in got and (b in texts) != (b + " end" in texts)


def test_rows_without_words(spark):
    rows = [(1, "", "en", "s", 0), (1, "", "en", "s", 0), (1, " ", "en", "s", 1),
            (2, None, "en", "s", None), (None, "", "en", "s", 0), (None, "", "en", "s", 0)]
    got = kept_rows(spark, rows)
    assert sorted(str(r[0]) for r in got) == ["1", "2", "None", "None"]


def ibans_of(text):
    return [text[s:e] for s, e, kind, _ in find_personal(text)[1] if kind == "iban"]


def test_ibans_beside_others():
    de, gb, ip = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "192.168.1.1"
    assert ibans_of(f"{de} {gb}") == [de, gb]
    assert ibans_of(f"PO12 {gb}") == [gb]
    assert ibans_of(f"{de} {ip}") == [de]
    assert [k for _, _, k in find_personal(f"{de} {ip}")[0]] == ["ip"]
    assert ibans_of(f"{gb} AB12 CD34 EF56") == [gb]
    assert ibans_of(" ".join([de, gb] * 20)) == [de, gb] * 20
    solid = de.replace(" ", "")
    assert ibans_of(f"({solid}) {solid}x {solid}") == [solid, solid]


def test_ibans_by_any_end():
    """Each start takes an end that passes; the plain version tries all."""
    draw = random.Random(5)
    for _ in range(300):
        words = ["".join(draw.choices("AB12", k=draw.randint(1, 9))) for _ in range(12)]
        text = " ".join(words)
        found = ibans_of(text)
        at = 0
        for iban in found:
            at = text.index(iban, at)
            assert passes_mod97(iban.replace(" ", "")) and 15 <= len(iban.replace(" ", "")) <= 34
            assert not text[at + len(iban):at + len(iban) + 1].isalnum()
            at += len(iban)


LONG = "<p>" + "body words " * 30 + "</p>"
LINKS = "<ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul>"


def blocks(page):
    return [b[:12].strip() for b in main_text(page).split("\n\n")]


def test_links_and_adverts_do_not_end_the_text():
    for between in (LINKS, "<div class=ad><p>Buy</p><p>this</p><p>now</p></div>"):
        page = f"<div>{LONG * 12}{between}<p>Last words.</p></div><div>{LINKS}</div><div>(c) x</div>"
        assert [b for b in blocks(page) if b not in ("One", "Two", "Three")] == [
            *["body words b"] * 12, "Last words."]
    apart = f"<div>{LONG * 12}</div><div>{LINKS}</div><div><p>{'other words ' * 8}</p></div>"
    assert blocks(apart) == [*["body words b"] * 12, "other words"]
    wrapped = f"<div><div>{LONG * 9}</div><div>{LINKS}</div><div><p>Bye.</p></div></div>"
    assert blocks(wrapped) == [*["body words b"] * 9, "Bye."]


def test_lines_that_are_a_link_are_text():
    page = (f"<div>{LINKS}</div><div><h1><a href=/>The title</a></h1></div><div>{LONG}"
            f"<p><a href=/r>Full report</a></p>{LONG}<p><a href=/s>Source</a></p></div>")
    assert blocks(page) == ["The title", "body words b", "Full report", "body words b", "Source"]
    listed = f"<div>{LONG}{LINKS}{LONG}{LINKS}</div>"
    assert blocks(listed) == ["body words b", "One", "Two", "Three", "body words b"]


def test_time_of_deep_pages():
    deep = "".join(f"<div>{LINKS}<p>{'some text ' * 9}</p>" for _ in range(4000))
    began = time.perf_counter()
    assert len(blocks(deep)) >= 4000
    assert time.perf_counter() - began < 20


def test_a_teaser_article_is_not_the_page():
    teaser = "<section><article><p>A teaser of forty characters or so.</p></article></section>"
    page = f"<div>{LONG * 6}</div>{teaser}<div>{LONG * 6}</div>"
    assert blocks(page).count("body words b") == 12
    assert blocks(f"{teaser}<div>{LONG * 6}</div>").count("body words b") == 6


def test_articles_are_weighed_and_may_be_boilerplate():
    side = "<div><p>" + "beside it " * 20 + "</p></div>"
    assert blocks(f"{side}<article>{LONG * 3}</article>{side}") == ["body words b"] * 3
    for attribute in ("class=comment", 'id="comments"', "role=complementary"):
        comment = f"<article {attribute}><p>" + "my opinion " * 40 + "</p></article>"
        assert blocks(f"<article>{LONG}</article>{comment}") == ["body words b"]
        assert blocks(f"<div>{LONG}</div>{comment}") == ["body words b"]


def many_sources(spark):
    """40 sources of 60 documents and 600 of 6, in words."""
    rows = [(i, "a b c d", "en" if i % 3 else "de", f"big{i % 40}", 0) for i in range(2400)]
    rows += [(i + 2400, "a b c d", "en", f"small{i % 600}", 0) for i in range(3600)]
    return spark.createDataFrame(rows, DOCS)


def test_every_source_is_a_category(spark):
    rows = mixing.mixed(many_sources(spark)).collect()
    had, asked = Counter(), Counter()
    for r in rows:
        had[r.source] += r.tokens
        asked[r.source] += r.tokens * r.chance
    assert len(had) == 640
    small = sum(n for s, n in asked.items() if s.startswith("small")) / sum(asked.values())
    present = sum(n for s, n in had.items() if s.startswith("small")) / sum(had.values())
    assert small > present
    assert all(asked[s] / had[s] > 0.85 for s in had if s.startswith("small"))
    assert max(asked[s] / had[s] for s in had if s.startswith("big")) < 0.8


@pytest.mark.parametrize("cells_a_task", [200_000, 100])
@pytest.mark.parametrize("targets", [{}, {"source": {"big1": 0.2, "small7": 0.1},
                                          "lang": {"en": 0.5, "de": 0.5}}])
def test_chances_of_many_cells(spark, monkeypatch, targets, cells_a_task):
    """By one task or by several, against a plain version."""
    monkeypatch.setattr(mixing, "CELLS_A_TASK", cells_a_task)
    monkeypatch.setattr(mixing, "ROUNDS", 4)
    rows = mixing.mixed(many_sources(spark).where("doc_id % 7 < 3"), targets).collect()
    cells = Counter()
    for r in rows:
        cells[r.source, r.lang, r.topic] += r.tokens
    want = chances(cells, targets, mixing.FRACTION, mixing.EVENING, 4)
    assert len(want) > 400
    monkeypatch.setattr(mixing, "CELLS_A_TASK", 50)
    again = {r.doc_id: r.chance for r in
             mixing.mixed(many_sources(spark).where("doc_id % 7 < 3"), targets).collect()}
    assert all(again[r.doc_id] == r.chance for r in rows)
    assert all(abs(r.chance - want[r.source, r.lang, r.topic]) < 1e-9 for r in rows)


def test_equal_fractions_do_not_meet_in_one_task(spark):
    before = {k: spark.conf.get(k, None) for k in (
        "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(4000).select(
            F.lit(0.5).alias("__fraction"), F.concat(F.lit("host"), "id").alias("source"),
            F.md5(F.col("id").cast("string").cast("binary")).alias("__draw"))
        parts = [(r["__part"], r["source"]) for r in sharding._ranges(rows).collect()]
        sizes = Counter(part for part, _ in parts)
        assert len(parts) == 4000 and max(sizes.values()) < 1200
        assert [s for _, s in sorted(parts)] == sorted(s for _, s in parts)
        docs = spark.createDataFrame(
            [(i, f"t{i}", "en", None if i % 50 == 0 else f"s{i}" if i % 3 else "hot", 0)
             for i in range(900)], DOCS)
        got = sharding.sharded(docs, 8).collect()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    ranks, order = Counter(), []
    drawn = sorted(got, key=lambda r: hashlib.md5(
        f"{sharding.SEED}:{r.doc_id}:{r.text_crc32}:{r.size}".encode()).hexdigest())
    sizes = Counter(r.source for r in got)
    # Sources of one size lie evenly spread, in a seeded order.
    named = sorted(sizes, key=lambda s: hashlib.md5(
        f"{sharding.SEED}:{'n' if s is None else 's' + s}".encode()).hexdigest())
    nth, alike = Counter(), Counter(sizes.values())
    offset = {}
    for s in named:
        nth[sizes[s]] += 1
        offset[s] = (nth[sizes[s]] - 0.5) / alike[sizes[s]]
    for place, r in enumerate(drawn):
        ranks[r.source] += 1
        order.append(((ranks[r.source] - offset[r.source]) / sizes[r.source], r.source is not None,
                      r.source or "", place, r))
    order.sort(key=lambda x: x[:4])
    shards = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [x[4].doc_id for x in order] == [r.doc_id for r in shards]
