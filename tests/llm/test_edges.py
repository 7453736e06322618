"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib

import pytest
from plain import (decontamination, near_duplicates as plain_near, personal, raked, repeats as plain_repeats,
                   sections_of, top_k as plain_top_k)
from pyspark.sql import functions as F

from hubloom.llm.components import components
from hubloom.llm.decontaminate import clean, matched
from hubloom.llm.html_text import extracted, main_text
from hubloom.llm.mixing import mixed, sampled
from hubloom.llm.near_duplicates import near_duplicates, one_of_each
from hubloom.llm.pii import find_personal, passes_mod97, personal_data
from hubloom.llm.quality import accepted, merged, rules_of, scored, statistics
from hubloom.llm.repeats import without_repeats
from hubloom.llm.search import top_k
from hubloom.llm.sharding import sharded
from hubloom.llm.token_counts import attributed, section_tokens

EMPTY = hashlib.sha256(b"").hexdigest()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n, salt=0):
    return " ".join(f"w{(i * 7 + salt * 1001) % 5003}" for i in range(n))


def frame(spark, rows, names="doc_id long, text string"):
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="module")
def awkward(spark):
    """Rows of every awkward kind, and columns whose names operators use inside."""
    rows = [(1, None, "en", "a", None), (2, "", "en", None, 0), (3, " \t\n", None, "a", 3),
            (4, "one two", "en", "a", 7), (5, "one two", "en", "b", 7),
            (6, prose(30_000), "de", "a", 1), (7, prose(30_000) + " end", "de", "a", 1),
            (8, "x" * 300_000, "de", "b", 1), (None, prose(60, 3), "fr", "b", 1),
            (9, prose(60, 3), "fr", "b", 1), (9, prose(60, 3), "fr", "b", 1),
            (10, "Ünïcödé ✓ " * 30, "fr", "b", 1)]
    return frame(spark, rows, DOCS).select("*", *(F.lit(1).alias(n) for n in (
        "at", "content", "class", "key", "score", "rank", "size", "shard", "tokens", "kept",
        "places", "topic", "held_out", "n_words", "slot", "__n", "least")))


def empty(spark):
    return frame(spark, [], DOCS)


# near duplicates

def test_near_duplicates_of_awkward_rows(awkward):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in
           near_duplicates(awkward).collect()}
    want = plain_near([(r.doc_id, r.text) for r in awkward.collect() if r.doc_id is not None])
    assert got == want | {(None, 56, 9, None)}
    assert near_duplicates(awkward).count() == 12


def test_near_duplicates_chain_and_threshold(spark):
    base = [f"t{i}" for i in range(200)]
    docs = [(i, " ".join(base[:200 - 4 * i] + [f"n{i}_{j}" for j in range(4 * i)]))
            for i in range(12)]
    # 40 shingles, 34 shared of 40 in all: exactly 85 percent.
    docs += [(50, prose(44, 9)), (51, prose(38, 9))]
    docs += [(60, prose(44, 9).upper()), (61, "a b c"), (62, "A b C"), (63, "a b")]
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept)
           for r in near_duplicates(frame(spark, docs)).collect()}
    assert got == plain_near(docs)
    assert (51, 34, 50, False) in got and (62, 1, 61, False) in got


def test_a_large_group_and_its_neighbours(spark):
    """One bucket holds many copies and others that are no copies of them."""
    import random
    draw = random.Random(4)
    base = [f"t{i}" for i in range(150)]
    docs = []
    for i in range(160):
        w = list(base)
        for k in draw.sample(range(150), 1 + i % 9):
            w[k] = f"{i}_{k}"
        docs.append((i, " ".join(w)))
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept)
           for r in near_duplicates(frame(spark, docs)).collect()}
    assert got == plain_near(docs)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 100), (7, 7)]
    got = {tuple(r) for r in components(frame(spark, edges, "u long, v long")).collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(100, 90), (95, 90)}
    assert components(frame(spark, [], "u long, v long")).count() == 0


# repeats

def test_repeats_of_awkward_rows(awkward):
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
           for r in without_repeats(awkward).collect()]
    assert len(got) == 12
    # The null id is the least, so the others repeat it.
    want = plain_repeats([(-1 if r.doc_id is None else r.doc_id, r.text)
                          for r in awkward.collect()])
    assert {(-1 if r[0] is None else r[0], *r[1:]) for r in got} == want


def test_repeats_within_and_between(spark):
    passage = prose(55, 2)
    docs = [(1, passage), (2, "start " + passage + " end"), (3, prose(20, 5) + " " + prose(20, 5)),
            (4, "be " * 70), (5, prose(19, 6)), (6, prose(19, 6)), (7, prose(20, 7)),
            (8, prose(20, 7)), (9, "A " + prose(40, 2)), (10, passage.replace(" ", "\n", 9))]
    docs += [(20 + i, f"{i} {prose(30, 8)} {i}") for i in range(40)]
    got = {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
           for r in without_repeats(frame(spark, docs)).collect()}
    assert got == plain_repeats(docs)


@pytest.mark.parametrize("most", [1, 2, 4])
def test_repeats_dealt_out_in_steps(spark, monkeypatch, most):
    """More groups than are dealt to at once, and tasks that hold few windows."""
    import hubloom.llm.repeats as module
    for name, value in {"MOST_GROUPS": max(most, 2), "GROUP_BYTES": 500, "HELD": 50 * most}.items():
        monkeypatch.setattr(module, name, value)
    docs = [(i, f"{i} {prose(45, i % 6)} {i} {prose(25, 9)} {prose(25, 10 + i % 2)}") for i in range(30)]
    got = {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
           for r in without_repeats(frame(spark, docs)).collect()}
    assert got == plain_repeats(docs)


def test_kept_text_of_repeats(spark):
    rows = without_repeats(frame(spark, [(1, prose(25)), (2, "a\n\tb " + prose(25) + " c")]))
    assert {r.doc_id: r.kept_text for r in rows.collect()} == {1: prose(25), 2: "a b c"}


# decontamination

ITEMS = [(1, prose(30, 1)), (2, "Short item!"), (3, None), (4, ""), (5, prose(30, 1)),
         (None, prose(12, 4)), (11, "?!")]


def test_decontamination_of_awkward_rows(spark, awkward):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    items = [("" if i is None else i, t) for i, t in ITEMS]
    found = matched(awkward, frame(spark, ITEMS, "item_id long, text string"))
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
           for r in found.collect()}
    assert got == decontamination(docs, items)
    assert set(awkward.columns) <= set(found.columns)


def test_decontamination_of_planted_passages(spark):
    docs = [(1, "x " + prose(30, 1) + " y"), (2, prose(9, 1)), (3, "a SHORT-item b short, item"),
            (4, prose(11, 1).replace(" ", "--")), (5, prose(14, 1) + " z " + prose(30, 1)[30:])]
    for items in (ITEMS, [], [(i, prose(10 + i % 7, i)) for i in range(40)]):
        found = matched(frame(spark, docs), frame(spark, items, "item_id long, text string"))
        got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
               for r in found.collect()}
        assert got == decontamination(docs, [("" if i is None else i, t) for i, t in items])


def test_decontamination_in_several_passes(spark, monkeypatch):
    import hubloom.llm.decontaminate as module
    items = [(i, prose(10 + i % 7, i)) for i in range(12)]
    docs = [(i, f"{prose(20, i)} and {prose(15, i + 1)}") for i in range(15)] + [(99, None)]
    tests, table = frame(spark, items, "item_id long, text string"), frame(spark, docs)
    whole = sorted(map(repr, matched(table, tests).collect()))
    monkeypatch.setattr(module, "BLOCK_BYTES", 600)
    found = matched(table, tests).collect()
    assert sorted(map(repr, found)) == whole
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
           for r in found}
    assert got == decontamination(docs, items)
    assert {r.doc_id for r in clean(table, tests).collect()} == {r[0] for r in got if not r[5]}


def test_longest_match(spark):
    """Of one item, with its places; two items side by side are no longer match."""
    items = [(1, prose(30, 1)), (2, prose(12, 4)), (3, prose(30, 1)), (4, prose(11, 4)), (5, "so")]
    docs = [(1, f"{prose(10, 1)} a b {prose(14, 1)}"), (2, f"x {prose(30, 1)[40:]} {prose(12, 4)}"),
            (3, prose(11, 4)), (4, "no so so")]
    rows = matched(frame(spark, docs), frame(spark, items, "item_id long, text string"))
    got = {r.doc_id: r for r in rows.collect()}
    assert (got[1].longest_match, got[1].match_word) == (14, 12)
    assert [tuple(m) for m in got[1].matches] == [("1", 14, 12, 0), ("3", 14, 12, 0)]
    cut = 30 - len(prose(30, 1)[40:].split())
    n = 30 - cut
    # The first word may be cut; what is left of it is no word of the item.
    assert {m.item_id: m.length for m in got[2].matches}["2"] == 12
    assert got[2].longest_match in (n, n - 1) and got[2].n_hit == got[2].longest_match + 12
    assert [tuple(m) for m in got[3].matches] == [("2", 11, 0, 0), ("4", 11, 0, 0)]
    assert [tuple(m) for m in got[4].matches] == [("5", 1, 1, 0)]


# personal data

@pytest.mark.parametrize("text", [
    "", "no data", "a@b.c a@b.c@d.e", "x@@y.z _.%+-@a-b.c-d.", "a@b .c@d.e.f g@h",
    "1.2.3.4.5.6.7.8.9 256.1.1.1 00255.1.1.001 1.2.3 1..2.3.4 1.2.3.4", "é1.2.3.4é",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 5 00000000000000",
    "+1 (743) 555-3824, +49.30.1234567 +123 +1((((2 ++1234567890 +1+1234567890",
    "+4111111111111111 a+1234567890@x.y", "0" * 5000, "1." * 3000, "@" * 3000, "a@" * 2000,
    "+1" + "(" * 3000, "1 " * 3000])
def test_personal_data_like_the_patterns(text):
    base, _ = find_personal(text)
    assert [(k, s, e) for s, e, k in base] == personal(text)


def test_added_personal_data():
    assert passes_mod97("GB82WEST12345698765432")
    text = "IBAN GB82 WEST 1234 5698 7654 32 IS MINE, not GB83 WEST 1234 5698 7654 32"
    assert [(k, text[s:e]) for s, e, k, _ in find_personal(text)[1]] == [
        ("iban", "GB82 WEST 1234 5698 7654 32")]
    assert [k for *_, k, _ in find_personal("My SSN is 123-45-6789")[1]] == ["ssn"]
    assert find_personal("code 123-45-6789")[1] == []
    assert [k for *_, k, _ in find_personal("call (212) 555-0100")[1]] == ["local"]


def test_personal_data_of_awkward_rows(awkward):
    rows = personal_data(awkward).collect()
    assert len(rows) == 12 and all(r.base_sha256 == EMPTY and r.spans == "" for r in rows)


# quality

@pytest.mark.parametrize("rows", [
    [(1, "good text", 1), (2, "bad text", 0)], [(i, "the same text", i % 2) for i in range(60)]])
def test_texts_that_no_rule_tells_apart(spark, rows):
    docs = frame(spark, [r[:2] for r in rows])
    scores = {r.score for r in scored(docs, frame(
        spark, [(r[0], r[2]) for r in rows], "doc_id long, quality int")).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 1


def test_quality_of_awkward_rows(spark, awkward):
    labels = frame(spark, [(i, i % 2) for i in range(1, 11)] + [(1, 0), (2, None), (None, 1)],
                   "doc_id long, quality int")
    rows = scored(awkward, labels).collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    none = scored(awkward, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}


def test_rules():
    tree = ("DecisionTree\n  If (feature 3 <= 0.5)\n   If (feature 1 <= 2.0)\n    Predict: 0.0\n"
            "   Else (feature 1 > 2.0)\n    Predict: 1.0\n  Else (feature 3 > 0.5)\n"
            "   Predict: 1.0\n")
    assert list(rules_of(tree)) == [((3, True, 0.5),), ((1, True, 2.0), (3, True, 0.5)),
                                    ((1, False, 2.0), (3, True, 0.5)), ((3, False, 0.5),)]
    assert merged([(1, True, 3.0), (1, True, 2.0), (1, False, 0.0)]) == (
        (1, False, 0.0), (1, True, 2.0))
    assert set(statistics(None)) == {0.0} == set(statistics(b" \n"))


# sharding

def test_sharding_of_awkward_rows(awkward):
    rows = sharded(awkward, shards=5).collect()
    check_shards(rows, 12, 5)
    assert {r.size for r in rows if r.doc_id in (1, 2)} == {8}


def check_shards(rows, n, shards):
    assert len(rows) == n
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by.get(i, [])) for i in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(by) <= set(range(shards))


def test_shards_hold_the_mixture(spark):
    rows = [(i, f"t{i}", "big" if i % 3 else f"s{i % 7}") for i in range(2000)]
    got = sharded(frame(spark, rows, "doc_id long, text string, source string"), 8).collect()
    check_shards(got, 2000, 8)
    for source in {r[2] for r in rows}:
        counts = [sum(r.shard == s and r.source == source for r in got) for s in range(8)]
        assert max(counts) - min(counts) <= 8  # one a source


def test_shards_match_the_mixture_with_many_small_sources(spark):
    """One large source, hundreds of one row and of two rows, some of another size."""
    rows = [(i, f"t{i}", "big") for i in range(600)]
    rows += [(1000 + i, f"t{i}", f"one {i}") for i in range(300)]
    got = sharded(frame(spark, rows, "doc_id long, text string, source string"), 24).collect()
    check_shards(got, 900, 24)
    counts = [sum(r.shard == s and r.source == "big" for r in got) for s in range(24)]
    assert all(abs(n - 600 / 24) <= 1 for n in counts)
    rows += [(2000 + i, f"t{i}", f"two {i // 2}") for i in range(200)]
    rows += [(3000 + i, f"t{i}", None if i % 2 else "half") for i in range(100)]
    got = sharded(frame(spark, rows, "doc_id long, text string, source string"), 24).collect()
    check_shards(got, 1200, 24)
    for kind, n in (("big", 600), ("one", 300), ("two", 200), ("half", 50), (None, 50)):
        mine = [r.shard for r in got if (r.source or "None").split()[0] == str(kind)]
        assert len(mine) == n and all(abs(mine.count(s) - n / 24) <= 2 for s in range(24)), kind


# mixing

def test_mixing_of_awkward_rows(awkward):
    rows = mixed(awkward).collect()
    assert len(rows) == 12 and all(0 <= r.chance <= 1 for r in rows)
    assert all(r.kept == (r.weight is not None) for r in rows)
    assert all(r.kept for r in rows if not r.tokens)


def test_raking_meets_targets():
    import numpy as np
    tokens = np.array([[[50., 30], [10, 10]], [[40, 20], [20, 20]]])
    targets = [np.array([.5, .5]), np.array([.6, .4]), np.array([.55, .45])]
    fitted = raked(tokens, targets, 0.5)
    for axis, goal in enumerate(targets):
        share = fitted.sum(axis=tuple(a for a in range(3) if a != axis)) / fitted.sum()
        assert np.allclose(share, goal, atol=1e-6)
    assert (fitted <= tokens).all() and np.isclose(fitted.sum(), 100)
    assert not raked(np.zeros((2, 2, 2)), targets).any()


def test_mixing_to_given_targets(spark):
    rows = [(i, "a b c", "x" if i % 4 else "y", "en", "t") for i in range(4000)]
    docs = frame(spark, rows, "doc_id long, text string, source string, lang string, topic string")
    got = mixed(docs, {"source": {"x": 0.5, "y": 0.5}}, 0.4, topic=F.col("topic")).collect()
    x, y = (sum(r.kept for r in got if r.source == s) for s in "xy")
    assert 730 < x < 870 and 730 < y < 870


# search

def test_search(spark):
    import random
    draw = random.Random(2)
    vectors = [(i, [draw.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    vectors += [(i, [0.5] * 8) for i in range(300, 320)] + [
        (400, None), (500, [None] * 8), (600, [float("nan")] * 8), (700, [float("inf")] * 8),
        (800, []), (None, [1.0] * 8)]
    table = frame(spark, vectors, "vec_id long, embedding array<double>").withColumn(
        "score", F.lit(1)).withColumn("rank", F.lit(2))
    got = {tuple(r) for r in top_k(table, F.col("vec_id") % 100 == 0).collect()}
    assert got == plain_top_k(vectors)
    few = frame(spark, vectors[:4], "vec_id long, embedding array<double>")
    assert top_k(few, F.col("vec_id") == 0).count() == 3
    assert top_k(few.limit(0), F.col("vec_id") == 0).count() == 0


def test_search_in_many_segments_and_groups(spark, monkeypatch):
    """A third of all vectors are copies; queries lie in several groups."""
    import random

    import hubloom.llm.search as module
    monkeypatch.setattr(module, "SEGMENT", 40)
    monkeypatch.setattr(module, "GROUP", 3)
    monkeypatch.setattr(module, "BLOCK", 8)
    draw = random.Random(5)
    vectors = [(i, [0.5, 0.25] if i % 3 == 0 else [draw.gauss(0, 1) for _ in range(i % 4)])
               for i in range(400)]
    table = frame(spark, vectors, "vec_id long, embedding array<double>").selectExpr(
        "*", "1 AS segment", "2 AS `group`", "3 AS query_id", "4 AS Vector")
    got = [tuple(r) for r in top_k(table, F.col("vec_id") % 25 == 0).collect()]
    assert len(set(got)) == len(got) and set(got) == plain_top_k(vectors, every=25)


def test_search_of_large_components(spark):
    vectors = [(i, [float(2 ** 20 + i), -1.5 * i, 3.0]) for i in range(250)]
    table = frame(spark, vectors, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in top_k(table, F.col("vec_id") % 100 == 0).collect()}
    assert got == plain_top_k(vectors)


# pages

def test_pages(spark):
    page = """<html><head><title>T</title><style>p{}</style></head><body class="blog">
      <header>Site</header><nav><a href=/>Home</a></nav><aside>Side</aside>
      <main><h1>Head &amp; line</h1><p>One<br>two &lt;three&gt;<b>bold</b> &#233;</p>
      <div class="ad-box">Buy</div><form><p>Name<input></form><script>if (a<b) "</p>"</script>
      <!-- hidden <p>no --><ul><li>item 1<li>item 2</ul>
      <div id="comments"><p>First!</p></div></main><footer>&copy; x</footer></body></html>"""
    assert main_text(page) == "Head & line\n\nOne two <three>bold é\n\nitem 1\n\nitem 2"
    plain = ("<body><div class=menu><a>a</a></div><div><p>" + "long text " * 20 + "</p><p>short</p><p>"
             + "more text " * 20 + "</p></div><div class='cookie-notice'>ok</div></body>")
    assert main_text(plain).split("\n\n") == [("long text " * 20).strip(), "short",
                                             ("more text " * 20).strip()]
    named = ("<div class='page with-sidebar'><p>" + "kept words " * 9 + "</p><div class='rightSidebar'>"
             "<p>gone</p></div><div id=userComments><p>gone too</p></div></div>")
    assert main_text(named) == ("kept words " * 9).strip()
    odd = [(1, "u", None), (2, None, ""), (3, "u", "<p"), (4, "u", "just text &amp; more"),
           (5, "u", "<" * 5000), (6, "u", "<a '" * 2000), (None, "u", "<p>" * 20_000 + "x")]
    table = frame(spark, odd, "page_id long, url string, html string").withColumn(
        "text", F.lit("clash"))
    got = {r.page_id: r.text for r in extracted(table).collect()}
    assert got[1] == got[2] == got[3] == "" and got[4] == "just text & more" and got[None] == "x"


BODY = "".join(f"<p>{'Words of paragraph ' * 8}{i}.</p>" for i in range(4))
TEXT = "\n\n".join(f"{('Words of paragraph ' * 8)}{i}." for i in range(4))


@pytest.mark.parametrize("page, want", [
    (f"<article class='comments-open'>{BODY}</article>", TEXT),
    (f"<div class='modal-verbs'>{BODY}</div>", TEXT),
    (f"<article>{BODY}<p class='related-work'>As others found.</p></article>",
     TEXT + "\n\nAs others found."),
    (f"<article><div class='header-image'>A mill.</div>{BODY}</article>", "A mill.\n\n" + TEXT),
    (f"<div class='widget'>{BODY}</div>", TEXT),
    (f"<div class='comments-list'>{BODY}</div><div>{BODY}</div>", TEXT),
    (f"<div>{BODY}</div><div class='related-mills'><a href=x>Mill one</a> <a href=y>two</a></div>",
     TEXT),
    (f"<div>{BODY}</div><div class='notice-winter'>Closed.</div>", TEXT),
    (f"<article>{BODY}<div class='ad-slot-3'>Buy now</div></article>", TEXT),
    (f"<article>{BODY}</article><section id='user-comments'><p>{'So true! ' * 90}</p></section>",
     TEXT),
    (f"<article>{BODY}</article><div role='complementary'><p>{'More. ' * 90}</p></div>", TEXT)])
def test_class_words_are_weighed(page, want):
    assert main_text(page) == want


# tokens

@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, "a" * 60_000, "7" * 60_000,
                                  "a" + " \t" * 700_000 + "b", "\u2003" * 900_000 + "x"])
def test_tokens_of_very_long_runs(spark, text):
    rows = section_tokens(frame(spark, [(1, text), (2, "a  b")])).collect()
    assert sum(r.n_tokens for r in rows if r.doc_id == 1) == rows[0].doc_tokens > 0


def test_pieces_have_the_tokens_of_the_whole(monkeypatch):
    import random

    from hubloom.llm import token_counts as module
    monkeypatch.setattr(module, "PIECE", 3)
    encoder = module.Encoder(module.read_vocabulary(module.VOCABULARY), module.PATTERN)
    draw = random.Random(3)
    for _ in range(600):
        text = "".join(draw.choice(["a", "b", " ", " ", " ", "\n", "\t", "1", ".", "'s", "é", "\u2003",
                                    "\x1c", "\x85"]) for _ in range(draw.randrange(60)))
        assert encoder.encode(text).tolist() == encoder.words.encode_ordinary(text), repr(text)


def test_attribution_rules():
    import random

    import numpy as np
    draw = random.Random(1)
    for _ in range(60):
        lengths = [draw.randint(1, 6) for _ in range(draw.randint(0, 30))]
        cuts = sorted(draw.sample(range(sum(lengths) + 1), min(8, sum(lengths) + 1)))
        spans = [(a, b) for a, b in zip(cuts[::2], cuts[1::2], strict=False)]
        for rule in ("largest", "first", "share"):
            counts, _ = attributed(np.array(lengths, np.int64), spans, rule)
            assert np.allclose(counts, sections_of(lengths, spans, rule)), (lengths, spans, rule)


def test_tokens_of_awkward_rows(awkward):
    rows = section_tokens(awkward).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in awkward.collect()}
    nothing = [r for r in rows if r.doc_id in (1, 2)]
    assert [(r.section, r.n_tokens, r.doc_tokens) for r in nothing] == [(-1, 0.0, 0)] * 2


def test_tokens_of_named_sections(spark):
    docs = frame(spark, [(1, "Títle here\nBody of text")]).withColumn("parts", F.expr(
        "array(named_struct('name', 'title', 'start', 0, 'end', 10),"
        " named_struct('name', 'body', 'start', 11, 'end', 99))"))
    rows = section_tokens(docs, "parts").orderBy("section").collect()
    assert [(r.section, r.name, r.start, r.end) for r in rows] == [
        (-1, None, 0, 0), (0, "title", 0, 10), (1, "body", 11, 23)]
    assert sum(r.n_tokens for r in rows) == rows[0].doc_tokens
    with pytest.raises(ValueError):
        section_tokens(docs, rule="other")


@pytest.mark.parametrize("operator", [
    near_duplicates, without_repeats, personal_data, sharded, mixed, section_tokens,
    lambda d: matched(d, d.select(F.col("doc_id").alias("item_id"), "text")),
    lambda d: scored(d, d.select("doc_id", F.lit(1).alias("quality"))),
    lambda d: extracted(d.select(F.col("doc_id").alias("page_id"), F.col("lang").alias("url"),
                                 F.col("text").alias("html"))),
    lambda d: accepted(d, d.select("doc_id", F.lit(1).alias("quality"))), one_of_each, sampled,
    lambda d: clean(d, d.select(F.col("doc_id").alias("item_id"), "text"))])
def test_empty_tables(spark, operator):
    assert operator(empty(spark)).count() == 0


# names

CLASHING = ("__bytes", "__source", "__lang", "Topic", "SCORE", "score", "N_Words", "__a", "a", "row",
            "c0", "kept", "Kept", "held_out", "matches", "key", "at", "bytes", "tokens", "draw",
            "chance", "id", "n", "place", "__draw", "__part", "doc_tokens", "statistics", "label")


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, f"{prose(40, i % 5)} end", "en", f"s{i % 2}", i) for i in range(20)]
    rows += [rows[3], rows[3], (None, "", None, None, None), (1, " " * 2_000_000, "en", "s0", 1)]
    return frame(spark, rows, DOCS).select(
        "*", *(F.concat(F.lit(f"{n} "), F.coalesce("doc_id", F.lit(-1))).alias(n) for n in CLASHING),
        F.create_map(F.lit("k"), "doc_id").alias("mapped"),
        F.parse_json(F.lit('{"v": 1}')).alias("variant"))


ITEM = [(1, prose(20, 2))]
OPERATORS = {
    "scored": lambda d, s: scored(d, d.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))),
    "matched": lambda d, s: matched(d, frame(s, ITEM, "item_id long, text string")),
    "mixed": lambda d, s: mixed(d), "near": lambda d, s: near_duplicates(d),
    "repeats": lambda d, s: without_repeats(d), "personal": lambda d, s: personal_data(d),
    "sharded": lambda d, s: sharded(d), "tokens": lambda d, s: section_tokens(d),
}
PICKERS = {
    "quality": lambda d, s: accepted(d, d.select("doc_id", F.lit(1).alias("quality"))),
    "near": lambda d, s: one_of_each(d), "sampled": lambda d, s: sampled(d),
    "clean": lambda d, s: clean(d, frame(s, ITEM, "item_id long, text string")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_take_columns_of_any_name(spark, clashing, name):
    docs = clashing.drop("variant") if name in ("scored", "matched") else clashing
    rows = OPERATORS[name](docs, spark)
    assert len(rows.collect()) >= 24


@pytest.mark.parametrize("name", PICKERS)
def test_stages_leave_columns_as_they_are(spark, clashing, name):
    docs = clashing.drop("variant") if name in ("quality", "clean") else clashing
    kept = PICKERS[name](docs, spark)
    assert kept.columns == docs.columns
    texts = lambda frame: {tuple(map(str, r)) for r in frame.collect()}
    assert texts(kept) <= texts(docs) and kept.count() > 0
