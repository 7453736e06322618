"""Random texts through the parts that need no Spark."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import TEST_WORD, personal, shingles, words

from hubloom.llm.decontaminate import Numbers, SuffixArray, shard_hits, test_windows, words_of
from hubloom.llm.html_text import main_text
from hubloom.llm.near_duplicates import shingle_sets
from hubloom.llm.pii import find_personal
from hubloom.llm.quality import STATISTICS, statistics
from hubloom.llm.repeats import covered, packed_places, unpacked_places, window_anchors
from hubloom.llm.texts import WordCodes, coded, word_lists
from hubloom.llm.token_counts import _in_bytes, line_spans

PERSONAL = st.text("0123456789..@@++--  ()aZ_é%", max_size=80)
ANY = st.text(max_size=200)
test_windows.__test__ = False


@settings(max_examples=400, deadline=None)
@given(PERSONAL)
def test_personal_data(text):
    base, added = find_personal(text)
    assert [(k, s, e) for s, e, k in base] == personal(text)
    assert all(0 <= s < e <= len(text) for s, e, *_ in added)


@settings(max_examples=200, deadline=None)
@given(st.text("<>/!-pabr \"'=;&#x1\n", max_size=120))
def test_pages_never_fail(page):
    text = main_text(page)
    assert text == text.strip() and "\n\n\n" not in text


@settings(max_examples=100, deadline=None)
@given(ANY)
def test_words(text):
    data = text.encode("utf-8", "ignore")
    assert word_lists([data]) == [words(data.decode())]
    assert words_of(data) == words(data.decode(), TEST_WORD, lower=True)
    assert len(statistics(data)) == len(STATISTICS)
    spans = line_spans(data)
    assert b"".join(data[a:b] for a, b in spans) == data


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab \n", max_size=60), max_size=6))
def test_shingle_sets(texts):
    sets = shingle_sets([t.encode() for t in texts], WordCodes())
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    for a, x in zip(texts, sets, strict=True):
        for b, y in zip(texts, sets, strict=True):
            assert len(np.intersect1d(x, y)) == len(shingles(a) & shingles(b))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), max_size=5))
def test_equal_windows_pick_equal_places(lists):
    flat, starts = coded(lists, WordCodes())
    windows, picks, codes = window_anchors(flat, starts)
    whole = [(d, i) for d, x in enumerate(lists) for i in range(len(x) - 19)]
    assert [(d, int(starts[d]) + i) for d, i in whole] == list(zip(
        (np.searchsorted(starts, windows, side="right") - 1).tolist(), windows.tolist(),
        strict=True))
    seen = {}
    for (d, i), w, p in zip(whole, windows.tolist(), picks.tolist(), strict=True):
        assert w <= p <= w + 12
        assert seen.setdefault(tuple(lists[d][i:i + 20]), (p - w, int(codes[p]))) == (
            p - w, int(codes[p]))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), max_size=30), max_size=4),
       st.lists(st.lists(st.sampled_from([b"a", b"b", b"c", b"e"]), max_size=14), max_size=4))
def test_suffix_array_finds_every_window(lists, items):
    tests = test_windows([(str(i), b" ".join(x)) for i, x in enumerate(items)])
    hit, starts, found = shard_hits(lists, Numbers(tests.numbers), tests)
    for d, x in enumerate(lists):
        expected, best = [False] * len(x), {}
        for i, item in enumerate(items):
            least = min(10, len(item))
            for k in range(len(item)):
                for at in range(len(x)):
                    n = 0
                    while at + n < len(x) and k + n < len(item) and x[at + n] == item[k + n]:
                        n += 1
                    if n and n >= least:
                        expected[at:at + n] = [True] * n
                        best[str(i)] = min(best.get(str(i), (0, 0, 0)), (-n, at, k))
        assert hit[starts[d]:starts[d + 1]].tolist() == expected
        assert {i: (-m.length, m.word, m.item_word) for i, m in found.get(d, {}).items()} == best


def test_suffixes_are_sorted():
    rng = np.random.default_rng(3)
    flat = rng.integers(0, 4, 300)
    array = SuffixArray(flat, np.array([0, 120, 120, 300]))
    ranks = array.rank(10)
    there = np.flatnonzero(ranks)
    assert len(there)
    first = [tuple(array.ranks[1][i:i + 10]) for i in there]
    order = sorted(set(first))
    assert [order.index(x) + 1 for x in first] == ranks[there].tolist()


@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 2 ** 32 - 1)), max_size=30, unique=True))
def test_packed_places(pairs):
    position = np.array(sorted(d << 32 | p for d, p in pairs), np.uint64)
    docs, counts, planes = packed_places(position)
    which, places = unpacked_places(counts, planes)
    assert [(int(docs[w]), int(p)) for w, p in zip(which, places, strict=True)] == sorted(pairs)


def test_cover():
    places = np.array([0, 5, 40], np.uint32).tobytes()
    assert np.flatnonzero(covered(70, places)).tolist() == [*range(25), *range(40, 60)]


@settings(max_examples=100, deadline=None)
@given(st.text("aé✓\n", max_size=20),
       st.lists(st.tuples(st.integers(-3, 25), st.integers(-3, 25)), max_size=5))
def test_spans_in_bytes(text, given_spans):
    data = text.encode()
    _, spans = _in_bytes(data, [{"name": "n", "start": a, "end": b} for a, b in given_spans])
    at = 0
    for a, b in spans:
        assert at <= a < b <= len(data)
        data[a:b].decode()
        at = b
