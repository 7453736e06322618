"""Registered queries against their SQL, or against plain versions."""

import hashlib
import zlib

import pytest
from oracle_check import differences, oracle_connection
from plain import personal

from hubloom.llm.oracle import ORACLE_SQL
from hubloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, connection, name):
    assert differences(QUERIES[name](spark, sf_dir), connection, ORACLE_SQL[name]) == []


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


def test_personal_data_of_all_documents(spark, sf_dir, connection):
    import hashlib
    got = {r.doc_id: r for r in QUERIES["op6_personal_data"](spark, sf_dir).collect()}
    for doc_id, text in connection.sql("SELECT doc_id, text FROM documents").fetchall():
        base = personal(text)
        written = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        row = got[doc_id]
        assert row.base_sha256 == hashlib.sha256(written.encode()).hexdigest(), doc_id
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(
            sum(k == x for k, _, _ in base) for x in ("email", "ip", "card", "phone"))
        assert set(filter(None, written.split(","))) <= set(row.spans.split(","))


def test_page_text_is_the_article(spark, sf_dir, connection):
    """These pages hold their article in one template."""
    import html
    import re
    got = {r.page_id: r for r in QUERIES["op3_html_text"](spark, sf_dir).collect()}
    for page_id, page in connection.sql("SELECT page_id, html FROM pages").fetchall():
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", article))
        assert got[page_id].text == "\n\n".join(filter(None, blocks))
        assert got[page_id].n_chars == len(got[page_id].text)


def test_quality_on_held_out_labels(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = (QUERIES["op7_quality"](spark, sf_dir).where("held_out").join(labels, "doc_id")
            .collect())
    right = sum(r.predicted == r.quality for r in rows)
    assert rows and right >= 0.9 * len(rows)


def plain_tree(node):
    """Rules of a fitted tree, by walking its nodes: all paths but the empty one."""
    found = []

    def walk(node, path):
        if path:
            found.append(path)
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        at, bound = split.featureIndex(), split.threshold()
        walk(node.leftChild(), [*path, (at, True, bound)])
        walk(node.rightChild(), [*path, (at, False, bound)])
    walk(node, [])
    return found


def test_scores_are_those_of_the_fitted_rules(spark, sf_dir, connection):
    """Statistics, rules and scores of all documents, one at a time."""
    import math
    from pyspark.sql import functions as F

    from hubloom.llm import quality
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ensemble = quality.RuleEnsemble.fit(docs, labels)
    assert len(ensemble.weights) > 3
    got = {r.doc_id: r for r in QUERIES["op7_quality"](spark, sf_dir).collect()}
    texts = connection.sql("SELECT doc_id, text FROM documents").fetchall()
    assert len(texts) == len(got)
    for doc_id, text in texts:
        numbers = quality.statistics(None if text is None else text.encode())
        logit = ensemble.intercept + sum(
            weight for rule, weight in ensemble.weights.items()
            if all(numbers[i] <= bound if at_most else numbers[i] > bound
                   for i, at_most, bound in rule))
        row = got[doc_id]
        assert abs(row.score - 1 / (1 + math.exp(-logit))) < 1e-9
        assert row.predicted == (row.score >= 0.3)
        assert row.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)

    # Every rule of the ensemble is a path of a tree fitted on the same sample.
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector
    sample = quality._sample(docs, labels).coalesce(1).sortWithinPartitions("doc_id")
    forest = RandomForestClassifier(
        numTrees=quality.TREES, maxDepth=quality.DEPTH, seed=7, minInstancesPerNode=5).fit(
        sample.select("label", array_to_vector("statistics").alias("features")))
    paths = {quality.merged([(i, m, float(b)) for i, m, b in path])
             for tree in forest.trees for path in plain_tree(tree._call_java("rootNode"))}
    assert set(ensemble.weights) <= paths
    used = sample.agg(F.count_if(quality.held_out())).first()[0]
    assert used == 0


def test_tokens_of_every_line(spark, sf_dir, connection):
    """Lines, tokens and their attribution, one token at a time."""
    from hubloom.llm import token_counts
    from plain import sections_of
    ranks = token_counts.read_vocabulary(token_counts.VOCABULARY)
    lengths = token_counts.byte_lengths(ranks)
    encoder = token_counts.Encoder(ranks, token_counts.PATTERN)
    got = {}
    for r in QUERIES["op1_token_counts"](spark, sf_dir).collect():
        got.setdefault(r.doc_id, []).append(r)
    for doc_id, text in connection.sql(
            "SELECT doc_id, text FROM documents WHERE length(text) < 3000").fetchall():
        tokens = encoder.words.encode_ordinary(text or "")
        lines = [x + "\n" for x in (text or "").split("\n")]
        lines = [*lines[:-1], *([lines[-1][:-1]] if lines[-1] != "\n" else [])]
        sizes = [len(x.encode()) for x in lines]
        ends = [sum(sizes[:i + 1]) for i in range(len(sizes))]
        want = sections_of([int(lengths[t]) for t in tokens],
                           [(e - n, e) for e, n in zip(ends, sizes, strict=True)], "largest")
        rows = sorted(got[doc_id], key=lambda r: r.section)
        assert [r.n_tokens for r in rows if r.section >= 0] == want[:-1]
        assert all(r.doc_tokens == len(tokens) for r in rows)
        at = 0
        for r, line in zip([r for r in rows if r.section >= 0], lines, strict=True):
            assert (r.start, r.end) == (at, at + len(line))
            at = r.end


def test_mixture_is_nearer_to_its_targets(spark, sf_dir):
    from collections import Counter

    from hubloom.llm.mixing import EVENING
    rows = QUERIES["op2_mixing"](spark, sf_dir).collect()
    present, kept = Counter(), Counter()
    for r in rows:
        present[r.source] += r.tokens
        kept[r.source] += r.tokens * r.chance
    total = sum(present.values())
    target = {s: (n / total) ** EVENING for s, n in present.items()}
    target = {s: t / sum(target.values()) for s, t in target.items()}
    off = lambda c: sum(abs(c[s] / sum(c.values()) - target[s]) for s in target)
    assert off(kept) < off(present)


def test_mixture_of_all_documents(spark, sf_dir):
    """Chances by a plain version from the documents' cells, draws by the stated hash."""
    from collections import Counter

    from hubloom.llm import mixing
    from plain import chances
    rows = QUERIES["op2_mixing"](spark, sf_dir).collect()
    cells = Counter()
    for r in rows:
        cells[r.source or "(none)", r.lang or "(none)", r.topic] += r.tokens
    want = chances(cells, {}, mixing.FRACTION, mixing.EVENING)
    for r in rows:
        chance = want[r.source or "(none)", r.lang or "(none)", r.topic]
        draw = int(hashlib.md5(f"{mixing.SEED}:{r.doc_id}".encode()).hexdigest()[:13], 16) / 16 ** 13
        assert abs(r.chance - chance) < 1e-5 and r.kept == (draw < r.chance)
        assert r.weight == (1 / r.chance if r.kept else None)


def test_token_counts_add_up(spark, sf_dir):
    rows = QUERIES["op1_token_counts"](spark, sf_dir).groupBy("doc_id").agg(
        {"n_tokens": "sum", "doc_tokens": "max"}).collect()
    assert rows and all(r["sum(n_tokens)"] == r["max(doc_tokens)"] for r in rows)
