"""One source, text, passage, vector and conversation hold a third of all rows each."""

import os
import shutil

import pytest
from oracle_check import TABLES, differences, oracle_connection

from hubloom.llm.oracle import ORACLE_SQL
from hubloom.llm.queries import QUERIES

CROWDED = """
WITH d AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS rn FROM documents),
one AS (SELECT text FROM documents WHERE length(text) BETWEEN 600 AND 3000
        ORDER BY doc_id LIMIT 1),
item AS (SELECT text FROM benchmark ORDER BY item_id LIMIT 1)
SELECT doc_id, CASE rn % 3 WHEN 0 THEN one.text WHEN 1 THEN d.text || ' ' || item.text
         ELSE d.text || E'\\n' || one.text END AS text,
       lang, CASE WHEN rn % 3 < 2 THEN 'one source' ELSE source END AS source, n_chars
FROM d, one, item"""
CROWDED_VECTORS = """
WITH one AS (SELECT embedding AS v FROM embeddings ORDER BY vec_id LIMIT 1)
SELECT vec_id, CASE WHEN vec_id % 3 = 1 THEN v ELSE embedding END AS embedding, label
FROM embeddings, one"""
CROWDED_CONVERSATIONS = """
WITH turns AS (SELECT turn, role, text FROM conversations WHERE conv_id = 0)
SELECT conv_id, turn, role, text FROM conversations
UNION ALL
SELECT 100000 + i, turn, role, text FROM turns, range(60) r(i)
UNION ALL
SELECT 200000, i, 'user', 'step ' || i FROM range(300) r(i)"""
CHANGED = {"documents": CROWDED, "embeddings": CROWDED_VECTORS,
           "conversations": CROWDED_CONVERSATIONS}
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "7",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "13",
}


@pytest.fixture(scope="module")
def crowded(sf_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("crowded"))
    source = oracle_connection(sf_dir)
    for table in TABLES:
        if table in CHANGED:
            source.execute(f"COPY ({CHANGED[table]}) TO '{out}/{table}.parquet' (FORMAT parquet)")
        else:
            shutil.copyfile(os.path.join(sf_dir, f"{table}.parquet"), f"{out}/{table}.parquet")
    return out, oracle_connection(out)


@pytest.fixture
def small(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_crowded_tables(small, crowded, name):
    assert differences(QUERIES[name](small, crowded[0]), crowded[1], ORACLE_SQL[name]) == []


def test_crowded_mixture(small, crowded):
    from collections import Counter

    from hubloom.llm import mixing
    from plain import chances
    rows = QUERIES["op2_mixing"](small, crowded[0]).collect()
    cells = Counter()
    for r in rows:
        cells[r.source or "(none)", r.lang or "(none)", r.topic] += r.tokens
    want = chances(cells, {}, mixing.FRACTION, mixing.EVENING)
    assert all(abs(r.chance - want[r.source or "(none)", r.lang or "(none)", r.topic]) < 1e-5
               for r in rows)


def test_crowded_packing(small, crowded):
    """Copies of one text lie in one place of the curve, in as many ranges as it takes."""
    from collections import Counter
    pieces = QUERIES["op11_packing"](small, crowded[0]).collect()
    lengths, sizes = Counter(), Counter()
    for p in pieces:
        lengths[p.doc_id] += p.length
        sizes[p.sequence_id] += p.length
        assert p.length <= p.doc_tokens
    assert {p.doc_id: p.doc_tokens for p in pieces} == lengths
    full = sum(sizes.values()) // 4096
    assert all(sizes[i] == 4096 for i in range(full)) and len(sizes) <= full + 12
