"""Hard negatives against SQL on hostile rows, with blocks of any size."""

import math
import random

import duckdb
import pytest

from spikeloom.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, score long, slot string, tag string"


def hostile():
    r, out = random.Random(8), []
    for k in range(700):
        if k % 3:  # one vector of many rows
            out.append((k, [0.5, -0.25, 0.125, 1.0], k % 4))
        else:
            out.append((k, [r.uniform(-1, 1) for _ in range(4)], r.choice([0, 1, 2, 3, 9])))
    out += [(700, None, 1), (800, [1.0, None, 0.0, 0.0], 1), (900, [1.0, math.nan, 0.0, 0.0], 2), (1000, [math.inf, 0.0, 0.0, 0.0], 2), (1100, [1.0, 0.0, 0.0, 0.0], None), (None, [1.0, 0.0, 0.0, 0.0], 1)]
    out += [out[100], out[100], (200, [0.9, 0.1, 0.0, 0.0], 2), (1200, [1e6, 3.0, 0.0, 0.0], 7), (1201, [1e5, 1.0, 2.0, 0.0], 7), (1202, [0.9e5, 1.0, 2.0, 0.0], 8), (1300, [0.0, 0.0, 0.0, 0.0], 5), (1301, [0.0, 0.0, 0.0, 1e-9], 5), (1400, [-1.0, 0.0, 0.0, 0.0], 6), (1401, [1.0, 0.0, 0.0, 0.0], 6)]
    r.shuffle(out)
    return [(*x, 1, "clash", None) for x in out]


def answers(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", [x[:3] for x in rows])
    cur = con.execute(negatives.ORACLE_SQL)
    names = [c[0] for c in cur.description]
    return names, sorted(cur.fetchall())


@pytest.mark.parametrize(("block", "tile"), [(1 << 17, 1 << 21), (2, 64), (64, 640)])
def test_against_sql(spark, monkeypatch, block, tile):
    monkeypatch.setattr(negatives, "ANCHORS", block)
    monkeypatch.setattr(negatives, "ROWS", 50 * block)
    monkeypatch.setattr(negatives, "TILE", tile)
    rows = hostile()
    names, want = answers(rows)
    got = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got.columns == names
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100


def test_by_hand(spark):
    """Scores of the anchor 100 (label 1): positives 10 and 8, negatives 10, 9, 8, 6 and -3."""
    vectors = [(100, 1.0, 1), (1, 10.0, 1), (2, 8.0, 1), (3, 10.0, 2), (4, 9.0, 2), (5, 8.0, 3), (6, 6.0, 3), (8, -3.0, 3), (9, -1.0, 1)]
    rows = spark.createDataFrame([(i, [x / 16], label) for i, x, label in vectors], "vec_id long, embedding array<float>, label int")
    unit = 16 * 16
    got = sorted(tuple(r) for r in negatives.hard_negatives(rows).collect())
    assert got == [(100, 1, 1, 3, 10 * unit, 10 * unit), (100, 1, 2, 4, 10 * unit, 9 * unit), (100, 1, 3, 5, 10 * unit, 8 * unit), (100, 2, 1, 5, 8 * unit, 8 * unit)]
    assert negatives.hard_negatives(rows.limit(0)).count() == 0
