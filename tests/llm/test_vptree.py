import numpy as np
import pytest

from conftest import SF_SMALL
from quarry.llm import queries, vptree
from tools_compare import same_rows


def brute(ids, vecs, qid, q, k):
    c = vptree.cosine(q[None], vecs)[0]
    order = sorted((-c[j], ids[j]) for j in range(len(ids)) if ids[j] != qid)
    return order[:k]


def test_query_equals_sql(spark, duck):
    df = queries.op2_nearest_vectors(spark, SF_SMALL)
    rel = duck.execute(queries.OP2_SQL)
    ok, why = same_rows(df.columns, [tuple(r) for r in df.collect()], [c[0] for c in rel.description], rel.fetchall())
    assert ok, why


@pytest.mark.parametrize("kind", ["random", "clusters", "copies"])
def test_factor_one_is_exact(kind):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 16))
    if kind == "clusters":
        x = rng.normal(size=(10, 16))[rng.integers(0, 10, 3000)] * 4 + x * 0.3
    if kind == "copies":
        x[rng.random(3000) < 0.4] = x[7]
    ids = rng.permutation(3000).astype(np.int64)
    tree = vptree.VPTree(ids, x)
    score, found = tree.search(ids[:60], x[:60], 5)
    for r in range(60):
        want = brute(ids, x, ids[r], x[r], 5)
        assert [(-s, i) for s, i in want] == list(zip(score[r].tolist(), found[r].tolist()))
    exact = tree.visited
    relaxed, near = tree.search(ids[:60], x[:60], 5, factor=2.0)
    assert tree.visited <= exact
    if kind == "clusters":
        assert exact < 60 * 3000 and (near == found).mean() >= 0.5


def test_edges(spark):
    schema = "vec_id long, embedding array<float>, label int, rank int, score double, shard int, v int, id int"
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]),
            (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (9, [1.0]), (50, [-1.0, 0.5]),
            (50, [-1.0, 0.5]), (100, None)]
    df = spark.createDataFrame([(i, v, 1, 2, 0.5, 3, 4, 5) for i, v in rows], schema)
    got = vptree.nearest(df, df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [
        (0, 1, 1), (0, 2, 2), (0, 3, 3), (0, 4, 50), (0, 5, 50),
        (50, 1, 3), (50, 2, 0), (50, 3, 1), (50, 4, 2)]
    assert vptree.nearest(df.where("false"), df.where("false")).count() == 0
    assert vptree.nearest(df, df.where("false")).count() == 0


def test_many_shards_and_blocks(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    q = df.where("vec_id % 7 = 0")
    one = vptree.nearest(df, q).orderBy("query_id", "rank").collect()
    many = vptree.nearest(df, q, shard_rows=40, block_rows=9).orderBy("query_id", "rank").collect()
    assert one == many and len(one) == 5 * q.count()


def test_nothing_is_broadcast(spark):
    """Every query meets every shard: Spark takes that table for a small one and sent it to the driver."""
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rng.normal(size=(300, 8)).tolist())], "vec_id long, embedding array<double>")
    got = vptree.nearest(df, df, shard_rows=20, block_rows=7)
    rows = got.collect()
    assert len(rows) == 5 * 300 and "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_shards_and_turns_together(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 4))
    x[rng.random(400) < 0.2] = x[5]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    for name, value in (("MANY", 3), ("TOGETHER", 3), ("TURN", 11), ("LEAF", 5)):
        monkeypatch.setattr(vptree, name, value)
    got = {}
    for r in vptree.nearest(df, df.where("vec_id % 8 = 0"), shard_rows=30, block_rows=4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    ids = np.arange(400)
    assert got == {i: brute(ids, x, i, x[i], 5) for i in range(0, 400, 8)}
