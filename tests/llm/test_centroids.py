"""Bit-plane clustering: planes against plain integers, rounds against SQL, odd rows, few vectors."""

import math
import random

import numpy as np
import pytest

from barsmith.llm import centroids, oracles

from ..compare import connect, differences

SCHEMA = "vec_id long, embedding array<float>"


@pytest.mark.parametrize("reach", [1, 2, 300, centroids.LARGEST])
def test_planes_are_exact(reach):
    rng = np.random.default_rng(reach)
    values = rng.integers(-reach, reach, (50, 64))
    other = rng.integers(-3 * reach // 2, 3 * reach // 2, 64)
    planes, one = centroids.packed_planes(values), centroids.packed_planes(other[None, :])[:, 0]
    assert (centroids.unpacked(planes) == values).all()
    assert (centroids.dots(planes, one) == values @ other).all()
    assert (centroids.squares(planes) == (values * values).sum(axis=1)).all()
    zero = centroids.packed_planes(np.zeros((3, 64), np.int64))
    assert (centroids.dots(zero, one) == 0).all() and centroids.packed_planes(np.zeros((0, 64), np.int64)).shape[1] == 0


def vectors(n, seed=5):
    walk = random.Random(seed)
    return [(i, [walk.gauss(walk.choice((-0.4, 0.3)), 0.1) for _ in range(64)]) for i in range(n)]


def odd_rows():
    good = vectors(130)
    same = [(1000 + i, good[0][1]) for i in range(200)]  # one vector as a third of all rows, all ties
    bad = [(1, None), (2, []), (3, [0.0] * 63), (4, [None] + [0.0] * 63), (5, [math.nan] + [0.0] * 63), (6, [math.inf] + [0.0] * 63),
           (7, [0.0] * 65)]
    more = [(None, [0.25] * 64), (None, [0.25] * 64), (8, [-0.0] * 64), (9, [900.0] + [0.0] * 63), (9007199254740993, [0.5] * 64)]
    return good + same + bad + more


def test_odd_rows_by_sql(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as cluster", "1 as id", "'p' as planes").repartition(5)
    con = connect("/root/testdata/sf0.001")
    con.execute("CREATE TABLE odd (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO odd VALUES (?, ?)", rows)
    got = centroids.cluster(df)
    assert differences(got, con, oracles.bit_plane_centroids("odd")) is None
    assert got.count() == len(rows) - 7 and got.filter("vec_id = 9007199254740993").count() == 1


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame(vectors(3), SCHEMA)
    rows = centroids.cluster(df).collect()
    assert sorted(r["cluster"] for r in rows) == [0, 1, 2] and {r["inertia"] for r in rows} == {0}
    empty = centroids.cluster(df.limit(0))
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_values_beyond_the_bound_are_held_at_it(spark):
    df = spark.createDataFrame([(1, [3e38] * 64), (2, [-3e38] * 64), (3, [65536.0] * 64)], SCHEMA)
    rows = {r["vec_id"]: r for r in centroids.cluster(df, count=1, rounds=0).collect()}
    assert rows[1]["distance"] == rows[3]["distance"]


def test_more_rounds_do_not_raise_inertia(spark):
    df = spark.createDataFrame(vectors(300), SCHEMA)
    found = [centroids.cluster(df, 8, r).first()["inertia"] for r in (0, 1, 5)]
    assert found[0] >= found[1] >= found[2]
