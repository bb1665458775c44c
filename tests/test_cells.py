import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbsight.operators import cells, nearest
from curbsight.sources import adapters
from tests.helpers import plan, rows


def grouped(spark, groups=30, size=40, dim=8, seed=1):
    """Vectors around some points, with copies."""
    rng = np.random.default_rng(seed)
    points = rng.normal(0, 10, (groups, dim))
    data = [(int(g * size + i), (points[g] + rng.normal(0, 0.5, dim)).tolist()) for g in range(groups) for i in range(size)]
    data += [(100_000 + i, data[0][1]) for i in range(50)]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>"), points


def asked(spark, points, seed=2):
    rng = np.random.default_rng(seed)
    return spark.createDataFrame([(i, (p + rng.normal(0, 1, len(p))).tolist()) for i, p in enumerate(points)], "query_id long, embedding array<double>")


def found(df):
    return sorted((r.query_id, r.position, r.vec_id, round(r.d2, 9)) for r in df.collect())


@pytest.mark.parametrize("k", [1, 5, 200])
def test_like_the_full_search(spark, folder, k):
    vectors, points = grouped(spark)
    index = cells.build(vectors, f"{folder}/index", cells=25)
    queries = asked(spark, points)
    assert found(cells.search(index, queries, k)) == found(nearest.nearest(vectors, queries, k))


def test_like_the_full_search_on_the_shared_vectors(spark, sf_dir, folder):
    vectors = adapters.vectors(spark, sf_dir)
    queries = vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    index = cells.build(vectors, f"{folder}/index", cells=12)
    assert found(cells.search(cells.load(spark, f"{folder}/index"), queries)) == found(nearest.nearest(vectors, queries))
    assert index.sizes.sum() == vectors.count()


def test_far_cells_are_not_read(spark, folder):
    vectors, points = grouped(spark)
    index = cells.build(vectors, f"{folder}/index", cells=25)
    queries = asked(spark, points[:2])
    wanted = cells._wanted(index, queries, 5, None)
    worst = nearest.nearest(vectors, queries).groupBy("query_id").agg(F.max("d2").alias("worst"))
    further = cells._wanted(index, queries.join(worst, "query_id"), 5, None, first_seen=True)
    read = set(cells.cells_read(index, wanted)) | set(cells.cells_read(index, further))
    assert 0 < len(read) < len(index.cells) / 2
    text = plan(index.vectors.where(F.col("cell").isin(sorted(read))))
    assert "PartitionFilters: [cell" in text


def test_a_visit_limit_keeps_most_neighbours(spark, folder):
    vectors, points = grouped(spark, groups=60)
    index = cells.build(vectors, f"{folder}/index", cells=40)
    queries = asked(spark, points)
    exact = {(q, v) for q, _, v, _ in found(nearest.nearest(vectors, queries))}
    limited = {(q, v) for q, _, v, _ in found(cells.search(index, queries, visits=3))}
    assert len(exact & limited) / len(exact) >= 0.9


def test_cells_and_queries_are_cut(spark, folder, monkeypatch):
    monkeypatch.setattr(nearest, "CHUNK_ROWS", 20)
    vectors, points = grouped(spark, groups=4, size=30)
    index = cells.build(vectors, f"{folder}/index", cells=3)
    queries = asked(spark, np.repeat(points, 12, axis=0))
    assert found(cells.search(index, queries)) == found(nearest.nearest(vectors, queries))


def test_all_vectors_alike(spark, folder):
    vectors = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(100)], "vec_id long, embedding array<double>")
    index = cells.build(vectors, f"{folder}/index")
    queries = spark.createDataFrame([(1, [0.0, 0.0])], "query_id long, embedding array<double>")
    assert [r[2] for r in found(cells.search(index, queries))] == [0, 1, 2, 3, 4]


def test_fewer_vectors_than_k_and_none(spark, folder):
    queries = spark.createDataFrame([(1, [0.0, 0.0])], "query_id long, embedding array<double>")
    few = spark.createDataFrame([(7, [1.0, 2.0]), (8, [3.0, 4.0])], "vec_id long, embedding array<double>")
    assert [r[2] for r in found(cells.search(cells.build(few, f"{folder}/few"), queries))] == [7, 8]
    assert rows(cells.search(cells.build(few, f"{folder}/again"), queries.limit(0))) == []


def test_bad_vectors_fail(spark, folder):
    with pytest.raises(Exception, match="must"):
        cells.build(spark.createDataFrame([(1, None)], "vec_id long, embedding array<double>"), f"{folder}/index")


def test_tasks_need_no_copy_of_the_package(sf_dir, tmp_path):
    """In a session whose Python workers, unlike the driver, can't import the library."""
    code = """if True:
        import sys
        sys.path.insert(0, sys.argv[1])
        from curbsight.plans.queries import QUERIES
        from curbsight.session import local_session
        spark = local_session(2, "workers without the package")
        print("rows:", QUERIES["knn_cells"](spark, sys.argv[2]).count())
    """
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    ran = subprocess.run([sys.executable, "-c", code, repo, sf_dir], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300)
    assert "rows: 50" in ran.stdout, ran.stderr[-2000:]
