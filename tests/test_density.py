import numpy as np
import pytest
from pyspark.sql import functions as F

from audience_engine.operators import density


def planted(seed=3, clusters=4, each=60, noise=25, dims=8):
    """Tight groups far apart, and single rows far from all: rows (id, group, vector), group -1 for noise."""
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(clusters, dims)) * 20
    rows = [(g, centers[g] + draw.normal(size=dims)) for g in range(clusters) for _ in range(each)]
    rows += [(-1, draw.normal(size=dims) * 200) for _ in range(noise)]
    return [(i, g, x.tolist()) for i, (g, x) in enumerate(rows)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, g int, v array<double>")


def exact(rows, k, radius):
    """Clusters by every pair: {id: set of ids of its cluster}, outliers left out."""
    x = np.array([r[2] for r in rows])
    far = np.sqrt(((x[:, None, :] - x[None]) ** 2).sum(axis=2))
    core = np.sort(far + np.diag(np.full(len(x), np.inf)), axis=1)[:, k - 1]
    dense, label = core <= radius, np.full(len(x), -1)
    for s in np.flatnonzero(dense):
        todo = [s] if label[s] < 0 else []
        while todo:
            at = todo.pop()
            if label[at] < 0:
                label[at] = s
                todo += [j for j in np.flatnonzero((far[at] <= radius) & dense) if label[j] < 0]
    for i in np.flatnonzero(~dense):
        near = [j for j in np.flatnonzero(dense) if far[i, j] <= radius]
        if near:
            label[i] = label[min(near, key=lambda j: far[i, j])]
    return label


def partition(ids, labels):
    groups = {}
    for i, g in zip(ids, labels):
        groups.setdefault(g, set()).add(i)
    return {frozenset(s) for g, s in groups.items() if g != -1}


def clustered(df, **options):
    got = density.density_clusters(df, "v", **options).collect()
    return partition([r["id"] for r in got], [r["topic"] for r in got]), got


@pytest.mark.parametrize("limit", [2048, 64])
def test_planted_clusters_and_noise_are_told_apart(spark, limit):
    rows = planted()
    found, got = clustered(frame(spark, rows), min_size=20, limit=limit)
    assert found == partition([r[0] for r in rows], [r[1] for r in rows])
    assert {r["topic"] for r in got} == {-1, 0, 1, 2, 3}
    assert all((r["topic_prob"] > 0) == (r["topic"] >= 0) and r["topic_prob"] <= 1 for r in got)


@pytest.mark.parametrize("radius", [0.15, 0.25, 0.4])
def test_agrees_with_every_pair(spark, radius):
    draw = np.random.default_rng(1)
    rows = [(i, 0, x.tolist()) for i, x in enumerate(draw.uniform(size=(300, 2)) ** 2 * 3)]
    label = exact(rows, 5, radius)
    ids = [r[0] for r in rows]
    assert clustered(frame(spark, rows), neighbours=5, min_size=1, radius=radius)[0] == partition(ids, label)


def test_parts_join_over_the_orders(spark):
    """A long chain of places runs through many parts; its pieces become one cluster."""
    rows = [(i, 0, [i / 10, float(np.sin(i / 50)), 0.0]) for i in range(1500)]
    found, _ = clustered(frame(spark, rows), neighbours=4, min_size=5, radius=1.0, limit=128)
    assert len(found) == 1 and len(next(iter(found))) == 1500


def test_no_noise_gives_no_outliers(spark):
    rows = planted(clusters=1, each=400, noise=0)
    found, _ = clustered(frame(spark, rows), min_size=20)
    assert len(found) == 1 and len(next(iter(found))) == 400


def test_a_third_of_the_rows_are_copies(spark):
    rows = planted()
    rows += [(1000 + i, 0, rows[0][2]) for i in range(140)]
    found, got = clustered(frame(spark, rows), min_size=20, limit=64)
    assert found == partition([r[0] for r in rows], [r[1] for r in rows])
    assert next(r for r in got if r["id"] == 1100)["topic_prob"] == 1.0


def test_crowded_cells_are_dealt(spark):
    """Vectors that agree in every sign are still cut into parts of about the limit."""
    draw = np.random.default_rng(5)
    rows = [(i, 0, (np.array([9.0, 9.0, 9.0]) + draw.normal(size=3) * 1e-3).tolist()) for i in range(3000)]
    rows += [(3000 + i, 0, (draw.normal(size=3) * 500).tolist()) for i in range(600)]
    vectors = density.distinct_vectors(frame(spark, rows), "v")[1].cache()
    parts = density.parts_of(vectors, 3600, 200, 3, 42)
    assert parts.groupBy("part").count().agg(F.max("count")).first()[0] <= 400
    assert {r["count"] for r in parts.groupBy("id").count().collect()} == {3}


def test_rows_without_a_vector_are_outliers(spark):
    rows = planted(clusters=2, each=40, noise=8)
    odd = [None, [], [1.0], [float("nan")] * 8, [float("inf")] * 8, [None] * 8]
    df = frame(spark, rows + [(900 + i, -1, v) for i, v in enumerate(odd)])
    extra = df.withColumns({"_v": F.lit("x"), "part": F.lit(1), "weight": F.lit(2), "topic": F.lit("old"), "core": F.col("g")})
    got = density.density_clusters(extra, "v", min_size=20)
    assert got.columns == ["id", "g", "v", "_v", "part", "weight", "core", "topic", "topic_prob"]
    found = got.collect()
    assert len(found) == len(rows) + len(odd) and {r["_v"] for r in found} == {"x"}
    assert {r["topic"] for r in found if r["id"] >= 900} == {-1}
    assert len({r["topic"] for r in found}) == 3


def test_small_and_empty_tables(spark):
    assert density.density_clusters(frame(spark, []), "v").collect() == []
    one = clustered(frame(spark, [(1, 0, [1.0, 2.0])]), min_size=1)
    assert one[0] == set()
    same = clustered(frame(spark, [(i, 0, [1.0, 2.0]) for i in range(30)]), min_size=5)
    assert len(same[0]) == 1


def test_reruns_agree(spark):
    df = frame(spark, planted(seed=8, each=100))
    runs = [sorted((r["id"], r["topic"], r["topic_prob"]) for r in clustered(d, limit=64, min_size=20)[1]) for d in (df, df.repartition(7, "id"))]
    assert runs[0] == runs[1]
