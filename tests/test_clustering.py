"""What must hold for scaled, clustered and reduced tables."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from refgauge import fixed
from refgauge.operators import clustering
from refgauge.plans.queries import QUERIES
from refgauge.sources import tables
from refgauge.workspace import written

TOY = [0.0, 0.1, 0.2, 9.0, 9.1, 9.2]


@pytest.fixture(scope="module")
def toy(spark):
    rows = [(i, float(i), Vectors.dense([x] * 3)) for i, x in enumerate(TOY)]
    return spark.createDataFrame(rows, ["id", "label", "features"]).coalesce(1)


@pytest.mark.parametrize("algorithm", [clustering.kmeans, clustering.bisecting])
def test_toy_clusters(spark, toy, algorithm):
    model = algorithm(2, vectors="features").fit(toy)
    groups = {}
    for r in model.transform(toy).collect():
        groups.setdefault(r.prediction, set()).add(r.id)
    assert sorted(map(sorted, groups.values())) == [[0, 1, 2], [3, 4, 5]]
    cost = clustering.cluster_cost(toy, model, "features").first()
    assert cost.cost == pytest.approx(0.12) and cost.nearest_cost == pytest.approx(0.12)
    for r in clustering.cluster_centers(toy, model, "features").collect():
        assert r.center == pytest.approx(r["mean"]) and r.n == 3


def test_libsvm_file(spark, toy, tmp_path):
    path = str(tmp_path / "toy")
    tables.write_libsvm(toy.select("label", "features"), path)
    back = tables.read_libsvm(spark, path, 3).orderBy("label").collect()
    assert [list(r.features.toArray()) for r in back] == [[x] * 3 for x in TOY]


def test_scaling_skips_gaps_and_centers_constants(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0), (2, 4.0, 5.0), (3, 1.0, None), (4, 1.0, 5.0), (5, math.nan, 5.0)],
                               "id int, a double, b double")
    found = clustering.scaled(df, ["a", "b"]).orderBy("id").collect()
    assert [(r.id, list(r.scaled_features.toArray())) for r in found] == [
        (1, [0.0, 0.5]), (2, [1.0, 0.5]), (4, [0.25, 0.5])]


def test_model_features(spark):
    df = spark.createDataFrame([(0, "t", 1.0, *[.1] * 6)], ["_c0", "title", "n_words", *fixed.CLASSES])
    assert clustering.model_features(df) == ["n_words"]


def brute_silhouette(points, labels, distance):
    out = []
    for i, (p, c) in enumerate(zip(points, labels)):
        far = {}
        for j, (q, d) in enumerate(zip(points, labels)):
            if i != j:
                far.setdefault(d, []).append(distance(p, q))
        if c not in far:
            out.append(0.0)
            continue
        a = sum(far[c]) / len(far[c])
        b = min(sum(v) / len(v) for k, v in far.items() if k != c)
        out.append(0.0 if a == b else 1 - a / b if a < b else b / a - 1)
    return out


def test_silhouette_equals_all_pairs(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(60, 4)) + np.repeat([[0], [3], [6]], 20, axis=0)
    labels = [0] * 20 + [1] * 20 + [2] * 19 + [3]
    df = spark.createDataFrame(
        [(i, [float(x) for x in p], c) for i, (p, c) in enumerate(zip(points, labels))],
        "id int, point array<double>, c int",
    )
    expected = brute_silhouette(points, labels, lambda p, q: float(((p - q) ** 2).sum()))
    found = clustering.silhouette_points(df, "point", "c").orderBy("id").collect()
    assert [r.silhouette for r in found] == pytest.approx(expected, abs=1e-9)
    vectors = df.select(array_to_vector("point").alias("v"), "c")
    assert clustering.silhouette(vectors, "v", "c") == pytest.approx(sum(expected) / 60, abs=1e-9)


def test_cluster_label_takes_the_majority(spark):
    rows = [(1, 0, "a"), (2, 0, "a"), (3, 0, "b"), (4, 0, None), (5, 1, "c"), (6, 1, "b"), (7, 1, None), (8, 2, None)]
    df = spark.createDataFrame(rows, "id int, prediction int, label string")
    found = {r.id: r.label_or_cluster for r in clustering.cluster_label(df, "label").collect()}
    assert found == {1: "a", 2: "a", 3: "b", 4: "a", 5: "c", 6: "b", 7: "b", 8: None}


def test_silhouette_far_from_zero(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(80, 3)) * 3
    points[:, 0] += 3e8
    points[40:, 0] += 100
    labels = [0] * 40 + [1] * 40
    df = spark.createDataFrame(
        [(i, [float(x) for x in p], c) for i, (p, c) in enumerate(zip(points, labels))], "id int, point array<double>, c int"
    )
    expected = brute_silhouette(points, labels, lambda p, q: float(((p - q) ** 2).sum()))
    found = [r.silhouette for r in clustering.silhouette_points(df, "point", "c").orderBy("id").collect()]
    assert found == pytest.approx(expected, abs=1e-9) and max(found) <= 1


def test_many_clusters(spark):
    df = spark.range(3300).selectExpr(
        "id", "cast(id % 1100 AS int) AS prediction", "array(double(id % 1100), double(id % 7)) AS point",
        "CASE WHEN id < 2200 THEN concat('l', id % 1100) END AS label",
    ).repartition(6)
    placed = clustering.cluster_label(df, "label")
    assert placed.filter("label_or_cluster <> concat('l', prediction)").count() == 0 and placed.count() == 3300
    assert clustering.silhouette_points(df, "point", "prediction").filter("silhouette IS NULL").count() == 0
    centers = clustering.group_centers(df, "prediction", "point")
    assert centers.count() == 1100
    assert clustering.nearest_center(df.drop("prediction"), centers, "point").filter("id <> prediction AND id < 1100 AND cost = 0").count() == 0


def test_blocks_and_packs_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(9)
    points, labels = rng.normal(size=(90, 3)), rng.integers(0, 30, 90).tolist()
    rows = [(i, [float(x) for x in p], c if c else None) for i, (p, c) in enumerate(zip(points, labels))]
    df = spark.createDataFrame(rows, "id int, point array<double>, c int").repartition(3)
    expected = brute_silhouette(points, labels, lambda p, q: float(((p - q) ** 2).sum()))
    far = ((points[:, None] - points[None, :40]) ** 2).sum(2)
    monkeypatch.setattr(clustering, "PACK", 7)
    monkeypatch.setattr(clustering.held_against, "__defaults__", (6, 2))
    found = clustering.silhouette_points(df, "point", "c").orderBy("id").collect()
    assert [r.silhouette for r in found] == pytest.approx(expected, abs=1e-9)
    centers = df.filter("id < 40").select("id", "point")
    near = clustering.nearest_center(df, centers, "point").orderBy("id").collect()
    assert [r.prediction for r in near] == far.argmin(1).tolist()
    assert [r.cost for r in near] == pytest.approx(far.min(1).tolist())
    ties = clustering.nearest_center(df, centers.withColumn("point", F.array(*[F.lit(0.0)] * 3)), "point")
    assert {r.prediction for r in ties.collect()} == {0}


def test_hundred_thousand_clusters(spark):
    """Two rows a cluster, on a line: the nearest other cluster is a neighbour."""
    df = spark.range(200_000).selectExpr("id", "id % 100000 AS c", "array(double(id % 100000), double(id div 100000)) AS point")
    sums = clustering.cluster_sums(df, array_to_vector("point"), "c").select("c", "n", "mean", "sse")
    kept = df.filter("id % 1000 = 7")
    found = clustering.nearest_center(kept, sums.select(F.col("c").cast("int"), "mean"), "point")
    assert found.count() == 200 and found.filter("prediction <> c OR cost <> 0.25").count() == 0
    placed = clustering.silhouette_points(df.withColumn("point", F.when(F.col("c") % 1000 < 3, F.col("point"))), "point", "c")
    # Distances to the other row: 1; to both rows of a neighbour on average (1 + 2) / 2.
    assert placed.filter("intra = 1 AND nearest = 1.5 AND abs(silhouette - 1 / 3D) < 1e-9").count() == 600
    assert placed.filter("point IS NULL AND silhouette IS NULL").count() == 199_400


def test_null_points_have_no_place(spark):
    df = spark.createDataFrame([(1, [0.0], 0), (2, None, 0), (3, [5.0], 1)], "id int, point array<double>, c int")
    near = {r.id: (r.prediction, r.cost) for r in clustering.nearest_center(df, [[1.0], [4.0]], "point").collect()}
    assert near == {1: (0, 1.0), 2: (None, None), 3: (1, 1.0)}
    assert clustering.silhouette_points(df, "point", "c").filter("id = 2").first().silhouette is None


def test_sweep_marks_the_best_k(spark, toy):
    df = toy.select("id", *[vector_to_array("features")[i].alias(f"x{i}") for i in range(3)])
    rows = clustering.k_sweep(df, ["x0", "x1", "x2"], ks=range(2, 5)).collect()
    assert sorted((r.algorithm, r.k) for r in rows) == [(a, k) for a in ("bisecting", "kmeans") for k in (2, 3, 4)]
    assert [(r.algorithm, r.k) for r in rows if r.best] in (
        [("bisecting", 2), ("kmeans", 2)], [("kmeans", 2), ("bisecting", 2)])


def test_fits_do_not_depend_on_layout(spark, sf):
    """On the package's own features, whose clusters lie close together."""
    table = written(QUERIES["feature_table"](spark, sf).select("title", *fixed.FEATURES), "test-features")
    names = list(fixed.FEATURES)
    doubled = table.union(table.filter("n_words % 3 = 0"))
    found = []
    for n, order in ((1, "title"), (4, "n_words"), (16, "level2")):
        laid = doubled.repartition(n, F.col(order)).sortWithinPartitions(F.col(order).desc())
        sweep = clustering.k_sweep(laid, names, ks=(3, 5))
        costs = {(r.algorithm, r.k): (r.cost, r.silhouette) for r in sweep.collect()}
        placed = clustering.fit_clusters(laid, names, clustering.bisecting(4)).transform(laid)
        found.append((costs, sorted((r.title, r.prediction) for r in placed.select("title", "prediction").collect())))
    for costs, places in found[1:]:
        assert costs.keys() == found[0][0].keys() and places == found[0][1]
        for key, values in costs.items():
            assert values == pytest.approx(found[0][0][key], rel=1e-9)


def test_settled_vectors_count_their_rows(spark):
    df = spark.createDataFrame([(Vectors.dense([float(k % 3), 1.0]),) for k in range(10)], ["v"]).repartition(5)
    rows = clustering.settled(df, "v", per_task=2).collect()
    assert sorted((tuple(r.v.toArray()), r.weight) for r in rows) == [((0.0, 1.0), 4.0), ((1.0, 1.0), 3.0), ((2.0, 1.0), 3.0)]


def test_rows_meet_centers_in_small_batches(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, f"{64 << 20}b")
        points = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(5)], "id int, point array<double>")
        found = clustering.nearest_center(points, [[0.0, 0.0], [4.0, 0.0]], "point")
        assert [r.prediction for r in found.orderBy("id").collect()] == [0, 0, 0, 1, 1]
        assert int(spark.conf.get(setting)) <= 4 << 20
    finally:
        spark.conf.set(setting, before)
