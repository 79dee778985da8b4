"""Scaling, clustering and reduction of feature tables with Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import PCA, MinMaxScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from refgauge import fixed
from refgauge.workspace import bounded_batches, written

RAW, SCALED, CLUSTER = "features", "scaled_features", "prediction"

# Seeds of the two algorithms in a sweep over k, and of the final model. Fixed values.
KMEANS_SEED, BISECTING_SEED, FINAL_SEED, FINAL_K = 1, 10, 1, 3
SWEEP = range(3, 11)

# Rows of a table that are broadcast at once, rows that meet them at once, and how many such meetings follow
# each other before their results are written.
BLOCK, PACK, CHAINED = 4096, 2048, 16
WEIGHT, PER_TASK = "weight", 50_000  # distinct vectors a task of a fit has
NO_NAME = "\x00"  # the cluster of rows whose cluster is NULL


def model_features(df: DataFrame, drop: Sequence[str] = ("_c0", "title", *fixed.CLASSES)) -> list[str]:
    """Columns to cluster by: all but the index, the title and the class scores."""
    return df.drop(*drop).columns


def assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The features as one vector column; rows with NULL or NaN features are dropped."""
    return _assembler(features).transform(df)


def scaling(features: Sequence[str]) -> list:
    """Pipeline stages from feature columns to vectors scaled to [0, 1]."""
    return [_assembler(features), MinMaxScaler(inputCol=RAW, outputCol=SCALED)]


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=RAW, handleInvalid="skip")


def scaled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """`df` with raw and scaled vectors; a constant feature becomes 0.5."""
    return Pipeline(stages=scaling(features)).fit(df).transform(df)


def kmeans(k: int, seed: int = KMEANS_SEED, vectors: str = SCALED) -> KMeans:
    return KMeans(featuresCol=vectors, predictionCol=CLUSTER, k=k, seed=seed)


def bisecting(k: int = FINAL_K, seed: int = FINAL_SEED, vectors: str = SCALED) -> BisectingKMeans:
    return BisectingKMeans(featuresCol=vectors, predictionCol=CLUSTER, k=k, seed=seed)


def settled(df: DataFrame, vectors: str = SCALED, per_task: int = PER_TASK) -> DataFrame:
    """The distinct vectors with how often each comes (`weight`), laid out by their content alone.

    Fits draw their first centers partition by partition and add up in the order of rows. Here the
    number of partitions follows from that of the vectors, a hash deals them out, and each
    partition is sorted, so a fit finds the same wherever rows were read. Equal rows are counted before they
    are moved, so many of them make no partition large.
    """
    counted = written(df.groupBy(vector_to_array(vectors).alias("_point")).agg(
        F.count(F.lit(1)).cast("double").alias(WEIGHT)), "vectors")
    tasks = max(1, -(-counted.count() // per_task))
    dealt = counted.repartition(tasks, F.xxhash64("_point")).sortWithinPartitions("_point")
    return dealt.select(array_to_vector("_point").alias(vectors), WEIGHT)


def fit_clusters(df: DataFrame, features: Sequence[str], algorithm) -> PipelineModel:
    """Scaling and clusters as one model, which does not depend on how the rows of `df` lie in tasks."""
    scaler = Pipeline(stages=scaling(features)).fit(df)
    points = settled(scaler.transform(df)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = algorithm.copy().setWeightCol(WEIGHT).fit(points)
    finally:
        points.unpersist()
    return PipelineModel(stages=[*scaler.stages, model])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def cluster_centers(df: DataFrame, model, vectors: str = SCALED) -> DataFrame:
    """Rows (cluster, n, center, mean): the center of the model, and the mean of its rows."""
    # k rows of d numbers: bounded by the parameters of the model.
    centers = df.sparkSession.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
        f"{CLUSTER} int, center array<double>",
    )
    means = (
        model.transform(df)
        .groupBy(CLUSTER)
        .agg(F.count("*").alias("n"), vector_to_array(Summarizer.mean(F.col(vectors))).alias("mean"))
    )
    return centers.join(means, CLUSTER, "left").select(CLUSTER, "n", "center", "mean")


def squared_norm(point: Column) -> Column:
    return F.aggregate(point, F.lit(0.0), lambda total, x: total + x * x)


def _matrix(points: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The points that are not NULL as rows of numbers, and where they are."""
    at = np.flatnonzero(points.is_valid().to_numpy(zero_copy_only=False))
    flat = points.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(at), -1) if len(at) else np.empty((0, 0)), at


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _batch(data: pa.Buffer) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as stream:
        return stream.read_next_batch()


def held_against(
    df: DataFrame, table: DataFrame, key: str, fields: dict[str, float], update: Callable[..., None],
    block: int = BLOCK, chained: int = CHAINED,
) -> DataFrame:
    """`df` with columns of doubles that every row gets from all rows of `table`, however many those are.

    The table is stored and dealt into blocks of about `block` rows by a hash of `key`. Rows of `df`
    are packed a few thousand at a time; each pack meets one block after the other, which is
    broadcast alone, and `update(rows, fields, block)` changes the fields in place. Packs are written
    out after every `chained` blocks, so neither plans nor what tasks hold grow with the table.
    Rows are not shuffled, and of the table the driver learns the number of rows.
    """
    bounded_batches(df.sparkSession)  # what a worker holds is some batches
    kept = written(table, "blocks")
    n_blocks = max(1, -(-kept.count() // block))
    dealt = kept.withColumn("_block", F.pmod(F.xxhash64(key), F.lit(n_blocks)))
    n, names = len(df.columns), [*df.columns, *fields]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PACK):
                rows = whole.slice(at, PACK)
                own = [pa.array(np.full(rows.num_rows, float(v))) for v in fields.values()]
                rows = pa.RecordBatch.from_arrays([*rows.columns, *own], [str(k) for k in range(n + len(own))])
                yield pa.RecordBatch.from_arrays([pa.array([_ipc(rows)], pa.binary())], ["pack"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pairs in batches:
            found = pairs.column("held")[:1].flatten() if pairs.num_rows else None
            for data in pairs.column("pack"):
                rows = _batch(data.as_buffer())
                own = {name: rows.column(n + k).to_numpy().copy() for k, name in enumerate(fields)}
                update(rows.columns[:n], own, found)
                columns = [*rows.columns[:n], *(pa.array(x) for x in own.values())]
                data = _ipc(pa.RecordBatch.from_arrays(columns, rows.schema.names))
                yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["pack"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for packs in batches:
            for data in packs.column("pack"):
                rows = _batch(data.as_buffer())
                yield pa.RecordBatch.from_arrays(rows.columns, names)

    packs = df.mapInArrow(pack, "pack binary")
    for number in range(n_blocks):
        one = dealt.filter(F.col("_block") == number).agg(F.collect_list(F.struct(*table.columns)).alias("held"))
        packs = packs.crossJoin(F.broadcast(one)).mapInArrow(meet, "pack binary")
        if number % chained == chained - 1:
            packs = written(packs, "packs")
    schema = reduce(lambda s, name: s.add(name, "double"), fields, StructType(list(df.schema.fields)))
    return packs.mapInArrow(unpack, schema)


def nearest_center(df: DataFrame, centers: DataFrame | Sequence[Sequence[float]], values: str) -> DataFrame:
    """Number of the closest center of each row and the squared distance to it, the least number on ties.

    centers: a table (number, center) of any size, or k points of the caller, numbered from 0. NULL
    points have neither.
    """
    if not isinstance(centers, DataFrame):
        rows = [(i, [float(x) for x in c]) for i, c in enumerate(centers)]
        centers = df.sparkSession.createDataFrame(rows, f"{CLUSTER} int, center array<double>")
    centers = centers.toDF("number", "center").filter("number IS NOT NULL AND center IS NOT NULL")
    place = df.columns.index(values)

    def update(columns: list[pa.Array], own: dict[str, np.ndarray], held: pa.StructArray) -> None:
        points, at = _matrix(columns[place])
        cost, number = own["cost"][at], own["_number"][at]
        means, _ = _matrix(held.field("center")) if len(held) and len(at) else ((), ())
        for i, mean in zip(held.field("number").to_pylist(), means):
            far = ((points - mean) ** 2).sum(1)
            nearer = (far < cost) | (far == cost) & (i < number)
            number[nearer], cost[nearer] = i, far[nearer]
        own["cost"][at], own["_number"][at] = cost, number

    found = held_against(df, centers, "number", {"cost": np.inf, "_number": -1.0}, update)
    known = F.col("_number") >= 0
    return found.select(
        *df.columns, F.when(known, F.col("_number").cast("int")).alias(CLUSTER), F.when(known, F.col("cost")).alias("cost")
    )


def group_centers(df: DataFrame, group: str, values: str) -> DataFrame:
    """Rows (cluster, center): the mean point of each group, under the number of the group."""
    mean = vector_to_array(Summarizer.mean(array_to_vector(F.col(values))))
    return df.groupBy(F.col(group).cast("int").alias(CLUSTER)).agg(mean.alias("center"))


def cluster_cost(df: DataFrame, model, vectors: str = SCALED) -> DataFrame:
    """Sum of squared distances to the own center, as the model states it and as recomputed."""
    centers = [[float(x) for x in c] for c in model.clusterCenters()]
    placed = nearest_center(df.select(vector_to_array(vectors).alias("point")), centers, "point")
    return placed.agg(
        F.lit(len(centers)).alias("k"),
        F.lit(float(model.summary.trainingCost)).alias("cost"),
        F.sum("cost").alias("nearest_cost"),
    )


def cluster_sums(df: DataFrame, vectors: Column, cluster: str) -> DataFrame:
    """Rows (c, n, mean, sse): size, mean and squared deviations from it of each cluster, in one pass."""
    sums = df.groupBy(F.col(cluster).cast("string").alias("c")).agg(
        Summarizer.metrics("count", "mean", "variance").summary(vectors).alias("s")
    )
    spread = F.aggregate(vector_to_array("s.variance"), F.lit(0.0), lambda total, x: total + x)
    n = F.col("s.count")
    return sums.select("c", n.alias("n"), vector_to_array("s.mean").alias("mean"), (spread * (n - 1)).alias("sse"))


def silhouette_points(df: DataFrame, values: str, cluster: str) -> DataFrame:
    """Silhouette of every row over squared distances, from sums per cluster instead of pairs.

    The squared distances of x to the n rows of a cluster with mean m add up to n*|x - m|^2 + sse,
    which has no large terms that cancel, wherever the points lie. Sums stay a table, against blocks
    of which the rows are held. NULL points have no silhouette.
    """
    known = df.filter(F.col(values).isNotNull())
    sums = cluster_sums(known, array_to_vector(F.col(values)), cluster).withColumn("c", F.coalesce("c", F.lit(NO_NAME)))
    name = F.coalesce(F.col(cluster).cast("string"), F.lit(NO_NAME))
    named = df.withColumn("_name", name)
    place = df.columns.index(values)

    def update(columns: list[pa.Array], own: dict[str, np.ndarray], held: pa.StructArray) -> None:
        points, at = _matrix(columns[place])
        if not len(held) or not len(at):
            return
        codes = {c: i for i, c in enumerate(held.field("c").to_pylist())}
        mine = np.array([codes.get(c, -1) for c in columns[-1].to_pylist()], np.int64)[at]
        intra, nearest, size = own["intra"][at], own["nearest"][at], own["_n"][at]
        counts, spread = held.field("n").to_numpy(), held.field("sse").to_numpy()
        for i, mean in enumerate(_matrix(held.field("mean"))[0]):
            n, total = counts[i], counts[i] * ((points - mean) ** 2).sum(1) + spread[i]
            inside = mine == i
            intra[inside], size[inside] = total[inside] / max(n - 1, 1), n
            nearest[~inside] = np.minimum(nearest[~inside], total[~inside] / n)
        own["intra"][at], own["nearest"][at], own["_n"][at] = intra, nearest, size

    found = held_against(named, sums, "c", {"intra": np.inf, "nearest": np.inf, "_n": 0.0}, update)
    given = {c: F.when(F.col(c) != float("inf"), F.col(c)) for c in ("intra", "nearest")}
    a, b = F.col("intra"), F.col("nearest")
    value = F.when((F.col("_n") == 1) | (a == b), F.lit(0.0)).when(a < b, 1 - a / b).otherwise(b / a - 1)
    return found.withColumns(given).withColumn("silhouette", value).drop("_name", "_n")


def silhouette(df: DataFrame, vectors: str = SCALED, cluster: str = CLUSTER) -> float:
    """Mean silhouette over squared distances; see `silhouette_points`."""
    points = df.select(vector_to_array(vectors).alias("point"), cluster)
    return silhouette_points(points, "point", cluster).agg(F.avg("silhouette")).first()[0]


def cluster_label(df: DataFrame, label: str, cluster: str = CLUSTER) -> DataFrame:
    """Rows without a label take the most common one of their cluster, the smallest on ties.

    Labels are counted before anything moves. What is joined back is one row per cluster, however
    many there are; Spark sends it to all tasks if it is small, and else splits large clusters.
    """
    counts = df.filter(F.col(label).isNotNull()).groupBy(cluster, label).agg(F.count("*").alias("_n"))
    common = counts.groupBy(cluster).agg(
        F.min_by(F.col(label), F.struct(-F.col("_n"), F.col(label))).alias("cluster_label")
    )
    return df.join(common, cluster, "left").withColumn(
        "label_or_cluster", F.coalesce(F.col(label), F.col("cluster_label"))
    )


def k_sweep(df: DataFrame, features: Sequence[str], ks: Iterable[int] = SWEEP, parallelism: int = 8) -> DataFrame:
    """Rows (algorithm, k, cost, silhouette, best): both algorithms for each k.

    Clusters are fit on scaled features and judged on unscaled ones. Both tables of vectors are
    kept for the fits, on disk where memory is short. Each fit is many short jobs, so a few fits
    share the cluster. `best` marks the k of the highest silhouette of each algorithm. Fits go over
    `settled` vectors, so they do not depend on how rows lie in tasks.
    """
    points = scaled(df, features).select(RAW, SCALED).persist(StorageLevel.MEMORY_AND_DISK)
    distinct = settled(points).persist(StorageLevel.MEMORY_AND_DISK)

    def judged(task) -> tuple:
        name, k = task
        algorithm = kmeans(k) if name == "kmeans" else bisecting(k, BISECTING_SEED)
        model = algorithm.setWeightCol(WEIGHT).fit(distinct)
        quality = silhouette(model.transform(points), RAW)
        return name, k, float(model.summary.trainingCost), float(quality)

    # The longest fits first.
    tasks = [(name, k) for k in sorted(ks, reverse=True) for name in ("bisecting", "kmeans")]
    try:
        with ThreadPool(parallelism) as pool:
            rows = pool.map(inheritable_thread_target(df.sparkSession)(judged), tasks, chunksize=1)
    finally:
        points.unpersist()
        distinct.unpersist()
    table = df.sparkSession.createDataFrame(
        rows, "algorithm string, k int, cost double, silhouette double"
    )
    best = F.max_by("k", "silhouette").over(Window.partitionBy("algorithm"))
    return table.withColumn("best", F.col("k") == best)


def pca_points(
    df: DataFrame, vectors: str, keys: Sequence[str], n: int = 2, upright: bool = False
) -> DataFrame:
    """First principal components of the vectors, next to the keys of their rows.

    The direction of a component is arbitrary. `upright` turns each so that its largest loading
    is positive, which makes results the same wherever they are computed.
    """
    model = PCA(k=n, inputCol=vectors, outputCol="pca").fit(df)
    point = vector_to_array("pca")
    signs = [1.0] * n
    if upright:
        loadings = model.pc.toArray()
        signs = [1.0 if max(axis, key=abs) >= 0 else -1.0 for axis in loadings.T]
    return model.transform(df).select(
        *keys, *[(F.get(point, F.lit(i)) * F.lit(signs[i])).alias(f"pc{i + 1}") for i in range(n)]
    )
