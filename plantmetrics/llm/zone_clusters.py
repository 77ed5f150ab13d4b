"""K-means over blocks of vectors along a Hilbert curve, whose min/max boxes spare comparisons.

Vectors are put in the order of a Hilbert curve and packed into blocks with the least and greatest value of every
dimension. For a block, a centroid is a candidate unless the one nearest to the box's middle is closer to every point
of the box: the difference of two squared distances is linear, so its greatest value over a box is a sum over the
dimensions. Vectors are compared with the candidates only. All values are integers, so results are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from plantmetrics.llm.arrow import record_batch
from plantmetrics.sources import stage

#: Integer units in 1.0, and the largest entry, with which squared distances of 64 dimensions fit a long.
SCALE, LARGEST = 256, 1 << 27


@dataclass(frozen=True)
class ClusterSettings:
    dims: int = 64
    clusters: int = 40
    rounds: int = 5
    #: Vectors in a block.
    block: int = 128
    #: Bits of the curve's grid per dimension.
    curve_bits: int = 2


def integer_vectors(rows: DataFrame, dims: int) -> DataFrame:
    """``vec_id, x``: rows whose ``embedding`` has ``dims`` entries, none null or non-finite, as integers."""
    entry = F.transform("embedding", lambda c: c.cast("double"))
    good = (F.size("embedding") == dims) & ~F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    bound = F.lit(float(LARGEST))
    whole = F.transform(entry, lambda c: F.floor(F.greatest(-bound, F.least(bound, c * SCALE))).cast("int"))
    return rows.where(F.col("embedding").isNotNull() & good).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x"))


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Keys whose order is that of the Hilbert curve through a grid of 2^``bits`` cells per dimension.

    ``cells`` has a row per point. The transform undoes the curve's reflections and exchanges of axes from the
    highest bit down, then Gray-decodes; the key has the highest bits of all dimensions first.
    """
    x = cells.astype(np.int64).T.copy()
    dims, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(dims):
            reflect = (x[i] & q) != 0
            swap = np.where(reflect, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(reflect, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    q = top
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    planes = [(x >> b) & 1 for b in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)


def pack_blocks(vectors: DataFrame, settings: ClusterSettings) -> DataFrame:
    """``ids, x, low, high``: blocks of neighbours on the curve (``x`` row by row) with their boxes.

    The grid's cells lie within two deviations of each dimension's mean, the outer ones are open. Rows are dealt out
    by ranges of (key, id, row number), so copies of one vector spread over partitions like others.
    """
    dims = settings.dims
    each = [f(F.get("x", F.lit(i))).alias(f"{n}{i}") for i in range(dims) for n, f in (("m", F.avg), ("d", F.stddev_pop))]
    stats = vectors.agg(*each).first()
    mean, dev = (np.array([stats[f"{n}{i}"] or 0.0 for i in range(dims)]) for n in "md")
    cells, bits = 1 << settings.curve_bits, settings.curve_bits
    kind = StructType.fromDDL("vec_id long, x array<int>, key binary")
    arrow = to_arrow_schema(kind)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                place = (_matrix(batch.column(1), dims) - mean) / np.maximum(dev, 1e-9)
                grid = np.clip(np.floor((place + 2.0) / 4.0 * cells), 0, cells - 1)
                yield record_batch([batch.column(0), batch.column(1), hilbert_keys(grid, bits)], arrow)

    order = ["key", "vec_id", "spread"]
    dealt = vectors.mapInArrow(keyed, kind).withColumn("spread", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).select("vec_id", "x")
    packed = StructType.fromDDL("ids array<long>, x array<int>, low array<int>, high array<int>")
    shape = to_arrow_schema(packed)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(ids, x):
            return record_batch([[ids], [x.reshape(-1)], [x.min(axis=0)], [x.max(axis=0)]], shape)

        ids, x = [], np.zeros((0, dims), np.int32)
        for batch in batches:
            ids += batch.column(0).to_pylist()
            x = np.concatenate([x, _matrix(batch.column(1), dims).astype(np.int32)])
            while len(ids) >= settings.block:
                yield block(ids[: settings.block], x[: settings.block])
                ids, x = ids[settings.block :], x[settings.block :]
        if ids:
            yield block(ids, x)

    return dealt.mapInArrow(pack, packed)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers, ascending, of the centroids that may be nearest to a point of the box.

    A centroid is none if the one nearest to the box's middle is closer to all points, or as close and smaller.
    """
    twice = low + high  # the middle, doubled
    apart = 2 * centroids - twice
    best = int((apart * apart).sum(axis=1).argmin())
    step = centroids - centroids[best]
    # d(p, best) - d(p, other) = 2 p.step - |other|^2 + |best|^2, greatest at a corner of the box
    corner = np.where(step > 0, high, low)
    lead = ((2 * corner - centroids - centroids[best]) * step).sum(axis=1)
    keep = (lead > 0) | ((lead == 0) & (np.arange(len(centroids)) <= best))
    keep[best] = True
    return np.flatnonzero(keep)


def nearest(x: np.ndarray, centroids: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest of the centroids ``numbers`` (ascending; of equals the smaller)."""
    some = centroids[numbers]
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(some).max(initial=0)))
    if largest * largest * 4 * x.shape[1] < 1 << 53:  # whole numbers that doubles hold exactly
        a, b = x.astype(np.float64), some.astype(np.float64)
        far = (a * a).sum(axis=1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
    else:
        far = np.stack([((x - one) ** 2).sum(axis=1) for one in some], axis=1)
    at = far.argmin(axis=1)
    return numbers[at], far[np.arange(len(x)), at].astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int):
    for batch in batches:
        for ids, x, low, high in zip(*batch.columns, strict=True):
            yield ids, *(part.values.to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64) for part in (x, low, high))


def cluster_sums(blocks: DataFrame, centroids: np.ndarray, settings: ClusterSettings) -> DataFrame:
    """``cluster, n, compared, s0, s1, ...``: per task and cluster, vectors, comparisons made for them, and sums."""
    dims = settings.dims
    names = [f"s{i}" for i in range(dims)]
    kind = StructType.fromDDL("cluster int, n long, compared long, " + ", ".join(f"{s} long" for s in names))
    arrow = to_arrow_schema(kind)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(centroids), dims), np.int64)
        counts = np.zeros((2, len(centroids)), np.int64)
        for _, x, low, high in _blocks(batches, dims):
            numbers = candidates(low[0], high[0], centroids)
            own, _ = nearest(x, centroids, numbers)
            np.add.at(sums, own, x)
            found = np.bincount(own, minlength=len(centroids))
            counts += np.stack([found, found * len(numbers)])
        used = np.flatnonzero(counts[0])
        yield record_batch([used.astype(np.int32), *counts[:, used], *sums[used].T], arrow)

    return blocks.mapInArrow(add, kind)


def first_centroids(vectors: DataFrame, settings: ClusterSettings) -> np.ndarray:
    """The vectors with the smallest digests of their ids; fewer if there are fewer. Rows without an id are none."""
    digest = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.where("vec_id IS NOT NULL").orderBy(digest, "x").limit(settings.clusters).select("x").collect()
    return np.array([row["x"] for row in rows], np.int64).reshape(-1, settings.dims)


def moved_centroids(blocks: DataFrame, centroids: np.ndarray, settings: ClusterSettings) -> tuple[np.ndarray, int]:
    """(centroids after one round, comparisons made): floors of exact means; a centroid without vectors stays."""
    wide = [F.sum(F.col(f"s{i}").cast("decimal(38,0)")).alias(f"s{i}") for i in range(settings.dims)]
    per_cluster = cluster_sums(blocks, centroids, settings).groupBy("cluster")
    rows = per_cluster.agg(F.sum("n").alias("n"), F.sum("compared").alias("compared"), *wide).collect()  # a row per cluster
    moved = centroids.copy()
    for row in rows:
        moved[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(settings.dims)]
    return moved, sum(row["compared"] for row in rows)


def assign(blocks: DataFrame, centroids: np.ndarray, settings: ClusterSettings) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector of the blocks."""
    kind = StructType.fromDDL("vec_id long, cluster int, distance long")
    arrow = to_arrow_schema(kind)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x, low, high in _blocks(batches, settings.dims):
            own, far = nearest(x, centroids, candidates(low[0], high[0], centroids))
            yield record_batch([ids.values, own.astype(np.int32), far], arrow)

    return blocks.mapInArrow(find, kind)


def fit_clusters(vectors: DataFrame, settings: ClusterSettings) -> tuple[DataFrame | None, np.ndarray]:
    """(blocks as a written table, centroids after all rounds); (None, none) if there is no vector to begin with."""
    centroids = first_centroids(vectors, settings)
    if not len(centroids):
        return None, centroids
    blocks = stage(pack_blocks(vectors, settings), "blocks")
    for _ in range(settings.rounds):
        centroids, _ = moved_centroids(blocks, centroids, settings)
    return blocks, centroids


def cluster_embeddings(rows: DataFrame, settings: ClusterSettings = ClusterSettings()) -> DataFrame:
    """A row per kept row: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Kept are rows of ``rows`` (``vec_id``, ``embedding``) whose vector has exactly ``dims`` entries, none null or
    non-finite; the others are dropped. Entries become floor(256 * x), bounded to +-2^27. The first centroids
    are the vectors with the smallest sha256 of ``2:<vec_id>`` (of equal ids the smaller vector first; rows that
    share id and vector may give equal centroids, of which the first gets all). Of equally near centroids the
    smaller number counts. Rows without an id never begin a centroid and are assigned like others; if no row
    has an id, or the table is empty, the result is empty. Repeated rows give repeated rows; other columns
    are ignored. The inertias are exact and null beyond a long.

    Blocks are written once and read in every round; a round sends one row per task and cluster.
    """
    vectors = integer_vectors(rows.select("vec_id", "embedding"), settings.dims)
    blocks, centroids = fit_clusters(vectors, settings)
    if blocks is None:
        kind = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return rows.sparkSession.createDataFrame([], kind)
    assigned = stage(assign(blocks, centroids, settings), "assigned")
    totals = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    by_cluster = {row["cluster"]: int(row["total"]) for row in totals}  # a row per cluster
    digests = [hashlib.sha256(",".join(map(str, one)).encode()).hexdigest() for one in centroids.tolist()]
    every = range(len(centroids))
    sums = [F.lit(str(by_cluster.get(k, 0))).try_cast("bigint") for k in every]
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(F.array(*sums), F.col("cluster")).alias("cluster_inertia"),
        F.lit(str(sum(by_cluster.values()))).try_cast("bigint").alias("inertia"),
        F.get(F.array(*(F.lit(digests[k]) for k in every)), F.col("cluster")).alias("centroid_sha256"),
    )
