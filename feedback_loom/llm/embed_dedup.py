"""Embedding near-duplicates: exact cosine links by PCA-ordered tiled comparison.

Vectors are scaled to length 1 and turned into their principal axes, which changes no
cosine. They are sorted by the first axis and packed into tiles. Two tiles are compared if
their ranges on that axis are near enough. Within a pair of tiles the products of
the leading axes come first; what the other axes can still add is at most the product of the
two suffix norms, so a pair whose bound misses the threshold stops there. The rest goes on to
more axes, and what remains is measured in double precision on the given values.

Tiles hand out one row per vector (number of links, smallest linked id), never the pairs.
The number of tile pairs grows with the square of the table unless the first axis separates
them: that is the price of an exact join by this method.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from ..session import to_table
from ..operators.components import components
from .columns import few_rows, join_dealt

#: Most rows of a tile; wide vectors get fewer, so that a tile's values keep to ``TILE_BYTES``.
TILE, TILE_BYTES = 4096, 8 << 20
LEAD, ROWS, PAIRS = 16, 512, 1 << 16
#: Room for the rounding of single precision in the bounds.
SLACK = 1e-4


def unit(values: np.ndarray) -> np.ndarray:
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


class Tile:
    """Some vectors of one dimension count, padded with zeros, in principal axes."""

    def __init__(self, ids: bytes, copies: bytes, sizes: bytes, values: bytes, axes: np.ndarray):
        self.ids, self.copies = np.frombuffer(ids, np.int64), np.frombuffer(copies, np.int64)
        self.sizes = np.frombuffer(sizes, np.int32)
        self.unit = unit(np.frombuffer(values, np.float64).reshape(len(self.ids), -1))
        turned = self.unit @ axes
        self.stages = []
        for end in (LEAD, 2 * LEAD):
            if end < turned.shape[1]:
                rest = np.sqrt((turned[:, end:] ** 2).sum(axis=1, keepdims=True))
                self.stages.append(np.hstack([turned[:, :end], rest]).astype(np.float32))


def links_between(a: Tile, b: Tile, threshold: float, same: bool):
    """Index pairs of linked vectors, some rows of ``a`` at a time."""
    for top in range(0, len(a.ids), ROWS):
        if a.stages:
            near = a.stages[0][top:top + ROWS] @ b.stages[0].T >= threshold - SLACK
            x, y = np.divmod(np.flatnonzero(near), len(b.ids))
        else:
            x, y = np.divmod(np.arange(min(ROWS, len(a.ids) - top) * len(b.ids)), len(b.ids))
        x += top
        if same:
            x, y = x[x < y], y[x < y]
        for low in range(0, len(x), PAIRS):
            i, j = x[low:low + PAIRS], y[low:low + PAIRS]
            for one, two in zip(a.stages[1:], b.stages[1:]):
                keep = np.einsum("ij,ij->i", one[i], two[j]) >= threshold - SLACK
                i, j = i[keep], j[keep]
            keep = (np.einsum("ij,ij->i", a.unit[i], b.unit[j]) >= threshold) & (a.sizes[i] == b.sizes[j])
            yield i[keep], j[keep]


def lowest(labels: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Lower each label to the smallest that links reach."""
    while len(x):
        least = np.minimum(labels[x], labels[y])
        before = labels.copy()
        np.minimum.at(labels, labels[x], least)
        np.minimum.at(labels, labels[y], least)
        np.minimum.at(labels, x, least)
        np.minimum.at(labels, y, least)
        labels = labels[labels]
        if (labels == before).all():
            break
        open_links = labels[x] != labels[y]
        x, y = x[open_links], y[open_links]
    return labels


def compared(a: Tile, b: Tile, threshold: float, same: bool):
    """For each vector with a link: id, number of linked vectors, smallest id reached within the two tiles."""
    ids = a.ids if same else np.concatenate([a.ids, b.ids])
    copies = a.copies if same else np.concatenate([a.copies, b.copies])
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    counts = np.zeros(len(ids), np.int64)
    labels = np.arange(len(ids))
    shift = 0 if same else len(a.ids)
    for i, j in links_between(a, b, threshold, same):
        j = j + shift
        counts += np.bincount(i, copies[j], len(ids)).astype(np.int64) + np.bincount(j, copies[i], len(ids)).astype(np.int64)
        labels = lowest(labels, rank[i], rank[j])
    at = np.flatnonzero(counts)
    return ids[at], counts[at], ids[order][labels[rank[at]]]


def _keyed(batches):
    """Id, vector as bytes and their digest of each row; digest and vector are null where a vector links with nothing."""
    for batch in batches:
        lists = batch.column(1)
        sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
        flat = lists.flatten().fill_null(np.nan).to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # one zero only
        row_of = np.repeat(np.arange(len(sizes)), sizes)
        broken = np.bincount(row_of, ~np.isfinite(flat), len(sizes)) > 0
        sound = (np.bincount(row_of, flat != 0, len(sizes)) > 0) & ~broken & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        vectors = [flat[a:b].tobytes() if ok else None for a, b, ok in zip(edges[:-1], edges[1:], sound)]
        digests = [None if v is None else hashlib.sha256(v).digest() for v in vectors]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.binary()), pa.array(digests, pa.binary())],
                                         names=["id", "vector", "digest"])


def _padded(column, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors from their bytes, filled up with zeros, and their sizes."""
    sizes = (pc.binary_length(column).to_numpy(zero_copy_only=False) // 8).astype(np.int32)
    values = np.zeros((len(sizes), width))
    values[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(column.to_pylist()), np.float64)
    return values, sizes


def _units(batches, width: int):
    for batch in few_rows(batches):
        values, _ = _padded(batch.column(0), width)
        offsets = pa.array(np.arange(0, values.size + 1, width, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(unit(values).ravel()))], names=["unit"])


def _led(batches, width: int, axes_of):
    """Rows with their coordinate on the first axis."""
    for batch in few_rows(batches):
        lead = unit(_padded(batch.column(2), width)[0]) @ axes_of.value[:, 0]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lead)], names=["id", "copies", "vector", "lead"])


def _packed(batches, width: int, rows: int):
    """Tiles of ``rows`` rows of one partition, in its order, whatever the batches."""
    task, number, waiting = TaskContext.get().partitionId(), 0, []

    def packed(part: pa.Table, number: int) -> pa.RecordBatch:
        values, sizes = _padded(part.column(2).combine_chunks(), width)
        ids, copies, lead = (part.column(i).to_numpy() for i in (0, 1, 3))
        return pa.RecordBatch.from_pydict({
            "tile": [(task << 32) + number], "low": [float(lead.min())], "high": [float(lead.max())],
            "ids": [ids.tobytes()], "copies": [copies.tobytes()], "sizes": [sizes.tobytes()],
            "vectors": [values.tobytes()]}, schema=pa.schema([
                ("tile", pa.int64()), ("low", pa.float64()), ("high", pa.float64()), ("ids", pa.binary()),
                ("copies", pa.binary()), ("sizes", pa.binary()), ("vectors", pa.binary())]))

    for batch in few_rows(batches):
        waiting.append(batch)
        while sum(b.num_rows for b in waiting) >= rows:
            table = pa.Table.from_batches(waiting)
            yield packed(table.slice(0, rows), number)
            waiting, number = table.slice(rows).to_batches(), number + 1
    if any(b.num_rows for b in waiting):
        yield packed(pa.Table.from_batches(waiting), number)


def near_vectors(vectors: DataFrame, value: str = "embedding", key: str = "vec_id", threshold: float = 0.95) -> DataFrame:
    """``(key, n_links, component_id, kept)`` for each row of ``vectors``.

    Rows link if their cosine, in double precision, is at least ``threshold`` (above 0) and
    their vectors have the same length. A vector that is null, empty or zero, or holds null or non-finite
    components, has no link, as has a row with a null key (its component is null and it is kept).
    ``n_links`` counts linked rows, copies included. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(value).cast("array<double>").alias("vector"))
    keyed = rows.mapInArrow(_keyed, "id long, vector binary, digest binary")
    sound = keyed.where("digest IS NOT NULL")
    # copies combine before they are moved; from here on a vector is known by its digest
    groups = to_table(sound.groupBy("digest").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), F.any_value("vector").alias("vector")), "vectors")
    head = groups.agg(F.max(F.octet_length("vector")), F.count("*")).first()
    width, n = (head[0] or 0) // 8, head[1]
    if n:
        axes = np.eye(width)
        if n > 1 and width > 1:
            units = groups.select("vector").mapInArrow(lambda batches: _units(batches, width), "unit array<double>")
            features = to_table(units, "units").select(array_to_vector("unit").alias("features"))
            axes = PCA(k=width, inputCol="features").fit(features).pc.toArray()
        axes_of = spark.sparkContext.broadcast(axes)
        tile_rows = max(1, min(TILE, TILE_BYTES // (8 * width)))
        placed = (groups.select("id", "copies", "vector")
                  .mapInArrow(lambda batches: _led(batches, width, axes_of), "id long, copies long, vector binary, lead double")
                  .repartitionByRange(-(-n // tile_rows), "lead").sortWithinPartitions("lead", "id"))
        schema = "tile long, low double, high double, ids binary, copies binary, sizes binary, vectors binary"
        tiles = to_table(placed.mapInArrow(lambda batches: _packed(batches, width, tile_rows), schema), "tiles")
        # one small row per tile: which tiles are near enough on the first axis, as |x - y|^2 = 2 - 2 cos
        ranges = sorted((r.low, r.high, r.tile) for r in tiles.select("tile", "low", "high").collect())
        reach = np.sqrt(2 - 2 * threshold) + SLACK
        last = np.searchsorted([r[0] for r in ranges], [r[1] + reach for r in ranges], "right") - 1
        spans = [(i, int(j), r[2]) for i, (j, r) in enumerate(zip(last, ranges))]
        numbers = spark.createDataFrame(spans, "place int, last int, tile long")
        numbered = tiles.join(numbers, "tile")
        packed = F.struct("ids", "copies", "sizes", "vectors")
        pairs = numbers.select(F.col("place").alias("one"), F.explode(F.sequence("place", "last")).alias("two"))
        both = (pairs.join(numbered.select(F.col("place").alias("one"), packed.alias("a")), "one")
                .join(numbered.select(F.col("place").alias("two"), packed.alias("b")), "two"))

        def run(batches):
            for batch in batches:
                for row in range(batch.num_rows):
                    two, one, a, b = (batch.column(i)[row].as_py() for i in range(4))
                    left = Tile(a["ids"], a["copies"], a["sizes"], a["vectors"], axes_of.value)
                    right = left if one == two else Tile(b["ids"], b["copies"], b["sizes"], b["vectors"], axes_of.value)
                    ids, counts, lows = compared(left, right, threshold, one == two)
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts), pa.array(lows)], names=["id", "n", "low"])

        found = to_table(both.select("two", "one", "a", "b").mapInArrow(run, "id long, n long, low long"), "linked")
        links = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
        found = found.groupBy("id").agg(F.sum("n").alias("n"))
        groups = (groups.select("digest", "id", "copies").join(found, "id", "left").join(links, "id", "left")
                  .select("digest", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                          F.coalesce("component", "id").alias("component_id")))
    else:
        groups = groups.select("digest", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    linked = join_dealt(sound.select("id", "digest"), groups, "digest", "id").select("id", "n_links", "component_id")
    other = keyed.where("digest IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(other).select(
        F.col("id").alias(key), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
