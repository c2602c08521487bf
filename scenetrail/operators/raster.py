"""Operators on pixel tables (scene, band, row, col, value)."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scenetrail.operators.graph import components
from scenetrail.session import cut

# Bands taken, source and target range of the rescale, and the tile size.
BANDS = (3, 2, 1)
SOURCE_RANGE = (1, 10000)
TARGET_RANGE = (0, 255)
TILE = 1098


def rescale_bands(
    pixels: DataFrame, bands=BANDS, source=SOURCE_RANGE, target=TARGET_RANGE
) -> DataFrame:
    """Take bands in a new order (numbered from 1) and scale their values to clamped bytes."""
    order = F.create_map(*[F.lit(x) for i, b in enumerate(bands, start=1) for x in (b, i)])
    slope = (target[1] - target[0]) / (source[1] - source[0])
    scaled = F.floor((F.col("value") - source[0]) * F.lit(slope) + target[0] + 0.5)
    byte = F.greatest(F.lit(target[0]), F.least(F.lit(target[1]), scaled)).cast("short")
    return (
        pixels.filter(F.col("band").isin(*bands))
        .withColumn("band", order[F.col("band")])
        .withColumn("value", byte)
    )


def retile(pixels: DataFrame, height: int = TILE, width: int = TILE) -> DataFrame:
    """Add the tile of each pixel and the place inside it; tiles at the edge are smaller."""
    return (
        pixels.withColumn("tile_row", F.floor(F.col("row") / height))
        .withColumn("tile_col", F.floor(F.col("col") / width))
        .withColumn("in_row", F.col("row") % height)
        .withColumn("in_col", F.col("col") % width)
    )


def write_tiles(tiled: DataFrame, path: str) -> None:
    """One folder per scene; the tiles of a scene are spread over tasks."""
    tiled.repartition("scene", "tile_row", "tile_col").write.mode("overwrite").partitionBy("scene").parquet(path)


def mosaic(tiles: DataFrame, keys: tuple[str, ...] = ("row", "col")) -> DataFrame:
    """Merge overlapping tiles: per pixel the value of the tile with the last name."""
    return tiles.groupBy(*keys).agg(F.max_by("value", "tile_name").alias("value"))


_ROW_SHIFT = 31  # a place is packed as row * 2**31 + col, so rows and columns stay below 2**31
_SIDE = 512  # rows and columns of the squares that are labelled by themselves
_KEYS = ["scene", "band"]
_FORWARD = ((0, 1), (1, -1), (1, 0), (1, 1))  # to the four neighbours after a pixel


def _place(row: Column, col: Column) -> Column:
    return F.shiftleft(row.cast("long"), _ROW_SHIFT) + col


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of the set of each of n things, of which a[i] and b[i] belong together: union-find in rounds."""
    root = np.arange(n)
    while True:
        left, right = root[a], root[b]
        apart = left != right
        if not apart.any():
            return root
        a, b, left, right = a[apart], b[apart], left[apart], right[apart]
        np.minimum.at(root, np.maximum(left, right), np.minimum(left, right))
        while True:
            above = root[root]
            if (above == root).all():
                break
            root = above


def _label_square(square: pa.Table) -> pa.Table:
    """Regions inside one square, and its pixels that have neighbours in another one (n is null there).

    Values stay in Arrow, which tells NaN from null.
    """
    rows, cols = (square[name].to_numpy().astype(np.int64) for name in ("row", "col"))
    order = np.lexsort((cols, rows))
    rows, cols, values = rows[order], cols[order], square["value"].combine_chunks().take(pa.array(order))
    code = values.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    r, c = rows % _SIDE, cols % _SIDE
    grid = np.full((_SIDE + 1, _SIDE + 2), -1, np.int64)  # with an empty margin, for neighbours outside
    grid[r, c + 1] = np.arange(len(rows))
    pairs = []
    for down, right in _FORWARD:
        other = grid[r + down, c + 1 + right]
        here = np.flatnonzero(other >= 0)
        here = here[code[here] == code[other[here]]]
        pairs.append((here, other[here]))
    root = _roots(len(rows), np.concatenate([p for p, _ in pairs]), np.concatenate([q for _, q in pairs]))

    first, of = np.unique(root, return_inverse=True)
    edge = np.flatnonzero((r == 0) | (r == _SIDE - 1) | (c == 0) | (c == _SIDE - 1))
    n_pixels = np.concatenate([np.bincount(of), np.zeros(len(edge), np.int64)])
    bounds = [rows[first], rows[first].copy(), cols[first].copy(), cols[first].copy()]  # a region starts in its first row
    np.maximum.at(bounds[1], of, rows)
    np.minimum.at(bounds[2], of, cols)
    np.maximum.at(bounds[3], of, cols)
    bounds = [np.concatenate([b, at[edge]]) for b, at in zip(bounds, (rows, rows, cols, cols))]
    seeds = ((rows << _ROW_SHIFT) + cols)[np.concatenate([first, root[edge]])]
    scene, band = (pa.repeat(square[name][0], len(seeds)) for name in _KEYS)
    value = values.take(pa.array(np.concatenate([first, edge])))
    counts = pa.array(n_pixels, mask=np.arange(len(seeds)) >= len(first))
    names = [*_KEYS, "seed", "value", "n", "min_row", "max_row", "min_col", "max_col"]
    return pa.table([scene, band, pa.array(seeds), value, counts, *map(pa.array, bounds)], names=names)


def segments(pixels: DataFrame) -> DataFrame:
    """8-connected regions of equal value, one row each.

    ``pixels`` is (scene, band, row, col, value) with each place once. A region is named by its first
    pixel in row and column order. A null value is no data and belongs to no region; rows and columns below 0 or from
    2**31 on are an error.

    Squares of fixed size are labelled by union-find, each as one Arrow group that its area bounds. Only pixels on the border
    of a square meet their neighbours in other squares; the regions that touch there are the edges of a graph, and its
    components are the regions of the scene. A region of any size stays spread out.
    """
    inside = F.col("row").between(0, (1 << _ROW_SHIFT) - 1) & F.col("col").between(0, (1 << _ROW_SHIFT) - 1)
    outside = F.raise_error(F.concat(F.lit("a pixel is out of range: "), F.concat_ws(", ", "row", "col")))
    row = F.when(inside, F.col("row").cast("long")).otherwise(outside.cast("long"))
    value = F.col("value")
    if isinstance(pixels.schema["value"].dataType, (T.DoubleType, T.FloatType)):
        value = F.when(value == 0, F.abs(value)).otherwise(value)  # both zeros are one value
    known = pixels.filter(F.col("value").isNotNull()).select(
        *_KEYS, row.alias("row"), F.col("col").cast("long").alias("col"), value.alias("value")
    )
    kinds = [pixels.schema[c] for c in _KEYS] + [T.StructField("seed", T.LongType()), pixels.schema["value"]]
    kinds += [T.StructField(c, T.LongType()) for c in ("n", "min_row", "max_row", "min_col", "max_col")]
    square = [F.floor(F.col(c) / _SIDE) for c in ("row", "col")]
    labelled = cut(known.groupBy(*_KEYS, *square).applyInArrow(_label_square, T.StructType(kinds)), "squares")

    border = labelled.filter("n IS NULL").select(*_KEYS, "value", "seed", F.col("min_row").alias("row"), F.col("min_col").alias("col"))
    near = [F.struct(F.lit(i).alias("dr"), F.lit(j).alias("dc")) for i, j in _FORWARD]
    beyond = border.select("*", F.inline(F.array(*near))).select(
        *_KEYS, "value", F.col("seed").alias("parent"), "row", "col", (F.col("row") + F.col("dr")).alias("to_row"), (F.col("col") + F.col("dc")).alias("to_col")
    )
    crosses = reduce(Column.__or__, [F.floor(F.col(c) / _SIDE) != F.floor(F.col(f"to_{c}") / _SIDE) for c in ("row", "col")])
    beyond = beyond.filter(crosses).select(*_KEYS, "value", "parent", _place(F.col("to_row"), F.col("to_col")).alias("place"))
    there = border.select(*_KEYS, "value", F.col("seed").alias("child"), _place(F.col("row"), F.col("col")).alias("place"))
    edges = beyond.join(there, [*_KEYS, "place", "value"]).select(*_KEYS, "parent", "child").distinct()
    regions = labelled.filter("n IS NOT NULL")
    return (
        regions.join(components(edges, _KEYS).withColumnRenamed("node", "seed"), [*_KEYS, "seed"], "left")
        .groupBy(*_KEYS, F.coalesce("component", "seed").alias("first"), "value")
        .agg(
            F.sum("n").alias("n_pixels"),
            F.min("min_row").alias("min_row"),
            F.max("max_row").alias("max_row"),
            F.min("min_col").alias("min_col"),
            F.max("max_col").alias("max_col"),
        )
        .withColumn("seed_row", F.shiftright("first", _ROW_SHIFT))
        .withColumn("seed_col", F.col("first") - F.shiftleft("seed_row", _ROW_SHIFT))
        .drop("first")
    )
