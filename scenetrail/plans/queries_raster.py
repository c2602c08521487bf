"""Queries on pixel tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from scenetrail.operators import raster
from scenetrail.plans.derived import view
from scenetrail.plans.registry import query


@query(
    "q_rescale",
    """
    SELECT scene, cast(4 - band AS int) AS band, row, col,
           cast(greatest(0, least(255, floor((value - 1) * (255.0::double / 9999.0::double) + 0.5::double))) AS int) AS value
    FROM pixels WHERE band IN (1, 2, 3)
    """,
    ("pixels",),
)
def rescale(spark, sf):
    out = raster.rescale_bands(view(spark, sf, "pixels"))
    return out.select("scene", F.col("band").cast("int").alias("band"), "row", "col", F.col("value").cast("int").alias("value"))


@query(
    "q_retile",
    """
    SELECT scene, cast(floor(row / 1098) AS bigint) AS tile_row, cast(floor(col / 1098) AS bigint) AS tile_col,
           count(*) AS n, min(row % 1098) AS first_row, max(col % 1098) AS last_col FROM pixels GROUP BY 1, 2, 3
    """,
    ("pixels",),
)
def retile(spark, sf):
    tiled = raster.retile(view(spark, sf, "pixels"))
    return tiled.groupBy("scene", "tile_row", "tile_col").agg(
        F.count("*").alias("n"), F.min("in_row").alias("first_row"), F.max("in_col").alias("last_col")
    )


@query(
    "q_mosaic",
    """
    SELECT row, col, arg_max(value, tile_name) AS value
    FROM (SELECT row, col, lpad(band || '_' || scene, 20, '0') || '_mask.tif' AS tile_name, value FROM pixels) x
    GROUP BY 1, 2
    """,
    ("pixels",),
)
def mosaic(spark, sf):
    name = F.concat(F.lpad(F.concat("band", F.lit("_"), "scene"), 20, "0"), F.lit("_mask.tif"))
    return raster.mosaic(view(spark, sf, "pixels").withColumn("tile_name", name))


@query(
    "q_segments",
    """
    , adj AS (SELECT a.row * 128 + a.col AS u, b.row * 128 + b.col AS v FROM
                (SELECT *, unnest([-1, 0, 1]) AS dr FROM mask) a JOIN mask b
                ON b.row = a.row + a.dr AND b.value = a.value AND abs(b.col - a.col) <= 1),
    reach(u, v) AS (SELECT u, v FROM adj UNION SELECT r.u, a.v FROM reach r JOIN adj a ON a.u = r.v),
    label AS (SELECT u, min(v) AS c FROM reach GROUP BY 1)
    SELECT 's' AS scene, 1 AS band, cast(floor(c / 128) AS bigint) AS seed_row, c % 128 AS seed_col, min(value) AS value,
           count(*) AS n_pixels, min(row) AS min_row, max(row) AS max_row, min(col) AS min_col, max(col) AS max_col
    FROM label JOIN mask ON row * 128 + col = u GROUP BY c
    """,
    ("mask",),
)
def segments(spark, sf):
    return raster.segments(view(spark, sf, "mask"))
