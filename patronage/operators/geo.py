"""Geographic segments and heat grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import to_pixel
from ..session import durable
from . import convolution

ALPHA = 200
THRESHOLD = 0.7
#: Pairs of pixels up to which heat is added up pair by pair; beyond, transforms do less work.
PAIRS = 1 << 24
#: Rounds of a fit that ends when its centres rest.
ENDLESS = (1 << 31) - 1
# Rows that one task of a fit of segments holds as vectors.
SEGMENT_ROWS = 250_000


def fit_centers(
    points: DataFrame, clusters: int = 10, iterations: int | None = None, seed: int = 5
) -> list[tuple[float, float]]:
    """K-means centres of raw (lat, lon), in a fixed order.

    Without ``iterations`` the fit goes on until no centre moves any more.
    Equal places count once with their weight, so the fit sees as many rows as
    there are distinct places.
    """
    places = durable(
        points.groupBy("lat", "lon")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
        .repartitionByRange("lat", "lon")
        .sortWithinPartitions("lat", "lon")
    )
    vectors = VectorAssembler(inputCols=["lat", "lon"], outputCol="v").transform(places)
    model = KMeans(
        k=clusters, maxIter=ENDLESS if iterations is None else iterations, seed=seed, featuresCol="v", weightCol="weight"
    ).fit(vectors)
    return sorted((float(c[0]), float(c[1])) for c in model.clusterCenters())


def assign_clusters(points: DataFrame, centers: Sequence[tuple[float, float]]) -> DataFrame:
    """Nearest centre per point (ties: the first), as plain column arithmetic."""
    options = F.array(
        *[
            F.struct(
                (
                    (F.col("lat") - F.lit(a)) * (F.col("lat") - F.lit(a))
                    + (F.col("lon") - F.lit(b)) * (F.col("lon") - F.lit(b))
                ).alias("d"),
                F.lit(i).alias("cluster"),
                F.lit(a).alias("clat"),
                F.lit(b).alias("clon"),
            )
            for i, (a, b) in enumerate((float(x), float(y)) for x, y in centers)
        ]
    )
    return points.withColumn("_c", F.array_min(options)).select(
        F.col("_c.cluster").alias("cluster"),
        F.col("_c.clat").alias("clat"),
        F.col("_c.clon").alias("clon"),
        "lat",
        "lon",
    )


def geo_clusters(
    points: DataFrame, clusters: int = 10, iterations: int | None = None, seed: int = 5
) -> DataFrame:
    return assign_clusters(points, fit_centers(points, clusters, iterations, seed))


def fit_segments(
    df: DataFrame,
    features: Sequence[str],
    categories: Sequence[str] = (),
    clusters: int = 5,
    iterations: int = 100,
    seed: int = 5,
) -> tuple[PipelineModel, DataFrame]:
    """K-means over standardised numeric features and one-hot categories, and the complete rows it was fitted on."""
    data = durable(df.dropna(subset=[*features, *categories]))
    hot = [f"_hot_{c}" for c in categories]
    coded = [
        StringIndexer(inputCols=[*categories], outputCols=[f"_code_{c}" for c in categories], stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=[f"_code_{c}" for c in categories], outputCols=hot, dropLast=False),
    ]
    pipeline = Pipeline(
        stages=[
            *(coded if categories else []),
            VectorAssembler(inputCols=[*features, *hot], outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
            KMeans(
                k=clusters, maxIter=iterations, seed=seed,
                featuresCol="_scaled", predictionCol="cluster",
            ),
        ]
    )
    # a stored row is small and its vector is not, so the fit's tasks are cut by rows
    parts = -(-data.count() // SEGMENT_ROWS)
    return pipeline.fit(data.repartition(parts) if parts > data.rdd.getNumPartitions() else data), data


def customer_segments(
    df: DataFrame, features: Sequence[str], categories: Sequence[str] = (), **parameters
) -> DataFrame:
    """The complete rows with the ``cluster`` of their segment."""
    model, data = fit_segments(df, features, categories, **parameters)
    return model.transform(data).select(*df.columns, "cluster")


def at_nearest_center(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with their ``cluster``, and in ``nearest`` whether no centre is nearer than that one's."""
    placed = model.transform(rows).withColumn("_x", vector_to_array("_scaled"))

    def away(center) -> Column:
        apart = F.zip_with("_x", F.array(*[F.lit(float(c)) for c in center]), lambda a, b: (a - b) * (a - b))
        return F.aggregate(apart, F.lit(0.0), lambda s, x: s + x)

    distances = F.array(*[away(c) for c in model.stages[-1].clusterCenters()])
    nearest = F.get(distances, F.col("cluster")) <= F.array_min(distances) + 1e-9
    return placed.withColumn("nearest", nearest).select(*rows.columns, "cluster", "nearest")


def project_pixels(points: DataFrame, width: int, height: int) -> DataFrame:
    x, y = to_pixel(F.col("lat"), F.col("lon"), width, height)
    return points.withColumn("x", x).withColumn("y", y)


def cluster_pixels(clustered: DataFrame, width: int, height: int, *more: str) -> DataFrame:
    """Pixels of points and of their cluster centres, and further columns as they are."""
    cx, cy = to_pixel(F.col("clat"), F.col("clon"), width, height)
    x, y = to_pixel(F.col("lat"), F.col("lon"), width, height)
    return clustered.select(
        "cluster", cx.alias("cx"), cy.alias("cy"), x.alias("x"), y.alias("y"), *more
    )


def grid(spark: SparkSession, width: int, height: int) -> DataFrame:
    """Every pixel of the image."""
    return spark.range(width * height).select(
        (F.col("id") % width).cast("int").alias("x"),
        F.floor(F.col("id") / width).cast("int").alias("y"),
    )


def pixel_counts(pixels: DataFrame, width: int, height: int) -> DataFrame:
    """Points per occupied pixel, borders included; from here on sizes depend on the image alone."""
    inside = pixels.where(F.col("x").between(0, width) & F.col("y").between(0, height))
    return inside.groupBy("x", "y").agg(F.count(F.lit(1)).alias("points"))


def _weight(square):
    return F.when(square == 0, F.lit(1.0)).otherwise(F.lit(1.0) / square)


def pixel_heat(pixels: DataFrame, width: int, height: int) -> DataFrame:
    """Heat of every pixel from the points nearer than a fifth of the width on both axes.

    On a small image each occupied pixel hands its share to the pixels around it, and shares for the
    same pixel are summed before they are shuffled: occupied pixels times the square of the
    reach. Larger ones (see PAIRS) are convolved with the kernel, cut at the reach. Either way
    the number of points does not matter.
    """
    reach = width // 5
    counted = pixel_counts(pixels, width, height)
    if width * height * (2 * reach - 1) ** 2 > PAIRS:
        return convolution.inverse_square(counted, width, height, reach)
    offsets = F.sequence(F.lit(1 - reach), F.lit(reach - 1)) if reach > 0 else F.array().cast(
        "array<int>"
    )
    shares = (
        counted.withColumn("dx", F.explode(offsets))
        .withColumn("tx", F.col("x") + F.col("dx"))
        .where(F.col("tx").between(0, width - 1))
        .withColumn("dy", F.explode(offsets))
        .withColumn("ty", F.col("y") + F.col("dy"))
        .where(F.col("ty").between(0, height - 1))
        .withColumn(
            "share",
            F.col("points")
            * _weight((F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")).cast("double")),
        )
        .groupBy(F.col("tx").alias("x"), F.col("ty").alias("y"))
        .agg(F.sum("share").alias("heat"))
    )
    return (
        grid(pixels.sparkSession, width, height)
        .join(shares, ["x", "y"], "left")
        .select("x", "y", F.coalesce("heat", F.lit(0.0)).alias("heat"))
    )


def point_heat(pixels: DataFrame, width: int, height: int) -> DataFrame:
    """Heat of every occupied pixel from all points; other pixels of the image are 0.

    On a small image each occupied pixel meets the occupied pixels of one image row at a time, by
    an equi-join on the row number: occupied pixels squared. Larger ones (see PAIRS) are
    convolved with the whole kernel. Either way the number of points does not matter.
    """
    counted = pixel_counts(pixels, width, height)
    if (width * height) ** 2 > PAIRS:
        heat = convolution.inverse_square(counted, width, height).join(counted, ["x", "y"], "left")
        return heat.select("x", "y", F.when(F.col("points").isNull(), 0.0).otherwise(F.col("heat")).alias("heat"))
    sources = counted.select(F.col("x").alias("sx"), F.col("y").alias("sy"), "points")
    targets = counted.select(
        "x", "y", F.explode(F.sequence(F.lit(0), F.lit(height))).alias("sy")
    )
    dx, dy = F.col("x") - F.col("sx"), F.col("y") - F.col("sy")
    heat = (
        targets.join(sources, "sy")
        .select("x", "y", (F.col("points") * _weight((dx * dx + dy * dy).cast("double"))).alias("share"))
        .groupBy("x", "y")
        .agg(F.sum("share").alias("heat"))
    )
    return (
        grid(pixels.sparkSession, width, height)
        .join(heat, ["x", "y"], "left")
        .select("x", "y", F.coalesce("heat", F.lit(0.0)).alias("heat"))
    )


def heat_colour(heat: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Colour ramp over heat / threshold, channels 0..255, constant alpha."""
    w = F.col("heat") / F.lit(threshold)

    def channel(x):
        return F.least(F.greatest(x, F.lit(0.0)), F.lit(255.0)).cast("int")

    def up(a, b):
        return channel(F.lit(255.0) * (w - F.lit(a)) / F.lit(b - a))

    def down(a, b):
        return channel(F.lit(255.0) * (F.lit(b) - w) / F.lit(b - a))

    zero, full = F.lit(0), F.lit(255)
    first, second, third = w < 0.25, w < 0.5, w < 0.75
    red = F.when(second, zero).when(third, down(0.5, 0.75)).otherwise(up(0.75, 1.0))
    green = (
        F.when(first, zero).when(second, up(0.25, 0.5)).when(third, full).otherwise(down(0.75, 1.0))
    )
    blue = F.when(first, up(0.0, 0.25)).when(second, down(0.25, 0.5)).otherwise(zero)
    return heat.select(
        "x", "y", red.alias("r"), green.alias("g"), blue.alias("b"), F.lit(ALPHA).alias("a")
    )
