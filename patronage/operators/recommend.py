"""Collaborative filtering on preference scores, and the model's store."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..session import durable, shared_dir
from .preferences import bounded_users, dictionary, preference_scores, preferences_json, rating_matrix

# Users whose factors travel in one row.
USER_BLOCK = 512
# Products that travel in one row when all users are served.
PRODUCT_BLOCK = 256
# Ratings that a task should make where every product is rated.
TASK_RATINGS = 250_000
# Factors up to this number are multiplied by a written-out sum.
WRITTEN_OUT = 32
# Ratings that one block of a fit should hold: at most, and at least while there are fewer than 20 blocks.
BLOCK_RATINGS, SMALL_BLOCK = 1_000_000, 10_000


class Recommender(NamedTuple):
    users: DataFrame
    products: DataFrame
    model: ALSModel


def als_train(
    ratings: DataFrame,
    rank: int = 10,
    iterations: int = 20,
    regularization: float = 0.01,
    partitions: int | None = None,
    seed: int = 7,
) -> ALSModel:
    """Explicit alternating least squares on (uid, pid, rating).

    Rows are placed and sorted by id first, so that equal input gives equal factors.
    Without ``partitions`` there are up to 20 blocks, as ratings go round for, and more where ratings are many.
    """
    if partitions is None:
        n = ratings.count()
        partitions = max(min(20, -(-n // SMALL_BLOCK)), -(-n // BLOCK_RATINGS), 1)
    shared_dir(ratings.sparkSession)  # lets ALS cut its lineage every ten rounds
    placed = ratings.repartition(partitions, "uid").sortWithinPartitions("uid", "pid")
    als = ALS(
        rank=rank,
        maxIter=iterations,
        regParam=regularization,
        numUserBlocks=partitions,
        numItemBlocks=partitions,
        userCol="uid",
        itemCol="pid",
        ratingCol="rating",
        coldStartStrategy="drop",
        checkpointInterval=10,
        seed=seed,
    )
    return als.fit(placed)


def train(
    lines: DataFrame,
    minprefs: int = 10,
    maxprefs: int = 20,
    **parameters,
) -> Recommender:
    """From basket lines to a fitted model with its two dictionaries."""
    # all scores are counted by user, and then read
    scores = durable(bounded_users(durable(preference_scores(lines)), minprefs, maxprefs))
    users = durable(dictionary(scores, "user"))
    products = durable(dictionary(scores, "product"))
    # counted, and read by the fit
    model = als_train(durable(rating_matrix(scores, users, products)), **parameters)
    return Recommender(users, products, model)


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def factor_tables(recommender: Recommender) -> tuple[DataFrame, DataFrame]:
    """Factors by term: (user, factors) and (product, factors)."""
    users = recommender.model.userFactors.join(
        recommender.users, F.col("id") == F.col("idx")
    ).select(F.col("term").alias("user"), F.col("features").alias("factors"))
    products = recommender.model.itemFactors.join(
        recommender.products, F.col("id") == F.col("idx")
    ).select(F.col("term").alias("product"), F.col("features").alias("factors"))
    return users, products


def _ranked(rated: DataFrame) -> DataFrame:
    """Preferences, best first; the score is the rating cut to an integer."""
    return rated.select(
        "user", "product", F.col("rating").cast("int").alias("score"), "rating"
    ).orderBy(F.desc("rating"), "user", "product")


def zip_pairs(users: DataFrame, products: DataFrame) -> DataFrame:
    """Users and products paired by position; both carry (term, idx)."""
    u = users.select("idx", F.col("term").alias("user"))
    p = products.select("idx", F.col("term").alias("product"))
    return u.join(p, "idx").select("user", "product")


def request_pairs(spark: SparkSession, users: str, items: str) -> DataFrame:
    """Pairs of a request's two comma lists, by position."""
    return (
        spark.range(1)
        .select(
            F.explode(
                F.arrays_zip(
                    F.split(F.lit(users), ",").alias("user"),
                    F.split(F.lit(items), ",").alias("product"),
                )
            ).alias("p")
        )
        .select("p.user", "p.product")
        .dropna()
    )


def predict_pairs(pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """Ratings of (user, product) pairs; unknown users and products fall out."""
    u = user_factors.withColumnRenamed("factors", "uf")
    p = item_factors.withColumnRenamed("factors", "pf")
    rated = pairs.join(u, "user").join(p, "product")
    return _ranked(rated.withColumn("rating", _dot(F.col("uf"), F.col("pf"))))


def _dot_of(a: Column, b: Column, rank: int) -> Column:
    """``_dot`` of factors whose number is known: written out, so that it is compiled; the same order of sums."""
    if rank > WRITTEN_OUT:
        return _dot(a, b)
    products = (F.get(a, F.lit(i)).cast("double") * F.get(b, F.lit(i)).cast("double") for i in range(rank))
    return functools.reduce(Column.__add__, products, F.lit(0.0))


def _against_request(
    users: DataFrame, products: DataFrame, user_factors: DataFrame
) -> DataFrame:
    """Every product rated for the users of a request, however many.

    Users travel in blocks of about ``USER_BLOCK`` and products in blocks of about ``PRODUCT_BLOCK``. Each pair of
    blocks meets once, by both numbers. The pairs are dealt to tasks by the ratings they
    will make: as input they are small, and Spark would put them all in a few tasks.
    """
    chosen = durable(user_factors.join(users.select("user").distinct(), "user", "left_semi"))
    wanted = durable(products)
    n_users = chosen.count()
    n_products, rank = wanted.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("factors")), F.lit(0))).first()
    u_blocks, p_blocks = max(1, -(-n_users // USER_BLOCK)), max(1, -(-n_products // PRODUCT_BLOCK))
    tasks = max(1, min(u_blocks * p_blocks, -(-n_users * n_products // TASK_RATINGS)))

    def block(key: str, count: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(count))

    def each(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint")))

    who = chosen.groupBy(block("user", u_blocks).alias("u")).agg(F.collect_list(F.struct("user", "factors")).alias("users"))
    what = wanted.groupBy(block("product", p_blocks).alias("p")).agg(F.collect_list(F.struct("product", "factors")).alias("products"))
    left = who.withColumn("p", each(p_blocks)).repartition(tasks, "u", "p")
    right = what.withColumn("u", each(u_blocks)).repartition(tasks, "u", "p")
    return (
        left.join(right, ["u", "p"])
        .select("products", F.explode("users").alias("_u"))
        .select("_u", F.explode("products").alias("_p"))
        .select("_u.user", "_p.product", _dot_of(F.col("_u.factors"), F.col("_p.factors"), rank).alias("rating"))
    )


def predict_user_items(
    users: DataFrame, products: DataFrame, user_factors: DataFrame, item_factors: DataFrame
) -> DataFrame:
    """Ratings of a list of products for the user(s) of a request."""
    wanted = item_factors.join(products.select("product").distinct(), "product", "left_semi")
    return _ranked(_against_request(users, wanted, user_factors))


def recommend_top_n(
    users: DataFrame, n: int, user_factors: DataFrame, item_factors: DataFrame
) -> DataFrame:
    """The ``n`` best products for each user of a request; ties by product.

    As for everyone (see ``recommend_everyone``), so no task ever holds all ratings of its users.
    """
    chosen = user_factors.join(users.select("user").distinct(), "user", "left_semi")
    return recommend_everyone(n, chosen, item_factors)


def _norm(factors: str) -> Column:
    return F.sqrt(F.aggregate(factors, F.lit(0.0), lambda s, x: s + x * x))


def recommend_everyone(
    n: int, user_factors: DataFrame, item_factors: DataFrame, block: int = PRODUCT_BLOCK, waves: list[dict] | None = None
) -> DataFrame:
    """The ``n`` best products for every user; ties by product.

    Equal factors have equal ratings: users that share them are served once, by the least of them, and of products
    that share them only the first ``n`` can be among the best. So the work is that of the different
    factors (see ``_best_of_all``), and each user is then joined to what its factors were given.
    """
    double = F.transform("factors", lambda x: x.cast("double"))
    # -0.0 is 0.0 here, so that equal factors are found by grouping
    members = durable(user_factors.dropDuplicates(["user"]).select("user", F.transform(double, lambda x: x + F.lit(0.0)).alias("factors")))
    heads = durable(members.groupBy("factors").agg(F.min("user").alias("head")))
    of_head = durable(members.join(heads, "factors").select("user", "head"))
    same = Window.partitionBy("factors").orderBy("product")
    ranked = item_factors.select("product", F.transform(double, lambda x: x + F.lit(0.0)).alias("factors")).withColumn("_n", F.row_number().over(same))
    best = durable(_best_of_all(n, heads.select(F.col("head").alias("user"), "factors"), ranked.where(F.col("_n") <= n).drop("_n"), block, waves))
    return _ranked(of_head.join(best.withColumnRenamed("user", "head"), "head"))


def _best_of_all(n: int, user_factors: DataFrame, item_factors: DataFrame, block: int, waves: list[dict] | None) -> DataFrame:
    """The ``n`` best products for every user, in no order.

    Products go in blocks by falling norm of their factors. A rating is at most the product of both norms, so a
    user whose n-th best rating exceeds its norm times that of the next block is done:
    nothing further can enter. Blocks come in waves of 1, 2, 4, ..., and in a wave a user
    only meets the blocks its bests so far leave open, so most ratings of most users are
    never computed, and the answer is exact. Between waves a user is its n bests. ``waves`` takes
    what each wave did: users open, and ratings computed.
    """
    double = F.transform("factors", lambda x: x.cast("double"))
    users = durable(user_factors.select("user", double.alias("f")).withColumn("norm", _norm("f")))
    ranged = item_factors.select("product", double.alias("f")).withColumn("norm", _norm("f")).repartitionByRange(F.desc("norm"), "product")
    placed = ranged.sortWithinPartitions(F.desc("norm"), "product").withColumn("_at", F.monotonically_increasing_id())
    # a partition's rows have consecutive numbers above its own multiple of 2 ** 33
    whole = F.shiftright("_at", 33) * (1 << 33) + F.floor((F.col("_at") % (1 << 33)) / block)
    packed = durable(placed.groupBy(whole.alias("_b")).agg(F.max("norm").alias("top"), F.collect_list(F.struct("product", "norm", "f")).alias("products")))
    blocks = durable(packed.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("top"), "_b")) - 1).drop("_b"))  # one row per block of products
    tops = blocks.select("rank", "top")
    n_blocks = blocks.count()

    kinds = [user_factors.schema["user"].dataType, item_factors.schema["product"].dataType]
    schema = T.StructType([T.StructField("user", kinds[0]), T.StructField("product", kinds[1]), T.StructField("rating", T.DoubleType()), T.StructField("rated", T.LongType())])

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for who, what in zip(b.column(0), b.column(1), strict=True):
                u, p = who.values, what.values
                uf = u.field("f").flatten().to_numpy().reshape(len(u), -1)
                pf = p.field("f").flatten().to_numpy().reshape(len(p), -1)
                least = u.field("least").to_numpy(zero_copy_only=False)
                least = np.where(np.isnan(least), -np.inf, least)
                # both sorted by norm: each user rates the products its bound reaches
                reach = u.field("norm").to_numpy()[:, None] * p.field("norm").to_numpy() * (1 + 1e-9) >= least[:, None]
                ratings = np.where(reach, uf @ pf.T, -np.inf)
                keep = min(n, len(p))
                low = np.partition(ratings, len(p) - keep, axis=1)[:, len(p) - keep]
                i, j = np.nonzero((ratings >= np.maximum(low, least)[:, None]) & reach)
                rated = np.zeros(len(i), np.int64)
                if len(i):
                    rated[0] = int(reach.sum())
                yield pa.RecordBatch.from_arrays([u.field("user").take(pa.array(i)), p.field("product").take(pa.array(j)), pa.array(ratings[i, j]), pa.array(rated)], schema.names)

    best = Window.partitionBy("user").orderBy(F.desc("rating"), "product")
    done: list[DataFrame] = []
    open_users, bests = users.withColumn("least", F.lit(None).cast("double")).withColumn("last", F.lit(0)), None
    first, size = 0, 1
    while first < n_blocks:
        packs = max(1, -(-open_users.count() // USER_BLOCK))
        packed = open_users.withColumn("upto", F.least("last", F.lit(first + size - 1))).groupBy(F.pmod(F.xxhash64("user"), F.lit(packs)).alias("pack"), "upto")
        who = packed.agg(F.collect_list(F.struct("user", "norm", "f", "least")).alias("who"))
        pairs = who.withColumn("rank", F.explode(F.sequence(F.lit(first), "upto"))).join(blocks, "rank").select("who", "products")
        found = durable(pairs.mapInArrow(rate, schema))
        rows = found.select("user", "product", "rating")
        if bests is not None:
            rows = rows.unionByName(bests)
        bests = durable(rows.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= n).drop("_rank"))
        if waves is not None:
            waves.append({"users": open_users.count(), "rated": found.agg(F.coalesce(F.sum("rated"), F.lit(0))).first()[0]})
        first, size = first + size, size * 2
        if first >= n_blocks:
            break
        # how far each user still has to go: to the last block that its n-th best does not rule out
        nth = bests.groupBy("user").agg(F.when(F.count(F.lit(1)) >= n, F.min("rating")).alias("least"))
        limits = [(r["rank"], r["top"]) for r in tops.where(F.col("rank") >= first).orderBy("rank").limit(size).collect()]
        met = open_users.drop("least", "last").join(nth, "user", "left")
        reach = F.col("norm") * F.lit(limits[0][1]) * (1 + 1e-9) >= F.col("least")
        met = met.where(F.col("least").isNull() | reach)
        far = F.array(*[F.lit(t) for _, t in limits])
        count = F.size(F.filter(far, lambda t: F.col("least").isNull() | (F.col("norm") * t * (1 + 1e-9) >= F.col("least"))))
        still = durable(met.withColumn("last", F.lit(first - 1) + count))
        done.append(bests.join(still.select("user"), "user", "left_anti"))
        bests = bests.join(still.select("user"), "user", "left_semi")
        open_users = still
        if still.isEmpty():
            bests = None
            break
    parts = done if bests is None else [*done, bests]
    if not parts:
        return users.sparkSession.createDataFrame([], schema).drop("rated")
    return functools.reduce(DataFrame.unionByName, parts)


def predictions_json(rated: DataFrame, part_size: int = 10_000) -> DataFrame:
    """The preferences of a request as JSON documents, one per user and part, in rating order."""
    scores = rated.select("user", "product", F.col("rating").alias("score"))
    return preferences_json(scores, part_size)


def fold_in(ratings: DataFrame, item_factors: DataFrame, rank: int = 10, regularization: float = 0.01) -> DataFrame:
    """Factors of users that a fit has not seen, from stored product factors: user, factors.

    ratings: user, product, rating. A user's factors solve the regularised normal
    equations of its ratings, which is what the last half step of a fit does. Both sides are
    sums over ratings, so a user with very many is added up before anything is shuffled;
    the small systems are solved in batches. Products without factors do not count, and users
    without others fall out.
    """
    f = F.transform("factors", lambda x: x.cast("double"))
    met = ratings.join(item_factors.select("product", f.alias("f")), "product").withColumn("rating", F.col("rating").cast("double"))
    at = [(i, j) for i in range(rank) for j in range(i + 1)]
    sums = [F.sum(F.col("f")[i] * F.col("f")[j]) for i, j in at] + [F.sum(F.col("f")[i] * F.col("rating")) for i in range(rank)]
    equations = met.groupBy("user").agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("sums"))
    schema = T.StructType([equations.schema["user"], T.StructField("factors", T.ArrayType(T.DoubleType()))])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, j = np.array(at).T
        for b in batches:
            x = b.column(2).flatten().to_numpy().reshape(b.num_rows, -1)
            left = np.zeros((b.num_rows, rank, rank))
            left[:, i, j] = left[:, j, i] = x[:, : len(at)]
            left += regularization * b.column(1).to_numpy()[:, None, None] * np.eye(rank)
            found = np.linalg.solve(left, x[:, len(at) :, None])[:, :, 0]
            lists = pa.ListArray.from_arrays(np.arange(b.num_rows + 1, dtype=np.int32) * rank, pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], schema.names)

    return equations.mapInArrow(solve, schema)


def solved_users(recommender: Recommender, ratings: DataFrame, regularization: float = 0.01, tolerance: float = 1e-3) -> DataFrame:
    """For each user of the ratings, whether its factors solve the regularised normal equations for the product factors.

    The last half step of a fit solves them for all users: the sum over a user's ratings
    of v (v.u - r), plus lambda times their number times u, is zero.
    """
    double = F.transform("features", lambda x: x.cast("double"))
    u = recommender.model.userFactors.select(F.col("id").alias("uid"), double.alias("u"))
    v = recommender.model.itemFactors.select(F.col("id").alias("pid"), double.alias("v"))
    places = range(len(recommender.model.itemFactors.select("features").first()[0]))
    error = _dot_of(F.col("u"), F.col("v"), len(places)) - F.col("rating")
    met = ratings.join(v, "pid").join(u, "uid").select("uid", "rating", "v", error.alias("error"))
    sums = met.groupBy("uid").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(F.col("v")[i] * F.col("error")) for i in places]).alias("error"),
        F.array(*[F.sum(F.abs(F.col("v")[i] * F.col("rating"))) for i in places]).alias("scale"),
    )
    parts = F.arrays_zip("error", "scale", "u")
    holds = F.forall(parts, lambda x: F.abs(x["error"] + regularization * F.col("n") * x["u"]) <= tolerance * (1 + x["scale"]))
    solved = sums.join(u, "uid").select("uid", holds.alias("solved"))
    return recommender.users.select(F.col("term").alias("user"), F.col("idx").alias("uid")).join(solved, "uid", "left").select("user", F.coalesce("solved", F.lit(False)).alias("solved"))


# ---------------------------------------------------------------- model store

_INDEX = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("saved_at", T.LongType()),
        T.StructField("path", T.StringType()),
    ]
)


def save_model(recommender: Recommender, root: str, name: str, saved_at: int) -> str:
    """Model and dictionaries under a folder stamped with ``saved_at`` (epoch ms).

    The index row is written last, so a half-written model is never found.
    """
    spark = recommender.users.sparkSession
    path = f"{root}/{name}/{saved_at}"
    recommender.users.write.mode("overwrite").parquet(f"{path}/users")
    recommender.products.write.mode("overwrite").parquet(f"{path}/products")
    recommender.model.write().overwrite().save(f"{path}/model")
    entry = spark.range(1).select(
        F.lit(name).alias("model"),
        F.lit(saved_at).cast("bigint").alias("saved_at"),
        F.lit(path).alias("path"),
    )
    entry.write.mode("append").parquet(f"{root}/index")
    return path


def latest_models(spark: SparkSession, root: str) -> DataFrame:
    """The newest entry per model name."""
    return (
        spark.read.schema(_INDEX)
        .parquet(f"{root}/index")
        .groupBy("model")
        .agg(F.max("saved_at").alias("saved_at"), F.max_by("path", "saved_at").alias("path"))
    )


def load_model(spark: SparkSession, root: str, name: str) -> Recommender:
    found = latest_models(spark, root).where(F.col("model") == name).select("path").first()
    if found is None:
        raise LookupError(f"no model named {name}")
    path = found["path"]
    return Recommender(
        spark.read.parquet(f"{path}/users"),
        spark.read.parquet(f"{path}/products"),
        ALSModel.load(f"{path}/model"),
    )


def training_parameters(request: Mapping[str, str]) -> dict:
    """Text parameters of a training request as keyword arguments."""
    known = {
        "minprefs": ("minprefs", int),
        "maxprefs": ("maxprefs", int),
        "partitions": ("partitions", int),
        "rank": ("rank", int),
        "iter": ("iterations", int),
        "lambda": ("regularization", float),
    }
    return {name: kind(request[key]) for key, (name, kind) in known.items() if key in request}
