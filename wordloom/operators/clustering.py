"""Standardised distances, complete-linkage clustering and cohesion of word groups."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions import vectors as vec
from wordloom.sources.scratch import materialize

# Vectors handled by one block of the distance table.
BLOCK_ROWS = 2000


def group_means(vectors: DataFrame, group: str, col: str = "vec") -> DataFrame:
    """``(group, vec, n)``: mean vector and size of each group, summed map-side first."""
    mean = Summarizer.mean(array_to_vector(F.col(col)))
    return vectors.groupBy(group).agg(vector_to_array(mean).alias("vec"), F.count("*").alias("n"))


def dimension_variance(vectors: DataFrame, col: str = "vec") -> list[float]:
    """Sample variance of every dimension: one number per dimension."""
    stats = Summarizer.metrics("variance").summary(array_to_vector(F.col(col)))
    return [float(v) for v in vectors.select(stats.alias("s")).first()["s"]["variance"]]


def seuclidean_distances(chosen: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(a, b, distance)``, ``a < b``, over ``chosen(id, vec)``.

    Each squared difference is divided by that dimension's sample variance; constant
    dimensions drop out.  Vectors are hashed into blocks and every pair of blocks is one
    group of bounded size, so a large choice means more groups, not larger ones.
    """
    variance = np.array(dimension_variance(chosen))
    weight = np.where(variance > 0, 1.0 / np.where(variance > 0, variance, 1.0), 0.0)
    blocks = max(1, -(-chosen.count() // block_rows))
    others = F.sequence(F.lit(0), F.lit(blocks - 1))
    homed = chosen.select(F.col("id").cast("bigint").alias("id"), "vec").withColumn(
        "home", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    )
    placed = homed.select(
        "id", "vec", "home", F.explode(others).alias("o")
    ).select(
        "id", "vec", "home", F.least("home", "o").alias("p"), F.greatest("home", "o").alias("q")
    )

    def distances(pdf: pd.DataFrame) -> pd.DataFrame:
        p, q = pdf["p"].iloc[0], pdf["q"].iloc[0]
        left, right = pdf[pdf["home"] == p], pdf[pdf["home"] == q]
        out = []
        y = np.stack(right["vec"].to_list()) if len(right) else np.empty((0, len(weight)))
        ids = right["id"].to_numpy()
        for a, x in zip(left["id"], left["vec"]):
            keep = ids > a if p == q else np.ones(len(ids), bool)
            d = np.sqrt((((y[keep] - np.asarray(x)) ** 2) * weight).sum(axis=1))
            out.append(
                pd.DataFrame(
                    {"a": np.minimum(a, ids[keep]), "b": np.maximum(a, ids[keep]), "distance": d}
                )
            )
        empty = pd.DataFrame({"a": [], "b": [], "distance": []})
        return pd.concat(out, ignore_index=True) if out else empty

    return placed.groupBy("p", "q").applyInPandas(distances, "a bigint, b bigint, distance double")


def complete_linkage(distances: DataFrame) -> DataFrame:
    """``(a, b, height, size, round)``: the merges of complete-linkage clustering.

    A cluster is named by its smallest member.  Every round merges all pairs that are each
    other's nearest neighbour and takes the larger of the old distances; complete linkage
    is reducible, so this gives the same tree as merging one pair at a time.  Each round
    is one aggregation, two joins and a written table; the pairs stay spread by cluster.
    """
    spark = distances.sparkSession
    links = materialize(distances.select("a", "b", F.col("distance").alias("d")), "linkage")
    if links.isEmpty():
        return spark.createDataFrame([], "a bigint, b bigint, height double, size bigint, round int")
    ids = links.select(F.explode(F.array("a", "b")).alias("c")).distinct()
    sizes = materialize(ids.select("c", F.lit(1).cast("bigint").alias("size")), "linkage-sizes")
    merges: DataFrame | None = None
    step = 0
    while not links.isEmpty():
        ends = links.select(F.inline(F.array(
            F.struct(F.col("a").alias("c"), F.col("b").alias("o"), "d"),
            F.struct(F.col("b").alias("c"), F.col("a").alias("o"), "d"),
        )))
        # ties go to the pair with the smallest ids, seen the same from both ends
        order = F.struct("d", F.least("c", "o"), F.greatest("c", "o"))
        nearest = ends.groupBy("c").agg(F.min_by(F.struct("o", "d"), order).alias("n"))
        nearest = materialize(nearest.select("c", "n.o", "n.d"), "linkage-nearest")
        back = nearest.select(F.col("c").alias("o"), F.col("o").alias("c"))
        mutual = nearest.join(back, ["c", "o"]).where(F.col("c") < F.col("o"))
        size_of = sizes.select(F.col("c"), F.col("size").alias("size_c"))
        size_to = sizes.select(F.col("c").alias("o"), F.col("size").alias("size_o"))
        merged = materialize(
            mutual.join(size_of, "c").join(size_to, "o").select(
                F.col("c").alias("a"),
                F.col("o").alias("b"),
                F.col("d").alias("height"),
                (F.col("size_c") + F.col("size_o")).alias("size"),
                F.lit(step).alias("round"),
            ),
            "linkage-merges",
        )
        merges = merged if merges is None else merges.unionByName(merged)
        gone_a = merged.select(F.col("b").alias("a"), F.col("a").alias("to_a"))
        gone_b = merged.select("b", F.col("a").alias("to_b"))
        moved = (
            links.join(gone_a, "a", "left")
            .join(gone_b, "b", "left")
            .select(F.coalesce("to_a", "a").alias("x"), F.coalesce("to_b", "b").alias("y"), "d")
            .where(F.col("x") != F.col("y"))
        )
        links = materialize(
            moved.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(
                F.max("d").alias("d")
            ),
            "linkage",
        )
        now = merged.select(F.col("a").alias("c"), F.col("size").alias("new_size"))
        sizes = materialize(
            sizes.join(merged.select(F.col("b").alias("c")), "c", "left_anti")
            .join(now, "c", "left")
            .select("c", F.coalesce("new_size", "size").alias("size")),
            "linkage-sizes",
        )
        step += 1
    return merges


def group_cohesion(members: DataFrame, group: str, col: str = "vec") -> DataFrame:
    """``(group, n, within, between)``: mean cosine inside each group and to all other groups.

    Means over all pairs follow from the sums of unit vectors, so no pair is formed:
    ``within = (|S_g|^2 - n) / (n (n - 1))`` and ``between = S_g . (S - S_g) / (n (N - n))``.
    Zero vectors have no direction and are left out.
    """
    length = vec.norm(F.col(col))
    unit = members.where(length > 0).select(
        group, array_to_vector(F.transform(col, lambda x: x / length)).alias("u")
    )
    sums = unit.groupBy(group).agg(
        vector_to_array(Summarizer.sum(F.col("u"))).alias("s"), F.count("*").alias("n")
    )
    sums = materialize(sums, "group-sums")
    whole = sums.agg(
        vector_to_array(Summarizer.sum(array_to_vector(F.col("s")))).alias("s"),
        F.sum("n").alias("n"),
    ).first()
    total = F.array(*[F.lit(float(x)) for x in whole["s"]])
    n, own = F.col("n"), vec.dot(F.col("s"), F.col("s"))
    within = F.when(n > 1, (own - n) / (n * (n - 1)))
    rest = F.lit(whole["n"]) - n
    between = F.when(rest > 0, (vec.dot(F.col("s"), total) - own) / (n * rest))
    return sums.select(group, "n", within.alias("within"), between.alias("between"))
