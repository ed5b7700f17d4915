"""Centroid clustering in integer arithmetic, as JVM expressions.

Vectors are turned into integers once (``floor(scale * x)``) and written to
the shared folder. Each round is one pass over them: ``zip_with`` and
``aggregate`` compute the squared distance of a vector to every centroid, which
are literal arrays in the plan (one product and one sum per component, from
the vector's own square on); ``array_min`` of (distance, number) structs
chooses the nearest, ties going to the smaller number; the new centroids come
from one aggregate with a sum per component, combined within each task before
the shuffle, so a cluster that holds a third of all rows costs no more than
another. The driver sees one row of sums per cluster and round.

Integers are 64 bits wide. If the first pass finds components or counts for
which distances or sums could leave that range, decimals are used instead, so
results stay exact up to components of MOST; larger ones raise an error.

Defined results: vectors that are NULL, of another size, or with a NULL or
non-finite component are left out. A NULL vec_id is hashed as the empty
string. Rows that repeat a vec_id are vectors of their own (equal hashes are
ordered by their components). A distance or sum beyond 64 bits is NULL
(such a distance is left out of the sums). Fewer vectors than centroids: each is a centroid.
No vectors, or an empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tenderfold.llm.common import staged

LONG_SQUARE = 1 << 62           # distances and sums that stay below need no decimals
MOST = 1 << 57                  # |component| up to which decimals of 38 digits are exact


def integer_vectors(table: DataFrame, dims: int, scale: int, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, v (array of ``dims`` integers) of the rows whose vectors are whole and finite."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & (x > float("-inf")) & (x < float("inf")))     # NaN is above all
    kept = table.where((F.size(embedding) == dims) & finite)
    return kept.select(F.col(vec_id).cast("long").alias("vec_id"),
                       F.transform(embedding, lambda x: F.floor(x.cast("double") * scale)).alias("v"))


@dataclass
class Clustering:
    """Vectors with the centroids of the last round."""

    vectors: DataFrame                  # vec_id, v, q (the square of v)
    centroids: list[list[int]]
    number: str                         # type in which distances are computed

    def nearest(self) -> Column:
        """struct(distance, cluster) of the nearest centroid of ``v``."""
        def distance(centroid: list[int]) -> Column:
            # |v - c|^2 = |v|^2 + |c|^2 + the sum of v * (-2 c), exact in integers
            literal = F.expr(f"cast(array({','.join(f'{-2 * c}L' for c in centroid)}) as array<{self.number}>)")
            start = F.col("q") + F.lit(str(sum(c * c for c in centroid))).cast(self.number)
            return F.aggregate(F.zip_with("v", literal, lambda x, c: x * c), start.cast(self.number), lambda acc, d: acc + d)

        return F.array_min(F.array(*[
            F.struct(distance(c).alias("distance"), F.lit(j).alias("cluster")) for j, c in enumerate(self.centroids)]))

    def assigned(self) -> DataFrame:
        """vec_id, cluster, distance of every vector."""
        found = self.vectors.select("vec_id", self.nearest().alias("n"))
        return found.select("vec_id", F.col("n.cluster").alias("cluster"), F.col("n.distance").try_cast("long").alias("distance"))

    def step(self) -> None:
        """One round: every non-empty centroid becomes the floor of its vectors' mean."""
        dims = len(self.centroids[0])
        sums = self.vectors.select("v", self.nearest()["cluster"].alias("cluster")).groupBy("cluster").agg(
            F.count("*").alias("n"), *[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dims)])
        for row in sums.collect():                      # one row per centroid
            self.centroids[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dims)]


def fit(table: DataFrame, clusters: int, rounds: int, dims: int, scale: int, seed: int,
        vec_id: str = "vec_id", embedding: str = "embedding") -> Clustering:
    """Centroids after ``rounds`` rounds; they start as the vectors with the least hex sha256 of ``seed:vec_id``."""
    vectors = staged(integer_vectors(table, dims, scale, vec_id, embedding), "vectors")
    largest = F.array_max(F.transform("v", lambda x: F.greatest(x, -x)))
    n, most = vectors.agg(F.count("*"), F.max(largest)).first()
    if n and most > MOST:
        raise ValueError(f"a component of {most} is beyond exact arithmetic ({MOST})")
    number = "bigint"
    if n and max(dims * (2 * most) ** 2, n * most) >= LONG_SQUARE:
        number = "decimal(38,0)"
        vectors = vectors.withColumn("v", F.col("v").cast("array<decimal(38,0)>"))
    square = F.aggregate("v", F.lit(0).cast(number), lambda acc, x: acc + x * x)
    vectors = staged(vectors.withColumn("q", square), "squares")
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = vectors.orderBy(F.sha2(named.cast("binary"), 256), "v").limit(clusters).select("v").collect()
    found = Clustering(vectors, [[int(x) for x in row["v"]] for row in first], number)
    for _ in range(rounds if first else 0):
        found.step()
    return found


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def clustered(table: DataFrame, clusters: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    spark = table.sparkSession
    found = fit(table, clusters, rounds, dims, scale, seed)
    if not found.centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    rows = staged(found.assigned(), "assigned")
    inertia = {r["cluster"]: int(r["s"] or 0) for r in rows.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    # as text, since a sum may be beyond 64 bits: then it is NULL
    per_cluster = F.array(*[F.lit(str(inertia.get(j, 0))).try_cast("long") for j in range(len(found.centroids))])
    digests = F.array(*[F.lit(centroid_digest(c)) for c in found.centroids])
    return rows.select("vec_id", "cluster", "distance", F.get(per_cluster, F.col("cluster")).alias("cluster_inertia"),
                       F.lit(str(sum(inertia.values()))).try_cast("long").alias("inertia"),
                       F.get(digests, F.col("cluster")).alias("centroid_sha256"))
