"""Lloyd's k-means on integer 2-D points, and the per-cluster summary.

Semantics (fixed by the reference): squared distance in DOUBLE, nearest centre with the lowest
index winning ties, integer centroids truncated toward zero, empty clusters keep their old
centre, stop when the summed squared movement of all centres drops below ``eta`` (returning the
new centres) or after ``max_iterations`` updates.

Scale notes: points are first collapsed to weighted distinct points (x, y, n).  Every later
quantity (mean, size, dominant language, median) depends only on multiplicities, so this is
exact, and the iterated input shrinks from one row per question to one row per distinct
(language, score).  The centres travel inside the plan as a literal array (k rows, a parameter),
each iteration is one small aggregation job that returns at most k rows to the driver, and the
plan does not grow with the iteration count.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.functions import label_at, literal_table, quote_identifier, sort_bounded, squared_distance
from kestrel.session import path_exists

Centre = tuple[int, int]


@dataclass(frozen=True)
class KMeansParams:
    """Fixed values of the reference's clustering: spread 50000, k 45, eta 20.0, 120 updates."""
    spread: int = 50000
    k: int = 45
    eta: float = 20.0
    max_iterations: int = 120


@dataclass
class FitResult:
    centres: list[Centre]
    iterations: int
    movements: list[float]
    converged: bool = True     # False: stopped at the iteration cap
    trace: list[tuple] = field(default_factory=list)


def weighted_points(vectors: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Distinct points with multiplicity: (x, y, n BIGINT)."""
    return vectors.groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count(F.lit(1)).alias("n"))


def centres_sql(centres: Sequence[Centre]) -> str:
    """The centre list as a SQL literal ``array<struct<x:int,y:int>>``.

    Rendered as one expression string (integers only) so that building a plan costs one
    round trip to the JVM however many centres there are.
    """
    if not centres:
        raise ValueError("no centres")
    items = ", ".join(f"named_struct('x', CAST({int(cx)} AS INT), 'y', CAST({int(cy)} AS INT))"
                      for cx, cy in centres)
    return f"array({items})"


def centres_literal(centres: Sequence[Centre]) -> Column:
    """The centre list as a literal array column."""
    return F.expr(centres_sql(centres))


def nearest_centre(centres: Sequence[Centre], x: str = "x", y: str = "y") -> Column:
    """Index of the closest centre (J2, C16); ties go to the lowest index.

    ``array_min`` over (squared distance, index) structs compares the distance first and the
    index second, which is exactly "strictly smaller distance wins, else keep the earlier index".
    Distances are DOUBLE, as in ``kestrel.functions.squared_distance``.
    """
    px, py = quote_identifier(x), quote_identifier(y)
    dist = (f"CAST({px} - c.x AS DOUBLE) * CAST({px} - c.x AS DOUBLE) + "
            f"CAST({py} - c.y AS DOUBLE) * CAST({py} - c.y AS DOUBLE)")
    return F.expr(f"array_min(transform({centres_sql(centres)}, (c, i) -> named_struct('d', {dist}, 'i', i))).i")


def assign(points: DataFrame, centres: Sequence[Centre]) -> DataFrame:
    """Add the ``cluster`` column to points."""
    return points.withColumn("cluster", nearest_centre(centres))


def _weight(points: DataFrame) -> Column:
    return F.col("n") if "n" in points.columns else F.lit(1).cast("bigint")


def centroids(points: DataFrame, centres: Sequence[Centre]) -> DataFrame:
    """Integer centroid of every non-empty cluster (A8): (cluster, x, y).

    64-bit weighted sums; ``div`` truncates toward zero like the reference's Long division.
    """
    w = _weight(points)
    return (assign(points, centres).groupBy("cluster")
            .agg((F.sum(F.col("x").cast("bigint") * w).alias("sx")),
                 (F.sum(F.col("y").cast("bigint") * w).alias("sy")),
                 F.sum(w).alias("sn"))
            .select("cluster",
                    F.expr("sx div sn").cast("int").alias("x"),
                    F.expr("sy div sn").cast("int").alias("y")))


def centres_frame(spark: SparkSession, centres: Sequence[Centre], prefix: str = "") -> DataFrame:
    """Driver-held centre list as a k-row DataFrame (cluster, x, y)."""
    rows = [(i, int(cx), int(cy)) for i, (cx, cy) in enumerate(centres)]
    return literal_table(spark, rows, [("cluster", "int"), (f"{prefix}x", "int"), (f"{prefix}y", "int")])


def _update(points: DataFrame, centres: Sequence[Centre]) -> DataFrame:
    """(cluster, old_x, old_y, x, y) for all k clusters; an empty cluster keeps its centre.

    The new-centroid side has at most k rows (one per cluster index), so broadcasting it is
    bounded by the parameter k.
    """
    old = centres_frame(points.sparkSession, centres, prefix="old_")
    new = centroids(points, centres)
    return (old.join(F.broadcast(new), "cluster", "left")
            .select("cluster", "old_x", "old_y",
                    F.coalesce("x", "old_x").alias("x"), F.coalesce("y", "old_y").alias("y")))


def step(points: DataFrame, centres: Sequence[Centre]) -> DataFrame:
    """One update (K2): (cluster, x, y) for all k clusters; an empty cluster keeps its centre."""
    return _update(points, centres).select("cluster", "x", "y")


def movement_frame(points: DataFrame, centres: Sequence[Centre]) -> DataFrame:
    """Summed squared movement of one update (A16): one row, column ``movement``."""
    moved = _update(points, centres)
    return moved.agg(F.sum(squared_distance(F.col("x"), F.col("y"), F.col("old_x"), F.col("old_y")))
                     .alias("movement"))


def distance(a: Centre, b: Centre) -> float:
    """Squared distance of two driver-side points."""
    dx = float(a[0] - b[0])
    dy = float(a[1] - b[1])
    return dx * dx + dy * dy


def total_movement(old: Sequence[Centre], new: Sequence[Centre]) -> float:
    """Sum of squared distances between paired centres (A16), in index order."""
    if len(old) != len(new):
        raise ValueError("centre lists differ in length")
    total = 0.0
    for a, b in zip(old, new):
        total += distance(a, b)
    return total


def converged(movement: float, eta: float) -> bool:
    """K3: strict comparison."""
    return movement < eta


TRACE_FIELDS = [("iteration", "int"), ("cluster", "int"), ("old_x", "int"), ("old_y", "int"),
                ("new_x", "int"), ("new_y", "int"), ("distance", "double"), ("total_distance", "double")]


class UpdateLog:
    """Updates of a fit in a folder that outlives the driver: one file of k rows (``TRACE_FIELDS``) per update.

    A fit with the same folder goes on after the last complete update.  A file holds a whole update and appears by
    one rename, so an update that a lost driver was writing is either there or not.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def add(self, rows: Sequence[tuple]) -> None:
        rows_frame(self.spark, rows).coalesce(1).write.mode("append").parquet(self.folder)

    def read(self, k: int) -> list[tuple]:
        """Rows of the complete updates 1, 2, …, in order: k per update reach the driver.

        An update that stands there twice (two drivers) counts once.
        """
        if not path_exists(self.spark, f"{self.folder}/_SUCCESS"):
            return []
        schema = ", ".join(f"{name} {kind}" for name, kind in TRACE_FIELDS)
        found = self.spark.read.schema(schema).parquet(self.folder).distinct().collect()
        by_update: dict[int, list[tuple]] = {}
        for row in found:
            by_update.setdefault(row["iteration"], []).append(tuple(row))
        out: list[tuple] = []
        for update in range(1, len(by_update) + 1):
            rows = sorted(by_update.get(update, ()))
            if [r[1] for r in rows] != list(range(k)):
                raise ValueError(f"update {update} in {self.folder} is not one of {k} centres")
            out += rows
        return out


def fit(points: DataFrame, centres: Sequence[Centre], eta: float = 20.0, max_iterations: int = 120,
        keep_trace: bool = False, log: UpdateLog | None = None) -> FitResult:
    """Lloyd iterations from ``centres`` (K1), driver loop of small Spark jobs.

    ``points`` should be weighted points in a stored table (``kestrel.session.Held``): they are reread
    once per iteration.  With ``log``, every update is written there, and a fit that finds updates in it
    goes on from the last one (they must have begun from ``centres``).
    """
    if max_iterations < 1:
        raise ValueError("max_iterations must be >= 1")
    current = [(int(x), int(y)) for x, y in centres]
    movements: list[float] = []
    trace: list[tuple] = []
    k = len(current)
    done = log.read(k) if log else []
    if done and [(r[2], r[3]) for r in done[:k]] != current:
        raise ValueError(f"the updates in {log.folder} began from other centres")
    while True:
        iteration = len(movements) + 1
        if (iteration - 1) * k < len(done):
            rows = done[(iteration - 1) * k:iteration * k]
            moved, new = rows[0][7], [(r[4], r[5]) for r in rows]
        else:
            new = list(current)
            for row in centroids(points, current).collect():  # at most k rows
                new[row["cluster"]] = (row["x"], row["y"])
            moved = total_movement(current, new)
            rows = [(iteration, i, a[0], a[1], b[0], b[1], distance(a, b), moved)
                    for i, (a, b) in enumerate(zip(current, new))]
            if log:
                log.add(rows)
        movements.append(moved)
        if keep_trace:
            trace += rows
        current = new
        if converged(moved, eta) or iteration >= max_iterations:
            return FitResult(current, iteration, movements, converged(moved, eta), trace)


def rows_frame(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """``TRACE_FIELDS`` rows as a DataFrame, from one JSON literal: planning does not grow with an
    expression per row."""
    names = [name for name, _ in TRACE_FIELDS]
    text = json.dumps([dict(zip(names, row)) for row in rows])
    schema = "array<struct<" + ", ".join(f"{name}:{kind}" for name, kind in TRACE_FIELDS) + ">>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), schema)))


def trace_frame(spark: SparkSession, result: FitResult) -> DataFrame:
    """Iteration trace (K4) as a DataFrame of (iterations x k) rows."""
    if not result.trace:
        raise ValueError("no trace: run fit(..., keep_trace=True)")
    return rows_frame(spark, result.trace)


MEDIAN_BUCKET = 1024  # scores per first-level bucket of the median


def cluster_medians(assigned: DataFrame) -> DataFrame:
    """(cluster, med): exact median of ``y`` weighted by ``_w``, mean of the two middle values.

    Scores are counted per bucket first; the buckets that hold the middle ranks are then looked
    into alone, so no task gets all scores of a cluster.
    """
    bucket = F.floor(F.col("y") / MEDIAN_BUCKET)
    per_y = assigned.groupBy("cluster", "y").agg(F.sum("_w").alias("w"))
    per_bucket = per_y.groupBy("cluster", bucket.alias("b")).agg(F.sum("w").alias("w"))
    low_rank, high_rank = F.expr("(n - 1) div 2"), F.expr("n div 2")
    upto = F.sum("w").over(Window.partitionBy("cluster").orderBy("b"))
    middle = per_bucket.withColumns({"n": F.sum("w").over(Window.partitionBy("cluster")), "before": upto - F.col("w"),
                                     "after": upto})
    middle = middle.where((high_rank >= F.col("before")) & (low_rank < F.col("after"))).select(
        "cluster", "b", "n", "before")
    inside = per_y.withColumn("b", bucket).join(middle, ["cluster", "b"])
    reach = F.col("before") + F.sum("w").over(Window.partitionBy("cluster", "b").orderBy("y"))
    inside = inside.withColumns({"reach": reach, "start": reach - F.col("w")})

    def at(rank):
        return F.max(F.when((rank >= F.col("start")) & (rank < F.col("reach")), F.col("y")))

    return inside.groupBy("cluster").agg(at(low_rank).alias("lo"), at(high_rank).alias("hi")).select(
        "cluster", ((F.col("lo") + F.col("hi")) / 2).alias("med"))


def cluster_summary(points: DataFrame, centres: Sequence[Centre], langs: Sequence[str],
                    spread: int = 50000) -> DataFrame:
    """Per non-empty cluster (K5): dominant language, its share in percent, size, median score.

    label   most common language (A9); ties go to the lowest language index
    percent 100 * share of that language (A10)
    size    number of points (A11)
    median  exact median of y, mean of the two middle values truncated (A12)
    Sorted by median, then cluster index (O4).
    """
    a = assign(points, centres)
    w = _weight(points)
    a = a.withColumn("_w", w)
    per_lang = a.groupBy("cluster", "x").agg(F.sum("_w").alias("c"))
    dominant = per_lang.groupBy("cluster").agg(
        F.max_by("x", F.struct(F.col("c"), -F.col("x"))).alias("lx"),
        F.max("c").alias("mc"))
    stats = a.groupBy("cluster").agg(
        F.sum("_w").alias("size"))
    out = dominant.join(stats, "cluster").join(cluster_medians(a), "cluster").select(
        "cluster",
        label_at(list(langs), F.expr(f"lx div {int(spread)}")).alias("label"),
        (F.col("mc").cast("double") / F.col("size").cast("double") * F.lit(100.0)).alias("percent"),
        F.col("size").cast("bigint").alias("size"),
        F.col("med").cast("int").alias("median"))
    return sort_bounded(out, "median", "cluster").drop("cluster")  # at most k rows


# Fixed values of the printed cluster report: line format and header lines.
REPORT_FORMAT = "%7d  %-17s (%-5.1f%%) %7d"
REPORT_HEADER = ["Resulting clusters:",
                 "  Score  Dominant language (%percent)  Questions",
                 "================================================"]


def cluster_report(summary: DataFrame) -> DataFrame:
    """Formatted report lines (S11): median, label, percent, size per cluster."""
    return summary.select(F.format_string(REPORT_FORMAT, "median", "label", "percent", "size").alias("line"))


def report_text(summary: DataFrame) -> str:
    """The printed report: header lines, then one line per cluster in summary order.

    Collects the summary, which has at most k rows.
    """
    lines = [r["line"] for r in cluster_report(summary).collect()]
    return "\n".join(REPORT_HEADER + lines)
