"""Segments and metrics of predictions, all segments and models in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.scaling import min_max_scaled
from pulsegrid.operators.cleaning import CLASS_LABEL, REG_LABEL
from pulsegrid.operators.joins import join_grouped
from pulsegrid.operators.stats import value_range
from pulsegrid.schemas import TIME_COLUMN

# Bounds of the temporal segments on normalized time.
TEMPORAL_SEGMENTS = {
    "early": (0.00, 0.33),
    "mid": (0.33, 0.67),
    "late": (0.67, 1.00),
}
FULL_SEGMENT = "full_test"


def with_time_norm(df: DataFrame, time: str = TIME_COLUMN, per: str | None = None) -> DataFrame:
    """Time scaled to [0, 1] over the whole table, or over each group when ``per`` names one."""
    if per:
        bounds = df.groupBy(per).agg(F.min(time).alias("_lo"), F.max(time).alias("_hi"))
        joined = join_grouped(df, bounds, [per])
        scaled = min_max_scaled(*[F.col(c).cast("double") for c in (time, "_lo", "_hi")])
        return joined.withColumn("time_norm", scaled).drop("_lo", "_hi")
    lo, hi = (F.col(c).cast("double").alias(c) for c in ("lo", "hi"))
    bounds = value_range(df, time).select(F.struct(lo, hi)).scalar()
    scaled = min_max_scaled(F.col(time).cast("double"), bounds["lo"], bounds["hi"])
    return df.withColumn("time_norm", scaled)


def in_segment(lo: float, hi: float, closed: bool = False, time_norm: str = "time_norm") -> Column:
    """Half-open range of normalized time; ``closed`` takes the upper end in."""
    t = F.col(time_norm)
    return (t >= lo) & ((t <= hi) if closed else (t < hi))


def segments(alarms: str = "Num_Patient_Alarms", closed_last: bool = False) -> dict[str, Column]:
    """Condition of every segment. A row without an alarm count is in neither alarm segment."""
    conditions = {FULL_SEGMENT: F.lit(True)}
    last = list(TEMPORAL_SEGMENTS)[-1]
    for name, (lo, hi) in TEMPORAL_SEGMENTS.items():
        conditions[f"temporal_{name}"] = in_segment(lo, hi, closed_last and name == last)
    conditions["alarms_active"] = F.col(alarms) > 0
    conditions["no_alarms"] = F.col(alarms) == 0
    return conditions


def by_segment(df: DataFrame, conditions: dict[str, Column] | None = None) -> DataFrame:
    """One row per segment of each row."""
    names = [F.when(c, name) for name, c in (conditions or segments()).items()]
    return df.withColumn("segment", F.explode(F.array_compact(F.array(*names))))


def _with_membership(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Add the segments of a row as bits of one number, a short grouping key."""
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions.values())]
    member = bits[0]
    for bit in bits[1:]:
        member = member + bit
    return df.withColumn("_member", member)


def _spread_to_segments(df: DataFrame, names: list[str]) -> DataFrame:
    """Give grouped rows to each of their segments."""
    hits = [F.when(F.col("_member").bitwiseAND(1 << i) > 0, name) for i, name in enumerate(names)]
    return df.withColumn("segment", F.explode(F.array_compact(F.array(*hits)))).drop("_member")


def classification_metrics(predictions: DataFrame, by: tuple[str, ...] = ("model",),
                           conditions: dict[str, Column] | None = None, label: str = CLASS_LABEL,
                           prediction: str = "prediction", score: str = "probability", digits: int | None = 4,
                           ranges: int | None = None) -> DataFrame:
    """Area under the ROC curve, accuracy and weighted F1, precision and recall per group of binary predictions.

    ``conditions`` adds a segment to the grouping; a row counts in every segment whose condition it meets. Rows
    collapse to counts per score and segment membership, and only the sums of a range are given to the segments, so the
    segments cost no extra pass and no row is there twice.

    The area is the exact rank sum over the scores. Distinct scores are dealt to ranges of about equal numbers, in the order
    of group and score, whatever the scale of a group's scores. They are ranked inside each range in parallel, for all segments
    at once and by as many tasks as there are ranges; one row per range and group is put in order across a group. There are
    ``ranges`` of them, the session's shuffle partitions by default.
    """
    known = predictions.filter(F.col(label).isNotNull())
    groups, marks = list(by), []
    if conditions:
        known = _with_membership(known, conditions)
        marks.append("_member")
    actual, said = F.col(label) == 1, F.col(prediction) == 1
    counts = known.groupBy(*groups, *marks, F.col(score).alias("_score")).agg(
        F.count_if(actual & said).alias("tp"),
        F.count_if(~actual & said).alias("fp"),
        F.count_if(~actual & ~said).alias("tn"),
        F.count_if(actual & ~said).alias("fn"),
    )
    # Both numbers are fixed: joined partitions would give fewer and larger ranges, and several ranges to a task.
    ranges = ranges or int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = in_ranges(counts, [*groups, "_score"], ranges).repartition(ranges, *groups, "_range")

    # With peers in the running counts, sum(pos * neg up to) counts the pairs neg <= pos and sum(neg * pos up to) the
    # pairs pos <= neg. Their difference to all pairs, halved, is the rank sum with ties worth one half.
    tallies = ["tp", "fp", "tn", "fn"]
    positive, negative = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    up_to = Window.partitionBy(*groups, "_range").orderBy("_score").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    names = list(conditions) if conditions else [None]
    leads = {}
    for i in range(len(names)):
        here = F.col("_member").bitwiseAND(1 << i) > 0 if conditions else F.lit(True)
        p, q = F.when(here, positive).otherwise(0), F.when(here, negative).otherwise(0)
        leads[f"_lead{i}"] = p.cast("double") * F.sum(q).over(up_to) - q.cast("double") * F.sum(p).over(up_to)
    ranges = counts.withColumns(leads).groupBy(*groups, *marks, "_range").agg(*[F.sum(c).alias(c) for c in (*tallies, *leads)])
    keys = groups
    if conditions:
        keys = [*groups, "segment"]
        own = F.coalesce(*[F.when(F.col("segment") == name, F.col(lead)) for name, lead in zip(names, leads, strict=True)])
        ranges = _spread_to_segments(ranges, names).withColumn("_lead0", own)
        ranges = ranges.groupBy(*keys, "_range").agg(*[F.sum(c).alias(c) for c in (*tallies, "_lead0")])
    # At most one row per score range and group: small whatever the number of predictions.
    pos, neg = positive.cast("double"), negative.cast("double")
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum(negative).over(earlier), F.lit(0)).cast("double")
    ranges = ranges.withColumn("_pairs", (F.col("_lead0") + pos * neg) / 2 + pos * below)
    totals = ranges.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (*tallies, "_pairs")])

    tp, fp, tn, fn = (F.col(c).cast("double") for c in tallies)
    n, p, q = tp + fp + tn + fn, tp + fn, fp + tn
    area = F.when(p == 0, 0.0).when(q == 0, 1.0).otherwise(F.try_divide("_pairs", p * q))
    precision = _weighted(_ratio(tp, tp + fp), p, _ratio(tn, tn + fn), q)
    f1 = _weighted(_ratio(2 * tp, 2 * tp + fp + fn), p, _ratio(2 * tn, 2 * tn + fp + fn), q)
    values = {
        "auc": area, "accuracy": (tp + tn) / n, "f1": f1 / n, "precision": precision / n, "recall": (tp + tn) / n,
    }
    return totals.select(*keys, n.cast("long").alias("n_rows"), *_rounded(values, digits))


def in_ranges(df: DataFrame, order: list[str], ranges: int | None = None) -> DataFrame:
    """Add ``_range``: numbers that rise with the order; the ranges hold about equally many rows."""
    return df.repartitionByRange(*([ranges] if ranges else []), *order).withColumn("_range", F.spark_partition_id())


def regression_metrics(predictions: DataFrame, by: tuple[str, ...] = ("model",),
                       conditions: dict[str, Column] | None = None, label: str = REG_LABEL,
                       prediction: str = "prediction", digits: int | None = 4) -> DataFrame:
    """Root mean square error, mean absolute error and R² per group, from one pass over the rows.

    With ``conditions`` the rows are reduced per segment membership, and the few reduced rows go to the segments.
    """
    known = predictions.filter(F.col(label).isNotNull())
    keys = list(by)
    if conditions:
        known = _with_membership(known, conditions)
        keys.append("_member")
    y, error = F.col(label), F.col(prediction) - F.col(label)
    sums = known.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.sum(error * error).alias("_squares"), F.sum(F.abs(error)).alias("_absolute"),
        F.avg(y).alias("_mean"), F.var_pop(y).alias("_spread"),
    )
    if conditions:
        sums = _spread_to_segments(sums, list(conditions))
        keys[-1] = "segment"
    n, weight = F.sum("_n"), F.col("_n") * F.col("_mean")
    between = F.sum(weight * F.col("_mean")) - F.sum(weight) * F.sum(weight) / n
    total = F.sum(F.col("_n") * F.col("_spread")) + between
    values = {
        "rmse": F.sqrt(F.sum("_squares") / n), "mae": F.sum("_absolute") / n,
        "r2": 1 - F.try_divide(F.sum("_squares"), total),
    }
    return sums.groupBy(*keys).agg(n.alias("n_rows"), *_rounded(values, digits))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / F.when(whole > 0, whole)).otherwise(0.0)


def _weighted(first: Column, first_weight: Column, second: Column, second_weight: Column) -> Column:
    return first * first_weight + second * second_weight


def _rounded(values: dict[str, Column], digits: int | None) -> list[Column]:
    return [(v if digits is None else F.round(v, digits)).alias(k) for k, v in values.items()]
