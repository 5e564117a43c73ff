"""Distribution shift between a reference and a current sample."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulspark.functions.columns import col
from rulspark.operators.quantiles import exact_quantiles
from rulspark.operators.stats import rows_from
from rulspark.session import durable, workers_import

# Terms of the Kolmogorov series.
KS_TERMS = 100
# Share given to an empty bin, so that its logarithm exists.
EPSILON = 1e-6
# Rows that a task sorts at once.
BUFFER_ROWS = 200_000
# Values of a task's summary of a feature; most leaves that a feature is cut into.
SUMMARY, LEAVES = 1_024, 16_384
# Values in open leaves that are walked without cutting the leaves further.
WALK_ROWS = 2_000_000


def flag_out_of_range(low: Column, high: Column, lo: float = -0.01, hi: float = 1.01) -> Column:
    return (low < lo) | (high > hi)


def range_shift(scaled: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Extremes of scaled features and the share of values below 0 and above 1."""
    records = []
    for c in columns:
        x = col(c)
        records.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.min(x).alias("min_scaled"),
                F.max(x).alias("max_scaled"),
                F.try_divide(F.count_if(x < 0) * F.lit(100.0), F.count(x)).alias("pct_below"),
                F.try_divide(F.count_if(x > 1) * F.lit(100.0), F.count(x)).alias("pct_above"),
            )
        )
    out = rows_from(scaled, [], records)
    return out.withColumn(
        "out_of_range", flag_out_of_range(F.col("min_scaled"), F.col("max_scaled"))
    )


def shift_severity(range_report: DataFrame) -> DataFrame:
    """MILD within 0.05 of [0, 1], MODERATE within 0.2, else SEVERE."""
    lo, hi = F.col("min_scaled"), F.col("max_scaled")
    out = range_report.agg(F.min(lo).alias("min_scaled"), F.max(hi).alias("max_scaled"))
    return out.select(
        "min_scaled",
        "max_scaled",
        F.abs(F.least(lo, F.lit(0.0))).alias("below_zero"),
        F.greatest(hi - 1.0, F.lit(0.0)).alias("above_one"),
        F.when((lo > -0.05) & (hi < 1.05), "MILD")
        .when((lo > -0.2) & (hi < 1.2), "MODERATE")
        .otherwise("SEVERE")
        .alias("severity"),
    )


def _clean(c: str) -> Column:
    x = col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _both(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    def side(df, flag):
        return df.select(*[_clean(c).alias(f"v{i}") for i, c in enumerate(columns)],
                         F.lit(flag).alias("is_ref"))

    return side(reference, 1).unionByName(side(current, 0))


def ks_pvalue(distance: Column, n: Column, m: Column, terms: int = KS_TERMS) -> Column:
    """Asymptotic two-sided p-value."""
    size = F.sqrt(n * m / (n + m))
    z = F.pow(size * distance, F.lit(2.0))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda s, k: s
        + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * k.cast("double") * k.cast("double") * z),
    )
    p = F.least(F.greatest(series * 2.0, F.lit(0.0)), F.lit(1.0))
    return F.when(distance == 0, F.lit(1.0)).otherwise(p)


def _buffers(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """(reference, current) values of each feature, sorted, for ``BUFFER_ROWS`` rows or a few more."""

    def merged(parts: list[pa.RecordBatch]) -> list[tuple[np.ndarray, np.ndarray]]:
        rows = pa.Table.from_batches(parts)
        ref = rows.column("is_ref").to_numpy() == 1
        out = []
        for i in range(features):
            x = rows.column(f"v{i}").to_numpy()
            known = ~np.isnan(x)  # nulls
            out.append((np.sort(x[known & ref]), np.sort(x[known & ~ref])))
        return out

    parts, n = [], 0
    for batch in batches:
        parts.append(batch)
        n += batch.num_rows
        if n >= BUFFER_ROWS:
            yield merged(parts)
            parts, n = [], 0
    if n:
        yield merged(parts)


def _summed(both: DataFrame, run: Callable, kinds: str) -> DataFrame:
    workers_import(both.sparkSession)
    return both.mapInArrow(run, kinds)


def _thinned(x: np.ndarray, weight: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """About ``size`` of the values, evenly spaced by weight, which they share."""
    if len(x) <= size:
        return x, weight
    order = np.argsort(x, kind="stable")
    upto = np.cumsum(weight[order])
    at = np.searchsorted(upto, (np.arange(size) + 0.5) * (upto[-1] / size))
    return x[order][np.minimum(at, len(x) - 1)], np.full(size, upto[-1] / size)


def _cuts(both: DataFrame, features: int, buckets: int) -> list[list[float]]:
    """Values that cut each feature into about equal leaves, from summaries that tasks make of all values."""

    def run(batches):
        kept = [(np.zeros(0), np.zeros(0))] * features
        for sides in _buffers(batches, features):
            for i, pair in enumerate(sides):
                fresh = np.concatenate(pair)
                fresh = _thinned(fresh, np.ones(len(fresh)), SUMMARY)
                kept[i] = _thinned(*(np.concatenate(two) for two in zip(kept[i], fresh)), 8 * SUMMARY)
        for i, (x, weight) in enumerate(kept):
            x, weight = _thinned(x, weight, SUMMARY)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(x), i, np.int32)), pa.array(x), pa.array(weight)], ["feature", "x", "weight"]
            )

    # SUMMARY values per feature and task.
    found = _summed(both, run, "feature int, x double, weight double").toArrow()
    feature, x, weight = (found.column(c).to_numpy() for c in ("feature", "x", "weight"))
    out = []
    for i in range(features):
        own, _ = _thinned(x[feature == i], weight[feature == i], 8 * SUMMARY)
        ranks = np.arange(1, buckets) / buckets
        out.append(np.unique(np.quantile(own, ranks, method="inverted_cdf")).tolist() if len(own) else [])
    return out


def _bounds(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where each leaf begins in sorted values, and their number. Leaf 2i lies between edges
    i - 1 and i, leaf 2i + 1 is edge i itself."""
    ends = np.column_stack([np.searchsorted(x, edges, "left"), np.searchsorted(x, edges, "right")])
    return np.concatenate([[0], ends.reshape(-1), [len(x)]])


def _leaf_totals(both: DataFrame, edges: Sequence[Sequence[float]]) -> list[dict[int, tuple[int, int]]]:
    """Reference and current rows of each leaf that has some, per feature."""
    cuts = [np.array(cut, float) for cut in edges]

    def run(batches):
        sums = [np.zeros((2, 2 * len(cut) + 1), np.int64) for cut in cuts]
        for sides in _buffers(batches, len(cuts)):
            for total, cut, pair in zip(sums, cuts, sides):
                for side, x in enumerate(pair):
                    total[side] += np.diff(_bounds(x, cut))
        for i, total in enumerate(sums):
            leaf = np.flatnonzero(total.any(axis=0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(leaf), i, np.int32)), pa.array(leaf.astype(np.int32)), *[pa.array(t[leaf]) for t in total]],
                ["feature", "leaf", "ref", "cur"],
            )

    told = _summed(both, run, "feature int, leaf int, ref long, cur long")
    out: list[dict[int, tuple[int, int]]] = [{} for _ in cuts]
    found = told.groupBy("feature", "leaf").agg(F.sum("ref"), F.sum("cur")).toArrow()  # one row per leaf
    for feature, leaf, ref, cur in zip(*(c.to_pylist() for c in found.columns)):
        out[feature][leaf] = (ref, cur)
    return out


def _in_leaves(both: DataFrame, edges: Sequence[Sequence[float]], kept) -> DataFrame:
    """(feature, leaf, x, ref, cur): values in the ``kept`` leaves of each feature, counted within a buffer."""
    cuts = [np.array(cut, float) for cut in edges]
    masks = [np.isin(np.arange(2 * len(cut) + 1), list(leaves)) for cut, leaves in zip(cuts, kept)]
    names = ["feature", "leaf", "x", "ref", "cur"]

    def run(batches):
        for sides in _buffers(batches, len(cuts)):
            for i, (cut, mask, pair) in enumerate(zip(cuts, masks, sides)):
                for side, x in enumerate(pair):
                    leaf = np.repeat(np.arange(len(mask), dtype=np.int32), np.diff(_bounds(x, cut)))
                    inside = mask[leaf]
                    x, leaf = x[inside], leaf[inside]
                    first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
                    n, none = np.diff(np.append(first, len(x))), np.zeros(len(first), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(first), i, np.int32)), pa.array(leaf[first]), pa.array(x[first])]
                        + [pa.array(t) for t in ((none, n) if side else (n, none))],
                        names,
                    )

    return _summed(both, run, "feature int, leaf int, x double, ref long, cur long")


def ks_leaves(
    both: DataFrame, features: int, buckets: int
) -> tuple[list[list[float]], list[dict], list[tuple[int, int, float | None]]]:
    """What the totals of leaves tell of each feature's distance.

    Returns the edges; the leaves that may hold a greater distance, each with the rows before
    it; and the sizes of both samples with the greatest distance at a leaf's end. Inside a leaf the
    distribution functions rise by no more than its shares, so its bound is known from totals.
    While more than ``WALK_ROWS`` values lie in such leaves, these are cut into equal parts and
    all leaves are counted again, unless that no longer halves the values.
    """
    edges = _cuts(both, features, buckets)
    open_, ends, rows = _judged(_leaf_totals(both, edges))
    while rows > WALK_ROWS:
        finer = [_finer(cut, leaves) for cut, leaves in zip(edges, open_)]
        if finer == edges:
            break
        edges, before = finer, rows
        open_, ends, rows = _judged(_leaf_totals(both, edges))
        if 2 * rows > before:
            break
    return edges, open_, ends


def _finer(cut: list[float], leaves: dict) -> list[float]:
    """Edges with those that cut open leaves between two edges into equal parts."""
    inner = [leaf // 2 for leaf in leaves if 0 < leaf < 2 * len(cut)]
    parts = (LEAVES - len(cut)) // max(len(inner), 1)
    more = [np.linspace(cut[i - 1], cut[i], parts + 1)[1:-1] for i in inner if parts > 1 and np.isfinite(cut[i] - cut[i - 1])]
    return np.unique(np.concatenate([cut, *more])).tolist()


def _judged(totals: list[dict[int, tuple[int, int]]]) -> tuple[list[dict], list[tuple[int, int, float | None]], int]:
    """Open leaves, sizes and distances as ``ks_leaves`` returns them, and the values in open leaves."""
    open_, ends, rows = [], [], 0
    for leaves in totals:
        n, m = (sum(side) for side in zip(*leaves.values())) if leaves else (0, 0)
        if not n or not m:
            open_.append({})
            ends.append((n, m, None))
            continue
        before, bounds, best, ref, cur = {}, {}, 0.0, 0, 0
        for leaf in sorted(leaves):
            r, c = leaves[leaf]
            before[leaf] = (ref, cur)
            bounds[leaf] = max(abs((ref + r) / n - cur / m), abs(ref / n - (cur + c) / m))
            ref, cur = ref + r, cur + c
            best = max(best, abs(ref / n - cur / m))
        # An edge is one value: its end is all there is to know.
        open_.append({leaf: before[leaf] for leaf, top in bounds.items() if leaf % 2 == 0 and top > best})
        ends.append((n, m, best))
        rows += sum(sum(leaves[leaf]) for leaf in open_[-1])
    return open_, ends, rows


def ks_two_sample(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    alpha: float = 0.05,
    pieces: int | None = None,
    buckets: int = 64,
) -> DataFrame:
    """Kolmogorov-Smirnov distance and p-value per feature.

    Values from summaries cut every feature into ``buckets`` leaves, whose totals are summed
    map-side. They give the distance at each leaf's end and a bound on the distance inside; only
    leaves whose bound exceeds the best distance are walked, after they have been cut further
    where they hold many values, so few values are shuffled. They are counted before, so
    copies of one value cost nothing, and range-partitioned into as many ``pieces`` as
    there are shuffle partitions unless given: every task walks its own run of values, and the
    totals of the pieces are chained afterwards. Where the cuts lie does not change the result.
    """
    both = _both(reference, current, columns)
    edges, open_, ends = ks_leaves(both, len(columns), buckets)
    known = both.sparkSession.createDataFrame(
        [(i, n, m, best) for i, (n, m, best) in enumerate(ends) if n or m],
        "feature int, n_ref long, n_cur long, best double",
    )
    distance = known.withColumn("distance", F.col("best"))
    if any(open_):
        distance = (
            known.join(F.broadcast(_walked(both, edges, open_, known, pieces)), "feature", "left")  # one row per feature
            .withColumn("distance", F.when(F.col("best").isNotNull(), F.greatest("best", "inside")))
        )
    p = ks_pvalue(F.col("distance"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double"))
    names = F.array(*[F.lit(c) for c in columns])
    return distance.select(
        F.get(names, F.col("feature")).alias("feature"), "n_ref", "n_cur", "distance", p.alias("p_value")
    ).withColumn("shifted", F.col("p_value") < alpha)


def _walked(both: DataFrame, edges, open_, known: DataFrame, pieces: int | None) -> DataFrame:
    """Greatest distance inside the open leaves, per feature."""
    counted = _in_leaves(both, edges, open_).groupBy("feature", "leaf", "x").agg(
        F.sum("ref").alias("ref"), F.sum("cur").alias("cur")
    )
    cut = [pieces] if pieces else []
    # Stored, since the cuts are sampled anew by every run of the plan.
    counts = durable(
        counted.repartitionByRange(*cut, "feature", "leaf", "x").withColumn("piece", F.spark_partition_id())
    )
    starts = both.sparkSession.createDataFrame(
        [(i, leaf, r, c) for i, leaves in enumerate(open_) for leaf, (r, c) in leaves.items()],
        "feature int, leaf int, ref_before long, cur_before long",
    )
    chain = Window.partitionBy("feature", "leaf").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    begins = (  # one row per leaf and piece
        counts.groupBy("feature", "leaf", "piece").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
        .join(F.broadcast(starts), ["feature", "leaf"])
        .join(F.broadcast(known), "feature")
        .select(
            "feature", "leaf", "piece", "n_ref", "n_cur",
            *[
                (F.col(f"{side}_before") + F.coalesce(F.sum(side).over(chain), F.lit(0))).alias(f"{side}_from")
                for side in ("ref", "cur")
            ],
        )
    )
    walk = Window.partitionBy("feature", "leaf", "piece").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    # Chained whole numbers, divided last: the same doubles wherever the cuts lie.
    apart = F.abs(
        (F.col("ref_from") + F.col("ref")) / F.col("n_ref") - (F.col("cur_from") + F.col("cur")) / F.col("n_cur")
    )
    run = counts.select(
        "feature", "leaf", "piece", F.sum("ref").over(walk).alias("ref"), F.sum("cur").over(walk).alias("cur")
    )
    # At most shuffle partitions plus leaves.
    return run.join(F.broadcast(begins), ["feature", "leaf", "piece"]).groupBy("feature").agg(
        F.max(apart).alias("inside")
    )


def psi_kl(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 10,
    epsilon: float = EPSILON,
) -> DataFrame:
    """Population stability index and KL divergence over quantile bins of the reference.

    Equal quantiles merge into one bin. The edges, a few numbers per feature, are
    literals in the plan of the count.
    """
    probs = [i / bins for i in range(1, bins)]
    edges: dict[str, list[float]] = {c: [] for c in columns}
    for row in exact_quantiles(reference, columns, probs).collect():  # bins - 1 rows per feature
        edges[row.feature].append(row.value)
    both = _both(reference, current, columns)
    entries = []
    for i, c in enumerate(columns):
        slot = " + ".join(["0", *[f"int(v{i} > {e!r}D)" for e in sorted(set(edges[c]))]])
        entries.append(
            F.struct(
                F.lit(c).alias("feature"), F.expr(slot).alias("bin"),
                F.col(f"v{i}").isNotNull().alias("known"),
            )
        )
    counts = (
        both.select("is_ref", F.inline(F.array(*entries)))
        .where("known")
        .groupBy("feature", "bin")
        .agg(F.sum("is_ref").alias("ref"), F.sum(F.lit(1) - F.col("is_ref")).alias("cur"))
    )
    feature = Window.partitionBy("feature")  # one row per bin

    def share(name):
        return F.greatest(
            F.try_divide(F.col(name).cast("double"), F.sum(name).over(feature)), F.lit(epsilon)
        )

    p, q = F.col("p"), F.col("q")
    return (
        counts.select("feature", share("cur").alias("p"), share("ref").alias("q"))
        .groupBy("feature")
        .agg(
            F.sum((p - q) * F.log(p / q)).alias("psi"),
            F.sum(p * F.log(p / q)).alias("kl"),
        )
    )
