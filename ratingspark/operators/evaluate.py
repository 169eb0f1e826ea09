"""Error metrics and cross validation.

Metrics are sums computed in one aggregate (count, squared and absolute
error), per fold when a fold column is given, so all folds cost one job.

``item_mean_runs`` is a closed-form predictor used to exercise the tuning
tools without training: the mean rating of the item in the *other* folds,
shrunk towards the global train mean.  All folds and all parameter settings
come from one pass over the ratings, which are first reduced to
``(item, fold, rating) -> count`` (ratings take few distinct values, so this
table is far smaller than the rows; a hot item is one partial row per map
task).  Per (item, fold) sums follow from it, "every fold but h" sums by
subtraction from the item totals, and the errors of every setting are
count-weighted sums over the same reduced table.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint


def error_sums(scored: DataFrame, label: str = "rating", prediction: str = "prediction",
               group_col: str | None = None) -> DataFrame:
    """``n_scored, sse, sae`` over rows with a non-null prediction."""
    err = F.col(prediction) - F.col(label)
    rows = scored.where(F.col(prediction).isNotNull())
    aggs = [F.count(F.lit(1)).alias("n_scored"), F.sum(err * err).alias("sse"),
            F.sum(F.abs(err)).alias("sae")]
    return rows.groupBy(group_col).agg(*aggs) if group_col else rows.agg(*aggs)


def rmse(scored: DataFrame, label: str = "rating", prediction: str = "prediction",
         group_col: str | None = None) -> DataFrame:
    """RMSE = sqrt(mean((r - p)^2)) over scored rows."""
    s = error_sums(scored, label, prediction, group_col)
    keys = [group_col] if group_col else []
    return s.select(*keys, "n_scored", F.sqrt(F.col("sse") / F.col("n_scored")).alias("rmse"))


def mae(scored: DataFrame, label: str = "rating", prediction: str = "prediction",
        group_col: str | None = None) -> DataFrame:
    """Mean absolute error (A17; the reference's RDD variant called it RMSE)."""
    s = error_sums(scored, label, prediction, group_col)
    keys = [group_col] if group_col else []
    return s.select(*keys, "n_scored", (F.col("sae") / F.col("n_scored")).alias("mae"))


def factor_errors(rows: DataFrame, U: DataFrame, V: DataFrame, by: Sequence[str] = (), user_col: str = "user_id",
                  item_col: str = "item_id", rating_col: str = "rating") -> DataFrame:
    """``by..., n_scored, rmse, mae`` of predictions <u, v> from factor tables.

    ``U`` and ``V`` are ``(by..., id, features)``, for instance the factors of
    all folds with their fold, read from files: no model object is involved.
    Rows of users or items without factors are not scored, nor are null
    ratings; repeated (user, item) pairs are scored one by one.
    """
    u = U.select(*by, F.col("id").alias(user_col), F.col("features").alias("_u"))
    v = V.select(*by, F.col("id").alias(item_col), F.col("features").alias("_v"))
    pairs = rows.select(*by, user_col, item_col, rating_col).join(u, [*by, user_col]).join(v, [*by, item_col])
    prediction = F.aggregate(F.zip_with("_u", "_v", lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)
    err = prediction - F.col(rating_col)
    return pairs.groupBy(*by).agg(F.count(err).alias("n_scored"), F.sqrt(F.avg(err * err)).alias("rmse"),
                                  F.avg(F.abs(err)).alias("mae"))


def cv_error(runs: DataFrame, params: Sequence[str], metric: str = "rmse") -> DataFrame:
    """Cross-validation error per setting: unweighted mean over folds."""
    return runs.groupBy(*params).agg(F.avg(metric).alias(f"cv_{metric}"),
                                     F.count(F.lit(1)).alias("n_folds"))


def _train_stats(per_rating: DataFrame, item_col: str, rating_col: str,
                 fold_col: str) -> DataFrame:
    """``item, fold(=held out), s_train, c_train``: item sums over every other fold."""
    per = per_rating.groupBy(item_col, fold_col).agg(
        F.sum(F.col(rating_col) * F.col("_w")).alias("_s_fold"), F.sum("_w").alias("_c_fold"))
    tot = per.groupBy(item_col).agg(F.sum("_s_fold").alias("_s_all"),
                                    F.sum("_c_fold").alias("_c_all"))
    return per.join(tot, item_col).select(
        item_col, fold_col, (F.col("_s_all") - F.col("_s_fold")).alias("s_train"),
        (F.col("_c_all") - F.col("_c_fold")).alias("c_train"))


def _global_train(per_rating: DataFrame, rating_col: str, fold_col: str) -> DataFrame:
    """``fold, g_train`` = mean rating over every other fold (a row per fold of the data)."""
    per = per_rating.groupBy(fold_col).agg(F.sum(F.col(rating_col) * F.col("_w")).alias("_s"),
                                           F.sum("_w").alias("_c"))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return per.select(fold_col, F.try_divide(F.sum("_s").over(every) - F.col("_s"),
                                         F.sum("_c").over(every) - F.col("_c")).alias("g_train"))


def shrunk_mean(reg: float, min_count: int) -> Column:
    """Prediction from (s_train, c_train, g_train) for one setting.

    No train rating of the item -> null (unscored, like a cold-start drop)
    when ``min_count`` is 0, the global train mean otherwise; fewer than
    ``min_count`` ratings -> the global train mean; else the mean shrunk by a
    prior of weight ``reg`` at the global mean.
    """
    s, c, g = F.col("s_train"), F.coalesce(F.col("c_train"), F.lit(0)), F.col("g_train")
    shrunk = (s + F.lit(float(reg)) * g) / (c + F.lit(float(reg)))
    if min_count <= 0:
        return F.when(c == 0, F.lit(None).cast("double")).otherwise(shrunk)
    return F.when(c < F.lit(min_count), g).otherwise(shrunk)


def item_mean_runs(folded: DataFrame, k: int, regs: Sequence[float],
                   min_counts: Sequence[int], item_col: str = "item_id",
                   rating_col: str = "rating", fold_col: str = "fold") -> DataFrame:
    """Runs table ``reg, min_count, fold, n_test, n_scored, rmse, mae`` for a grid.

    Every row of fold h is a test row for held-out fold h, whatever folds the
    data holds (``k`` is only a check: more folds than it says is an error;
    rows without a fold only train).  One join to the
    (item, fold) train stats and one per-fold aggregate serve every setting.
    """
    # read three times (item stats, fold means, errors): written once, so the
    # ratings are scanned once
    per_rating = reliable_checkpoint(
        folded.where(F.col(rating_col).isNotNull())
        .groupBy(item_col, fold_col, rating_col).agg(F.count(F.lit(1)).alias("_w")))
    beyond = per_rating.agg(F.max(fold_col)).first()[0]
    if beyond is not None and beyond >= k:
        raise ValueError(f"the data holds fold {beyond}, but k is {k}")
    stats = _train_stats(per_rating, item_col, rating_col, fold_col)
    glob = _global_train(per_rating, rating_col, fold_col)
    rows = (per_rating.join(stats, [item_col, fold_col], "left")
            .join(F.broadcast(glob), fold_col))
    grid = list(product(regs, min_counts))
    w = F.col("_w")
    aggs = [F.sum(w).alias("n_test")]
    for i, (reg, mc) in enumerate(grid):
        err = shrunk_mean(reg, mc) - F.col(rating_col)
        aggs += [F.sum(F.when(err.isNotNull(), w)).alias(f"n{i}"),
                 F.sum(w * err * err).alias(f"q{i}"),
                 F.sum(w * F.abs(err)).alias(f"a{i}")]
    per_fold = rows.groupBy(fold_col).agg(*aggs)
    recs = F.explode(F.array(*[
        F.struct(F.lit(float(reg)).alias("reg"), F.lit(int(mc)).alias("min_count"),
                 F.col(f"n{i}").alias("n_scored"), F.col(f"q{i}").alias("sse"),
                 F.col(f"a{i}").alias("sae"))
        for i, (reg, mc) in enumerate(grid)]))
    out = per_fold.select(fold_col, "n_test", recs.alias("r")).select(
        "r.reg", "r.min_count", fold_col, "n_test",
        F.coalesce(F.col("r.n_scored"), F.lit(0)).cast("bigint").alias("n_scored"),
        "r.sse", "r.sae")
    return out.select("reg", "min_count", fold_col, F.col("n_test").cast("bigint"), "n_scored",
                      F.sqrt(F.col("sse") / F.col("n_scored")).alias("rmse"),
                      (F.col("sae") / F.col("n_scored")).alias("mae"))


def check_folds(sizes: dict, k: int) -> None:
    """Raise if the data holds folds beyond ``0..k-1``: they would never be tested."""
    beyond = [h for h in sizes if h is None or not 0 <= h < k]
    if beyond:
        raise ValueError(f"the data holds folds {beyond}, but k is {k}")


def run_folds(one_fold, k: int, parallelism: int = 1) -> list:
    """``[one_fold(h) for h in range(k)]``, optionally from a thread pool.

    Pool threads inherit the caller's local properties (job group,
    description, scheduler pool), as PySpark's pinned-thread mode requires.
    """
    if parallelism <= 1:
        return [one_fold(h) for h in range(k)]
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    task = inheritable_thread_target(one_fold)
    with ThreadPoolExecutor(max_workers=min(parallelism, k)) as pool:
        return list(pool.map(task, range(k)))
