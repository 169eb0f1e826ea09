"""Named queries over the driver tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query composes library operators on the rating views of
``plans.views``.  Double outputs are rounded to 6 digits and vectors are
emitted as ``(id, dim, value)`` rows, so the DuckDB statements in
``plans.oracle`` can be compared value by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors as fv
from ..operators import als, cells, evaluate, folds, gradient, indexing, prep, project, similar, tune
from ..operators import vectors as V
from ..session import ensure_checkpoint_dir, reliable_checkpoint
from ..sources import files, testdata
from . import views
from .views import rnd

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# fixed parameters of the registered queries
TOP_CATEGORIES = [1, 4]
PROBE_ITEMS = [3, 17, 42]
PROBE_CATEGORIES = [0, 2]
PCA_CATEGORIES = [1, 3, 5]
CELL_ITEMS = 50


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def long_vectors(df: DataFrame, keys: list[str], features: str = "features") -> DataFrame:
    """``keys..., dim, value`` rows of an array column (value rounded)."""
    exploded = df.select(*keys, F.posexplode(features).alias("dim", "value"))
    return exploded.select(*keys, F.col("dim").cast("int").alias("dim"), rnd("value"))


# ---------------------------------------------------------------- step 0
@query
def top_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = similar.top_items(views.lookup(spark, sf_dir), TOP_CATEGORIES)
    return out.select("item_id", rnd("category_id"), rnd("rating"), "item_name")


# ---------------------------------------------------------------- step 1: prepare
@query
def drop_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = prep.drop_null_rows(testdata.nullable_reviews(spark, sf_dir))
    return out.select("user_name", "user_id", "item_id", "item_name", "category", "rating")


@query
def rating_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.triples(spark, sf_dir)


@query
def encode_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexing.dense_codes(views.reviews(spark, sf_dir), "user_name", "user_id")


@query
def encode_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = testdata.nullable_reviews(spark, sf_dir).select("item_id", "category")
    return indexing.encode(rows, "category", "category_id").select("item_id", "category", "category_id")


@query
def item_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = views.lookup(spark, sf_dir)
    return out.select("item_id", "item_name", "category", "category_id", rnd("rating"))


@query
def item_mean_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = prep.item_mean_rating(views.reviews(spark, sf_dir))
    return out.select("item_id", rnd("rating"))


@query
def item_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = prep.item_support(views.reviews(spark, sf_dir), key_col="item_name", min_count=5)
    return out.select("item_name", rnd("mean_rating"), "n_reviews")


@query
def supported_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = prep.supported_reviews(testdata.nullable_reviews(spark, sf_dir), min_count=5)
    return out.select("user_name", "item_name", "rating", "category", rnd("mean_rating"),
                      "n_reviews")


@query
def mean_predictor_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prep.supported_reviews(views.reviews(spark, sf_dir), min_count=5)
    out = prep.mean_predictor(rows)
    return out.select("n", rnd("mean_rating"), rnd("rmse"))


@query
def rating_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prep.supported_reviews(views.reviews(spark, sf_dir), min_count=5)
    out = prep.rating_histogram(rows, bins=10)
    return out.select("bin", rnd("lo"), rnd("hi"), "n")


@query
def entity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.entity_counts(testdata.ratings(spark, sf_dir))


# ---------------------------------------------------------------- step 3: vectors
@query
def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.item_vectors(spark, sf_dir)
    return long_vectors(items.select("item_id", "item_name", "category", "category_id",
                                     rnd("rating"), "features"),
                        ["item_id", "item_name", "category", "category_id", "rating"])


@query
def pack_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = testdata.embeddings(spark, sf_dir)
    d = V.vector_dim(emb)
    wide = emb.select("item_id", *fv.to_wide("features", d))
    packed = wide.select("item_id", fv.to_array([f"f{k}" for k in range(d)]).alias("features"))
    return long_vectors(packed, ["item_id"])


@query
def vectors_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    lk = views.lookup(spark, sf_dir)
    vecs = testdata.embeddings(spark, sf_dir)
    out = V.vectors_by_category(vecs, lk, PCA_CATEGORIES)
    return long_vectors(out, ["item_id", "category_id", "position"])


@query
def category_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = V.category_centroids(views.item_vectors(spark, sf_dir), "category_id")
    return long_vectors(out, ["category_id", "n_items"])


@query
def probe_from_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = V.probe_from_items_frame(views.item_vectors(spark, sf_dir), PROBE_ITEMS).drop("n_found")
    return long_vectors(out, ["names", "n_rows"])


@query
def probe_from_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = V.probe_from_categories_frame(views.item_vectors(spark, sf_dir), PROBE_CATEGORIES).drop("n_found")
    return long_vectors(out, ["names", "n_rows"])


def _item_probe(items: DataFrame) -> list[float]:
    probe, _ = V.collect_probe(V.probe_from_items_frame(items, PROBE_ITEMS), expected=PROBE_ITEMS)
    return probe


@query
def nearest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.item_vectors(spark, sf_dir)
    out = similar.nearest_items(items, _item_probe(items))
    return out.select("item_id", "item_name", "category", rnd("distance"))


@query
def nearest_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.item_vectors(spark, sf_dir)
    out = similar.nearest_categories(items, _item_probe(items))
    return out.select("category_id", "category", rnd("distance"))


@query
def similarity_top15(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.item_vectors(spark, sf_dir)
    out = similar.top_similar(similar.nearest_items(items, _item_probe(items)), 15)
    return out.select("item_id", "item_name", rnd("distance"), rnd("similarity"))


@query
def similarity_top15_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest items again, from items stored by cell."""
    items = views.item_vectors(spark, sf_dir)
    index = cells.write_cells(items, _folder(spark, "cells"), cell_items=CELL_ITEMS)
    found, _ = index.nearest(_item_probe(items), 15)
    return similar.top_similar(found, 15).select("item_id", "item_name", rnd("distance"), rnd("similarity"))


@query
def similarity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.item_vectors(spark, sf_dir)
    out = similar.similarity_report(items, category_ids=PROBE_CATEGORIES, k=15)
    return out.select("kind", "id", "name", rnd("distance"), rnd("similarity"), "probe")


@query
def similarity_report_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views.item_vectors(spark, sf_dir)
    out = similar.similarity_report(items, item_ids=PROBE_ITEMS, category_ids=PROBE_CATEGORIES, k=15)
    return out.select("kind", "id", "name", rnd("distance"), rnd("similarity"), "probe")


# ---------------------------------------------------------------- step 2: folds
K_FOLDS = 5
FOLD_SEED = 42
HELD_OUT = 0


def folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.assign_folds(views.triples(spark, sf_dir), k=K_FOLDS, seed=FOLD_SEED)


@query
def fold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folded(spark, sf_dir).select("user_id", "item_id", "rating", "fold")


@query
def fold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.fold_counts(folded(spark, sf_dir), K_FOLDS)


@query
def fold_train_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = folds.label_split(folded(spark, sf_dir), HELD_OUT)
    return out.select("user_id", "item_id", "rating", "fold", "split")


# ---------------------------------------------------------------- step 4: gradient descent
GD_D = 2
GD_INIT_D = 4
GD_SEED = 1234567
GD_GAIN = 0.001
GD_POWER = 0.2
GD_LAM = 0.1
GD_MU = 0.2
GD_ITERS = 2
GD_HISTORY_ITERS = 3
GD_RESUMED_ITERS = 6
GD_BLOCK_ROWS = 20_000
GD_PACKED_D = 64
GD_GRID_LAMS = [0.0, 0.1]
GD_GRID_DS = [2, 3]


def long_wide(df: DataFrame, keys: list[str], d: int, prefix: str = "f") -> DataFrame:
    """``keys..., dim, value`` rows of wide ``f0..`` columns (value rounded)."""
    arr = F.array(*[F.col(f"{prefix}{k}") for k in range(d)])
    exploded = df.select(*keys, F.posexplode(arr).alias("dim", "value"))
    return exploded.select(*keys, F.col("dim").cast("int").alias("dim"), rnd("value"))


def _gd_params(maxiter: int = GD_ITERS):
    return gradient.GDParams(d=GD_D, gain=GD_GAIN, power=GD_POWER, lam=GD_LAM, mu=GD_MU,
                             maxiter=maxiter, seed=GD_SEED)


def _formula_start(rows: DataFrame, materialize: bool = False):
    """Start vectors; ``materialize`` writes them once for queries that read them
    several times (the trainer checkpoints its start state itself)."""
    U = views.formula_factors(rows, "user_id", GD_D)
    V = views.formula_factors(rows, "item_id", GD_D)
    if materialize:
        return reliable_checkpoint(U), reliable_checkpoint(V)
    return U, V


@query
def init_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.triples(spark, sf_dir)
    both = gradient.init_both(rows, GD_INIT_D, GD_SEED)
    both = both.withColumn("side", F.when(F.col("side") == 0, "user").otherwise("item"))
    return long_wide(both, ["side", "id"], GD_INIT_D)


def _joined(spark: SparkSession, sf_dir: str):
    rows = views.triples(spark, sf_dir)
    U, V = _formula_start(rows, materialize=True)
    return gradient.join_predict(rows, U, V, GD_D), U, V


@query
def residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    j, _, _ = _joined(spark, sf_dir)
    return j.select("user_id", "item_id", "rating", rnd("err"))


@query
def gd_objective(spark: SparkSession, sf_dir: str) -> DataFrame:
    j, U, V = _joined(spark, sf_dir)
    out = gradient.objective_terms(j, U, V, GD_D, GD_LAM, GD_MU)
    return out.select(rnd("sse"), rnd("user_norm"), rnd("item_norm"), rnd("objective"))


@query
def gd_user_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    j, U, _ = _joined(spark, sf_dir)
    out = gradient.user_step(j, U, gradient.step_size(GD_GAIN, GD_POWER, 1), GD_LAM, GD_D)
    return long_wide(out.withColumnRenamed("id", "user_id"), ["user_id"], GD_D)


@query
def gd_item_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    j, _, V = _joined(spark, sf_dir)
    out = gradient.item_step(j, V, gradient.step_size(GD_GAIN, GD_POWER, 1), GD_MU, GD_D)
    return long_wide(out.withColumnRenamed("id", "item_id"), ["item_id"], GD_D)


@query
def gd_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.triples(spark, sf_dir)
    U0, V0 = _formula_start(rows)
    res = gradient.train(rows, _gd_params(), U0=U0, V0=V0)
    return _both(res, GD_D)


def _both(res: gradient.GDResult, d: int) -> DataFrame:
    both = res.U.withColumn("side", F.lit("user")).unionByName(res.V.withColumn("side", F.lit("item")))
    return long_wide(both, ["side", "id"], d)


@query
def gd_train_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``gd_train`` with the ratings in two-sided blocks: steps move factors only."""
    rows = views.triples(spark, sf_dir)
    U0, V0 = _formula_start(rows)
    res = gradient.train(rows, _gd_params(), U0=U0, V0=V0, persist=False, layout="blocks", block_rows=GD_BLOCK_ROWS)
    return _both(res, GD_D)


@query
def gd_train_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One step of many dimensions: factors are arrays, summed by one vector aggregate."""
    rows = views.triples(spark, sf_dir)
    U0, V0 = _start_vectors(rows, GD_PACKED_D)
    params = replace(_gd_params(1), d=GD_PACKED_D)
    return _both(gradient.train(rows, params, U0=U0, V0=V0), GD_PACKED_D)


@query
def gd_train_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trainer with the library's default parameters and hashed start vectors: objective of every step."""
    res = gradient.train(views.triples(spark, sf_dir))
    rows = [(h["iteration"], h["objective"]) for h in res.history]  # a row for each step
    out = spark.createDataFrame(rows, "iteration int, objective double")
    return out.select("iteration", F.round("objective", 3).alias("objective"))


@query
def gd_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three steps, and from their manifest three more by a second call."""
    rows = views.triples(spark, sf_dir)
    U0, V0 = _formula_start(rows)
    folder = _folder(spark, "resume")
    gradient.train(rows, _gd_params(GD_RESUMED_ITERS // 2), U0=U0, V0=V0, resume_dir=folder)
    return _both(gradient.train(rows, _gd_params(GD_RESUMED_ITERS), resume_dir=folder), GD_D)


@query
def gd_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = gradient.cross_validate(folded(spark, sf_dir), _gd_params(), K_FOLDS, init=_start_vectors)
    return out.select("fold", "n_train", "n_test", "n_scored", rnd("rmse"), rnd("mae"))


def _start_vectors(rows: DataFrame, d: int) -> tuple[DataFrame, DataFrame]:
    return views.formula_factors(rows, "user_id", d), views.formula_factors(rows, "item_id", d)


@query
def gd_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objective, step size and test error entering each step, fold 0 held out."""
    train, test = folds.fold_split(reliable_checkpoint(folded(spark, sf_dir)), HELD_OUT)
    U0, V0 = _formula_start(train)
    res = gradient.train(train, _gd_params(GD_HISTORY_ITERS), test=test, U0=U0, V0=V0)
    rows = [(h["iteration"], h["objective"], h["gamma"], h["n_test"], h["n_scored"], h["test_rmse"])
            for h in res.history]  # a row for each step
    out = spark.createDataFrame(rows, "iteration int, objective double, gamma double, n_test bigint, "
                                      "n_scored bigint, test_rmse double")
    return out.select("iteration", rnd("objective"), rnd("gamma"), "n_test", "n_scored", rnd("test_rmse"))


@query
def gd_train_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.triples(spark, sf_dir)
    U0, V0 = _formula_start(rows)
    _, m = gradient.train_all(rows, _gd_params(), U0=U0, V0=V0)
    out = spark.createDataFrame([(m["n_train"], m["train_rmse"], m["train_mae"])],
                                "n_train bigint, train_rmse double, train_mae double")
    return out.select("n_train", rnd("train_rmse"), rnd("train_mae"))


@query
def gd_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = gradient.grid_runs(folded(spark, sf_dir), GD_GRID_LAMS, [GD_MU], GD_GRID_DS, K_FOLDS,
                              base=_gd_params(1), init=_start_vectors)
    return runs.select("lam", "mu", "d", "fold", "n_train", "n_test", "n_scored", rnd("rmse"), rnd("mae"))


@query
def gd_grid_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid of ``gd_grid`` after a search that stopped halfway: the runs table holds every run once."""
    rows, path = reliable_checkpoint(folded(spark, sf_dir)), _folder(spark, "grid")
    for lams in (GD_GRID_LAMS[:1], GD_GRID_LAMS):
        gradient.grid_runs(rows, lams, [GD_MU], GD_GRID_DS, K_FOLDS, base=_gd_params(1), init=_start_vectors, runs_path=path)
    runs = files.read_runs(spark, path)
    return runs.select("lam", "mu", "d", "fold", "n_train", "n_test", "n_scored", rnd("rmse"), rnd("mae"))


# ---------------------------------------------------------------- step 5: evaluation, tuning
EVAL_REGS = [0.0, 2.0, 10.0]
EVAL_MIN_COUNTS = [1, 5]


def _runs(spark: SparkSession, sf_dir: str, regs, min_counts) -> DataFrame:
    return evaluate.item_mean_runs(folded(spark, sf_dir), K_FOLDS, regs, min_counts)


@query
def rmse_by_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _runs(spark, sf_dir, [0.0], [0])
    return out.select("fold", "n_test", "n_scored", rnd("rmse"))


@query
def mae_by_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _runs(spark, sf_dir, [0.0], [0])
    return out.select("fold", "n_test", "n_scored", rnd("mae"))


def _cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.cv_error(_runs(spark, sf_dir, EVAL_REGS, EVAL_MIN_COUNTS), ["reg", "min_count"])


@query
def cv_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cv(spark, sf_dir).select("reg", "min_count", rnd("cv_rmse"), "n_folds")


@query
def best_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tune.best_params(_cv(spark, sf_dir), rel_tol=1e-9).select("reg", "min_count", rnd("cv_rmse"), "n_folds")


@query
def tuning_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tune.tuning_curve(_cv(spark, sf_dir), {"min_count": 1}, "reg").select("reg", rnd("cv_rmse"))


# ---------------------------------------------------------------- step 6: ALS
# The folds of one setting are fitted concurrently (parallelism = k): at the
# test scale one fit cannot fill the local cores.
ALS_RANK = 8
ALS_ITERS = 5
ALS_REG = 0.1
ALS_GRID_REGS = [0.05, 0.1, 0.2]
ALS_TOLERANCE = 1e-5
EXPORT_D = 4


def _als_params(**kw):
    base = dict(rank=ALS_RANK, max_iter=ALS_ITERS, reg=ALS_REG, seed=42)
    base.update(kw)
    return als.ALSParams(**base)


@query
def als_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = als.fit(views.triples(spark, sf_dir), _als_params())
    U, V = als.factors(model)
    both = U.withColumn("side", F.lit("user")).unionByName(V.withColumn("side", F.lit("item")))
    return long_vectors(both, ["side", "id"])


@query
def als_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = als.cross_validate(folded(spark, sf_dir), _als_params(), K_FOLDS, parallelism=K_FOLDS)
    return out.select("fold", "n_train", "n_test", "n_scored", rnd("rmse"), rnd("mae"))


@query
def als_train_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, m = als.train_all(views.triples(spark, sf_dir), _als_params())
    return spark.createDataFrame(
        [(m["n_train"], m["n_scored"], m["train_rmse"], m["train_mae"])],
        "n_train bigint, n_scored bigint, train_rmse double, train_mae double",
    ).select("n_train", "n_scored", rnd("train_rmse"), rnd("train_mae"))


@query
def als_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = als.grid_runs(folded(spark, sf_dir), ALS_GRID_REGS, [ALS_RANK], K_FOLDS,
                         base=_als_params(), parallelism=K_FOLDS)
    return runs.select("reg", "rank", "fold", "n_train", "n_test", "n_scored", rnd("rmse"),
                       rnd("mae"))


@query
def als_user_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every user's factors solve its ridge equations."""
    rows = reliable_checkpoint(views.triples(spark, sf_dir))
    fitted = als.fit(rows, _als_params())
    return als.user_equations(fitted, rows, ALS_REG)


@query
def als_cv_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows trained on, tested and scored by the ALS cross validation of one setting."""
    out = als.cross_validate(folded(spark, sf_dir), _als_params(max_iter=1, rank=2), K_FOLDS, parallelism=K_FOLDS)
    return out.select("fold", "n_train", "n_test", "n_scored", (F.col("mae") <= F.col("rmse")).alias("ordered"))


def _same(a: str, b: str) -> Column:
    """Equal errors: a model predicts in single precision, factor tables are joined in double."""
    return F.abs(F.col(a) - F.col(b)) <= F.lit(ALS_TOLERANCE) * F.col(b)


def _compared(model: DataFrame, joined: DataFrame, keys: list[str]) -> DataFrame:
    """Whether errors by the model are those by its exported factors."""
    again = joined.select(*keys, F.col("n_scored").alias("_n"), F.col("rmse").alias("_rmse"), F.col("mae").alias("_mae"))
    met = model.join(again, keys) if keys else model.crossJoin(again)  # one row each
    return met.select(*keys, "n_train", *[c for c in ("n_test",) if c in model.columns], "n_scored",
                      (F.col("n_scored") == F.col("_n")).alias("same_rows"), _same("rmse", "_rmse").alias("same_rmse"),
                      _same("mae", "_mae").alias("same_mae"))


@query
def als_cv_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out errors of every fold, again by joins with the factor files of its model."""
    rows, out = reliable_checkpoint(folded(spark, sf_dir)), _folder(spark, "als-cv")
    cv = als.cross_validate(rows, _als_params(), K_FOLDS, parallelism=K_FOLDS, export_dir=out)
    U, V = als.read_exported(spark, out, ALS_RANK, K_FOLDS)
    return _compared(cv, evaluate.factor_errors(rows, U, V, by=["fold"]), ["fold"])


@query
def als_train_all_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training errors, again by joins with the model's factor files."""
    rows, out = reliable_checkpoint(views.triples(spark, sf_dir)), _folder(spark, "als-all")
    fitted, m = als.train_all(rows, _als_params())
    als.write_factors(fitted, out)
    model = spark.createDataFrame([(m["n_train"], m["n_scored"], m["train_rmse"], m["train_mae"])],
                                  "n_train bigint, n_scored bigint, rmse double, mae double")
    return _compared(model, evaluate.factor_errors(rows, *als.read_exported(spark, out, ALS_RANK)), [])


@query
def als_train_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``als_train_all_values`` with the library's default parameters."""
    rows, out, params = reliable_checkpoint(views.triples(spark, sf_dir)), _folder(spark, "als-defaults"), als.ALSParams()
    fitted, m = als.train_all(rows, params)
    als.write_factors(fitted, out)
    model = spark.createDataFrame([(m["n_train"], m["n_scored"], m["train_rmse"], m["train_mae"])],
                                  "n_train bigint, n_scored bigint, rmse double, mae double")
    return _compared(model, evaluate.factor_errors(rows, *als.read_exported(spark, out, params.rank)), [])


@query
def als_grid_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out errors of every setting and fold, again by joins with the factor files."""
    rows, out = reliable_checkpoint(folded(spark, sf_dir)), _folder(spark, "als-grid")
    runs = als.grid_runs(rows, ALS_GRID_REGS, [ALS_RANK], K_FOLDS, base=_als_params(), parallelism=K_FOLDS, export_dir=out)
    sides = [[x.withColumn("reg", F.lit(reg)) for x in
              als.read_exported(spark, als.exported_at(out, reg, ALS_RANK), ALS_RANK, K_FOLDS)] for reg in ALS_GRID_REGS]
    U, V = (reduce(DataFrame.unionByName, [s[n] for s in sides]) for n in (0, 1))
    asked = rows.crossJoin(F.broadcast(spark.createDataFrame([(r,) for r in ALS_GRID_REGS], "reg double")))  # three settings
    return _compared(runs.drop("rank"), evaluate.factor_errors(asked, U, V, by=["reg", "fold"]), ["reg", "fold"])


@query
def factor_export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    U = views.formula_factors(views.triples(spark, sf_dir), "user_id", EXPORT_D)
    return U.select(fv.vector_text("id", [f"f{k}" for k in range(EXPORT_D)], scale=12).alias("value"))


# ---------------------------------------------------------------- step 7: projection
@query
def pca_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = V.vectors_by_category(testdata.embeddings(spark, sf_dir), views.lookup(spark, sf_dir),
                                 PCA_CATEGORIES)
    out = project.pca_coords(vecs, k=3, keep=("item_id", "category_id", "position"))
    return out.select("item_id", "category_id", "position", rnd("pc1"), rnd("pc2"), rnd("pc3"))


# ---------------------------------------------------------------- files: written and read back
def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ratingspark-{name}-{uuid.uuid4().hex}"


@query
def reviews_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "reviews")
    names = [F.col(name).alias(raw) for raw, _, name in files.REVIEW_FILE_COLUMNS]
    files.write_table(views.reviews(spark, sf_dir).select(*names), path)
    return files.read_reviews(spark, path).select("user_name", "item_id", "item_name", "category", rnd("rating"))


@query
def ratings_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "ratings")
    views.triples(spark, sf_dir).select("user_id", "item_id", "rating").write.csv(path)
    return files.read_ratings(spark, path, "user_id BIGINT, item_id BIGINT, rating DOUBLE")


@query
def folds_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "folds")
    files.write_folds(folded(spark, sf_dir), path)
    return files.read_folds(spark, path, K_FOLDS, "user_id BIGINT, item_id BIGINT, rating DOUBLE")


@query
def lookup_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "lookup")
    files.write_lookup(views.lookup(spark, sf_dir), path)
    return files.read_lookup(spark, path).select("item_id", "item_name", "category", "category_id", rnd("rating"))


@query
def factors_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "factors")
    files.write_factor_text(views.formula_factors(views.triples(spark, sf_dir), "user_id", EXPORT_D), path)
    return long_vectors(files.read_factors(spark, path, EXPORT_D, "bigint"), ["id"])


@query
def runs_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of three settings from one pass; a repeated append adds nothing."""
    path, runs = _folder(spark, "runs"), reliable_checkpoint(_runs(spark, sf_dir, EVAL_REGS, [0]))
    for _ in range(2):
        files.append_runs(runs, path)
    return files.read_runs(spark, path).select("reg", "fold", "n_test", "n_scored", rnd("rmse"), rnd("mae"))


@query
def ratings_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rating file with bad lines: clean rows, rejected lines and the counts of both."""
    path = _folder(spark, "bad-ratings")
    user, item, rating = (F.col(c).cast("string") for c in ("user_id", "item_id", "rating"))
    kind = F.col("item_id") % 10
    line = (F.when(kind == 3, F.concat_ws(",", user, item, F.lit("n/a")))
            .when(kind == 7, F.concat_ws(",", user, item)).otherwise(F.concat_ws(",", user, item, rating)))
    views.triples(spark, sf_dir).select(line.alias("value")).write.text(path)
    found = files.read_checked(spark, path, "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    clean = found.clean.select(F.lit("clean").alias("kind"), "user_id", "item_id", rnd("rating"), F.lit(None).cast("string").alias("line"))
    bad = found.rejected.select(F.lit("rejected").alias("kind"), F.lit(None).cast("bigint").alias("user_id"),
                                F.lit(None).cast("bigint").alias("item_id"), F.lit(None).cast("double").alias("rating"), "line")
    return clean.unionByName(bad).join(F.broadcast(found.counts), "kind")


@query
def reviews_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review file in which some ratings are no number: rows by kind."""
    path = _folder(spark, "bad-reviews")
    named = {name: raw for raw, _, name in files.REVIEW_FILE_COLUMNS}
    rating = F.when(F.col("item_id") % 10 == 3, F.lit("unrated")).otherwise(F.col("rating").cast("string"))
    files.write_table(views.reviews(spark, sf_dir).select(
        "user_id", *[(rating if name == "rating" else F.col(name)).alias(raw) for name, raw in named.items()]), path)
    found = files.read_reviews_checked(spark, path)
    clean = found.clean.groupBy("category").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("rating"), "rating"))
    bad = found.rejected.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("(rejected)").alias("category"), "n", F.lit(None).cast("double").alias("rating"))
    return clean.unionByName(bad)


@query
def result_tables_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The explore stage's tables, written and read back."""
    items, path = views.item_vectors(spark, sf_dir), _folder(spark, "explore")
    similar.write_outputs(items, path, item_ids=PROBE_ITEMS, top_categories=TOP_CATEGORIES)
    near = files.read_table(spark, f"{path}/item_distances", "item_id BIGINT, item_name STRING, category STRING, distance DOUBLE")
    cats = files.read_table(spark, f"{path}/category_distances", "category_id BIGINT, category STRING, distance DOUBLE")
    top = files.read_table(spark, f"{path}/top_items", "item_id BIGINT, category_id DOUBLE, rating DOUBLE, item_name STRING")
    return (near.select(F.lit("item").alias("kind"), F.col("item_id").alias("id"), F.col("item_name").alias("name"), rnd("distance", "value"))
            .unionByName(cats.select(F.lit("category").alias("kind"), F.col("category_id").alias("id"), F.col("category").alias("name"), rnd("distance", "value")))
            .unionByName(top.select(F.lit("top").alias("kind"), F.col("item_id").alias("id"), F.col("item_name").alias("name"), rnd("rating", "value"))))
