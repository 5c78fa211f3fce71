"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the benchmark tables under ``sf_dir`` (through
``sources.tables``) and runs the library's operators over all of them.
Inexact doubles (predictions, RMSE) are rounded to 6 places for display and
comparison; exact ones (means of grid ratings, similarities computed from
exact co-moments) are returned as computed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corate.constants import ALS_RANK
from corate.operators.als import dot_differences, factor_tables, user_residuals
from corate.operators.evaluate import evaluate, score
from corate.operators.impute import impute, unscorable_by_factors
from corate.operators.neighbors import (
    attach_similarity,
    item_candidates,
    top_k,
    user_candidates,
)
from corate.operators.pair_count import corated_pair_count
from corate.operators.ridge import fold_in, residuals
from corate.operators.split import dedup_last
from corate.operators.stats import adjacency_lists, item_stats, user_genre_stats
from corate.plans import pipelines as P
from corate.session import ensure_checkpoint_dir, materialize, table_path
from corate.sources.readers import (
    read_genres_csv,
    read_predictions_csv,
    read_ratings_csv,
    read_test_csv,
)
from corate.sources.sinks import prediction_rows, write_predictions
from corate.sources.tables import benchmark_inputs, write_csv_inputs

_PREP_CACHE: dict[tuple, P.Prepared] = {}


def _session_key(spark: SparkSession) -> tuple:
    return (id(spark), spark.sparkContext.applicationId)


def prepared(spark: SparkSession, sf_dir: str, offgrid: bool = False) -> P.Prepared:
    """Deduped, split and materialized inputs for ``sf_dir`` (built once per
    session and directory)."""
    key = (_session_key(spark), sf_dir.rstrip("/"), offgrid)
    if key not in _PREP_CACHE:
        inp = benchmark_inputs(spark, sf_dir, offgrid)
        _PREP_CACHE[key] = P.prepare(inp.events, inp.test, inp.genres)
    return _PREP_CACHE[key]


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(F.col(c), 6))
    return df


_PRED_COLS = ["user", "item", "rating", "prediction", "source", "n_neighbors"]


# --- inputs and statistics -------------------------------------------------

def q_ratings_dedup(spark, sf_dir):
    """Rating events deduplicated per (user, item), last event wins."""
    return dedup_last(benchmark_inputs(spark, sf_dir).events)


def q_test_pairs(spark, sf_dir):
    return benchmark_inputs(spark, sf_dir).test


def q_train_split(spark, sf_dir):
    return prepared(spark, sf_dir).train


def q_truth_holdout(spark, sf_dir):
    return prepared(spark, sf_dir).truth


def q_user_stats(spark, sf_dir):
    return prepared(spark, sf_dir).ustats


def q_item_stats(spark, sf_dir):
    return item_stats(prepared(spark, sf_dir).train)


def q_user_item_lists(spark, sf_dir):
    return adjacency_lists(prepared(spark, sf_dir).train, "user", "item")


def q_item_user_lists(spark, sf_dir):
    return adjacency_lists(prepared(spark, sf_dir).train, "item", "user")


def q_user_genre_mean(spark, sf_dir):
    p = prepared(spark, sf_dir)
    return user_genre_stats(p.train, p.genres)


# --- similarity tables -----------------------------------------------------

def q_corated_pairs(spark, sf_dir):
    """Pearson similarity of every co-rated item pair (the item-pair job)."""
    return P.item_pairs(prepared(spark, sf_dir))


def q_corated_pair_count(spark, sf_dir):
    """Co-rated item pairs, counted from bitmaps."""
    return corated_pair_count(prepared(spark, sf_dir).train)


def q_item_pearson(spark, sf_dir):
    """Pearson similarity of every (test item, item the test user rated) pair
    the item-based job looks up; 0 for pairs without a co-rater."""
    p = prepared(spark, sf_dir)
    return P.item_pairs(p, needed=P.needed_item_pairs(p), of_truth=True)


def q_item_pearson_offgrid(spark, sf_dir):
    """Pearson similarity of every co-rated item pair, for ratings off any
    grid, from exact sums; to 12 places."""
    pairs = P.item_pairs(prepared(spark, sf_dir, offgrid=True))
    return pairs.withColumn("sim", F.round("sim", 12) + F.lit(0.0))


def q_item_sum_normalized(spark, sf_dir):
    return P.item_pairs(prepared(spark, sf_dir), "sum_normalized")


def q_user_pearson(spark, sf_dir):
    return P.user_pairs(prepared(spark, sf_dir))[0]


# --- neighbours ------------------------------------------------------------

def q_topk_items(spark, sf_dir):
    """Top 10 most similar rated items per answered test pair."""
    p = prepared(spark, sf_dir)
    if P.takes_passes(p, "user"):
        top = P.ranked_items(p, 10)
    else:
        cand = item_candidates(p.truth, p.train)
        keep = P.needed_pairs(cand, "item", None, p.pair_rows)
        top = top_k(attach_similarity(cand, P.item_pairs(p, keep=keep), "item", "item1", "item2"), 10)
    return top.select("user", "item", "nbr", "nbr_rating", "sim", "nbr_rank")


def q_topk_users(spark, sf_dir):
    """Most similar rater of the test item per answered test pair (k = 1)."""
    p = prepared(spark, sf_dir)
    centred = P.centred_layout(p)
    cand = user_candidates(p.truth, centred)
    keep = P.needed_pairs(cand, "user", None, P.user_pair_rows(p))
    sims, _ = P.user_pairs(p, keep=keep, needed=P.needed_user_pairs(p) if keep is None else None, of_truth=True)
    scored = attach_similarity(cand, sims, "user", "user1", "user2")
    return top_k(scored, 1).select("user", "item", "nbr", "nbr_rating", "sim", "nbr_rank")


# --- predictions and evaluation --------------------------------------------

def q_item_based_predict(spark, sf_dir):
    return _r6(P.item_based(prepared(spark, sf_dir)).predictions.select(*_PRED_COLS), "prediction")


def q_item_based_eval(spark, sf_dir):
    return _r6(P.item_based(prepared(spark, sf_dir)).metrics, "rmse")


def q_item_based_sum_normalized_predict(spark, sf_dir):
    r = P.item_based(prepared(spark, sf_dir), metric="sum_normalized")
    return _r6(r.predictions.select(*_PRED_COLS), "prediction")


def q_item_based_genre_fallback(spark, sf_dir):
    r = P.item_based(prepared(spark, sf_dir), fallback="genre")
    return _r6(r.predictions.select(*_PRED_COLS), "prediction")


def q_item_based_offgrid_predict(spark, sf_dir):
    """Item-based predictions from all neighbours, for ratings off any grid."""
    r = P.item_based(prepared(spark, sf_dir, offgrid=True), k=None)
    return _r6(r.predictions.select(*_PRED_COLS), "rating", "prediction")


def q_score_join_eval(spark, sf_dir):
    """Evaluation of the user-mean prediction (else the global mean) of every
    test pair against the held-out ratings."""
    p = prepared(spark, sf_dir)
    guess = p.test.join(p.ustats, "user", "left").select(
        "user", "item", F.coalesce("mean_rating", p.gmean).alias("prediction"))
    return _r6(evaluate(score(p.truth, guess)), "rmse")


def q_prediction_file(spark, sf_dir):
    """The item-based prediction file as written, read back with each row's position."""
    ensure_checkpoint_dir(spark)
    path = table_path(spark, "prediction-file")
    pred = materialize(_r6(P.item_based(prepared(spark, sf_dir)).predictions, "prediction"), "auto", "pred")
    write_predictions(pred, path)
    return read_predictions_csv(spark, path)


def q_prediction_single_file(spark, sf_dir):
    """The same as one file, joined from ordered parts, read back."""
    ensure_checkpoint_dir(spark)
    path = table_path(spark, "prediction-one")
    pred = materialize(_r6(P.item_based(prepared(spark, sf_dir)).predictions, "prediction"), "auto", "pred")
    write_predictions(pred, path, single_file=True)
    return read_predictions_csv(spark, path)


def q_prediction_output(spark, sf_dir):
    """The sorted prediction file rows (UserId, MovieId, Pred_rating)."""
    pred = _r6(P.item_based(prepared(spark, sf_dir)).predictions, "prediction")
    return prediction_rows(pred)


def q_user_based_predict(spark, sf_dir):
    r = P.user_based(prepared(spark, sf_dir), k=1, loo="literal")
    return _r6(r.predictions.select(*_PRED_COLS), "prediction")


def q_user_based_predict_corrected(spark, sf_dir):
    r = P.user_based(prepared(spark, sf_dir), k=1, loo="corrected")
    return _r6(r.predictions.select(*_PRED_COLS), "prediction")


def q_user_based_eval(spark, sf_dir):
    return _r6(P.user_based(prepared(spark, sf_dir), k=1).metrics, "rmse")


# --- cold start, imputation, factor model ----------------------------------

def q_cold_start_cases(spark, sf_dir):
    """Answered test pairs a factor model cannot score, with the reason."""
    p = prepared(spark, sf_dir)
    return unscorable_by_factors(p.truth, p.train)


def q_impute_genre(spark, sf_dir):
    p = prepared(spark, sf_dir)
    cases = unscorable_by_factors(p.truth, p.train).drop("reason")
    return impute(cases, p.train, p.genres, p.gmean, "genre", p.ustats)


def q_impute_item_mean(spark, sf_dir):
    p = prepared(spark, sf_dir)
    cases = unscorable_by_factors(p.truth, p.train).drop("reason")
    return impute(cases, p.train, p.genres, p.gmean, "item_mean", p.ustats)


_MODEL_CACHE: dict[tuple, P.ModelResult] = {}


def _model(spark, sf_dir) -> P.ModelResult:
    """The model-based job for ``sf_dir``, fitted once per session and shared
    by the ALS-backed queries (coverage, predictions, imputed rows, metrics)."""
    key = (_session_key(spark), sf_dir.rstrip("/"))
    if key not in _MODEL_CACHE:
        _MODEL_CACHE[key] = P.model_based(prepared(spark, sf_dir))
    return _MODEL_CACHE[key]


def q_als_coverage(spark, sf_dir):
    """Test pairs (answered or not) the fitted ALS model scores."""
    return _model(spark, sf_dir).factor_predictions.select("user", "item")


def q_als_predict(spark, sf_dir):
    return _model(spark, sf_dir).factor_predictions


def q_model_based_imputed(spark, sf_dir):
    """Answered test pairs the fitted ALS model left unscored, filled by genre mean."""
    return _model(spark, sf_dir).imputed


def q_model_based_predict(spark, sf_dir):
    return _model(spark, sf_dir).predictions


def q_model_based_eval(spark, sf_dir):
    return _r6(_model(spark, sf_dir).metrics, "rmse")


def q_model_based_keys(spark, sf_dir):
    """The model-based job's output rows and their source, with the
    predictions of the imputed ones (those of the factors have no SQL)."""
    filled = F.when(F.col("source") != "als", F.col("prediction"))
    return _model(spark, sf_dir).predictions.select("user", "item", "source", filled.alias("imputed"))


def q_als_dot_check(spark, sf_dir):
    """Per scored test pair: is the prediction its factors' dot product?"""
    m = _model(spark, sf_dir)
    d = dot_differences(m.model, m.factor_predictions)
    return d.select("user", "item", (F.col("difference") <= 1e-4).alias("is_dot_product"))


def q_als_normal_equations(spark, sf_dir):
    """Per training user: do the factors solve the user's ridge equations?"""
    r = user_residuals(_model(spark, sf_dir).model, prepared(spark, sf_dir).train)
    return r.select("user", (F.col("residual") <= 1e-5).alias("solved"))


def q_als_item_half_step(spark, sf_dir):
    """Per training item: do the factors of a further item half-step, given
    the model's user factors, solve the item's ridge equations?"""
    train = prepared(spark, sf_dir).train
    users, _ = factor_tables(_model(spark, sf_dir).model)
    items = fold_in(train, users, "item", "user", ALS_RANK)
    r = residuals(train, items, users, "item", "user", ALS_RANK)
    return r.select("item", (F.col("residual") <= 1e-9).alias("solved"))


def q_als_user_half_step(spark, sf_dir):
    """Per training user: does folding the user in, given the model's item
    factors, give the factors of the model's own last half-step?"""
    users, items = factor_tables(_model(spark, sf_dir).model)
    own = fold_in(prepared(spark, sf_dir).train, items, "user", "item", ALS_RANK).withColumnRenamed("user_factors", "own")
    norm = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)
    apart = F.zip_with("own", "user_factors", lambda x, y: x - y.cast("double"))
    return own.join(users, "user").select("user", (norm(apart) <= 1e-8 * (1 + norm(F.col("own")))).alias("same"))


def q_als_fold_in(spark, sf_dir):
    """Users that come after training (they have held-out ratings only):
    factors from these ratings, checked by residual."""
    p = prepared(spark, sf_dir)
    _, items = factor_tables(_model(spark, sf_dir).model)
    late = p.truth.join(p.train.select("user").distinct(), "user", "left_anti")
    users = fold_in(late, items, "user", "item", ALS_RANK)
    r = residuals(late, users, items, "user", "item", ALS_RANK)
    return r.select("user", (F.col("residual") <= 1e-9).alias("solved"))


def formula_factors(train: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Factor tables of the training users and items from a formula over their
    ids: five multiples of 1/8, whose products are exact."""
    def table(name: str, step: int, mod: int) -> DataFrame:
        f = F.array(*[(F.col(name) * (2 * k + step)) % mod / F.lit(8.0) for k in range(ALS_RANK)])
        return train.select(name).distinct().select(name, f.alias(f"{name}_factors"))

    return table("user", 3, 11), table("item", 5, 13)


def _formula_model(spark, sf_dir) -> P.ModelResult:
    p = prepared(spark, sf_dir)
    return P.model_based(p, factors=formula_factors(p.train))


def q_model_based_formula_predict(spark, sf_dir):
    """The model-based job's output for factors from a formula: scored pairs and imputed rows."""
    return _formula_model(spark, sf_dir).predictions.select("user", "item", "prediction", "source")


def q_model_based_formula_eval(spark, sf_dir):
    return _r6(_formula_model(spark, sf_dir).metrics, "rmse")


# --- files -------------------------------------------------------------------

_CSV_CACHE: dict[tuple, str] = {}


def _csv(spark, sf_dir, name: str) -> str:
    """The path of one input written as CSV, once per session and directory."""
    key = (_session_key(spark), sf_dir.rstrip("/"), name)
    if key not in _CSV_CACHE:
        ensure_checkpoint_dir(spark)
        _CSV_CACHE[key] = getattr(write_csv_inputs(spark, sf_dir, table_path(spark, "csv"), (name,)), name)
    return _CSV_CACHE[key]


def q_csv_ratings(spark, sf_dir):
    """The ratings file read and deduplicated, the last line of a key wins."""
    return dedup_last(read_ratings_csv(spark, _csv(spark, sf_dir, "ratings")).rows)


def q_csv_test_pairs(spark, sf_dir):
    return read_test_csv(spark, _csv(spark, sf_dir, "test")).rows


def q_csv_genres(spark, sf_dir):
    return read_genres_csv(spark, _csv(spark, sf_dir, "genres")).rows


def q_csv_header_parts(spark, sf_dir):
    """Rating lines of a folder whose parts mostly have no header, while it
    comes back within them: lines of each key and the last rating."""
    rows = read_ratings_csv(spark, _csv(spark, sf_dir, "parts")).rows
    return rows.groupBy("user", "item").agg(F.count("*").alias("n_lines"), F.max_by("rating", "seq").alias("rating"))


def q_csv_rejects(spark, sf_dir):
    """Every line of the three files that does not parse: (file, line, reason)."""
    readers = {"ratings": read_ratings_csv, "test": read_test_csv, "genres": read_genres_csv}
    parts = {n: read(spark, _csv(spark, sf_dir, n)) for n, read in readers.items()}
    frames = [p.rejects.select(F.lit(n).alias("file"), "line", "reason") for n, p in parts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "ratings_dedup": q_ratings_dedup,
        "test_pairs": q_test_pairs,
        "train_split": q_train_split,
        "truth_holdout": q_truth_holdout,
        "user_stats": q_user_stats,
        "item_stats": q_item_stats,
        "user_item_lists": q_user_item_lists,
        "item_user_lists": q_item_user_lists,
        "user_genre_mean": q_user_genre_mean,
        "corated_pairs": q_corated_pairs,
        "corated_pair_count": q_corated_pair_count,
        "item_pearson": q_item_pearson,
        "item_pearson_offgrid": q_item_pearson_offgrid,
        "item_sum_normalized": q_item_sum_normalized,
        "user_pearson": q_user_pearson,
        "topk_items": q_topk_items,
        "topk_users": q_topk_users,
        "item_based_predict": q_item_based_predict,
        "item_based_eval": q_item_based_eval,
        "item_based_sum_normalized_predict": q_item_based_sum_normalized_predict,
        "item_based_genre_fallback": q_item_based_genre_fallback,
        "item_based_offgrid_predict": q_item_based_offgrid_predict,
        "score_join_eval": q_score_join_eval,
        "prediction_output": q_prediction_output,
        "prediction_file": q_prediction_file,
        "prediction_single_file": q_prediction_single_file,
        "user_based_predict": q_user_based_predict,
        "user_based_predict_corrected": q_user_based_predict_corrected,
        "user_based_eval": q_user_based_eval,
        "cold_start_cases": q_cold_start_cases,
        "impute_genre": q_impute_genre,
        "impute_item_mean": q_impute_item_mean,
        "als_coverage": q_als_coverage,
        "als_predict": q_als_predict,
        "model_based_imputed": q_model_based_imputed,
        "model_based_predict": q_model_based_predict,
        "model_based_eval": q_model_based_eval,
        "model_based_keys": q_model_based_keys,
        "als_dot_check": q_als_dot_check,
        "als_normal_equations": q_als_normal_equations,
        "als_item_half_step": q_als_item_half_step,
        "als_user_half_step": q_als_user_half_step,
        "als_fold_in": q_als_fold_in,
        "model_based_formula_predict": q_model_based_formula_predict,
        "model_based_formula_eval": q_model_based_formula_eval,
        "csv_ratings": q_csv_ratings,
        "csv_test_pairs": q_csv_test_pairs,
        "csv_genres": q_csv_genres,
        "csv_header_parts": q_csv_header_parts,
        "csv_rejects": q_csv_rejects,
    }
