"""The four end-to-end jobs.

* ``item_based``   -- item-item neighbourhood CF (Pearson or sum-normalised,
  k neighbours, user-mean or genre fallback)
* ``user_based``   -- user-user neighbourhood CF (k neighbours, leave-one-out
  neighbour means)
* ``model_based``  -- ALS factors, cold pairs filled from genre / item / user means
* ``item_pairs``   -- the similarity of every co-rated item pair

Each takes a ``Prepared`` (deduped ratings split into train / truth) and
returns lazy DataFrames, except that ALS fitting is eager by nature.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from corate.constants import (
    ALS_ITERATIONS,
    ALS_LAMBDA,
    ALS_RANK,
    ITEM_NEIGHBOURS,
    USER_NEIGHBOURS,
)
from corate.functions.exact import top_bit
from corate.operators import als as als_ops
from corate.operators import asked_pairs, pair_filter
from corate.operators.evaluate import evaluate, score
from corate.operators.exact_pairs import exact_pearson
from corate.operators.impute import impute
from corate.operators.neighbors import (
    attach_similarity,
    item_candidates,
    item_needed,
    top_k,
    user_candidates,
    user_needed,
)
from corate.operators.predict import item_based_prediction, user_based_prediction
from corate.operators.similarity import ITEM_METRICS, Pairs, centred_ratings, item_similarity, user_similarity
from corate.operators.sizing import broadcast_if_small
from corate.operators.skew import DEFAULT_HOT_ROWS, HOT_PAIRS, dealt_pairs
from corate.operators.split import dedup_last, flag_holdout, holdout_split
from corate.operators.stats import user_genre_stats, user_stats
from corate.session import checkpoint_dir, delete_files, drop_layout, materialize, open_layout, write_layout, write_table
from corate.sources.readers import dedup_genres


class Prepared(NamedTuple):
    train: DataFrame
    truth: DataFrame
    test: DataFrame
    ustats: DataFrame
    gmean: Column
    genres: DataFrame | None
    by_user: bool = False   # train/truth are laid out by user
    n_train: int = 0
    max_user_rows: int = -1  # largest per-user training count (-1: unknown)
    layouts: dict | None = None  # further layouts of the training set
    tables: list | None = None  # the files under the layouts, folders of results
    exact_top: int | None = None  # for ratings off the grid: see ``TrainSummary``
    pair_rows: int = -1  # rows of the item co-rating self-join (-1: unknown)
    max_user_product: int = -1  # bound of truth rows x training rows of a user (-1: unknown)

    def close(self) -> None:
        """Release everything cached or laid out for these inputs."""
        spark = self.train.sparkSession
        for df in (self.train, self.truth, (self.layouts or {}).get("item")):
            if df is not None:
                df.unpersist()
        for table in self.tables or []:
            (delete_files if isinstance(table, str) else drop_layout)(spark, table)
        for held in (self.layouts, self.tables):
            if held:
                held.clear()


def co_partition(df: DataFrame, key: str = "user", n: int | None = None, tables: list | None = None) -> DataFrame:
    """``df`` laid out by ``key`` in n (default: the session's shuffle
    partitions) hash partitions. Frames laid out this way with the same n are
    co-partitioned: joins and aggregations on ``key`` between them need no
    exchange. With a list ``tables`` they are bucketed tables in the shared
    checkpoint folder, noted there; else cached, and lost blocks are rebuilt
    from the frame's lineage."""
    from pyspark import StorageLevel

    n = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if tables is None:
        return df.repartition(n, key).persist(StorageLevel.MEMORY_AND_DISK)
    tables.append(write_layout(df, key, n, f"by-{key}"))
    return open_layout(df.sparkSession, tables[-1])


LAYOUT_ROWS_PER_PARTITION = 500_000


class TrainSummary(NamedTuple):
    rows: int
    rating_sum: float | None
    max_user_rows: int
    exact_top: int | None   # |rating| < 2^exact_top if ratings are off the grid, else None
    pair_rows: int          # rows of the item co-rating self-join


#: Ratings that are multiples of 1/GRID have products whose sums are exact as
#: doubles, up to 2^53 / GRID^2 of them at rating 1.
GRID = 256


def train_summary(train: DataFrame) -> TrainSummary:
    """Row count, rating sum, the largest per-user row count and whether the
    ratings are on a grid, in one job (a per-user partial aggregate, then one
    row to the driver)."""
    scaled = F.col("rating") * GRID
    r = (
        train.groupBy("user")
        .agg(F.count("*").alias("n"), F.sum("rating").alias("s"), F.max(F.abs("rating")).alias("m"),
             F.bool_and(scaled == F.floor(scaled)).alias("grid"))
        .agg(F.sum("n").alias("rows"), F.sum("s").alias("total"), F.max("n").alias("top"),
             F.max("m").alias("largest"), F.bool_and("grid").alias("grid"),
             F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2).alias("pairs"))
        .first()
    )
    top = None if r["grid"] in (True, None) else top_bit(r["largest"])
    return TrainSummary(int(r["rows"] or 0), r["total"], int(r["top"] or 0), top, int(r["pairs"] or 0))


def layout_partitions(
    spark, rows: int, rows_per_partition: int = LAYOUT_ROWS_PER_PARTITION
) -> int:
    """Partition count of a layout: about ``rows_per_partition`` training rows
    each, at least the default parallelism (AQE can neither coalesce nor split
    a layout, so it is sized up front)."""
    return max(1, spark.sparkContext.defaultParallelism, -(-rows // rows_per_partition))


def prepare(
    ratings: DataFrame,
    test: DataFrame,
    genres: DataFrame | None = None,
    order_col: str | None = "seq",
    materialize_how: str | None = "auto",
    by_user: bool | None = None,
    hot_rows: int | None = LAYOUT_ROWS_PER_PARTITION,
) -> Prepared:
    """Dedup (last event wins, when ``order_col`` is present), split, and
    write (or cache) the frames that every later stage reads.

    ``by_user``: lay train and truth out by user (one shuffle each), so the
    item co-rating self-join, the candidate join (truth with train on user)
    and the per-user statistics read them without a further exchange; users
    with many pairs leave these joins for salted ones. A user's rows then sit
    in one partition, so with ``None`` (default) the layout is used only when
    no user has more than ``hot_rows`` training ratings; otherwise every join
    keeps its shuffle, where AQE's skew splitting spreads hot users."""
    if order_col and order_col in ratings.columns:
        ratings = dedup_last(ratings, order_col)
    else:
        ratings = ratings.select("user", "item", "rating")
    # a repeated test pair must not repeat its truth row; one genre per item
    test = test.select("user", "item").distinct()
    if genres is not None:
        genres = dedup_genres(genres)
    how = materialize_how
    if how == "auto":
        how = "table" if checkpoint_dir(ratings.sparkSession) else "persist"
    if how == "table":
        # one pass: dedup + flag join, written once, split by partition pruning
        t = write_table(flag_holdout(ratings, test), "split", partition_by=["held_out"])
        train = t.filter(~F.col("held_out")).drop("held_out")
        truth = t.filter(F.col("held_out")).drop("held_out")
        keys = test.select("user", "item")
    else:
        sp = holdout_split(ratings, test)
        train = materialize(sp.train, how)
        truth = materialize(sp.truth, how)
        keys = sp.test
    summ = train_summary(train)
    # mean training rating; sum/count in double, as Spark's avg computes it
    gmean = F.lit(summ.rating_sum / summ.rows if summ.rows else None).cast("double")
    if by_user is None:
        by_user = hot_rows is not None and summ.max_user_rows <= hot_rows
    tables: list | None = [] if how == "table" else None
    if by_user and how not in (None, "none"):
        n = layout_partitions(train.sparkSession, summ.rows)
        plain = (train, truth)
        train = co_partition(train, "user", n, tables)
        truth = co_partition(truth, "user", n, tables)
        if how == "persist":
            # built here, so that no later step pays for the layout; then drop the plain caches under them
            train.count()
            truth.count()
            for df in plain:
                df.unpersist()
    ustats = user_stats(train)
    laid_out = bool(by_user) and how not in (None, "none")
    return Prepared(
        train, truth, keys, ustats, gmean, genres, laid_out, summ.rows, summ.max_user_rows, {}, tables, summ.exact_top,
        summ.pair_rows, summ.max_user_rows * _max_group_rows(truth, "user"),
    )


ANCHOR_SHARE = 0.25


def _no_hot_user(prep: Prepared, hot_rows: int | None) -> bool:
    """Whether the split's summary already shows no user above ``hot_rows``."""
    return hot_rows is not None and 0 <= prep.max_user_rows <= hot_rows


def _centred_layout(prep: Prepared, hot_rows: int | None) -> tuple[DataFrame, bool]:
    """(centred ratings, no item above ``hot_rows``). The centred ratings are
    laid out by item (once per ``Prepared``, released by its ``close``) when
    the user layout is in use and an item's raters fit a partition, so that
    the user self-join on item and the candidate join on item need no exchange."""
    layouts = {} if prep.layouts is None else prep.layouts
    ct = layouts.get("item")
    if ct is None:
        ct = centred_ratings(prep.train, prep.ustats)
        if not prep.by_user or hot_rows is None:
            return ct, False
        facts = layouts.get("item facts")
        if facts is None:
            facts = layouts["item facts"] = _item_facts(prep)
        if facts.max_rows <= LAYOUT_ROWS_PER_PARTITION:
            ct = layouts["item"] = co_partition(ct, "item", layout_partitions(ct.sparkSession, prep.n_train), prep.tables)
    return ct, hot_rows is not None and layouts["item facts"].max_rows <= hot_rows


class ItemFacts(NamedTuple):
    max_rows: int      # training rows of an item
    pair_rows: int     # rows of the user co-rating self-join
    max_product: int   # bound of truth rows x training rows of an item
    max_truth: int     # truth rows of an item


def _item_facts(prep: Prepared) -> ItemFacts:
    n = prep.train.groupBy("item").agg(F.count("*").alias("n"))
    r = n.agg(F.max("n").alias("top"), F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2).alias("pairs")).first()
    top = int(r["top"] or 0)
    most = _max_group_rows(prep.truth, "item")
    return ItemFacts(top, int(r["pairs"] or 0), top * most, most)


def _most_pairs(prep: Prepared, needed: bool = False) -> int | None:
    """Bound of the co-rating rows of one item, or of one user, and of the
    candidate pairs of the truth that it is in, if ``needed``."""
    if prep.max_user_rows < 0 or prep.layouts is None or needed and prep.max_user_product < 0:
        return None
    facts = prep.layouts.get("item facts")
    if facts is None:
        facts = prep.layouts["item facts"] = _item_facts(prep)
    asked = 0
    if needed and prep.max_user_rows:
        asked = prep.max_user_product // prep.max_user_rows * facts.max_rows + prep.max_user_rows * facts.max_truth
    return prep.max_user_rows * facts.max_rows + asked


def centred_layout(prep: Prepared, hot_rows: int | None = DEFAULT_HOT_ROWS) -> DataFrame:
    """The centred ratings the user similarities are built from."""
    return _centred_layout(prep, hot_rows)[0]


def _max_group_rows(df: DataFrame, key: str) -> int:
    """Largest number of rows sharing one ``key`` value (one partial aggregate)."""
    r = df.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n").alias("m")).first()
    return int(r["m"] or 0)


def selective_anchors(
    pairs: DataFrame, train: DataFrame, col: str, restrict: bool | None
) -> DataFrame | None:
    """The distinct ``col`` values of the pairs to score, when restricting the
    similarity table to pairs that touch them is worth it.

    ``restrict=None`` decides by two approximate distinct counts (one-pass
    HyperLogLog aggregates, no shuffle of the values): restrict when the pairs
    touch at most ``ANCHOR_SHARE`` of the training ``col`` values (a small
    scoring set against a large catalogue); otherwise every co-rated pair is
    needed anyway and the plain self-join is cheaper.
    """
    if restrict is False:
        return None
    if restrict is None:
        n_anchor = pairs.agg(F.approx_count_distinct(col).alias("n")).first()["n"]
        n_all = train.agg(F.approx_count_distinct(col).alias("n")).first()["n"]
        if n_anchor > ANCHOR_SHARE * n_all:
            return None
    return pairs.select(col).distinct()


#: Co-rating rows from which dropping those of other pairs pays for making the candidates twice.
FILTER_ROWS = 100_000_000
#: Bits a pair below which the filter passes too many other pairs to be worth its broadcast.
USEFUL_BITS = 6


def needed_pairs(
    cand: DataFrame, self_col: str, restrict: bool | None = True, pair_rows: int = -1
) -> Callable[[DataFrame], DataFrame] | None:
    """What drops co-rating rows of pairs that are no candidates (``self_col``,
    nbr), before they are aggregated; None if ``restrict`` is False, or None
    and there are few such rows, or if the bit filter would be too large to be
    of use (see ``operators.pair_filter``). Results do not depend on it."""
    if restrict is False or restrict is None and 0 <= pair_rows < FILTER_ROWS:
        return None
    found = pair_filter.build(cand, self_col, "nbr", least_bits=USEFUL_BITS)
    return None if found is None else (lambda rows: pair_filter.probe(rows, found, "m1", "m2"))


def user_pair_rows(prep: Prepared) -> int:
    """Rows of the user co-rating self-join, -1 if they were not counted."""
    facts = (prep.layouts or {}).get("item facts")
    return -1 if facts is None else facts.pair_rows


def needed_user_pairs(prep: Prepared) -> DataFrame:
    """The user pairs the user-based job looks up for the truth, as lists."""
    facts = (prep.layouts or {}).get("item facts")
    small = facts is not None and facts.max_product <= HOT_PAIRS
    return user_needed(prep.truth, centred_layout(prep), None if small else HOT_PAIRS)


def needed_item_pairs(prep: Prepared) -> DataFrame:
    """The item pairs the item-based job looks up for the truth, as lists."""
    small = 0 <= prep.max_user_product <= HOT_PAIRS
    return item_needed(prep.truth, prep.train, None if small else HOT_PAIRS)


#: Co-rating rows from which similarities are made in passes (``operators.asked_pairs``), each of which
#: frees its disk: below, one plan with fewer jobs is faster.
PASSES_FROM = 100_000_000


def takes_passes(prep: Prepared, group: str, candidates: bool = True) -> bool:
    """Whether the pairs of members of a ``group`` are taken in passes: there
    are many, their ids are whole numbers, there is a folder for the results
    and, if ``candidates`` are ranked, no group has more than a task can make."""
    facts = (prep.layouts or {}).get("item facts")
    if group == "user":
        rows, product = prep.pair_rows, prep.max_user_product
    else:
        rows, product = (-1, -1) if facts is None else (facts.pair_rows, facts.max_product)
    if rows < PASSES_FROM or candidates and not 0 <= product <= HOT_PAIRS:
        return False
    ids = all(isinstance(prep.train.schema[c].dataType, LongType) for c in ("user", "item"))
    return ids and prep.tables is not None and checkpoint_dir(prep.train.sparkSession) is not None


def ranked_items(prep: Prepared, k: int | None, metric: str = "pearson", hot_rows: int | None = DEFAULT_HOT_ROWS) -> DataFrame:
    """The ``k`` most similar rated items of each test pair of the truth (``top_k``), in passes."""
    if metric not in ITEM_METRICS:
        raise ValueError(f"metric must be one of {ITEM_METRICS}")
    if metric == "sum_normalized":
        score, least = asked_pairs.sum_normalized_score(), 1
    elif prep.exact_top is not None:
        score, least = asked_pairs.exact_score(prep.exact_top), 2
    else:
        shift = F.coalesce(F.round(prep.gmean), F.lit(0.0))
        score, least = asked_pairs.pearson_score(prep.train.sparkSession.range(1).select(shift).first()[0]), 2
    found = asked_pairs.asked_similarities(prep.train, prep.truth, "user", "item", "rating", score, least, _most_pairs(prep, True), hot_rows, prep.tables)
    return asked_pairs.ranked(prep.truth, prep.train, found, "user", "item", {"rating": "nbr_rating"}, k)


def ranked_users(prep: Prepared, k: int, hot_rows: int | None = DEFAULT_HOT_ROWS) -> DataFrame:
    """The ``k`` most similar raters of the item of each test pair of the truth, in passes."""
    ct = centred_layout(prep, hot_rows)
    found = asked_pairs.asked_similarities(ct, prep.truth, "item", "user", "dev", asked_pairs.centred_score(), 1, _most_pairs(prep, True), hot_rows, prep.tables)
    fields = {"rating": "nbr_rating", "n_ratings": "nbr_n", "sum_rating": "nbr_sum"}
    return asked_pairs.ranked(prep.truth, ct, found, "item", "user", fields, k)


class Result(NamedTuple):
    predictions: DataFrame   # user, item, rating, prediction, source, ...
    metrics: DataFrame       # one row: bands, n_scored, rmse


def item_based(
    prep: Prepared,
    k: int | None = ITEM_NEIGHBOURS,
    metric: str = "pearson",
    fallback: str = "user_mean",
    hot_rows: int | None = DEFAULT_HOT_ROWS,
    clamp: tuple[float, float] | None = None,
    sims: DataFrame | None = None,
    pairs: DataFrame | None = None,
    restrict: bool | None = None,
) -> Result:
    """Item-item CF: for each answered test pair, rank the items the user
    rated by similarity to the test item (signed, descending, ties by item
    id), keep k (None: all), and predict sum(r*sim)/sum(|sim|).

    fallback ``user_mean`` (the reference) or ``genre`` (the user's mean on
    the same genre first, then the user mean). ``sims`` reuses a similarity
    table; ``pairs`` scores other (user, item[, rating]) pairs than the truth;
    ``restrict`` limits the similarity table to the pairs looked up (False:
    every pair; None: anchors by their share, see ``selective_anchors``, else
    passes over the truth's pairs where there are many, see ``takes_passes``,
    else the bit filter of ``needed_pairs``).
    """
    truth = prep.truth if pairs is None else pairs
    small = pairs is None and 0 <= prep.max_user_product <= HOT_PAIRS
    anchors = selective_anchors(truth, prep.train, "item", restrict) if sims is None else None
    if sims is None and anchors is None and pairs is None and restrict is None and takes_passes(prep, "user"):
        top = ranked_items(prep, k, metric, hot_rows)
    else:
        cand = item_candidates(truth, prep.train, None if small else HOT_PAIRS)
        if sims is None:
            sims = item_pairs(prep, metric, hot_rows, anchors, needed_pairs(cand, "item", restrict, prep.pair_rows))
        top = top_k(attach_similarity(cand, sims, "item", "item1", "item2"), k)
    fallbacks: list[tuple[str, str]] = []
    if fallback == "genre":
        if prep.genres is None:
            raise ValueError("genre fallback needs genres")
        ug = user_genre_stats(prep.train, prep.genres).select(
            "user", "genre", F.col("mean_rating").alias("genre_mean")
        )
        truth = truth.join(broadcast_if_small(prep.genres.select("item", "genre")), "item", "left").join(
            ug, ["user", "genre"], "left"
        )
        fallbacks = [("genre_mean", "genre_mean")]
    elif fallback != "user_mean":
        raise ValueError("fallback must be 'user_mean' or 'genre'")
    pred = item_based_prediction(truth, top, prep.ustats, prep.gmean, fallbacks, clamp)
    return Result(pred, evaluate(pred))


def user_based(
    prep: Prepared,
    k: int | None = USER_NEIGHBOURS,
    loo: str = "literal",
    hot_rows: int | None = DEFAULT_HOT_ROWS,
    clamp: tuple[float, float] | None = None,
    sims: DataFrame | None = None,
    pairs: DataFrame | None = None,
    restrict: bool | None = None,
) -> Result:
    """User-user CF: for each answered test pair, rank the users who rated the
    item by their Pearson similarity to the user, keep k, and predict
    mean(u) + sum(dev*sim)/sum(|sim|), dev = rating minus the neighbour's
    leave-one-out mean. The reference runs it with k = 1. ``sims`` reuses a
    similarity table; ``pairs`` scores other pairs than the truth;
    ``restrict`` limits the similarity table as in ``item_based``."""
    truth = prep.truth if pairs is None else pairs
    ct, _ = _centred_layout(prep, hot_rows)
    facts = (prep.layouts or {}).get("item facts")
    small = pairs is None and facts is not None and facts.max_product <= HOT_PAIRS
    anchors = selective_anchors(truth, prep.train, "user", restrict) if sims is None else None
    if sims is None and anchors is None and pairs is None and restrict is None and k is not None and takes_passes(prep, "item"):
        top = ranked_users(prep, k, hot_rows)
    else:
        cand = user_candidates(truth, ct, None if small else HOT_PAIRS)
        if sims is None:
            keep = needed_pairs(cand, "user", restrict, user_pair_rows(prep))
            # two users who share an item nearly always have a similarity, which the lookup would be sent
            asked = user_needed(truth, ct, None if small else HOT_PAIRS) if anchors is None and keep is None and restrict is not False else None
            sims, _ = user_pairs(prep, hot_rows, anchors, keep, asked, asked is not None and pairs is None)
        top = top_k(attach_similarity(cand, sims, "user", "user1", "user2"), k)
    pred = user_based_prediction(truth, top, prep.ustats, prep.gmean, loo, clamp)
    return Result(pred, evaluate(pred))


@dataclass
class ModelResult:
    model: als_ops.FactorModel | None
    factor_predictions: DataFrame   # user, item, prediction: every scorable test pair
    imputed: DataFrame              # user, item, rating, prediction, source
    truth: DataFrame

    @cached_property
    def predictions(self) -> DataFrame:
        """user, item, prediction, source: the output file, made when first asked for."""
        out = self.factor_predictions.withColumn("source", F.lit("als")).unionByName(
            self.imputed.select("user", "item", "prediction", "source")
        )
        # Read twice (output file and metrics). Materializing it also keeps the
        # union out of the metrics plan, where Spark 4.1's constraint inference
        # fails on union -> join -> aggregate.
        return materialize(out, "auto", "model-pred")

    @property
    def metrics(self) -> DataFrame:
        return evaluate(score(self.truth, self.predictions))


def model_based(
    prep: Prepared,
    rank: int = ALS_RANK,
    max_iter: int = ALS_ITERATIONS,
    reg_param: float = ALS_LAMBDA,
    seed: int = 42,
    impute_how: str = "genre",
    impute_unanswered: bool = False,
    num_blocks: int | None = None,
    factors: tuple[DataFrame, DataFrame] | None = None,
) -> ModelResult:
    """ALS on the training ratings, scored on all test pairs; the answered
    test pairs it cannot score are filled by ``impute_how`` (``genre``: the
    user's same-genre mean, then the user mean; ``item_mean``: the item mean,
    then the user mean). ``impute_unanswered`` also fills unscorable test
    pairs that have no held-out rating. ``factors`` (user and item tables, see
    ``als.score_pairs``) take the place of a fit."""
    if factors is None:
        fm = als_ops.fit_als(prep.train, rank, max_iter, reg_param, seed, num_blocks, n_rows=prep.n_train or None)
        fp = als_ops.als_predict(fm, prep.test)
    else:
        fm, fp = None, als_ops.score_pairs(*factors, prep.test)
    fp = materialize(fp, "auto", "als")
    if impute_unanswered:
        cases = prep.test.join(fp, ["user", "item"], "left_anti")
        cases = cases.join(prep.truth, ["user", "item"], "left")
    else:
        cases = prep.truth.join(fp, ["user", "item"], "left_anti")
    imp = impute(cases, prep.train, prep.genres, prep.gmean, impute_how, prep.ustats)
    return ModelResult(fm, fp, imp, prep.truth)


def item_pairs(
    prep: Prepared,
    metric: str = "pearson",
    hot_rows: int | None = DEFAULT_HOT_ROWS,
    anchors: DataFrame | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
    needed: DataFrame | None = None,
    of_truth: bool = False,
) -> DataFrame:
    """Every co-rated item pair of the training set (touching ``anchors``, and
    left by ``keep``, when given) with its similarity; or the pairs ``needed``
    (m1, m2s), whether co-rated or not (``of_truth``: they are those of the
    truth, whose number per item is bounded, so that they need no count).
    Many pairs of ratings off the grid are made in passes, at once."""
    if metric == "pearson" and prep.exact_top is not None and anchors is None and keep is None and needed is None and takes_passes(prep, "user", False):
        return _exact_item_pairs(prep, hot_rows)
    known = Pairs()
    if anchors is None and keep is None:
        known = Pairs(prep.pair_rows, _most_pairs(prep, of_truth) if needed is None or of_truth else None)
    return item_similarity(prep.train, metric, hot_rows, anchors=anchors, no_hot=_no_hot_user(prep, hot_rows),
                           shift=prep.gmean, keep=keep, exact_top=prep.exact_top, known=known, needed=needed)


def _exact_item_pairs(prep: Prepared, hot_rows: int | None) -> DataFrame:
    """Every co-rated item pair with its correlation from exact sums, in passes over the first items."""
    spark, scratch = prep.train.sparkSession, []
    lists = asked_pairs.member_lists(prep.train, "user", "item", ["rating"], hot_rows, scratch)

    def work(later: DataFrame, pairs: int) -> DataFrame:
        rows = later.select("m1", F.col("rating1").alias("v1"), "m2s", F.col("rating2s").alias("v2s"))
        m = exact_pearson(dealt_pairs(rows, pairs, _most_pairs(prep), in_order=True)[0], prep.exact_top)
        return m.withColumnsRenamed({"m1": "item1", "m2": "item2"})

    try:
        return asked_pairs.in_passes(lists, work, "pairs", prep.tables)
    finally:
        for path in scratch:
            delete_files(spark, path)


def user_pairs(
    prep: Prepared, hot_rows: int | None = DEFAULT_HOT_ROWS, anchors: DataFrame | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
    needed: DataFrame | None = None,
    of_truth: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(similarity of every co-rating user pair, the centred ratings it is built
    from); ``needed`` and ``of_truth`` as in ``item_pairs``."""
    ct, no_hot_item = _centred_layout(prep, hot_rows)
    facts = (prep.layouts or {}).get("item facts")
    known = Pairs()
    if facts is not None:
        known = Pairs(facts.pair_rows, _most_pairs(prep, of_truth) if needed is None or of_truth else None)
    sims = user_similarity(prep.train, prep.ustats, hot_rows, anchors=anchors, centred=ct,
                           no_hot=no_hot_item, keep=keep, known=known, needed=needed)
    return sims, ct
