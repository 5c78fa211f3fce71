"""corate: collaborative-filtering rating prediction as Spark DataFrame jobs.

Layout
------
sources/    readers for ratings / test pairs / genres, the prediction sink,
            and the mapping of the benchmark tables onto those inputs
functions/  column expressions (guarded ratios, Pearson from moments, bands)
operators/  split, statistics, similarity, neighbours, prediction,
            imputation, ALS, evaluation, skew handling
plans/      end-to-end recommenders and the registered queries
streaming/  micro-batch scoring of arriving test pairs
"""

__version__ = "0.1.0"
