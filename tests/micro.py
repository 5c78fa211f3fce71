"""The hand-worked micro fixture (FIXTURES.md section 3)."""

RATINGS = [
    (1, 10, 4.0), (1, 20, 3.0), (1, 30, 5.0),
    (2, 10, 5.0), (2, 20, 3.0), (2, 30, 4.0),
    (3, 10, 2.0), (3, 20, 4.0), (3, 30, 3.0),
    (4, 20, 2.0), (4, 30, 4.5),
]
GENRES = [(10, "Comedy"), (20, "Drama"), (30, "Comedy|Drama"), (40, "Comedy"), (50, "Comedy|Drama")]
TEST = [(3, 30), (3, 40), (3, 50)]


def frames(spark):
    r = spark.createDataFrame(RATINGS, "user BIGINT, item BIGINT, rating DOUBLE")
    g = spark.createDataFrame(GENRES, "item BIGINT, genre STRING")
    t = spark.createDataFrame(TEST, "user BIGINT, item BIGINT")
    return r, g, t


def prepared(spark):
    from corate.plans import pipelines as P

    r, g, t = frames(spark)
    return P.prepare(r, t, g, order_col=None, materialize_how="none")
