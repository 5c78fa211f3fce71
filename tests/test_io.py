"""CSV readers (with rejects) and the prediction sink."""

import glob
import os

from corate.sources.readers import read_genres_csv, read_ratings_csv, read_test_csv
from corate.sources.sinks import write_predictions


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_ratings_csv_drops_trailing_column_and_rejects_bad_rows(spark, scratch):
    p = _write(os.path.join(scratch, "ratings.csv"),
               "userId,movieId,rating,timestamp\n1,10,4.0,964982703\n1,20,x,1\n2,10,3.5,9\n")
    parsed = read_ratings_csv(spark, p)
    rows = sorted((r["user"], r["item"], r["rating"]) for r in parsed.rows.collect())
    assert rows == [(1, 10, 4.0), (2, 10, 3.5)]
    assert parsed.rejects.count() == 1
    assert "seq" in parsed.rows.columns


def test_test_csv_distinct_first_two_columns(spark, scratch):
    p = _write(os.path.join(scratch, "test.csv"), "userId,movieId\n1,10\n1,10\n2,20\n")
    parsed = read_test_csv(spark, p)
    assert sorted(tuple(r) for r in parsed.rows.collect()) == [(1, 10), (2, 20)]


def test_genre_csv_two_and_three_column_forms(spark, scratch):
    p = _write(os.path.join(scratch, "movies.csv"),
               '1,Comedy|Drama\n2,"Heat, The (1995)",Action\n3,Toy Story,Animation\n')
    got = {r["item"]: r["genre"] for r in read_genres_csv(spark, p).rows.collect()}
    assert got == {1: "Comedy|Drama", 2: "Action", 3: "Animation"}


def test_prediction_sink_single_file_sorted_with_header(spark, scratch):
    df = spark.createDataFrame(
        [(10, 2, 3.5), (2, 30, 1.0), (2, 4, 2.0), (10, 1, 4.25)],
        "user BIGINT, item BIGINT, prediction DOUBLE",
    )
    out = os.path.join(scratch, "pred")
    write_predictions(df, out, single_file=True)
    files = glob.glob(os.path.join(out, "part-*.csv"))
    assert len(files) == 1
    lines = open(files[0]).read().strip().splitlines()
    assert lines[0] == "UserId,MovieId,Pred_rating"
    assert lines[1:] == ["2,4,2.0", "2,30,1.0", "10,1,4.25", "10,2,3.5"]


def test_ratings_csv_last_line_wins_across_files(spark, scratch):
    from corate.operators.split import dedup_last

    d = os.path.join(scratch, "multi")
    os.makedirs(d)
    _write(os.path.join(d, "a.csv"), "u,i,r,t\n1,1,1.0,0\n1,1,2.0,0\n")
    _write(os.path.join(d, "b.csv"), "u,i,r,t\n1,1,4.5,0\n2,2,3.0,0\n")
    got = {(r["user"], r["item"]): r["rating"] for r in dedup_last(read_ratings_csv(spark, d).rows).collect()}
    assert got == {(1, 1): 4.5, (2, 2): 3.0}


def test_header_is_matched_by_content_not_by_position(spark, scratch):
    """Parts without a header keep their first line; a header within a part goes."""
    d = os.path.join(scratch, "parts dir")
    os.makedirs(d)
    _write(os.path.join(d, "0.csv"), "\n")
    _write(os.path.join(d, "a.csv"), "userId,movieId,rating,timestamp\n1,10,4.0,1\n")
    _write(os.path.join(d, "b.csv"), "5,6,2.0,1\nuserId,movieId,rating,time\n5,7,1.0,1\n")
    parsed = read_ratings_csv(spark, d)
    assert sorted((r.user, r.item, r.rating) for r in parsed.rows.collect()) == [(1, 10, 4.0), (5, 6, 2.0), (5, 7, 1.0)]
    assert parsed.rejects.count() == 0


def test_folder_without_any_header(spark, scratch):
    d = os.path.join(scratch, "bare")
    os.makedirs(d)
    _write(os.path.join(d, "a.csv"), "1,10,4.0,1\n1,10,4.0,2\n")
    _write(os.path.join(d, "b.csv"), "2,10,3.0,1\n")
    assert read_ratings_csv(spark, d).rows.count() == 3
    assert read_ratings_csv(spark, d, header="1,10,4.0,1").rows.count() == 1  # the first line named as header
    assert read_test_csv(spark, d).rows.count() == 2


def test_malformed_lines_are_rejects_with_their_place(spark, scratch):
    p = _write(os.path.join(scratch, "ragged.csv"),
               'u,i,r,t\n1,2,3.0,9,extra,more\n7,8,2.5\n\n"9,1,2.0,3\nx,1,2.0,3\n5,8,,1\n"5","9",1.5,"a,b"\n')
    parsed = read_ratings_csv(spark, p)
    assert [(r.user, r.item, r.rating) for r in parsed.rows.collect()] == [(5, 9, 1.5)]
    got = {(r.line_no, r.reason, r.line) for r in parsed.rejects.collect()}
    assert got == {(2, "fields", "1,2,3.0,9,extra,more"), (3, "fields", "7,8,2.5"), (5, "quote", '"9,1,2.0,3'),
                   (6, "type", "x,1,2.0,3"), (7, "type", "5,8,,1")}
    assert all(r.file.endswith("ragged.csv") for r in parsed.rejects.collect())


def test_line_numbers_over_file_splits(spark, scratch):
    p = _write(os.path.join(scratch, "split.csv"), "u,i,r,t\n" + "".join(f"{n},1,{'x' if n % 50 == 7 else '2.5'},0\n" for n in range(1000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        parsed = read_ratings_csv(spark, p)
        assert parsed.rows.rdd.getNumPartitions() > 5
        assert {r.line_no for r in parsed.rejects.collect()} == {n + 2 for n in range(1000) if n % 50 == 7}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_test_file_rejects(spark, scratch):
    p = _write(os.path.join(scratch, "t.csv"), "u,i,x\n1,2,a\n1,2\n1,y,b\n")
    parsed = read_test_csv(spark, p)
    assert [tuple(r) for r in parsed.rows.collect()] == [(1, 2)]
    assert {(r.line, r.reason) for r in parsed.rejects.collect()} == {("1,2", "fields"), ("1,y,b", "type")}


def test_last_genre_of_an_item_wins(spark, scratch):
    from corate.plans.pipelines import dedup_genres

    p = _write(os.path.join(scratch, "genres.csv"), '1,Drama\n2,"A, b",Western\n1,"T, the",Comedy\n2,Action\n3,"Open, Drama\n4\n5,a,b,c\n6,t,\n7,a,,b\n')
    parsed = read_genres_csv(spark, p)
    assert {r.item: r.genre for r in parsed.rows.collect()} == {1: "Comedy", 2: "Action"}
    assert {(r.line_no, r.reason) for r in parsed.rejects.collect()} == {(5, "quote"), (6, "fields"), (7, "fields"), (8, "type"), (9, "fields")}
    events = spark.createDataFrame([(1, "Western", 2), (1, "Action", 3)], "item BIGINT, genre STRING, seq INT")
    assert dedup_genres(events).first().genre == "Action"
    assert dedup_genres(events.drop("seq")).first().genre == "Western"


def test_empty_files(spark, scratch):
    p = _write(os.path.join(scratch, "empty.csv"), "")
    for read in (read_ratings_csv, read_test_csv, read_genres_csv):
        assert read(spark, p).rows.count() == 0 and read(spark, p).rejects.count() == 0


def test_single_file_is_joined_from_ordered_parts(spark, scratch):
    """The bytes of one sorted file, whatever the number of parts; no other file is left."""
    rows = [(u, i, round((u * 7 + i) % 45 / 9, 4)) for u in range(200) for i in range(0, 60, 1 + u % 7)]
    df = spark.createDataFrame(rows, "user BIGINT, item BIGINT, prediction DOUBLE").repartition(5)
    want = "UserId,MovieId,Pred_rating\n" + "".join(f"{u},{i},{p}\n" for u, i, p in sorted(rows))
    for adaptive in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        try:
            out = os.path.join(scratch, f"one-{adaptive}")
            write_predictions(df, out, single_file=True)
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        assert sorted(f for f in os.listdir(out) if not f.startswith(".")) == ["_SUCCESS", "part-00000.csv"]
        assert open(os.path.join(out, "part-00000.csv")).read() == want


def test_single_file_of_nothing_has_the_header(spark, scratch):
    out = os.path.join(scratch, "none")
    write_predictions(spark.createDataFrame([], "user BIGINT, item BIGINT, prediction DOUBLE"), out, single_file=True)
    assert open(os.path.join(out, "part-00000.csv")).read() == "UserId,MovieId,Pred_rating\n"
