"""The command line on small CSV files (the reference's file formats)."""

import glob
import os

from tests import micro


def _files(d):
    r = os.path.join(d, "ratings.csv")
    with open(r, "w") as f:
        f.write("userId,movieId,rating,timestamp\n")
        for u, i, x in micro.RATINGS:
            f.write(f"{u},{i},{x},0\n")
    t = os.path.join(d, "test.csv")
    with open(t, "w") as f:
        f.write("userId,movieId\n")
        for u, i in micro.TEST:
            f.write(f"{u},{i}\n")
    g = os.path.join(d, "movies.csv")
    with open(g, "w") as f:
        for i, genre in micro.GENRES:
            f.write(f'{i},"Title {i}, The",{genre}\n')
    return r, t, g


def test_item_based_cli(spark, scratch, capsys):
    from corate.cli import main

    r, t, _ = _files(scratch)
    out = os.path.join(scratch, "out")
    assert main(["item-based", r, t, out, "--single-file"]) == 0
    text = capsys.readouterr().out
    assert ">=4: 1" in text and "RMSE = 5.0" in text
    lines = open(glob.glob(f"{out}/predictions/part-*.csv")[0]).read().split()
    assert lines == ["UserId,MovieId,Pred_rating", "3,30,-2.0"]


def test_model_based_cli(spark, scratch, capsys):
    from corate.cli import main

    r, t, g = _files(scratch)
    out = os.path.join(scratch, "out")
    assert main(["model-based", r, g, t, out]) == 0
    assert "RMSE = " in capsys.readouterr().out


def test_rejected_rows_are_written_and_counted(spark, scratch, capsys):
    from corate.cli import main

    r, t, _ = _files(scratch)
    with open(r, "a") as f:
        f.write("x,1,2.0,0\n5,y,1.0,0\n")
    out = os.path.join(scratch, "out")
    assert main(["item-based", r, t, out]) == 0
    text = capsys.readouterr().out
    assert "rejected rows of ratings: 2" in text and "rejected rows of test: 0" in text
    assert spark.read.json(f"{out}/rejects/ratings").count() == 2
    assert main(["item-based", r, t, os.path.join(scratch, "out2"), "--on-bad-row", "fail"]) == 2
