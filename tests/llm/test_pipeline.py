"""The pipeline and the registered queries."""
import re
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import test_operators as ops

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "labels")


def test_all_queries_are_registered():
    names = {n.split("_")[0] for n in entry.queries()}
    assert {f"op{n}" for n in range(1, 11)} | {"pipeline"} <= names


@pytest.mark.parametrize("name", ["op4_quality_rules", "op10_source_mix"])
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    res = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    key = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    assert sorted(map(key, df.select(*columns).collect())) == sorted(map(key, res.fetchall()))
    assert sorted(df.columns) == sorted(columns)


def test_stages_agree_with_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        before, after = [r.asDict() for r in docs.collect()], [r.asDict() for r in out.collect()]
        if k < 4:
            assert out.columns == columns
        ids = sorted(r["doc_id"] for r in after)
        if k == 0:
            kept = [r["doc_id"] for r in spark.createDataFrame(before, docs.schema).transform(lambda d: corpus_pipeline.quality_rules.judge(d)).where("kept").collect()]
            assert ids == sorted(kept) and 0 < len(ids) < len(before)
        elif k == 1:
            fps = [ops.brute_fingerprint(r["text"]) for r in before]
            assert ids == sorted(set(ops.brute_components([r["doc_id"] for r in before], fps)))
        elif k == 2:
            clean = []
            for r in before:
                n, hit, _ = ops.brute_hits(r["text"], items)
                if not (hit and 20 * hit >= n):
                    clean.append(r["doc_id"])
            assert ids == sorted(clean)
        elif k == 3:
            size = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in rows)
            assert abs(size(after) - size(before)) < 0.35 * size(before)
        else:
            from tokenizers import Tokenizer

            t = Tokenizer.from_file("/opt/tokenizers/word_bpe_49k.json")
            want = sorted((r["doc_id"], zlib.crc32(np.array(t.encode(r["text"], add_special_tokens=False).ids + [1], "<u4").tobytes())) for r in before)
            assert sorted((r["doc_id"], r["ids_crc32"]) for r in after) == want
        docs = out


def test_rest_imports_without_the_package(tmp_path):
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(f"{root}/corate", f"{tmp_path}/corate", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert len(e.queries()) >= 32 and not any(n.startswith('op') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
