"""Connected components, hashing and the entry point with and without the subpackage."""

import random
import shutil
import subprocess
import sys
import zlib
from pathlib import Path

from pyspark.sql import functions as F

from pitchside.llm.common import components, held_out, unit_hash

REPO = Path(__file__).resolve().parents[2]


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 300)] + [(500, i) for i in range(501, 900)]  # a path and a star
    edges += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)] + [(7, 7), (8, 9), (9, 8)]
    root = {i: i for i in range(1500)}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    v = spark.range(1500)
    got = {r["id"]: r["component"] for r in components(v, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in range(1500)}
    assert components(v.limit(3), spark.createDataFrame([], "a long, b long")).where("id = component").count() == 3
    named = components(v.selectExpr("*", "id * 2 as `twice`"), spark.createDataFrame([(1, 0)], "a long, b long"))
    assert named.columns == ["id", "twice", "component"] and named.where("id = 1").first()[1:] == (2, 0)


def test_hashes(spark):
    rows = spark.range(2000).select("id", held_out(F.col("id")).alias("h"), unit_hash(F.lit("1"), F.col("id").cast("string")).alias("u")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) and 0 <= r["u"] < 1 for r in rows)
    assert 0.45 < sum(r["u"] for r in rows) / 2000 < 0.55


def test_library_works_without_the_corpus_part(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=lambda d, names: [n for n in names if n in (".git", "llm", "corpus_pipeline.py", "__pycache__")])
    code = "import __spark_entry__ as e; q = e.queries(); assert 'team_strengths' in q and not any(n.startswith('op') for n in q), q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)


def test_nothing_else_imports_the_corpus_part():
    others = [p for p in (REPO / "pitchside").rglob("*.py") if "llm" not in p.parts]
    assert others and not any("pitchside.llm" in p.read_text() or "corpus_pipeline" in p.read_text() for p in others)
