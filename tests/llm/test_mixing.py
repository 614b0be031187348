"""Mixing sources: SQL, edge rows and the shares the mix reaches."""

import pytest

from pitchside.llm import mixing, registry
from tests.compare import compare, duck

SF = "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, rate string")


def test_sql(spark):
    ok, msg = compare(registry.QUERIES["op2_mix_sources"](spark, SF), duck(SF), registry.ORACLE_SQL["op2_mix_sources"])
    assert ok, msg


def test_targets_are_reshared(spark):
    # weights 1, 2, 3: c would get 200 of 400 but stops at 30, which the others share 1 : 2
    sizes = spark.createDataFrame([("a", 290), ("b", 100), ("c", 10)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    assert got["c"] == 30 and got["a"] == pytest.approx(370 / 3) and got["b"] == pytest.approx(740 / 3)


def test_edges(spark):
    rows = [(1, None, "a", "x"), (2, "", None, "x"), (3, "one two", None, None), (3, "one two", None, None),
            (None, "w " * 5000, "b", "x")]
    got = mixing.mix_sources(frame(spark, rows)).collect()
    assert len(got) == 5
    assert sum(r["size"] for r in got) == 5004
    assert all(0 <= r["copies"] <= 3 for r in got)
    assert {r["copies"] for r in got if r["doc_id"] == 3} in ({0}, {1}, {2}, {3})
    assert all(r["target"] == 0 and r["rate"] == 0 for r in got if r["source"] == "a")
    out = mixing.emit_copies(mixing.mix_sources(frame(spark, rows)))
    assert out.columns == ["doc_id", "text", "source"]
    assert mixing.mix_sources(frame(spark, [])).count() == 0


def test_reruns_agree_and_sources_near_target(spark):
    docs = spark.range(4000).selectExpr(
        "id as doc_id", "repeat('w ', cast(1 + id % 50 as int)) as text", "concat('s', id % 3 * (id % 2)) as source")
    rows = sorted(map(tuple, mixing.mix_sources(docs).collect()))
    assert rows == sorted(map(tuple, mixing.mix_sources(docs.repartition(7)).collect()))
    per = {}
    for r in mixing.mix_sources(docs).collect():
        s = per.setdefault(r["source"], [r["target"], 0])
        s[1] += r["size"] * r["copies"]
    assert all(abs(taken - target) < 0.1 * target for target, taken in per.values())


def test_rows_without_id(spark):
    """Two sources of 1,000 rows without id each, all alike: taken words land within 5 % of target, and reruns agree."""
    docs = spark.range(2000).selectExpr("cast(null as long) as doc_id", "'ten words ' || repeat('w ', 8) as text", "if(id % 2 = 0, 'a', 'b') as source",
                                        "id as _key", "'x' as _salt", "1 as _draw", "2 as _text", "3 as _copy")
    mixed = mixing.mix_sources(docs.repartition(5))
    assert mixed.columns == [*docs.columns, *mixing.ADDED] and mixing.emit_copies(mixed).columns == docs.columns
    rows = mixed.collect()
    for source in "ab":
        mine = [r for r in rows if r["source"] == source]
        assert len(mine) == 1000 and abs(sum(r["size"] * r["copies"] for r in mine) - mine[0]["target"]) < 0.05 * mine[0]["target"]
        assert sorted(r["copies"] for r in mine) == sorted(r["copies"] for r in mixing.mix_sources(docs.coalesce(1)).collect() if r["source"] == source)


def test_sql_without_ids(spark):
    con = duck(SF)
    rows = [(None, t, s) for t in ("a b c", "a b c d", None, "x") for s in ("p", "q", None) for _ in range(20)] + [(5, "a b", "p"), (6, "c d e", None)]
    con.execute("CREATE OR REPLACE TABLE given (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO given VALUES (?, ?, ?)", rows)
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM given")
    mixed = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    ok, msg = compare(mixed.select("doc_id", "size", "source_size", "target", (mixing.F.col("size") * mixing.F.col("copies")).alias("taken")), con, mixing.SQL)
    assert ok, msg
