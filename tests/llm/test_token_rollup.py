import duckdb
from pyspark.sql import functions as F

from formloom.llm import queries
from formloom.llm._shared import Scratch
from formloom.llm.token_rollup import Rollup

CHANGE = "op string, doc_id long, source string, lang string, version string, tokens long, chars long, seq long"


def totals(store):
    return sorted((tuple(r) for r in store.totals().collect()), key=str)


def test_matches_sql(spark, sf):
    for d in (sf, "/root/testdata/sf0.01"):
        con = duckdb.connect()
        con.sql(f"create view documents as select * from '{d}/documents.parquet'")
        got = sorted((tuple(r) for r in queries.op5_token_rollup(spark, d).collect()), key=str)
        assert got == sorted(con.sql(queries.TOKEN_ROLLUP_SQL).fetchall(), key=str)


def test_signed_batches(spark):
    store = Rollup(spark, Scratch(spark, "rollup").root)
    put = lambda batch, rows: store.commit(batch, spark.createDataFrame(rows, CHANGE))
    assert totals(store) == [] and store.batches() == []
    first = [("insert", 1, "a", "en", "v1", 10, 50, 1), (None, 2, "a", "en", "v1", 5, 20, 1), ("insert", 3, None, None, "v1", None, None, 1),
             ("insert", 1, "a", "en", "v2", 12, 50, 1), ("insert", None, "b", "fr", "v1", 7, 9, 1), ("delete", None, "b", "fr", "v1", 7, 9, 1)]
    assert put("one", first) and not put("one", first)
    want = [("a", "en", "v1", 2, 15, 70), ("a", "en", "v2", 1, 12, 50), ("b", "fr", "v1", 1, 7, 9), (None, None, "v1", 1, 0, 0)]
    assert totals(store) == sorted(want, key=str)
    # moved to another source, revised twice (the later holds), revised though not there, deleted under one version, and under all
    second = [("revise", 2, "c", "de", "v1", 6, 21, 1), ("revise", 2, "c", "de", "v1", 8, 22, 2), ("revise", 99, "a", "en", "v1", 1, 1, 1),
              ("delete", 1, None, None, "v2", None, None, 1), ("delete", 3, None, None, None, None, None, 1), ("insert", 1, "a", "en", "v1", 11, 50, 1)]
    assert put("two", second) and not put("two", second)
    assert totals(store) == sorted([("c", "de", "v1", 1, 8, 22), ("a", "en", "v1", 1, 11, 50), ("b", "fr", "v1", 1, 7, 9)], key=str)
    assert put("none", []) and store.batches() == ["none", "one", "two"]
    assert totals(Rollup(spark, store.root)) == totals(store)


def test_a_batch_that_broke_off_is_written_anew(spark):
    store = Rollup(spark, Scratch(spark, "rollup").root)
    rows = spark.createDataFrame([("insert", i, "a", "en", "v1", 2, 8, 1) for i in range(10)], CHANGE).withColumn("_op", F.lit("clash"))
    store.commit("one", rows)
    store._fs().delete(store._path("_log", "00000000"), True)
    assert totals(store) == []
    assert store.commit("one", rows) and totals(store) == [("a", "en", "v1", 10, 20, 80)]


def test_two_writers(spark, monkeypatch):
    """Another batch claims the entry while one is written: that one starts anew from what holds then. Of one batch only one is counted."""
    store = Rollup(spark, Scratch(spark, "rollup").root)
    put = lambda s, batch, tokens: s.commit(batch, spark.createDataFrame([("insert", 1, "a", "en", "v1", tokens, 1, 1)], CHANGE))
    assert put(store, "one", 5)
    plain, met = Rollup._write, []

    def slow(self, entries):
        part = plain(self, entries)
        if not met:
            met.append(1)
            other = Rollup(spark, store.root)
            assert put(other, "two", 7) and put(other, "same", 8)
        return part

    monkeypatch.setattr(Rollup, "_write", slow)
    assert put(store, "three", 9)
    assert totals(store) == [("a", "en", "v1", 1, 9, 1)] and store.batches() == ["one", "same", "three", "two"]
    met.clear()
    monkeypatch.setattr(Rollup, "_write", lambda self, e: slow(self, e) if met else (met.append(1), put(Rollup(spark, store.root), "late", 3), plain(self, e))[2])
    assert not put(store, "late", 4) and totals(store) == [("a", "en", "v1", 1, 3, 1)]


def test_compacting_and_buckets(spark):
    store = Rollup(spark, Scratch(spark, "rollup").root)
    rows = lambda lo, hi, n: spark.createDataFrame([("insert", i, "a", "en", "v1", n, 1, 1) for i in range(lo, hi)], CHANGE)
    store.commit("one", rows(0, 300, 2))
    store.commit("two", rows(100, 200, 5))
    before = totals(store)
    store.compact()
    assert totals(store) == before == [("a", "en", "v1", 300, 900, 300)] and store.batches() == ["one", "two"] and len(store._parts(store._log())) == 1
    assert not store.commit("two", rows(0, 1, 9)) and store.commit("three", rows(7, 8, 9))
    assert totals(store) == [("a", "en", "v1", 300, 907, 300)] and store.ledger().count() == 300
    plan = store.ledger([3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan


def test_query_on_empty_tables_and_odd_white_space(spark, tmp_path):
    texts = [(1, "a\rb\x0cc\x0bd", "en", "s"), (2, None, None, None), (3, "", "en", "s"), (4, "", "en", "s"), (5, "x\nx\ny", "en", "s")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = sorted(con.sql(queries.TOKEN_ROLLUP_SQL).fetchall(), key=str)
    assert sorted((tuple(r) for r in queries.op5_token_rollup(spark, str(tmp_path)).collect()), key=str) == want and ("s", "en", "words", 2, 6, 10) in want
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.op5_token_rollup(spark, f"{tmp_path}/none").count() == 0
