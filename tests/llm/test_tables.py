"""Host trust, sharding, the pipeline and the registered queries."""
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import pytest
from conftest import SF_SMOKE
from pyspark.sql import functions as F

import __spark_entry__ as E
from eddy.llm import host_trust, sharding
from eddy.llm.queries import ORACLE, QUERIES


def test_urls_match_sql(spark, scratch):
    zones, langs = ["com", "net", "org"], ["en", "de", "fr"]
    rows = [(i, f"https://H{i % 7}.{zones[i % 3]}/{langs[i % 4 % 3]}/{i}",
             "".join(f'<a HREF = "http://h{j % 7}.{zones[(i + j) % 3]}/x"><a href=//h{j % 5}.net?u=http://no.org>' for j in range(i % 5)), "clash") for i in range(300)]
    rows += [(None, None, None, None), (1, "x", "", ""), (2, "HTTP://A.Net?x://y/", "", ""), (3, "a://b://c/d", None, ""),
             (4, "https://notexample.com/de/x", "", ""), (5, "https://sub.EXAMPLE.com/de/x?q#f", "", ""), (6, "://", "", ""), (6, "://", "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    df.write.parquet(f"{scratch}/p")
    db = duckdb.connect()
    db.sql(f"create view pages as select * from read_parquet('{scratch}/p/*.parquet')")
    got = sorted(map(tuple, host_trust.judge_urls(df).collect()), key=str)
    assert got == sorted(db.sql(host_trust.judge_urls_sql()).fetchall(), key=str)
    assert (5, "sub.example.com", "/de/x", "example.com/de/", "block") in got
    assert (4, "notexample.com", "/de/x", None, "allow") in got
    assert (2, "a.net", "", None, "allow") in got
    assert host_trust.judge_urls(df.limit(0)).count() == 0


def test_links_that_name_a_host(spark):
    html = """<a href="http://A.com/x">, <A HREF='https://b.org?q'>, <a href=//c.net/y>, <a href=HTTP://d.com>, <a href = " //e.com#z">
      <a href="/go?u=http://no.org">, <a href="go/http://no.org">, <a href=x//no.org>, <a href="mailto:x@no.org">, <a href="#//no.org">, <a href="///no.org">,
      <a href="http://self.com/1">, <a href="ftp://f.com:21/2">, <a href=http://A.com>"""
    df = spark.createDataFrame([(1, "http://self.com/", html), (2, None, html), (3, "http://self.com/2", None)], "page_id long, url string, html string")
    got = sorted(map(tuple, host_trust.host_edges(df).collect()))
    assert got == [("self.com", "a.com", 2), ("self.com", "b.org", 1), ("self.com", "c.net", 1), ("self.com", "d.com", 1),
                   ("self.com", "e.com", 1), ("self.com", "f.com:21", 1)]


def test_a_blocked_hot_host_is_dealt_to_salts(spark):
    rows = [(i, "http://hot.com/x", '<a href="//bad.net/">') for i in range(300)] + [(1000 + i, "http://bad.net/", "") for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in host_trust.judge_urls(df).collect()}
    assert len(got) == 700 and set(got.values()) == {"block"}


def test_distrust_runs_against_links_and_trust_along(spark):
    seeds = spark.createDataFrame([("good", 10.0, 0.0), ("bad", 0.0, 10.0), ("far", 0.0, 0.0)], "host string, trust double, distrust double")
    edges = spark.createDataFrame([("good", "liked", 1), ("linker", "bad", 3), ("linker", "good", 1)], "a string, b string, n long")
    got = {r.host: r for r in host_trust.propagate(seeds, edges).collect()}
    assert got["liked"].trust > 0 and got["liked"].distrust == 0
    assert got["linker"].distrust > 0 and got["linker"].trust == 0
    assert "far" not in got


def check_shards(got, n):
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None
    for rows in by.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert set(by) <= set(range(n))
    return [sum(r.size for r in by.get(s, [])) for s in range(n)]


@pytest.mark.parametrize("block_rows", [64, 1 << 11])
def test_shards_with_a_hot_text(spark, block_rows):
    rows = [(i, "the same text" if i % 3 else f"text {i}", "x", i) for i in range(6000)] + [(5, None, "x", 1), (None, None, "x", 1), (None, "é", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, h int")
    got = sharding.shard_documents(df, shards=40, block_rows=block_rows).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    want = Counter((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, *_ in rows)
    assert Counter((r.size, r.text_crc32) for r in got) == want
    sizes = check_shards(got, 40)
    assert max(sizes) - min(sizes) <= 0.06 * sum(sizes) / 40
    small = defaultdict(set)
    for r in got:
        small[r.text_crc32].add(r.shard)
    assert sum(len(s) > 1 for s in small.values()) == 1          # only the hot text is cut


def test_shards_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    got = sharding.shard_documents(docs, shards=5).collect()
    sizes = check_shards(got, 5)
    assert len(got) == docs.count() and max(sizes) < 1.4 * min(sizes)
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_native_queries_have_no_python(spark):
    for name in ("op6_url_filters", "op9_sharding"):
        plan = E.queries()[name](spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_queries_are_registered_and_match_their_sql(spark):
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        db.sql(f"create view {t} as select * from read_parquet('{SF_SMOKE}/{t}.parquet')")
    for name, sql in ORACLE.items():
        got = E.queries()[name](spark, SF_SMOKE)
        names = sorted(got.columns)
        want = db.sql(f"select {', '.join(names)} from ({sql})").fetchall()
        assert sorted(map(tuple, got.select(names).collect()), key=str) == sorted(want, key=str), name


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    extra = spark.createDataFrame([(None, "a null id stays", "en", "s", 15), (10 ** 6, None, None, None, None)], docs.schema)
    docs = docs.unionByName(extra)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMOKE)
        if name == corpus_pipeline.STAGES[-1][0]:
            assert out.count() == docs.count() and out.where("not parity or not round_trip").count() == 0
        else:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert out.dtypes == docs.dtypes
            before, after = docs.count(), out.count()
            assert 0.5 * before < after <= before
            assert stage(spark, docs.limit(0), SF_SMOKE).count() == 0
            docs = spark.createDataFrame(out.collect(), docs.schema)
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_runs(spark):
    got = E.queries()["pipeline"](spark, SF_SMOKE)
    ids = [r.doc_id for r in got.select("doc_id").collect()]
    kept = [r.doc_id for r in E.queries()["op2_minhash_dedup"](spark, SF_SMOKE).where(F.col("kept")).collect()]
    assert len(ids) == len(set(ids)) > 0 and len(ids) < len(kept) + 20
