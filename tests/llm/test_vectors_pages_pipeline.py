"""Nearest neighbours against brute force, archives as exact round trips, and the pipeline end to end."""

from __future__ import annotations

import base64
import hashlib
import io

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from orestack.llm import ann_codes, oracle, queries, warc
from orestack.sources import workspace

DATA = "/root/testdata/sf0.001"


def product(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def best(rows, k, every):
    """The neighbours of every row whose id is asked for among all other rows."""
    out = []
    for at, (q, asked) in enumerate(rows):
        if q % every == 0:
            near = sorted((-product(asked, v), i) for other, (i, v) in enumerate(rows) if other != at)[:k]
            out += [(q, rank, i, -score) for rank, (score, i) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("dim", [1, 5, 64])
def test_neighbours_equal_brute_force(spark, dim, monkeypatch):
    monkeypatch.setattr(ann_codes, "CANDIDATES", 60)
    rng = np.random.default_rng(dim)
    vectors = {i: rng.standard_normal(dim).astype("f4").astype(float).tolist() for i in range(300)}
    for i in range(100, 160):  # equal vectors: ties go to the smaller id
        vectors[i] = vectors[100]
    rows = [(i, v, "x", 1) for i, v in vectors.items()]
    repeated = [(1, vectors[1]), (20, vectors[30]), (20, vectors[20])]  # ids again, with another vector and with the same
    rows += [(i, v, "x", 1) for i, v in repeated]
    unusable = [(1000, None), (1010, [0.0] * dim), (1020, [float("nan")] * dim), (1030, [None] * dim), (1040, []), (None, [1.0] * dim)]
    table = spark.createDataFrame(rows + [(i, v, "x", 1) for i, v in unusable], "vec_id long, v array<float>, code string, id int")
    got = ann_codes.search(table, "vec_id", "v", F.col("id") % 10 == 0, k=7, bound=4.0)
    expected = best([(i, v) for i, v, _, _ in rows], 7, 10)
    assert sorted(tuple(r) for r in got.collect()) == expected
    assert ann_codes.search(table.limit(0), "vec_id", "v", F.col("id") % 10 == 0).count() == 0


def test_fewer_candidates_than_asked_for(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 1.0]), (2, [1.0])], "vec_id long, v array<double>")
    got = ann_codes.search(table, "vec_id", "v", F.col("id") >= 0, k=5)
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, 1, 5.0), (1, 1, 0, 5.0)]


PAGES = [(0, "http://a/0", "one é"), (1, "http://a/1\r\nX: y", ""), (2, None, None), (3, "u", "one é"), (4, "u", "two\r\n\r\nthree"),
         (None, "n", "one é"), (6, "", "x" * 700_000), (7, "u", "alone"), (8, "u", "one é")]


def test_archive_round_trip(spark):
    pages = spark.createDataFrame([(*p, "x", 5) for p in PAGES], "page_id long, url string, html string, sha1 string, first int")
    index = warc.write_bundles(pages, "file://" + workspace.new_folder(spark, "test").removeprefix("file://"))
    got = {r.page_id: r for r in warc.read_records(index).collect()}
    assert index.count() == len(got) == len(PAGES)
    for page_id, url, html in PAGES:
        payload, r = (html or "").encode(), got[page_id]
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        first = {"one é": 0, "": 1}.get(html or "")
        assert r.refers_to == (None if first == page_id else first)
        assert (r.record_type, r.payload) == (("response", payload) if r.refers_to is None else ("revisit", None))
    assert got[4].url == "u" and got[2].url is None and got[1].url == "http://a/1%0D%0AX: y"
    one = index.filter("page_id = 6")
    assert [r.payload_bytes for r in warc.read_records(one).collect()] == [700_000]
    assert warc.archive(pages.limit(0)).count() == 0


def test_archive_equals_its_sql(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame(list(PAGES), "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    with duckdb.connect() as database:
        database.sql(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
        expected = sorted(database.sql(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to "
                                       f"FROM ({oracle.oracle_sql()['op6_warc']})").fetchall(), key=repr)
    assert sorted((tuple(r) for r in queries.op6_warc(spark, folder).collect()), key=repr) == expected


def test_bundles_are_plain_zstandard(spark):
    zstandard = pytest.importorskip("zstandard")
    pages = spark.createDataFrame([(i, "u", "page %d" % i * 9000) for i in range(20)], "page_id long, url string, html string").coalesce(1)
    index = warc.write_bundles(pages, "file://" + workspace.new_folder(spark, "test").removeprefix("file://"))
    path = index.select("bundle").distinct().first()[0].removeprefix("file://")
    with open(path, "rb") as file:
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(file.read()), read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == 20 and index.agg(F.max("frame")).first()[0] > 1


def test_pipeline_is_registered_with_its_parts():
    assert {"pipeline", *queries.queries()} <= driver.queries().keys()
    assert oracle.oracle_sql().keys() <= driver.oracle_sql().keys()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights"]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumn("_name", F.lit("clash"))
    benchmark = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, DATA).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
            assert after.exceptAll(docs).count() == 0 or name == "line dedup"
        docs = after
        counts.append(docs.count())
        if name == "benchmark decontamination":
            left = " ".join(" ".join(r.text.lower().split()) for r in docs.collect())
            assert not any(item in left for item in benchmark)
    assert counts[0] > counts[1] == counts[2] >= counts[3] > counts[4] == counts[5] > counts[0] // 2
    assert docs.columns == ["doc_id", "size", "source_size", "target", "taken", "pieces"]
