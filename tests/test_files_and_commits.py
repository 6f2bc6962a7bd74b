"""Lines by number, digests of files, commits of several tables, versions, whole requests, late lines."""

from __future__ import annotations

import datetime as dt
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from sparktrips.operators import epochs, features, logs, model, validate as V
from sparktrips.session import scratch_path
from sparktrips.streaming import jobs


def split_size(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 0 if size < 1 << 20 else 4 << 20)


@pytest.fixture()
def split_sizes(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    yield lambda size: split_size(spark, size)
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_request_ids_do_not_depend_on_splits(spark, tmp_path, split_sizes):
    for name, n in (("a.jsonl", 5000), ("b.jsonl", 300), ("c.jsonl", 0)):
        (tmp_path / name).write_text("".join(json.dumps({"trip_distance": i % 7, "note": "x" * (i % 90)}) + "\n" for i in range(n)))
    found = []
    for size in (128 << 20, 20_000, 3_000):
        split_sizes(size)
        lines = V.numbered_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > (1 if size < 1 << 20 else 0)
        rows = lines.collect()
        for name, n in (("a.jsonl", 5000), ("b.jsonl", 300)):
            own = sorted((r["position"], r["payload"]) for r in rows if r["source_file"] == name)
            assert [p for p, _ in own] == list(range(n)) and [t + "\n" for _, t in own] == (tmp_path / name).read_text().splitlines(keepends=True)
        found.append({r["request_id"] for r in V.read_trip_requests(spark, str(tmp_path)).collect()})
    assert found[0] == found[1] == found[2] and len(found[0]) == 5300


def test_tree_digests(spark, tmp_path, split_sizes, monkeypatch):
    data = bytearray(os.urandom(400_000))
    names = ["one", "same", "changed", "longer", "empty", "feeds"]
    contents = [data, data, data[:200_000] + bytes([data[200_000] ^ 1]) + data[200_001:], data + b"\n", b"", b"\n" * 40_000]
    for name, content in zip(names, contents):
        (tmp_path / name).write_bytes(bytes(content))
    paths = [str(tmp_path / n) for n in names if n != "empty"]
    monkeypatch.setattr(model, "TREE_LINES", 64)
    found = []
    for size in (128 << 20, 50_000, 7_000):
        split_sizes(size)
        found.append({os.path.basename(r["path"]): r["sha256"] for r in model.tree_digests(spark, paths).collect()})
    assert found[0] == found[1] == found[2] and len(found[0]) == 5
    d = found[0]
    assert d["one"] == d["same"] and len({d[n] for n in ("one", "changed", "longer", "feeds")}) == 4
    # the manifest hashes long files as trees and the others whole
    monkeypatch.setattr(model, "WHOLE_FILE_BYTES", 100_000)
    manifest = {r["relative_path"]: r for r in model.artifact_manifest(spark, str(tmp_path)).collect()}
    assert manifest["one"]["sha256"] == d["one"] and manifest["one"]["length"] == 400_000 and len(manifest) == 5  # Spark lists no empty files
    import hashlib
    assert manifest["feeds"]["sha256"] == hashlib.sha256(contents[5]).hexdigest()


def test_an_epoch_shows_whole_or_not_at_all(spark):
    root = scratch_path(spark, "epochs")
    one = spark.createDataFrame([(1,), (2,)], "x int")
    with pytest.raises(FileNotFoundError):
        epochs.read_epochs(spark, root, "a")
    epochs.write_epoch(spark, root, 0, {"a": one, "b": one})

    class Broken:
        @property
        def write(self):
            raise OSError("no space")

    with pytest.raises(OSError):
        epochs.write_epoch(spark, root, 1, {"a": one, "b": Broken()})  # fails between both tables
    assert epochs.read_epochs(spark, root, "a").count() == epochs.read_epochs(spark, root, "b").count() == 2
    for _ in range(2):  # run again, and once more
        epochs.write_epoch(spark, root, 1, {"a": one, "b": one.limit(1)})
    assert epochs.read_epochs(spark, root, "a").count() == 4 and epochs.read_epochs(spark, root, "b").count() == 3
    assert epochs.read_epochs(spark, root, "a", since=1).select("epoch").distinct().count() == 1


def test_writers_at_once_get_versions_of_their_own(spark):
    root = scratch_path(spark, "versions")
    got = []

    def write(i):
        got.append(epochs.append_version(spark.createDataFrame([(i,)], "x int"), root))

    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got) == [1, 2, 3, 4]
    rows = epochs.read_versions(spark, root).collect()
    assert sorted(r["version_number"] for r in rows) == [1, 2, 3, 4] and sorted(r["x"] for r in rows) == [0, 1, 2, 3]


def test_scores_written_again_are_replaced(spark):
    from sparktrips.plans.q_model import write_scores
    root = scratch_path(spark, "scores")
    scored = spark.createDataFrame([("r", 1.5)], "correlation_id string, prediction double")
    for epoch in (0, 0, 1):
        write_scores(scored, root, epoch)
    assert epochs.read_epochs(spark, root, "scores").count() == 2
    late = V.with_latency(scored.withColumn("at", F.current_timestamp() - F.expr("interval 2 seconds")), "at").first()
    assert 2000 <= late["latency_ms"] < 60_000
    rows = spark.createDataFrame([("r", 1, 2.0), ("r", 0, 1.0)], "request_id string, trip_index int, prediction double").withColumn("at", F.current_timestamp())
    answer = V.batch_responses(rows, "v", received="at").first()
    assert answer["predictions"] == [1.0, 2.0] and answer["count"] == 2 and answer["latency_ms"] >= 0


def _write(spark, folder, rows):
    spark.createDataFrame(rows, "request_id string, pos int, l_partkey bigint, l_suppkey bigint, payload string, declared bigint").coalesce(1).write.parquet(folder)


def test_requests_in_parts_are_scored_once_and_their_state_is_freed(spark, tmp_path):
    good, bad = '{"trip_distance": 2, "fare_amount": 5, "total_amount": 6}', '{"trip_distance": -2, "fare_amount": 5, "total_amount": 6}'
    row = lambda request, pos, payload, declared: (request, pos, 1, 1, payload, declared)
    source, out = str(tmp_path / "in"), scratch_path(spark, "parts")
    scorer = lambda df: df.withColumn("prediction", F.lit(3.0) * F.col("trip_distance") + F.lit(5.0))
    schema = "request_id string, pos int, l_partkey bigint, l_suppkey bigint, payload string, declared bigint"

    def run(timeout):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(source)
        jobs.run_scoring(stream, scorer, out, timeout=timeout)
        table = lambda name: epochs.read_epochs(spark, out, name)
        return sorted((r["request_id"], r["pos"]) for r in table("predictions").collect()), sorted((r["request_id"], r["pos"], r["message"]) for r in table("rejects").collect())

    # a: whole in two parts; b: one bad trip in the second part; c: a part is missing; d: more than declared
    _write(spark, f"{source}/part=0", [row("a", 0, good, 3), row("a", 1, good, 3), row("b", 0, good, 2), row("c", 0, good, 2), row("d", 0, good, 1), row("d", 1, good, 1)])
    hour = dt.timedelta(hours=1)
    scored, rejected = run(hour)
    assert scored == [] and [r[:2] for r in rejected] == [("d", 0), ("d", 1)]
    _write(spark, f"{source}/part=1", [row("a", 2, good, 3), row("b", 1, bad, 2)])
    scored, rejected = run(hour)
    assert scored == [("a", 0), ("a", 1), ("a", 2)]
    assert [r[:2] for r in rejected if r[0] == "b"] == [("b", 0), ("b", 1)]
    assert [r for r in rejected if r[0] == "c"] == []
    state = spark.read.format("statestore").load(f"{out}/_checkpoint")
    assert [r["key"][0] for r in state.collect()] == ["c"]  # what is decided is freed


def test_a_request_that_stays_incomplete_is_rejected_after_the_timeout(spark, tmp_path):
    good = '{"trip_distance": 2, "fare_amount": 5, "total_amount": 6}'
    source, out = str(tmp_path / "in"), scratch_path(spark, "timeout")
    schema = "request_id string, pos int, l_partkey bigint, l_suppkey bigint, payload string, declared bigint"
    for part, request in ((0, "late"), (1, "other")):
        _write(spark, f"{source}/part={part}", [(request, 0, 1, 1, good, 2)])
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        jobs.run_scoring(stream, lambda df: df.withColumn("prediction", F.lit(1.0)), out, timeout=dt.timedelta(milliseconds=1))
    rejects = {r["request_id"]: r["message"] for r in epochs.read_epochs(spark, out, "rejects").collect()}
    assert rejects["late"] == jobs.INCOMPLETE
    assert epochs.read_epochs(spark, out, "predictions").count() == 0


def test_late_lines_are_counted_for_their_window(spark, sf_small, monkeypatch):
    monkeypatch.setattr(jobs, "COMPACT_EVERY", 3)
    out = scratch_path(spark, "disorder")
    found = {r["window_start"]: r for r in jobs.stream_out_of_order(spark, sf_small, parts=5, out=out).collect()}
    from sparktrips.sources import views
    batch = logs.extract_latency(logs.parse_log_lines(views.service_log(spark, sf_small))).where("latency_ms is not null")
    whole = {r["w"]: r["n"] for r in batch.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("w")).agg(F.count("*").alias("n")).collect()}
    assert {w: r["calls"] + r["late"] for w, r in found.items()} == whole
    assert sum(r["late"] for r in found.values()) > 0 and sum(r["calls"] for r in found.values()) > 0
    assert any("compacted" in m["tables"] for m in epochs.manifests(spark, f"{out}/windows"))


def test_p95_of_windows(spark, sf_small):
    import numpy as np
    windows = {r["window_start"]: r for r in jobs.stream_latency_windows(spark, sf_small, out=scratch_path(spark, "p95")).collect()}
    from sparktrips.sources import views
    rows = logs.extract_latency(logs.parse_log_lines(views.service_log(spark, sf_small))).where("latency_ms is not null").select("ts", "latency_ms").collect()
    for w, r in windows.items():
        own = np.array([x["latency_ms"] for x in rows if w <= x["ts"] < w + dt.timedelta(hours=1)])
        below, upto = (own < r["p95_ms"]).mean(), (own <= r["p95_ms"]).mean()
        assert below - jobs.P95_RANK_ERROR - 1 / len(own) <= 0.95 <= upto + jobs.P95_RANK_ERROR + 1 / len(own) and r["late"] == 0


def test_vocabulary_in_a_table_gives_the_same_vectors(spark):
    rows = [(i, float(i % 3) or None, None if i % 5 == 0 else f"c{i % 400}", "hot" if i % 3 else f"d{i}", None) for i in range(900)]
    df = spark.createDataFrame(rows, "key int, x double, one string, two string, none double").repartition(4)
    numeric, categorical = ["x", "none"], ["one", "two"]
    small = features.fit_dict_vectorizer(df, numeric, categorical, key="key")
    large = features.fit_dict_vectorizer(df, numeric, categorical, key="key", most=10)
    assert isinstance(small, features.DictVectorizerModel) and isinstance(large, features.DictVectorizerTable) and large.size == len(small.vocabulary)
    unseen = df.withColumn("one", F.when(F.col("key") == 1, "never seen").otherwise(F.col("one")))
    for rows in (df, unseen):
        a = {r["key"]: r["features"] for r in small.transform(rows).collect()}
        b = {r["key"]: r["features"] for r in large.transform(rows).collect()}
        assert len(a) == 900 and {k: v.toArray().tolist() for k, v in a.items()} == {k: v.toArray().tolist() for k, v in b.items()}
    with pytest.raises(ValueError):
        features.fit_dict_vectorizer(df, numeric, categorical, most=10)


def test_a_vocabulary_of_many_names(spark):
    """More names than the driver would take, most of them met once."""
    n = 300_000
    df = spark.range(n).select("id", F.concat(F.lit("v"), "id").alias("word"), (F.col("id") % 2).cast("double").alias("odd"))
    found = features.fit_dict_vectorizer(df, ["odd"], ["word"], key="id", most=1000)
    assert found.size == n + 1
    ends = found.vocabulary.agg(F.min("index"), F.max("index"), F.countDistinct("index")).first()
    assert tuple(ends) == (0, n, n + 1) and found.vocabulary.where("name = 'odd'").first()["index"] == 0
    vector = found.transform(df.where("id in (7, 8)")).orderBy("id").collect()
    assert [v["features"].numNonzeros() for v in vector] == [2, 1] and vector[0]["features"].size == n + 1


def test_requests_share_states(spark, tmp_path, monkeypatch):
    """Python is called per state, not per request; requests in one state are decided and timed out each on its own."""
    monkeypatch.setattr(jobs, "STATES", 1)
    good = '{"trip_distance": 2, "fare_amount": 5, "total_amount": 6}'
    source, out = str(tmp_path / "in"), scratch_path(spark, "shared")
    schema = "request_id string, pos int, l_partkey bigint, l_suppkey bigint, payload string, declared bigint"

    def run(timeout):
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        jobs.run_scoring(stream, lambda df: df.withColumn("prediction", F.lit(1.0)), out, timeout=timeout)
        rejects = epochs.read_epochs(spark, out, "rejects").select("request_id", "message").distinct().collect()
        return {r["request_id"] for r in epochs.read_epochs(spark, out, "predictions").collect()}, {tuple(r) for r in rejects}

    _write(spark, f"{source}/part=0", [(f"request-{i}", 0, 1, 1, good, 2) for i in range(40)])
    assert run(dt.timedelta(milliseconds=1)) == (set(), set())
    assert spark.read.format("statestore").load(f"{out}/_checkpoint").count() == 1  # was one for each request
    _write(spark, f"{source}/part=1", [(f"request-{i}", 1, 1, 1, good, 2) for i in range(30)])
    scored, rejected = run(dt.timedelta(hours=1))
    assert scored == {f"request-{i}" for i in range(30)}
    assert rejected == {(f"request-{i}", jobs.INCOMPLETE) for i in range(30, 40)}
    assert spark.read.format("statestore").load(f"{out}/_checkpoint").count() == 0


def test_states_follow_the_number_of_trips_and_are_kept_on_disk(spark, tmp_path, monkeypatch):
    good = '{"trip_distance": 2, "fare_amount": 5, "total_amount": 6}'
    rows = spark.createDataFrame([(f"request-{i // 2}", i % 2, 1, i, good) for i in range(50)], "request_id string, pos int, l_partkey bigint, l_suppkey bigint, payload string")
    monkeypatch.setattr(jobs, "STATES", 2)
    monkeypatch.setattr(jobs, "TRIPS_PER_STATE", 5)
    asked, scoring = {}, jobs.run_scoring
    monkeypatch.setattr(jobs, "run_scoring", lambda *a, **kw: asked.update(kw) or scoring(*a, **kw))
    before = {name: spark.conf.get(name, None) for name in jobs.QUERY_CONF}
    out = str(tmp_path / "parts")
    found = jobs.stream_score_parts(spark, rows, lambda df: df.withColumn("prediction", F.lit(1.0)), parts=2, out=out)
    assert asked["states"] == 10
    assert epochs.read_epochs(spark, found["root"], "predictions").count() == 50
    kept = [p.suffix for p in (tmp_path / "parts/scored/_checkpoint/state").rglob("*") if p.is_file()]
    assert ".changelog" in kept and ".delta" not in kept  # RocksDB's; the other store keeps all on the heap
    assert {name: spark.conf.get(name, None) for name in jobs.QUERY_CONF} == before
