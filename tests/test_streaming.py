"""Streams fed file by file end where the batch operators do."""

import random

from pyspark.sql import functions as F

from shopledger.operators import carts, replay, telemetry
from shopledger.streaming import carts as live_carts
from shopledger.streaming import requests as live
from shopledger.streaming import runs


def in_files(df, path, key, n=3):
    """The rows in n files, in key order, so that each micro-batch is a later stretch of the log."""
    rows = df.count()
    for i in range(n):
        part = df.filter((F.col(key) >= i * rows // n) & (F.col(key) < (i + 1) * rows // n))
        part.coalesce(1).write.mode("append").parquet(str(path))
    return str(path)


def test_cart_stream(spark, tmp_path):
    rng = random.Random(1)
    log = [
        (i, rng.randint(0, 5), "empty" if rng.random() < 0.1 else "add", rng.randint(0, 9), rng.randint(1, 4))
        for i in range(240)
    ]
    df = spark.createDataFrame(log, "seq bigint, user_id bigint, kind string, product_id bigint, quantity bigint")
    folder = in_files(df, tmp_path / "log", "seq")
    stream = runs.event_stream(spark, folder, df.schema, "*.parquet", files_per_batch=1)
    updates = runs.run_available(live_carts.cart_updates(stream), "update", "carts")
    assert updates.select("batch_id").distinct().count() == 3
    got = {tuple(r) for r in live_carts.current_lines(updates).select("user_id", "product_id", "quantity").collect()}
    want = {tuple(r) for r in carts.cart_state(df).select("user_id", "product_id", "quantity").collect()}
    assert got == want


def test_late_adds_and_empties(spark, tmp_path):
    """Events in any order of arrival, in a folder of part files: late adds count."""
    log = [(10, 1, "add", 7, 2), (5, 1, "add", 7, 3), (11, 2, "add", 7, 1), (12, 2, "empty", None, None), (13, 2, "add", 8, 4)]
    schema = "seq bigint, user_id bigint, kind string, product_id bigint, quantity bigint"
    for row in log:
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "log.parquet"))
    df = spark.createDataFrame(log, schema)
    stream = runs.event_stream(spark, str(tmp_path / "log.parquet"), df.schema, files_per_batch=1)
    updates = runs.run_available(live_carts.cart_updates(stream), "update", "carts")
    got = {tuple(r) for r in live_carts.current_lines(updates).select("user_id", "product_id", "quantity").collect()}
    assert got == {(1, 7, 5), (2, 8, 4)}
    assert got == {tuple(r) for r in carts.cart_state(df).select("user_id", "product_id", "quantity").collect()}


def test_empty_stream_and_settings(spark, tmp_path):
    df = requests(spark)
    df.limit(0).write.parquet(str(tmp_path / "log.parquet"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    stream = runs.event_stream(spark, str(tmp_path / "log.parquet"), df.schema)
    seen = runs.run_available(live.live_metrics(stream), "update", "metrics")
    assert seen.count() == 0 and "requests" in seen.columns
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


def test_late_requests_count(spark, tmp_path):
    """The oldest requests come last, hours after newer ones."""
    df = requests(spark).withColumn("ts", F.timestamp_seconds(F.col("req_id") * 3600))
    for low, high in ((200, 300), (100, 200), (0, 100)):
        part = df.filter((F.col("req_id") >= low) & (F.col("req_id") < high))
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "log.parquet"))
    stream = runs.event_stream(spark, str(tmp_path / "log.parquet"), df.schema, files_per_batch=1)
    seen = runs.run_available(live.live_metrics(stream), "update", "metrics")
    final = seen.groupBy("window_start", "method", "route", "status").agg(F.max_by("requests", "batch_id").alias("n"))
    got = {tuple(r) for r in final.groupBy("method", "route", "status").agg(F.sum("n")).collect()}
    assert got == {tuple(r) for r in telemetry.request_counts(df).collect()}


def test_rate_limit_stream(spark, tmp_path):
    rng, at = random.Random(2), 0
    log = []
    for i in range(200):
        at += rng.randint(0, 3) * 1_000_000
        log.append((rng.randint(0, 3), at, i))
    df = spark.createDataFrame(log, "key bigint, at_us bigint, call_id bigint")
    folder = in_files(df, tmp_path / "log", "call_id")
    stream = runs.event_stream(spark, folder, df.schema, "*.parquet", files_per_batch=1)
    seen = runs.run_available(live.live_rate_limit(stream, 20, 3), "append", "limits")
    got = {(r.call_id, r.allowed) for r in seen.collect()}
    assert got == {(r.call_id, r.allowed) for r in replay.rate_limited(df, 20, 3).collect()}


def test_string_ids(spark, tmp_path):
    """Users, products, keys and calls named by text, over several micro-batches."""
    rng = random.Random(6)
    log = [
        (i, f"user-{rng.randint(0, 4)}", "empty" if rng.random() < 0.1 else "add", f"OLJ{rng.randint(0, 9)}", rng.randint(1, 4))
        for i in range(240)
    ]
    df = spark.createDataFrame(log, "seq bigint, user_id string, kind string, product_id string, quantity bigint")
    stream = runs.event_stream(spark, in_files(df, tmp_path / "carts", "seq"), df.schema, "*.parquet", files_per_batch=1)
    updates = runs.run_available(live_carts.cart_updates(stream), "update", "carts")
    assert dict(updates.dtypes)["user_id"] == dict(updates.dtypes)["product_id"] == "string"
    got = {tuple(r) for r in live_carts.current_lines(updates).select("user_id", "product_id", "quantity").collect()}
    assert got == {tuple(r) for r in carts.cart_state(df).select("user_id", "product_id", "quantity").collect()}

    calls = spark.createDataFrame(
        [(f"key-{i % 3}", i * 2_000_000, f"call-{i:03}", i) for i in range(150)], "key string, at_us bigint, call_id string, n bigint"
    )
    folder = in_files(calls, tmp_path / "calls", "n")
    stream = runs.event_stream(spark, folder, calls.schema, "*.parquet", files_per_batch=1).drop("n")
    seen = runs.run_available(live.live_rate_limit(stream, 20, 2), "append", "limits")
    want = {tuple(r) for r in replay.rate_limited(calls.drop("n"), 20, 2).select("key", "call_id", "allowed").collect()}
    assert {tuple(r) for r in seen.select("key", "call_id", "allowed").collect()} == want
    assert {allowed for _, _, allowed in want} == {True, False}


def requests(spark):
    rows = spark.range(300).select(
        F.col("id").alias("req_id"), F.timestamp_seconds(F.col("id") * 7).alias("ts"), F.lit("GET").alias("method"),
        F.when(F.col("id") % 3 == 0, "/cart").otherwise("/nowhere").alias("path"),
        (F.col("id") % 2 * 500).cast("int").alias("status"), (F.col("id") * 11).alias("took_us"),
    )
    return rows


def test_live_metrics(spark, tmp_path):
    df = requests(spark)
    folder = in_files(df, tmp_path / "log", "req_id")
    stream = runs.event_stream(spark, folder, df.schema, "*.parquet", files_per_batch=1)
    seen = runs.run_available(live.live_metrics(stream), "update", "metrics")
    final = seen.groupBy("window_start", "method", "route", "status").agg(F.max_by("requests", "batch_id").alias("n"))
    got = {tuple(r) for r in final.groupBy("method", "route", "status").agg(F.sum("n")).collect()}
    assert got == {tuple(r) for r in telemetry.request_counts(df).collect()}


def test_hot_reload(spark, tmp_path):
    """A product added between micro-batches is found from then on."""
    asked = spark.range(6).select(F.col("id").alias("seq"), F.lit(1).cast("bigint").alias("product_id"))
    folder = in_files(asked, tmp_path / "log", "seq", n=2)
    loads = []

    def load():
        loads.append(1)
        ids = [(5, "five")] if len(loads) == 1 else [(1, "one")]
        return spark.createDataFrame(ids, "id bigint, name string")

    stream = runs.event_stream(spark, folder, asked.schema, "*.parquet", files_per_batch=1)
    seen = runs.run_available(
        stream, "append", "enriched", lambda path: live.enrich_with_reload(load, runs.table_sink(path))
    )
    got = {(r.batch_id, r.found) for r in seen.collect()}
    assert got == {(0, False), (1, True)} and len(loads) == 2


def test_exposition_page(spark, tmp_path):
    telemetry.write_metrics_text(requests(spark), str(tmp_path / "page"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "page")).collect()]
    assert lines[0].startswith("# HELP frontend_http_requests_total")
    assert 'frontend_http_requests_total{method="GET",route="/cart",status="200"} 50' in lines
    assert lines[-1] == 'frontend_http_request_duration_seconds_count{method="GET",route="unmatched"} 200'
