"""Request log operators: route labels, counters, histograms, load report, metrics text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.text import escaped_label
from shopledger.sources.fixed_values import ROUTES, UNMATCHED_ROUTE

MICROS = 1_000_000


def route_label(method: Column, path: Column) -> Column:
    """The template of the first route that takes this method and path."""
    label = F.lit(UNMATCHED_ROUTE)
    for verbs, kind, template in reversed(ROUTES):
        if kind == "exact":
            fits = path == template
        elif kind == "prefix":
            fits = F.startswith(path, F.lit(template))
        else:
            fixed = template[: template.index("{")]
            fits = path.rlike(f"^{re.escape(fixed)}[^/]+$")
        if verbs:
            fits = fits & method.isin(verbs.split())
        label = F.when(fits, template).otherwise(label)
    return label


def with_route(requests: DataFrame) -> DataFrame:
    """Adds ``route``; a status of 0 was never set and counts as 200."""
    status = F.when(F.col("status") == 0, 200).otherwise(F.col("status"))
    return requests.withColumn("route", route_label(F.col("method"), F.col("path"))).withColumn(
        "status", status.cast("string")
    )


def request_counts(requests: DataFrame) -> DataFrame:
    return with_route(requests).groupBy("method", "route", "status").agg(F.count("*").alias("requests"))


def duration_summary(requests: DataFrame) -> DataFrame:
    """Summed microseconds and count per (method, route); integer sums are exact in any order."""
    return (
        with_route(requests)
        .groupBy("method", "route")
        .agg(F.sum("took_us").alias("sum_us"), F.count("*").alias("requests"))
    )


def in_label_order(counts: DataFrame, labels: list[str]) -> DataFrame:
    """Ordered by the labels run together, which is not the order of the label tuple."""
    return counts.orderBy(F.concat(*labels), *labels)


def _sample(name: str, labels: list[str], value: Column) -> Column:
    """One exposition line. Label values are escaped once."""
    pairs = []
    for i, label in enumerate(labels):
        pairs += [F.lit(("," if i else "") + label + '="'), escaped_label(F.col(label)), F.lit('"')]
    return F.concat(F.lit(name + "{"), *pairs, F.lit("} "), value)


def metrics_text(requests: DataFrame) -> DataFrame:
    """(section, labels, part, line): all exposition lines; ordering by the first three gives the page."""
    # one scan: counts and sums per status, and these rolled up over the statuses
    base = with_route(requests).groupBy("method", "route", "status").agg(
        F.sum("took_us").alias("sum_us"), F.count("*").alias("requests")
    )
    both = base.groupingSets([["method", "route", "status"], ["method", "route"]], "method", "route", "status").agg(
        F.sum("sum_us").alias("sum_us"), F.sum("requests").alias("requests"), F.grouping("status").alias("rolled")
    )
    total, took = "frontend_http_requests_total", "frontend_http_request_duration_seconds"
    # Exact decimal division by a power of ten; format_number would group digits.
    seconds = (F.col("sum_us").cast("decimal(28,0)") / F.lit(MICROS).cast("decimal(7,0)")).cast("decimal(34,6)")
    headers = F.array(
        *[
            F.struct(F.lit(s).alias("section"), F.lit("").alias("labels"), F.lit(p).alias("part"), F.lit(t).alias("line"))
            for s, p, t in [
                (0, 0, f"# HELP {total} Total frontend HTTP requests."),
                (0, 1, f"# TYPE {total} counter"),
                (1, 0, f"# HELP {took} Frontend HTTP request duration."),
                (1, 1, f"# TYPE {took} summary"),
            ]
        ]
    )
    head = requests.sparkSession.range(1).select(F.inline(headers))

    def line(section: int, labels: Column, part: int, text: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), labels.alias("labels"), F.lit(part).alias("part"), text.alias("line"))

    requested = F.col("requests").cast("string")
    counted = line(0, F.concat("method", "route", "status"), 2, _sample(total, ["method", "route", "status"], requested))
    pair, names = F.concat("method", "route"), ["method", "route"]
    summed = line(1, pair, 2, _sample(took + "_sum", names, seconds.cast("string")))
    number = line(1, pair, 3, _sample(took + "_count", names, requested))
    lines = both.select(F.inline(F.when(F.col("rolled") == 0, F.array(counted)).otherwise(F.array(summed, number))))
    return head.unionByName(lines)


def write_metrics_text(requests: DataFrame, path: str) -> None:
    """One text file, in page order; its size depends on the number of label sets only."""
    page = metrics_text(requests).orderBy("section", "labels", "part")
    page.select("line").coalesce(1).write.mode("overwrite").text(path)


def cumulative_histogram(
    samples: DataFrame, labels: list[str], value: Column, bounds: list[float], weight: Column | None = None
) -> DataFrame:
    """(labels..., le, samples): how many values are <= each bound, and all of them as '+Inf'.

    A row with a weight stands for so many samples.
    """
    names = [f"{b:g}" for b in bounds]
    one = F.lit(1).cast("bigint") if weight is None else weight
    within = [F.sum(F.when(value <= F.lit(b), one).otherwise(0)).alias(n) for n, b in zip(names, bounds)]
    wide = samples.groupBy(*labels).agg(*within, F.sum(F.when(value.isNotNull(), one).otherwise(0)).alias("+Inf"))
    return wide.unpivot(labels, [f"`{n}`" for n in names] + ["`+Inf`"], "le", "samples")


def labelled_counters(samples: DataFrame, labels: list[str]) -> DataFrame:
    return samples.groupBy(*labels).agg(F.count("*").alias("total"))


def retrieval_counters(queries: DataFrame, hits: DataFrame, backend: str) -> DataFrame:
    """(metric, backend, total): searches of a backend and the documents they found."""
    counts = [(n, df.agg(F.count("*").alias("total"))) for n, df in (("queries", queries), ("hits", hits))]
    first, second = (df.select(F.lit(n).alias("metric"), F.lit(backend).alias("backend"), "total") for n, df in counts)
    return first.unionByName(second)


def rejected_calls(limited: DataFrame) -> DataFrame:
    """How many calls the rate limiter turned away."""
    return limited.agg(F.count_if(~F.col("allowed")).alias("rejected"))


def hit_ratio(hits: Column, limit: int, corpus_size: Column | int) -> Column:
    """Share of the possible results that a token search returned."""
    size = F.lit(corpus_size) if isinstance(corpus_size, int) else corpus_size
    return hits / F.greatest(F.lit(1), F.least(F.lit(limit), size)).cast("double")


def vector_hit_ratio(hits: Column) -> Column:
    """A vector search either found something or did not."""
    return F.when(hits > 0, 1.0).otherwise(0.0)


def latest_ratio(searches: DataFrame) -> DataFrame:
    """The gauge per backend: its last written value."""
    return searches.groupBy("backend").agg(
        F.max_by("ratio", F.struct("written_at", "query_id")).alias("hit_ratio")
    )


def load_report(requests: DataFrame, labels: list[str], exact: bool = True) -> DataFrame:
    """Requests, errors, error rate and latency percentiles in milliseconds.

    Exact percentiles come from counts per whole millisecond: the values a group can hold
    are bounded by the request timeout, not by the number of requests.
    """
    failed = F.count_if(F.col("status") >= 500)
    if not exact:
        cuts = F.percentile_approx("took_ms", F.lit([0.5, 0.95, 0.99]), 10_000)
        report = _in_ms(requests).groupBy(*labels).agg(
            F.count("*").alias("requests"), failed.alias("errors"), cuts.alias("cuts")
        )
    else:
        counted = _in_ms(requests).groupBy(*labels, "took_ms").agg(
            F.count("*").alias("n"), failed.alias("failed")
        )
        cuts = F.percentile("took_ms", F.lit([0.5, 0.95, 0.99]), F.col("n"))
        report = counted.groupBy(*labels).agg(
            F.sum("n").alias("requests"), F.sum("failed").alias("errors"), cuts.alias("cuts")
        )
    return report.select(
        *labels,
        "requests",
        "errors",
        (F.col("errors") / F.col("requests")).alias("error_rate"),
        *[F.col("cuts")[i].cast("double").alias(n) for i, n in enumerate(["p50_ms", "p95_ms", "p99_ms"])],
    )


def _in_ms(requests: DataFrame) -> DataFrame:
    return requests.withColumn("took_ms", F.call_function("div", F.col("took_us"), F.lit(1000)))


LOG_SCHEMA = "severity string, levelname string, timestamp string, created string, message string"


def normalised_logs(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON log lines with one severity and one timestamp each."""
    parsed = lines.withColumn("_log", F.from_json(F.col(column), LOG_SCHEMA))
    log = F.col("_log")

    def given(name: str) -> Column:
        return F.when(log[name] != "", log[name])

    return parsed.select(
        *[c for c in lines.columns if c != column],
        F.coalesce(F.upper(given("severity")), log["levelname"]).alias("severity"),
        F.coalesce(given("timestamp"), log["created"]).alias("timestamp"),
        log["message"].alias("message"),
    )
