"""Quality rules by host: document rules, failure rates of hosts, verdicts.

Rules fail single documents. Failures are counted by host, the rate of each host is
shrunk towards an empirical beta prior (so that a host with three documents is not
judged by three documents), and hosts whose shrunk rate is too high lose all documents.

Only built-in expressions: the measures of a text are array expressions over its own
row, the counts by host are partial aggregates, and verdicts come back by a join on the
host that Spark may split where one host holds a large part of all rows.

Null or empty text: all measures 0, so the rule on the number of words fails it. Null
host: the rows without a host form one host of their own. Repeated rows are judged as
often as they occur. Other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from thermoflow.llm.common import read, text_of, words_of, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host is rejected if its shrunk failure rate is above this.
MAX_HOST_RATE = 0.5
#: Bounds of the weight of the prior, in documents.
PRIOR_LEAST, PRIOR_MOST = 1.0, 1000.0

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def host_of_url(url: Column) -> Column:
    """The host of a web address, in lower case."""
    return F.lower(F.parse_url(url, F.lit("HOST")))


def measures(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the five measures of each text."""
    kept = [F.col(c) for c in keep]
    body = df.select(*kept, text_of(text).alias("_text"))
    split = body.select(
        *kept, "_text", words_of(F.col("_text")).alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^ \t-\r]")).alias("_lines"),
    )
    windows = split.select(
        *kept, "_lines",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        F.when(F.size("_words") >= 3, F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size("_words") - 3),
            lambda i: F.struct(
                F.concat_ws(" ", F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)).alias("gram"),
                i.alias("at"),
            ),
        ))).alias("_sorted"),
    )
    # Equal windows are neighbours once sorted.
    repeated = F.filter("_sorted", lambda x, k: (
        (x["gram"] == F.get("_sorted", k - 1)["gram"]) | (x["gram"] == F.get("_sorted", k + 1)["gram"])
    ))
    covered = F.array_distinct(F.flatten(F.transform(
        repeated, lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2)
    )))
    return windows.select(
        *kept, "n_words", "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(F.size(covered), F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def host_verdicts(judged: DataFrame, host: str, failed: str, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: ``host, host_docs, host_failed, host_rate, host_rejected``.

    The prior has the mean of the hosts' rates, and the weight that their variance
    suggests (method of moments), within bounds. Only its two numbers reach the driver.
    """
    hosts = judged.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("host_docs"),
        F.sum(F.col(failed).cast("bigint")).alias("host_failed"),
    )
    rate = F.col("host_failed") / F.col("host_docs")
    mean, variance = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    mean, variance = mean or 0.0, variance or 0.0
    weight = mean * (1 - mean) / variance - 1 if variance > 0 else PRIOR_MOST
    weight = min(max(weight, PRIOR_LEAST), PRIOR_MOST)
    shrunk = (F.col("host_failed") + mean * weight) / (F.col("host_docs") + weight)
    return hosts.withColumn("host_rate", shrunk).withColumn("host_rejected", shrunk > max_rate)


def apply_rules(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
    max_rate: float = MAX_HOST_RATE,
) -> DataFrame:
    """A row per document: id, measures, ``base_failed``, its host's counts, rate and verdict, ``kept``."""
    named = df.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"))
    # Texts are measured once: the counts by host and the verdicts both start from this table.
    judged = written(
        measures(named, ["doc_id", "host"]).withColumn("base_failed", base_failed()), "quality-measures"
    )
    hosts = host_verdicts(judged, "host", "base_failed", max_rate)
    return (
        judged.alias("d")
        .join(hosts.alias("h"), F.col("d.host").eqNullSafe(F.col("h.host")), "left")
        .select("d.*", "host_docs", "host_failed", "host_rate", "host_rejected")
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
    )


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return apply_rules(read(spark, folder, "documents")).select(
        "doc_id", *MEASURES, "base_failed", "kept", "host_docs", "host_failed", "host_rejected"
    )


SQL = rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
parts AS (
  SELECT r, doc_id, source, text,
    regexp_extract_all(text, '[^ \t\n\x0b\f\r]+') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0b\f\r]')) AS l
  FROM texts),
grams AS (
  SELECT r, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS gram
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM parts)),
repeats AS (SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM repeats) GROUP BY r),
measured AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words,
    coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM parts LEFT JOIN covered USING (r)),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM measured),
hosts AS (
  SELECT source, count(*) AS host_docs, sum(base_failed::BIGINT)::BIGINT AS host_failed FROM judged GROUP BY source),
moments AS (
  SELECT avg(host_failed / host_docs) AS m, var_pop(host_failed / host_docs) AS v FROM hosts),
prior AS (
  SELECT m, least(greatest(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE {PRIOR_MOST} END, {PRIOR_LEAST}), {PRIOR_MOST}) AS k
  FROM moments),
verdicts AS (
  SELECT source, host_docs, host_failed, (host_failed + m * k) / (host_docs + k) > {MAX_HOST_RATE} AS host_rejected
  FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT host_rejected AS kept, host_docs, host_failed, host_rejected
FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source
"""
