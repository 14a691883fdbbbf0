"""The registered queries: every operator over the whole tables of a data folder.

The events of the test tables are minutes apart, so windows and gaps are hours here
where the defaults are seconds.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from thermoflow.fixed_values import OUT_OF_ORDERNESS, SOURCE_IN, SOURCE_OUT, WARNING_THRESHOLD
from thermoflow.functions.numeric import int_mean, room_partition
from thermoflow.model import READING_ORDER
from thermoflow.operators import (
    dashboard, distributions, keying, lateness, meters, metrics, points, projections, relation, running, sequences, windows,
)
from thermoflow.operators.ordered import plan_slices, running_totals
from thermoflow.operators.patterns import alerts, compat_alerts, warnings
from thermoflow.plans.main_job import window_points
from thermoflow.session import stream_session, use_utc, working_path
from thermoflow.sinks import buckets
from thermoflow.sinks.commits import CommittedTable
from thermoflow.sinks.latest import LatestTable
from thermoflow.sources import codec, kafka
from thermoflow.sources.events import (
    arrivals, compound_id, messages_from_conversations, readings_from_events, table, table_stream,
)
from thermoflow.streaming.event_time import with_event_time
from thermoflow.streaming.patterns import stream_alerts, stream_warnings, warning_delay
from thermoflow.streaming.run import drain, drained
from thermoflow.streaming.sequences import MATCHES, store_matches
from thermoflow.streaming.windows import store_closed_windows

Query = Callable[[SparkSession, str], DataFrame]

WIDTH = "1 hour"
DAY = "1 day"
PARTITIONS = 3
WARNING_WITHIN = "1 hour"
ALERT_WITHIN = "2 hours"
LATEST_WITHIN = "3 hours"
SERIES_RANGE = "7 days"
STREAM_SLICE = "6 hours"
PART_ROWS = 100
RECENT = 500
POSITIONS = 2

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(use_utc(spark), folder)

    _QUERIES[function.__name__] = run
    return function


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _readings(spark: SparkSession, folder: str, source: str | None = None) -> DataFrame:
    return readings_from_events(table(spark, folder, "events"), source)


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    return messages_from_conversations(table(spark, folder, "conversations"))


def _with_id(spark: SparkSession, folder: str) -> DataFrame:
    readings = _readings(spark, folder)
    return readings.select(compound_id(readings).alias("id"), "ts", "temperature", "event_id")


# Sources, decoding and encoding


@_query
def wire_records(spark, folder):
    return codec.encode_wire(_readings(spark, folder), "event_id")


@_query
def readings_roundtrip(spark, folder):
    decoded = codec.accepted(codec.decode_wire(wire_records(spark, folder)))
    return decoded.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@_query
def dead_letters(spark, folder):
    """Good wire records among event properties (no reading), chat turns (no JSON) and hostile records."""
    good = codec.encode_wire(_readings(spark, folder))
    properties = table(spark, folder, "events").select(F.lit('{"roomId":"1_IN"}').alias("key"), F.col("props").alias("value"))
    turns = table(spark, folder, "conversations").select(
        F.concat(F.lit('{"roomId":"'), "role", F.lit('"}')).alias("key"), F.col("text").alias("value")
    )
    number = F.lpad(F.col("event_id").cast("string"), 5, "0")
    extreme = table(spark, folder, "events").select(
        F.lit('{"roomId":"1_IN"}').alias("key"),
        F.concat(F.lit('{"value":5,"timestamp":-92233720368547'), number, F.lit("}")).alias("value"),
    )
    unknown = table(spark, folder, "events").select(
        F.concat(F.lit('{"roomId":"'), number, F.lit('_XX"}')).alias("key"), F.lit('{"value":5,"timestamp":1}').alias("value")
    )
    records = good.unionByName(properties).unionByName(turns).unionByName(extreme).unionByName(unknown)
    return codec.dead_letters(codec.decode_wire(records))


@_query
def raw_records(spark, folder):
    records = table(spark, folder, "events").select(
        F.encode("event_type", "UTF-8").alias("key"), F.encode("props", "UTF-8").alias("value"),
        F.col("ts").alias("timestamp"),
    )
    return codec.decode_raw(records)


@_query
def messages_roundtrip(spark, folder):
    return codec.decode_messages(codec.encode_messages(_messages(spark, folder), "event_id"))


@_query
def topic_rows(spark, folder):
    """Rows for a topic sink, keyed so that a repeated write can be recognised."""
    return kafka.keyed_rows(window_len_concat(spark, folder), ("window_start", "event_type", "part"), "text")


# Filters, projections, tokens


@_query
def readings_in(spark, folder):
    return projections.only_source(_readings(spark, folder, SOURCE_IN), SOURCE_IN)


@_query
def readings_out(spark, folder):
    return projections.only_source(_readings(spark, folder, SOURCE_OUT), SOURCE_OUT)


@_query
def hot_readings(spark, folder):
    return projections.at_least(_with_id(spark, folder))


@_query
def non_empty_messages(spark, folder):
    return projections.non_empty(_messages(spark, folder).select("event_id", "message"), "message")


@_query
def hot_ids(spark, folder):
    return projections.ids(projections.at_least(_with_id(spark, folder)))


@_query
def hot_ids_split(spark, folder):
    return projections.tokens(hot_ids(spark, folder), "id", "_")


@_query
def words_with_one(spark, folder):
    return projections.words_with_one(table(spark, folder, "documents").select("text"))


@_query
def upper_type(spark, folder):
    return projections.upper_case(table(spark, folder, "events").select("event_id", "event_type"), "event_type")


@_query
def split_compound_id(spark, folder):
    """The whole-number averages of ``room_<n>_<source>``, with the id taken apart again."""
    averages = windows.window_int_mean_values(_with_id(spark, folder), WIDTH, ("id",), part_rows=PART_ROWS)
    return projections.split_compound_id(averages)


@_query
def room_partitions(spark, folder):
    readings = _with_id(spark, folder)
    room = F.get(F.split("id", "_"), F.lit(1))
    return readings.select("event_id", room_partition(room, PARTITIONS).alias("partition"))


@_query
def message_lengths(spark, folder):
    return _messages(spark, folder).select("event_id", projections.text_length(F.col("message")).alias("length"))


# Windows and aggregates


@_query
def window_avg_in(spark, folder):
    return windows.window_mean(_readings(spark, folder, SOURCE_IN), WIDTH)


@_query
def window_avg_out(spark, folder):
    return windows.window_mean(_readings(spark, folder, SOURCE_OUT), WIDTH)


@_query
def int_avg_values(spark, folder):
    return windows.window_int_mean_values(_readings(spark, folder), DAY, part_rows=PART_ROWS)


@_query
def int_avg(spark, folder):
    return windows.window_int_mean(_readings(spark, folder), WIDTH)


@_query
def window_sum_keyed(spark, folder):
    return windows.window_sum(_with_id(spark, folder), WIDTH, ("id",))


@_query
def window_first_sum(spark, folder):
    return windows.window_sum(_readings(spark, folder), WIDTH, first_of=("room_id", "source"))


@_query
def window_concat(spark, folder):
    """All values of a window joined, with the key of its first record."""
    events = table(spark, folder, "events")
    return windows.window_concat(events, F.col("props"), DAY, first_of="event_type", part_rows=PART_ROWS)


@_query
def window_concat_values(spark, folder):
    return windows.window_concat(table(spark, folder, "events"), F.col("event_type"), WIDTH, part_rows=PART_ROWS)


@_query
def window_len_concat(spark, folder):
    records = projections.non_empty(table(spark, folder, "events"), "props")
    length = projections.text_length(F.col("props"))
    return windows.window_concat(records, length, DAY, ("event_type",), part_rows=PART_ROWS)


@_query
def backup_messages(spark, folder):
    """Backup records as JSON, without their id and wall-clock time."""
    events = table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("sender"), F.col("event_type").alias("recipient"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("sentAt"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"), "ts", "event_id",
    )
    backups = windows.window_backup(events, DAY, part_rows=PART_ROWS)
    return codec.encode_json(backups, ("inputMessages",), keep=("window_start", "window_end", "part", "n"))


@_query
def window_max_by(spark, folder):
    """The message sent last in each window (whole rows, ties to the first)."""
    return windows.window_max_row(_messages(spark, folder), "sentAt", "5 minutes")


# Relation of IN and OUT


@_query
def in_out_relation(spark, folder):
    return relation.relation(_readings(spark, folder), WIDTH)


@_query
def in_out_relation_join(spark, folder):
    return relation.relation_by_join(_readings(spark, folder), WIDTH)


@_query
def in_out_relation_ieee(spark, folder):
    """With infinity and NaN for a zero denominator, shown as a class beside the finite value."""
    out = relation.relation(_readings(spark, folder), WIDTH, ieee=True)
    value = F.col("relation")
    infinite = F.lit(float("inf"))
    kind = F.when(F.isnan(value), "nan").when(value == infinite, "inf").when(value == -infinite, "-inf").otherwise("finite")
    return out.select("room_id", "window_end", kind.alias("kind"), F.when(kind == "finite", value).alias("relation"))


@_query
def int_relation(spark, folder):
    return relation.int_relation(_readings(spark, folder), WIDTH).select(
        "room_id", "relation", "window_end", F.col("relation_text").eqNullSafe(F.col("relation").cast("string")).alias("text_is_same")
    )


@_query
def main_job_points(spark, folder):
    return window_points(_readings(spark, folder), WIDTH)


# Patterns


def _warnings(spark: SparkSession, folder: str, source: str | None = None) -> tuple[DataFrame, dict]:
    readings = _readings(spark, folder, source)
    slices = plan_slices(readings, READING_ORDER)
    return warnings(readings, within=WARNING_WITHIN, slices=slices), {"slices": slices}


def _alerts(spark: SparkSession, folder: str, source: str | None = None, scope: str = "global") -> DataFrame:
    warned, slices = _warnings(spark, folder, source)
    return alerts(warned, ALERT_WITHIN, scope, **slices)


@_query
def warnings_in(spark, folder):
    return _warnings(spark, folder, SOURCE_IN)[0]


@_query
def warnings_out(spark, folder):
    return _warnings(spark, folder, SOURCE_OUT)[0]


@_query
def warnings_exact(spark, folder):
    return warnings(_readings(spark, folder), within=WARNING_WITHIN, exact=True)


@_query
def alerts_in_global(spark, folder):
    return _alerts(spark, folder, SOURCE_IN)


@_query
def alerts_out_global(spark, folder):
    return _alerts(spark, folder, SOURCE_OUT)


@_query
def alerts_by_room(spark, folder):
    return _alerts(spark, folder, scope="room")


@_query
def alerts_compat_out(spark, folder):
    return compat_alerts(_alerts(spark, folder, SOURCE_IN))


@_query
def alert_count(spark, folder):
    return _alerts(spark, folder).groupBy("source").agg(F.count(F.lit(1)).alias("alerts"))


@_query
def alert_counter_series(spark, folder):
    return dashboard.alert_counter(_alerts(spark, folder), WIDTH)


# Running aggregates


@_query
def running_mean(spark, folder):
    return running.running_mean(_readings(spark, folder))


@_query
def mean_per_key(spark, folder):
    return running.mean_per_key(_readings(spark, folder))


@_query
def word_count(spark, folder):
    return running.word_count(table(spark, folder, "documents"))


@_query
def running_word_count(spark, folder):
    return running.running_word_count(table(spark, folder, "conversations"), ("conv_id", "turn"), span=8)


@_query
def running_sum(spark, folder):
    readings = _readings(spark, folder).select("room_id", "temperature", *READING_ORDER)
    return running.running_sum(readings, ("room_id",), "temperature", READING_ORDER)


# Points and dashboard


def _relation_points(spark: SparkSession, folder: str) -> DataFrame:
    return points.relation_points(relation.relation(_readings(spark, folder), WIDTH))


def _temperature_points(spark: SparkSession, folder: str, source: str | None = None) -> DataFrame:
    averages = windows.window_mean(_readings(spark, folder, source), WIDTH, ("room_id", "source"))
    return points.temperature_points(averages)


@_query
def points_rooms_avg(spark, folder):
    return _relation_points(spark, folder)


@_query
def points_rooms_temperatures(spark, folder):
    return _temperature_points(spark, folder)


@_query
def points_new_rooms(spark, folder):
    return points.reading_points(_readings(spark, folder))


@_query
def line_protocol(spark, folder):
    return points.as_lines(_temperature_points(spark, folder))


@_query
def line_protocol_ratios(spark, folder):
    """Ratios that may not be finite: those write no field, so no line."""
    ratios = relation.relation(_readings(spark, folder), WIDTH, ieee=True)
    return points.as_lines(points.relation_points(ratios))


@_query
def sum_by_position(spark, folder):
    """Sums by a key that is given by its position."""
    readings = _readings(spark, folder).select("ts", "temperature", "room_id")
    key = keying.key_at(readings, POSITIONS)
    return windows.window_sum(readings, WIDTH, (key,), "temperature")


@_query
def rebalanced_counts(spark, folder):
    """What is counted doesn't depend on how rows are spread."""
    spread = keying.rebalance(_readings(spark, folder))
    return spread.groupBy("room_id", "source").agg(F.count(F.lit(1)).alias("count"))


@_query
def line_protocol_readings(spark, folder):
    return points.as_lines(points.reading_points(_readings(spark, folder)))


@_query
def ratio_series(spark, folder):
    return dashboard.series(_relation_points(spark, folder), SERIES_RANGE)


@_query
def ratio_grid_cells(spark, folder):
    return dashboard.grid_cells(_relation_points(spark, folder))


@_query
def latest_in(spark, folder):
    return dashboard.latest(_temperature_points(spark, folder, SOURCE_IN), SOURCE_IN, LATEST_WITHIN)


@_query
def latest_out(spark, folder):
    return dashboard.latest(_temperature_points(spark, folder, SOURCE_OUT), SOURCE_OUT, LATEST_WITHIN)


@_query
def threshold_bands(spark, folder):
    return dashboard.gauge(_temperature_points(spark, folder).select("time", "room", "source", "value"))


@_query
def series_reduced(spark, folder):
    reduced = dashboard.reduce_series(_temperature_points(spark, folder), ("room", "source"))
    return reduced.withColumn("mean", F.round("mean", 6))


# Measurements


@_query
def event_counter(spark, folder):
    """Rows counted while they are written somewhere, read from the metric."""
    seen = Observation()
    metrics.counted(table(spark, folder, "events"), seen).write.format("noop").mode("overwrite").save()
    return spark.range(1).select(F.lit(seen.get["events"]).alias("events"))


@_query
def throughput(spark, folder):
    return metrics.throughput(table(spark, folder, "events"), WIDTH)


def _rounded(histogram: DataFrame) -> DataFrame:
    names = ["stddev", *[metrics.quantile_name(q) for q in metrics.QUANTILES]]
    return histogram.withColumns({name: F.round(name, 6) for name in names})


@_query
def value_histogram(spark, folder):
    return _rounded(metrics.window_histogram(_readings(spark, folder), DAY, keys=("source",)))


@_query
def recent_value_histogram(spark, folder):
    return _rounded(metrics.recent_histogram(_readings(spark, folder), RECENT))


# Streams: the files of the table as a stream, run until all input is used. Windows that
# the watermark has not passed by then have no result yet.


def _reading_stream(spark: SparkSession, folder: str) -> DataFrame:
    stream = table_stream(stream_session(spark), folder, "events")
    return with_event_time(readings_from_events(stream), OUT_OF_ORDERNESS)


def _ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


@_query
def stream_relation(spark, folder):
    out = relation.relation(_reading_stream(spark, folder), WIDTH)
    return _ntz(drained(spark, out, "relation"), "window_end")


@_query
def stream_relation_join(spark, folder):
    out = relation.relation_by_join(_reading_stream(spark, folder), WIDTH)
    return _ntz(drained(spark, out, "relation-join"), "window_end")


@_query
def stream_main_job_points(spark, folder):
    out = window_points(_reading_stream(spark, folder), WIDTH)
    return _ntz(drained(spark, out, "points"), "time")


def _stream_warnings(spark: SparkSession, folder: str) -> DataFrame:
    return stream_warnings(_reading_stream(spark, folder), within=WARNING_WITHIN, slice_width=STREAM_SLICE)


@_query
def stream_warning_pairs(spark, folder):
    return _ntz(drained(spark, _stream_warnings(spark, folder), "warnings"), "ts")


@_query
def stream_alert_pairs(spark, folder):
    found = _stream_warnings(spark, folder)
    stored = working_path(spark, "warnings")
    drain(found, stored, working_path(spark, "warnings-checkpoint"))
    warned = stream_session(spark).readStream.schema(found.schema).parquet(stored)
    delayed = with_event_time(warned, warning_delay(WARNING_WITHIN, STREAM_SLICE))
    return _ntz(drained(spark, stream_alerts(delayed, ALERT_WITHIN, slice_width=STREAM_SLICE), "alerts"), "ts")


@_query
def stream_mean_per_key(spark, folder):
    """Every update of the running means is stored; the last one of each key is its mean."""
    updates = drained(
        spark, running.mean_per_key(readings_from_events(table_stream(stream_session(spark), folder, "events"))),
        "means", output_mode="update",
    )
    return updates.groupBy("room_id", "source").agg(
        F.max("count").alias("count"), F.max_by("total", "count").alias("total"),
        F.max_by("mean", "count").alias("mean"),
    )


@_query
def stream_word_count(spark, folder):
    texts = table_stream(stream_session(spark), folder, "part").select(F.col("p_name").alias("text"))
    updates = drained(spark, running.word_count(texts), "words", output_mode="update")
    return updates.groupBy("word").agg(F.max("count").alias("count"))


# Patterns of any length


def _hot(event, taken):
    return event["temperature"] >= WARNING_THRESHOLD


@_query
def pattern_warnings(spark, folder):
    """The warning as a pattern of two steps."""
    pattern = sequences.Pattern().begin("first", _hot).next("second", _hot).within(WARNING_WITHIN)
    found = sequences.matches(_readings(spark, folder), pattern)
    mean = int_mean(F.col("first.temperature") + F.col("second.temperature"), F.lit(2)).cast("double")
    return sequences.select(
        found, F.col("first.room_id").alias("room_id"), "source", F.col("second.ts").alias("ts"),
        F.col("second.event_id").alias("event_id"), mean.alias("avg_temperature"),
    )


@_query
def pattern_alerts(spark, folder):
    """The alert as a pattern without conditions, whose flat select gives a row or none."""
    pattern = sequences.Pattern().begin("first").next("second").within(ALERT_WITHIN)
    found = sequences.matches(pattern_warnings(spark, folder), pattern, ("source",))
    alert = F.struct(
        F.col("first.room_id").alias("room_id"), "source", F.col("second.ts").alias("ts"),
        F.col("second.event_id").alias("event_id"), F.col("second.avg_temperature").alias("alerted_temperature"),
    )
    rising = F.col("first.avg_temperature") < F.col("second.avg_temperature")
    return sequences.flat_select(found, F.when(rising, F.array(alert)).otherwise(F.array()))


_RISING = (
    sequences.Pattern().begin("low")
    .next("middle", lambda event, taken: event["temperature"] > taken["low"][0]["temperature"])
    .next("high", lambda event, taken: (event["temperature"] > taken["middle"][0]["temperature"]) & (
        event["temperature"] > taken["low"][0]["temperature"] + taken["middle"][0]["temperature"]))
    .within("12 hours")
)


def _rising_rows(found: DataFrame) -> DataFrame:
    return found.select("room_id", "source", *[
        F.col(f"{step}.{field}").alias(f"{step}_{field}") for step in ("low", "middle", "high") for field in ("event_id", "temperature")
    ])


@_query
def rising_triples(spark, folder):
    """Three readings in a row, each above the one before, the last one also above twice the mean of the others."""
    return _rising_rows(sequences.matches(_readings(spark, folder), _RISING, fields=("temperature",)))


@_query
def hot_streaks(spark, folder):
    """Four hot readings in a row of which no two neighbours are equal, then one that is not hot."""
    pattern = (
        sequences.Pattern()
        .begin("hot", lambda event, taken: _hot(event, taken) & (
            event["temperature"] != taken["hot"][-1]["temperature"] if taken["hot"] else F.lit(True)), times=4)
        .next("cool", lambda event, taken: event["temperature"] < WARNING_THRESHOLD)
    )
    found = sequences.matches(_readings(spark, folder), pattern, fields=("temperature",))
    return found.select(
        "room_id", "source", F.to_json(F.transform("hot", lambda row: row["event_id"])).alias("hot_ids"),
        F.aggregate("hot", F.lit(0), lambda total, row: total + row["temperature"]).alias("hot_total"),
        F.col("cool.event_id").alias("cool_id"),
    )


@_query
def rising_runs(spark, folder):
    """Longest runs of rising readings, three or more."""
    found = sequences.runs(
        _readings(spark, folder), lambda before, row: before["temperature"] < row["temperature"],
        {"total": F.sum("temperature")}, at_least=3,
    )
    return found.select(
        "room_id", "source", F.col("first.event_id").alias("first_id"), F.col("last.event_id").alias("last_id"), "n", "total"
    )


# Late rows and corrections


STEP = "5 seconds"


def _judged(spark, folder, delay):
    return lateness.late_rows(arrivals(_readings(spark, folder)), STEP, delay).select(
        "event_id", "ts", "arrival", "watermark", "window_end"
    )


@_query
def late_rows_ascending(spark, folder):
    return _judged(spark, folder, lateness.ASCENDING)


@_query
def late_rows_bounded(spark, folder):
    return _judged(spark, folder, lateness.BOUNDED)


@_query
def late_rows_punctuated(spark, folder):
    return _judged(spark, folder, lateness.PUNCTUATED)


def _corrections(spark, folder):
    return lateness.correction_log(
        arrivals(_readings(spark, folder)), F.col("temperature"), STEP, ("room_id", "source"), lateness.ASCENDING, "2500 milliseconds"
    )


@_query
def corrections(spark, folder):
    """What is sent for each window when late rows still count for a while."""
    return _corrections(spark, folder)


@_query
def corrections_upserted(spark, folder):
    return lateness.upserted(_corrections(spark, folder))


@_query
def corrections_summed(spark, folder):
    return lateness.summed(_corrections(spark, folder), ("room_id",))


# Exactly once


@_query
def committed_points(spark, folder):
    """Points stored in batches: one is sent again, one is staged by a writer that dies, and the first ones are compacted."""
    points_ = points_rooms_temperatures(spark, folder)
    target = CommittedTable(spark, working_path(spark, "committed-points"), ("measurement",))
    batches = [points_.where(F.pmod(F.xxhash64("time"), F.lit(3)) == i) for i in range(3)]
    for number, batch in enumerate(batches):
        target.append(batch, "points", number)
    target.append(batches[1], "points", 1)
    target.stage(batches[2])
    target.compact(keep_newest=1)
    return target.read()


# Meters, distributions and latest values on large data


@_query
def sliding_throughput(spark, folder):
    """Events of the last five seconds, at every second at which their number changes."""
    return meters.sliding_throughput(arrivals(_readings(spark, folder)), keys=("source",))


@_query
def counter_with_restarts(spark, folder):
    """A counter of events that starts anew after every 97 of them, scraped at each event."""
    readings = _readings(spark, folder)
    counted = running_totals(readings, ("source",), READING_ORDER, {"seen": F.lit(1)})
    return meters.counter_rate(counted.withColumn("value", F.col("seen") % 97), WIDTH, keys=("source",))


@_query
def sketched_quantiles(spark, folder):
    """Whether the ranks of quantiles from merged hourly sketches are as exact as they should be."""
    readings = _readings(spark, folder)
    path = working_path(spark, "value-sketches")
    distributions.value_sketches(readings, WIDTH, keys=("room_id",)).write.parquet(path)
    found = distributions.merged_quantiles(spark.read.parquet(path), ("room_id",))
    named = [(q, metrics.quantile_name(q)) for q in metrics.QUANTILES]
    estimates = found.select("room_id", "n", "min", "max", F.inline(F.array(*[
        F.struct(F.lit(name).alias("quantile"), F.lit(q).alias("q"), F.col(name).alias("estimate")) for q, name in named
    ])))
    counts = readings.groupBy("room_id", "temperature").agg(F.count(F.lit(1)).alias("times"))
    ranks = estimates.join(counts, "room_id").groupBy("room_id", "quantile", "q", "n", "min", "max").agg(
        F.sum(F.when(F.col("temperature") < F.col("estimate"), F.col("times")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("temperature") <= F.col("estimate"), F.col("times")).otherwise(0)).alias("up_to"),
    )
    error = distributions.RANK_ERROR * F.col("n") + 1
    exact_enough = (F.col("below") <= F.col("q") * F.col("n") + error) & (F.col("up_to") >= F.col("q") * F.col("n") - error)
    return ranks.select("room_id", "quantile", "n", "min", "max", exact_enough.alias("within_error"))


@_query
def recent_per_room(spark, folder):
    """The figures of the last values of each room and source."""
    recent = distributions.newest_per_key(_readings(spark, folder), PART_ROWS, ("room_id", "source"))
    return recent.groupBy("room_id", "source").agg(
        F.count(F.lit(1)).alias("n"), F.min("temperature").alias("min"), F.max("temperature").alias("max"),
        F.sum("temperature").alias("total"), F.min("event_id").alias("first_id"),
    )


@_query
def latest_table(spark, folder):
    """The latest value per room and source after four batches, one of which is sent twice."""
    points_ = _temperature_points(spark, folder)
    state = LatestTable(spark, working_path(spark, "latest"), horizon=LATEST_WITHIN)
    for number in (0, 1, 1, 2, 3):
        state.merge(points_.where(F.pmod(F.xxhash64("time", "room"), F.lit(4)) == number), "points", number)
    return state.read()


@_query
def bucketed_relation(spark, folder):
    """The ratio by room from stored buckets, without a shuffle."""
    name = f"readings_{uuid.uuid4().hex}"
    buckets.store_buckets(_readings(spark, folder), name, working_path(spark, "buckets"), 8)
    return buckets.bucketed_relation(buckets.layout_session(spark).table(name), WIDTH)


@_query
def stream_texts(spark, folder):
    """Texts of closed windows in the parts that tables have."""
    target = working_path(spark, "texts")
    store_closed_windows(
        _reading_stream(spark, folder),
        lambda rows: windows.window_concat(
            rows, F.col("temperature").cast("string"), DAY, ("source",), separator=" ", part_rows=PART_ROWS),
        target, working_path(spark, "texts-checkpoint"), "texts", DAY, state_rows=50, availableNow=True,
    ).awaitTermination()
    return _ntz(CommittedTable(spark, target).read(), "window_start", "window_end")


@_query
def stream_rising_triples(spark, folder):
    """The pattern of three steps on a stream."""
    target = working_path(spark, "rising")
    store_matches(
        _reading_stream(spark, folder), _RISING, _rising_rows, target, working_path(spark, "rising-checkpoint"), "rising",
        slice_width=STREAM_SLICE, state_rows=50, availableNow=True,
    ).awaitTermination()
    return CommittedTable(spark, f"{target}/{MATCHES}").read()
