"""The layout by room: no shuffle after the rows have been stored."""

import re
import uuid

import pytest
from conftest import SF, same_rows

from thermoflow.operators import relation, windows
from thermoflow.sinks import buckets
from thermoflow.sources.events import readings_from_events, table


def exchanges(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return len(re.findall(r"Exchange", text))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    given = readings_from_events(table(spark, SF, "events"))
    name = f"readings_{uuid.uuid4().hex}"
    buckets.store_buckets(given, name, str(tmp_path_factory.mktemp("buckets") / "t"), 8)
    return given, buckets.layout_session(spark).table(name)


def test_averages_and_relation_without_a_shuffle(stored):
    given, laid_out = stored
    found = buckets.bucketed_relation(laid_out, "1 hour")
    assert exchanges(found) == 0
    same_rows(found, relation.relation_by_join(given, "1 hour"))
    means = buckets.bucketed_means(laid_out, "1 hour")
    assert exchanges(means) == 0
    same_rows(means.drop("span"), windows.window_mean(given, "1 hour").drop("window_start"))


def test_a_hot_room_is_spread(stored):
    _, laid_out = stored
    assert laid_out.where("room_id = '1'").select("span").distinct().count() > 3
    with pytest.raises(ValueError):
        buckets.bucketed_means(laid_out, "5 hours")


def test_empty_and_null_rooms(spark, tmp_path, readings):
    df = readings([(None, "IN", 0, 4), (None, "OUT", 1, 2), ("a", "IN", 0, None)])
    name = f"readings_{uuid.uuid4().hex}"
    means = buckets.bucketed_means(buckets.store_buckets(df, name, str(tmp_path / "t"), 2), "5 seconds")
    assert {(r.room_id, r.avg_temperature) for r in means.collect()} == {(None, 3.0), ("a", None)}
    empty = buckets.store_buckets(df.limit(0), f"e_{name}", str(tmp_path / "e"), 2)
    assert buckets.bucketed_relation(empty, "5 seconds").count() == 0
