"""Every registered query against its SQL, and the sliced forms against the same SQL."""

import pytest
from conftest import SF
from oracle_check import connect, differences

from thermoflow.model import READING_ORDER
from thermoflow.operators import ordered, patterns, running, windows
from thermoflow.plans import registered
from thermoflow.plans.oracles import oracle_sql
from thermoflow.sources.events import readings_from_events, table

QUERIES, ORACLES = registered.registered(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, ORACLES[name]) is None


SLICED = {
    "warnings_exact": lambda r, s: patterns.warnings(r, within=registered.WARNING_WITHIN, exact=True, slices=s),
    "alerts_by_room": lambda r, s: patterns.alerts(
        patterns.warnings(r, within=registered.WARNING_WITHIN, slices=s), registered.ALERT_WITHIN, "room", s),
    "running_mean": lambda r, s: running.running_mean(r, slices=s),
    "int_avg_values": lambda r, s: windows.window_int_mean_values(
        r, registered.DAY, part_rows=registered.PART_ROWS, slices=s),
}


@pytest.mark.parametrize("name", sorted(SLICED))
def test_sliced_form(spark, duck, name):
    readings = readings_from_events(table(spark, SF, "events"))
    slices = ordered.plan_slices(readings, READING_ORDER, 60, span="3650 days")
    assert slices.count > 10
    assert differences(SLICED[name](readings, slices), duck, ORACLES[name]) is None
