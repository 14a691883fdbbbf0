"""Schemas of the record types that travel between operators."""

from __future__ import annotations

READING = "room_id string, source string, ts timestamp, temperature int, event_id bigint"
WARNING = "room_id string, source string, ts timestamp, event_id bigint, avg_temperature double"
ALERT = "room_id string, source string, ts timestamp, event_id bigint, alerted_temperature double"
POINT = "measurement string, time timestamp, room string, source string, value double"
MESSAGE = "sender string, recipient string, sentAt bigint, message string"
RAW_RECORD = "key binary, value binary, timestamp timestamp"

# Arrival order of readings: event time, then a unique id for equal times.
READING_ORDER = ("ts", "event_id")
