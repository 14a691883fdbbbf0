from thermoflow.functions.encoding import line_protocol
from thermoflow.functions.numeric import band, clamp, int_mean, ratio, room_partition
from thermoflow.functions.text import parts_of, split_tokens
from thermoflow.functions.time import as_micros

__all__ = [
    "as_micros", "band", "clamp", "int_mean", "line_protocol", "parts_of", "ratio",
    "room_partition", "split_tokens",
]
