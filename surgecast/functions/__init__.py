from surgecast.functions import fixed_values
from surgecast.functions.columns import (
    congestion_band,
    epoch_millis,
    event_time,
    in_comma_list,
    truncated_int,
)

__all__ = [
    "fixed_values",
    "congestion_band",
    "epoch_millis",
    "event_time",
    "in_comma_list",
    "truncated_int",
]
