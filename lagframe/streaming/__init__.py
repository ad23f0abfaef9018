"""Incremental runs of the batch operators over arriving leg files.

The source pipeline is batch-only. When leg files land continuously, the
same long lag join applies unchanged to a file stream: legs are the
streaming side, the observation index is a static table, and the join is
a stream-static left outer join (no state store, no watermark needed).
``events`` holds what needs state: windows of event time with late data,
and the one-sided lag join of two streams.
"""

from lagframe.streaming.events import lagged_side_stream, late_groups, windowed_measures
from lagframe.streaming.legs import lagged_legs_stream, start_lagged_legs

__all__ = ["lagged_legs_stream", "lagged_side_stream", "late_groups", "start_lagged_legs", "windowed_measures"]
