"""Sources and sinks: driver tables, CSV feeds, samples, report sinks."""

from lagframe.sources.csv import read_feed, write_csv, write_metrics
from lagframe.sources.fixtures import (
    load_table, fixture_legs, fixture_legs_raw, fixture_observations,
    fixture_observations_raw, fixture_stations,
)
from lagframe.sources.sampling import key_bucket, sample_by_key, sample_rows

__all__ = [
    "read_feed", "write_csv", "write_metrics", "load_table", "fixture_legs",
    "fixture_legs_raw", "fixture_observations", "fixture_observations_raw",
    "fixture_stations", "key_bucket", "sample_by_key", "sample_rows",
]
