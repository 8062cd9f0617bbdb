"""Event sources: files (CSV / Parquet / JSON), JDBC, Kafka and the test-data adapter."""

from matchstream.sources.files import read_events_csv, read_events_parquet
from matchstream.sources.testdata import load_match_events_from_testdata

__all__ = ["read_events_csv", "read_events_parquet", "load_match_events_from_testdata"]
