"""Sources: Kafka/file event streams, delimited dimension files, tables, fixtures."""

from fleetlake.sources.files import read_csv_typed, read_delimited  # noqa: F401
from fleetlake.sources.kafka import decode_kafka, read_events_stream, replay  # noqa: F401
