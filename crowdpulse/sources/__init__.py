from crowdpulse.sources.files import read_event_files, read_events_with_arrival, read_static_tables
from crowdpulse.sources.wire import parse_events, read_kafka, read_text_stream

__all__ = [
    "parse_events",
    "read_event_files",
    "read_events_with_arrival",
    "read_kafka",
    "read_static_tables",
    "read_text_stream",
]
