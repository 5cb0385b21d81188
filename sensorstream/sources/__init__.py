"""Sources and sinks (Kafka, message files, history tables)."""

from .config import ARCHIVE_TOPIC, INPUT_TOPIC, kafka_options, parse_properties, read_config
from .fixtures import control_readings, events, field_control, field_messages, field_readings, raw_messages, tick_readings
from .manifest import append_history, history_count, history_end, history_stream, read_history, recent_history
from .readers import history, read_messages, read_readings, spread_small_input
from .sinks import for_each_batch, publish_readings, write_archive, write_history

__all__ = [
    "ARCHIVE_TOPIC", "INPUT_TOPIC", "kafka_options", "parse_properties", "read_config",
    "control_readings", "events", "field_control", "field_messages", "field_readings", "raw_messages", "tick_readings",
    "append_history", "history_count", "history_end", "history_stream", "read_history", "recent_history",
    "history", "read_messages", "read_readings", "spread_small_input",
    "for_each_batch", "publish_readings", "write_archive", "write_history",
]
