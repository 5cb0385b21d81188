"""Column-level functions: parsing, time arithmetic, JSON, normalisation."""

from .parse import parse_readings, event_time_of, value_as_text
from .time import epoch_micros, from_epoch_micros, to_instant, from_instant, display_time, as_interval_micros
from .jsonio import archive_json, reading_json, parse_archive
from .normalise import normalise_readings, measure

__all__ = [
    "parse_readings", "event_time_of", "value_as_text",
    "epoch_micros", "from_epoch_micros", "to_instant", "from_instant", "display_time", "as_interval_micros",
    "archive_json", "reading_json", "parse_archive",
    "normalise_readings", "measure",
]
