"""sensorstream: sensor-reading analytics on Spark DataFrames and streams.

Parse JSON readings against a fixed schema, label alerts, keep the latest
state per sensor, merge alerts into incidents, derive actuator state, and
write JSON archives and chart-ready panels, in batch or Structured Streaming.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Python code shipped to executors (the controller's pandas functions) is
# pickled by value, so workers do not need this package installed.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from .functions import archive_json, normalise_readings, parse_readings, reading_json
from .operators import *  # noqa: F401,F403
from .operators import __all__ as _ops
from .rules import RULES, VALID_SENSORS
from .schema import ENRICHED_COLUMNS, READING_SCHEMA

__all__ = ["archive_json", "normalise_readings", "parse_readings", "reading_json", "RULES", "VALID_SENSORS",
           "ENRICHED_COLUMNS", "READING_SCHEMA", *_ops]
