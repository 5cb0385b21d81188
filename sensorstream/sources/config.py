"""Connection settings: ``key=value`` properties -> Spark Kafka options."""

from __future__ import annotations

import os

# Fixed values (kept so existing deployments work unchanged): default broker,
# topic names and properties file name.
DEFAULT_BOOTSTRAP = "localhost:9092"
INPUT_TOPIC = "IOT_sensor"
ARCHIVE_TOPIC = "IOT_archive"
PROPERTIES_FILE = "./working.properties"


def parse_properties(text: str) -> dict[str, str]:
    """Parse ``key=value`` lines; blank lines and ``#`` comment lines skipped.

    A value that is itself a comment (``key= # fill in``) counts as empty.
    """
    conf: dict[str, str] = {}
    for line in text.splitlines():
        line = line.strip()
        if not line or line.startswith("#") or "=" not in line:
            continue
        key, value = line.split("=", 1)
        value = value.strip()
        conf[key.strip()] = "" if value.startswith("#") else value
    return conf


def read_config(path: str = PROPERTIES_FILE) -> dict[str, str]:
    """Properties file -> dict; a missing file gives ``{}``."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as fh:
        return parse_properties(fh.read())


def _jaas_quote(value: str) -> str:
    """Escape a value for a double-quoted JAAS option."""
    return value.replace("\\", "\\\\").replace('"', '\\"')


def kafka_options(conf: dict[str, str], topic: str | None = INPUT_TOPIC, starting: str | None = "latest") -> dict[str, str]:
    """Spark Kafka source/sink options.

    SASL_SSL with PLAIN and a JAAS line only when both user and password are
    set, else PLAINTEXT defaults. ``topic`` subscribes (source); pass
    ``topic=None`` for a sink and set the topic on the writer.
    """
    opts = {"kafka.bootstrap.servers": conf.get("bootstrap.servers") or DEFAULT_BOOTSTRAP}
    if topic:
        opts["subscribe"] = topic
    if starting:
        opts["startingOffsets"] = starting
    user, password = conf.get("sasl.username"), conf.get("sasl.password")
    if user and password:
        user, password = _jaas_quote(user), _jaas_quote(password)
        opts["kafka.security.protocol"] = "SASL_SSL"
        opts["kafka.sasl.mechanism"] = "PLAIN"
        opts["kafka.sasl.jaas.config"] = (
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            f'username="{user}" password="{password}";'
        )
    return opts
