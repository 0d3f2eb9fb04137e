"""Ready-made publishers, configured by the options of a route.

Network destinations take a transport factory from the caller: a picklable
function without arguments that, inside a task, returns ``send(record) -> status``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.values import FALSE_WORDS, TRUE_WORDS
from ..schemas import KAFKA_PREFIX, MAX_DATAGRAM, PUBSUB_CHANNEL, STREAM_PREFIX
from . import files, records
from .deliver import DEFAULT_RETRIES, callback_status, deliver, python_deliver, webhook_deliver
from .publisher import Publisher

Transport = Callable[[], Callable[[dict], "int | None"]]


def option_int(options: Mapping[str, str], key: str, default: int) -> int:
    """Leading digits of a setting, 0 when there are none."""
    text = options.get(key)
    if text is None:
        return default
    digits = re.match(r"\s*([-+]?\d+)", text)
    return int(digits.group(1)) if digits else 0


def option_bool(options: Mapping[str, str], key: str, default: bool) -> bool:
    """A known word in any case, else the default."""
    word = (options.get(key) or "").lstrip(" \t\n\r").lower()
    return True if word in TRUE_WORDS else False if word in FALSE_WORDS else default


class Configured(Publisher):
    """Keeps the options and checks that the required ones are there."""

    required: tuple[str, ...] = ()

    def __init__(self, name: str):
        self.name = name
        self.options: Mapping[str, str] = {}

    def init(self, options: Mapping[str, str]) -> None:
        missing = [k for k in self.required if options.get(k) is None]
        if missing:
            raise ValueError(f"publisher {self.name} lacks {', '.join(missing)}")
        self.options = options


class FilePublisher(Configured):
    """JSON lines below ``file_path``; a repeated batch replaces its own files.

    With ``rotate_max_events`` rotation goes on across batches, else each batch
    has a folder.
    """

    required = ("file_path",)

    def publish_batch(self, batch: DataFrame, batch_id: int) -> None:
        path = self.options["file_path"].rstrip("/")
        max_events = option_int(self.options, "rotate_max_events", 0)
        if max_events > 0:
            files.append_jsonl(batch, path, batch_id, max_events,
                               option_int(self.options, "rotate_max_files", files.DEFAULT_MAX_FILES))
        else:
            files.write_jsonl(batch, f"{path}/batch-{batch_id:09d}")


class KafkaPublisher(Configured):
    required = ("bootstrap_servers",)

    def shape(self, batch: DataFrame) -> DataFrame:
        return records.kafka_records(
            batch, self.options.get("topic_prefix", KAFKA_PREFIX), option_bool(self.options, "topic_per_table", False))

    def publish_batch(self, batch: DataFrame, batch_id: int) -> None:
        files.write_kafka(
            self.shape(batch), self.options["bootstrap_servers"], self.options.get("compression", "snappy"),
            option_int(self.options, "batch_bytes", 262144), option_int(self.options, "linger_ms", 10),
            option_int(self.options, "delivery_timeout_ms", 120_000))


class AuditPublisher(Configured):
    """Rows of the audit table: by JDBC when ``url`` is set, else a catalog table."""

    required = ("table",)

    def publish_batch(self, batch: DataFrame, batch_id: int) -> None:
        ts = "ts" if "ts" in batch.columns else None
        if "url" in self.options:
            login = {"user": "username", "password": "password", "driver": "driver"}
            properties = {k: self.options[o] for k, o in login.items() if o in self.options}
            files.write_audit_jdbc(batch, self.options["url"], self.options["table"], properties, ts)
        else:
            files.write_audit(batch, self.options["table"], self.options.get("path"), ts)


class Delivering(Configured):
    """A destination reached through an injected transport."""

    payload = "json"

    def __init__(self, name: str, transport: Transport):
        super().__init__(name)
        self.transport = transport

    def shape(self, batch: DataFrame) -> DataFrame:
        raise NotImplementedError

    def publish_batch(self, batch: DataFrame, batch_id: int) -> DataFrame:
        return deliver(self.shape(batch), self.name, self.transport, self.payload)


class RedisPublisher(Delivering):
    """Stream records with ``use_streams``, else messages on one channel."""

    payload = "message"

    def shape(self, batch: DataFrame) -> DataFrame:
        if option_bool(self.options, "use_streams", False):
            stream = records.redis_stream_records(batch, self.options.get("stream_prefix", STREAM_PREFIX))
            return stream.select("*", F.col("fields")["json"].alias("message"))
        return records.pubsub_records(batch, self.options.get("channel", PUBSUB_CHANNEL))


class SyslogPublisher(Delivering):
    payload = "message"

    def shape(self, batch: DataFrame) -> DataFrame:
        return records.syslog_records(
            batch, option_bool(self.options, "format_compact", False),
            self.options.get("facility"), self.options.get("priority"))


class DatagramPublisher(Delivering):
    """Sends what fits and reports the rest as dropped."""

    required = ("udp_host", "udp_port")
    payload = "packet"

    def publish_batch(self, batch: DataFrame, batch_id: int) -> DataFrame:
        fits, oversize = records.datagram_records(
            batch, option_int(self.options, "max_packet_size", MAX_DATAGRAM),
            self.options.get("add_newline") not in ("no", "false", "0"))
        dropped = oversize.selectExpr(
            f"'{self.name}' as publisher", "log_file", "position", "false as ok", "true as dropped",
            "0 as attempts", "cast(null as int) as status", "0L as bytes", "'larger than a packet' as error")
        return deliver(fits, self.name, self.transport, self.payload).unionByName(dropped)


class MessagePublisher(Delivering):
    required = ("endpoint",)
    payload = "payload"

    def shape(self, batch: DataFrame) -> DataFrame:
        return records.topic_messages(batch, option_bool(self.options, "subscriber_filtering", False))


class WebhookPublisher(Delivering):
    required = ("webhook_url",)

    def publish_batch(self, batch: DataFrame, batch_id: int) -> DataFrame:
        return webhook_deliver(
            batch, self.transport, option_int(self.options, "retry_count", DEFAULT_RETRIES),
            self.options.get("auth_token"), publisher=self.name)


class ConsolePublisher(Configured):
    def publish_batch(self, batch: DataFrame, batch_id: int) -> None:
        files.write_console(batch)


class PythonPublisher(Configured):
    """User callbacks on a script object; ``on_*_method`` options name them.

    Life-cycle hooks run on the driver, the event hook inside tasks.
    """

    def __init__(self, name: str, script: object):
        super().__init__(name)
        self.script = script

    def hook(self, which: str):
        return getattr(self.script, self.options.get(f"on_{which}_method", f"on_{which}"), None)

    def call(self, which: str, *args) -> None:
        hook = self.hook(which)
        if hook is not None and callback_status(hook(*args)) != 200:
            raise RuntimeError(f"on_{which} of publisher {self.name} failed")

    def init(self, options: Mapping[str, str]) -> None:
        super().init(options)
        if not callable(self.hook("event")):
            raise ValueError(f"publisher {self.name} has no event callback")
        self.call("init", dict(options))

    def start(self) -> None:
        self.call("start")

    def publish_batch(self, batch: DataFrame, batch_id: int) -> DataFrame:
        return python_deliver(batch, self.hook("event"), self.name)

    def stop(self) -> None:
        self.call("stop")

    def cleanup(self) -> None:
        self.call("cleanup")

    def health_check(self) -> bool:
        try:
            self.call("health")
            return True
        except Exception:
            return False


# Route sinks by name.  A sink in the second group needs a transport, one in the
# third a script object.
PLAIN = {"file": FilePublisher, "kafka": KafkaPublisher, "mysql": AuditPublisher, "example": ConsolePublisher}
NETWORK = {"redis": RedisPublisher, "syslog": SyslogPublisher, "udp": DatagramPublisher, "zmq": MessagePublisher,
           "webhook": WebhookPublisher}
SCRIPTED = {"python": PythonPublisher}


def build_publishers(
    routes: DataFrame,
    transports: Mapping[str, Transport] | None = None,
    scripts: Mapping[str, object] | None = None,
) -> dict[str, Publisher]:
    """Initialised publishers of all active routes, by name.

    ``transports`` and ``scripts`` are looked up by publisher name.
    """
    built: dict[str, Publisher] = {}
    for r in routes.where("active").select("publisher", "sink", "options").toLocalIterator():
        if r.sink in PLAIN:
            publisher = PLAIN[r.sink](r.publisher)
        elif r.sink in NETWORK and r.publisher in (transports or {}):
            publisher = NETWORK[r.sink](r.publisher, transports[r.publisher])
        elif r.sink in SCRIPTED and r.publisher in (scripts or {}):
            publisher = SCRIPTED[r.sink](r.publisher, scripts[r.publisher])
        else:
            raise ValueError(f"publisher {r.publisher}: no sink, transport or script for '{r.sink}'")
        publisher.init(r.options or {})
        built[r.publisher] = publisher
    return built
