"""The message broker source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def broker_options(servers: str, login: str | None = None) -> dict[str, str]:
    """How to reach the broker; ``login`` is a JAAS entry for SASL/PLAIN over TLS."""
    options = {"kafka.bootstrap.servers": servers}
    if login:
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": login,
        }
    return options


def message_options(
    servers: str,
    topic: str,
    group: str | None = None,
    login: str | None = None,
    starting: str = "latest",
    fail_on_data_loss: bool = False,
    **more: str,
) -> dict[str, str]:
    """Options of the ``kafka`` source for one topic.

    ``starting`` counts only for a stream's first start; afterwards its checkpoint
    decides. ``more`` passes anything else on, of which ``maxOffsetsPerTrigger``
    (a bound on the micro-batch after an outage) and ``minPartitions`` (several
    tasks per broker partition, for a topic with one hot partition) matter at
    scale.
    """
    options = broker_options(servers, login) | {
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if group:
        options["kafka.group.id"] = group
    return options | more


def read_messages(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Unbounded message envelopes; needs the Kafka connector on the classpath."""
    return spark.readStream.format("kafka").options(**options).load()


def send_messages(encoded: DataFrame, topic: str, options: dict[str, str]) -> None:
    """Publish a batch of ``key, value`` rows; needs the Kafka connector too."""
    encoded.write.format("kafka").options(**options).option("topic", topic).save()
