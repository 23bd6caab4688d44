"""Optional connectors: present only when their package is on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The data source class each optional format needs.
_CLASSES = {
    "avro": "org.apache.spark.sql.avro.AvroFileFormat",
    "protobuf": "org.apache.spark.sql.protobuf.CatalystDataToProtobuf",
    "kafka": "org.apache.spark.sql.kafka010.KafkaSourceProvider",
}


class MissingConnector(RuntimeError):
    """The session has no package for this format."""


def available(spark: SparkSession, name: str) -> bool:
    try:
        spark._jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(_CLASSES[name])
    except Exception:
        return False
    return True


def _require(spark: SparkSession, name: str) -> None:
    if not available(spark, name):
        raise MissingConnector(f"add the spark {name} package to read this source")


def avro_files(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Avro files with a declared schema."""
    _require(spark, "avro")
    return spark.read.format("avro").schema(schema).load(path)


def protobuf_rows(df: DataFrame, column: str, message: str, descriptor: str) -> DataFrame:
    """Decode a binary protobuf column; enums become STRING, oneof members nullable."""
    _require(df.sparkSession, "protobuf")
    from pyspark.sql.protobuf.functions import from_protobuf

    return df.withColumn(column, from_protobuf(column, message, descFilePath=descriptor))


def log_topic(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Message-log topic as a stream of binary keys and values."""
    _require(spark, "kafka")
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
    )
