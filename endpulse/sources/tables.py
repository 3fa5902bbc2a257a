"""Readers of the input tables. No schema is ever inferred."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.containment import parse_networks, rejected_networks
from ..schemas import CONVERTED, GEO_NETWORKS


def read_or_empty(spark, path, schema, fmt="parquet", **options):
    """A table with a fixed schema; an empty one where nothing is stored yet."""
    try:
        return spark.read.schema(schema).options(**options).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_payloads(spark, path):
    """Landed payload files: (source, content, arrived).

    A file is named by its source's link, percent-encoded. Spark lists no
    empty files, so an empty payload is as if it had not been fetched.
    """
    return payload_columns(spark.read.format("binaryFile").load(path))


def payload_columns(files):
    name = F.substring_index("path", "/", -1)
    # The path is a URI, so a '%' in the file name comes encoded once more.
    source = F.try_url_decode(F.try_url_decode(name))
    return files.select(
        F.coalesce(source, name).alias("source"), "content",
        F.unix_millis("modificationTime").alias("arrived"))


def network_lines(lines):
    """Lines of a network list without blanks, empty lines and # comments; other columns stay."""
    return lines.withColumn("line", strip(F.col("line"))).where(
        (F.col("line") != "") & ~F.col("line").startswith("#"))


def numbered_lines(spark, path):
    """(file, line_no from 1, line) of text files; each file is read as one row."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", "\r\n|\n|\r")).alias("at", "line"))
    return files.select("file", (F.col("at") + 1).alias("line_no"), "line")


def read_networks(spark, path):
    """(networks, rejected lines with their file and number) of text files with one network per line."""
    lines = network_lines(numbered_lines(spark, path))
    return parse_networks(lines), rejected_networks(lines).select("file", "line_no", "line")


def read_geo_networks(spark, path, fmt="parquet", **options):
    """Geo networks; without a file every label is NULL."""
    return read_or_empty(spark, path, GEO_NETWORKS, fmt, **options)


def read_converted(spark, path, fmt="parquet", **options):
    """The link converter's output, one row per link."""
    return read_or_empty(spark, path, CONVERTED, fmt, **options)
