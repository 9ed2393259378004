"""Storage tables: catalog settings, creation, append, scan, listing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsloom.operators.outcomes import latest_urls
from newsloom.operators.storage import PLACE, place_ranges, unstored
from newsloom.schemas import SEEN_URLS, STORAGE_ROW

# Table properties.
ICEBERG_PROPERTIES = {
    "format-version": "2",
    "write.object-storage.enabled": "true",
    "write.metadata.delete-after-commit.enabled": "true",
    "write.parquet.compression-codec": "zstd",
}
PARQUET_PROPERTIES = {"compression": "zstd"}


@dataclass(frozen=True)
class TableConfig:
    """Where the processed_news table lives.

    ``catalog=None`` uses the session catalog. ``table_format`` is ``parquet``,
    or ``iceberg`` where its runtime jar is on the class path.
    """

    warehouse: str
    namespace: str = "news"
    table: str = "processed_news"
    catalog: str | None = None
    table_format: str = "parquet"
    rest_uri: str = ""
    endpoint: str = ""
    region: str = "us-east-1"

    @property
    def schema_name(self) -> str:
        return ".".join(p for p in (self.catalog, self.namespace) if p)

    @property
    def name(self) -> str:
        return f"{self.schema_name}.{self.table}"

    @property
    def location(self) -> str:
        return f"{self.warehouse.rstrip('/')}/{self.namespace}/{self.table}"

    def catalog_conf(self) -> dict[str, str]:
        """Session settings of an Iceberg REST catalog. Credentials come from the
        cluster's own provider chain."""
        if not self.catalog:
            return {}
        prefix = f"spark.sql.catalog.{self.catalog}"
        return {
            prefix: "org.apache.iceberg.spark.SparkCatalog",
            f"{prefix}.type": "rest",
            f"{prefix}.uri": self.rest_uri,
            f"{prefix}.warehouse": self.warehouse,
            f"{prefix}.io-impl": "org.apache.iceberg.aws.s3.S3FileIO",
            f"{prefix}.s3.endpoint": self.endpoint,
            f"{prefix}.client.region": self.region,
        }


def create_table(spark: SparkSession, config: TableConfig, schema: str = STORAGE_ROW) -> str:
    """Create namespace and table where they are missing; return the table name."""
    root = f"{config.warehouse.rstrip('/')}/{config.namespace}"
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {config.schema_name} LOCATION '{root}'")
    properties = ICEBERG_PROPERTIES if config.table_format == "iceberg" else PARQUET_PROPERTIES
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}{' NOT NULL' if f.name == 'article_id' else ''}"
        for f in StructType.fromDDL(schema)
    )
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    clause = "TBLPROPERTIES" if config.table_format == "iceberg" else "OPTIONS"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {config.name} ({columns}) USING {config.table_format} "
        f"{clause} ({pairs}) LOCATION '{config.location}'"
    )
    return config.name


def _append(fresh: DataFrame, table: str, iceberg: bool) -> int:
    """Append rows in ranges of topic, partition and offset; return their number.

    That keeps the range of every file narrow for the check of a later batch, and lets AQE merge small ranges
    into files of a sensible size. A snapshot carries the number of its records, so only there they are counted before they are written.
    """
    ordered = fresh.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE)
    if iceberg:
        count = fresh.count()
        (ordered.writeTo(table).option("snapshot-property.ingest.source", "newsloom")
         .option("snapshot-property.ingest.records", str(count)).append())
        return count
    counted = Observation()
    ordered.observe(counted, F.count("*").alias("n")).write.format("parquet").mode("append").saveAsTable(table)
    return counted.get["n"]


def append_new(rows: DataFrame, table: str, iceberg: bool = False) -> int:
    """Append the rows whose topic position is not stored yet and return their number.

    A batch that is delivered again after a failure therefore adds nothing.
    """
    # The batch is used several times: for its offset ranges and the append.
    rows = rows.persist()
    try:
        ranges = place_ranges(rows)
        return _append(unstored(rows, rows.sparkSession.table(table), ranges), table, iceberg) if ranges else 0
    finally:
        rows.unpersist()


LEDGER = "query string, batch_id bigint, source_topic string, kafka_partition bigint, low bigint, high bigint, rows bigint"


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException:
        return spark.createDataFrame([], LEDGER)


def append_batch(rows: DataFrame, table: str, ledger: str, query: str, batch_id: int, first: bool, iceberg: bool = False) -> int:
    """Append one batch of a query and note it in the ``ledger``; return the number of rows it added.

    A batch that the ledger names is done and adds nothing, and its rows are not even read. The ledger also knows the highest offset
    stored of each topic and partition: a batch that lies behind it cannot be stored yet and is appended
    without a look at the table. Only the first batch after a start, which may have been appended just before the query ended and
    not been noted, and a batch that goes back behind the ledger are compared with the stored rows.
    """
    spark = rows.sparkSession
    noted = read_ledger(spark, ledger)
    if not noted.filter((F.col("query") == query) & (F.col("batch_id") == batch_id)).isEmpty():
        return 0
    rows = rows.persist()
    try:
        ranges = place_ranges(rows)
        if not ranges:
            return 0
        # One row for each topic and partition.
        highest = {(r[0], r[1]): r.high for r in noted.groupBy(*PLACE[:2]).agg(F.max("high").alias("high")).collect()}
        back = any(r.low <= highest.get((r[0], r[1]), -1) for r in ranges)
        count = _append(unstored(rows, spark.table(table), ranges) if first or back else rows, table, iceberg)
        notes = [(query, batch_id, r[0], r[1], r.low, r.high, count) for r in ranges]
        spark.createDataFrame(notes, LEDGER).coalesce(1).write.mode("append").parquet(ledger)
        return count
    finally:
        rows.unpersist()


def load_seen(spark: SparkSession, path: str, size: int) -> DataFrame:
    """The ``size`` latest registered urls; none when nothing was saved or files are unreadable."""
    try:
        saved = spark.read.schema(SEEN_URLS).option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).parquet(path)
    except AnalysisException:
        saved = spark.createDataFrame([], SEEN_URLS)
    first = saved.groupBy("url_hash").agg(F.min("seq").alias("seq"))
    return latest_urls(first, size)


def save_seen(registered: DataFrame, path: str) -> None:
    """Add the urls of a crawl; a url keeps the place of its first registration."""
    registered.select("url_hash", "seq").write.mode("append").parquet(path)


def scan(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def schemas(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    return spark.sql("SHOW NAMESPACES" + (f" IN {catalog}" if catalog else ""))


def tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {schema}")
