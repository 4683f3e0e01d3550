"""JDBC tables, JSON snapshots and the exchange-rate feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T


def jdbc_options(url: str, table: str, partition_column: str, lower: int, upper: int, partitions: int, **extra: str) -> dict[str, str]:
    """Options of a parallel JDBC read: the key range is cut into `partitions` queries."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
        **extra,
    }


def jdbc_scan(spark: SparkSession, source: dict[str, str] | str, columns: Sequence[str], where: str | None = None) -> DataFrame:
    """Columns of a table, filtered. source: JDBC options (see jdbc_options), or the folder of a parquet extract.

    Spark hands the columns and the filter down to either.
    """
    if isinstance(source, dict):
        table = spark.read.format("jdbc").options(**source).load()
    else:
        table = spark.read.parquet(source)
    picked = table.where(where) if where else table
    return picked.select(*columns)


def paged_snapshot_scan(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON-lines pages of a record snapshot with a declared schema; each page is one or more splits."""
    return spark.read.schema(schema).json(path)


PAGE_SCHEMA = "model string, count long, offset long, read_no long, records array<{record}>"


def snapshot_pages(spark: SparkSession, path: str, record: str) -> DataFrame:
    """Pages of a record snapshot as the record service gives them, one JSON document a line.

    A page has the model, the number of records that the service declared, its offset, a number that rises from read to read, and its
    records (`record`: their type, with a field id).
    """
    return spark.read.schema(PAGE_SCHEMA.format(record=record)).json(path)


def snapshot_records(pages: DataFrame) -> DataFrame:
    """The records of all pages; of one that came several times (a page read again, pages that overlap) the copy read last counts."""
    rows = pages.select("model", "read_no", F.posexplode("records").alias("place", "record"))
    latest = Window.partitionBy("model", "record.id").orderBy(F.desc("read_no"), F.desc("place"))
    return rows.withColumn("n", F.row_number().over(latest)).where("n = 1").select("model", "record.*")


def snapshot_findings(pages: DataFrame) -> DataFrame:
    """(model, finding, first, behind): what is wrong with the pages of a model, as ranges [first, behind) of offsets.

    'missing': no page holds these records, up to the number declared last; 'repeated': an earlier page in the order of offsets holds them already;
    'undeclared': pages go on behind that number. Only offsets and sizes are looked at, one row a page.
    """
    spans = pages.select("model", "read_no", F.col("count").alias("declared"), F.col("offset").alias("first"), (F.col("offset") + F.size("records")).alias("behind"))
    earlier = Window.partitionBy("model").orderBy("first", "behind", "read_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = spans.withColumn("reached", F.coalesce(F.max("behind").over(earlier), F.lit(0)))
    ends = spans.groupBy("model").agg(F.max_by("declared", "read_no").alias("declared"), F.max("behind").alias("reached"))

    def found(rows: DataFrame, finding: str, first: Column, behind: Column) -> DataFrame:
        return rows.where(first < behind).select("model", F.lit(finding).alias("finding"), first.alias("first"), behind.alias("behind"))

    first, behind, reached, declared = (F.col(c) for c in ("first", "behind", "reached", "declared"))
    return (
        found(placed, "missing", reached, first)
        .unionByName(found(placed, "repeated", first, F.least(behind, reached)))
        .unionByName(found(ends, "missing", reached, declared))
        .unionByName(found(ends, "undeclared", declared, reached))
    )


FEED_SCHEMA = "responseContent array<struct<currency_id: string, period: string, selling: string>>"


def rate_feed_scan(raw: DataFrame, currencies: Sequence[str] = ("USD", "MYR", "CNY"), column: str = "json") -> DataFrame:
    """Rates of the wanted currencies out of feed documents."""
    kept = [c for c in raw.columns if c != column]
    items = raw.select(*kept, F.explode(F.from_json(column, FEED_SCHEMA).getField("responseContent")).alias("item"))
    return items.where(F.col("item.currency_id").isin(*currencies)).select(*kept, "item.*")
