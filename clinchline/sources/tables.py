"""Writing and reading the tables of a run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from clinchline import schemas
from clinchline.plans.formats import Format

# rows of one file of a report, and bytes of its row groups, of which a page reads one
REPORT_FILE_ROWS = 1_000_000
REPORT_GROUP_BYTES = 16 << 20
# columns by which pages look up their rows
PAGE_KEYS = ["team_key", "event_key"]
# sizes tried for a bloom filter, each half of the one before: 1 MB (Parquet's most) down to 64 bytes
BLOOM_SIZES = 15

# sort order of each report
REPORT_ORDER = {
    "rankings": ["rank"],
    "events": ["start_date", "name"],
    "event_pages": ["event_key"],
    "team_pages": ["team_key"],
    "team_followers": ["team_key", "following_team_rank"],
    "pages": ["kind", "key"],
}
DIVISION_EVENT_ORDER = ["event_type", "name"]


def save_table(df: DataFrame, path: str, partition_by: list[str], append: bool = False) -> None:
    """Create a table if missing, else append or replace the partitions that ``df`` holds.

    Replacing only those partitions makes a repeated run of a district harmless.
    """
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    if append:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The raw tables saved below ``folder``."""
    return {
        name: spark.read.schema(schema).parquet(f"{folder}/{name}")
        for name, schema in schemas.RAW_TABLES.items()
    }


def with_home(name: str, table: DataFrame, fmt: Format, owners: DataFrame | None) -> DataFrame:
    """A table with the key of its district; a table of events gets it from ``owners``."""
    if owners is not None and not set(fmt.home) <= set(table.columns) and "event_key" in table.columns:
        table = table.join(owners, [c for c in owners.columns if c in table.columns])
    missing = [k for k in fmt.home if k not in table.columns]
    if missing:
        raise ValueError(f"{name} has no {', '.join(missing)}; writing it would erase other districts")
    return table


def write_tables(
    tables: Mapping[str, DataFrame], folder: str, fmt: Format, owners: DataFrame | None = None
) -> None:
    """Write each table by district, so that a run replaces only the districts it holds.

    A table of events that does not name its district gets it from ``owners`` (district and
    event keys, one row per event). One that still has none would erase other runs: an error.
    """
    for name, table in tables.items():
        table = with_home(name, table, fmt, owners)
        spread = [k for k in ("event_key", "team_key") if k in table.columns]
        laid_out = table.repartitionByRange(*fmt.home, *spread)
        save_table(laid_out, f"{folder}/{name}", list(fmt.home))


def write_reports(reports: Mapping[str, DataFrame], folder: str, fmt: Format) -> None:
    """One dataset per report, by district and in display order.

    Range partitions follow the display order, so a large district becomes several sorted
    files instead of one task. Small row groups with bloom filters of the page keys let a page read
    one row group of a large report. A filter is as large as its row group needs: one of full size in
    each file would make many small districts many megabytes.
    """
    for name, report in reports.items():
        order = REPORT_ORDER.get(name, [])
        if not set(order) <= set(report.columns):
            order = DIVISION_EVENT_ORDER
        keys = [*fmt.district, *order] if "region" in report.columns else [*fmt.home, *order]
        laid_out = report.repartitionByRange(*keys).sortWithinPartitions(*keys)
        writer = (
            laid_out.write.partitionBy(*fmt.home)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", REPORT_FILE_ROWS)
            .option("parquet.block.size", REPORT_GROUP_BYTES)
            .option("parquet.bloom.filter.adaptive.enabled", "true")
        )
        for key in PAGE_KEYS:
            if key in report.columns:  # rows of a page are found where the order does not lead to them
                writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(
                    f"parquet.bloom.filter.candidates.number#{key}", BLOOM_SIZES
                )
        writer.parquet(f"{folder}/{name}")
