"""The headline table in the catalog."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from presslake.schemas import FINAL_HEADLINE, FINAL_PARTITIONS

AT_ONCE = 200  # partitions in a statement


def register_final(spark: SparkSession, table: str, location: str) -> None:
    """Create the table if need be and take in the partitions found on storage.

    This lists the whole table; after a run that has written some partitions
    ``register_written`` is enough.
    """
    create_final(spark, table, location)
    refresh_partitions(spark, table)


def create_final(spark: SparkSession, table: str, location: str) -> None:
    """Create the table if need be, without partitions. Partition columns are declared
    as strings, so that ``05`` stays ``05``."""
    columns = ", ".join(f"{name} STRING" for name in (*FINAL_HEADLINE.names, *FINAL_PARTITIONS))
    spark.sql(
        f"""
        CREATE TABLE IF NOT EXISTS {table} ({columns}) USING csv
        OPTIONS (header 'true', sep ';', escape '"', multiLine 'true', nullValue '\\u0000')
        PARTITIONED BY ({", ".join(FINAL_PARTITIONS)})
        LOCATION '{location}'
        """
    )


def refresh_partitions(spark: SparkSession, table: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")


def list_partitions(spark: SparkSession, table: str) -> DataFrame:
    """What the catalog knows: one row ``periodico=../year=../month=../day=..`` each."""
    return spark.sql(f"SHOW PARTITIONS {table}")


def _spec(values: Sequence[str]) -> str:
    quoted = [value.replace("\\", "\\\\").replace("'", "\\'") for value in values]
    return "PARTITION (" + ", ".join(f"{n} = '{v}'" for n, v in zip(FINAL_PARTITIONS, quoted)) + ")"


def _located(values: Sequence[str], location: str) -> str:
    quoted = location.replace("'", "\\'")
    return f"{_spec(values)} LOCATION '{quoted}'"


def _known(spark: SparkSession, table: str) -> set[tuple[str, ...]]:
    """The partitions in the catalog, by name alone."""
    rows = list_partitions(spark, table).collect()  # what the catalog holds in memory too
    return {tuple(unquote(part.split("=", 1)[1]) for part in row[0].split("/")) for row in rows}


def partition_places(
    spark: SparkSession, table: str, partitions: Iterable[Sequence[str]] | None = None
) -> dict[tuple[str, ...], str]:
    """Where the catalog says that the table's partitions (or some) lie."""
    wanted = _known(spark, table) if partitions is None else {tuple(p) for p in partitions}
    places = {}
    for values in sorted(wanted):
        try:
            rows = spark.sql(f"DESCRIBE FORMATTED {table} {_spec(values)}").collect()
        except AnalysisException as error:
            if error.getCondition() != "PARTITIONS_NOT_FOUND":
                raise
            continue
        places[values] = next(row.data_type for row in rows if row.col_name == "Location")
    return places


def place_partitions(spark: SparkSession, table: str, places: Mapping[Sequence[str], str]) -> None:
    """Point partitions to their places; readers see each change whole."""
    for values, location in places.items():
        spark.sql(f"ALTER TABLE {table} {_spec(values)} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)


def register_written(spark: SparkSession, table: str, places: Mapping[Sequence[str], str]) -> None:
    """Take in partitions that a run has written, by their places; nothing is listed.

    Those the catalog has not are added, ``AT_ONCE`` in a statement; those that lie
    elsewhere, as after compaction, point to what was written.
    """
    places = {tuple(values): location for values, location in places.items()}
    known = _known(spark, table)
    new = [values for values in sorted(places) if values not in known]
    for i in range(0, len(new), AT_ONCE):
        some = " ".join(_located(values, places[values]) for values in new[i : i + AT_ONCE])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {some}")
    held = partition_places(spark, table, [values for values in places if values in known])
    moved = {v: places[v] for v, at in held.items() if at.rstrip("/") != places[v].rstrip("/")}
    if moved:
        place_partitions(spark, table, moved)
    else:
        spark.catalog.refreshTable(table)
