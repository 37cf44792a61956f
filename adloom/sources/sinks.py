"""Views and tables that models are written to."""

from __future__ import annotations

import getpass
import posixpath
import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from adloom.sources.versions import current_folder, new_folder_version, new_table_version


@dataclass(frozen=True)
class Layout:
    """Day partitions, and the columns rows are sorted by within a day."""

    partition: str = "date"
    cluster: tuple[str, ...] = ()


CABINET_LAYOUT = Layout(cluster=("is_realweb", "is_ret_campaign"))
INSTALLS_LAYOUT = Layout(cluster=("is_realweb", "is_ret_campaign", "source"))


# The environment that writes tables, and the schema that only it may write to.
PRODUCTION = "prod"
PRODUCTION_SCHEMA = "production"
AUDIT = "_audit"


def identifier_parts(name: str) -> list[str]:
    """The parts of a name like ``catalog.`schema```, without their quotes."""
    part = r"\s*(?:`((?:[^`]|``)+)`|([^`.\s]+))\s*"
    if not re.fullmatch(rf"{part}(?:\.{part})*", name):
        raise ValueError(f"{name!r} is no name of a schema")
    return [
        quoted.replace("``", "`") if quoted else plain
        for quoted, plain in re.findall(rf"{part}(?:\.|$)", name)
    ]


@dataclass(frozen=True)
class Target:
    """An environment: ``prod`` writes tables, any other name makes staging models views.

    Tables go to ``folder/schema/model`` as Parquet, or to the catalog without a folder.  Only
    ``prod`` may write to the production schema, as a run replaces the tables it finds there; the
    schema counts as it is resolved, whatever catalog, quotes, case or folder it is spelled with.
    """

    name: str
    schema: str
    folder: str | None = None

    def __post_init__(self) -> None:
        parts = identifier_parts(self.schema)
        places = [parts[-1]]
        if self.folder is not None:
            if len(parts) > 1 or not re.fullmatch(r"\w+", parts[0]):
                raise ValueError(f"schema {self.schema} is no plain name for a folder")
            # Models of a schema that lies in the production schema's folder would be found there.
            places.append(posixpath.basename(posixpath.normpath(unquote(self.folder.strip()))))
        own = {place.strip().lower().removesuffix(AUDIT) for place in places}
        if PRODUCTION_SCHEMA in own and self.name != PRODUCTION:
            raise ValueError(f"target {self.name} must not write to schema {self.schema}")

    @classmethod
    def of(cls, name: str, schema: str | None = None, folder: str | None = None) -> Target:
        """A target whose schema follows from its name: every developer has one of their own."""
        if schema is None:
            user = re.sub("[^a-z0-9]+", "_", getpass.getuser().lower())
            schema = PRODUCTION_SCHEMA if name == PRODUCTION else f"{name}_{user}"
        return cls(name, schema, folder)

    @property
    def writes_tables(self) -> bool:
        return self.name == PRODUCTION

    def path(self, model: str) -> str:
        return f"{self.folder.rstrip('/')}/{self.schema}/{model}"


def arranged(frame: DataFrame, layout: Layout) -> DataFrame:
    """Bring each day's rows together and sort them, so that scans can skip row groups.

    The rebalance hint lets adaptive execution merge small days into one task and split a day
    that is too large for one; a plain repartition by day would write a hot day in one task.
    """
    return frame.hint("rebalance", layout.partition).sortWithinPartitions(
        layout.partition, *layout.cluster
    )


def write_table(
    frame: DataFrame, model: str, target: Target, layout: Layout | None = None
) -> DataFrame:
    """Replace the table of a model and return a scan of it in the model's column order.

    The new rows are written as a version of their own, which then takes the table's place at once.
    """
    spark = frame.sparkSession
    writer = (arranged(frame, layout) if layout else frame).write
    if layout:
        writer = writer.partitionBy(layout.partition)
    if target.folder is not None:
        with new_folder_version(spark, target.path(model)) as folder:
            writer.parquet(folder)
        # The schema is given: Spark would guess the type of the partition column.
        written = spark.read.schema(frame.schema).parquet(folder)
    else:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {target.schema}")
        with new_table_version(spark, target.schema, model) as table:
            writer.format("parquet").saveAsTable(table)
        written = spark.table(table)
    return written.select(*frame.columns)


def write_view(frame: DataFrame, model: str) -> DataFrame:
    frame.createOrReplaceTempView(model)
    return frame.sparkSession.table(model)


def materialize(
    frame: DataFrame,
    model: str,
    target: Target,
    layout: Layout | None = None,
    always_table: bool = False,
) -> DataFrame:
    """Write a model where the environment wants it and return what readers will see."""
    if target.writes_tables or always_table:
        return write_table(frame, model, target, layout if target.writes_tables else None)
    return write_view(frame, model)


def read_model(
    spark: SparkSession, model: str, target: Target, schema: StructType
) -> DataFrame:
    """Scan a model that another job wrote as a table, in the model's column order."""
    if target.folder is not None:
        folder = current_folder(spark, target.path(model))
        stored = spark.read.schema(schema).parquet(folder)
    else:
        stored = spark.table(f"{target.schema}.{model}")
    return stored.select(*schema.names)
