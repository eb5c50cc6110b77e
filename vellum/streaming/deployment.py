"""Schemas, tables and views of a deployment: defined once, found by later sessions, reset as a whole.

Definitions (view texts included) are rows of a small table under the
deployment's root; the newest row of a name counts.  ``open_deployment`` creates
schemas, tables and views of them in the session's catalog, views after
what they need, so a new session or application finds all of them.

Tables, checkpoints and history of a deployment lie in one folder, its generation.
``reset`` drops the views and table entries and publishes a new, empty generation
in one commit.  Tables and the checkpoints that say what was read into them
so always begin anew together; one that dies before the commit has changed no
data, and the next ``open_deployment`` restores the entries.  The old generation's
files stay.  One writer at a time, as for every published table.

Spark's in-session catalog holds the entries; no metastore is needed, and where a
cluster has one, the same statements go there.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.operators.catalog import PROCESSED_SCHEMA, QUARANTINE_SCHEMA, RAW_SCHEMA, create_table, read_table
from vellum.operators.published import current, publish
from vellum.session import qualified
from vellum.streaming.steps import PipelineRoot

DEFINITIONS = T.StructType([
    T.StructField("n", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("needs", T.ArrayType(T.StringType())),
])
# Tables of every generation: name, folder (an attribute of PipelineRoot) and schema.
TABLES = (("pdf_raw_file_catalog", "raw", RAW_SCHEMA), ("pdf_processed_file_catalog", "processed", PROCESSED_SCHEMA),
          ("pdf_quarantine", "quarantine", QUARANTINE_SCHEMA))


@dataclass(frozen=True)
class Deployment:
    """A root folder and the schema its tables and views are named in."""
    root: str
    schema: str

    def __post_init__(self):
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", self.schema):
            raise ValueError(f"not a schema name: {self.schema!r}")

    @property
    def definitions(self) -> str:
        return f"{self.root}/definitions"

    @property
    def location(self) -> str:
        """The schema's own folder holds nothing: DROP DATABASE deletes it, and must not reach tables or definitions."""
        return f"{self.root}/schema"

    def name(self, of: str) -> str:
        return f"`{self.schema}`.`{of}`"


def create_schema(spark: SparkSession, name: str, location: str) -> None:
    """CREATE DATABASE IF NOT EXISTS at ``location``; a schema of that name elsewhere is an error, not reused."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{location}'")
    there = spark.catalog.getDatabase(name).locationUri
    if qualified(spark, there) != qualified(spark, location):
        raise ValueError(f"schema {name} lies at {there}, not at {location}")


def generation(spark: SparkSession, d: Deployment) -> PipelineRoot:
    """The folders of the generation that counts; the first is published here."""
    now = current(spark, f"{d.root}/generations")
    if now is None:
        publish(spark, f"{d.root}/generations", "gen-1")
    return PipelineRoot(f"{d.root}/{now.folder if now else 'gen-1'}")


def views(spark: SparkSession, d: Deployment) -> dict[str, tuple[str, tuple[str, ...]]]:
    """Text and needs of every view, in an order in which each comes after the views it needs."""
    newest = W.partitionBy("name").orderBy(F.col("n").desc())
    rows = (read_table(spark, d.definitions, DEFINITIONS).withColumn("at", F.row_number().over(newest))
            .where((F.col("at") == 1) & F.col("text").isNotNull()).collect())
    found = {r.name: (r.text, tuple(r.needs or ())) for r in rows}
    order = TopologicalSorter({v: sorted(set(needs) & set(found)) for v, (_, needs) in sorted(found.items())})
    return {v: found[v] for v in order.static_order()}


def _store(spark: SparkSession, d: Deployment, name: str, text: str | None, needs: tuple[str, ...]) -> None:
    last = read_table(spark, d.definitions, DEFINITIONS).agg(F.max("n")).first()[0] or 0
    spark.createDataFrame([(last + 1, name, text, list(needs))], DEFINITIONS).coalesce(1).write.mode("append").parquet(d.definitions)


def _create_view(spark: SparkSession, d: Deployment, name: str, text: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {d.name(name)} AS {text.replace('{schema}', f'`{d.schema}`')}")


def define_view(spark: SparkSession, d: Deployment, name: str, text: str, needs: tuple[str, ...] = ()) -> None:
    """CREATE OR REPLACE VIEW and keep its text.  ``{schema}`` in it stands for the deployment's schema; ``needs``
    names the deployment's views it reads.  A text that Spark refuses isn't kept."""
    known = views(spark, d)
    if missing := set(needs) - set(known):
        raise ValueError(f"{name} needs views that are not defined: {sorted(missing)}")
    below, reached = list(needs), set()
    while below:
        v = below.pop()
        if v == name:
            raise ValueError(f"{name} would need itself")
        if v not in reached:
            reached.add(v)
            below.extend(known[v][1])
    _create_view(spark, d, name, text)
    _store(spark, d, name, text, needs)


def drop_view(spark: SparkSession, d: Deployment, name: str) -> None:
    """DROP VIEW IF EXISTS, for later sessions too; refused while another view needs it."""
    if users := [v for v, (_, needs) in views(spark, d).items() if name in needs]:
        raise ValueError(f"{name} is needed by {users}")
    spark.sql(f"DROP VIEW IF EXISTS {d.name(name)}")
    _store(spark, d, name, None, ())


def open_deployment(spark: SparkSession, d: Deployment) -> PipelineRoot:
    """Create what the session's catalog lacks (schema, tables, views) and point it at the generation that counts."""
    create_schema(spark, d.schema, d.location)
    root = generation(spark, d)
    for name, folder, schema in TABLES:
        path = getattr(root, folder)
        create_table(spark, path, schema)
        spark.sql(f"DROP TABLE IF EXISTS {d.name(name)}")  # an external table: its files stay
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {d.name(name)} ({columns}) USING parquet LOCATION '{path}'")
    for name, (text, _) in views(spark, d).items():
        _create_view(spark, d, name, text)
    return root


def read_view(spark: SparkSession, d: Deployment, name: str) -> DataFrame:
    """The view over what its tables hold now."""
    for table, _, _ in TABLES:
        spark.sql(f"REFRESH TABLE {d.name(table)}")
    return spark.table(d.name(name))


def reset(spark: SparkSession, d: Deployment) -> PipelineRoot:
    """Drop views and tables, then begin an empty generation with its own checkpoints; definitions stay and are re-created."""
    generation(spark, d)
    create_schema(spark, d.schema, d.location)
    for name in reversed(list(views(spark, d))):
        spark.sql(f"DROP VIEW IF EXISTS {d.name(name)}")
    for name, _, _ in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {d.name(name)}")
    now = current(spark, f"{d.root}/generations")
    publish(spark, f"{d.root}/generations", f"gen-{now.n + 1}")
    return open_deployment(spark, d)
