"""Input readers.  CSV types are explicit by default: inference costs one extra
full scan of every CSV and can guess differently from file to file.  Columns are
always bound by name."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class PipelineConfig:
    """Where the inputs are and where the star goes (any Hadoop FS URI).

    Input and output must differ: overwriting a table while reading it fails.
    """

    events: str
    output: str
    temperatures: str
    demographics: str
    country_mapping: str
    events_format: str = "parquet"
    events_options: dict = field(default_factory=dict)
    events_schema: T.StructType | None = None
    temperatures_schema: T.StructType | None = None
    demographics_schema: T.StructType | None = None
    mapping_schema: T.StructType | None = None
    country_aliases: dict = field(default_factory=dict)

    def table(self, name: str) -> str:
        return f"{self.output.rstrip('/')}/{name}"

    def inputs(self) -> list[str]:
        return [self.events, self.temperatures, self.demographics, self.country_mapping]


def _bind(df: DataFrame, schema: T.StructType, what: str, all_of: bool = True) -> DataFrame:
    """Columns of ``df`` bound to ``schema`` by name and cast to its types.

    Columns that the schema does not name stay as they are, behind the others;
    a column that is missing raises (with ``all_of=False`` it is left out).
    A value that does not parse raises, as casts do under ANSI mode.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing and all_of:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")
    known = [f for f in schema.fields if f.name not in missing]
    names = {f.name for f in known}
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in known],
                     *[F.col(f"`{c}`") for c in df.columns if c not in names])


def read_events(spark: SparkSession, path: str, fmt: str = "parquet",
                schema: T.StructType | None = None, **options) -> DataFrame:
    """Events staged in any Spark data source (parquet, orc, csv, json...).

    Parquet and ORC carry their schema, so every column of the file is kept;
    ``schema`` then only checks and casts by name.  CSV has a header unless
    ``header=False`` is given.
    """
    if fmt == "csv":
        return read_csv_table(spark, path, schema, **options)
    reader = spark.read.format(fmt).options(**options)
    if schema is None:
        return reader.load(path)
    if fmt in ("parquet", "orc"):
        return _bind(reader.load(path), schema, path)
    return reader.schema(schema).load(path)


def require_columns(df: DataFrame, names, what: str) -> DataFrame:
    """``df``, or an error that lists the columns it lacks."""
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")
    return df


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   sep: str = ",", header: bool = True, infer_schema: bool = False,
                   **options) -> DataFrame:
    """CSV; quoted separators are handled by the parser.

    With a header, columns are bound to ``schema`` by name, whatever their
    order in the file; files of one folder must agree on the header.  Without
    a header the schema is bound by position.
    """
    reader = spark.read.options(header=header, sep=sep, **options)
    headed = str(header).lower() == "true"
    if schema is not None and not headed:
        return reader.schema(schema).csv(path)
    if headed:
        reader = reader.option("enforceSchema", False)  # a file with another header raises
    if schema is None:
        return reader.option("inferSchema", infer_schema).csv(path)
    return _bind(reader.csv(path), schema, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a persisted (possibly Hive-partitioned) Parquet table back."""
    return spark.read.parquet(path)
