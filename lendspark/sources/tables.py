"""Scans, sinks and table contracts."""
from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STAR_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """S3: parquet scan (vectorised; filters and projections are pushed down)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan_ordered(df: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """S3 with a row limit: a deterministic first-n by key (top-k sort, no full order)."""
    return df if limit is None else df.orderBy(key).limit(limit)


def sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """Free SQL, with DataFrames bound as ``{name}`` references."""
    return spark.sql(text, **frames) if frames else spark.sql(text)


# --- S1/S2: CSV ingest ---------------------------------------------------------

_NOT_NAME = re.compile(r"[^\w]")


def normalise_name(name: str) -> str:
    """Trimmed and lower-cased; every character that is no letter, digit or '_' becomes one '_'."""
    return _NOT_NAME.sub("_", name.strip().lower())


def normalise_names(names: list[str]) -> list[str]:
    """Normalised header names; two headers that become one name are an error."""
    out = [normalise_name(n) for n in names]
    twice = sorted({n for n in out if out.count(n) > 1})
    if twice:
        raise ValueError(f"headers that normalise to one name: {twice}")
    return out


def widen(dt: T.DataType) -> T.DataType:
    """Keep only four wide types: boolean, long, double, string."""
    if isinstance(dt, T.BooleanType):
        return T.BooleanType()
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return T.DoubleType()
    return T.StringType()


INFER_ROWS = 200_000        # the first rows of a file that types are inferred from


def _kinds(names: int, rows: int):
    """Of the first rows of the first split: for each column the types that all its values have. Other splits read nothing."""

    def fits(values: pa.Array, kind: str) -> bool:
        if kind == "boolean":
            return pc.all(pc.is_in(pc.utf8_lower(values), pa.array(["true", "false"])), min_count=0).as_py()
        try:
            values.cast(pa.int64() if kind == "long" else pa.float64())
        except pa.ArrowInvalid:
            return False
        return True

    def run(batches):
        from pyspark import TaskContext

        if TaskContext.get().partitionId() > 0:
            return
        left, possible, seen = rows, [["boolean", "long", "double"] for _ in range(names)], [False] * names
        for batch in batches:
            batch = batch.slice(0, left)
            left -= batch.num_rows
            for i in range(names):
                values = batch.column(i).drop_null()
                seen[i] |= len(values) > 0
                possible[i] = [k for k in possible[i] if fits(values, k)]
            if left == 0:
                break
        kinds = [(p or ["string"])[0] if s else "double" for p, s in zip(possible, seen, strict=True)]
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(names), pa.int32()), "kind": pa.array(kinds, pa.string())})

    return run


def infer_csv_schema(spark: SparkSession, path: str, rows: int = INFER_ROWS) -> T.StructType:
    """A schema of wide types (boolean, long, double, string; a column without any value: double) from the first ``rows``
    rows of the first split of the first file, with normalised column names. Run once; commit the result as code."""
    everything = spark.read.option("header", True).option("nullValue", "").csv(path)
    first = unquote(min(everything.inputFiles()))           # listed as addresses
    head = spark.read.schema(T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(everything.columns))])).option(
        "header", True).option("nullValue", "").csv(first)
    kinds = {r["place"]: r["kind"] for r in head.mapInArrow(_kinds(len(everything.columns), rows), "place int, kind string").collect()}
    types = {"boolean": T.BooleanType(), "long": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}
    names = normalise_names(everything.columns)
    return T.StructType([T.StructField(n, types[kinds.get(i, "double")], True) for i, n in enumerate(names)])


def infer_csv_folder(spark: SparkSession, folder: str, skip: Iterable[str] = (), rows: int = INFER_ROWS) -> dict[str, T.StructType]:
    """The schema of every ``*.csv`` of a folder, by table name (file name without ending, lower case). ``skip``: file
    names that are no tables (column descriptions, templates). Two files of one table name are an error."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: dict[str, str] = {}
    for entry in sorted(e.getPath().getName() for e in fs.listStatus(top)):
        if entry.lower().endswith(".csv") and entry not in set(skip):
            table = normalise_name(entry[:-4])
            if table in found:
                raise ValueError(f"two files of one table name: {found[table]}, {entry}")
            found[table] = entry
    return {table: infer_csv_schema(spark, f"{folder.rstrip('/')}/{entry}", rows) for table, entry in found.items()}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with an explicit schema; empty string is NULL. The header
    names are replaced positionally by the (normalised) schema names."""
    return (spark.read.schema(schema).option("header", True).option("nullValue", "")
            .option("mode", "FAILFAST").csv(path))


def load_csv_to_parquet(spark: SparkSession, path: str, schema: T.StructType, out: str) -> DataFrame:
    """S1 + S6: replace the table at ``out`` with the CSV's rows."""
    df = read_csv(spark, path, schema)
    df.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


# --- S6/S7/S9: sinks -----------------------------------------------------------

def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Small result tables as one JSON/CSV file."""
    w = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.json(path)


# --- S5/S8/S10: contracts --------------------------------------------------------

def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows violating a primary key: NULL key, or key seen more than once."""
    keys = [key] if isinstance(key, str) else list(key)
    null_any = None
    for k in keys:
        c = F.col(k).isNull()
        null_any = c if null_any is None else (null_any | c)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where((F.col("n_rows") > 1) | null_any)


def assert_unique(df: DataFrame, key: str | Sequence[str]) -> None:
    bad = duplicate_keys(df, key).limit(1).collect()
    if bad:
        raise ValueError(f"primary key violated on {key}: {bad[0].asDict()}")


def lookup(ids: DataFrame, table: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """S5 batch point lookup: (found rows, unknown ids). Unknown ids are routed
    to a reject frame instead of failing the whole batch."""
    found = ids.join(table, key, "inner")
    missing = ids.join(table.select(key), key, "left_anti").withColumn("reason", F.lit("unknown id"))
    return found, missing


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One (name, rows) line per frame, as one union of global counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def column_roles(df: DataFrame, id_col: str, target: str) -> dict[str, list[str]]:
    """Split columns by role and type (schema only, no job)."""
    roles: dict[str, list[str]] = {"id": [], "target": [], "numeric": [], "categorical": [], "bool": []}
    for f in df.schema.fields:
        if f.name == id_col:
            roles["id"].append(f.name)
        elif f.name == target:
            roles["target"].append(f.name)
        elif isinstance(f.dataType, T.BooleanType):
            roles["bool"].append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            roles["numeric"].append(f.name)
        else:
            roles["categorical"].append(f.name)
    return roles


def names(cols: Iterable[str]) -> list[str]:
    return list(cols)
