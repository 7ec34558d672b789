"""Sources, sinks and the table catalog.

Reading is declarative (`spark.read`), so Catalyst prunes columns and pushes
filters into the Parquet scan; CSV ingest converts once into Parquet tables.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Mapping, Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.session import stage

# Fixed values that must match the reference's rules.
# Column-name sanitizer for tables: every char outside [a-zA-Z0-9_] -> "_", then lower.
TABLE_NAME_BAD_CHARS = r"[^a-zA-Z0-9_]"
# Model-safe sanitizer: these characters -> "_": < > [ ] { } | " ' \ / * ? :
MODEL_NAME_BAD_CHARS = r"[<>\[\]{}|\"'\\/*?:]"
TABLE_PREFIX = "raw_"
TABLE_STEM_MAX = 50

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """S9 table scan of one driver table (Parquet)."""
    return spark.read.parquet(table_path(sf_dir, name))


# The tokens that pandas reads as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    encoding: str = "UTF-8",
    header: bool = True,
    corrupt_col: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """S1/S2 CSV scan with pandas' reading rules: a doubled quote inside a
    quoted field is a quote, quoted fields may hold line breaks, and the NA
    tokens are null whatever the column.  Columns are read as text, missing
    tokens are removed, then types are given: by ``schema``, or inferred in
    one pass over all rows (long, double, boolean, else text).  With
    ``corrupt_col`` the raw text of rows that do not parse is kept there.

    Quoted line breaks make a file one task; a file known to hold none is read
    with ``multi_line=False`` and split over many."""
    reader = spark.read.option("header", header).option("encoding", encoding).option("mode", "PERMISSIVE")
    reader = reader.option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    paths = path if isinstance(path, str) else list(path)
    text = reader.csv(paths)
    if corrupt_col:
        shape = T.StructType([*text.schema.fields, T.StructField(corrupt_col, T.StringType())])
        text = reader.option("columnNameOfCorruptRecord", corrupt_col).schema(shape).csv(paths)
    raw = text.select(
        *[F.when(~F.col(f"`{c}`").isin(*NA_TOKENS), F.col(f"`{c}`")).alias(c) if c != corrupt_col else F.col(f"`{c}`") for c in text.columns]
    )
    if schema is not None:
        want = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        kinds = {f.name: f.dataType for f in want.fields}
    else:
        kinds = infer_kinds(raw, [c for c in raw.columns if c != corrupt_col])
    return raw.select(
        *[F.col(f"`{c}`").try_cast(kinds[c]).alias(c) if c in kinds and kinds[c] != T.StringType() else F.col(f"`{c}`") for c in raw.columns]
    )


def infer_kinds(raw: DataFrame, columns: Sequence[str]) -> dict[str, T.DataType]:
    """The narrowest type that all known values of a text column have."""
    if not columns:
        return {}
    checks = []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`")
        checks += [
            F.count(v).alias(f"n{i}"),
            F.count(v.try_cast("long")).alias(f"l{i}"),
            F.count(F.when(v.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"), v)).alias(f"d{i}"),
            F.count(F.when(v.isin("True", "False", "true", "false", "TRUE", "FALSE"), v)).alias(f"b{i}"),
        ]
    r = raw.agg(*checks).first()
    out: dict[str, T.DataType] = {}
    for i, c in enumerate(columns):
        n = r[f"n{i}"]
        if n and r[f"l{i}"] == n:
            out[c] = T.LongType()
        elif n and r[f"d{i}"] == n:
            out[c] = T.DoubleType()
        elif n and r[f"b{i}"] == n:
            out[c] = T.BooleanType()
        else:
            out[c] = T.StringType()
    return out


def read_tagged(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str = "parquet",
    tag_col: str = "tag",
    pattern: str = r"^([^_]+)_",
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Scan many files as one table, tagging each row with a value
    taken from its file name (e.g. the country in ``CC_Trending.csv``).

    One multi-path scan; the tag comes from the hidden ``_metadata`` column, so
    no per-file driver loop and no union tree.  CSV files whose headers differ
    are read once per distinct header and united by name, so a column never
    takes the values of another; columns that a file lacks are null.  Parquet
    files of different schemas need ``mergeSchema`` as an option (it opens
    every footer)."""
    if fmt == "csv":
        return _tagged_csv(spark, [paths] if isinstance(paths, str) else list(paths), tag_col, pattern, schema, options)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(paths if isinstance(paths, str) else list(paths))
    return df.withColumn(tag_col, F.regexp_extract(F.col("_metadata.file_name"), pattern, 1))


def _tagged_csv(spark: SparkSession, paths: list[str], tag_col: str, pattern: str, schema, options: Mapping[str, str]) -> DataFrame:
    # text first: types are given to all files together
    given = {k: v for k, v in options.items() if k.lower() not in ("inferschema", "header")}
    csv = {"quote": '"', "escape": '"', "multiLine": "true", **given}
    # the files are listed, not read; then the header, one short row per file
    files = set(spark.read.text(paths).inputFiles())
    groups: dict[tuple[str, ...], list[str]] = {}
    for f in sorted(files):
        groups.setdefault(tuple(spark.read.options(**{**csv, "header": "true"}).csv(f).columns), []).append(f)
    out = None
    for part in groups.values():
        df = spark.read.options(**{**csv, "header": "true"}).csv(part)
        tag = F.regexp_extract(F.col("_metadata.file_name"), pattern, 1).alias(tag_col)
        df = df.select(*[F.when(~F.col(f"`{c}`").isin(*NA_TOKENS), F.col(f"`{c}`")).alias(c) for c in df.columns], tag)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if schema is not None:
        kinds = {f.name: f.dataType for f in schema.fields}
    else:
        kinds = infer_kinds(out, [c for c in out.columns if c != tag_col])
    return out.select(*[F.col(f"`{c}`").try_cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in out.columns])


def sanitize_name(name: str) -> str:
    return re.sub(TABLE_NAME_BAD_CHARS, "_", name).lower()


def model_safe_name(name: str) -> str:
    return re.sub(MODEL_NAME_BAD_CHARS, "_", name)


def sanitize_columns(df: DataFrame, model_safe: bool = False) -> DataFrame:
    """S4 (table names: non-alnum -> ``_``, lower) or S5 (model-safe chars)."""
    fn = model_safe_name if model_safe else sanitize_name
    return df.toDF(*[fn(c) for c in df.columns])


def safe_table_name(path: str) -> str:
    """``raw_`` + sanitized file stem, stem cut to 50 chars."""
    stem = PurePosixPath(path).stem
    return TABLE_PREFIX + sanitize_name(stem)[:TABLE_STEM_MAX]


def table_names(paths: Sequence[str]) -> dict[str, str]:
    """S6 for many files: path -> table name.  Files whose names would collide
    after sanitizing and cutting get a hash of their path appended."""
    plain = {p: safe_table_name(p) for p in dict.fromkeys(paths)}
    uses = Counter(plain.values())
    return {p: n if uses[n] == 1 else f"{n}_{zlib.crc32(p.encode()):08x}" for p, n in plain.items()}


def nan_to_null(df: DataFrame) -> DataFrame:
    """Ingest rule: floating NaN becomes SQL NULL (pandas has one missing
    marker; Spark orders NaN above every number)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def load_tables(
    spark: SparkSession,
    sources: Mapping[str, str],
    database: str = "default",
    mode: str = "overwrite",
    fmt: str = "csv",
    multi_line: bool = True,
) -> DataFrame:
    """Load many files as catalog tables; one failing file does not
    stop the others.  Returns one registry row per file (table, source, rows,
    cols, error): a failed file has its error there and null rows.

    Each table is written at an explicit location under the warehouse, so
    ``overwrite`` replaces data left by an earlier run (the reference's
    replace semantics) even when the catalog does not know the table.  The
    loop only issues one distributed write per file; no data passes through
    the driver."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    rows = []
    names = table_names(list(sources.values()))
    for src_path, name in names.items():
        try:
            df = read_csv(spark, src_path, multi_line=multi_line) if fmt == "csv" else spark.read.format(fmt).load(src_path)
            df = nan_to_null(sanitize_columns(df))
            location = f"{root}/{database}.db/{name}"
            df.write.mode(mode).format("parquet").option("path", location).saveAsTable(f"{database}.{name}")
            n = spark.table(f"{database}.{name}").count()
            rows.append((name, src_path, n, list(df.columns), None))
        except Exception as exc:  # per-file failure isolation
            rows.append((name, src_path, None, None, f"{type(exc).__name__}: {str(exc)[:300]}"))
    schema = "table string, source string, rows long, cols array<string>, error string"
    return spark.createDataFrame(rows, schema)


def table_registry(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table (table, rows, n_cols), built lazily as a
    union of distributed counts: a single job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"),
            F.col("rows"),
            F.lit(len(df.columns)).cast("long").alias("n_cols"),
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def largest_table(registry: DataFrame) -> DataFrame:
    """The table with the largest rows x cols (ties: name order)."""
    return (
        registry.withColumn("area", F.col("rows") * F.col("n_cols"))
        .orderBy(F.col("area").desc(), F.col("table_name"))
        .limit(1)
    )


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by=None, **options: str
) -> None:
    """S10/S11 sinks: parquet (default), csv or json, optionally partitioned.
    CSV is written by pandas' rules: a quote is doubled, blanks stay."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="")
    w = w.options(**options)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


def select_candidates(
    candidates: DataFrame,
    query_col: str,
    ref_col: str,
    order_col: str,
    per_query: int,
    query_order: Sequence[str],
) -> DataFrame:
    """Manifest selection.  Queries are processed in ``query_order``;
    each takes up to ``per_query`` refs in result order, skipping refs an
    earlier query already took (a ref skipped for capacity stays free).

    Each query depends on the refs claimed before it, so the loop runs over
    the (configured, short) query list; each step is a distributed anti-join
    and a per-query top-N, never a driver-side scan of candidates."""
    best = stage(candidates.groupBy(query_col, ref_col).agg(F.min(order_col).alias("_pos")), "candidates")
    claimed = None
    picked = []
    for i, q in enumerate(query_order):
        # each step's picks are staged, so a later query reads the claims
        # instead of computing all earlier steps again
        cand = best.where(F.col(query_col) == F.lit(q))
        if claimed is not None:
            cand = cand.join(claimed, ref_col, "left_anti")
        w = Window.partitionBy(query_col).orderBy("_pos", ref_col)
        take = (
            cand.withColumn("_k", F.row_number().over(w))
            .where(F.col("_k") <= per_query)
            .select(query_col, ref_col, F.col("_pos").alias(order_col), F.lit(i).alias("query_rank"), F.col("_k").alias("slot"))
        )
        take = stage(take, "claimed")
        picked.append(take)
        refs = take.select(ref_col)
        claimed = refs if claimed is None else claimed.unionByName(refs)
    out = picked[0]
    for p in picked[1:]:
        out = out.unionByName(p)
    return out
