"""Sources: CSV with drifting headers, seeds, cached text CSV, roster JSON, tables."""

from __future__ import annotations

import csv
import re
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statmart.functions.casts import all_text
from statmart.operators.nested import parse_roster_ids, parse_rosters
from statmart.operators.sets import union_by_name


def _files(spark: SparkSession, pattern: str) -> dict[str, str]:
    """Files a glob names, through the file system of the path (local, HDFS, object store).

    Path by URI and by plain name, as Spark may report a file in either form.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in fs.globStatus(path) or [] if f.isFile()]
    return {name: p.toString() for p in found for name in (p.toUri().toString(), p.toString())}


def _headers(spark: SparkSession, files: dict[str, str]) -> dict[str, list[str]]:
    """Header line -> its files, found in one job; files without a line have none."""
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    lines = spark.read.text(sorted(set(files.values()))).select(F.col("_metadata.file_path").alias("file"), F.rtrim("value").alias("line"), at.alias("at"))
    first = lines.groupBy("file").agg(F.min_by("line", "at").alias("line"))
    groups: dict[str, list[str]] = defaultdict(list)
    for row in first.collect():  # a row per file, as many as the listing has
        known = files.get(row.file) or files[re.sub("^file:/+", "file:/", row.file)]
        groups[row.line].append(known)
    return {line: sorted(names) for line, names in sorted(groups.items())}


def read_csv_union_by_name(spark: SparkSession, pattern: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV files with headers, united by column name.

    One multi-file CSV read would match columns by position. One job finds every file's
    header line, files with equal headers are read together, and the groups are united
    by name. Without ``schema`` types are inferred per group (one more job each); a column
    whose groups disagree becomes double if all are numbers, else text. Empty files have no rows.
    """
    files = _files(spark, pattern)
    if not files:
        raise FileNotFoundError(f"no file matches {pattern}")
    frames = []
    for line, names in _headers(spark, files).items():
        reader = spark.read.option("header", True)
        if schema is None:
            frames.append(reader.option("inferSchema", True).csv(names))
        else:
            # The header is known, so nothing has to be opened to learn the columns.
            columns = [c.strip() for c in next(csv.reader([line]))]
            frames.append(reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).csv(names))
    if not frames:
        return spark.createDataFrame([], schema or T.StructType([]))
    if schema is not None:
        types = {f.name: f.dataType for f in schema.fields}
        frames = [
            df.select([F.col(f"`{c}`").try_cast(types.get(c, T.StringType())).alias(c) for c in df.columns])
            for df in frames
        ]
        out = union_by_name(*frames)
        absent = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in out.columns}
        return out.withColumns(absent)
    return union_by_name(*_agree(frames))


def _agree(frames: list[DataFrame]) -> list[DataFrame]:
    seen: dict[str, set] = defaultdict(set)
    for df in frames:
        for f in df.schema.fields:
            seen[f.name].add(f.dataType)
    clash = {
        name: T.DoubleType() if all(isinstance(t, T.NumericType) for t in kinds) else T.StringType()
        for name, kinds in seen.items()
        if len(kinds) > 1
    }
    return [
        df.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in clash.items() if c in df.columns})
        for df in frames
    ]


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Static lookup CSV with a declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_text_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Cached CSV with every column as text, so ids keep leading zeros; empty if absent."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema or T.StructType([]))
    return all_text(spark.read.option("header", True).option("inferSchema", False).csv(path))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def read_rosters_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Roster documents as a map column. One document per file, or one per line."""
    return parse_rosters(spark.read.text(path, wholetext=not lines))


def read_roster_ids(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Documents of team to id list as (team, ids as text)."""
    return parse_roster_ids(spark.read.text(path, wholetext=not lines))


def table(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """A catalogue table by qualified name, or ``root/schema/table`` as parquet."""
    if root is None:
        return spark.table(name)
    return spark.read.parquet(f"{root.rstrip('/')}/{name.replace('.', '/')}")


def select_season_log(df: DataFrame, year: int | str, season: str = "season_id", game: str = "game_id") -> DataFrame:
    """Log rows of one season: season id is kind + year and the game id starts with 00 + kind."""
    def one(kind: str) -> Column:
        return (F.col(season) == f"{kind}{year}") & F.col(game).startswith(f"00{kind}")

    return df.filter(one("2") | one("4") | one("6"))
