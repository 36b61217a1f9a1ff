"""Sinks: overwriting tables, one file a row, and an ASCII-escaped JSON catalogue."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, *partition_by: str) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def rendered_files(df: DataFrame, stem: str, content: str, suffix: str) -> DataFrame:
    """(file_name, content) with the suffix in place of the old one; rows without content give none."""
    named = df.select(F.concat(F.regexp_replace(stem, r"\.[^.]*$", ""), F.lit(suffix)).alias("file_name"), F.col(content).alias("content"))
    return named.where("content is not null")


def write_files(files: DataFrame, folder: str) -> None:
    """One file a row (file_name, content: string or binary), written by the tasks to a folder that all executors share; files of that name are replaced.

    folder: a path or an address that pyarrow's file systems know. A task that runs again writes the same files again."""
    def write(rows):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        system.create_dir(base, recursive=True)
        for row in rows:
            with system.open_output_stream(f"{base}/{row.file_name}") as out:
                out.write(row.content.encode() if isinstance(row.content, str) else bytes(row.content))

    files.select("file_name", "content").foreachPartition(write)


def decoded(df: DataFrame, column: str) -> DataFrame:
    """df with a base-64 column as its bytes."""
    return df.withColumn(column, F.unbase64(column))


def catalogue_json(one_row: DataFrame) -> str:
    """The nested one-row catalogue as indented JSON with non-ASCII characters escaped."""
    return json.dumps(json.loads(one_row.select(F.to_json(F.struct("*"))).first()[0]), indent=2)
