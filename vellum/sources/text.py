"""Sources: whole files with their names, JSON arrays, ordered listings, outlines, word lists, layout flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.operators.documents import free_names
from vellum.session import keep


def text_files(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """(file_name, text): one row a file, whole."""
    return spark.read.option("pathGlobFilter", glob).text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))


def listing(spark: SparkSession, path: str, suffix: str = ".txt", any_case: bool = False) -> DataFrame:
    """(file_name): the files with the suffix in the order of their names; the contents are not read."""
    names = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_name").alias("file_name"))
    own = F.lower("file_name").endswith(suffix.lower()) if any_case else F.col("file_name").endswith(suffix)
    return names.where(own).orderBy("file_name")


def json_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def volume_files(spark: SparkSession, n: int = 63, pattern: str = "volume%02d.pdf") -> DataFrame:
    return spark.range(1, n + 1).select(F.col("id").cast("int").alias("volume"), F.format_string(pattern, "id").alias("file_name"))


def present_volumes(wanted: DataFrame, names: DataFrame) -> DataFrame:
    """wanted (volume, file_name) with problem: null where the listing has the file, else what is wrong with it."""
    there = names.select("file_name", F.lit(True).alias("there"))
    return wanted.join(there, "file_name", "left").select("volume", "file_name", F.when(F.col("there").isNull(), F.lit("missing")).alias("problem"))


def pages_of(volumes: DataFrame, read_pages, schema: str = "volume int, page_no int, text string") -> DataFrame:
    """The page contract for a document format: read_pages maps (volume, bytes) to an iterable of (page_no, text) in the tasks. A file that it
    fails on gives one row with a null page_no and the error as text; empty pages give none. volumes: volume, content."""
    def run(batches):
        import pandas as pd

        for rows in batches:
            out = []
            for volume, content in zip(rows["volume"], rows["content"], strict=True):
                try:
                    out += [(volume, page_no, text) for page_no, text in read_pages(volume, content) if text]
                except Exception as e:  # noqa: BLE001 - one bad file must not end the job; the row says so
                    out.append((volume, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["volume", "page_no", "text"]).astype({"page_no": "Int32"})

    return volumes.select("volume", "content").mapInPandas(run, schema)


def zero_based(entries: DataFrame) -> DataFrame:
    """Contents entries whose page_no counts from 1, counted from 0."""
    return entries.withColumn("page_no", F.col("page_no") - 1)


def flat_outline(nested: DataFrame, most: int = 32) -> DataFrame:
    """(volume, ord, level, title, page_no): a nested outline (volume, id, parent, pos, title, page_no; parent null at the top) depth first, in the order of pos.

    One join a level, each written before the next, so that no level is made twice and none is sent to the driver; an outline of over `most` levels is an error, as it has a circle."""
    path, here = free_names(nested, "path", "here")
    level = keep(nested.where("parent is null").select("volume", "id", "title", "page_no", F.array("pos").alias(path)))
    parts = [level]
    while not level.isEmpty():
        if len(parts) > most:
            raise ValueError(f"an outline of over {most} levels")
        above = level.select("volume", F.col("id").alias("parent"), F.col(path).alias(here)).hint("merge")
        level = keep(nested.join(above, ["volume", "parent"]).select("volume", "id", "title", "page_no", F.array_append(here, F.col("pos")).alias(path)))
        parts.append(level)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    from pyspark.sql import Window

    order = F.row_number().over(Window.partitionBy("volume").orderBy(path)) - 1
    return out.select("volume", order.alias("ord"), F.size(path).alias("level"), F.btrim("title").alias("title"), "page_no")


def text_blocks(blocks: DataFrame) -> DataFrame:
    """(document, page_no, block_no, line_no, spans): the lines of a page's text blocks (type 0) with their spans that hold text; lines without any go.

    blocks: document, page_no, block_no, type, lines: an array of (spans)."""
    lines = blocks.where("type = 0").select("document", "page_no", "block_no", F.posexplode("lines").alias("line_no", "line"))
    return lines.select("document", "page_no", "block_no", "line_no", F.filter("line.spans", lambda s: s["text"] != "").alias("spans")).where(F.size("spans") > 0)


def is_italic(flags: Column) -> Column:
    return flags.bitwiseAND(F.lit(2)) != 0


def is_bold(flags: Column) -> Column:
    return flags.bitwiseAND(F.lit(16)) != 0


def word_list(spark: SparkSession, path: str, extras: tuple[str, ...] = ()) -> DataFrame:
    """Distinct lower-case words: those of the file, one a line, that stand there in lower case, and extras. Names, which open with a
    capital only, are left out unless they are extras. A file that is not there has no words."""
    more = spark.createDataFrame([(w,) for w in extras], "word string")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return more.where("word != ''").distinct()
    raw = F.btrim("value")
    words = spark.read.text(path).where((raw == F.lower(raw)) & (F.lower(F.left(raw, F.lit(1))) != F.upper(F.left(raw, F.lit(1))))).select(raw.alias("word"))
    return words.unionByName(more).where("word != ''").distinct()
