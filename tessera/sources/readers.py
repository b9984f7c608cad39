"""Sources: file listings, texts, address lists, tables and stage indexes as DataFrames; and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.routing import visible_files

CHUNK_INDEX = "created_at timestamp, total_chunks int, total_tokens long, source_files array<string>, chunks array<struct<chunk_id:string,file_path:string,title:string,estimated_tokens:int,source_file:string,chunking_method:string>>"
SKU_INDEX = "created_at timestamp, updated_at timestamp, total_skus int, total_characters long, chunks_processed array<string>, factual_count int, relational_count int, procedural_count int, meta_count int, skus array<struct<sku_id:string,name:string,classification:string,path:string,source_chunk:string,character_count:int,description:string,confidence:double>>"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def list_files(spark: SparkSession, root: str, content: bool = False) -> DataFrame:
    """Files below ``root``, recursively, without hidden and ignored ones: path, length, modified (and content). A missing
    root gives no row. Only listings are read unless the content is asked for."""
    schema = "path string, length long, modified timestamp" + (", content binary" if content else "")
    if not _exists(spark, root):
        return spark.createDataFrame([], schema)
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    cols = [F.regexp_replace("path", "^file:/+", "/").alias("path"), "length", F.col("modificationTime").alias("modified")] + (["content"] if content else [])
    return visible_files(rows.select(*cols), root.removeprefix("file://"))


def read_texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per text file: path, text."""
    return spark.read.text(paths, wholetext=True).select(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/").alias("path"), F.col("value").alias("text"))


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    from tessera.operators.routing import url_list

    return url_list(spark.read.text(path)) if _exists(spark, path) else spark.createDataFrame([], "url string")


def read_csv_records(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file as JSON records: record. Empty cells are null."""
    rows = spark.read.option("header", "true").option("inferSchema", "true").option("multiLine", "true").csv(path)
    return rows.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"}).alias("record"))


def table_metadata(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("header", "true").csv(path)
    return rows.agg(F.count(F.lit(1)).alias("row_count")).withColumn("column_count", F.when(F.col("row_count") > 0, len(rows.columns)).otherwise(0))


def read_excel_records(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Workbooks (path, content) as JSON records: path, sheet, record, error. A missing library or a broken file is a row with
    an error, not an exception."""
    def convert(frames):
        import io

        import pandas as pd

        for frame in frames:
            out = []
            for path, content in frame[["path", "content"]].itertuples(index=False):
                try:
                    sheets = pd.read_excel(io.BytesIO(content), sheet_name=None)
                    out += [(path, s, r, None) for s, d in sheets.items() for r in d.to_json(orient="records", lines=True, force_ascii=False, date_format="iso").splitlines()]
                except Exception as e:  # noqa: BLE001
                    out.append((path, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "sheet", "record", "error"])

    return files.select("path", "content").mapInPandas(convert, "path string, sheet string, record string, error string")


def read_chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """Chunks of a chunk index, by id; a missing index has none."""
    if not _exists(spark, path):
        return spark.createDataFrame([], T._parse_datatype_string("chunk_id string, file_path string, title string, estimated_tokens int, source_file string, chunking_method string"))
    return spark.read.schema(CHUNK_INDEX).json(path, multiLine=True).select(F.explode("chunks").alias("c")).select("c.*").orderBy("chunk_id")


def read_sku_index(spark: SparkSession, path: str, create: bool = False) -> DataFrame:
    """Units of an index. A missing one is an error, unless it may be created; a corrupt one then counts as empty."""
    empty = spark.createDataFrame([], SKU_INDEX).select(F.explode("skus").alias("s")).select("s.*")
    if not _exists(spark, path):
        if create:
            return empty
        raise FileNotFoundError(path)
    rows = spark.read.schema(SKU_INDEX + ", _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path, multiLine=True)
    return rows.select(F.explode("skus").alias("s")).select("s.*")


def write_index(rows: DataFrame, path: str) -> None:
    """Write to a staging folder, then swap, so readers never see half an index."""
    spark = rows.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    staging, old = path.rstrip("/") + "._staging", path.rstrip("/") + "._old"
    rows.write.mode("overwrite").parquet(staging)
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(fs_path(old), True)
    if fs.exists(fs_path(path)):
        fs.rename(fs_path(path), fs_path(old))
    fs.rename(fs_path(staging), fs_path(path))
    fs.delete(fs_path(old), True)


def write_texts(files: DataFrame, root: str) -> None:
    """Write files (target, content) below ``root``, from the executors, through Hadoop's file system of the driver-side
    configuration. ``root`` must be a folder all executors share."""
    def save(batch):
        import os

        for row in batch:
            where = os.path.join(root, row.target)
            os.makedirs(os.path.dirname(where), exist_ok=True)
            partial = f"{where}.{os.getpid()}.part"
            with open(partial, "w", encoding="utf-8") as f:
                f.write(row.content or "")
            os.replace(partial, where)  # a rerun of a lost task replaces the file by the same

    files.select("target", "content").foreachPartition(save)
