"""Sources and sinks: line-wise JSON, tolerant logs, vocabularies, validated and append-only tables."""
from __future__ import annotations

import json
import os
import re
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import squeeze
from .validate import checked

PAGES = T.StructType([T.StructField("id", T.LongType()), T.StructField("page", T.IntegerType()), T.StructField("part", T.StringType()), T.StructField("text", T.StringType())])
TOC = T.StructType([T.StructField("id", T.LongType()), T.StructField("lvl", T.IntegerType()), T.StructField("sub", T.IntegerType()), T.StructField("title", T.StringType())])


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of a file of JSON lines; blank lines are skipped, a bad line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """As ``read_jsonl``; a missing file is an empty table."""
    return read_jsonl(spark, path, schema) if exists(spark, path) else spark.createDataFrame([], schema)


def read_log(spark: SparkSession, path: str, schema: T.StructType, key: str, seq: str) -> DataFrame:
    """The last row of each key of an append log; torn lines and rows with an error are left out."""
    wide = T.StructType([*schema.fields, T.StructField("_torn", T.StringType())])
    rows = spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_torn").json(path)
    rows = rows.where("_torn is null").select(*schema.names)
    if "error" in schema.names:
        rows = rows.where("error is null")
    return latest_by(rows, key, seq)


def latest_by(rows: DataFrame, key: str, seq: str) -> DataFrame:
    last = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), seq).alias("r"))
    return last.select("r.*")


def completed(rows: DataFrame, key: str) -> DataFrame:
    return rows.where("error is null").select(key).distinct()


def names_in(spark: SparkSession, path: str) -> list[str]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return sorted(f.getPath().getName() for f in target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target))


def find_tables(names: list[str]) -> tuple[str, str]:
    """The tables of a decoded book that hold its pages and its contents: ``b`` and ``t`` with a number, else by their plain names."""
    found = []
    for pattern, plain in ((r"b[0-9]+", "pages"), (r"t[0-9]+", "toc")):
        hit = next((n for n in names if re.fullmatch(rf"{pattern}(\.(parquet|json|jsonl))?", n, re.IGNORECASE)), None) or next((n for n in names if re.fullmatch(rf"{plain}(\.(parquet|json|jsonl))?", n)), None)
        if hit is None:
            raise ValueError(f"no table of pages and contents among: {', '.join(names)}")
        found.append(hit)
    return found[0], found[1]


def read_book(spark: SparkSession, path: str, book: str, book_id: int | None = None, expected: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``pages`` and ``toc`` of a decoded book folder, with the book's name and the order of its headings.

    The tables are found by their names. A book whose ``book_id`` is not the ``expected`` one is read with a warning. Titles have
    single spaces.
    """
    if expected is not None and book_id != expected:
        warnings.warn(f"book {book_id} is not the expected {expected}; rules for its headings may not fit", stacklevel=2)
    body, contents = (f"{path}/{n}" for n in find_tables(names_in(spark, path)))
    pages = spark.read.parquet(body).select(*PAGES.names) if body.endswith(".parquet") else spark.read.schema(PAGES).json(body)
    toc = spark.read.parquet(contents).select(*TOC.names) if contents.endswith(".parquet") else spark.read.schema(TOC).json(contents)
    order = Window.partitionBy("book").orderBy("id", "lvl", "sub", "title")
    return pages.withColumn("book", F.lit(book)), toc.withColumn("title", squeeze("title")).withColumn("book", F.lit(book)).withColumn("ord", F.row_number().over(order))


def decoded(column: str, charset: str = "windows-1256"):
    """Bytes that were read as Latin-1, as text of the charset, with line ends as one character.

    Needs ``spark.sql.legacy.javaCharsets`` for charsets beyond the standard ones.
    """
    return F.regexp_replace(F.decode(F.encode(F.coalesce(column, F.lit("")), "ISO-8859-1"), charset), r"\r\n?", "\n")


def read_vocabulary(path: str, fold: Callable[[str], str] = lambda s: s):
    """A vocabulary file ``{"terms": [{key, label_ar, aliases, ...}]}``."""
    from ..functions.vocab import Vocabulary

    with open(path, encoding="utf-8") as f:
        terms = json.load(f)["terms"]
    return Vocabulary.of([(t["key"], [t["key"], t.get("label_ar") or "", *t.get("aliases", [])]) for t in terms], fold)


def read_vocabularies(folder: str, fold: Callable[[str], str] = lambda s: s) -> dict[str, object]:
    """All vocabulary files of a folder by their names."""
    return {n.removesuffix(".json"): read_vocabulary(os.path.join(folder, n), fold) for n in sorted(os.listdir(folder)) if n.endswith(".json")}


def locate(explicit: str | None, variable: str, folders: list[str], suffix: str) -> str | None:
    """The explicit path, else the variable's, else the first file with the suffix in the folders, by name."""
    if explicit or os.environ.get(variable):
        return explicit or os.environ[variable]
    for folder in folders:
        names = sorted(n for n in os.listdir(folder) if n.endswith(suffix)) if os.path.isdir(folder) else []
        if names:
            return os.path.join(folder, names[0])
    return None


def write_checked(df: DataFrame, path: str, rules: dict[str, str], fmt: str = "parquet") -> None:
    """All rows or none: a broken rule fails the job before anything is committed."""
    checked(df, rules).write.mode("overwrite").format(fmt).save(path)


def append(df: DataFrame, path: str, fmt: str = "json") -> None:
    df.write.mode("append").format(fmt).save(path)


def write_report(df: DataFrame, path: str) -> None:
    """A small report as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def seed(spark: SparkSession, source: str, target: str, names: list[str], force: bool = False) -> list[str]:
    """Tables copied that the target lacks, or all of them."""
    done = []
    for name in names:
        if exists(spark, f"{source}/{name}") and (force or not exists(spark, f"{target}/{name}")):
            spark.read.parquet(f"{source}/{name}").write.mode("overwrite").parquet(f"{target}/{name}")
            done.append(name)
    return done


def should_checkpoint(n: int, every: int) -> bool:
    return n > 0 and n % every == 0


def pack(tables: dict[str, DataFrame], path: str, key: str = "person_id") -> None:
    """The served tables, each sorted by its key within files, so that point reads touch few row groups."""
    for name, df in tables.items():
        rows = df.repartitionByRange(F.col(key)).sortWithinPartitions(key) if key in df.columns else df
        rows.write.mode("overwrite").parquet(f"{path}/{name}")
