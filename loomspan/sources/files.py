"""Files in and out: typed CSV with renamed headers, headerless bars, dated folders, articles, tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from loomspan.functions.scalars import decimal_comma

#: Columns of headerless bar files.
BAR_COLUMNS = "epoch bigint, open double, high double, low double, close double, volume double, trades bigint"


def plain_header(name: str) -> str:
    """Upper case; slashes and spaces become underscores; nothing else but letters, digits and underscores."""
    return re.sub(r"[^A-Za-z0-9_]", "", re.sub(r"[/ ]+", "_", name.strip())).upper()


def read_table(spark: SparkSession, path: str, schema: str, rename: Mapping[str, str] | None = None, sep: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """A CSV with a header, by schema, with plain headers and then new names."""
    df = spark.read.schema(schema).option("header", True).option("sep", sep).option("encoding", encoding).csv(path)
    df = df.toDF(*map(plain_header, df.columns))
    return df.withColumnsRenamed(dict(rename or {}))


def read_prices(spark: SparkSession, path: str, numbers: Sequence[str], sep: str = ";") -> DataFrame:
    """A CSV of text columns of which some are numbers with decimal commas; what is no number is null."""
    df = spark.read.option("header", True).option("sep", sep).csv(path)
    return df.withColumns({c: decimal_comma(F.col(c)) for c in numbers})


def read_bars(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Headerless bars of several files in one table; at is the time of the epoch, file the file's name."""
    df = spark.read.schema(BAR_COLUMNS).csv(list(paths))
    return df.withColumn("at", F.timestamp_seconds("epoch")).withColumn("file", F.regexp_extract(F.input_file_name(), "([^/]+)$", 1))


def parse_bars(payloads: DataFrame, column: str) -> DataFrame:
    """Bars out of an exchange's answers, JSON text: result holds a list of bars by pair (and last, which is none), a bar
    is [time, open, high, low, close, mean, volume, trades], numbers as text or not. pair, at, open, high, low, close, volume,
    trades; answers without a result give nothing, and what is no number is null."""
    result = F.from_json(F.get_json_object(column, "$.result"), "map<string, string>")
    pairs = payloads.select(F.explode(F.map_filter(result, lambda k, _: k != "last")).alias("pair", "list"))
    rows = pairs.select("pair", F.explode(F.from_json("list", "array<array<string>>")).alias("b"))
    number = lambda i, t: F.get("b", F.lit(i)).try_cast(t)
    at = F.timestamp_seconds(number(0, "bigint"))
    return rows.select("pair", at.alias("at"), *(number(i, "double").alias(c) for i, c in ((1, "open"), (2, "high"), (3, "low"), (4, "close"), (6, "volume"))), number(7, "bigint").alias("trades"))


def merge_history(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both, of rows with one key those of old first; one row for each key."""
    rows = old.withColumn("__p", F.lit(0)).unionByName(new.withColumn("__p", F.lit(1)), allowMissingColumns=True)
    w = W.partitionBy(*keys).orderBy("__p", *(c for c in sorted(old.columns) if c not in keys))
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__p")


def read_latest(spark: SparkSession, path: str, schema: str, date_column: str = "date") -> DataFrame:
    """A folder of date=... parts: the rows of the latest date. Folders are listed, and only that one is read; without
    any the table is empty."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target)
    names = [f.getPath().getName() for f in found]
    # dates are written so that their order is that of the letters
    parts = [n for n in names if re.fullmatch(rf"{re.escape(date_column)}=\d{{4}}-\d\d-\d\d", n)]
    reader = spark.read.schema(schema).option("header", True).option("basePath", path)
    return reader.csv(f"{path.rstrip('/')}/{max(parts)}") if parts else spark.createDataFrame([], schema)


#: How articles are written: quotes doubled, every field quoted, spaces kept, and a text that is missing told from an
#: empty one.
_ARTICLES = {"header": True, "escape": '"', "quoteAll": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": "", "nullValue": "\\N"}


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Articles of all CSV files of a folder, quoted fields over several lines."""
    return spark.read.options(**_ARTICLES).option("multiLine", True).csv(path)


def write_articles(df: DataFrame, path: str) -> None:
    df.write.options(**_ARTICLES).csv(path)


def write_table(df: DataFrame, path: str, sep: str = ";") -> None:
    """A CSV with a header."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_sheets(sheets: Mapping[str, DataFrame], path: str) -> None:
    """One folder for each sheet."""
    for name, df in sheets.items():
        write_table(df, f"{path}/{name}")
