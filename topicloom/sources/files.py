"""Readers: prompt files, tables with declared schemas, label tables, dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from topicloom.functions import text as tx

LABEL_SCHEMA = T.StructType(
    [
        T.StructField("category_id", T.IntegerType()),
        T.StructField("category_name", T.StringType()),
        T.StructField("subcategory_id", T.IntegerType()),
        T.StructField("subcategory_name", T.StringType()),
        T.StructField("keywords", T.StringType()),
    ]
)
CATEGORISED_SCHEMA = T.StructType(
    [
        T.StructField("raw_text", T.StringType()),
        T.StructField("truncated_prompt", T.StringType()),
        T.StructField("category_id", T.IntegerType()),
        T.StructField("category_name", T.StringType()),
        T.StructField("subcategory_id", T.IntegerType()),
        T.StructField("subcategory_name", T.StringType()),
    ]
)
HEADER_PATTERN = r"(?iU)^\S*prompt\S*$"
DATE_PATTERN = r"(\d{4}-\d{2}-\d{2})"


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fail before any plan is built when a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def spread_if_few(df: DataFrame, *keys: str) -> DataFrame:
    """Spread an input that arrives in fewer splits than there are cores.

    A large input has plenty of splits and is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * 2, *keys) if df.rdd.getNumPartitions() < cores else df


def is_header(line: Column) -> Column:
    """One word that contains "prompt"."""
    return line.rlike(HEADER_PATTERN)


def text_lines(texts: DataFrame, text_col: str, *keep: str, skip_header: bool = True) -> DataFrame:
    """``(keep..., pos, raw_text)``: stripped, non-blank lines of multi-line texts.

    The lines of a text are in its row, so the header test needs no window.
    """
    lines = F.transform(
        F.split(text_col, "\n"), lambda v, i: F.struct(i.alias("pos"), tx.strip(v).alias("raw_text"))
    )
    kept = tx.let(lines, lambda ls: F.filter(ls, lambda l: l["raw_text"] != ""))
    if skip_header:
        kept = tx.let(
            kept,
            lambda ls: F.when(
                is_header(F.get(ls, F.lit(0))["raw_text"]),
                F.slice(ls, F.lit(2), F.greatest(F.size(ls) - 1, F.lit(0))),
            ).otherwise(ls),
        )
    return texts.select(*keep, F.explode(kept).alias("_l")).select(
        *keep, F.col("_l.pos").alias("pos"), F.col("_l.raw_text").alias("raw_text")
    )


def first_existing(spark: SparkSession, *paths: str) -> str:
    """The first path that exists, such as a text file before its CSV twin."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    for path in paths:
        place = hadoop(path)
        if place.getFileSystem(conf).globStatus(place):
            return path
    raise FileNotFoundError(f"none of {paths} exists")


def without_headers(lines: DataFrame) -> DataFrame:
    """Drop the first kept line of each file where it is a header.

    ``lines`` has ``prompt_id`` and ``raw_text``, and of each line's file ``_path`` and ``_block``.
    """
    place = F.struct("_block", "prompt_id")
    headers = (
        lines.groupBy("_path")
        .agg(F.min(F.struct(place.alias("p"), F.col("raw_text").alias("t"))).alias("_first"))
        .filter(is_header(F.col("_first.t")))
        .select(F.col("_first.p.prompt_id").alias("prompt_id"))
    )
    return lines.join(headers, "prompt_id", "left_anti")


def read_prompts(spark: SparkSession, *paths: str, skip_header: bool = True) -> DataFrame:
    """``(prompt_id, raw_text, file_name)`` from line files.

    Ids follow the place of a line in the input.  The first kept line of a file is
    its minimum over (block, id), one pre-summed row per file; only files whose
    first line is a header take part in the anti-join that drops it.
    """
    lines = (
        spark.read.text(list(paths))
        .select(
            tx.strip(F.col("value")).alias("raw_text"),
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.col("_metadata.file_name").alias("file_name"),
        )
        .withColumn("prompt_id", F.monotonically_increasing_id())
        .filter("raw_text <> ''")
    )
    if skip_header:
        lines = without_headers(lines)
    return lines.select("prompt_id", "raw_text", "file_name")


def file_date(file_name: Column) -> Column:
    """The date in a file name; a name without one is an error."""
    found = F.regexp_extract(file_name, DATE_PATTERN, 1)
    return F.when(found != "", found.cast("date")).otherwise(
        F.raise_error(F.concat(F.lit("no YYYY-MM-DD date in file name "), file_name)).cast("date")
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV with header, doubled quotes and a declared schema.

    Fields that hold line breaks need ``multi_line=True``; Spark cannot split such files.
    """
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .schema(schema)
        .csv(path)
    )


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """A label table with its row index ``tax_idx``, in file order."""
    labels = read_csv(spark, path, LABEL_SCHEMA, multi_line=True)
    order = F.row_number().over(W.orderBy("_pos"))
    return labels.withColumn("_pos", F.monotonically_increasing_id()).select(
        (order - 1).alias("tax_idx"), *labels.columns
    )


def read_categorised(spark: SparkSession, path: str) -> DataFrame:
    """The categorised dataset; a column the file lacks is an error and not a null column."""
    header = spark.read.option("header", True).csv(path)
    require_columns(header, "truncated_prompt", "subcategory_id")
    return read_csv(spark, path, CATEGORISED_SCHEMA)


def read_dictionary(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """``(term, english)`` from a file with one JSON object, or with one object per line."""
    whole = spark.read.text(path, wholetext=not lines)
    entries = F.from_json("value", "map<string,string>")
    return whole.select(F.explode(entries).alias("term", "english"))


def read_word_list(spark: SparkSession, path: str, max_words: int = 100_000) -> list[str]:
    """A word list for ``without_words``, one word per line: noise words, extra stopwords.

    It becomes part of the plan, so a file beyond ``max_words`` is refused.
    """
    words = (
        spark.read.text(path)
        .select(tx.strip(F.col("value")).alias("w"))
        .filter("w <> ''")
        .distinct()
    )
    if words.limit(max_words + 1).count() > max_words:
        raise ValueError(f"{path} has more than {max_words} words")
    return sorted(row.w for row in words.toLocalIterator())
