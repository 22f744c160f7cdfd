"""Reading and writing corpora, and the demonstration corpus."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from civiltext import tables
from civiltext.functions import sqltext as sql
from civiltext.functions.text import contains_one_of
from civiltext.operators.exploration import discover_labels
from civiltext.operators.sampling import balanced_sample, shuffle_rows
from civiltext.sources.records import read_csv


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table, in the pieces it comes in.

    Only a table that fits into one scan partition is spread over the cores: a small file often
    is a single piece, and moving it costs less than leaving all cores but one idle. Anything
    larger is not moved.
    """
    df = spark.read.parquet(path)
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    one = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes"))
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if size <= one else df


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A text file as one row per line."""
    return spark.read.text(path).withColumnRenamed("value", "text")


def read_labeled_csv(spark: SparkSession, path: str) -> DataFrame:
    """A labelled corpus: ``id, comment_text`` and whichever label columns the header names.

    Comments may hold line breaks and doubled quotes; a large file is read by many tasks.
    """
    raw = read_csv(spark, path)
    labels = discover_labels(raw)
    return raw.select("id", "comment_text", *[F.col(c).cast("int").alias(c) for c in labels])


def write_labeled_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    (df.write.mode(mode).option("header", True).option("quoteAll", True)
     .option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_report(report: DataFrame, path: str, fmt: str = "parquet",
                 mode: str = "errorifexists") -> None:
    """Store a result table; nested columns need parquet, orc or json."""
    report.write.mode(mode).format(fmt).save(path)


def load_dataset(spark: SparkSession, path: str | None, size: int | None = None) -> DataFrame:
    """The corpus at ``path``, reduced to a balanced sample of ``size`` rows if it is larger
    (``None``: keep all), or the demonstration corpus if there is nothing at ``path``."""
    if path is None:
        return demo_corpus(spark)
    try:
        df = read_labeled_csv(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return demo_corpus(spark)
    return df if size is None else balanced_sample(df, "id", size=size)


def _pick(choices: list[str], i: Column) -> Column:
    listed = F.expr(f"array({', '.join(sql.quote(c) for c in choices)})")
    return F.element_at(listed, (F.pmod(i, F.lit(len(choices))) + 1).cast("int"))


def _flag(test: Column) -> Column:
    return test.cast("int")


def demo_toxic_text(i: Column) -> Column:
    """The ``i``-th toxic demonstration comment: a template with its slots filled in turn."""
    text = _pick(tables.DEMO_TOXIC, i)
    for slot, words, step in (
            ("insult1", tables.DEMO_INSULTS, 0), ("insult2", tables.DEMO_INSULTS, 1),
            ("hate", tables.DEMO_HATE, 0), ("adj1", tables.DEMO_ADJECTIVES, 0),
            ("adj2", tables.DEMO_ADJECTIVES, 1), ("command", tables.DEMO_COMMANDS, 0)):
        text = F.replace(text, F.lit("{" + slot + "}"), _pick(words, i + step))
    return text


def demo_rows(indices: DataFrame, toxic: bool, i_col: str = "i") -> DataFrame:
    """Demonstration comments with their six labels for the numbers in ``i_col``."""
    i = F.col(i_col)
    if not toxic:
        return indices.withColumns({
            "comment_text": _pick(tables.DEMO_CLEAN, i),
            **{label: F.lit(0) for label in tables.LABELS}})
    text = F.col("comment_text")
    return indices.withColumn("comment_text", demo_toxic_text(i)).withColumns({
        "toxic": F.lit(1),
        "severe_toxic": _flag(F.pmod(i, F.lit(10)) == 0),
        "obscene": _flag(F.pmod(i, F.lit(3)) == 0),
        "threat": _flag(contains_one_of(text, tables.DEMO_THREATS)),
        "insult": _flag(contains_one_of(text, tables.DEMO_INSULTS)),
        "identity_hate": _flag(F.pmod(i, F.lit(8)) == 0)})


def demo_corpus(spark: SparkSession, n: int = 2000, seed: int = 42) -> DataFrame:
    """``n`` demonstration comments, half of them toxic, in a random but fixed order."""
    half = spark.range(n // 2).withColumnRenamed("id", "i")
    rows = (demo_rows(half, toxic=True).withColumn("id", F.concat(F.lit("t"), "i"))
            .unionByName(demo_rows(half, toxic=False).withColumn("id", F.concat(F.lit("c"), "i"))))
    return shuffle_rows(rows.select("id", "comment_text", *tables.LABELS), "id", seed)
