"""Samples and splits that do not depend on partitioning.

Randomness comes from a hash of seed and row id, so a rerun, a retried task or another
cluster size gives the same rows. Where the id is missing, the row's other columns take its
place; rows that are equal in all of them share a key and are told apart at random.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SAMPLE_SIZE = 50_000
BUCKET_DIGITS = 4  # 16^4 buckets


def shuffle_key(id_col: str, seed: int = 42, others: tuple[str, ...] = ()) -> Column:
    """A uniformly distributed hex string per row; ``others`` stand in for a missing id."""
    rest = F.concat_ws("|", F.lit("missing"), *[F.col(c).cast("string") for c in others])
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), rest))
                 .cast("binary"))


def stand_ins(df: DataFrame, id_col: str) -> tuple[str, ...]:
    """The columns that tell rows without an id apart, by name."""
    return tuple(sorted(name for name, kind in df.dtypes
                        if name != id_col and not kind.startswith(("map", "array", "struct"))))


def shuffle_rows(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """All rows in a reproducible random order (a range-partitioned sort)."""
    return df.orderBy(shuffle_key(id_col, seed, stand_ins(df, id_col)), id_col)


def in_test_part(id_col: str, test_size: float = 0.2, seed: int = 42,
                 others: tuple[str, ...] = ()) -> Column:
    """Whether a row belongs to the held-out part; about ``test_size`` of all rows do."""
    return shuffle_key(id_col, seed, others) < format(int(test_size * 16 ** 8), "08x")


def train_test_split(df: DataFrame, id_col: str, test_size: float = 0.2,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    test = in_test_part(id_col, test_size, seed, stand_ins(df, id_col))
    return df.filter(~test), df.filter(test)


def concat_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def _histogram(df: DataFrame, id_col: str, stratum: str, seed: int) -> DataFrame:
    """Rows per stratum and key prefix: at most 16^4 rows per stratum, whatever the input."""
    key = shuffle_key(id_col, seed, stand_ins(df, id_col))
    bucket = F.substring(key, 1, BUCKET_DIGITS)
    return df.groupBy(F.col(stratum).alias("stratum"), bucket.alias("bucket")) \
             .agg(F.count("*").alias("n"))


def take_per_stratum(df: DataFrame, id_col: str, stratum: str, quotas: dict,
                     seed: int = 42) -> DataFrame:
    """Exactly ``quotas[s]`` rows of every stratum ``s``: those with the smallest keys.

    Ranking a whole stratum would sort it in one task. Instead a histogram over key
    prefixes tells in which prefix the quota is reached. Rows below it are taken by a plain
    filter; only the rows of that one prefix, 1/65536 of the stratum, are ranked.
    """
    by_bucket = Window.partitionBy("stratum").orderBy("bucket")
    up_to = F.sum("n").over(by_bucket)
    quota = F.create_map(*[F.lit(x) for pair in quotas.items() for x in pair])
    cuts = (_histogram(df.filter(F.col(stratum).isin(list(quotas))), id_col, stratum, seed)
            .withColumn("before", up_to - F.col("n"))
            .withColumn("quota", F.element_at(quota, F.col("stratum")))
            .filter("before < quota and quota <= before + n").collect())  # one row per stratum
    key = shuffle_key(id_col, seed, stand_ins(df, id_col))
    bucket = F.substring(key, 1, BUCKET_DIGITS)
    below, at, rest = F.lit(False), F.lit(False), F.lit(0)
    for cut in cuts:
        mine = F.col(stratum) == cut.stratum
        below = below | (mine & (bucket < cut.bucket))
        at = at | (mine & (bucket == cut.bucket))
        rest = F.when(mine, F.lit(cut.quota - cut.before)).otherwise(rest)
    ranked = (df.filter(at)
              .withColumn("_rank", F.row_number().over(
                  Window.partitionBy(stratum).orderBy(key, id_col)))
              .filter(F.col("_rank") <= rest).drop("_rank"))
    return df.filter(below).unionByName(ranked)


def balanced_sample(df: DataFrame, id_col: str, label: str = "toxic",
                    size: int = SAMPLE_SIZE, seed: int = 42) -> DataFrame:
    """At most a quarter of ``size`` toxic rows, the rest clean; all rows if there are fewer.

    Too few clean rows to fill the sample is an error, not a smaller sample.
    """
    counts = {r[label]: r["n"] for r in
              df.groupBy(label).agg(F.count("*").alias("n")).collect()}  # a row per label value
    if sum(counts.values()) <= size:
        return df
    toxic = min(size // 4, counts.get(1, 0))
    clean = size - toxic
    if counts.get(0, 0) < clean:
        raise ValueError(f"{clean} clean rows needed, {counts.get(0, 0)} found")
    return take_per_stratum(df, id_col, label, {1: toxic, 0: clean}, seed)
