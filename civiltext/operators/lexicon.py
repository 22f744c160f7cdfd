"""Toxicity lexicons.

A lexicon is an ordered list of (term, category). The list form builds column
expressions; the table form takes part in joins. Terms with a space are phrases.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from civiltext import tables
from civiltext.sources.shared import cut_lineage

# A lexicon up to this many terms is written into expressions; beyond it, use the join form.
MAX_INLINE_TERMS = 5_000


class Lexicon:
    """An ordered, immutable set of terms; a later listing of a term overrides its category."""

    def __init__(self, listing: Iterable[tuple[str, str]]):
        self.listing = [(term, category) for term, category in listing]
        self.category = dict(self.listing)

    @classmethod
    def default(cls) -> "Lexicon":
        return cls.from_groups(tables.LEXICON)

    @classmethod
    def from_groups(cls, groups: Mapping[str, Iterable[str]]) -> "Lexicon":
        return cls((term, category) for category, terms in groups.items() for term in terms)

    def extend(self, groups: Mapping[str, Iterable[str]]) -> "Lexicon":
        """A new lexicon with more terms; they override earlier listings."""
        more = [(term.lower(), category) for category, terms in groups.items() for term in terms]
        return Lexicon(self.listing + more)

    def add_words(self, words: Iterable[str], category: str = "custom") -> "Lexicon":
        return self.extend({category: list(words)})

    @property
    def terms(self) -> list[str]:
        return list(self.category)

    @property
    def words(self) -> dict[str, str]:
        """Single-word terms with their category."""
        return {t: c for t, c in self.category.items() if " " not in t}

    @property
    def phrases(self) -> dict[str, str]:
        """Terms of several words with their category."""
        return {t: c for t, c in self.category.items() if " " in t}

    def check_inline(self) -> None:
        if len(self.category) > MAX_INLINE_TERMS:
            raise ValueError(f"{len(self.category)} terms are too many for expressions "
                             f"(limit {MAX_INLINE_TERMS}); use detect_table")

    def listing_table(self, spark: SparkSession) -> DataFrame:
        """Every listing, duplicates included: ``term, category, ord``."""
        rows = [(t, c, i) for i, (t, c) in enumerate(self.listing)]
        return spark.createDataFrame(rows, "term string, category string, ord int")

    def table(self, spark: SparkSession) -> DataFrame:
        """``term, category, is_phrase, ord``, one row per distinct term."""
        return resolve_listing(self.listing_table(spark))


def resolve_listing(listing: DataFrame) -> DataFrame:
    """One row per term: the category of the last listing, the position of the first.

    Runs as one partially aggregated ``groupBy``, so listings of any size will do.
    """
    return (listing.groupBy("term")
            .agg(F.max_by("category", "ord").alias("category"),
                 F.min("ord").alias("ord"))
            .select("term", "category", F.contains("term", F.lit(" ")).alias("is_phrase"), "ord"))


def combine_listings(*listings: DataFrame) -> DataFrame:
    """Stack listings; terms of a later one override those of an earlier one."""
    stacked = None
    for rank, listing in enumerate(listings):
        part = listing.select(F.lower("term").alias("term"), "category",
                              F.struct(F.lit(rank).alias("rank"), F.col("ord")).alias("ord"))
        stacked = part if stacked is None else stacked.unionByName(part)
    return resolve_listing(stacked)


def terms_per_category(lexicon: DataFrame) -> DataFrame:
    return lexicon.groupBy("category").agg(F.count("*").alias("terms"))


def replacement_order(replacements: DataFrame) -> DataFrame:
    """Application order of replacements: longest term first, ties in listing order.

    A range-partitioned sort; the rank is the place in the own part plus the sizes of the
    parts before, of which there are as many rows as parts.
    """
    ranked = cut_lineage(
        replacements.select("term", "neutral", "ord").orderBy(F.desc(F.length("term")), "ord")
        .withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = ranked.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n"))
                          .alias("_before"))
    return (ranked.withColumn("_part", part).join(F.broadcast(before), "_part")
            .select("term", "neutral", "ord",
                    (F.col("_before") + place + 1).cast("int").alias("step")))
