"""How many tokens each source, language and domain holds.

Whole texts are hashed and deduplicated, each distinct text is tokenised once, and the count is
joined back by hash to the exact multiplicities of every group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tokens import with_counts


def digest(text: Column) -> Column:
    """128 bits that stand for a text; null for null."""
    return F.unhex(F.md5(text))


def multiplicities(df: DataFrame, item: str, text: str, by: list[str]) -> DataFrame:
    """``__hash, <by>, __copies``: how many items of a combination have each text, by its hash (null for none)."""
    slim = df.select(df[item].alias("__item"), digest(df[text]).alias("__hash"), *by)
    items = slim.groupBy("__item", *by).agg(F.min("__hash").alias("__hash"))
    return items.groupBy("__hash", *by).agg(F.count(F.lit(1)).alias("__copies"))


def text_counts(df: DataFrame, item: str, text: str, by: list[str]) -> DataFrame:
    """One row a combination of ``by``: ``n_videos`` and ``n_texts``, the distinct texts among them."""
    counted = multiplicities(df, item, text, by).groupBy(*by)
    return counted.agg(F.sum("__copies").alias("n_videos"), F.count("__hash").alias("n_texts"))


def token_budget(
    df: DataFrame, item: str, text: str, by: list[str], tokenizer: str = "byte_bpe_50k", directory: str | None = None
) -> DataFrame:
    """One row for each combination of ``by`` as stored (null is a value of its own): ``n_videos``
    and ``n_tokens``, each ``item`` counted once in a combination.

    Null and empty texts count 0 tokens. If rows of one item in one combination differ in text, the
    text of the smallest hash counts; a null ``item`` is an item. An empty table gives no rows.

    What is shuffled is one copy of every distinct text, after a map-side choice, and 16-byte hashes;
    texts are grouped by their hash, never by themselves. The groups are counted over (group, hash),
    so no group or text is ever gathered in one task.
    """
    copies = multiplicities(df, item, text, by)
    texts = df.where(df[text].isNotNull()).select(digest(df[text]).alias("__hash"), df[text].alias("__whole"))
    texts = texts.groupBy("__hash").agg(F.first("__whole").alias("__whole"))
    counted = with_counts(texts, "__whole", ["__hash"], "__n", tokenizer, directory)
    # rows without a text meet none, so they stay out of the join
    some = copies.where("__hash is not null").join(counted, "__hash", "left").drop("__hash")
    none = copies.where("__hash is null").select(*by, "__copies", F.lit(None).cast("long").alias("__n"))
    return (
        some.unionByName(none)
        .groupBy(*by)
        .agg(
            F.sum("__copies").alias("n_videos"),
            F.sum(F.col("__copies") * F.coalesce("__n", F.lit(0))).alias("n_tokens"),
        )
    )
