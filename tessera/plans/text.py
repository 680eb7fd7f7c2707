"""Word counts over text columns: split, explode, aggregate.

The aggregate is partial on the map side, so a very frequent word ("the")
is pre-counted in every task before the shuffle; no word's occurrences are
ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Unicode white space and the four ASCII separators.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


def word_count_whitespace(df: DataFrame, text: str = "text") -> DataFrame:
    """Split on runs of (Unicode) whitespace, drop empty tokens, lower-case, count;
    most frequent first (ties by word).  The text is lower-cased once per
    document (the same tokens as lowering each word: lower-casing neither
    adds nor removes whitespace)."""
    words = (df.select(F.explode(F.split(F.lower(F.col(text)), WHITESPACE)).alias("word"))
             .where(F.col("word") != ""))
    return words.groupBy("word").count().orderBy(F.desc("count"), F.asc("word"))


def word_count_space(df: DataFrame, text: str = "text") -> DataFrame:
    """Split on single spaces (double blanks give empty tokens, which are
    counted), lower-case, count; most frequent first."""
    words = df.select(F.explode(F.split(F.lower(F.col(text)), " ")).alias("word"))
    return words.groupBy("word").count().orderBy(F.desc("count"), F.asc("word"))
