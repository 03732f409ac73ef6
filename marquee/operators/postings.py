"""Search over a large catalogue by stored postings.

``build_postings`` writes, once per catalogue, which titles hold which three
letters in a row in which column. A search reads only the postings of the
trigrams of its terms, keeps the titles that hold all of them, and tests
these by the terms themselves, so its rows are those of ``search_titles``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.search import _terms, search_titles

BUCKETS = 128
SPREAD = 8
SEARCHED = ("genres", "cast", "director")


def _grams(text: Column) -> Column:
    """Distinct trigrams of lower-cased text; none for shorter text."""
    low = F.lower(text)
    return F.when(F.length(low) >= 3, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(low) - 2, F.lit(1))), lambda i: F.substring(low, i, F.lit(3)))))


def _bucket(column: Column, gram: Column) -> Column:
    return F.pmod(F.xxhash64(column, gram), F.lit(BUCKETS)).cast("int")


def build_postings(df: DataFrame, path: str, columns: Sequence[str] = SEARCHED) -> None:
    """Write (field, gram, id) in a folder per bucket of (field, gram),
    sorted by gram, so that a search opens few folders and skips most of
    their row groups. A bucket is written by ``SPREAD`` tasks: a trigram that
    most titles hold is not gathered in one."""
    entries = F.concat(*map(_entries, columns))
    rows = df.select("id", F.explode(entries).alias("x")).select("x.field", "x.gram", "id").withColumn(
        "bucket", _bucket(F.col("field"), F.col("gram")))
    (rows.repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(SPREAD))).sortWithinPartitions("bucket", "field", "gram")
     .write.mode("overwrite").partitionBy("bucket").parquet(path))


def _entries(column: str) -> Column:
    grams = F.coalesce(_grams(F.col(column)), F.array().cast("array<string>"))
    return F.transform(grams, lambda g: F.struct(F.lit(column).alias("field"), g.alias("gram")))


def asked_grams(**terms: str | Sequence[str] | None) -> set[tuple[str, str]]:
    """The (column, trigram) pairs that a match must hold."""
    out = set()
    for column, value in terms.items():
        for term in _terms(value):
            low = term.lower()
            out |= {(column, low[i:i + 3]) for i in range(len(low) - 2)}
    return out


def candidates(spark: SparkSession, path: str, asked: set[tuple[str, str]]) -> DataFrame:
    """Ids of the titles that hold all asked trigrams. The folders read are
    those of the trigrams' buckets, known when the plan is made."""
    pairs = sorted(asked)
    numbered = spark.createDataFrame(pairs, "field string, gram string")
    buckets = sorted(numbered.agg(F.collect_set(_bucket(F.col("field"), F.col("gram"))).alias("b")).first()["b"])
    wanted = reduce(lambda a, b: a | b, [(F.col("field") == f) & (F.col("gram") == g) for f, g in pairs])
    held = spark.read.parquet(path).where(F.col("bucket").isin(buckets) & wanted)
    return held.groupBy("id").agg(F.count_distinct("field", "gram").alias("n")).where(
        F.col("n") == len(pairs)).select("id")


def search_indexed(df: DataFrame, path: str, genres: str | Sequence[str] | None = None,
                   cast: str | Sequence[str] | None = None, director: str | Sequence[str] | None = None,
                   sort_by: str = "vote_average", ascending: bool = False, match: str = "substring") -> DataFrame:
    """``search_titles`` by way of the postings at ``path``. Terms of under
    three letters prune nothing; without a longer one this is the plain
    search. ``path`` must hold the postings of ``df`` as it is now."""
    asked = asked_grams(genres=genres, cast=cast, director=director)
    data = df.join(candidates(df.sparkSession, path, asked), "id", "left_semi") if asked else df
    return search_titles(data, genres, cast, director, sort_by, ascending, match)
