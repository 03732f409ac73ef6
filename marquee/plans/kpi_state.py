"""Group reports kept up to date from partial aggregates.

The reports by membership, collection, director, genre and year are sums,
counts and medians, so a catalogue that changes in a few titles need not be
read again: what the old rows of these titles gave is taken back, what their
new rows give is added. The store under ``base`` holds, per version:

* ``sums``: per (report, key, measure) the rows, titles, non-null values and
  their exact decimal sum;
* ``values``: counted values per (report, key, measure): those that medians
  are taken from, and those that a decimal of 6 places does not hold, which
  are summed as doubles;
* ``facts``: the columns the reports read, per title, in ``BUCKETS`` folders
  by a hash of the id; a refresh appends a version of the touched titles and
  reads only the folders they lie in.

A version counts once its marker in ``versions`` is written, last of all; a
refresh that failed half-way is simply done again, over the same folders.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.functions.columns import split_multi
from marquee.operators.groups import median_of_counts, membership_label
from marquee.operators.metrics import add_metrics

BUCKETS = 256
FACTS = ["id", "title", "release_date", "genres", "belongs_to_collection", "director", "budget_musd",
         "revenue_musd", "vote_average", "popularity"]
# measures of each report: summed ones, and those of a median
SUMMED: Mapping[str, tuple[str, ...]] = {
    "membership": ("revenue_musd", "budget_musd", "popularity", "vote_average"),
    "collection": ("budget_musd", "revenue_musd", "vote_average"),
    "director": ("revenue_musd", "vote_average"),
    "year": ("revenue_musd",),
}
MEDIANS: Mapping[str, tuple[str, ...]] = {"membership": ("roi",), "genre": ("roi",)}
PLACES = "decimal(38,6)"
GROUP = ["report", "key", "measure"]


def _bucket(column: Column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BUCKETS)).cast("int")


def facts_of(clean: DataFrame) -> DataFrame:
    """The columns the reports read, with the bucket of the id."""
    return clean.select(*FACTS, _bucket(F.col("id")).alias("bucket"))


def contributions(facts: DataFrame, sign: int = 1) -> DataFrame:
    """What every title adds to the reports: (report, key, measure, median,
    value, titles, rows), the last two with ``sign``. The measure "" carries
    the rows and titles of a group."""
    data = add_metrics(facts).withColumn("_label", membership_label(facts))
    has_sales = F.col("release_date").isNotNull() & F.col("revenue_musd").isNotNull()
    keys = {
        "membership": F.array("_label"),
        "collection": F.array("belongs_to_collection"),
        "director": F.coalesce(split_multi("director"), F.array().cast("array<string>")),
        "genre": F.when(F.col("roi").isNotNull(), F.coalesce(split_multi("genres"), F.array().cast("array<string>"))),
        "year": F.array(F.when(has_sales, F.year("release_date").cast("string"))),
    }

    def added(report: str, of: Column) -> Column:
        measured = [("", F.lit(False), F.lit(None).cast("double"))]
        measured += [(m, F.lit(False), F.col(m)) for m in SUMMED.get(report, ())]
        measured += [(m, F.lit(True), F.col(m)) for m in MEDIANS.get(report, ())]
        entry = F.array(*[F.struct(F.lit(m).alias("measure"), median.alias("median"),
                                   value.cast("double").alias("value")) for m, median, value in measured])
        present = F.filter(F.coalesce(of, F.array().cast("array<string>")), lambda k: k.isNotNull())
        return F.flatten(F.transform(present, lambda k: F.transform(entry, lambda x: F.struct(
            F.lit(report).alias("report"), k.alias("key"), x["measure"].alias("measure"),
            x["median"].alias("median"), x["value"].alias("value")))))

    parts = [added(report, of) for report, of in keys.items()]
    return data.select(F.when(F.col("title").isNotNull(), F.lit(sign)).otherwise(F.lit(0)).alias("titles"),
                       F.explode(F.concat(*parts)).alias("x")).select("x.*", "titles", F.lit(sign).alias("sign"))


def _plain(value: Column) -> Column:
    """Whether a decimal of 6 places holds the value."""
    return (F.abs(value) < F.lit(1e17)) & (F.round(value, 6) == value)


def partial(contributed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sums, values) of contributions."""
    rows = contributed.withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    held = F.when(_plain(F.col("value")), F.col("value").cast(PLACES)) * F.col("sign")
    sums = rows.where(~F.col("median")).groupBy(*GROUP).agg(
        F.sum("sign").alias("rows"), F.sum("titles").alias("titles"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("sign")).otherwise(F.lit(0))).alias("n"),
        F.sum(F.when(_plain(F.col("value")), F.col("sign")).otherwise(F.lit(0))).alias("n_held"),
        F.coalesce(F.sum(held.cast("decimal(28,6)")), F.lit(0)).cast(PLACES).alias("total"))
    values = rows.where(F.col("value").isNotNull() & (F.col("median") | ~_plain(F.col("value")))).groupBy(
        *GROUP, "value").agg(F.sum("sign").alias("n"))
    return sums, values


def _added(sums: list[DataFrame], values: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    def union(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    total = union(sums).groupBy(*GROUP).agg(
        *[F.sum(c).alias(c) for c in ("rows", "titles", "n", "n_held")], F.sum("total").cast(PLACES).alias("total"))
    counts = union(values).groupBy(*GROUP, "value").agg(F.sum("n").alias("n"))
    return total.where("rows != 0"), counts.where("n != 0")


def _version(spark: SparkSession, base: str) -> int:
    """The newest finished version; 0 when there is none."""
    from pyspark.errors import AnalysisException

    try:
        found = spark.read.schema("done boolean, version bigint").parquet(f"{base}/versions")
        return int(found.agg(F.max("version")).first()[0] or 0)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return 0


def _publish(spark: SparkSession, base: str, version: int, facts: DataFrame, state) -> None:
    sums, values = state
    facts.write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/facts/version={version}")
    sums.write.mode("overwrite").parquet(f"{base}/sums/version={version}")
    values.write.mode("overwrite").parquet(f"{base}/values/version={version}")
    spark.range(1).select(F.lit(True).alias("done")).coalesce(1).write.mode("overwrite").parquet(
        f"{base}/versions/version={version}")


def _facts(spark: SparkSession, base: str, version: int, schema) -> DataFrame:
    """All fact rows up to a version, newest of each title last to win."""
    return spark.read.schema(schema).parquet(f"{base}/facts").where(F.col("version") <= version)


def _newest(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("id").orderBy(F.col("version").desc())
    return rows.withColumn("_k", F.row_number().over(order)).where("_k = 1 AND present").drop("_k")


def build_kpis(spark: SparkSession, clean: DataFrame, base: str) -> int:
    """Start the store from a whole catalogue; returns the version. Ids are
    unique and not null, as in a clean catalogue."""
    base = base.rstrip("/")
    version = _version(spark, base) + 1
    facts = facts_of(clean)
    state = partial(contributions(facts))
    _publish(spark, base, version, facts.withColumn("present", F.lit(True)),
             (state[0].where("rows != 0"), state[1].where("n != 0")))
    return version


def touched_facts(spark: SparkSession, base: str, touched: DataFrame) -> DataFrame:
    """The stored rows of the touched ids (``id``): only the folders of
    their buckets are read."""
    base = base.rstrip("/")
    # one row: a set of the fixed number of buckets
    buckets = touched.agg(F.collect_set(_bucket(F.col("id"))).alias("buckets")).first()["buckets"]
    schema = spark.read.parquet(f"{base}/facts").schema
    rows = _facts(spark, base, _version(spark, base), schema).where(F.col("bucket").isin(buckets))
    return _newest(rows.join(touched.select("id").distinct(), "id", "left_semi"))


def refresh_kpis(spark: SparkSession, base: str, touched: DataFrame, fresh: DataFrame) -> int:
    """Bring the store up to date: ``touched`` names the ids that may have
    changed (any superset), ``fresh`` holds the clean rows these ids have
    now; an id that is touched and has no row is gone. Returns the version."""
    base = base.rstrip("/")
    ids = touched.select(F.col("id").try_cast("bigint").alias("id")).where(F.col("id").isNotNull()).distinct()
    version = _version(spark, base)
    if not version:
        raise ValueError(f"{base} holds no reports yet: build_kpis comes first")
    old = touched_facts(spark, base, ids)
    new = facts_of(fresh.join(ids, "id", "left_semi"))
    change = partial(contributions(old.select(*FACTS), -1).unionByName(contributions(new.select(*FACTS))))
    sums = spark.read.parquet(f"{base}/sums/version={version}")
    values = spark.read.parquet(f"{base}/values/version={version}")
    # an id without a row now is stored as one that is not present
    rows = ids.join(new.drop("bucket"), "id", "left").join(
        new.select("id", F.lit(True).alias("present")), "id", "left").select(
        *FACTS, F.coalesce("present", F.lit(False)).alias("present"), _bucket(F.col("id")).alias("bucket"))
    _publish(spark, base, version + 1, rows, _added([sums, change[0]], [values, change[1]]))
    return version + 1


def kpi_reports(spark: SparkSession, base: str, min_movies: int = 2) -> dict[str, DataFrame]:
    """The reports from the store, equal to those of ``operators.groups``:
    membership, collection, director, genre, year."""
    base = base.rstrip("/")
    version = _version(spark, base)
    sums = spark.read.parquet(f"{base}/sums/version={version}")
    values = spark.read.parquet(f"{base}/values/version={version}")
    loose = values.join(sums.where("measure != ''").select(*GROUP), GROUP, "left_semi").groupBy(*GROUP).agg(
        F.sum(F.col("value") * F.col("n")).alias("loose"))
    both = sums.join(loose, GROUP, "left")
    total = (F.when(F.col("n") == 0, F.lit(None).cast("double"))
             .when(F.col("loose").isNull(), F.col("total").cast("double"))
             .when(F.col("n_held") == 0, F.col("loose")).otherwise(F.col("total").cast("double") + F.col("loose")))
    measured = both.select(*GROUP, "titles", "n", total.alias("sum"))

    def report(name: str, key: str, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
        def of(measure: str, kind: str) -> Column:
            value = F.col("sum") if kind == "sum" else F.when(F.col("n") > 0, F.col("sum") / F.col("n"))
            return F.max(F.when(F.col("measure") == measure, value))

        return measured.where(F.col("report") == name).groupBy(F.col("key").alias(key)).agg(
            F.max(F.when(F.col("measure") == "", F.col("titles"))).alias("num_movies"),
            *[of(m, kind).alias(c) for c, (m, kind) in columns.items()])

    def median(name: str, key: str) -> DataFrame:
        counted = values.where((F.col("report") == name) & (F.col("measure") == "roi")).select(
            F.col("key").alias(key), F.col("value").alias("_v"), F.col("n").alias("_w"))
        return median_of_counts(counted, [key], "median_roi")

    member = report("membership", "is_franchise", {
        "mean_revenue": ("revenue_musd", "mean"), "mean_budget": ("budget_musd", "mean"),
        "mean_popularity": ("popularity", "mean"), "mean_rating": ("vote_average", "mean")})
    money = {f"{kind}_{m}": (f"{m}_musd", "sum" if kind == "total" else "mean")
             for m in ("budget", "revenue") for kind in ("total", "mean")}
    collection = report("collection", "belongs_to_collection", {**money, "mean_rating": ("vote_average", "mean")})
    director = report("director", "director", {"total_revenue": ("revenue_musd", "sum"),
                                               "mean_rating": ("vote_average", "mean")})
    return {
        "membership": member.join(median("membership", "is_franchise"), "is_franchise", "left").select(
            "is_franchise", "mean_revenue", "median_roi", "mean_budget", "mean_popularity",
            "mean_rating").orderBy("is_franchise"),
        "collection": collection.where(F.col("num_movies") >= min_movies).orderBy(
            F.col("total_revenue").desc_nulls_last(), "belongs_to_collection"),
        "director": director.orderBy(F.col("total_revenue").desc_nulls_last(), "director"),
        "genre": median("genre", "genres").orderBy("median_roi", "genres"),
        "year": report("year", "year", {"total_revenue": ("revenue_musd", "sum")}).select(
            F.col("year").cast("int").alias("year"), "total_revenue").orderBy("year"),
    }
