"""A raw title catalogue derived from the TPC-H-style tables.

One title per ``part``. Money, votes, dates and credits come from the
part's ``lineitem`` rows, its suppliers and their nations / regions. The
mapping also plants every kind of defect the cleaning stages repair, on
fixed residues of the part key, so each stage has work at every scale.

Execution shape (all DataFrame operators, no driver loop):

* lineitem is aggregated twice: first to (part, supplier) pairs with
  map-side partial aggregation, so a part holding a third of all lines
  collapses to one row per supplier per task before any shuffle; then
  to one row per part (the pair rows are already few).
* suppliers, nations and regions are joined at pair level with no
  broadcast hint: Catalyst (from file statistics) and AQE (from the
  measured shuffle size) broadcast a side only when it is under
  ``spark.sql.autoBroadcastJoinThreshold`` and fall back to a sort-merge
  join otherwise, which AQE splits further when one supplier is hot.
* per-part lists come from a ``collect_set`` over fixed-size tables: the
  suppliers' nations (cast, production countries; at most 25), crew
  (nation, job) entries (at most 75) and regions (at most 5). A part
  holding a third of all lines still yields bounded arrays.
* duplicates are produced with ``explode`` of a copy number, not with a
  union that would run the aggregation twice.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.schemas import DIRECTOR_JOB
from marquee.sources.sinks import encode_raw

# ---------------------------------------------------------------------------
# FIXED VALUES of the mapping (defect planting on residues of the part key)
# ---------------------------------------------------------------------------
NULL_ID = (97, 13)          # id missing
NULL_TITLE = (53, 7)        # title missing
UNRELEASED = (11, 3)        # status 'In Production'
DUPLICATED = (29, 0)        # title appears twice (second copy: popularity + 1)
BAD_BUDGET = (101, 5)       # budget text 'abc'
ZERO_BUDGET = (17, 0)       # budget '0'
ZERO_VOTES = (23, 0)        # vote_count '0'
ZERO_RUNTIME = (19, 0)      # runtime '0'
BAD_DATE = (89, 1)          # release_date 'xx'
NO_GENRES = (13, 0)         # genres '[]'
SPARSE = (37, 4)            # everything but id, title, status missing
NO_OVERVIEW = (31, 1)       # overview 'No overview found.'
EMPTY_OVERVIEW = (31, 2)    # overview ''
NO_TAGLINE = (31, 3)        # tagline 'No Data'
EMPTY_TAGLINE = (31, 4)     # tagline ''
DATE_SPREAD_DAYS = 2500     # release = first ship date + (key mod this) days
STANDALONE_SIZE_MOD = 5     # p_size divisible by this -> no collection

RAW_KEYS = [
    "adult", "backdrop_path", "belongs_to_collection", "budget", "credits", "genres",
    "homepage", "id", "imdb_id", "origin_country", "original_language", "original_title",
    "overview", "popularity", "poster_path", "production_companies", "production_countries",
    "release_date", "revenue", "runtime", "softcore", "spoken_languages", "status",
    "tagline", "title", "video", "vote_average", "vote_count",
]


def _on(k: Column, rule: tuple[int, int]) -> Column:
    return (k % F.lit(rule[0])) == F.lit(rule[1])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def supplier_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (part, supplier) with the pair's line measures and the
    crew jobs implied by its line numbers."""
    li = _table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_shipdate")
    return li.groupBy("l_partkey", "l_suppkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("price"),
        F.count_if(F.col("l_returnflag") == "R").alias("returns"),
        F.sum("l_quantity").alias("qty"),
        F.count(F.lit(1)).alias("lines"),
        F.min(F.col("l_shipdate").cast("date")).alias("first_ship"),
        F.max(F.col("l_linenumber") == 1).alias("is_director"),
        F.max(F.col("l_linenumber") == 2).alias("is_writer"),
        F.max(F.col("l_linenumber") > 2).alias("is_crew"),
    )


def title_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part: revenue, returns, quantity, lines, first ship
    date, and the sorted lists of its suppliers' nations (the cast and
    the production countries), crew (nation, job) entries and regions.

    The lists come from one ``collect_set`` over fixed-size tables (25
    nations with their regions, 3 jobs), so a title's arrays stay bounded
    however many lines or suppliers a part has."""
    sup = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "left") \
        .select("n_nationkey", "n_name", "r_name")
    pairs = supplier_pairs(spark, sf_dir)
    named = pairs.join(sup, pairs.l_suppkey == sup.s_suppkey, "left") \
        .join(geo, F.col("s_nationkey") == F.col("n_nationkey"), "left")

    def listed(name: str, flag: str | None = None) -> Column:
        some = F.filter("_places", lambda x: x[name].isNotNull() & (x[flag] if flag else F.lit(True)))
        return F.array_distinct(F.transform(some, lambda x: x[name]))

    crew = F.concat(
        F.transform(F.col("_crew"), lambda n: F.struct(n.alias("name"), F.lit("Crew").alias("job"))),
        F.transform(F.col("_dir"), lambda n: F.struct(n.alias("name"), F.lit(DIRECTOR_JOB).alias("job"))),
        F.transform(F.col("_wri"), lambda n: F.struct(n.alias("name"), F.lit("Writer").alias("job"))))
    return named.groupBy("l_partkey").agg(
        F.sum("price").alias("price"),
        F.sum("returns").alias("returns"),
        F.sum("qty").alias("qty"),
        F.sum("lines").alias("lines"),
        F.min("first_ship").alias("first_ship"),
        # one set a part: a buffer for each list costs more than the rest of the job
        F.collect_set(F.struct("n_name", "r_name", "is_crew", "is_director", "is_writer")).alias("_places"),
    ).withColumns({
        "nations": F.sort_array(listed("n_name")), "regions": F.sort_array(listed("r_name")),
        "_crew": listed("n_name", "is_crew"), "_dir": listed("n_name", "is_director"),
        "_wri": listed("n_name", "is_writer"),
    }).select("l_partkey", "price", "returns", "qty", "lines", "first_ship", "nations", "regions",
             F.col("nations").alias("cast_names"), F.sort_array(crew).alias("crew"))


def title_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title records as an upstream API would deliver them: scalars as
    text, nested fields as real arrays / structs, null where absent."""
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    facts = title_facts(spark, sf_dir)
    t = part.join(facts, part.p_partkey == facts.l_partkey, "left") \
        .withColumn("_copy", F.explode(F.when(_on(F.col("p_partkey"), DUPLICATED), F.array(F.lit(0), F.lit(1)))
                                       .otherwise(F.array(F.lit(0)))))
    k = F.col("p_partkey")
    ks = k.cast("string")
    s = lambda c: c.cast("string")
    genres = F.transform(F.split(F.col("p_name"), " "),
                         lambda w, i: F.struct((i + 1).alias("id"), w.alias("name")))
    record = {
        "adult": F.lit("False"),
        "backdrop_path": F.concat(F.lit("/b"), ks, F.lit(".jpg")),
        "belongs_to_collection": F.when(
            F.col("p_size") % STANDALONE_SIZE_MOD != 0,
            F.struct(F.col("p_size").alias("id"),
                     F.concat(F.col("p_brand"), F.lit("/"), s(F.col("p_size"))).alias("name"))),
        "budget": F.when(_on(k, BAD_BUDGET), F.lit("abc")).when(_on(k, ZERO_BUDGET), F.lit("0"))
        .otherwise(s(F.col("p_size").cast("bigint") * 1_000_000)),
        "credits": F.struct(
            F.transform(F.col("cast_names"), lambda n, i: F.struct(n.alias("name"), i.alias("order"))).alias("cast"),
            F.col("crew").alias("crew")),
        "genres": F.when(_on(k, NO_GENRES), F.array().cast(genres_type())).otherwise(genres),
        "homepage": F.concat(F.lit("https://example.com/title/"), ks),
        "id": F.when(_on(k, NULL_ID), F.lit(None).cast("string")).otherwise(ks),
        "imdb_id": F.concat(F.lit("tt"), F.when(F.length(ks) < 7, F.lpad(ks, 7, "0")).otherwise(ks)),
        "origin_country": F.col("nations"),
        "original_language": F.lower(F.substring(F.col("p_type"), 1, 2)),
        "original_title": F.col("p_name"),
        "overview": F.when(_on(k, NO_OVERVIEW), F.lit("No overview found."))
        .when(_on(k, EMPTY_OVERVIEW), F.lit(""))
        .otherwise(F.concat(F.lit("A "), F.lower(F.col("p_type")), F.lit(" "), F.col("p_name"), F.lit(" title."))),
        "popularity": s(F.col("qty") + F.col("_copy")),
        "poster_path": F.concat(F.lit("/p"), ks, F.lit(".jpg")),
        "production_companies": F.array(F.struct(F.col("p_brand").alias("name"))),
        "production_countries": F.transform(F.col("nations"), lambda n: F.struct(n.alias("name"))),
        "release_date": F.when(_on(k, BAD_DATE), F.lit("xx")).otherwise(
            F.date_format(F.date_add(F.col("first_ship"), (k % DATE_SPREAD_DAYS).cast("int")), "yyyy-MM-dd")),
        "revenue": s((F.col("price") * 100).cast("bigint")),
        "runtime": F.when(_on(k, ZERO_RUNTIME), F.lit("0")).otherwise(s(F.col("p_size") * 3)),
        "softcore": F.lit("False"),
        "spoken_languages": F.transform(
            F.col("regions"), lambda r: F.struct(r.alias("english_name"), F.lower(r).alias("name"))),
        "status": F.when(_on(k, UNRELEASED), F.lit("In Production")).otherwise(F.lit("Released")),
        "tagline": F.when(_on(k, NO_TAGLINE), F.lit("No Data")).when(_on(k, EMPTY_TAGLINE), F.lit(""))
        .otherwise(F.concat(F.col("p_type"), F.lit(" "), F.col("p_brand"))),
        "title": F.when(_on(k, NULL_TITLE), F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("p_name"), F.lit(" #"), ks)),
        "video": F.lit("False"),
        "vote_average": s(F.floor(F.col("qty") * 2 / F.col("lines")) / 10),
        "vote_count": F.when(_on(k, ZERO_VOTES), F.lit("0")).otherwise(s(F.col("returns"))),
    }
    keep_when_sparse = {"id", "title", "status"}
    sparse = _on(k, SPARSE)
    cols = []
    for name in RAW_KEYS:
        c = record[name]
        if name not in keep_when_sparse:
            c = F.when(~sparse, c)
        cols.append(c.alias(name))
    return t.select(*cols)


def genres_type() -> str:
    return "array<struct<id:int,name:string>>"


def raw_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw catalogue in raw-cache shape: 28 text columns, nested
    fields as JSON text, with planted duplicates, gaps and bad values."""
    return encode_raw(title_records(spark, sf_dir))


def clean_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean catalogue of the tables at ``sf_dir``."""
    from marquee.operators.clean import clean_catalogue

    return clean_catalogue(raw_catalogue(spark, sf_dir))
