"""

Every query derives the title catalogue from the tables at ``sf_dir``
(``marquee.sources.starview``) and runs the library operator on it, so
its work grows with the tables. ``oracle_sql()`` holds, per query, an
independent DuckDB statement over the same tables.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# importable from any working directory: the package sits next to this file
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators import feeds, groups, lattice, quality, ranking, search, trends, variants
from marquee.operators.clean import dedupe_by_id, drop_missing_keys, fix_types, stage_counts
from marquee.operators.nested import flatten, parse_health, parse_nested
from marquee.sources import ingest, starview

# the text operators and their pipeline are optional: without their files
# every other query still works
try:
    from marquee.llm import oracle as _LLM_ORACLE
    from marquee.llm import queries as _LLM
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith("marquee.llm"):
        raise
    _LLM = _LLM_ORACLE = None
try:
    import corpus_pipeline as _PIPELINE
except ModuleNotFoundError as missing:
    if missing.name != "corpus_pipeline" and not (missing.name or "").startswith("marquee.llm"):
        raise
    _PIPELINE = None

FLAGSHIP_SF = "/root/testdata/sf0.001"


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return starview.clean_titles(spark, sf)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: highest-revenue titles of the sf0.001 catalogue."""
    return ranking.highest_revenue(_clean(spark, FLAGSHIP_SF))


def _on_clean(fn):
    """Run a catalogue operator on the clean catalogue of ``sf``."""
    return lambda spark, sf: fn(_clean(spark, sf))


def _typed(spark, sf):
    return fix_types(flatten(parse_nested(starview.raw_catalogue(spark, sf))))


def _stage_counts(spark, sf):
    return stage_counts(starview.raw_catalogue(spark, sf))


def _parse_health(spark, sf):
    parsed = parse_nested(starview.raw_catalogue(spark, sf))
    return parsed.agg(*[c.alias(n) for n, c in parse_health(parsed).items()])


def _dedupe_survivors(spark, sf):
    typed = _typed(spark, sf)
    return dedupe_by_id(drop_missing_keys(typed)).select("id", "popularity", "status")


def _parsed_flattened(spark, sf):
    return flatten(parse_nested(starview.raw_catalogue(spark, sf))).select(
        F.col("id").alias("id_text"), "genres", "belongs_to_collection", "production_companies",
        "production_countries", "spoken_languages", "cast", "cast_size", "director", "crew_size")


def _typed_values(spark, sf):
    return _typed(spark, sf).select(
        "id", "title", "status", "budget_musd", "revenue_musd", "vote_count", "vote_average",
        "popularity", "runtime", "release_date", "overview", "tagline")


def _clean_csv_roundtrip(spark, sf):
    """Clean catalogue written as header CSV under the shared checkpoint
    folder, read back and re-typed by the contract."""
    import uuid

    from marquee.plans.session import scratch_path
    from marquee.sources.raw import read_clean
    from marquee.sources.sinks import write_clean

    path = scratch_path(spark, f"clean-csv-{uuid.uuid4().hex}")
    write_clean(_clean(spark, sf), path, fmt="csv")
    return read_clean(spark, path, fmt="csv")


def _raw_csv_clean(spark, sf):
    """IO1, IO4, IO9 in CSV: the raw catalogue written as CSV, read back as
    text, cleaned, written as a CSV catalogue and read again."""
    import uuid

    from marquee.plans.job import preprocess
    from marquee.plans.session import scratch_path
    from marquee.sources.raw import read_raw
    from marquee.sources.sinks import write_raw

    base = scratch_path(spark, f"raw-csv-{uuid.uuid4().hex}")
    write_raw(starview.raw_catalogue(spark, sf), f"{base}/raw", fmt="csv")
    out, _ = preprocess(spark, read_raw(spark, f"{base}/raw", "csv"), f"{base}/clean", fmt="csv")
    return out


def _cache_growing_keys(spark, sf):
    """IO5, IO8: two landings of the raw cache that differ in keys; the
    cache reads back with the columns of both."""
    import uuid

    from marquee.plans.session import scratch_path
    from marquee.sources.raw import read_raw
    from marquee.sources.sinks import write_raw

    path = scratch_path(spark, f"cache-keys-{uuid.uuid4().hex}")
    raw = starview.raw_catalogue(spark, sf).select("id", "title", "status", "poster_path")
    early = F.col("id").cast("bigint") % 2 == 0
    write_raw(raw.where(early).drop("poster_path"), path)
    write_raw(raw.where(~early | early.isNull()).drop("status"), path)
    return read_raw(spark, path).select("id", "title", "status", "poster_path")


def _raw_encode(spark, sf):
    return starview.raw_catalogue(spark, sf).select(
        "id", "title", "status", "budget", "revenue", "release_date", "popularity",
        "genres", "belongs_to_collection")


def _landing_lines(spark, sf):
    return ingest.to_json_lines(starview.title_records(spark, sf))


def _required_keys_rejects(spark, sf):
    _, bad = ingest.split_records(_landing_lines(spark, sf))
    return bad.select(F.get_json_object("value", "$.id").alias("id"),
                      F.array_join("missing", "|").alias("missing"))


def _ingest_accepted(spark, sf):
    good, _ = ingest.ingest(_landing_lines(spark, sf), starview.RAW_KEYS)
    return good.select("id", "title", "status")


def _cache_gap_fill(spark, sf):
    landing = starview.raw_catalogue(spark, sf)
    cache = landing.where(F.col("release_date") < F.lit("2000-01-01"))
    requested = spark.read.parquet(f"{sf.rstrip('/')}/part.parquet").select(F.col("p_partkey").alias("id"))
    _, new = ingest.gap_fill(cache, landing, requested)
    return cache.select("id", "title", F.lit("cache").alias("origin")).unionByName(
        new.select("id", "title", F.lit("landing").alias("origin")))


def _stream_ingest(spark, sf):
    """Landing JSON lines of the catalogue, written to a fresh folder under
    the shared checkpoint folder, ingested by the file stream."""
    import uuid

    from marquee.plans.session import scratch_path
    from marquee.streaming import ingest_folder

    base = scratch_path(spark, f"stream-ingest-{uuid.uuid4().hex}")
    _landing_lines(spark, sf).write.mode("overwrite").text(f"{base}/landing")
    cache = ingest_folder(spark, f"{base}/landing", f"{base}/cache", f"{base}/rejects",
                          f"{base}/checkpoint", starview.RAW_KEYS)
    return cache.select("id", "title", "status")


def _sql_rank_roi(spark, sf):
    """Highest ROI through the SQL surface: a temp view plus SQL functions."""
    import uuid

    from marquee.functions.sql import register_catalogue

    view = register_catalogue(_clean(spark, sf), f"marquee_titles_{uuid.uuid4().hex}")
    return spark.sql(f"""
        SELECT title, mq_roi(revenue_musd, budget_musd) AS roi, revenue_musd, budget_musd
        FROM {view}
        WHERE budget_musd >= 10 AND mq_roi(revenue_musd, budget_musd) IS NOT NULL
        ORDER BY roi DESC, id ASC LIMIT 5""")


def _clean_refresh(spark, sf):
    """Clean an earlier cache (titles released before 2000), then refresh it
    with the remaining records, recomputing only the ids they touch; the
    result must equal cleaning everything at once."""
    import uuid

    from marquee.plans.job import preprocess, refresh_clean
    from marquee.plans.session import scratch_path

    raw = starview.raw_catalogue(spark, sf)
    early = F.col("release_date") < F.lit("2000-01-01")
    old, new = raw.where(early), raw.where(~early | F.col("release_date").isNull())
    base = scratch_path(spark, f"clean-refresh-{uuid.uuid4().hex}")
    preprocess(spark, old, f"{base}/old")
    return refresh_clean(spark, raw, new.select("id"), f"{base}/old", f"{base}/new")


def _cache_full_hit(spark, sf):
    """Every requested id is cached already: nothing is taken from landing."""
    landing = starview.raw_catalogue(spark, sf)
    cache = landing
    requested = cache.select("id")
    _, new = ingest.gap_fill(cache, landing, requested)
    return cache.select("id", "title", F.lit("cache").alias("origin")).unionByName(
        new.select("id", "title", F.lit("landing").alias("origin")))


def _cache_gap_report(spark, sf):
    landing = starview.raw_catalogue(spark, sf)
    cache = landing.where(F.col("release_date") < F.lit("2000-01-01"))
    requested = spark.read.parquet(f"{sf.rstrip('/')}/part.parquet").select(F.col("p_partkey").alias("id"))
    return ingest.gap_report(cache, landing, requested)


def _search_genres_cast(spark, sf):
    return search.search_titles(_clean(spark, sf), genres=["Hot", "widget"], cast="nation_1",
                                sort_by="vote_average").select("title", "vote_average", "genres", "cast")


def _search_tokens(spark, sf):
    """Whole-item matching: 'NATION_1' as a cast item, not a substring of
    NATION_10 .. NATION_19."""
    return search.search_titles(_clean(spark, sf), genres="RED", cast="nation_1", match="token",
                                sort_by="popularity").select("title", "popularity", "genres", "cast")


def _search_cast_director(spark, sf):
    return search.search_titles(_clean(spark, sf), cast="NATION_12",
                                director="nation_3", sort_by="runtime", ascending=True) \
        .select("title", "runtime", "director", "cast")


def _impute_budget(spark, sf):
    return groups.impute_from_similar(_clean(spark, sf), "budget_musd") \
        .select("id", "budget_musd", "budget_musd_imputed")


def _feed_sample_merged(spark, sf):
    """Samples of three disjoint parts of the catalogue, merged."""
    clean = _clean(spark, sf)
    parts = [feeds.sampled(clean.where(F.col("id") % 3 == i), "budget_musd", "revenue_musd", 20) for i in range(3)]
    return feeds.merge_samples(parts, 20)


def _moved_lines(spark, sf):
    """Landing lines whose shape has moved: budgets as JSON numbers on every
    fifth id, a new nested key on every seventh."""
    lines = _landing_lines(spark, sf)
    k = F.get_json_object("value", "$.id").try_cast("bigint")
    text = F.when(k % 5 == 0, F.regexp_replace("value", r'"budget":"(\d+)"', r'"budget":$1')).otherwise(F.col("value"))
    studio = F.concat(text.substr(F.lit(1), F.length(text) - 1), F.lit(',"studio":{"founded":'),
                      (F.lit(1900) + k % 100).cast("string"), F.lit(',"names":["x",null]}}'))
    return lines.select(F.when(k % 7 == 0, studio).otherwise(text).alias("value"), k.alias("k"),
                        F.when(F.get_json_object("value", "$.release_date") < "2000-01-01", F.lit("early"))
                        .otherwise(F.lit("late")).alias("landing"))


def _schema_drift(spark, sf):
    """IO6, N1-N5: per landing, the paths whose key is unknown or whose type
    has changed; some records are cut off, and some taglines are lists."""
    from marquee.sources import drift

    lines = _moved_lines(spark, sf)
    text = F.when(F.col("k") % 6 == 1, F.regexp_replace("value", r'"tagline":"([^"]*)"', r'"tagline":["$1"]'))
    text = F.when(F.col("k") % 41 == 0, F.substring("value", 1, 20)).otherwise(F.coalesce(text, F.col("value")))
    records = drift.as_variant(lines.select("landing", text.alias("value")))
    shaped = drift.shapes(records, by=["landing"])
    expected = {**drift.expected_types(starview.RAW_KEYS), "$.origin_country": ["ARRAY"]}
    return drift.drift(shaped, expected, starview.RAW_KEYS).where(
        F.col("status").isin("unknown key", "type changed"))


def _clean_from_variant(spark, sf):
    """The clean catalogue from records read as VARIANT, though numbers and
    keys have moved."""
    from marquee.operators.clean import clean_catalogue
    from marquee.sources import drift

    return clean_catalogue(drift.raw_from_variant(drift.as_variant(_moved_lines(spark, sf)), starview.RAW_KEYS))


def _stream_keyed_ingest(spark, sf):
    """IO7, IO8 on an unbounded stream: three drops of landing files with
    repeated and late records, each taken in from the checkpoint the one
    before left. Event time: the release date; 1,000 days of delay."""
    import uuid

    from marquee.plans.session import scratch_path
    from marquee.streaming import keyed

    base = scratch_path(spark, f"stream-keyed-{uuid.uuid4().hex}")
    # derived from the tables once; the three drops take their lines from here
    _landing_lines(spark, sf).withColumn("k", F.get_json_object("value", "$.id").try_cast("bigint")) \
        .write.parquet(f"{base}/lines")
    lines = spark.read.parquet(f"{base}/lines")
    k = F.col("k")
    for i, drop in enumerate((k % 3 == 0, (k % 3 == 1) | (k % 6 == 0), (k % 3 == 2) | (k % 12 == 0))):
        lines.where(drop).select("value").write.text(f"{base}/landing/drop-{i}")
        keyed.ingest_keyed(spark, f"{base}/landing/*", f"{base}/out", "release_date", "1000 days")
    loaded = keyed.keyed_cache(spark, f"{base}/out", starview.RAW_KEYS).select("id", F.lit("loaded").alias("outcome"))
    late = keyed.late_records(spark, f"{base}/out").select(
        F.get_json_object("value", "$.id").alias("id"), F.lit("late").alias("outcome"))
    bad = keyed.rejected_records(spark, f"{base}/out").select(
        F.get_json_object("record", "$.id").alias("id"), F.concat(F.lit("lacks "), "missing").alias("outcome"))
    return loaded.unionByName(late).unionByName(bad)


def _kpi_refresh(spark, sf):
    """A1-A5 kept up to date: reports built from an earlier catalogue (fewer
    titles, other revenues, titles that are gone by now), then refreshed with
    the titles that changed. Long form: report, key, column, value."""
    import uuid

    from marquee.plans import kpi_state
    from marquee.plans.session import scratch_path

    base = scratch_path(spark, f"kpi-refresh-{uuid.uuid4().hex}")
    _clean(spark, sf).write.parquet(f"{base}/clean")
    clean = spark.read.parquet(f"{base}/clean")
    early = clean.where("id % 4 != 0").withColumn("revenue_musd", F.when(
        F.col("id") % 5 == 0, F.col("revenue_musd") * 1.5 + 1e-7).otherwise(F.col("revenue_musd")))
    gone = clean.where("id % 9 = 0").withColumn("id", -F.col("id")).withColumn("director", F.lit("NOBODY|NATION_1"))
    kpi_state.build_kpis(spark, early.unionByName(gone), f"{base}/kpis")
    touched = clean.where("id % 4 = 0 OR id % 5 = 0").select("id").union(gone.select("id"))
    kpi_state.refresh_kpis(spark, f"{base}/kpis", touched, clean.where("id % 4 = 0 OR id % 5 = 0"))
    out = None
    for name, report in kpi_state.kpi_reports(spark, f"{base}/kpis").items():
        key, *columns = report.columns
        rows = report.select(F.lit(name).alias("report"), F.col(key).cast("string").alias("key"), F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])).alias("x")) \
            .select("report", "key", "x.column", "x.value")
        out = rows if out is None else out.unionByName(rows)
    return out


def _spelt(spark, sf):
    """Companies of the clean catalogue, spelt in six ways by the id."""
    name, k = F.col("production_companies"), F.col("id") % 10
    ways = (F.when(k == 1, F.lower(name)).when(k == 2, F.concat(name, F.lit(" ")))
            .when(k == 3, F.replace(name, F.lit("#"), F.lit(" "))).when(k == 4, F.replace(name, F.lit("#"), F.lit("")))
            .when(k == 5, F.concat(F.substring(name, 7, 9), F.lit(", Brand"))).otherwise(name))
    return _clean(spark, sf).withColumn("production_companies", ways)


def _named_searches(spark, sf):
    """S1 and S2 on a catalogue that holds what they look for: genres, cast
    and directors are put in front of a title's own, by its id."""
    def put(text, column, n, rest):
        return F.when(F.col("id") % n == rest, F.concat_ws("|", F.lit(text), F.col(column))).otherwise(F.col(column))

    clean = _clean(spark, sf).withColumns({
        "genres": put("Action|science fiction", "genres", 4, 0),
        "director": put("Quentin Tarantino", "director", 3, 1)}).withColumn(
        "cast", put("BRUCE WILLIS", "cast", 3, 0)).withColumn("cast", put("Uma Thurman", "cast", 6, 1))
    one = search.search_scifi_action_bruce_willis(clean)
    two = search.search_thurman_tarantino(clean)
    return one.select(F.lit("S1").alias("search"), "title", F.col("vote_average").alias("sorted_by"), "cast").unionByName(
        two.select(F.lit("S2").alias("search"), "title", F.col("runtime").alias("sorted_by"), "cast"))


def _quality_report_planted(spark, sf):
    """Q3-Q9 where every rule is broken by some titles."""
    def when(n, rest, value, column):
        return F.when(F.col("id") % n == rest, value).otherwise(F.col(column))

    day = F.lit("1870-05-01").cast("date")
    typed = _typed(spark, sf).withColumns({
        "budget_musd": when(13, 5, -F.col("budget_musd"), "budget_musd"),
        "revenue_musd": when(17, 3, -F.col("revenue_musd"), "revenue_musd"),
        "runtime": when(19, 4, F.lit(0.0), "runtime"),
        "vote_average": when(23, 0, F.lit(5.0), "vote_average")}).withColumn(
        "vote_average", when(29, 7, F.lit(10.5), "vote_average")).withColumn(
        "release_date", when(31, 9, F.lit("2030-01-01").cast("date"), "release_date")).withColumn(
        "release_date", when(31, 10, day, "release_date"))
    return quality.quality_report(typed, as_of="2025-12-31", expected_rows=18)


def _whole_run(spark, sf):
    """IO10, V6: the whole job into a scratch folder; rows of every table it
    wrote, read back."""
    import uuid

    from marquee.plans import job
    from marquee.plans.session import scratch_path

    paths = job.run(spark, starview.raw_catalogue(spark, sf), scratch_path(spark, f"job-{uuid.uuid4().hex}"))
    out = None
    for name, path in paths.items():
        if name != "metrics":
            rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
            out = rows if out is None else out.unionByName(rows)
    return out


def _roi_sketch_medians(spark, sf):
    """A1, A4 from stored sketches: n and exact median per genre and overall,
    and whether the sketch's rank error keeps three times the bound."""
    import uuid

    from marquee.operators import sketches
    from marquee.plans.session import scratch_path

    base = scratch_path(spark, f"roi-sketches-{uuid.uuid4().hex}")
    _clean(spark, sf).write.parquet(f"{base}/clean")
    clean = spark.read.parquet(f"{base}/clean")
    sketches.roi_sketches(clean).write.parquet(f"{base}/sketches")
    report = sketches.median_report(clean, spark.read.parquet(f"{base}/sketches"))
    return report.select("genre", "n", "exact_median",
                         (F.col("rank_error") <= 3 * sketches.rank_error()).alias("within_bound"))


def _landing_overlaps(spark, sf):
    """A7, Q11 across landings by release year: exact counts beside those of
    stored sketches, as whether these lie within their bound."""
    from marquee.operators import sketches

    raw = starview.raw_catalogue(spark, sf).select(
        "id", F.concat(F.lit("to "), (F.substring("release_date", 1, 4).try_cast("int") - F.coalesce(
            F.col("id").try_cast("bigint"), F.lit(0)) % 3).cast("string")).alias("landing")).where("landing IS NOT NULL")
    later = raw.where(F.col("id").try_cast("bigint") % 2 == 0).withColumn("landing", F.concat("landing", F.lit(" again")))
    records = raw.unionByName(later)
    ids = records.select("landing", F.col("id").try_cast("bigint").alias("k")).where("k IS NOT NULL").distinct()
    pairs = ids.groupBy("k").agg(F.array_sort(F.collect_set("landing")).alias("of"))  # a few landings an id
    two = pairs.select(F.explode(F.flatten(F.transform("of", lambda x: F.transform(
        F.filter("of", lambda y: y > x), lambda y: F.struct(x.alias("first"), y.alias("second")))))).alias("p"))
    shared = two.groupBy("p.first", "p.second").agg(F.count(F.lit(1)).alias("both"))
    sizes = ids.groupBy("landing").agg(F.count(F.lit(1)).alias("size"))
    found = sketches.landing_overlaps(sketches.landing_sketches(records))
    joined = found.join(shared, ["first", "second"], "left").join(
        sizes.select(F.col("landing").alias("first"), F.col("size").alias("a")), "first").join(
        sizes.select(F.col("landing").alias("second"), F.col("size").alias("b")), "second")
    both = F.coalesce("both", F.lit(0))
    union = F.col("a") + F.col("b") - both
    room = F.lit(sketches.distinct_error()) * union
    near = ((F.abs(F.col("union_ids") - union) <= room) & (F.abs(F.col("shared_ids") - both) <= room)
            & (F.abs(F.col("only_ids") - (F.col("a") - both)) <= room))
    return joined.select("first", "second", union.alias("union_ids"), both.alias("shared_ids"),
                         (F.col("a") - both).alias("only_ids"), near.alias("within_bound"))


def _search_indexed(spark, sf):
    """S0 by stored postings: the rows of ``search_genres_cast``."""
    import uuid

    from marquee.operators import postings
    from marquee.plans.session import scratch_path

    base = scratch_path(spark, f"postings-{uuid.uuid4().hex}")
    _clean(spark, sf).write.parquet(f"{base}/clean")
    clean = spark.read.parquet(f"{base}/clean")
    postings.build_postings(clean, f"{base}/postings")
    return postings.search_indexed(clean, f"{base}/postings", genres=["Hot", "widget"], cast="nation_1").select(
        "title", "vote_average", "genres", "cast")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "clean_catalogue": _clean,
        "rank_revenue": _on_clean(ranking.highest_revenue),
        "rank_budget": _on_clean(ranking.highest_budget),
        "rank_profit_high": _on_clean(ranking.highest_profit),
        "rank_profit_low": _on_clean(ranking.lowest_profit),
        "rank_roi_high": _on_clean(ranking.highest_roi),
        "rank_roi_low": _on_clean(ranking.lowest_roi),
        "rank_votes": _on_clean(ranking.most_voted),
        "rank_rating_high": _on_clean(ranking.highest_rated),
        "rank_rating_low": _on_clean(ranking.lowest_rated),
        "rank_popularity": _on_clean(ranking.most_popular),
        "rank_all": _on_clean(ranking.rank_all),
        "sql_rank_roi": _sql_rank_roi,
        "rank_within_collection": lambda s, sf: ranking.top_per_group(
            _clean(s, sf), "belongs_to_collection", "revenue_musd")
        .select("belongs_to_collection", "title", "revenue_musd", "rank"),
        "search_genres_cast": _search_genres_cast,
        "search_cast_director": _search_cast_director,
        "search_tokens": _search_tokens,
        "search_indexed": _search_indexed,
        "search_scifi_action_bruce_willis": _on_clean(search.search_scifi_action_bruce_willis),
        "search_thurman_tarantino": _on_clean(search.search_thurman_tarantino),
        "group_membership": _on_clean(groups.franchise_vs_standalone),
        "group_collection": _on_clean(groups.franchise_summary),
        "group_director": _on_clean(groups.director_summary),
        "group_genre_roi": _on_clean(groups.roi_by_genre),
        "group_year": _on_clean(groups.yearly_box_office),
        "director_by_year": lambda s, sf: groups.director_summary(_clean(s, sf), by_year=True),
        "collection_by_year": lambda s, sf: groups.franchise_summary(_clean(s, sf), min_movies=1,
                                                                     by_year=True),
        "value_counts_genres": lambda s, sf: groups.value_counts(_clean(s, sf), "genres", multi=True),
        "value_counts_director": lambda s, sf: groups.value_counts(_clean(s, sf), "director", multi=True),
        "value_counts_language": lambda s, sf: groups.value_counts(_clean(s, sf), "original_language"),
        "impute_budget": _impute_budget,
        "impute_lattice": lambda s, sf: lattice.impute_from_lattice(_clean(s, sf), "budget_musd")
        .select("id", "budget_musd", "budget_musd_level"),
        "director_over_time": lambda s, sf: trends.over_time(_clean(s, sf), "director", multi=True),
        "collection_over_time": lambda s, sf: trends.over_time(_clean(s, sf), "belongs_to_collection"),
        "roi_sketch_medians": _roi_sketch_medians,
        "landing_overlaps": _landing_overlaps,
        "company_variants": lambda s, sf: variants.value_variants(_spelt(s, sf), "production_companies"),
        "named_searches_planted": _named_searches,
        "quality_report_planted": _quality_report_planted,
        "whole_run": _whole_run,
        "feed_revenue_budget": _on_clean(feeds.revenue_vs_budget),
        "feed_breakeven": _on_clean(feeds.breakeven_end),
        "feed_rating_popularity": _on_clean(feeds.popularity_vs_rating),
        "feed_revenue_budget_sampled": lambda s, sf: feeds.sampled(_clean(s, sf), "budget_musd", "revenue_musd", 20),
        "feed_rating_popularity_sampled": lambda s, sf: feeds.sampled(_clean(s, sf), "vote_average", "popularity", 20),
        "feed_sample_merged": _feed_sample_merged,
        "feed_membership_bars": _on_clean(feeds.membership_bars),
        "feed_revenue_budget_binned": lambda s, sf: feeds.binned(
            feeds.revenue_vs_budget(_clean(s, sf)), "budget_musd", "revenue_musd", 10.0),
        "dedupe_survivors": _dedupe_survivors,
        "stage_counts": _stage_counts,
        "parse_health": _parse_health,
        "quality_report": lambda s, sf: quality.quality_report(_typed(s, sf), as_of="2025-12-31",
                                                               expected_rows=18),
        "parsed_flattened": _parsed_flattened,
        "typed_values": _typed_values,
        "clean_csv_roundtrip": _clean_csv_roundtrip,
        "clean_refresh": _clean_refresh,
        "raw_csv_clean": _raw_csv_clean,
        "cache_growing_keys": _cache_growing_keys,
        "raw_encode": _raw_encode,
        "required_keys_rejects": _required_keys_rejects,
        "ingest_accepted": _ingest_accepted,
        "cache_gap_fill": _cache_gap_fill,
        "cache_gap_report": _cache_gap_report,
        "cache_full_hit": _cache_full_hit,
        "stream_ingest": _stream_ingest,
        "stream_keyed_ingest": _stream_keyed_ingest,
        "schema_drift": _schema_drift,
        "clean_from_variant": _clean_from_variant,
        "kpi_refresh": _kpi_refresh,
    }
    if _LLM is not None:
        q |= _LLM.queries()
    if _PIPELINE is not None:
        q["pipeline"] = _PIPELINE.run
    return q


def oracle_sql() -> dict[str, str]:
    from oracle_sql import statements

    sql = statements()
    if _LLM_ORACLE is not None:
        sql |= _LLM_ORACLE.statements()
    if _PIPELINE is not None and _PIPELINE.ORACLE_SQL:
        sql["pipeline"] = _PIPELINE.ORACLE_SQL
    return sql
