"""marquee: title-catalogue analytics on Spark DataFrames.

Typical use::

    import marquee as mq

    clean, run = mq.preprocess(spark, mq.read_raw(spark, "raw/", "json"), "clean/")
    mq.highest_roi(clean).show()
    mq.franchise_vs_standalone(clean).show()
"""

from marquee.operators.clean import clean_catalogue, clean_rows, dedupe_by_id, fix_types, stage_counts
from marquee.operators.feeds import (
    all_feeds,
    breakeven_end,
    merge_samples,
    popularity_vs_rating,
    revenue_vs_budget,
    sampled,
    write_feeds,
)
from marquee.operators.groups import (
    director_summary,
    franchise_summary,
    franchise_vs_standalone,
    group_median,
    impute_from_similar,
    roi_by_genre,
    value_counts,
    yearly_box_office,
)
from marquee.operators.metrics import add_metrics
from marquee.operators.nested import flatten, parse_nested
from marquee.operators.quality import QualityError, check_clean, quality_report
from marquee.operators.ranking import (
    highest_budget,
    highest_profit,
    highest_rated,
    highest_revenue,
    highest_roi,
    lowest_profit,
    lowest_rated,
    lowest_roi,
    most_popular,
    most_voted,
    rank_all,
    rank_titles,
    top_per_group,
    with_rank,
)
from marquee.operators.search import search_scifi_action_bruce_willis, search_thurman_tarantino, search_titles
from marquee.plans.job import ingest_landing, preprocess, run
from marquee.sources.ingest import gap_fill, ingest
from marquee.sources.raw import read_clean, read_raw
from marquee.sources.sinks import encode_raw, write_clean, write_raw

__version__ = "0.1.0"

__all__ = [
    "QualityError", "add_metrics", "all_feeds", "breakeven_end", "check_clean", "clean_catalogue",
    "clean_rows", "dedupe_by_id", "director_summary", "encode_raw", "fix_types", "flatten",
    "franchise_summary", "franchise_vs_standalone", "gap_fill", "group_median", "highest_budget",
    "highest_profit", "highest_rated", "highest_revenue", "highest_roi", "impute_from_similar",
    "ingest", "ingest_landing", "lowest_profit", "lowest_rated", "lowest_roi", "merge_samples", "most_popular",
    "most_voted", "parse_nested", "popularity_vs_rating", "preprocess", "quality_report",
    "rank_all", "rank_titles", "read_clean", "read_raw", "revenue_vs_budget", "roi_by_genre", "run", "sampled",
    "search_scifi_action_bruce_willis", "search_thurman_tarantino", "search_titles",
    "stage_counts", "top_per_group", "value_counts", "with_rank", "write_clean", "write_feeds",
    "write_raw", "yearly_box_office",
]
