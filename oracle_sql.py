"""DuckDB oracle SQL for every registered query.

Each statement recomputes its answer straight from the driver's tables:
the shared ``CATALOGUE`` CTE derives the clean catalogue from the
planted-defect rules of ``marquee.sources.starview`` without going through
JSON, so it is an independent second implementation of the Spark chain.
"""

from __future__ import annotations

_FACTS = """
li AS (
  SELECT l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
         CAST(l_shipdate AS DATE) AS ship
  FROM lineitem),
pairs AS (
  SELECT l_partkey, l_suppkey,
         SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS price,
         COUNT(*) FILTER (WHERE l_returnflag = 'R') AS returns,
         SUM(l_quantity) AS qty, COUNT(*) AS lines, MIN(ship) AS first_ship,
         MAX(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) AS is_director,
         MAX(CASE WHEN l_linenumber = 2 THEN 1 ELSE 0 END) AS is_writer,
         MAX(CASE WHEN l_linenumber > 2 THEN 1 ELSE 0 END) AS is_crew
  FROM li GROUP BY l_partkey, l_suppkey),
named AS (
  SELECT p.*, n.n_name, r.r_name
  FROM pairs p
  LEFT JOIN supplier s ON p.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
facts AS (
  SELECT l_partkey,
         CAST(SUM(price) * 100 AS BIGINT) AS revenue,
         CAST(SUM(returns) AS BIGINT) AS returns,
         SUM(qty) AS qty, CAST(SUM(lines) AS BIGINT) AS lines, MIN(first_ship) AS first_ship,
         string_agg(DISTINCT n_name, '|' ORDER BY n_name) AS cast_text,
         CAST(COUNT(DISTINCT n_name) AS INTEGER) AS cast_size,
         string_agg(DISTINCT CASE WHEN is_director = 1 THEN n_name END, '|'
                    ORDER BY CASE WHEN is_director = 1 THEN n_name END) AS director,
         CAST(COUNT(DISTINCT CASE WHEN is_director = 1 THEN n_name END)
              + COUNT(DISTINCT CASE WHEN is_writer = 1 THEN n_name END)
              + COUNT(DISTINCT CASE WHEN is_crew = 1 THEN n_name END) AS INTEGER) AS crew_size,
         string_agg(DISTINCT n_name, '|' ORDER BY n_name) AS nations,
         string_agg(DISTINCT r_name, '|' ORDER BY r_name) AS regions
  FROM named GROUP BY l_partkey),
base AS (
  SELECT p.p_partkey AS k, p.p_name, p.p_brand, p.p_type, p.p_size, f.*
  FROM part p LEFT JOIN facts f ON f.l_partkey = p.p_partkey),
copies AS (
  SELECT b.*, c.copy FROM base b,
  LATERAL (SELECT unnest(CASE WHEN b.k % 29 = 0 THEN [0, 1] ELSE [0] END) AS copy) c)"""

_TYPED_COLS = """
    k, copy,
    CASE WHEN k % 97 = 13 THEN NULL ELSE k END AS id,
    CASE WHEN k % 53 = 7 THEN NULL ELSE p_name || ' #' || CAST(k AS VARCHAR) END AS title,
    CASE WHEN k % 11 = 3 THEN 'In Production' ELSE 'Released' END AS status,
    CASE WHEN k % 37 = 4 OR k % 31 IN (3, 4) THEN NULL ELSE p_type || ' ' || p_brand END AS tagline,
    CASE WHEN k % 37 = 4 OR k % 89 = 1 THEN NULL ELSE first_ship + CAST(k % 2500 AS INTEGER) END AS release_date,
    CASE WHEN k % 37 = 4 OR k % 13 = 0 THEN NULL ELSE replace(p_name, ' ', '|') END AS genres,
    CASE WHEN k % 37 = 4 OR p_size % 5 = 0 THEN NULL ELSE p_brand || '/' || CAST(p_size AS VARCHAR) END AS belongs_to_collection,
    CASE WHEN k % 37 = 4 THEN NULL ELSE lower(substr(p_type, 1, 2)) END AS original_language,
    CASE WHEN k % 37 = 4 OR k % 101 = 5 OR k % 17 = 0 THEN NULL ELSE CAST(p_size * 1000000 AS DOUBLE) / 1000000 END AS budget_musd,
    CASE WHEN k % 37 = 4 OR revenue = 0 THEN NULL ELSE CAST(revenue AS DOUBLE) / 1000000 END AS revenue_musd,
    CASE WHEN k % 37 = 4 THEN NULL ELSE p_brand END AS production_companies,
    CASE WHEN k % 37 = 4 THEN NULL ELSE nations END AS production_countries,
    CASE WHEN k % 37 = 4 THEN NULL WHEN k % 23 = 0 THEN CAST(0 AS BIGINT) ELSE returns END AS vote_count,
    CASE WHEN k % 37 = 4 OR k % 23 = 0 OR returns = 0 THEN NULL ELSE floor(qty * 2 / lines) / 10 END AS vote_average,
    CASE WHEN k % 37 = 4 THEN NULL ELSE qty + copy END AS popularity,
    CASE WHEN k % 37 = 4 OR k % 19 = 0 THEN NULL ELSE CAST(p_size * 3 AS DOUBLE) END AS runtime,
    CASE WHEN k % 37 = 4 OR k % 31 IN (1, 2) THEN NULL ELSE 'A ' || lower(p_type) || ' ' || p_name || ' title.' END AS overview,
    CASE WHEN k % 37 = 4 THEN NULL ELSE regions END AS spoken_languages,
    CASE WHEN k % 37 = 4 THEN NULL ELSE '/p' || CAST(k AS VARCHAR) || '.jpg' END AS poster_path,
    CASE WHEN k % 37 = 4 THEN NULL ELSE cast_text END AS "cast",
    CASE WHEN k % 37 = 4 THEN NULL ELSE cast_size END AS cast_size,
    CASE WHEN k % 37 = 4 THEN NULL ELSE director END AS director,
    CASE WHEN k % 37 = 4 THEN NULL ELSE crew_size END AS crew_size"""

CLEAN_SELECT = """id, title, tagline, release_date, genres, belongs_to_collection, original_language,
    budget_musd, revenue_musd, production_companies, production_countries, vote_count,
    vote_average, popularity, runtime, overview, spoken_languages, poster_path, "cast",
    cast_size, director, crew_size"""

# typed: every raw row after typing (duplicates, keyless and sparse rows
# included); clean: one released, populated, keyed row per id (the
# duplicate kept is the second copy, popularity + 1); m: clean + metrics.
CATALOGUE = f"""WITH {_FACTS},
typed AS (SELECT {_TYPED_COLS} FROM copies),
clean AS (
  SELECT {CLEAN_SELECT} FROM typed
  WHERE id IS NOT NULL AND title IS NOT NULL AND k % 37 <> 4 AND status = 'Released'
    AND copy = (CASE WHEN k % 29 = 0 THEN 1 ELSE 0 END)),
m AS (SELECT *, revenue_musd - budget_musd AS profit_musd, revenue_musd / budget_musd AS roi FROM clean)
"""


def _mean(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(24,6))) AS DOUBLE) / COUNT({c})"


def _sum(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(24,6))) AS DOUBLE)"


def _median(c: str) -> str:
    return f"median({c})"


def _rank(by: str, asc: bool, extra: list[str], where: str = "") -> str:
    cols = ", ".join(["title", by] + extra)
    cond = f"{by} IS NOT NULL" + (f" AND {where}" if where else "")
    return (CATALOGUE + f"SELECT {cols} FROM m WHERE {cond} "
            f"ORDER BY {by} {'ASC' if asc else 'DESC'}, id ASC LIMIT 5")


def _search(where: str, by: str, asc: bool, cols: str) -> str:
    order = f"{by} {'ASC' if asc else 'DESC'} NULLS LAST, id ASC"
    return CATALOGUE + f"SELECT {cols} FROM clean WHERE {where} ORDER BY {order}"


def _has(col: str, term: str) -> str:
    return f"contains(lower({col}), '{term.lower()}')"


MEMBERSHIP = ("CASE WHEN belongs_to_collection IS NOT NULL THEN 'Franchise' "
              "ELSE 'Standalone' END")


def statements() -> dict[str, str]:
    q: dict[str, str] = {}
    q["clean_catalogue"] = CATALOGUE + "SELECT * FROM clean"
    q["rank_revenue"] = _rank("revenue_musd", False, [])
    q["rank_budget"] = _rank("budget_musd", False, [])
    q["rank_profit_high"] = _rank("profit_musd", False, ["revenue_musd", "budget_musd"])
    q["rank_profit_low"] = _rank("profit_musd", True, ["revenue_musd", "budget_musd"])
    q["rank_roi_high"] = _rank("roi", False, ["revenue_musd", "budget_musd"], "budget_musd >= 10")
    q["rank_roi_low"] = _rank("roi", True, ["revenue_musd", "budget_musd"], "budget_musd >= 10")
    q["rank_votes"] = _rank("vote_count", False, [])
    q["rank_rating_high"] = _rank("vote_average", False, ["vote_count"], "vote_count >= 10")
    q["rank_rating_low"] = _rank("vote_average", True, ["vote_count"], "vote_count >= 10")
    q["rank_popularity"] = _rank("popularity", False, [])
    q["sql_rank_roi"] = q["rank_roi_high"]
    shown = "title, revenue_musd, budget_musd, vote_count, popularity, profit_musd, roi, vote_average"
    reports = {"highest_revenue": ("revenue_musd DESC", ""), "highest_budget": ("budget_musd DESC", ""),
               "highest_profit": ("profit_musd DESC", ""), "lowest_profit": ("profit_musd", ""),
               "highest_roi": ("roi DESC", "budget_musd >= 10"), "lowest_roi": ("roi", "budget_musd >= 10"),
               "most_voted": ("vote_count DESC", ""), "most_popular": ("popularity DESC", ""),
               "highest_rated": ("vote_average DESC", "vote_count >= 10"),
               "lowest_rated": ("vote_average", "vote_count >= 10")}
    q["rank_all"] = CATALOGUE + " UNION ALL ".join(
        f"(SELECT '{name}' AS ranking, CAST(row_number() OVER (ORDER BY {by}, id) AS INTEGER) AS rank, id, {shown} "
        f"FROM m WHERE {by.split()[0]} IS NOT NULL {'AND ' + cond if cond else ''} ORDER BY {by}, id LIMIT 5)"
        for name, (by, cond) in reports.items())
    q["rank_within_collection"] = CATALOGUE + """
SELECT belongs_to_collection, title, revenue_musd, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY belongs_to_collection
                                    ORDER BY revenue_musd DESC, id ASC) AS INTEGER) AS rank
  FROM m WHERE revenue_musd IS NOT NULL) WHERE rank <= 5"""
    q["search_genres_cast"] = _search(
        f"{_has('genres', 'Hot')} AND {_has('genres', 'widget')} AND {_has('\"cast\"', 'nation_1')}",
        "vote_average", False, 'title, vote_average, genres, "cast"')
    q["search_indexed"] = q["search_genres_cast"]
    q["search_cast_director"] = _search(
        f"{_has('\"cast\"', 'NATION_12')} AND {_has('director', 'nation_3')}",
        "runtime", True, 'title, runtime, director, "cast"')
    q["search_tokens"] = _search(
        "list_contains(list_transform(string_split(genres, '|'), lambda x: lower(x)), 'red') "
        "AND list_contains(list_transform(string_split(\"cast\", '|'), lambda x: lower(x)), 'nation_1')",
        "popularity", False, 'title, popularity, genres, "cast"')
    q["search_scifi_action_bruce_willis"] = _search(
        f"{_has('genres', 'Science Fiction')} AND {_has('genres', 'Action')} AND {_has('\"cast\"', 'Bruce Willis')}",
        "vote_average", False, 'title, vote_average, genres, "cast"')
    q["search_thurman_tarantino"] = _search(
        f"{_has('\"cast\"', 'Uma Thurman')} AND {_has('director', 'Quentin Tarantino')}",
        "runtime", True, 'title, runtime, director, "cast"')
    q["group_membership"] = CATALOGUE + f"""
SELECT {MEMBERSHIP} AS is_franchise, {_mean('revenue_musd')} AS mean_revenue,
       {_median('roi')} AS median_roi, {_mean('budget_musd')} AS mean_budget,
       {_mean('popularity')} AS mean_popularity, {_mean('vote_average')} AS mean_rating
FROM m GROUP BY 1"""
    q["group_collection"] = CATALOGUE + f"""
SELECT belongs_to_collection, COUNT(title) AS num_movies,
       {_sum('budget_musd')} AS total_budget, {_mean('budget_musd')} AS mean_budget,
       {_sum('revenue_musd')} AS total_revenue, {_mean('revenue_musd')} AS mean_revenue,
       {_mean('vote_average')} AS mean_rating
FROM m WHERE belongs_to_collection IS NOT NULL GROUP BY 1 HAVING COUNT(title) >= 2"""
    q["group_director"] = CATALOGUE + f"""
SELECT d AS director, COUNT(title) AS num_movies, {_sum('revenue_musd')} AS total_revenue,
       {_mean('vote_average')} AS mean_rating
FROM (SELECT *, unnest(list_filter(string_split(director, '|'), lambda x: x <> '')) AS d
      FROM m WHERE director IS NOT NULL) GROUP BY 1"""
    q["group_genre_roi"] = CATALOGUE + f"""
SELECT g AS genres, {_median('roi')} AS median_roi
FROM (SELECT roi, unnest(list_filter(string_split(genres, '|'), lambda x: x <> '')) AS g
      FROM m WHERE genres IS NOT NULL AND roi IS NOT NULL) GROUP BY 1"""
    q["group_year"] = CATALOGUE + f"""
SELECT CAST(year(release_date) AS INTEGER) AS year, {_sum('revenue_musd')} AS total_revenue
FROM clean WHERE release_date IS NOT NULL AND revenue_musd IS NOT NULL GROUP BY 1"""
    q["director_by_year"] = CATALOGUE + f"""
SELECT d AS director, CAST(year(release_date) AS INTEGER) AS year, COUNT(title) AS num_movies,
       {_sum('revenue_musd')} AS total_revenue, {_mean('vote_average')} AS mean_rating
FROM (SELECT *, unnest(list_filter(string_split(director, '|'), lambda x: x <> '')) AS d
      FROM m WHERE director IS NOT NULL) GROUP BY 1, 2"""
    q["collection_by_year"] = CATALOGUE + f"""
SELECT belongs_to_collection, CAST(year(release_date) AS INTEGER) AS year, COUNT(title) AS num_movies,
       {_sum('budget_musd')} AS total_budget, {_mean('budget_musd')} AS mean_budget,
       {_sum('revenue_musd')} AS total_revenue, {_mean('revenue_musd')} AS mean_revenue,
       {_mean('vote_average')} AS mean_rating
FROM m WHERE belongs_to_collection IS NOT NULL GROUP BY 1, 2 HAVING COUNT(title) >= 1"""
    q["value_counts_genres"] = CATALOGUE + """
SELECT g AS genres, COUNT(*) AS n FROM (
  SELECT unnest(CASE WHEN genres IS NULL THEN [NULL]
                     ELSE list_filter(string_split(genres, '|'), lambda x: x <> '') END) AS g
  FROM clean) GROUP BY 1"""
    q["value_counts_director"] = CATALOGUE + """
SELECT d AS director, COUNT(*) AS n FROM (
  SELECT unnest(CASE WHEN director IS NULL THEN [NULL]
                     ELSE list_filter(string_split(director, '|'), lambda x: x <> '') END) AS d
  FROM clean) GROUP BY 1"""
    q["value_counts_language"] = CATALOGUE + """
SELECT original_language, COUNT(*) AS n FROM clean GROUP BY 1"""
    q["impute_budget"] = CATALOGUE + f"""
SELECT c.id, COALESCE(c.budget_musd, g.fill) AS budget_musd,
       (c.budget_musd IS NULL AND g.fill IS NOT NULL) AS budget_musd_imputed
FROM clean c LEFT JOIN (
  SELECT belongs_to_collection, {_median('budget_musd')} AS fill
  FROM clean WHERE belongs_to_collection IS NOT NULL GROUP BY 1) g
ON c.belongs_to_collection = g.belongs_to_collection"""
    q["feed_revenue_budget"] = CATALOGUE + """
SELECT budget_musd, revenue_musd FROM clean
WHERE budget_musd IS NOT NULL AND revenue_musd IS NOT NULL"""
    for name, x, y in (("feed_revenue_budget_sampled", "budget_musd", "revenue_musd"),
                       ("feed_rating_popularity_sampled", "vote_average", "popularity")):
        q[name] = CATALOGUE + f"""
SELECT year, id, {x}, {y}, stratum_rows FROM (
  SELECT *, count(*) OVER (PARTITION BY year) AS stratum_rows,
         row_number() OVER (PARTITION BY year ORDER BY md5(CAST(id AS VARCHAR)), id) AS k
  FROM (SELECT *, CAST(year(release_date) AS INTEGER) AS year FROM clean WHERE {x} IS NOT NULL AND {y} IS NOT NULL))
WHERE k <= 20"""
    q["feed_sample_merged"] = q["feed_revenue_budget_sampled"]
    q["feed_breakeven"] = CATALOGUE + """
SELECT greatest(MAX(budget_musd), MAX(revenue_musd)) AS breakeven_end FROM clean
WHERE budget_musd IS NOT NULL AND revenue_musd IS NOT NULL"""
    q["feed_rating_popularity"] = CATALOGUE + """
SELECT vote_average, popularity FROM clean
WHERE vote_average IS NOT NULL AND popularity IS NOT NULL"""
    q["feed_membership_bars"] = CATALOGUE + f"""
SELECT {MEMBERSHIP} AS is_franchise, {_mean('revenue_musd')} AS mean_revenue,
       {_mean('budget_musd')} AS mean_budget FROM clean GROUP BY 1"""
    q["feed_revenue_budget_binned"] = CATALOGUE + """
SELECT floor(budget_musd / 10.0) * 10.0 AS budget_musd, floor(revenue_musd / 10.0) * 10.0 AS revenue_musd,
       COUNT(*) AS n FROM clean
WHERE budget_musd IS NOT NULL AND revenue_musd IS NOT NULL GROUP BY 1, 2"""
    q["dedupe_survivors"] = CATALOGUE + """
SELECT id, popularity, status FROM typed
WHERE id IS NOT NULL AND title IS NOT NULL AND copy = (CASE WHEN k % 29 = 0 THEN 1 ELSE 0 END)"""
    q["parsed_flattened"] = CATALOGUE + """
SELECT CAST(id AS VARCHAR) AS id_text, genres, belongs_to_collection, production_companies,
       production_countries, spoken_languages, "cast", cast_size, director, crew_size
FROM typed"""
    q["typed_values"] = CATALOGUE + """
SELECT id, title, status, budget_musd, revenue_musd, vote_count, vote_average, popularity,
       runtime, release_date, overview, tagline
FROM typed"""
    q["clean_csv_roundtrip"] = CATALOGUE + "SELECT * FROM clean"
    q["clean_refresh"] = CATALOGUE + "SELECT * FROM clean"
    q["stage_counts"] = CATALOGUE + """
SELECT * FROM (VALUES
  ('raw', (SELECT COUNT(*) FROM typed)),
  ('keyed', (SELECT COUNT(*) FROM typed WHERE id IS NOT NULL AND title IS NOT NULL)),
  ('deduplicated', (SELECT COUNT(DISTINCT id) FROM typed WHERE id IS NOT NULL AND title IS NOT NULL)),
  ('populated', (SELECT COUNT(DISTINCT id) FROM typed
                 WHERE id IS NOT NULL AND title IS NOT NULL AND k % 37 <> 4)),
  ('released', (SELECT COUNT(*) FROM clean))
) AS t(stage, "rows")"""
    q["parse_health"] = CATALOGUE + """
SELECT COUNT(*) AS "rows",
       COUNT(*) FILTER (WHERE genres IS NOT NULL) AS genres_parsed,
       COUNT(*) FILTER (WHERE k % 37 <> 4 AND cast_size IS NOT NULL) AS credits_parsed
FROM typed"""
    q["quality_report"] = CATALOGUE + """
SELECT * FROM (VALUES
  ('rating_scale', 'value', (SELECT COUNT(*) FROM typed WHERE vote_average < 0 OR vote_average > 10)),
  ('rating_needs_votes', 'value', (SELECT COUNT(*) FROM typed WHERE vote_count = 0 AND vote_average IS NOT NULL)),
  ('release_too_early', 'value', (SELECT COUNT(*) FROM typed WHERE release_date < DATE '1888-01-01')),
  ('release_in_future', 'value', (SELECT COUNT(*) FROM typed WHERE release_date > DATE '2025-12-31')),
  ('running_time', 'value', (SELECT COUNT(*) FROM typed WHERE runtime <= 0)),
  ('budget_sign', 'value', (SELECT COUNT(*) FROM typed WHERE budget_musd < 0)),
  ('revenue_sign', 'value', (SELECT COUNT(*) FROM typed WHERE revenue_musd < 0)),
  ('duplicate id', 'schema', (SELECT COUNT(id) - COUNT(DISTINCT id) FROM typed)),
  ('null id', 'schema', (SELECT COUNT(*) FROM typed WHERE id IS NULL)),
  ('row count near expected', 'value', (SELECT greatest(abs(COUNT(*) - 18) - 2, 0) FROM typed))
) AS t("check", tier, bad_rows)"""
    q["raw_csv_clean"] = CATALOGUE + "SELECT * FROM clean"
    q["cache_growing_keys"] = f"WITH {_FACTS}" + """
SELECT CASE WHEN k % 97 = 13 THEN NULL ELSE CAST(k AS VARCHAR) END AS id,
       CASE WHEN k % 53 = 7 THEN NULL ELSE p_name || ' #' || CAST(k AS VARCHAR) END AS title,
       CASE WHEN k % 97 <> 13 AND k % 2 = 0 THEN
            CASE WHEN k % 11 = 3 THEN 'In Production' ELSE 'Released' END END AS status,
       CASE WHEN (k % 97 = 13 OR k % 2 <> 0) AND k % 37 <> 4 THEN '/p' || CAST(k AS VARCHAR) || '.jpg' END AS poster_path
FROM copies"""
    q["raw_encode"] = f"WITH {_FACTS}" + """
SELECT CASE WHEN k % 97 = 13 THEN NULL ELSE CAST(k AS VARCHAR) END AS id,
       CASE WHEN k % 53 = 7 THEN NULL ELSE p_name || ' #' || CAST(k AS VARCHAR) END AS title,
       CASE WHEN k % 11 = 3 THEN 'In Production' ELSE 'Released' END AS status,
       CASE WHEN k % 37 = 4 THEN NULL WHEN k % 101 = 5 THEN 'abc' WHEN k % 17 = 0 THEN '0'
            ELSE CAST(CAST(p_size AS BIGINT) * 1000000 AS VARCHAR) END AS budget,
       CASE WHEN k % 37 = 4 THEN NULL ELSE CAST(revenue AS VARCHAR) END AS revenue,
       CASE WHEN k % 37 = 4 THEN NULL WHEN k % 89 = 1 THEN 'xx'
            ELSE strftime(first_ship + CAST(k % 2500 AS INTEGER), '%Y-%m-%d') END AS release_date,
       CASE WHEN k % 37 = 4 THEN NULL
            ELSE CAST(qty + copy AS VARCHAR) END AS popularity,
       CASE WHEN k % 37 = 4 THEN NULL WHEN k % 13 = 0 THEN '[]'
            ELSE CAST(to_json(list_transform(string_split(p_name, ' '), lambda w, i: {'id': i, 'name': w})) AS VARCHAR) END AS genres,
       CASE WHEN k % 37 = 4 OR p_size % 5 = 0 THEN NULL
            ELSE CAST(to_json({'id': p_size, 'name': p_brand || '/' || CAST(p_size AS VARCHAR)}) AS VARCHAR) END AS belongs_to_collection
FROM copies"""
    q["required_keys_rejects"] = f"WITH {_FACTS}" + """
SELECT CASE WHEN k % 97 = 13 THEN NULL ELSE CAST(k AS VARCHAR) END AS id,
       array_to_string(list_filter([
         CASE WHEN k % 97 = 13 THEN 'id' END,
         CASE WHEN k % 53 = 7 THEN 'title' END,
         CASE WHEN k % 37 = 4 THEN 'budget' END,
         CASE WHEN k % 37 = 4 THEN 'revenue' END,
         CASE WHEN k % 37 = 4 THEN 'genres' END,
         CASE WHEN k % 37 = 4 THEN 'credits' END,
         CASE WHEN k % 37 = 4 THEN 'release_date' END], lambda x: x IS NOT NULL), '|') AS missing
FROM copies WHERE k % 97 = 13 OR k % 53 = 7 OR k % 37 = 4"""
    q["ingest_accepted"] = f"WITH {_FACTS}" + """
SELECT CAST(k AS VARCHAR) AS id, p_name || ' #' || CAST(k AS VARCHAR) AS title,
       CASE WHEN k % 11 = 3 THEN 'In Production' ELSE 'Released' END AS status
FROM copies WHERE NOT (k % 97 = 13 OR k % 53 = 7 OR k % 37 = 4)"""
    q["stream_ingest"] = f"WITH {_FACTS}" + """,
accepted AS (
  SELECT k, CAST(k AS VARCHAR) AS id, p_name || ' #' || CAST(k AS VARCHAR) AS title,
         CASE WHEN k % 11 = 3 THEN 'In Production' ELSE 'Released' END AS status
  FROM copies WHERE NOT (k % 97 = 13 OR k % 53 = 7 OR k % 37 = 4))
SELECT id, title, status FROM accepted"""
    q["clean_from_variant"] = CATALOGUE + "SELECT * FROM clean"
    q["schema_drift"] = f"WITH {_FACTS}" + """,
recs AS (
  SELECT k, k % 37 = 4 AS sparse, k % 41 = 0 AS cut, k % 31 IN (3, 4) AS odd_tagline, k % 101 = 5 AS bad_budget,
         CASE WHEN k % 37 <> 4 AND k % 89 <> 1 AND first_ship + CAST(k % 2500 AS INTEGER) < DATE '2000-01-01'
              THEN 'early' ELSE 'late' END AS landing
  FROM copies WHERE k % 97 <> 13),
found AS (
  SELECT landing, '$' AS path, 'MALFORMED' AS type, 'type changed' AS status FROM recs WHERE cut
  UNION ALL SELECT landing, '$.budget', 'BIGINT', 'type changed' FROM recs
            WHERE NOT cut AND k % 5 = 0 AND NOT sparse AND NOT bad_budget
  UNION ALL SELECT landing, '$.tagline', 'ARRAY', 'type changed' FROM recs WHERE NOT cut AND k % 6 = 1 AND NOT sparse
  UNION ALL SELECT landing, p.path, p.type, 'unknown key' FROM recs, (VALUES
    ('$.studio', 'OBJECT'), ('$.studio.founded', 'BIGINT'), ('$.studio.names', 'ARRAY'),
    ('$.studio.names[*]', 'STRING'), ('$.studio.names[*]', 'VOID')) AS p(path, type)
    WHERE NOT cut AND k % 7 = 0)
SELECT landing, path, type, COUNT(*) AS "rows", status FROM found GROUP BY ALL"""
    q["stream_keyed_ingest"] = f"WITH {_FACTS}" + """,
recs AS (
  SELECT k, k % 53 = 7 AS untitled, k % 37 = 4 AS sparse, k % 89 = 1 AS undated,
         first_ship + CAST(k % 2500 AS INTEGER) AS e FROM copies WHERE k % 97 <> 13),
drops AS (
  SELECT 1 AS d, * FROM recs WHERE k % 3 = 0
  UNION ALL SELECT 2, * FROM recs WHERE k % 3 = 1 OR k % 6 = 0
  UNION ALL SELECT 3, * FROM recs WHERE k % 3 = 2 OR k % 12 = 0),
good AS (SELECT * FROM drops WHERE NOT (untitled OR sparse OR undated)),
marks AS (SELECT s.d, max(g.e) - INTERVAL 1000 DAY AS low FROM (VALUES (1), (2), (3)) AS s(d)
          LEFT JOIN good g ON g.d < s.d GROUP BY s.d),
judged AS (SELECT k, coalesce(e <= low, false) AS late FROM good JOIN marks USING (d))
SELECT DISTINCT CAST(k AS VARCHAR) AS id, 'loaded' AS outcome FROM judged WHERE NOT late
UNION ALL SELECT CAST(k AS VARCHAR), 'late' FROM judged WHERE late
UNION ALL SELECT CAST(k AS VARCHAR), 'lacks ' || array_to_string(list_filter([
         CASE WHEN untitled THEN 'title' END,
         CASE WHEN sparse THEN 'budget' END, CASE WHEN sparse THEN 'revenue' END, CASE WHEN sparse THEN 'genres' END,
         CASE WHEN sparse THEN 'credits' END,
         CASE WHEN sparse OR undated THEN 'release_date' END], lambda x: x IS NOT NULL), '|')
FROM drops WHERE untitled OR sparse OR undated"""
    reports = {"membership": ("group_membership", "is_franchise", "mean_revenue median_roi mean_budget mean_popularity mean_rating"),
               "collection": ("group_collection", "belongs_to_collection",
                              "num_movies total_budget mean_budget total_revenue mean_revenue mean_rating"),
               "director": ("group_director", "director", "num_movies total_revenue mean_rating"),
               "genre": ("group_genre_roi", "genres", "median_roi"), "year": ("group_year", "year", "total_revenue")}
    q["kpi_refresh"] = " UNION ALL ".join(
        f"SELECT '{name}' AS report, CAST({key} AS VARCHAR) AS key, '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value "
        f"FROM ({q[of]})" for name, (of, key, columns) in reports.items() for c in columns.split())
    for name, key, source in (
            ("director_over_time", "director", "(SELECT * EXCLUDE director, unnest(list_filter(string_split(director, '|'), "
             "lambda x: x <> '')) AS director FROM clean)"),
            ("collection_over_time", "belongs_to_collection", "clean")):
        q[name] = CATALOGUE + f""",
dated AS (SELECT {key} AS key, CAST(year(release_date) AS INTEGER) AS year, title, revenue_musd FROM {source}
          WHERE release_date IS NOT NULL AND {key} IS NOT NULL),
yearly AS (SELECT key, year, COUNT(title) AS n, COALESCE({_sum('revenue_musd')}, 0.0) AS revenue FROM dated GROUP BY 1, 2),
spine AS (SELECT key, CAST(unnest(range(min(year), max(year) + 1)) AS INTEGER) AS year FROM dated GROUP BY key)
SELECT s.key AS {key}, s.year, COALESCE(n, 0) AS num_movies, COALESCE(revenue, 0.0) AS total_revenue,
       CAST(SUM(COALESCE(n, 0)) OVER w AS BIGINT) AS running_movies,
       CAST(SUM(CAST(COALESCE(revenue, 0.0) AS DECIMAL(24,6))) OVER w AS DOUBLE) AS running_revenue,
       CAST(CAST(COALESCE(revenue, 0.0) AS DECIMAL(24,6)) - lag(CAST(COALESCE(revenue, 0.0) AS DECIMAL(24,6))) OVER w
            AS DOUBLE) AS revenue_change
FROM spine s LEFT JOIN yearly y ON y.key = s.key AND y.year = s.year
WINDOW w AS (PARTITION BY s.key ORDER BY s.year)"""
    split = "list_distinct(list_filter(string_split({0}, '|'), lambda x: x <> ''))"
    q["impute_lattice"] = CATALOGUE + f""",
own AS (
  SELECT id, budget_musd AS v, 0 AS level, belongs_to_collection AS key FROM clean WHERE belongs_to_collection IS NOT NULL
  UNION ALL SELECT id, v, 1, d || ' / ' || g FROM (SELECT id, v, d, unnest(gs) AS g FROM (
      SELECT id, budget_musd AS v, unnest({split.format('director')}) AS d, {split.format('genres')} AS gs FROM clean))
  UNION ALL SELECT id, budget_musd, 2, unnest({split.format('genres')}) FROM clean
  UNION ALL SELECT id, budget_musd, 3, CAST(year(release_date) AS VARCHAR) FROM clean WHERE release_date IS NOT NULL),
grouped AS (SELECT level, key, COUNT(v) AS n, median(v) AS fill FROM own GROUP BY 1, 2 HAVING COUNT(v) >= 3),
best AS (SELECT id, level, fill FROM own JOIN grouped USING (level, key) WHERE v IS NULL
         QUALIFY row_number() OVER (PARTITION BY id ORDER BY level, n DESC, key) = 1)
SELECT c.id, COALESCE(c.budget_musd, b.fill) AS budget_musd,
       ['collection', 'director and genre', 'genre', 'year'][b.level + 1] AS budget_musd_level
FROM clean c LEFT JOIN best b ON b.id = c.id"""
    q["roi_sketch_medians"] = CATALOGUE + """,
g AS (SELECT roi, unnest(list_filter(string_split(genres, '|'), lambda x: x <> '')) AS genre
      FROM m WHERE genres IS NOT NULL AND roi IS NOT NULL)
SELECT genre, COUNT(*) AS n, median(roi) AS exact_median, TRUE AS within_bound FROM g GROUP BY genre
UNION ALL SELECT NULL, COUNT(*), median(roi), TRUE FROM g HAVING COUNT(*) > 0"""
    q["landing_overlaps"] = f"WITH {_FACTS}" + """,
recs AS (SELECT k, 'to ' || CAST(year(first_ship + CAST(k % 2500 AS INTEGER)) - (CASE WHEN k % 97 = 13 THEN 0 ELSE k % 3 END) AS VARCHAR) AS landing,
                k % 97 = 13 AS anon FROM copies WHERE k % 37 <> 4 AND k % 89 <> 1),
held AS (SELECT landing, k, anon FROM recs
         UNION SELECT landing || ' again', k, anon FROM recs WHERE k % 2 = 0 AND NOT anon),
names AS (SELECT DISTINCT landing FROM held),
ids AS (SELECT DISTINCT landing, k FROM held WHERE NOT anon),
sizes AS (SELECT landing, COUNT(*) AS size FROM ids GROUP BY 1),
shared AS (SELECT x.landing AS first, y.landing AS second, COUNT(*) AS n FROM ids x JOIN ids y ON x.k = y.k AND x.landing < y.landing
           GROUP BY 1, 2)
SELECT a.landing AS first, b.landing AS second, a.size + b.size - COALESCE(n, 0) AS union_ids, COALESCE(n, 0) AS shared_ids,
       a.size - COALESCE(n, 0) AS only_ids, TRUE AS within_bound
FROM sizes a JOIN sizes b ON a.landing < b.landing LEFT JOIN shared s ON s.first = a.landing AND s.second = b.landing"""
    q["company_variants"] = CATALOGUE + """,
spelt AS (SELECT CASE id % 10 WHEN 1 THEN lower(p) WHEN 2 THEN p || ' ' WHEN 3 THEN replace(p, '#', ' ')
                 WHEN 4 THEN replace(p, '#', '') WHEN 5 THEN substr(p, 7, 9) || ', Brand' ELSE p END AS value
          FROM (SELECT id, production_companies AS p FROM clean)),
counted AS (SELECT * FROM (
  SELECT value, COUNT(*) AS n, array_to_string(list_sort(list_distinct(list_filter(
    regexp_split_to_array(lower(value), '[^\\pL\\pN]+'), lambda x: x <> ''))), ' ') AS print
  FROM spelt WHERE value IS NOT NULL GROUP BY value) WHERE print <> ''),
groups_ AS (SELECT print, SUM(n) AS total, arg_min(value, (-n, value)) AS head FROM counted GROUP BY print),
bared AS (SELECT *, regexp_replace(lower(head), '[^\\pL\\pN]+', '', 'g') AS bare FROM groups_),
keyed AS (SELECT *, array_to_string(list_sort(list_distinct(list_transform(range(1, greatest(length(bare) - 1, 1) + 1),
                 lambda i: substr(bare, i, 2)))), '') AS key FROM bared),
tops AS (SELECT key, head AS top, bare AS top_bare FROM keyed
         QUALIFY row_number() OVER (PARTITION BY key ORDER BY total DESC, head) = 1),
linked AS (SELECT print, CASE WHEN levenshtein(bare, top_bare) <= 2 THEN top ELSE head END AS canonical
           FROM keyed JOIN tops USING (key)),
met AS (SELECT value, n, canonical, CAST(levenshtein(value, canonical) AS INTEGER) AS distance
        FROM counted JOIN linked USING (print))
SELECT * FROM met WHERE canonical IN (SELECT canonical FROM met GROUP BY 1 HAVING COUNT(*) > 1)"""
    q["named_searches_planted"] = CATALOGUE + """,
planted AS (
  SELECT title, vote_average, runtime,
         CASE WHEN id % 4 = 0 THEN concat_ws('|', 'Action|science fiction', genres) ELSE genres END AS genres,
         CASE WHEN id % 3 = 1 THEN concat_ws('|', 'Quentin Tarantino', director) ELSE director END AS director,
         CASE WHEN id % 3 = 0 THEN concat_ws('|', 'BRUCE WILLIS', "cast")
              WHEN id % 6 = 1 THEN concat_ws('|', 'Uma Thurman', "cast") ELSE "cast" END AS "cast" FROM clean)
SELECT 'S1' AS search, title, vote_average AS sorted_by, "cast" FROM planted
WHERE contains(lower(genres), 'science fiction') AND contains(lower(genres), 'action') AND contains(lower("cast"), 'bruce willis')
UNION ALL SELECT 'S2', title, runtime, "cast" FROM planted
WHERE contains(lower("cast"), 'uma thurman') AND contains(lower(director), 'quentin tarantino')"""
    q["quality_report_planted"] = q["quality_report"].replace("SELECT * FROM (VALUES", """, broken AS (
  SELECT id, vote_count, CASE WHEN id % 13 = 5 THEN -budget_musd ELSE budget_musd END AS budget_musd,
         CASE WHEN id % 17 = 3 THEN -revenue_musd ELSE revenue_musd END AS revenue_musd,
         CASE WHEN id % 19 = 4 THEN 0.0 ELSE runtime END AS runtime,
         CASE WHEN id % 29 = 7 THEN 10.5 WHEN id % 23 = 0 THEN 5.0 ELSE vote_average END AS vote_average,
         CASE WHEN id % 31 = 9 THEN DATE '2030-01-01' WHEN id % 31 = 10 THEN DATE '1870-05-01' ELSE release_date END AS release_date
  FROM typed)
SELECT * FROM (VALUES""").replace("FROM typed W", "FROM broken W")
    tables = {"clean": "clean_catalogue", "rankings": "rank_all", "highest_revenue": "rank_revenue",
              "highest_budget": "rank_budget", "highest_profit": "rank_profit_high", "lowest_profit": "rank_profit_low",
              "highest_roi": "rank_roi_high", "lowest_roi": "rank_roi_low", "most_voted": "rank_votes",
              "most_popular": "rank_popularity", "highest_rated": "rank_rating_high", "lowest_rated": "rank_rating_low",
              "search_scifi_action_bruce_willis": "search_scifi_action_bruce_willis",
              "search_thurman_tarantino": "search_thurman_tarantino", "franchise_vs_standalone": "group_membership",
              "franchise_summary": "group_collection", "director_summary": "group_director",
              "feed_01-revenue-vs-budget": "feed_revenue_budget", "feed_02-roi-by-genre": "group_genre_roi",
              "feed_03-popularity-vs-rating": "feed_rating_popularity", "feed_04-yearly-box-office": "group_year",
              "feed_05-franchise-vs-standalone": "feed_membership_bars", "feed_breakeven": "feed_breakeven"}
    q["whole_run"] = " UNION ALL ".join(
        f"SELECT '{name}' AS name, COUNT(*) AS \"rows\" FROM ({q[of]})" for name, of in tables.items())
    q["cache_full_hit"] = f"WITH {_FACTS}" + """
SELECT CASE WHEN k % 97 = 13 THEN NULL ELSE CAST(k AS VARCHAR) END AS id,
       CASE WHEN k % 53 = 7 THEN NULL ELSE p_name || ' #' || CAST(k AS VARCHAR) END AS title,
       'cache' AS origin
FROM copies"""
    q["cache_gap_report"] = f"WITH {_FACTS}" + """,
recs AS (
  SELECT CASE WHEN k % 97 = 13 THEN NULL ELSE k END AS id,
         CASE WHEN k % 37 = 4 OR k % 89 = 1 THEN NULL
              ELSE first_ship + CAST(k % 2500 AS INTEGER) END AS rd
  FROM copies)
SELECT p_partkey AS id,
       CASE WHEN p_partkey IN (SELECT id FROM recs WHERE rd < DATE '2000-01-01' AND id IS NOT NULL)
            THEN 'cached'
            WHEN p_partkey IN (SELECT id FROM recs WHERE id IS NOT NULL) THEN 'loaded'
            ELSE 'unavailable' END AS status
FROM (SELECT DISTINCT p_partkey FROM part)"""
    q["cache_gap_fill"] = f"WITH {_FACTS}" + """,
recs AS (
  SELECT CASE WHEN k % 97 = 13 THEN NULL ELSE k END AS id,
         CASE WHEN k % 53 = 7 THEN NULL ELSE p_name || ' #' || CAST(k AS VARCHAR) END AS title,
         CASE WHEN k % 37 = 4 OR k % 89 = 1 THEN NULL
              ELSE first_ship + CAST(k % 2500 AS INTEGER) END AS rd
  FROM copies),
cache AS (SELECT * FROM recs WHERE rd < DATE '2000-01-01'),
gap AS (SELECT p_partkey AS id FROM part
        WHERE p_partkey NOT IN (SELECT id FROM cache WHERE id IS NOT NULL))
SELECT CAST(id AS VARCHAR) AS id, title, 'cache' AS origin FROM cache
UNION ALL
SELECT CAST(id AS VARCHAR) AS id, title, 'landing' AS origin FROM recs
WHERE id IN (SELECT id FROM gap)"""
    return q
