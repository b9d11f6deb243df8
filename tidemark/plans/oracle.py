"""Oracle SQL: for every catalogue key a statement that DuckDB runs on the same
Parquet tables.

The model chain computes the models another way than the Spark side: ranks and
medians come from ordered lists, the previous snapshot from an as-of join, means from
sums and counts, breakouts from a filter over each group's list.  What has to be the
same is marked: output names, single-precision velocities, the fixed limits and the
tie-breaks.
"""

from __future__ import annotations

from tidemark.operators.explorer import DEFAULT_LIMIT
from tidemark.plans.catalog import (
    ADHOC_SQL,
    LANGUAGE,
    LANGUAGES,
    SNAPSHOT,
    TRENDING_AS_OF,
    TRENDING_DAYS_BACK,
    TRENDING_PER_PAGE,
)

RAW_PARTS = """
raw_repos AS (
    SELECT
        CASE WHEN q.l_partkey % 101 = 0 THEN NULL ELSE q.l_partkey END AS id,
        p.p_name AS name,
        CASE WHEN p.p_size % 5 = 0 THEN '   '
             WHEN p.p_size % 2 = 0 THEN '  ' || p.p_type || ' '
             ELSE p.p_type END AS description,
        p.p_brand AS language,
        CASE WHEN q.l_partkey % 97 = 0 THEN -CAST(q.qty AS INTEGER) ELSE CAST(q.qty AS INTEGER) END AS stars,
        CAST(q.n_lines AS INTEGER) AS forks,
        CAST(q.n_returned AS INTEGER) AS open_issues,
        CAST(q.n_suppliers AS INTEGER) AS watchers,
        CASE WHEN p.p_type = 'SMALL' THEN 'NOASSERTION' ELSE p.p_type END AS license,
        '[' || array_to_string([CAST(to_json(x) AS VARCHAR) FOR x IN q.flags], ', ') || ']' AS topics,
        f.first_ship AS created_at,
        q.last_ship AS updated_at,
        q.last_ship AS pushed_at,
        'https://example.com/part/' || CAST(q.l_partkey AS VARCHAR) AS url,
        CAST(q.snapshot_date AS TIMESTAMP) + INTERVAL 6 HOUR AS ingested_at,
        q.snapshot_date
    FROM (
        SELECT l_partkey,
               last_day(CAST(date_trunc('quarter', l_shipdate) AS DATE) + INTERVAL 2 MONTH) AS snapshot_date,
               sum(l_quantity) AS qty,
               count(*) AS n_lines,
               count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
               count(DISTINCT l_suppkey) AS n_suppliers,
               list_sort(list_distinct(list(l_returnflag))) AS flags,
               max(l_shipdate) AS last_ship
        FROM lineitem
        GROUP BY 1, 2
    ) q
    JOIN (SELECT l_partkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY 1) f
      ON f.l_partkey = q.l_partkey
    JOIN part p ON p.p_partkey = q.l_partkey
)"""

RAW_USERS = """
raw_repos AS (
    SELECT
        d.user_id AS id,
        'org/u' || CAST(d.user_id AS VARCHAR) AS name,
        CAST(NULL AS VARCHAR) AS description,
        upper(d.event_type) AS language,
        CAST(d.value_floor AS INTEGER) AS stars,
        CAST(d.n_events AS INTEGER) AS forks,
        0 AS open_issues,
        0 AS watchers,
        CAST(NULL AS VARCHAR) AS license,
        '[]' AS topics,
        u.first_seen AS created_at,
        d.last_ts AS updated_at,
        d.last_ts AS pushed_at,
        'https://example.com/user/' || CAST(d.user_id AS VARCHAR) AS url,
        CAST(d.snapshot_date AS TIMESTAMP) + INTERVAL 6 HOUR AS ingested_at,
        d.snapshot_date
    FROM (
        SELECT user_id, event_type, CAST(ts AS DATE) AS snapshot_date,
               sum(floor(value)) AS value_floor, count(*) AS n_events, max(ts) AS last_ts
        FROM events
        GROUP BY 1, 2, 3
    ) d
    JOIN (SELECT user_id, min(ts) AS first_seen FROM events GROUP BY 1) u
      ON u.user_id = d.user_id
)"""

# Fixed values: 'NOASSERTION', top 20, factor 3, 50 stars, 2 and 1 digits; FLOAT is the
# velocity's type.
MODELS = r"""
cleaned AS (
    SELECT *, regexp_replace(description, '^\p{Zs}+|\p{Zs}+$', '', 'g') AS said FROM raw_repos WHERE id IS NOT NULL AND stars >= 0
),
stg_repos AS (
    SELECT id AS repo_id, name AS repo_name, CASE WHEN length(said) > 0 THEN said END AS description,
           lower(language) AS language, stars, forks, open_issues, watchers,
           CASE WHEN license <> 'NOASSERTION' THEN license END AS license,
           CAST(created_at AS DATE) AS repo_created_date, CAST(updated_at AS DATE) AS last_updated_date,
           CAST(pushed_at AS DATE) AS last_pushed_date, url, snapshot_date, stars + forks AS engagement_score,
           CAST(epoch(CAST(snapshot_date AS TIMESTAMP)) AS BIGINT) // 86400
             - CAST(epoch(date_trunc('day', created_at)) AS BIGINT) // 86400 AS repo_age_days
    FROM cleaned
),
best_first AS (
    SELECT snapshot_date, language, list(s ORDER BY s.stars DESC, s.repo_id) AS members
    FROM stg_repos s GROUP BY snapshot_date, language
),
numbered AS (
    SELECT unnest(members) AS m, unnest(range(1, len(members) + 1)) AS place FROM best_first
),
ranked_repos AS (
    SELECT m.snapshot_date AS snapshot_date, m.language AS language, place AS rank_in_language, m.repo_id AS repo_id,
           m.repo_name AS repo_name, m.description AS description, m.stars AS stars, m.forks AS forks,
           m.open_issues AS open_issues, m.engagement_score AS engagement_score, m.repo_age_days AS repo_age_days,
           m.license AS license, m.url AS url
    FROM numbered
),
mart_top_repos AS (SELECT * FROM ranked_repos WHERE rank_in_language BETWEEN 1 AND 20),
totals AS (
    SELECT snapshot_date, language, count(*) AS n, sum(stars) AS s, max(stars) AS top, sum(forks) AS f, count(forks) AS nf,
           sum(open_issues) AS i, sum(engagement_score) AS e, count(engagement_score) AS ne, sum(repo_age_days) AS a,
           count(repo_age_days) AS na
    FROM stg_repos GROUP BY ALL
),
int_language_daily AS (
    SELECT snapshot_date, language, n AS repo_count, CAST(s AS BIGINT) AS total_stars, CAST(s AS DOUBLE) / n AS avg_stars,
           top AS max_stars, CAST(f AS BIGINT) AS total_forks, CAST(f AS DOUBLE) / nullif(nf, 0) AS avg_forks,
           CAST(i AS BIGINT) AS total_open_issues, CAST(e AS DOUBLE) / nullif(ne, 0) AS avg_engagement,
           CAST(a AS DOUBLE) / nullif(na, 0) AS avg_repo_age_days
    FROM totals
),
language_growth AS (
    SELECT now.*, past.total_stars AS prev_total_stars, past.repo_count AS prev_repo_count,
           now.total_stars - past.total_stars AS stars_delta, now.repo_count - past.repo_count AS repo_count_delta,
           CASE WHEN past.total_stars <> 0
                THEN round(100.0 * (now.total_stars - past.total_stars) / past.total_stars, 2) END AS stars_growth_pct
    FROM int_language_daily now ASOF LEFT JOIN int_language_daily past
      ON coalesce(now.language, chr(1)) = coalesce(past.language, chr(1)) AND now.snapshot_date > past.snapshot_date
),
mart_language_trends AS (
    SELECT snapshot_date, language, repo_count, total_stars, avg_stars, max_stars, total_forks,
           avg_engagement, avg_repo_age_days, stars_delta, repo_count_delta, stars_growth_pct
    FROM language_growth
),
paced AS (
    SELECT snapshot_date, language, repo_id, repo_name, stars, forks, repo_age_days, url,
           round(CAST(stars AS FLOAT) / CASE WHEN repo_age_days > 0 THEN repo_age_days ELSE 1 END, 2) AS stars_per_day
    FROM mart_top_repos
),
paces AS (
    SELECT snapshot_date, language, list(p) AS members, list(stars_per_day ORDER BY stars_per_day) AS sorted
    FROM paced p GROUP BY snapshot_date, language
),
middles AS (
    SELECT snapshot_date, language, members, sorted[(len(sorted) + 1) // 2] AS low, sorted[len(sorted) // 2 + 1] AS high FROM paces
),
medians AS (
    SELECT snapshot_date, language, members, CAST((CAST(low AS DOUBLE) + CAST(high AS DOUBLE)) / 2 AS FLOAT) AS median_velocity FROM middles
),
breakout_repos AS (
    SELECT snapshot_date, language, r.repo_name AS repo_name, r.stars AS stars, r.forks AS forks,
           r.repo_age_days AS repo_age_days, r.stars_per_day AS stars_per_day, median_velocity,
           CASE WHEN median_velocity <> 0 THEN round(r.stars_per_day / median_velocity, 1) END AS velocity_multiplier,
           r.url AS url
    FROM (
        SELECT snapshot_date, language, median_velocity, unnest(members) AS r
        FROM medians WHERE snapshot_date IS NOT NULL AND language IS NOT NULL
    )
    WHERE r.stars >= 50 AND r.stars_per_day > 3 * median_velocity
)"""

VELOCITY = "SELECT repo_id, repo_name, language, stars, forks, repo_age_days, snapshot_date, url, stars_per_day FROM paced"
TRENDS_ORDER = "snapshot_date DESC, total_stars DESC, language"
TOP_ORDER = "snapshot_date DESC, language, rank_in_language"
BREAKOUT_ORDER = "velocity_multiplier DESC NULLS LAST, stars DESC, url, snapshot_date, language"


def _with(raw_cte: str, body: str) -> str:
    return f"WITH {raw_cte.strip()},\n{MODELS.strip()}\n{body.strip()}"


def _a(body: str) -> str:
    return _with(RAW_PARTS, body)


def _b(body: str) -> str:
    return _with(RAW_USERS, body)


def _langs() -> str:
    return ", ".join(f"'{x}'" for x in LANGUAGES)


_SLICE = f"""
SELECT * FROM mart_language_trends
WHERE language IN ({_langs()}) AND snapshot_date = DATE '{SNAPSHOT}'
"""

_TOP15 = f"""
SELECT * FROM mart_top_repos
WHERE language = '{LANGUAGE}' AND snapshot_date = DATE '{SNAPSHOT}'
ORDER BY rank_in_language
LIMIT 15
"""

ORACLE: dict[str, str] = {
    "raw_repos": _a("SELECT * FROM raw_repos"),
    "topics_json": _a("SELECT url, snapshot_date, topics FROM raw_repos"),
    "raw_row_count": _a("SELECT count(*) AS row_count FROM raw_repos"),
    "scan_trends": _a("SELECT * FROM mart_language_trends ORDER BY snapshot_date, language"),
    "scan_top": _a("SELECT * FROM mart_top_repos ORDER BY snapshot_date DESC, language, rank_in_language"),
    "union_snapshots": _a(
        "SELECT * FROM raw_repos WHERE snapshot_date < DATE '1998-07-01' "
        "UNION ALL SELECT * FROM raw_repos WHERE snapshot_date >= DATE '1998-07-01'"
    ),
    "dedup_snapshots": _a(
        """
        SELECT id, name, description, language, CASE WHEN id % 10 = 0 THEN stars + 1 ELSE stars END AS stars, forks,
               open_issues, watchers, license, topics, created_at, updated_at, pushed_at, url,
               CASE WHEN id % 10 = 0 THEN ingested_at + INTERVAL 1 HOUR ELSE ingested_at END AS ingested_at, snapshot_date
        FROM raw_repos
        """
    ),
    "stg_repos": _a("SELECT * FROM stg_repos"),
    "stg_filter": _a("SELECT id, stars, snapshot_date, url FROM raw_repos WHERE id IS NOT NULL AND stars >= 0"),
    "clean_description": _a(
        "SELECT url, snapshot_date, description AS raw_description, "
        "nullif(trim(description), '') AS description FROM raw_repos"
    ),
    "clean_license": _a(
        "SELECT url, snapshot_date, license AS raw_license, "
        "nullif(license, 'NOASSERTION') AS license FROM raw_repos"
    ),
    "engagement_score": _a(
        "SELECT url, snapshot_date, stars, forks, stars + forks AS engagement_score FROM raw_repos"
    ),
    "repo_age_days": _a(
        "SELECT url, snapshot_date, created_at, "
        "datediff('day', created_at, snapshot_date) AS repo_age_days FROM raw_repos"
    ),
    "repo_velocity": _a(VELOCITY),
    "velocity_users": _b(VELOCITY),
    "rank_in_language": _a(
        "SELECT snapshot_date, language, repo_id, stars, rank_in_language FROM ranked_repos"
    ),
    "top_repos": _a(f"SELECT * FROM mart_top_repos ORDER BY {TOP_ORDER}"),
    "language_daily": _a("SELECT * FROM int_language_daily"),
    "language_growth": _a(
        "SELECT snapshot_date, language, total_stars, prev_total_stars, repo_count, prev_repo_count, "
        "stars_delta, repo_count_delta, stars_growth_pct FROM language_growth"
    ),
    "language_trends": _a(f"SELECT * FROM mart_language_trends ORDER BY {TRENDS_ORDER}"),
    "trending_search": f"""
        SELECT id, language, stars, created_at, rank FROM (
            SELECT o_orderkey AS id,
                   o_orderpriority AS language,
                   CAST(floor(o_totalprice) AS INTEGER) AS stars,
                   o_orderdate AS created_at,
                   row_number() OVER (PARTITION BY o_orderpriority
                                      ORDER BY floor(o_totalprice) DESC, o_orderkey) AS rank
            FROM orders
            WHERE CAST(o_orderdate AS DATE) > DATE '{TRENDING_AS_OF}' - {TRENDING_DAYS_BACK}
        ) t
        WHERE rank <= {TRENDING_PER_PAGE}
    """,
    "language_median": _a("SELECT snapshot_date, language, median_velocity FROM medians"),
    "language_median_all": _a(
        "SELECT snapshot_date, language, CAST(quantile_cont(CAST(pace AS DOUBLE), 0.5) AS FLOAT) AS median_velocity FROM ("
        "SELECT snapshot_date, language, round(CAST(stars AS FLOAT) / CASE WHEN repo_age_days > 0 THEN repo_age_days ELSE 1 END, 2) AS pace "
        "FROM stg_repos) GROUP BY snapshot_date, language"
    ),
    "breakouts": _a(f"SELECT * FROM breakout_repos ORDER BY {BREAKOUT_ORDER}"),
    "breakouts_users": _b(f"SELECT * FROM breakout_repos ORDER BY {BREAKOUT_ORDER}"),
    "breakout_count": _a("SELECT count(*) AS breakout_count FROM breakout_repos"),
    "breakouts_view": _a(
        "SELECT language, repo_name, stars, stars_per_day, velocity_multiplier, forks, repo_age_days, url "
        f"FROM breakout_repos ORDER BY {BREAKOUT_ORDER}"
    ),
    "breakouts_top10": _a(
        "SELECT repo_name, language, stars, stars_per_day, velocity_multiplier, url "
        f"FROM breakout_repos ORDER BY {BREAKOUT_ORDER} LIMIT 10"
    ),
    "breakouts_chart": _a(
        "SELECT repo_name, language, velocity_multiplier FROM ("
        f"SELECT * FROM breakout_repos ORDER BY {BREAKOUT_ORDER} LIMIT 15"
        ") h ORDER BY velocity_multiplier NULLS LAST, url, snapshot_date"
    ),
    "breakout_details": _a(
        "SELECT repo_name AS repository, language, stars, stars_per_day, velocity_multiplier AS multiplier, "
        f"forks, url FROM breakout_repos ORDER BY {BREAKOUT_ORDER}"
    ),
    "short_names": _b(
        "SELECT substring(string_split(repo_name, '/')[-1], 1, 34) AS short_name, language, stars, "
        f"stars_per_day, velocity_multiplier, url FROM breakout_repos ORDER BY {BREAKOUT_ORDER} LIMIT 10"
    ),
    "trends_filtered": _a(_SLICE),
    "trends_over_time": _a(
        f"SELECT snapshot_date, language, total_stars FROM mart_language_trends WHERE language IN ({_langs()})"
    ),
    "top_for_language": _a(_TOP15),
    "trend_chart_available": _a(
        "SELECT count(DISTINCT snapshot_date) > 1 AS show_trend_chart FROM mart_language_trends"
    ),
    "top_repos_chart": _a(
        f"SELECT repo_name, CAST(sum(stars) AS BIGINT) AS stars FROM ({_TOP15}) t "
        "GROUP BY repo_name ORDER BY stars, repo_name"
    ),
    "repo_details": _a(
        "SELECT rank_in_language AS rank, repo_name AS repository, stars, forks, open_issues AS issues, "
        f"license, url FROM ({_TOP15}) t"
    ),
    "stars_by_language": _a(f"SELECT language, total_stars FROM ({_SLICE}) s ORDER BY total_stars, language"),
    "engagement_scatter": _a(f"SELECT language, avg_stars, avg_engagement, repo_count FROM ({_SLICE}) s"),
    "kpi_summary": _a(
        f"""
        SELECT COALESCE(CAST(sum(total_stars) AS BIGINT), 0) AS total_stars,
               COALESCE(CAST(sum(repo_count) AS BIGINT), 0) AS total_repos,
               COALESCE((SELECT upper(substr(language, 1, 1)) || lower(substr(language, 2))
                         FROM ({_SLICE}) h ORDER BY total_stars DESC, language LIMIT 1), '—') AS hottest_language,
               COALESCE(round_even(avg(avg_engagement), 1), 0.0) AS avg_engagement
        FROM ({_SLICE}) s
        """
    ),
    "kpi_pipeline_stats": _a(
        """
        SELECT (SELECT count(*) FROM raw_repos) AS total_ingested,
               count(DISTINCT snapshot_date) AS snapshots_available,
               count(DISTINCT language) AS languages_tracked
        FROM mart_language_trends
        """
    ),
    "snapshot_counts": _a("SELECT snapshot_date, count(*) AS repo_count FROM raw_repos GROUP BY 1 ORDER BY 1"),
    "distinct_languages": _a("SELECT DISTINCT language FROM mart_language_trends ORDER BY 1"),
    "distinct_snapshots": _a("SELECT DISTINCT snapshot_date FROM mart_language_trends ORDER BY 1 DESC"),
    "latest_snapshot": _a("SELECT max(snapshot_date) AS latest_snapshot FROM mart_language_trends"),
    "explorer_default": _a(
        f"""
        SELECT language, repo_name, stars, forks, engagement_score, repo_age_days
        FROM mart_top_repos
        WHERE snapshot_date = DATE '{SNAPSHOT}' AND language IN ({_langs()})
        ORDER BY stars DESC, repo_id
        LIMIT {DEFAULT_LIMIT}
        """
    ),
    "explorer_adhoc": _a(f"SELECT * FROM (\n{ADHOC_SQL}\n) AS q"),
    "quality_summary": _a(
        """
        SELECT check_name, failing_rows, failing_rows = 0 AS passed FROM (
            SELECT 'not_null:raw_repos.id' AS check_name, count(*) FILTER (WHERE id IS NULL) AS failing_rows FROM raw_repos
            UNION ALL SELECT 'not_null:raw_repos.language', count(*) FILTER (WHERE language IS NULL) FROM raw_repos
            UNION ALL SELECT 'not_null:raw_repos.stars', count(*) FILTER (WHERE stars IS NULL) FROM raw_repos
            UNION ALL SELECT 'not_null:stg_repos.repo_id', count(*) FILTER (WHERE repo_id IS NULL) FROM stg_repos
            UNION ALL SELECT 'not_null:stg_repos.stars', count(*) FILTER (WHERE stars IS NULL) FROM stg_repos
            UNION ALL SELECT 'not_null:mart_top_repos.repo_id', count(*) FILTER (WHERE repo_id IS NULL) FROM mart_top_repos
            UNION ALL SELECT 'not_null:mart_language_trends.language', count(*) FILTER (WHERE language IS NULL) FROM mart_language_trends
            UNION ALL SELECT 'not_null:mart_language_trends.snapshot_date', count(*) FILTER (WHERE snapshot_date IS NULL) FROM mart_language_trends
            UNION ALL SELECT 'assert_rank_bounds', count(*) FROM mart_top_repos WHERE rank_in_language < 1 OR rank_in_language > 20
            UNION ALL SELECT 'assert_stars_non_negative', count(*) FROM stg_repos WHERE stars < 0
        ) c
        """
    ),
    "quality_rank_failures": _a(
        "SELECT * FROM ranked_repos WHERE rank_in_language < 1 OR rank_in_language > 20"
    ),
    "quality_star_failures": _a("SELECT id AS repo_id, name AS repo_name, stars FROM raw_repos WHERE stars < 0"),
}
