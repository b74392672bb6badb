"""The derived source tables, and every registered query, in plain SQL."""

from __future__ import annotations

import re

from testbed.views import COHORT_KEYWORD, END, START

WINDOW = f"BETWEEN DATE '{START}' AND DATE '{END}'"

TABLES = {
    "raw_kw": """
        SELECT CAST(l_shipdate AS DATE) AS date, dayname(CAST(l_shipdate AS DATE)) AS day_of_week,
            p_name AS keyword, 'enabled' AS keyword_state, l_suppkey AS campaign_id,
            CASE WHEN l_suppkey % 2 = 0 THEN 'Core ' ELSE 'Rmktg ' END || s_name AS campaign_name,
            l_partkey AS ad_group_id, p_brand AS ad_group_name,
            CAST(l_quantity * 25 AS DECIMAL(18, 2)) AS cost, 'Google search' AS network,
            l_tax * 10 AS est_search_impression_share, l_discount AS est_search_impression_share_lost_rank,
            CASE WHEN l_returnflag = 'A' THEN 'mb' ELSE 'dt' END AS device,
            CAST(l_quantity AS BIGINT) * 100 AS impressions, CAST(l_quantity AS BIGINT) % 7 AS clicks,
            1 + l_discount * 20 AS average_position,
            CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber AS DOUBLE) END AS quality_score,
            'Average' AS landing_page_experience,
            CASE l_linenumber % 3 WHEN 0 THEN 'Broad' WHEN 1 THEN 'Exact' ELSE 'Phrase' END AS match_type
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
    "kw": f"SELECT * FROM raw_kw WHERE date {WINDOW}",
    "raw_camp": """
        SELECT CAST(l_shipdate AS DATE) AS date, dayname(CAST(l_shipdate AS DATE)) AS day_of_week,
            'enabled' AS campaign_state, l_suppkey AS campaign_id,
            CASE WHEN l_suppkey % 2 = 0 THEN 'Core ' ELSE 'Rmktg ' END || s_name AS campaign_name,
            CAST(SUM(l_quantity) * 25 AS DECIMAL(18, 2)) AS cost, 'Display network' AS network,
            MAX(l_tax) * 10 AS est_search_impression_share,
            MAX(l_discount) AS est_search_impression_share_lost_rank,
            MAX(l_tax) AS est_search_impression_share_lost_budget,
            CASE WHEN l_returnflag = 'A' THEN 'mb' ELSE 'dt' END AS device,
            CAST(1000 AS DECIMAL(18, 2)) AS budget,
            CAST(SUM(l_quantity) AS BIGINT) * 100 AS impressions,
            CAST(SUM(CAST(l_quantity AS BIGINT) % 7) AS BIGINT) AS clicks,
            1 + MAX(l_discount) * 20 AS average_position
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        GROUP BY CAST(l_shipdate AS DATE), l_suppkey, s_name, l_returnflag""",
    "camp": f"SELECT * FROM raw_camp WHERE date {WINDOW}",
    "raw_bing": """
        SELECT CAST(l_shipdate AS DATE) AS date, l_partkey AS keyword_id, p_name AS keyword,
            'Active' AS keyword_state, l_suppkey AS campaign_id, 'Second ' || s_name AS campaign_name,
            l_partkey AS ad_group_id, p_brand AS ad_group_name,
            CAST(l_quantity * 20 AS DECIMAL(18, 2)) AS cost,
            CASE WHEN l_returnflag = 'A' THEN 'mb' ELSE 'dt' END AS device,
            CAST(l_quantity AS BIGINT) * 40 AS impressions, CAST(l_quantity AS BIGINT) % 5 AS clicks,
            1 + l_discount * 10 AS average_position, CAST(l_linenumber AS DOUBLE) AS quality_score,
            CASE l_linenumber % 3 WHEN 0 THEN 'Broad' WHEN 1 THEN 'Exact' ELSE 'Phrase' END AS match_type,
            dayname(CAST(l_shipdate AS DATE)) AS day_of_week
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
    "bing_kw": f"SELECT * FROM raw_bing WHERE date {WINDOW}",
    "ev": """
        SELECT CASE event_type WHEN 'purchase' THEN 'Completed Order' ELSE event_type END AS event,
            788918400 + 80 * (date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 86400
                + hour(ts) * 3600 + minute(ts) * 60 + CAST(floor(second(ts)) AS BIGINT)) AS time,
            CASE WHEN value >= 0.5 THEN user_id END AS app_user_id, 'o-' || event_id AS order_id,
            CASE WHEN k < 70 THEN 'Google' ELSE 'Bing' END AS source,
            CASE WHEN value < 5 THEN 'email' ELSE 'cpc' END AS medium,
            CASE WHEN value >= 40 AND value < 42 THEN NULL ELSE CAST(floor(value / 10) AS BIGINT) END AS campaign_id,
            CASE WHEN k < 70 THEN p_name END AS keyword, CASE WHEN k >= 70 THEN k END AS keyword_id,
            k AS ad_group_id,
            CASE WHEN value < 20 THEN 'Broad' WHEN value < 60 THEN 'Exact' ELSE 'Phrase' END AS match_type,
            CASE WHEN minute(ts) < 30 THEN 'mb' ELSE 'dt' END AS device
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events) e
        LEFT JOIN part ON k = p_partkey""",
    "conv": f"""
        SELECT * FROM ev WHERE event = 'Completed Order' AND medium = 'cpc'
            AND time >= epoch(TIMESTAMP '{START} 00:00:00')
            AND time < epoch(TIMESTAMP '{END} 00:00:00' + INTERVAL 1 DAY)""",
    "conv_one": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, app_user_id ORDER BY time, order_id) AS n
            FROM conv) WHERE n = 1""",
    "tx": """
        SELECT o_orderkey AS id, o_custkey AS user_id, o_orderdate AS created_at, o_orderstatus <> 'P' AS complete,
            o_orderpriority = '5-LOW' AS refunded,
            CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '3-MEDIUM' THEN NULL ELSE 0 END
                AS DECIMAL(18, 2)) AS credit,
            CAST(o_orderkey % 7 AS DECIMAL(18, 2)) AS discount_amount,
            CAST(o_orderkey % 10 AS DECIMAL(18, 2)) AS sales_tax_amount
        FROM orders""",
    "items": """
        SELECT l_orderkey AS transaction_id, CASE WHEN l_linenumber <= 3 THEN l_partkey END AS discount_id,
            CAST(l_extendedprice AS DECIMAL(18, 2)) AS price, l_linestatus = 'F' AS recurring
        FROM lineitem""",
    "disc": """
        SELECT p_partkey AS id, CASE p_type WHEN 'ECONOMY' THEN 'GiftCard' ELSE 'Promo' END AS type,
            CAST(p_retailprice AS DECIMAL(18, 2)) AS amount
        FROM part""",
    "ref": """
        SELECT o_custkey AS influencer_id, CAST(date_trunc('week', CAST(o_orderdate AS DATE)) AS DATE) AS week_start,
            COUNT(*) AS new_referred_users,
            SUM(CAST(o_totalprice AS DECIMAL(18, 2))) AS referred_users_transaction_amount
        FROM orders GROUP BY 1, 2""",
    "first_tx": f"""
        SELECT MIN(t.created_at) AS first_transaction, c.c_custkey AS id, c.c_name AS name
        FROM customer c JOIN tx t ON t.user_id = c.c_custkey GROUP BY c.c_custkey, c.c_name
        HAVING CAST(MIN(t.created_at) AS DATE) {WINDOW}""",
    # Refunded items pay nothing; else a credit above 0 is taken off. A gift card is worth its discount row's amount.
    "extract": f"""
        SELECT created_at AS transaction_date, c_name AS user_name, user_id AS app_user_id,
            discount_amount, credit, sales_tax_amount, if(refunded, price, 0) AS refund_amount,
            if(cards.id IS NULL, price + discount_amount - sales_tax_amount, amount) AS retail_price,
            if(refunded, 0, price - greatest(coalesce(credit, 0), 0)) AS money_in_the_bank_paid_to_us,
            if(cards.id IS NOT NULL, 'Gift Card', if(recurring, 'Recurring Food Purchase', 'One-Time Meal Purchase')) AS purchase_type
        FROM items JOIN tx ON tx.id = transaction_id JOIN customer ON c_custkey = user_id
            LEFT JOIN (SELECT id, amount FROM disc WHERE type = 'GiftCard') cards ON cards.id = discount_id
        WHERE complete AND created_at >= DATE '{START}' AND created_at <= DATE '{END}' + 1""",
    "camp_names": "SELECT campaign_id, MIN(campaign_name) AS campaign_name FROM camp GROUP BY campaign_id",
    "bing_names": "SELECT campaign_id, MIN(campaign_name) AS campaign_name FROM bing_kw GROUP BY campaign_id",
    "bing_words": "SELECT keyword_id, MIN(keyword) AS keyword FROM bing_kw GROUP BY keyword_id",
    "acq_search": """
        SELECT c.app_user_id, c.keyword, n.campaign_name, c.campaign_id, c.device, c.match_type, c.ad_group_id
        FROM conv_one c LEFT JOIN camp_names n ON c.campaign_id = n.campaign_id
        WHERE c.source = 'Google' AND c.app_user_id IN (SELECT id FROM first_tx)""",
    "acq_bing": """
        SELECT c.app_user_id, w.keyword, n.campaign_name, c.campaign_id, c.device, c.match_type, c.ad_group_id
        FROM conv_one c LEFT JOIN bing_names n ON c.campaign_id = n.campaign_id
            LEFT JOIN bing_words w ON c.keyword_id = w.keyword_id
        WHERE c.source = 'Bing' AND c.app_user_id IN (SELECT id FROM first_tx)""",
}

_SOLD = """
    SELECT CAST(e.transaction_date AS DATE) AS date, a.app_user_id AS user_id, e.*, a.*
    FROM extract e JOIN {acq} a ON e.app_user_id = a.app_user_id
    WHERE CAST(e.transaction_date AS DATE) {window}"""
TABLES["sold_search"] = _SOLD.format(acq="acq_search", window=WINDOW)
TABLES["sold_bing"] = _SOLD.format(acq="acq_bing", window=WINDOW)

LOG_COLUMNS = [
    "date",
    "week",
    "day_of_week",
    "keyword",
    "match_type",
    "campaign_id",
    "campaign_name",
    "ad_group_id",
    "device",
    "impressions",
    "clicks",
    "cost",
    "average_position",
    "est_search_impression_share",
    "user_id",
    "user_name",
    "discount_amount",
    "credit",
    "sales_tax_amount",
    "refund_amount",
    "retail_price",
    "money_in_the_bank_paid_to_us",
    "purchase_type",
    "new_referred_users",
    "referred_users_transaction_amount",
]
BING_LOG_COLUMNS = [name for name in LOG_COLUMNS if name != "est_search_impression_share"]
MONEY_COLUMNS = {
    "cost",
    "budget",
    "discount_amount",
    "credit",
    "sales_tax_amount",
    "refund_amount",
    "retail_price",
    "money_in_the_bank_paid_to_us",
    "referred_users_transaction_amount",
}


def _week(day: str) -> str:
    return f"CAST(date_trunc('week', {day} + 1) AS DATE)"


def _log(sold: str, spend: str, spend_columns: set[str]) -> str:
    """The three kinds of rows of an event log."""
    referral_columns = {"week", "user_id", "new_referred_users", "referred_users_transaction_amount"}
    who = {"keyword", "match_type", "campaign_id", "campaign_name", "device"}
    sold_columns = set(LOG_COLUMNS) - referral_columns - {
        "impressions", "clicks", "cost", "average_position", "est_search_impression_share"
    } | {"user_id"}

    def cell(name: str, present: set[str], prefix: str) -> str:
        if name == "week" and "week" not in present:
            return f"{_week(prefix + 'date')} AS week"
        if name == "day_of_week" and prefix == "s.":
            return "dayname(s.date) AS day_of_week"
        return f"{prefix}{name} AS {name}" if name in present else f"NULL AS {name}"

    def cells(present: set[str], prefix: str) -> str:
        return ", ".join(cell(name, present, prefix) for name in LOG_COLUMNS)

    referral = ", ".join(
        f"{'a' if name in who else 'r'}.{name} AS {name}"
        if name in who | referral_columns
        else f"NULL AS {name}"
        for name in LOG_COLUMNS
    )
    return f"""
        SELECT {cells(sold_columns, "s.")} FROM {sold} s
        UNION ALL SELECT {cells(spend_columns, "k.")} FROM {spend} k
        UNION ALL SELECT {referral}
        FROM (SELECT *, week_start AS week, influencer_id AS user_id FROM ref) r
        JOIN (SELECT DISTINCT user_id, {", ".join(sorted(who))} FROM {sold}) a ON r.user_id = a.user_id
        WHERE r.week {WINDOW}"""


_SPEND = {"date", "day_of_week", "campaign_id", "campaign_name", "device", "impressions", "clicks", "cost"} | {
    "average_position"
}
TABLES["log_search"] = _log(
    "sold_search", "kw", _SPEND | {"keyword", "match_type", "ad_group_id", "est_search_impression_share"}
)
TABLES["log_bing"] = _log("sold_bing", "bing_kw", _SPEND | {"keyword", "match_type", "ad_group_id"})
TABLES["log_display_all"] = _log("sold_search", "camp", _SPEND | {"est_search_impression_share"})
TABLES["log_display"] = "SELECT * FROM log_display_all WHERE regexp_matches(campaign_name, 'Rmktg')"


def with_tables(body: str) -> str:
    """``body`` with the derived tables it needs in front."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(TABLES[name])

    visit(body)
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in TABLES.items() if name in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


def shown(names: list[str], source: str) -> str:
    """Select columns in comparable types: dates as text, money as double."""
    cells = []
    for name in names:
        if name in ("date", "week", "week_start"):
            cells.append(f"CAST({name} AS VARCHAR) AS {name}")
        elif name in MONEY_COLUMNS:
            cells.append(f"CAST({name} AS DOUBLE) AS {name}")
        elif name == "new_referred_users":
            cells.append(f"CAST({name} AS BIGINT) AS {name}")
        else:
            cells.append(name)
    return f"SELECT {', '.join(cells)} FROM {source}"


def kpi(source: str, keys: list[str], share: bool = True) -> str:
    """KPI summary of a log; the outer names are the inner ones."""
    by = f"GROUP BY {', '.join(keys)}" if keys else ""
    lead = "".join(f"{key}, " for key in keys)
    available = (
        """COALESCE(CAST(SUM(CAST(impressions / NULLIF(est_search_impression_share, 0) AS DECIMAL(18, 6))) AS DOUBLE), 0)
            AS estimated_available_impressions,"""
        if share
        else ""
    )
    shares = (
        """estimated_available_impressions,
            impressions / NULLIF(estimated_available_impressions, 0) AS est_search_impression_share,"""
        if share
        else ""
    )
    return f"""
        SELECT *, (estimated_ltv - cost) / NULLIF(cost, 0) AS "estimated_lifetime_ROAS",
            earnings + referred_earnings AS total_earnings,
            (earnings + referred_earnings) * 0.25 AS total_contribution,
            ((earnings + referred_earnings) * 0.25 - cost) / NULLIF(cost, 0) AS "actual_ROAS"
        FROM (SELECT {lead}cost, average_position, impressions, {shares} clicks,
            clicks / NULLIF(impressions, 0) AS click_through_rate, num_acquisitions,
            num_acquisitions / NULLIF(clicks, 0) AS conversion_rate, cost / NULLIF(clicks, 0) AS cost_per_click,
            earnings, earnings * 0.25 AS contribution, earnings / NULLIF(clicks, 0) AS earnings_per_click,
            earnings * 0.25 / NULLIF(clicks, 0) AS contribution_per_click,
            CASE WHEN num_acquisitions = 0 THEN cost ELSE cost / num_acquisitions END AS cpa,
            referred_users, referred_earnings,
            CAST(num_acquisitions * 10 * 70 AS DOUBLE) * 0.25 AS estimated_ltv
        FROM (SELECT {lead}
            CAST(COALESCE(SUM(cost), 0) AS DOUBLE) AS cost,
            CAST(SUM(CAST(average_position AS DECIMAL(9, 4)) * impressions) AS DOUBLE)
                / NULLIF(SUM(CASE WHEN average_position IS NOT NULL THEN impressions END), 0) AS average_position,
            {available}
            CAST(COALESCE(SUM(impressions), 0) AS BIGINT) AS impressions,
            CAST(COALESCE(SUM(clicks), 0) AS BIGINT) AS clicks,
            COUNT(DISTINCT user_id) AS num_acquisitions,
            CAST(COALESCE(SUM(money_in_the_bank_paid_to_us), 0) AS DOUBLE) AS earnings,
            CAST(COALESCE(SUM(new_referred_users), 0) AS BIGINT) AS referred_users,
            CAST(COALESCE(SUM(referred_users_transaction_amount), 0) AS DOUBLE) AS referred_earnings
        FROM {source} {by}))"""


def dated(sql: str, column: str = "week") -> str:
    """A query with one of its date columns as text."""
    return f"SELECT * REPLACE (CAST({column} AS VARCHAR) AS {column}) FROM ({sql})"


def series(
    source: str, keys: list[str], order: str = "week", roi: str = "cum_ROI", where: str = "TRUE"
) -> str:
    """Running sums in long form, from a log."""
    lead = "".join(f"{key}, " for key in keys)
    partition = f"PARTITION BY {', '.join(keys)}" if keys else ""
    over = f"OVER ({partition} ORDER BY {order} NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    values = [
        ("cum_cost", "CAST(cum_cost AS DOUBLE)"),
        ("cum_contribution", "CAST(cum_earned AS DOUBLE) * 0.25"),
        (roi, "CAST(cum_earned AS DOUBLE) * 0.25 - CAST(cum_cost AS DOUBLE)"),
    ]
    running = f"""
        SELECT *, SUM(cost_sum) {over} AS cum_cost, SUM(earned_sum) {over} AS cum_earned
        FROM (SELECT {lead}{order}, COALESCE(SUM(cost), 0) AS cost_sum,
                COALESCE(SUM(money_in_the_bank_paid_to_us), 0) AS earned_sum
            FROM {source} WHERE {where} GROUP BY {lead}{order})"""
    return " UNION ALL ".join(
        f"""SELECT {lead}{order}, CAST(cost_sum AS DOUBLE) AS cost,
            CAST(earned_sum AS DOUBLE) * 0.25 AS contribution, '{name}' AS type, {value} AS value
        FROM ({running})"""
        for name, value in values
    )


def earning(source: str) -> str:
    """Condition: the row's keyword earned something (a NULL keyword is one too)."""
    return f"""EXISTS (SELECT 1 FROM (SELECT keyword AS w, SUM(money_in_the_bank_paid_to_us) AS m
        FROM {source} GROUP BY keyword) x WHERE x.m > 0 AND x.w IS NOT DISTINCT FROM keyword)"""


# Cohorts of the test keyword on each log.
for _suffix, _source in (("", "log_search"), ("_bing", "log_bing")):
    TABLES[f"cohort_rows{_suffix}"] = f"SELECT * FROM {_source} WHERE keyword = '{COHORT_KEYWORD}'"
    TABLES[f"cohort_ordinals{_suffix}"] = f"""
        SELECT week, row_number() OVER (ORDER BY week NULLS LAST) AS week_number
        FROM (SELECT DISTINCT week FROM cohort_rows{_suffix})"""
    TABLES[f"cohort_users{_suffix}"] = f"""
        SELECT user_id, MIN(week) AS week FROM cohort_rows{_suffix} WHERE user_id IS NOT NULL GROUP BY user_id"""
    TABLES[f"cohorts{_suffix}"] = f"""
        SELECT r.*, o.week_number,
            CASE WHEN r.user_id IS NULL THEN o.week_number ELSE s.week_number END AS cohort_week
        FROM cohort_rows{_suffix} r JOIN cohort_ordinals{_suffix} o ON r.week = o.week
            LEFT JOIN cohort_users{_suffix} u ON r.user_id = u.user_id
            LEFT JOIN cohort_ordinals{_suffix} s ON u.week = s.week"""
