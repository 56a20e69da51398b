"""Serving SQL over the cleansed, metric, report and alert tables: checks, BI datasets, metrics and the unified view.

A query is one text of plain SQL with {names} of tables. Spark runs it over the frames of those names, without
registering anything; the SQL to compare with is the same text over the tables' own SQL.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.plans import alerts, gold, reports, silver, streams
from ledgerlake.sources.scratch import new_place
from ledgerlake.sources.tables import load

#: Tables by the names that queries use.
TABLES = {
    "daily": (gold, "gold_daily_volume"), "npl": (gold, "gold_npl"), "arpu": (gold, "gold_arpu"), "loss": (gold, "gold_loss_ratio"), "claim": (gold, "gold_claim_time"), "flow": (gold, "gold_mobile_flow"), "corr": (gold, "gold_corridors"),
    "bank": (silver, "silver_bank"), "ins": (silver, "silver_insurance"), "mob": (silver, "silver_mobile"), "loan": (silver, "silver_loans"), "client": (silver, "silver_clients"), "account": (silver, "silver_accounts"), "fx": (silver, "silver_fx_rates"),
    "banking": (reports, "report_banking"), "insuring": (reports, "report_insurance"),
    "burst": (alerts, "alert_large_burst"), "abroad": (alerts, "alert_unusual_country"), "claims3x": (alerts, "alert_claim_ratio"), "aml": (alerts, "alert_aml"), "liquidity": (alerts, "alert_liquidity"),
    "rt": (streams, "stream_silver_bank"), "rt_bursts": (streams, "stream_large_burst"),
}
BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

SQL = {
    # checks of raw and cleansed tables
    "check_volumes": "SELECT 'orders' AS source, CAST(count(*) AS BIGINT) AS n FROM {orders} UNION ALL SELECT 'lineitem', count(*) FROM {lineitem} UNION ALL SELECT 'events', count(*) FROM {events} UNION ALL SELECT 'customer', count(*) FROM {customer}",
    "check_balances": "SELECT country, currency, segment, CAST(count(*) AS BIGINT) AS n, round(sum(balance), 2) AS balance FROM {account} GROUP BY country, currency, segment ORDER BY country, currency, segment",
    "check_daily_bank": "SELECT day, CAST(count(*) AS BIGINT) AS n, round(sum(amount), 2) AS amount FROM {bank} GROUP BY 1 ORDER BY 1 DESC LIMIT 20",
    "check_counts_by_source": "SELECT source, country, CAST(count(*) AS BIGINT) AS n FROM (SELECT 'bank' AS source, country FROM {bank} UNION ALL SELECT 'insurance', country FROM {ins} UNION ALL SELECT 'mobile', sender_country FROM {mob} UNION ALL SELECT 'loan', country FROM {loan}) u GROUP BY 1, 2 ORDER BY 1, 2",
    "check_duplicate_keys": "SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n FROM {lineitem} GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    "check_orphans": "SELECT 'bank' AS source, CAST(count(*) AS BIGINT) AS n FROM {bank} b LEFT JOIN {account} a ON b.account = a.account WHERE a.account IS NULL UNION ALL SELECT 'sender', count(*) FROM {mob} m LEFT JOIN {client} c ON m.sender = c.client WHERE c.client IS NULL UNION ALL SELECT 'receiver', count(*) FROM {mob} m LEFT JOIN {client} c ON m.receiver = c.client WHERE c.client IS NULL UNION ALL SELECT 'debtors', count(*) FROM {client} c LEFT JOIN {account} a ON c.client = a.account WHERE a.account IS NULL UNION ALL SELECT 'loan', count(*) FROM {loan} WHERE orphan",
    "check_partitions": "SELECT country, month, CAST(count(*) AS BIGINT) AS n FROM {bank} GROUP BY country, month",
    "check_pii_preview": "SELECT c_custkey, concat(substr(c_name, 1, 4), '****') AS shown FROM {customer} ORDER BY c_custkey LIMIT 10",
    "check_default_rate": "SELECT country, CAST(count(*) AS BIGINT) AS n, round(100e0 * count_if(bad) / count(*), 2) AS default_pct FROM {loan} GROUP BY country ORDER BY default_pct DESC, country",
    "check_loss_ratio": "SELECT country, round(sum(amount) FILTER (WHERE claim_paid), 2) AS claims, round(sum(amount) FILTER (WHERE premium), 2) AS premiums, round(100e0 * sum(amount) FILTER (WHERE claim_paid) / nullif(sum(amount) FILTER (WHERE premium), 0), 2) AS loss_pct FROM {ins} GROUP BY country",
    "check_conservation": "SELECT 'orders' AS source, (SELECT CAST(count(DISTINCT o_orderkey) AS BIGINT) FROM {orders}) AS raw, (SELECT CAST(count(*) AS BIGINT) FROM {bank}) AS clean UNION ALL SELECT 'lineitem', (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM {lineitem}) d), (SELECT count(*) FROM {ins}) UNION ALL SELECT 'events', (SELECT count(DISTINCT event_id) FROM {events}), (SELECT count(*) FROM {mob})",
    "check_unique": "SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT id) AS BIGINT) AS n_ids FROM {bank} HAVING count(*) = count(DISTINCT id)",
    "check_eur_by_country": "SELECT country, currency, round(sum(amount_eur), 2) AS eur FROM {bank} GROUP BY country, currency ORDER BY eur DESC LIMIT 10",
    "check_quality": "SELECT country, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(orphan AS INT)) AS BIGINT) AS orphans, CAST(sum(CAST(outlier AS INT)) AS BIGINT) AS outliers FROM {bank} GROUP BY country",
    "check_segments": "SELECT segment, CAST(count(*) AS BIGINT) AS n FROM {client} GROUP BY segment ORDER BY n DESC, segment",
    "check_corridors": "SELECT corridor, CAST(count(*) AS BIGINT) AS n, round(sum(amount), 2) AS amount FROM {mob} WHERE cross_border GROUP BY corridor ORDER BY amount DESC, corridor LIMIT 10",
    # checks of metrics
    "check_metric_volumes": "SELECT 'daily' AS metric, CAST(count(*) AS BIGINT) AS n FROM {daily} UNION ALL SELECT 'npl', count(*) FROM {npl} UNION ALL SELECT 'arpu', count(*) FROM {arpu} UNION ALL SELECT 'loss', count(*) FROM {loss} UNION ALL SELECT 'claim', count(*) FROM {claim} UNION ALL SELECT 'flow', count(*) FROM {flow} UNION ALL SELECT 'corridors', count(*) FROM {corr}",
    "check_reconciled": "SELECT CAST(sum(n_ops) AS BIGINT) AS in_metric, (SELECT CAST(count(*) AS BIGINT) FROM {orders}) AS in_source FROM {daily} WHERE flow = 'BANK'",
    "check_npl_latest": "SELECT country, entity, n_loans, npl_ratio FROM {npl} WHERE month = (SELECT max(month) FROM {npl}) ORDER BY npl_ratio DESC, country, entity",
    "check_loss_cumulated": "SELECT country, branch, round(sum(claims), 2) AS claims, round(100e0 * sum(claims) / nullif(sum(premiums), 0), 2) AS loss_pct FROM {loss} GROUP BY 1, 2 ORDER BY 4 DESC, 1, 2",
    "check_arpu_by_segment": "SELECT segment, floor(CAST(sum(CAST(round(revenue * 100) AS BIGINT)) AS DOUBLE) / nullif(sum(clients), 0) + 0.5) / 100 AS arpu FROM {arpu} GROUP BY segment ORDER BY arpu DESC, segment",
    "check_claim_days": "SELECT branch, CAST(sum(n_closed) AS BIGINT) AS n, round(sum(mean_days * n_closed) / sum(n_closed), 2) AS mean_days FROM {claim} GROUP BY branch",
    "check_mobile_failures": "SELECT operator, CAST(sum(n_ops) AS BIGINT) AS n, round(100e0 * sum(n_failed) / nullif(sum(n_ops), 0), 2) AS failed_pct FROM {flow} GROUP BY operator",
    "check_top_corridors": "SELECT corridor, round(sum(total), 2) AS amount, CAST(sum(n_ops) AS BIGINT) AS n FROM {corr} GROUP BY corridor ORDER BY amount DESC, corridor LIMIT 10",
    # checks of reports and alerts
    "check_reports": "SELECT 'banking' AS report, CAST(count(*) AS BIGINT) AS n, min(report_date) AS report_date FROM {banking} UNION ALL SELECT 'insurance', count(*), min(report_date) FROM {insuring}",
    "check_banking_by_regulator": "SELECT regulator, CAST(count(*) AS BIGINT) AS n, CAST(count_if(breach) AS BIGINT) AS breaches, round(100e0 * sum(bad_outstanding) / nullif(sum(outstanding), 0), 2) AS npl_pct FROM {banking} WHERE report_date = (SELECT max(report_date) FROM {banking}) GROUP BY regulator ORDER BY regulator",
    "check_insurance_breaches": "SELECT regulator, country, branch, product, loss_ratio FROM {insuring} WHERE breach AND report_date = (SELECT max(report_date) FROM {insuring}) ORDER BY loss_ratio DESC, country, product LIMIT 20",
    "check_freshness": "SELECT event_type, CAST(count(*) AS BIGINT) AS n, max(ts) AS last FROM {events} GROUP BY event_type ORDER BY event_type",
    "check_stream_unique": "SELECT event_id, CAST(count(*) AS BIGINT) AS n FROM (SELECT event_id FROM {events} UNION ALL SELECT event_id FROM {events} WHERE event_id % 50 = 0) e GROUP BY event_id HAVING count(*) > 1",
    "check_conversion": "SELECT CAST(count(*) AS BIGINT) AS n, CAST(count_if(amount_eur IS NULL) AS BIGINT) AS unconverted, CAST(count_if(orphan) AS BIGINT) AS orphans FROM {bank}",
    "check_rt": "SELECT country, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT id) AS BIGINT) AS n_ids, CAST(count_if(amount_eur IS NULL) AS BIGINT) AS unconverted, CAST(count_if(orphan) AS BIGINT) AS orphans, CAST(count_if(orphan_branch) AS BIGINT) AS branch_orphans, max(ts) AS last FROM {rt} GROUP BY country",
    "check_rt_alerts": "SELECT country, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT alert_id) AS BIGINT) AS n_ids, CAST(count(DISTINCT subject_id) AS BIGINT) AS subjects, max(event_time) AS last FROM {rt_bursts} GROUP BY country",
    "check_alerts": "SELECT rule_code, country, CAST(count(*) AS BIGINT) AS n FROM (SELECT rule_code, country FROM {burst} UNION ALL SELECT rule_code, country FROM {abroad} UNION ALL SELECT rule_code, country FROM {claims3x} UNION ALL SELECT rule_code, country FROM {aml} UNION ALL SELECT rule_code, country FROM {liquidity}) a GROUP BY rule_code, country ORDER BY rule_code, country",
    "check_aml_by_country": "SELECT country, entity, CAST(count(*) AS BIGINT) AS n, round(sum(amount_eur), 2) AS eur FROM {aml} GROUP BY country, entity ORDER BY n DESC, country, entity",
    "check_liquidity_windows": "SELECT country, window_start, window_end, amount_eur FROM {liquidity} ORDER BY amount_eur DESC, country, window_start LIMIT 10",
    "check_last_alerts": "SELECT rule_code, subject_id, event_time FROM {aml} ORDER BY event_time DESC, subject_id, alert_id LIMIT 5",
    "check_recent_alerts": "SELECT rule_code, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT subject_id) AS BIGINT) AS subjects FROM {abroad} WHERE event_time >= (SELECT max(event_time) - INTERVAL 30 MINUTE FROM {abroad}) GROUP BY rule_code",
    # BI datasets
    "bi_revenue": "SELECT month, country, CASE line WHEN 'BANK' THEN 'Banking' WHEN 'MICROFINANCE' THEN 'Microfinance' WHEN 'OPERATOR' THEN 'Mobile money' ELSE 'Insurance' END AS business_line, round(sum(revenue), 2) AS revenue FROM (SELECT month, country, entity AS line, revenue FROM {arpu} UNION ALL SELECT month, country, entity, premiums FROM {loss}) u GROUP BY 1, 2, 3",
    "bi_revenue_per_client": "SELECT month, country, CAST(sum(clients) AS BIGINT) AS clients, round(sum(revenue), 2) AS revenue FROM {arpu} GROUP BY month, country",
    "bi_top_products": "SELECT country, product, users, CAST(place AS BIGINT) AS place FROM (SELECT country, product, users, row_number() OVER (PARTITION BY country ORDER BY users DESC, product) AS place FROM (SELECT country, product, CAST(count(DISTINCT who) AS BIGINT) AS users FROM (SELECT country, type AS product, account AS who FROM {bank} UNION ALL SELECT sender_country, operator, sender FROM {mob} WHERE sender_country IS NOT NULL UNION ALL SELECT country, 'LOAN', loan FROM {loan}) u GROUP BY country, product) n) r WHERE place <= 10",
    "bi_npl": "SELECT month, country, npl_pct, CASE WHEN npl_pct < 3 THEN 'green' WHEN npl_pct <= 5 THEN 'orange' ELSE 'red' END AS light, month = max(month) OVER (PARTITION BY country) AS is_latest FROM (SELECT month, country, round(100e0 * sum(bad_outstanding) / nullif(sum(outstanding), 0), 2) AS npl_pct FROM {npl} GROUP BY month, country) m",
    "bi_loss_12_months": "WITH z AS (SELECT max(month) AS upto FROM {loss}) SELECT country, product, round(sum(premiums), 2) AS premiums, round(sum(claims), 2) AS claims, round(100e0 * sum(claims) / nullif(sum(premiums), 0), 2) AS loss_pct FROM {loss} CROSS JOIN z WHERE month > upto - INTERVAL 12 MONTH GROUP BY country, product",
    "bi_aml_30_days": "WITH z AS (SELECT max(CAST(event_time AS DATE)) AS upto FROM {aml}) SELECT CAST(event_time AS DATE) AS day, country, CAST(count(*) AS BIGINT) AS n, round(sum(amount_eur), 2) AS eur FROM {aml} CROSS JOIN z WHERE CAST(event_time AS DATE) > upto - INTERVAL 30 DAY GROUP BY CAST(event_time AS DATE), country",
    "bi_claim_delay": "WITH z AS (SELECT max(month) AS upto FROM {claim}) SELECT country, branch, mean_days, CASE WHEN branch = 'IARD' THEN 10 ELSE 20 END AS sla_days, CASE WHEN mean_days <= CASE WHEN branch = 'IARD' THEN 10 ELSE 20 END THEN 'met' ELSE 'missed' END AS sla, country || ' ' || branch AS label FROM (SELECT country, branch, round(sum(mean_days * n_closed) / sum(n_closed), 2) AS mean_days FROM {claim} CROSS JOIN z WHERE month > upto - INTERVAL 12 MONTH GROUP BY country, branch) c",
    "bi_mobile_by_hour": "SELECT concat(lpad(CAST(hour AS VARCHAR(2)), 2, '0'), 'h') AS label, sender_country AS country, CAST(count(*) AS BIGINT) AS n, round(sum(amount), 2) AS amount FROM {mob} WHERE sender_country IS NOT NULL GROUP BY hour, sender_country",
    "bi_corridors_ranked": "SELECT corridor, amount, n, CAST(row_number() OVER (ORDER BY amount DESC, corridor) AS BIGINT) AS place FROM (SELECT corridor, round(sum(total), 2) AS amount, CAST(sum(n_ops) AS BIGINT) AS n FROM {corr} GROUP BY corridor) c",
    "bi_mobile_failures": "SELECT day, operator, CAST(sum(n_ops) AS BIGINT) AS n_ops, CAST(sum(n_failed) AS BIGINT) AS n_failed FROM {flow} GROUP BY day, operator",
    # metrics: ratios of sums, never means of ratios
    "metric_revenue": "SELECT entity, round(sum(revenue), 2) AS revenue FROM {arpu} GROUP BY entity",
    "metric_revenue_per_client": "SELECT country, floor(CAST(sum(CAST(round(revenue * 100) AS BIGINT)) AS DOUBLE) / nullif(sum(clients), 0) + 0.5) / 100 AS value FROM {arpu} GROUP BY country",
    "metric_npl_pct": "SELECT country, round(100e0 * sum(bad_outstanding) / nullif(sum(outstanding), 0), 2) AS value FROM {npl} GROUP BY country",
    "metric_loss_pct": "SELECT country, round(100e0 * sum(claims) / nullif(sum(premiums), 0), 2) AS value FROM {loss} GROUP BY country",
    "metric_aml_alerts": "SELECT country, CAST(count(*) AS BIGINT) AS value FROM {aml} GROUP BY country",
    "metric_claim_days": "SELECT country, round(sum(mean_days * n_closed) / nullif(sum(n_closed), 0), 2) AS value FROM {claim} GROUP BY country",
    "metric_sla_pct": "SELECT branch, round(100e0 * count_if(mean_days <= CASE WHEN branch = 'IARD' THEN 10 ELSE 20 END) / nullif(count(*), 0), 2) AS value FROM {claim} GROUP BY branch",
    "metric_payments": "SELECT operator, CAST(sum(n_success) AS BIGINT) AS value FROM {flow} GROUP BY operator",
    "metric_corridor_amount": "SELECT in_union, round(sum(total), 2) AS value FROM {corr} GROUP BY in_union",
    "metric_failed_pct": "SELECT operator, round(100e0 * sum(n_failed) / nullif(sum(n_ops), 0), 2) AS value FROM {flow} GROUP BY operator",
    "metric_by_country": "SELECT country, month, round(sum(revenue), 2) AS revenue FROM {arpu} WHERE country IN ('NATION_1', 'NATION_2', 'NATION_3') GROUP BY country, month",
    "top_corridors": "SELECT corridor, round(sum(total), 2) AS amount FROM {corr} GROUP BY corridor ORDER BY 2 DESC, 1 LIMIT 5",
    # batch up to a day, speed after it, over the last days
    "unified_view": "WITH z AS (SELECT max(day) AS upto FROM {flow}), b AS (SELECT day, country, CAST(sum(n_ops) AS BIGINT) AS n, sum(total) AS amount FROM {flow} CROSS JOIN z WHERE day <= upto - INTERVAL 1 DAY GROUP BY day, country), s AS (SELECT CAST(ts AS DATE) AS day, sender_country AS country, CAST(count(*) AS BIGINT) AS n, sum(CASE WHEN status = 'SUCCESS' THEN amount END) AS amount FROM {mob} CROSS JOIN z WHERE CAST(ts AS DATE) > upto - INTERVAL 1 DAY AND sender_country IS NOT NULL GROUP BY CAST(ts AS DATE), sender_country) SELECT coalesce(b.day, s.day) AS day, coalesce(b.country, s.country) AS country, coalesce(b.n, s.n) AS n, round(coalesce(b.amount, s.amount), 2) AS amount, CASE WHEN b.day IS NULL THEN 'speed' ELSE 'batch' END AS layer FROM b FULL OUTER JOIN s ON b.day = s.day AND b.country = s.country WHERE coalesce(b.day, s.day) > (SELECT upto - INTERVAL 3 DAY FROM z)",
    "unified_rows": "SELECT coalesce(b.day, s.day) AS day, coalesce(b.country, s.country) AS country, round(coalesce(b.total, 0) + coalesce(s.amount, 0), 2) AS amount FROM (SELECT day, country, round(sum(total), 2) AS total FROM {flow} GROUP BY day, country) b FULL OUTER JOIN (SELECT CAST(ts AS DATE) AS day, sender_country AS country, amount FROM {mob} WHERE status = 'SUCCESS' AND sender_country IS NOT NULL) s ON b.day = s.day AND b.country = s.country",
}


def names(sql: str) -> list[str]:
    return [n for n in (*TABLES, *BASE) if "{" + n + "}" in sql]


def once(df: DataFrame) -> DataFrame:
    """df written and read back, so that it is worked out once."""
    df.write.parquet(place := new_place(df.sparkSession, "served"))
    return df.sparkSession.read.schema(df.schema).parquet(place)


def served(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    """The text over the frames that it names.

    Metrics and reports are small beside what they are made of, and are made once where a text names them more than once:
    in one plan Spark would work out each place anew, as places that ask for different columns share no shuffle.
    """

    def frame(n: str) -> DataFrame:
        if n in BASE:
            return load(spark, sf, n)
        part, name = TABLES[n]
        df = part.QUERIES[name](spark, sf)
        return once(df) if part in (gold, reports) and sql.count("{" + n + "}") > 1 else df

    return spark.sql(sql, **{n: frame(n) for n in names(sql)})


def compared(sql: str) -> str:
    """The same text over the tables' own SQL."""
    ctes = ", ".join(f"{n}_ AS ({TABLES[n][0].ORACLES[TABLES[n][1]]})" for n in names(sql) if n in TABLES)
    body = sql.format(**{n: n if n in BASE else f"{n}_" for n in names(sql)})
    return body if not ctes else f"WITH {ctes}, {body[5:]}" if body.startswith("WITH ") else f"WITH {ctes} {body}"


QUERIES = {k: partial(lambda sql, spark, sf: served(spark, sf, sql), sql) for k, sql in SQL.items()}
ORACLES = {k: compared(sql) for k, sql in SQL.items()}
