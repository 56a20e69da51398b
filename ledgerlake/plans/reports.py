"""Regulatory reports as of a date, with the SQL that gives the same rows."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.expressions import ratio
from ledgerlake.plans import gold
from ledgerlake.plans.silver import countries

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

REPORT_DATE = datetime.date(1999, 7, 1)
# Who supervises banks and insurers, by region.
BANKING = {"AFRICA": "BOG", "AMERICA": "BCRG"}
INSURING = {"AFRICA": "NIC", "AMERICA": "DNA_GN"}
UNION_BANKING, UNION_INSURING = "BCEAO", "CIMA"
NPL_LIMIT, LOSS_LIMIT = 0.05, 0.70

_CASE = "CASE r_name WHEN 'AFRICA' THEN '{}' WHEN 'AMERICA' THEN '{}' ELSE '{}' END"
_WHERE = "JOIN nation ON n_name = {0}.country JOIN region ON n_regionkey = r_regionkey"


def query(sql: str):
    def put(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return put


def as_of(report_date: datetime.date) -> Column:
    """First day of the last month that is complete, or running, the day before the report."""
    return F.trunc(F.date_sub(F.lit(report_date), 1), "month")


def supervised(df: DataFrame, spark: SparkSession, sf: str, by: dict[str, str], default: str) -> DataFrame:
    known = F.create_map(*[F.lit(x) for pair in by.items() for x in pair])
    where = countries(spark, sf).select("country", "region")
    return df.join(where, "country").withColumn("regulator", F.coalesce(known[F.col("region")], F.lit(default))).drop("region")


@query(f"""WITH npl AS ({gold.ORACLES["gold_npl"]}), l AS (SELECT country, entity, max(month) AS month FROM npl WHERE month <= date_trunc('month', DATE '{REPORT_DATE}' - INTERVAL 1 DAY) GROUP BY ALL)
SELECT DATE '{REPORT_DATE}' AS report_date, {_CASE.format(*BANKING.values(), UNION_BANKING)} AS regulator, npl.country, npl.entity, npl.month, n_loans, n_bad, outstanding, bad_outstanding, npl_ratio, coalesce(npl_ratio > {NPL_LIMIT}, FALSE) AS breach FROM npl JOIN l ON npl.country = l.country AND npl.entity = l.entity AND npl.month = l.month {_WHERE.format("npl")}""")
def report_banking(spark: SparkSession, sf: str, report_date: datetime.date = REPORT_DATE) -> DataFrame:
    """The latest month up to the report's for each country and entity: a groupwise latest by max_by, without a join back."""
    npl = gold.QUERIES["gold_npl"](spark, sf).where(F.col("month") <= as_of(report_date))
    values = ["month", "n_loans", "n_bad", "outstanding", "bad_outstanding", "npl_ratio"]
    last = npl.groupBy("country", "entity").agg(F.max_by(F.struct(*values), "month").alias("v")).select("country", "entity", "v.*")
    out = supervised(last, spark, sf, BANKING, UNION_BANKING)
    return out.withColumns({"report_date": F.lit(report_date), "breach": F.coalesce(F.col("npl_ratio") > NPL_LIMIT, F.lit(False))})


@query(f"""WITH m AS ({gold.ORACLES["gold_loss_ratio"]}), c AS ({gold.ORACLES["gold_claim_time"]}), z AS (SELECT date_trunc('month', DATE '{REPORT_DATE}' - INTERVAL 1 DAY)::DATE AS upto),
y AS (SELECT country, entity, branch, product, min(month) AS first_month, max(month) AS data_month, round(sum(premiums), 2) AS premiums, round(sum(claims), 2) AS claims, CAST(sum(n_claims) AS BIGINT) AS n_claims FROM m, z WHERE month <= upto AND year(month) = year(upto) GROUP BY ALL),
d AS (SELECT country, branch, round(sum(mean_days * n_closed) / sum(n_closed), 2) AS mean_days FROM c, z WHERE month <= upto AND year(month) = year(upto) GROUP BY ALL)
SELECT DATE '{REPORT_DATE}' AS report_date, date_trunc('year', (SELECT upto FROM z))::DATE AS period_start, {_CASE.format(*INSURING.values(), UNION_INSURING)} AS regulator, y.*, d.mean_days, CASE WHEN premiums > 0 THEN round(claims / premiums, 4) END AS loss_ratio, coalesce(CASE WHEN premiums > 0 THEN round(claims / premiums, 4) END > {LOSS_LIMIT}, FALSE) AS breach
FROM y LEFT JOIN d USING (country, branch) {_WHERE.format("y")}""")
def report_insurance(spark: SparkSession, sf: str, report_date: datetime.date = REPORT_DATE) -> DataFrame:
    """Sums since 1 January, with the claim delay of country and branch weighted by closed claims."""
    upto = as_of(report_date)
    this_year = (F.col("month") <= upto) & (F.year("month") == F.year(upto))
    m = gold.QUERIES["gold_loss_ratio"](spark, sf).where(this_year)
    y = m.groupBy("country", "entity", "branch", "product").agg(F.min("month").alias("first_month"), F.max("month").alias("data_month"), F.round(F.sum("premiums"), 2).alias("premiums"), F.round(F.sum("claims"), 2).alias("claims"), F.sum("n_claims").alias("n_claims"))
    c = gold.QUERIES["gold_claim_time"](spark, sf).where(this_year)
    d = c.groupBy("country", "branch").agg(F.round(F.sum(F.col("mean_days") * F.col("n_closed")) / F.sum("n_closed"), 2).alias("mean_days"))
    out = supervised(y.join(d, ["country", "branch"], "left"), spark, sf, INSURING, UNION_INSURING)
    out = out.withColumn("loss_ratio", ratio(F.col("claims"), F.col("premiums")))
    return out.withColumns({"report_date": F.lit(report_date), "period_start": F.trunc(upto, "year"), "breach": F.coalesce(F.col("loss_ratio") > LOSS_LIMIT, F.lit(False))})


@query(f"""WITH b AS ({ORACLES["report_banking"]}), i AS ({ORACLES["report_insurance"]})
SELECT 'banking' AS report, regulator, country, entity AS subject, npl_ratio AS value FROM b WHERE breach UNION ALL SELECT 'insurance', regulator, country, branch || '/' || product, loss_ratio FROM i WHERE breach""")
def report_breaches(spark: SparkSession, sf: str) -> DataFrame:
    """What is over its limit in either report, the worst first in each."""
    b = report_banking(spark, sf).where("breach").select(F.lit("banking").alias("report"), "regulator", "country", F.col("entity").alias("subject"), F.col("npl_ratio").alias("value"))
    i = report_insurance(spark, sf).where("breach").select(F.lit("insurance").alias("report"), "regulator", "country", F.concat_ws("/", "branch", "product").alias("subject"), F.col("loss_ratio").alias("value"))
    return b.unionByName(i).orderBy("report", F.desc("value"), "country", "subject")
