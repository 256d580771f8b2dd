"""Quality checks on inputs that fail them and on inputs that pass, plus the report's numbers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from caselake.catalog.layers import (
    GOLD_SQL, SEEDS_SQL, WITH_SILVER, bronze_table, lookup_table, scorecard_sql, silver_table, typed_table,
)
from caselake.catalog.questions import ONLY
from caselake.catalog.registry import query
from caselake.catalog.standin import RAW_SQL, TYPED_SQL, table, typed_complaints
from caselake.operators import checks as K
from caselake.plans import gold as G
from caselake.plans import report as R
from caselake.plans import silver as S
from caselake.sources.relations import load_seed, load_seeds


@query("l1_unique", f"""{ONLY}
SELECT complaint_id, count(*) AS n FROM complaints WHERE complaint_id IS NOT NULL GROUP BY 1 HAVING n > 1""")
def _(spark, sf):
    return K.unique(typed_complaints(spark, sf), "complaint_id")


@query("l1_not_null", f"{ONLY} SELECT * FROM complaints WHERE complaint_id IS NULL")
def _(spark, sf):
    return K.not_null(typed_complaints(spark, sf), "complaint_id")


@query("l2_relationships", f"""WITH {TYPED_SQL}, {SEEDS_SQL}
SELECT state, count(*) AS n FROM complaints WHERE state NOT IN (SELECT state_code FROM state_ref) GROUP BY 1""")
def _(spark, sf):
    return K.relationships(typed_complaints(spark, sf), load_seed(spark, "state_ref"), "state", "state_code")


@query("l3_accepted_values", f"""{ONLY}
SELECT submitted_via, count(*) AS n FROM complaints WHERE submitted_via NOT IN ('Web', 'Referral', 'Phone') GROUP BY 1""")
def _(spark, sf):
    return K.accepted_values(typed_complaints(spark, sf), "submitted_via", ["Web", "Referral", "Phone"])


@query("l4_accepted_range", """
SELECT l_quantity AS failing_value FROM lineitem WHERE l_quantity < 5 OR l_quantity > 45""")
def _(spark, sf):
    return K.accepted_range(table(spark, sf, "lineitem"), "l_quantity", 5.0, 45.0)


@query("l5_unique_combination", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING n > 1""")
def _(spark, sf):
    return K.unique_combination(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


RECONCILE_SQL = """
n AS (SELECT (SELECT count(*) FROM raw) AS bronze_rows,
  (SELECT count(*) FROM staged WHERE complaint_id IS NULL OR date_received IS NULL) AS rejected_rows,
  (SELECT count(*) FROM {clean}) AS clean_rows,
  (SELECT count(DISTINCT complaint_id) FROM staged WHERE date_received IS NOT NULL) AS distinct_valid_ids)
SELECT * FROM n WHERE clean_rows <> distinct_valid_ids OR bronze_rows < clean_rows + rejected_rows"""


@query("l6_bronze_reconciles", WITH_SILVER + "," + RECONCILE_SQL.format(clean="silver"))
def _(spark, sf):
    bronze = bronze_table(spark, sf)
    return K.bronze_reconciles(bronze, S.stage(bronze), silver_table(spark, sf))


@query("l6_bronze_does_not_reconcile", WITH_SILVER + "," + RECONCILE_SQL.format(clean="(SELECT * FROM silver WHERE state IS NOT NULL)"))
def _(spark, sf):
    bronze = bronze_table(spark, sf)
    return K.bronze_reconciles(bronze, S.stage(bronze), silver_table(spark, sf).filter("state IS NOT NULL"))


@query("l7_totals_add_back", f"""{GOLD_SQL}
SELECT 'monthly' AS model, CAST(sum(complaints) AS BIGINT) AS model_total, (SELECT count(*) FROM silver WHERE company IS NOT NULL) AS expected
FROM monthly""")
def _(spark, sf):
    # one model that adds back and one measured against the wrong condition
    silver = silver_table(spark, sf)
    models = {
        "scorecard": (G.company_scorecard(silver), "complaints", F.col("company").isNotNull()),
        "monthly": (G.monthly_product_stats(silver), "complaints", F.col("company").isNotNull()),
    }
    return K.totals_add_back(silver, models)


@query("l8_merged_across_legal_forms", f"""{WITH_SILVER}
SELECT company_base AS company, string_agg(DISTINCT legal_form, ' | ' ORDER BY legal_form) AS legal_forms,
  string_agg(company_raw, ' | ' ORDER BY company_raw) AS raw_spellings
FROM lookup WHERE NOT mapped_by_seed GROUP BY 1 HAVING count(DISTINCT nullif(legal_form, '')) > 1""")
def _(spark, sf):
    # a failing input: every spelling merged by its base alone
    careless = lookup_table(spark, sf).withColumn("company", F.col("company_base"))
    return K.merged_across_legal_forms(careless)


@query("l8_no_merge_across_legal_forms", f"""{WITH_SILVER}
SELECT company, string_agg(DISTINCT legal_form, ' | ' ORDER BY legal_form) AS legal_forms,
  string_agg(company_raw, ' | ' ORDER BY company_raw) AS raw_spellings
FROM lookup WHERE NOT mapped_by_seed GROUP BY 1 HAVING count(DISTINCT nullif(legal_form, '')) > 1""")
def _(spark, sf):
    return K.merged_across_legal_forms(lookup_table(spark, sf))


@query("l9_partial_month_only_latest", f"""{GOLD_SQL}
SELECT DISTINCT month FROM monthly WHERE is_partial_month AND month <> (SELECT max(month) FROM monthly)""")
def _(spark, sf):
    return K.partial_month_not_latest(G.monthly_product_stats(silver_table(spark, sf)))


@query("l11_check_results", f"""{ONLY}
SELECT 'id is unique' AS check_name, 'error' AS severity, (SELECT count(*) FROM (SELECT 1 FROM complaints WHERE complaint_id IS NOT NULL
  GROUP BY complaint_id HAVING count(*) > 1)) AS bad_rows
UNION ALL SELECT 'day is set', 'warn', count(*) FROM complaints WHERE date_received IS NULL
UNION ALL SELECT 'product is set', 'error', count(*) FROM complaints WHERE product IS NULL""")
def _(spark, sf):
    rows = typed_table(spark, sf)
    results = K.run_checks(
        [
            K.Check("id is unique", K.unique(rows, "complaint_id")),
            K.Check("day is set", K.not_null(rows, "date_received"), K.WARN),
            K.Check("product is set", K.not_null(rows, "product")),
        ]
    )
    return spark.createDataFrame(
        [(r.name, r.severity, r.bad_rows) for r in results], "check_name STRING, severity STRING, bad_rows BIGINT"
    )


@query("l13_freshness", f"""WITH {RAW_SQL}
SELECT max(_ingested_at) AS last_ingest, epoch(TIMESTAMP '2001-07-12 12:00:00' - max(_ingested_at)) / 86400.0 AS age_days, 'warn' AS state FROM raw""")
def _(spark, sf):
    return K.freshness(bronze_table(spark, sf), datetime(2001, 7, 12, 12))


@query("l13_recent_rows", f"""{WITH_SILVER}
SELECT min(date_received) AS first_date, max(date_received) AS last_date, count(*) FILTER (date_received >= d - INTERVAL 7 DAY)
  AS rows_last_7_days FROM silver, (SELECT max(date_received) AS d FROM silver)""")
def _(spark, sf):
    return K.recent_rows(silver_table(spark, sf))


@query("l14_layer_counts", f"""{WITH_SILVER}
SELECT *, bronze - rejects - silver AS duplicates_removed FROM (SELECT (SELECT count(*) FROM raw) AS bronze,
  (SELECT count(*) FROM staged WHERE complaint_id IS NULL OR date_received IS NULL) AS rejects, (SELECT count(*) FROM silver) AS silver)""")
def _(spark, sf):
    return R.layer_counts({"bronze": bronze_table(spark, sf), "silver": silver_table(spark, sf)})


@query("l14_repeated_ids", f"""{WITH_SILVER}
SELECT count(*) AS repeated_ids FROM (SELECT complaint_id FROM staged WHERE complaint_id IS NOT NULL AND date_received IS NOT NULL
  GROUP BY 1 HAVING count(*) > 1)""")
def _(spark, sf):
    return R.repeated_ids(bronze_table(spark, sf))


@query("l14_reject_reasons", f"""{WITH_SILVER}
SELECT if(complaint_id IS NULL, 'invalid complaint_id', 'invalid date_received') AS reject_reason, count(*) AS rows
FROM staged WHERE complaint_id IS NULL OR date_received IS NULL GROUP BY 1""")
def _(spark, sf):
    return R.reject_reasons(S.rejects(bronze_table(spark, sf)))


@query("l14_completeness", WITH_SILVER + " UNION ALL ".join(
    f" SELECT '{label}' AS column_name, round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 3) AS pct_null FROM silver"
    for label, c in R.COMPLETENESS.items()
))
def _(spark, sf):
    return R.completeness(silver_table(spark, sf))


@query("l14_invalid_states", f"{WITH_SILVER} SELECT state_raw, count(*) AS rows FROM silver WHERE dq_invalid_state GROUP BY 1")
def _(spark, sf):
    return R.invalid_states(silver_table(spark, sf))


@query("l14_standardisation", f"""{WITH_SILVER}
SELECT (SELECT count(*) FROM lookup) AS raw_names, (SELECT count(DISTINCT company) FROM lookup) AS companies,
  (SELECT count(*) FROM lookup WHERE mapped_by_seed) AS seed_mapped,
  (SELECT count(*) FROM silver WHERE issue <> issue_raw) AS issues_renamed,
  (SELECT count(DISTINCT product) FROM silver WHERE product NOT IN (SELECT product FROM product_map)) AS products_unmapped""")
def _(spark, sf):
    return R.standardisation(silver_table(spark, sf), lookup_table(spark, sf), load_seeds(spark)["product_map"])


@query("l14_largest_companies", ",\n".join([WITH_SILVER, scorecard_sql()]) + """,
big AS (SELECT company, complaints, raw_name_variants FROM scorecard ORDER BY complaints DESC, company LIMIT 20)
SELECT b.company, complaints, raw_name_variants, string_agg(DISTINCT l.company_raw, ' | ' ORDER BY l.company_raw) AS raw_spellings
FROM big b JOIN lookup l ON l.company = b.company GROUP BY ALL""")
def _(spark, sf):
    return R.largest_companies(G.company_scorecard(silver_table(spark, sf)), lookup_table(spark, sf))


@query("l14_all_late_companies", ",\n".join([WITH_SILVER, scorecard_sql(20)]) + """
SELECT company, complaints, late_responses, late_pct FROM scorecard WHERE dq_check_all_late""")
def _(spark, sf):
    return R.all_late_companies(G.company_scorecard(silver_table(spark, sf), min_complaints=20))
