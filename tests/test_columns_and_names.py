from datetime import date

import pytest
from pyspark.sql import functions as F

from caselake.functions import columns as C
from caselake.plans.silver import company_lookup, company_names
from caselake.sources.relations import inline_relation, load_seed, seed_rows


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-03-04", date(2025, 3, 4)), ("2025/03/04", date(2025, 3, 4)), ("2025-3-4", date(2025, 3, 4)),
        (" 2025-03-04 10:00:00 ", date(2025, 3, 4)), ("2025-02-30", None), ("2025", None), ("2025-03", None),
        ("not a date", None), ("", None), (None, None), ("2025-03/04", None),
    ],
)
def test_safe_date(spark, text, expected):
    assert one(spark, C.safe_date(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize(
    "text, expected",
    [("12", 12), (" 12 ", 12), (" 12", 12), ("+7", 7), ("-3", -3), ("x12", None), ("", None), ("12.7", None), (None, None)],
)
def test_safe_long(spark, text, expected):
    assert one(spark, C.safe_long(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize(
    "text, expected",
    [("  a ", "a"), (" a b ", "a b"), ("   ", None), ("", None), (None, None), ("\ta", "\ta"), ("é ", "é")],
)
def test_clean_text(spark, text, expected):
    assert one(spark, C.clean_text(F.lit(text).cast("string"))) == expected


def test_default_flags_and_rates(spark):
    assert one(spark, C.clean_text(F.lit(" "), "Unknown")) == "Unknown"
    assert [one(spark, C.yes_no(F.lit(t))) for t in ("Yes", " No", "yes", "")] == [True, False, None, None]
    assert one(spark, C.pct(F.lit(1), F.lit(3))) == 33.33
    assert one(spark, C.pct(F.lit(1), F.lit(0))) is None
    assert one(spark, C.round_half(F.lit(1.005), 2)) == 1.0


def test_hour_marks_are_counted(spark):
    start, end = F.lit("2025-01-01 10:59:00").cast("timestamp"), F.lit("2025-01-01 12:01:00").cast("timestamp")
    assert one(spark, C.hour_boundaries(start, end)) == 2


def test_product_groups_by_rule_and_by_seed_agree(spark):
    rows = load_seed(spark, "product_map").select("product_group", C.product_group("product").alias("by_rule"))
    assert rows.filter("product_group <> by_rule").count() == 0
    assert one(spark, C.product_group(F.lit("MORTGAGE loans"))) == "Mortgage"
    assert one(spark, C.product_group(F.lit("Something new"))) == "Something new"


COMPANIES = {
    "WELLS FARGO & COMPANY": "WELLS FARGO",
    "Wells Fargo & Co.": "WELLS FARGO",
    "Credit Corp Solutions Inc.": "CREDIT CORP SOLUTIONS",
    "Credit Solutions LLC": "CREDIT SOLUTIONS",
    "INDEPENDENT BANK CORP.": "INDEPENDENT BANK CORP",
    "INDEPENDENT BANK GROUP, INC.": "INDEPENDENT BANK GROUP INC",
    "CL Holdings LLC": "CL HOLDINGS",
    "IPAC'S Inc.": "IPACS",
    "COSTCO WHOLESALE": "COSTCO WHOLESALE",
    "Bank of the West": "BANK OF THE WEST",
    "TRANSUNION INTERMEDIATE HOLDINGS, INC.": "TRANSUNION",
}


@pytest.mark.parametrize("partitions", [1, 8])
def test_company_rules(spark, partitions):
    raw = inline_relation(spark, [(c,) for c in COMPANIES] * 2, "company_raw STRING").repartition(partitions)
    reviewed = inline_relation(
        spark, [("TRANSUNION INTERMEDIATE", "TRANSUNION")], "company_norm STRING, company_canonical STRING"
    )
    found = {r["company_raw"]: r["company"] for r in company_lookup(company_names(raw), reviewed).collect()}
    assert found == COMPANIES


def test_name_of_nothing_but_a_suffix_keeps_its_text(spark):
    raw = inline_relation(spark, [("The",), (" ",), ("...",)], "company_raw STRING")
    found = company_lookup(raw, load_seed(spark, "company_map")).collect()
    assert {r["company_raw"]: r["company"] for r in found}["..."] == "..."


def test_seeds(spark):
    assert [len(seed_rows(n)) for n in ["product_map", "issue_map", "company_map", "state_ref", "state_alias"]] == [
        21, 7, 10, 63, 1,
    ]
    assert load_seed(spark, "product_map").filter("product LIKE 'Credit reporting, credit repair%'").count() == 1


def test_only_dates_with_slashes_are_rewritten(spark):
    texts = ["1996-03-04", "1996/03/04", " 1996/3/4 ", "1996-03/04", "1996/03/04 10:11", "1996-02-30", "/", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING").select(C.safe_date("t").alias("d")).collect()
    day = date(1996, 3, 4)
    assert [r["d"] for r in rows] == [day, day, day, None, day, None, None, None, None]
    assert "contains" in str(C.safe_date("t"))
