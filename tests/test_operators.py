import hashlib
import itertools
import random
import re
import statistics
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from caselake.operators import aggregates as G
from caselake.operators import cases as K
from caselake.operators import checks as Q
from caselake.operators import joins as J
from caselake.operators import numbering as N
from caselake.operators import profiles as P
from caselake.operators import scans as SC
from caselake.operators import similarity as S
from caselake.sources.relations import inline_relation


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has one key, a tenth has none."""
    values = [(i, "hot" if i % 3 == 0 else (None if i % 10 == 1 else f"k{i % 7}")) for i in range(3000)]
    return inline_relation(spark, values, "id INT, k STRING").repartition(8)


def test_salted_lookup_join_equals_broadcast(spark, skewed):
    lookup = inline_relation(spark, [("hot", 1), ("k1", 2), ("k9", 3), (None, 4)], "k STRING, v INT")
    for how in ("left", "inner"):
        small = J.lookup_join(skewed, lookup, ["k"], how)
        salted = J.lookup_join(skewed, lookup, ["k"], how, max_rows=2, salts=5)
        assert "_salt" in salted._jdf.queryExecution().toString()
        assert small.columns == salted.columns
        assert rows(small) == rows(salted)
    condition = F.col("id") > F.col("v") * 100
    assert rows(J.lookup_join(skewed, lookup, ["k"], "left", condition)) == rows(
        J.lookup_join(skewed, lookup, ["k"], "left", condition, max_rows=2)
    )


def test_equal_rows_spread_over_salts(spark):
    equal = spark.range(1000).select(F.lit("hot").alias("k")).repartition(4)
    hot = J.hot_keys(equal, ["k"])
    assert [r.k for r in hot.collect()] == ["hot"]
    assert J.with_salt(equal, hot, ["k"], 8).select("_salt").distinct().count() == 8
    lookup = inline_relation(spark, [("hot", 1), ("k1", 2), ("k9", 3)], "k STRING, v INT")
    assert J.lookup_join(equal, lookup, ["k"], max_rows=2, salts=8).filter("v = 1").count() == 1000


@pytest.mark.parametrize("how", ["right", "full", "left_anti"])
def test_other_joins_are_rejected(spark, skewed, how):
    lookup = inline_relation(spark, [("hot", 1)], "k STRING, v INT")
    for most in (1, 0):
        with pytest.raises(ValueError, match=how):
            J.lookup_join(skewed, lookup, ["k"], how, max_rows=most)


def test_sample_orders_no_wide_rows(spark):
    rows = [(i // 3, f"text {i}") for i in range(3000)]
    df = inline_relation(spark, rows, "id LONG, t STRING").repartition(6)
    got = sorted((r.id, r.t) for r in G.reproducible_sample(df, "id", 100).collect())
    md5 = lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest()
    assert got == sorted(sorted(rows, key=lambda r: (md5(r[0]), *r))[:100])


def test_broadcast_only_after_the_size_check(spark):
    df = inline_relation(spark, [("a" * 100,)] * 50, "t STRING")
    assert J.fits_broadcast(df) and J.fits_broadcast(df.repartition(2))
    assert not J.fits_broadcast(df, max_rows=49)
    assert not J.fits_broadcast(df.repartition(2), max_bytes=4999)


def test_temporal_join(spark):
    versions = inline_relation(
        spark,
        [("A", "ACME BANK", date(2011, 1, 1), date(2024, 6, 1)), ("A", "ACME FINANCIAL", date(2024, 6, 1), None)],
        "company_id STRING, name STRING, valid_from DATE, valid_to DATE",
    )
    facts = inline_relation(
        spark,
        [(101, "A", date(2023, 3, 10)), (102, "A", date(2024, 5, 31)), (103, "A", date(2024, 6, 1)), (104, "A", date(2025, 1, 15))],
        "id INT, company_id STRING, d DATE",
    )
    found = {r["id"]: r["name"] for r in J.temporal_join(facts, versions, ["company_id"], "d").collect()}
    assert found == {101: "ACME BANK", 102: "ACME BANK", 103: "ACME FINANCIAL", 104: "ACME FINANCIAL"}


def histories(rng, versions):
    """One key with a version a day, one with few, one with two long ones and gaps, one that is not asked for."""
    first = date(1999, 1, 1)
    rows = [("long", f"v{i}", first + timedelta(days=i), first + timedelta(days=i + 1)) for i in range(versions)]
    rows += [("few", f"f{i}", date(2000 + i, 1, 1), date(2001 + i, 1, 1) if i < 9 else None) for i in range(10)]
    cut = sorted(rng.sample(range(9000), 151))
    rows += [("gaps", f"g{i}", first + timedelta(days=a), first + timedelta(days=a + max(1, (b - a) // 2))) for i, (a, b) in enumerate(zip(cut, cut[1:]))]
    rows += [("gaps", "whole", date(1980, 1, 1), None), (None, "none", date(1980, 1, 1), None), ("long", "never", None, None)]
    return rows


@pytest.mark.parametrize("how", ["inner", "left"])
def test_temporal_join_over_long_histories(spark, how):
    rng = random.Random(7)
    versions = histories(rng, 3000)
    asked = [(i, rng.choice(["long", "few", "gaps", "other", None]), rng.choice([None, *[date(1998, 6, 1) + timedelta(days=rng.randrange(9500))] * 9])) for i in range(600)]
    facts = inline_relation(spark, asked, "id INT, k STRING, d DATE")
    history = inline_relation(spark, versions, "k STRING, name STRING, valid_from DATE, valid_to DATE")
    got = J.temporal_join(facts, history, ["k"], "d", how=how).select("id", "k", "d", "name").collect()
    want = []
    for i, k, d in asked:
        met = [n for key, n, a, b in versions if None not in (k, d, a) and key == k and a <= d < (b or date.max)]
        want += [(i, k, d, n) for n in (met if met or how == "inner" else [None])]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_rows_compared_grow_with_the_rows_not_the_versions(spark):
    rng = random.Random(8)
    for versions in (1000, 10_000):
        asked = [(i, "long", date(1999, 1, 1) + timedelta(days=rng.randrange(versions))) for i in range(2000)]
        facts = inline_relation(spark, asked, "id INT, k STRING, d DATE")
        history = inline_relation(spark, histories(rng, versions), "k STRING, name STRING, valid_from DATE, valid_to DATE")
        rows_, blocks = J.in_day_blocks(facts, history, ["k"], "d", "valid_from", "valid_to")
        assert rows_.join(blocks, ["k", "_block"]).count() <= 3 * len(asked)
        assert blocks.count() <= 2 * (versions + 200)


def test_not_in_and_not_exists(spark):
    df = inline_relation(spark, [(5,), (1,), (None,)], "x INT")
    with_null = inline_relation(spark, [(1,), (None,)], "v INT")
    no_null = inline_relation(spark, [(1,)], "v INT")
    none = inline_relation(spark, [], "v INT")
    assert rows(J.not_in(df, "x", with_null, "v")) == []
    assert rows(J.not_in(df, "x", no_null, "v")) == [(5,)]
    assert len(rows(J.not_in(df, "x", none, "v"))) == 3
    assert rows(J.not_exists(df, "x", with_null, "v")) == [(5,), (None,)]


def test_zero_preserving_count_and_fan_out(spark):
    members = inline_relation(spark, [("CA",), ("TX",)], "state STRING")
    facts = inline_relation(spark, [("CA", 1, 1), ("CA", 2, 0), ("NY", 3, 1)], "state STRING, id INT, ok INT")
    ok = F.col("ok") == 1
    assert rows(J.zero_preserving_count(members, facts, "state", "id", ok, "n")) == [("CA", 1), ("TX", 0)]
    assert rows(J.matched_only_count(members, facts, "state", "id", ok, "n")) == [("CA", 1)]
    lookup = inline_relation(spark, [("CA",), ("CA",), ("NY",)], "state STRING")
    assert rows(J.fan_out(facts, lookup, "state", "ok")) == [(2, 3)]
    with pytest.raises(ValueError):
        J.assert_no_fanout(lookup, ["state"])


def test_distinct_combination_counts_null_parts(spark):
    df = inline_relation(spark, [("a", None), ("a", None), ("a", "b")], "x STRING, y STRING")
    assert df.agg(G.distinct_combinations(["x", "y"]).alias("n")).first()["n"] == 2


def test_latest_per_key_limits_groups_before_the_shuffle(spark, skewed):
    latest = N.latest_per_key(skewed, ["k"], [F.desc("id")])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one below the exchange, one above
    assert {r["k"]: r["id"] for r in latest.collect()}["hot"] == 2997


def test_numbering_in_ranges_equals_one_window(spark):
    random.seed(3)
    members = [(random.choice([None, "é", "a", "Z", "zz", ""]), i if i % 5 else None) for i in range(400)]
    df = inline_relation(spark, sorted(set(members), key=str), "a STRING, b INT").repartition(5)
    one = N.dense_keys(df, ["a", "b"], "key")
    many = N.dense_keys(df, ["a", "b"], "key", max_single_task=10, buckets=7)
    assert rows(one) == rows(many)
    assert sorted(r["key"] for r in many.collect()) == list(range(1, df.count() + 1))


def days_and_ids(kind):
    rng = random.Random(kind)
    if kind == "hot day":
        return [(i, date(2025, 1, 1 + (0 if i % 3 else i % 4))) for i in rng.sample(range(900), 300)] + [(1000, None), (1001, None)]
    return [(i, date(1990, 1, 1) + timedelta(days=i * 7 % 5003)) for i in rng.sample(range(4000), 1500)]


@pytest.mark.parametrize("kind, range_rows, pieces", [("hot day", 1_000_000, 64), ("hot day", 1, 9), ("many days", 9, 2)])
def test_running_counts_and_ranks(spark, kind, range_rows, pieces):
    values = days_and_ids(kind)
    df = inline_relation(spark, values, "id INT, d DATE").repartition(6)
    counts = N.running_counts(df, "d", "id", range_rows, pieces)
    found = {r["id"]: (r["default_range_frame"], r["rows_frame"]) for r in counts.collect()}
    ordered = sorted(values, key=lambda v: (v[1] is None, v[1] or date.min, v[0]))
    last = {d: i + 1 for i, (_, d) in enumerate(ordered)}
    assert found == {cid: (last[d], i + 1) for i, (cid, d) in enumerate(ordered)}
    places = {r["id"]: (r["row_num"], r["rnk"], r["dense_rnk"]) for r in SC.positions(df, "d", "id", True, range_rows, pieces).collect()}
    ordered = sorted(values, key=lambda v: (v[1] is None, -(v[1] or date.min).toordinal(), v[0]))
    first, number = {}, {}
    for i, (_, d) in enumerate(ordered):
        first.setdefault(d, i + 1)
        number.setdefault(d, len(number) + 1)
    assert places == {cid: (i + 1, first[d], number[d]) for i, (cid, d) in enumerate(ordered)}
    ranked = N.global_rank(df, "d", "rnk", range_rows=range_rows)
    assert {r["id"]: r["rnk"] for r in ranked.collect()} == {cid: first[d] for cid, d in ordered}
    for result in (counts, ranked) if range_rows < 10 else ():  # a short list is one range
        assert "Exchange SinglePartition" not in result._jdf.queryExecution().executedPlan().toString()


def test_a_window_without_key_would_be_seen(spark):
    whole = spark.range(5).select(F.row_number().over(Window.orderBy("id")))
    assert "Exchange SinglePartition" in whole._jdf.queryExecution().executedPlan().toString()


def test_scan_tree_has_levels(spark):
    rng = random.Random(3)
    totals = [(i, rng.randrange(9)) for i in sorted(rng.sample(range(20_000), 700))]
    got = {r["i"]: r["before_n"] for r in SC.sums_before(inline_relation(spark, totals, "i INT, n BIGINT"), "i", ["n"]).collect()}
    assert got == {i: sum(n for j, n in totals if j < i) for i, _ in totals}


def test_ranges_of_split_points(spark):
    df = inline_relation(spark, [(i % 7, None if i % 11 == 0 else f"v{i % 90}", i) for i in range(800)], "a INT, b STRING, i INT")
    bounds = SC.split_points(df, ["a", "b"], 400, ["a"])
    assert len(bounds) > SC.FAN  # two steps
    key = lambda a, b: (-a, b is None, b or "")
    for r in df.withColumn("r", SC.range_of(df, ["a", "b"], bounds, ["a"])).collect():
        assert r.r == sum(key(x.a, x.b) <= key(r.a, r.b) for x in bounds)


@pytest.mark.parametrize("spread", [3, 50, 10**9])
def test_selected_percentiles_equal_the_built_in(spark, spread):
    rng = random.Random(spread)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, *[rng.randrange(spread) / 7] * 5])) for _ in range(3000)] + [("one", 5.5), ("none", None)]
    df = inline_relation(spark, data, "k STRING, v DOUBLE")
    wanted = {"low": 0.0, "p10": 0.1, "mid": 0.5, "p95": 0.95, "top": 1.0}
    built_in = df.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("s"), *[F.percentile("v", p).alias(c) for c, p in wanted.items()])
    for buckets in (4096, 5):
        got = SC.selected_percentiles(df, ["k"], "v", wanted, ("s", F.sum(F.col("v") * F.col("_n"))), buckets=buckets)
        near = lambda r: tuple(round(x, 3) if isinstance(x, float) else x for x in r)
        assert sorted(map(str, map(near, got.collect()))) == sorted(map(str, map(near, built_in.collect())))


def test_percentiles_and_sample_do_not_depend_on_partitions(spark, skewed):
    for f in (
        lambda df: G.exact_percentiles(df, ["k"], "id", {"p": 0.95}),
        lambda df: G.reproducible_sample(df, "id", 50),
    ):
        assert rows(f(skewed.coalesce(1))) == rows(f(skewed.repartition(8)))


def test_checks_find_bad_rows(spark):
    df = inline_relation(spark, [(1, "a"), (1, "b"), (2, None), (None, "a")], "id INT, t STRING")
    parent = inline_relation(spark, [("a",)], "t STRING")
    assert rows(Q.unique(df, "id")) == [(1, 2)]
    assert rows(Q.not_null(df, "t")) == [(2, None)]
    assert rows(Q.relationships(df, parent, "t", "t")) == [("b", 1)]
    assert rows(Q.accepted_values(df, "t", ["a"])) == [("b", 1)]
    assert rows(Q.accepted_range(df, "id", low=2)) == [(1,), (1,)]
    assert rows(Q.accepted_range(df, "id", 1, 2)) == []
    assert rows(Q.unique_combination(df, ["id", "t"])) == []
    lookup = inline_relation(
        spark,
        [("X CORP", "X", "CORP", False), ("X INC", "X", "INC", False), ("Y", "Y", "", True)],
        "company_raw STRING, company STRING, legal_form STRING, mapped_by_seed BOOLEAN",
    )
    assert rows(Q.merged_across_legal_forms(lookup)) == [("X", "CORP | INC", "X CORP | X INC")]
    results = Q.run_checks([Q.Check("u", Q.unique(df, "id")), Q.Check("n", Q.not_null(df, "t"), Q.WARN)])
    assert [(r.name, r.bad_rows, r.passed) for r in results] == [("u", 1, False), ("n", 1, False)]
    assert Q.gate([Q.Check("n", Q.not_null(df, "t"), Q.WARN)])[0].bad_rows == 1
    together = [
        Q.RowCheck("low", df, Q.is_outside("id", low=2)),
        Q.Check("n", Q.not_null(df, "t")),
        Q.RowCheck("listed", df, Q.is_unlisted("t", ["a"]), Q.WARN),
        Q.RowCheck("other table", parent, F.col("t").isNull()),
    ]
    assert [(r.name, r.bad_rows) for r in Q.run_checks(together)] == [("low", 2), ("n", 1), ("listed", 1), ("other table", 0)]
    assert Q.run_checks([]) == []
    with pytest.raises(Q.GateError, match="u: 1 bad rows"):
        Q.gate([Q.Check("u", Q.unique(df, "id"))])


@pytest.mark.parametrize("day, state", [(5, "pass"), (9, "warn"), (40, "error")])
def test_freshness(spark, day, state):
    bronze = spark.range(1).select(F.lit(datetime(2025, 1, 1)).cast("timestamp").alias("_ingested_at"))
    now = datetime.fromordinal(datetime(2025, 1, 1).toordinal() + day)
    assert Q.freshness(bronze, now).first()["state"] == state


def test_case_questions_treat_input_as_values(spark):
    cases = inline_relation(
        spark,
        [(i, 100 + i, "Card", "Fees", name, date(2024, 1, i)) for i, name in enumerate(["EQUIFAX", "EQUIFAX LLC", "50% OFF", "Equifax"], 1)],
        "CASE_ID INT, CMPL_ID INT, PRD_DESC STRING, ISS_DESC STRING, CO_NM STRING, RCV_DT DATE",
    )
    raw = [(10 * c + s, c, code, "T", datetime(2024, 2, 1, s)) for c in range(1, 5) for s, code in enumerate(["OPN", "INV", "ESC"])]
    history = K.with_current_flag(
        inline_relation(spark, raw, "STAT_ID INT, CASE_ID INT, STAT_CD STRING, ASGN_TEAM STRING, UPD_TS TIMESTAMP")
    )
    assert K.not_exactly_one_current(history).count() == 0
    since = date(2000, 1, 1)
    found = lambda *a, **k: [r["CMPL_ID"] for r in K.escalated_cases(cases, history, *a, **k).collect()]
    assert found("x' OR '1'='1", since) == [] and found("%", since) == [] and found("E_UIFAX", since) == []
    assert found("EQUIFAX", since) == [102, 101]
    assert found("equifax", since, ignore_case=True) == [104, 102, 101]
    assert found("", since, limit=-5) == [104] and K.clamp(100_000) == 500
    with pytest.raises(KeyError):
        found("EQUIFAX", since, sort="RCV_DT; DROP TABLE x")
    assert rows(K.status_counts(cases, history, K.status_codes(spark), "EQUIFAX")) == [("ESC", "Escalated", 2)]
    usage = {r["STAT_CD"]: (r["current_cases"], r["all_history_rows"]) for r in K.code_usage(history, K.status_codes(spark)).collect()}
    assert usage["CLS"] == (0, 0) and usage["ESC"] == (4, 4) and usage["OPN"] == (0, 4)


def plain_token_set(a, b):
    """The same score from its definition, with a table-filling common subsequence."""

    def ratio(x, y):
        if not x and not y:
            return 100.0
        table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, j in itertools.product(range(len(x)), range(len(y))):
            table[i + 1][j + 1] = table[i][j] + 1 if x[i] == y[j] else max(table[i][j + 1], table[i + 1][j])
        return 200.0 * table[-1][-1] / (len(x) + len(y))

    x, y = set(a.split()), set(b.split())
    shared, rest_x, rest_y = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if shared and (not rest_x or not rest_y):
        return 100.0
    full_x, full_y = (shared + " " + rest_x).strip(), (shared + " " + rest_y).strip()
    scores = [ratio(full_x, full_y)]
    if shared:
        scores += [ratio(shared, full_x), ratio(shared, full_y)]
    return max(scores)


def test_candidates_equal_all_pairs(spark):
    random.seed(5)
    words = ["BANK", "FIRST", "NATIONAL", "OF", "TRUST", "A", "CREDIT", "UNION", "NAVIENT", "NAVIENTS", "OCWEN", "X1", "X2", "SOLUTIONS", "SOLUTION"]
    names = sorted({" ".join(random.choices(words, k=random.randint(1, 4))) for _ in range(150)} | {"TRANSUNION", "TRANS UNION", "TRANSUNON"})
    volumes = [(n, 1000 - i) for i, n in enumerate(names)]
    for a, b in random.sample(list(itertools.combinations(names, 2)), 400):
        assert S.token_set_score(a, b) == pytest.approx(plain_token_set(a, b))
    numbered = inline_relation(spark, list(enumerate(names)), "id INT, name STRING")
    for score, rare_word in ((88, 64), (88, 3), (75, 0)):  # all, few and no words are rare
        possible = {tuple(r) for r in S.possible_pairs(numbered, score, rare_word).collect()}
        high = {(i, j) for i, j in itertools.combinations(range(len(names)), 2) if plain_token_set(names[i], names[j]) >= score}
        assert high and high <= possible
    best = {}
    for i, a in enumerate(names):
        listed = sorted(range(len(names)), key=lambda j: (-plain_token_set(a, names[j]) if j != i else -100.0, j))[:6]
        for j in listed:
            if j != i and plain_token_set(a, names[j]) >= 88:
                best[tuple(sorted((a, names[j])))] = round(plain_token_set(a, names[j]))
    scorecard = inline_relation(spark, volumes, "company STRING, complaints BIGINT")
    found = {(r["name_a"], r["name_b"]): r["score"] for r in S.company_candidates(scorecard, top=1000).collect()}
    assert found == best


def grown_names(n, rng):
    """Names as they grow: frequent words, words of their own, and misspelt copies."""
    frequent = ["BANK", "CREDIT", "UNION", "FINANCIAL", "SERVICES", "MORTGAGE", "HOME", "LOANS", "FIRST", "NATIONAL"]
    names = []
    while len(names) < n:
        if names and rng.random() < 0.15:
            letters = list(rng.choice(names))
            letters[rng.randrange(len(letters))] = rng.choice("ABCDEFGH")
            names.append("".join(letters))
        else:
            own = ["".join(rng.choice("ABCDEFGHIJKLMNOPRSTUVW") for _ in range(rng.randrange(4, 12))) for _ in range(rng.randrange(1, 3))]
            names.append(" ".join(own + rng.sample(frequent, rng.randrange(0, 3))))
    return names


def test_share_of_candidates_falls_with_the_number_of_names(spark):
    rng = random.Random(6)
    shares = []
    for n in (1000, 2000, 4000):
        numbered = inline_relation(spark, list(enumerate(grown_names(n, rng))), "id INT, name STRING")
        shares.append(S.possible_pairs(numbered, 88).count() / (n * (n - 1) / 2))
    assert shares[0] > 1.3 * shares[1] > 1.3 * 1.3 * shares[2] and shares[2] < 0.001, shares


def test_candidates_of_names_with_many_frequent_words(spark):
    rng = random.Random(2)
    pool = ["ALPHA", "BETA", "GAMMA", "DELTA", "OMEGA", "SIGMA", "KAPPA", "THETA", "LAMBDA", "ZETAS", "IOTAS", "CHIS"]
    names = [" ".join(rng.sample(pool, rng.randrange(7, 11)) + [rng.choice(["NAVIENT", "NAVIENTS", "NAVY"])]) for _ in range(60)]
    numbered = inline_relation(spark, list(enumerate(names)), "id INT, name STRING")
    possible = {tuple(r) for r in S.possible_pairs(numbered, 88, 2).collect()}
    high = {(i, j) for i, j in itertools.combinations(range(len(names)), 2) if plain_token_set(names[i], names[j]) >= 88}
    assert high and high <= possible


def test_profile_of_batches_is_the_profile_of_all(spark, tmp_path):
    rng = random.Random(9)
    data = [
        (i, 2**60 + i, rng.choice([None, rng.gauss(5, 2)]), rng.choice([None, "é", "a", "zz", f"v{i}"]), date(2020, 1, 1) + timedelta(days=i % 400), i % 3 == 0, None)
        for i in range(4000)
    ]
    df = inline_relation(spark, data, "i INT, big BIGINT, x DOUBLE, s STRING, d DATE, b BOOLEAN, nothing DOUBLE")
    path = str(tmp_path / "sketches")
    P.store_sketches(P.batch_sketches(df.filter("i < 700"), F.lit("one")), path)
    P.store_sketches(P.batch_sketches(df.filter("i >= 700"), F.lit("two")), path)
    P.store_sketches(P.batch_sketches(df.filter("i < 1000"), F.lit("one")), path)  # comes again, with more rows
    P.store_sketches(P.batch_sketches(df.filter("i >= 1000"), F.lit("two")), path)
    merged = {r["column_name"]: r.asDict() for r in P.merged_profile(P.stored_sketches(spark, path)).collect()}
    whole = {r["column_name"]: r.asDict() for r in P.profile(df).collect()}
    assert list(merged) == list(whole) == df.columns
    known = [r[2] for r in data if r[2] is not None]
    for c, one in whole.items():
        for field in P.PROFILE_FIELDS:
            a, b = merged[c][field], one[field]
            if field in ("avg", "std") and a is not None:
                assert a == pytest.approx(b, rel=1e-9)
            elif field == "approx_unique":
                assert abs(a - b) <= 0.03 * b
            elif field not in P.QUANTILES:
                assert a == b, (c, field)
    assert (whole["big"]["min"], whole["big"]["max"]) == (str(2**60), str(2**60 + 3999))
    assert (whole["s"]["min"], whole["s"]["max"], whole["s"]["avg"], whole["s"]["q50"], whole["s"]["std"]) == ("a", "é", None, None, None)
    assert whole["nothing"]["null_percentage"] == 100 and whole["nothing"]["q50"] is None and whole["nothing"]["approx_unique"] == 0
    assert whole["x"]["std"] == pytest.approx(statistics.stdev(known)) and whole["x"]["null_percentage"] == round(100 - len(known) / 40, 2)
    ranks = [sum(v <= float(merged["x"][q]) for v in known) / len(known) for q in P.QUANTILES]
    assert ranks == pytest.approx([0.25, 0.5, 0.75], abs=0.01)
    assert merged["d"]["min"] == "2020-01-01" and merged["d"]["q50"][:4] == "2020"
    only = {r["column_name"]: r["count"] for r in P.merged_profile(P.stored_sketches(spark, path, ["two"])).collect()}
    assert set(only.values()) == {3000} and P.profile(df.limit(0)).collect() == []


def test_key_checks_share_one_exchange(spark):
    child = inline_relation(spark, [(i, i % 7, None if i % 5 == 0 else f"s{i % 9}", i % 3) for i in range(200)] + [(0, 99, "s1", 1)], "id INT, p INT, s STRING, t INT")
    parent = inline_relation(spark, [(i, f"s{i}") for i in range(7)] + [(3, "s3")], "key BIGINT, name STRING")
    checks = [
        Q.KeyCheck("id", child, ["id"]), Q.KeyCheck("p", child, ["p"], parent=parent, parent_column="key"), Q.KeyCheck("s", child, ["s"], parent=parent, parent_column="name"),
        Q.KeyCheck("id and s", child, ["id", "s"]), Q.KeyCheck("s and t", child, ["s", "t"]), Q.KeyCheck("key", parent, ["key"]), Q.KeyCheck("fine", child.limit(0), ["id"]),
    ]
    single = [Q.exact_key_violations(c).count() for c in checks]
    assert single == [1, 1, 2, 0, 12, 1, 0]
    assert [r.bad_rows for r in Q.run_checks([Q.RowCheck("row", child, F.col("s").isNull()), *checks])] == [40, *single]
    plan = Q.key_violations(checks)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(i#\d+, h1", plan)) == 1 and plan.count("Exchange hashpartitioning") == 2


def test_a_far_page_reads_the_files_that_hold_it(spark, tmp_path):
    rng = random.Random(5)
    data = [(i, rng.choice([None, rng.randrange(50)])) for i in range(5000)]
    df = inline_relation(spark, data, "id INT, v INT").repartition(6)
    table = G.write_for_paging(df, str(tmp_path / "t"), ["v", "id"], ["v"], part_rows=250)
    ordered = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    files = len(list((tmp_path / "t/rows").rglob("*.parquet")))
    for offset, rows_ in ((0, 10), (2490, 30), (4995, 10), (6000, 5), (0, 5000)):
        page = G.seek_page(table, offset, rows_)
        assert [tuple(r) for r in page.select("id", "v").collect()] == ordered[offset : offset + rows_]
        if rows_ < 100:
            plan = page._jdf.queryExecution().executedPlan().toString()
            read = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan, re.S)
            parts = set(re.findall(r"(?<![#\w])\d+", read[1])) if read else set()  # no page, no scan
            assert files >= 15 and len(parts) <= 2 and (parts or offset == 6000)


def test_distinct_values_are_counted_column_by_column(spark):
    from caselake.catalog.drills import _distinct_values

    rows = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "a")], "n int, `t.u` string")
    assert _distinct_values(rows, ["n", "t.u"]) == {"n_n": 2, "t.u_n": 2}
    assert _distinct_values(rows, []) == {}
