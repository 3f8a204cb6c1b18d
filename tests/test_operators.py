import os

import pytest
from pyspark.sql import functions as F
from test_functions import lcs

from debtloom.functions.listing import cell_rows, is_listing, line_rows, listing_rows, page_counts, parse_cells, tab_rows
from debtloom.functions.markup import asks_to_log_in, document_links, file_links, form_rows, headed_rows
from debtloom.operators.desk import filled, first_only, stale_feeds, unnoted
from debtloom.functions.markup import business_number, label_values, link_targets, table_rows
from debtloom.operators.name_match import _looked_up, _posted, key_list, longer_key, match_names, near_keys, org_identifiers, org_names
from debtloom.operators import rollup
from debtloom.operators.rollup import admissible, below_floor, cascade, qualify, ranked, roll_up, scored
from debtloom.plans import roll_queries
from debtloom.session import settle
from debtloom.operators.state import first_by, merge_state, open_rows, prune, replace_by_key, upsert

SF = "/root/testdata/sf0.001"


def test_roll_up(spark):
    rows = [(1, "Larkspur Ltd", "m1", 42000.0, True, False, "x"), (2, "LARKSPUR LIMITED", "m2", 18000.0, True, False, ""), (3, "Finch", "m1", 0.0, False, False, None), (4, "Finch", "m1", 9.0, True, True, "y"), (5, "The Co", "m1", 1.0, True, False, None)]
    df = spark.createDataFrame(rows, "creditor_id bigint, creditor_name string, matter_id string, amount_aud double, amount_known boolean, related_party boolean, debtor_industry string")
    got = {r.name_key: r for r in scored(roll_up(admissible(df), "creditor_id")).collect()}
    assert set(got) == {"larkspur", "finch"}
    assert (got["larkspur"].display_name, got["larkspur"].total_exposure_aud, got["larkspur"].matter_count, got["larkspur"].debtor_industries) == ("LARKSPUR LIMITED", 60000.0, 2, ["x"])
    assert (got["finch"].exposure_known, got["finch"].score) == (False, 0)
    judged = ranked(cascade(scored(roll_up(admissible(df), "creditor_id")), [below_floor(100000.0)])).collect()
    assert [(r.name_key, r.qualified) for r in judged] == [("finch", True), ("larkspur", False)]
    assert judged[1].disqualified_reason == "Exposure $60,000 is below $100,000"
    assert roll_up(admissible(df.limit(0)), "creditor_id").count() == 0


def test_state(spark):
    known = spark.createDataFrame([("a", "", 0, False, "d1"), ("b", "kept", 5, True, "d1")], "k string, s string, n int, f boolean, last_seen string")
    found = spark.createDataFrame([("a", "new", 7, True), ("b", "other", 6, False), ("c", "x", 1, None)], "k string, s string, n int, f boolean")
    got = {r.k: tuple(r)[1:] for r in merge_state(known, found, "k", F.lit("d2")).collect()}
    assert got == {"a": ("new", 7, True, "d2", False), "b": ("kept", 5, True, "d2", False), "c": ("x", 1, None, "d2", True)}
    again = merge_state(merge_state(known, found, "k", F.lit("d2")).drop("is_new"), found, "k", F.lit("d2")).drop("is_new")
    assert sorted(map(str, again.collect())) == sorted(map(str, merge_state(known, found, "k", F.lit("d2")).drop("is_new").collect()))
    old = spark.createDataFrame([("m1", 1), ("m2", 2), ("m3", 3)], "m string, v int")
    new = spark.createDataFrame([("m1", 9)], "m string, v int")
    touched = spark.createDataFrame([("m3",)], "m string")
    assert sorted(map(tuple, replace_by_key(old, new, "m", touched).collect())) == [("m1", 9), ("m2", 2)]
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, None)], "k string, o int, v string")
    assert sorted(map(tuple, first_by(rows, ["k"], [F.col("o")]).select("k", "v").collect())) == [("a", "y"), ("b", None)]
    states = spark.createDataFrame([(1, None, None, None), (2, True, "2026-01-01", None), (3, False, "2020-01-01", None), (4, False, "2026-06-01", "scanned"), (5, False, "2026-06-01", "ok")], "i int, captured boolean, seen string, status string")
    assert sorted(r.i for r in open_rows(states, "captured", F.col("seen").try_cast("date"), F.lit("2026-06-30").cast("date"), 120, "status", ("scanned",)).collect()) == [1, 5]
    k = spark.createDataFrame([("a", "n1", "up"), ("b", "n1", None)], "k string, n string, up string")
    q = spark.createDataFrame([("b", "n2"), ("c", "n3")], "k string, n string")
    assert sorted(map(tuple, prune(upsert(k, q, "k", ["n"]), F.col("up").isNotNull()).collect())) == [("a", "n1", "up", False), ("b", "n2", None, True), ("c", "n3", None, True)]


def test_near_keys_against_brute_force(spark):
    import random

    random.seed(3)
    base = ["larkspur timber works", "finch foods", "mallow steel supplies", "sorrel glass", "yarrow hire management"]
    def typo(t):
        i = random.randrange(len(t))
        return random.choice([t[:i] + t[i + 1 :], t[:i] + "x" + t[i:], t])

    left = sorted({typo(random.choice(base)) for _ in range(40)})
    right = sorted({typo(typo(random.choice(base))) for _ in range(40)})
    score = lambda a, b: (lambda x, y: 200 * lcs(x, y) / (len(x) + len(y)))(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    want = {(a, b) for a in left for b in right if score(a, b) >= 92}
    frame = lambda xs: spark.createDataFrame([(x,) for x in xs], "key string")
    assert {(r.key, r.candidate) for r in near_keys(frame(left), frame(right)).collect()} == want and want
    assert near_keys(frame([]), frame(right)).count() == 0


def test_near_keys_at_the_cutoff_with_few_lookups(spark):
    import random

    random.seed(5)
    frame = lambda xs: spark.createDataFrame([(x,) for x in xs], "key string")
    # 23 and 27 letters, 46 of 50 in common: 92 exactly.
    edge = [("draixaren cleaning supplies", "draixaren clng supplies"), ("joinery paimuworth brothers", "paimuworth bros joinery"), ("whegglait plmb services", "whegglait plumbing services")]
    for a, b in edge:
        assert [(r.key, r.candidate, r.score) for r in near_keys(frame([a]), frame([b])).collect()] == [(a, b, 92.0)]
    texts = sorted({"".join(random.choice("abc ") for _ in range(random.randrange(1, 34))).strip() for _ in range(40)} | {"a", "ab", "7 a", "é b"} - {""})
    def typo(t):
        for _ in range(random.randrange(5)):
            i = random.randrange(len(t) + 1)
            t = random.choice([t[:i] + t[i + 1 :], t[:i] + random.choice("abc 7é") + t[i:]]) or "a"
        return t

    others = sorted({typo(t) for t in texts for _ in range(4)})
    sort = lambda t: " ".join(sorted(w for w in t.split(" ") if w))
    score = lambda x, y: 200 * lcs(x, y) / (len(x) + len(y))
    want = {(a, b) for a in texts for b in others if sort(a) and sort(b) and score(sort(a), sort(b)) >= 92}
    assert {(r.key, r.candidate) for r in near_keys(frame(texts), frame(others)).collect()} == want and len(want) > 50
    long = "joinery paimuworth brothers"
    assert _posted(frame([long]).select(F.col("key").alias("t")), 92).count() < 12 and _looked_up(frame([long]).select(F.col("key").alias("s")), 92).count() < 80


def test_cascade_of_names(spark):
    policies = spark.createDataFrame([("1", "Larkspur Timber Pty Ltd", "Finch Foods"), ("2", "Mallow Steel Trading North", None), ("3", "larkspur timber", "Sorrel Glass One"), ("4", "Sorrel Glass Two", None)], "no string, a string, b string")
    listed = key_list(policies, ["a", "b"], ["no"])
    keys = spark.createDataFrame([("larkspur timber",), ("finch foodss",), ("mallow steel",), ("sorrel glass",), ("",)], "key string")
    got = {r.key: (r.original, r.rung) for r in match_names(keys, listed).collect()}
    assert got == {"larkspur timber": ("Larkspur Timber Pty Ltd", "exact"), "finch foodss": ("Finch Foods", "near"), "mallow steel": ("Mallow Steel Trading North", "longer")}
    assert {r.key for r in longer_key(keys, listed).collect()} == {"mallow steel"}


def test_names_are_read_once_for_all_rungs(spark, tmp_path):
    spark.createDataFrame([("larkspur timber",), ("finch foodss",)], "key string").write.parquet(f"{tmp_path}/keys")
    listed = key_list(spark.createDataFrame([("1", "Larkspur Timber", "Finch Foods")], "no string, a string, b string"), ["a", "b"], ["no"])
    found = match_names(spark.read.parquet(f"{tmp_path}/keys"), listed)
    assert not [f for f in found.inputFiles() if str(tmp_path) in f] and {r.rung for r in found.collect()} == {"exact", "near"}


def test_debts_are_rolled_up_once_for_the_cascade(spark, tmp_path):
    rows = [(1, "Larkspur Timber Pty Ltd", "m1", 9000.0, True, False, "x"), (2, "Finch Foodss", "m1", 9000.0, True, False, "x"), (3, "Mallow Steel", "m2", 10.0, True, False, "x"), (4, "Yarrow Hire", "m2", 9000.0, True, False, "x")]
    spark.createDataFrame(rows, "id bigint, creditor_name string, matter_id string, amount_aud double, amount_known boolean, related_party boolean, debtor_industry string").write.parquet(f"{tmp_path}/debts")
    listed = key_list(spark.createDataFrame([("1", "Larkspur Timber", "Finch Foods")], "no string, a string, b string"), ["a", "b"], ["no"])
    out = qualify(scored(roll_up(admissible(spark.read.parquet(f"{tmp_path}/debts")), "id")), 5000.0, (), listed)
    assert not [f for f in out.inputFiles() if str(tmp_path) in f]
    assert {r.name_key: r.disqualified_reason for r in out.collect()} == {"larkspur timber": "Client: Larkspur Timber", "finch foodss": "Individual", "mallow steel": "Exposure $10 is below $5,000", "yarrow hire": None}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["excluded_audit", "ranked_prospects"])
def test_reasons_read_no_debts_again(spark, name):
    assert not [f for f in getattr(roll_queries, name)(spark, SF).inputFiles() if "/creditor." in f]


def test_keys_are_made_once_and_clients_sought_last(spark, monkeypatch):
    rows = [(1, "Larkspur Timber Pty Ltd", "m1", 9000.0, True, False, "x"), (2, "Ada Finch", "m1", 9000.0, True, False, "x"), (3, "Mallow Steel", "m2", 10.0, True, False, "x"), (4, "The & Co", "m2", 9000.0, True, False, "x")]
    debts = spark.createDataFrame(rows, "id bigint, creditor_name string, matter_id string, amount_aud double, amount_known boolean, related_party boolean, debtor_industry string")
    keyed = admissible(debts)
    assert keyed._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
    listed = key_list(spark.createDataFrame([("1", "Larkspur Timber", "Ada Finch"), ("2", "Mallow Steel", "x")], "no string, a string, b string"), ["a", "b"], ["no"])
    sought = []
    monkeypatch.setattr(rollup, "match_names", lambda left, right: (sought.extend(r.key for r in left.collect()), match_names(left, right))[1])
    out = qualify(scored(roll_up(keyed, "id")), 5000.0, (), listed)
    assert {r.name_key: r.disqualified_reason for r in out.collect()} == {"larkspur timber": "Client: Larkspur Timber", "ada finch": "Individual", "mallow steel": "Exposure $10 is below $5,000"}
    assert sought == ["larkspur timber"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_ranked_rows_gather_no_industries(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(rollup, "settle", lambda df, label: (kept.extend(df.columns), settle(df, label))[1])
    assert roll_queries.ranked_prospects(spark, SF).count() == 100
    assert "score" in kept and "debtor_industries" not in kept


def test_organisations(spark):
    orgs = spark.createDataFrame([(1, "Larkspur Pty Ltd", ["12 345 678 901", "a@b.invalid", "Finch Foods"]), (2, "Finch Foods", None)], "org_id bigint, org_name string, custom_fields array<string>")
    assert [tuple(r) for r in org_identifiers(orgs).collect()] == [(1, "345678901")]
    assert {(r.key, r.org_id) for r in org_names(orgs).collect()} == {("larkspur", 1), ("finch foods", 1)}


def test_listings(spark):
    page = [
        "3", "B.", "List of creditors", "Name of creditor", "Related Party (Yes/No)", "ROCAP /", "Identified", "Amount", "Larkspur Timber C/-", "12 Mill Rd", "Northtown VIC", "2124", "No", "$0.00", "$1,250.00",
        "Report for Mallow Steel Pty Ltd", "No", "$5.00", "Finch Foods", "Yes", "stray", "TBC", "fees", "No", "$7.00", "in the amount of", "No", "$8.00", "Mallow", "No", "words", "words", "words", "words", "words",
    ]
    rows = [("Larkspur Timber C/-", "12 Mill Rd Northtown VIC", False, 1250.0, True), ("Report for Mallow Steel Pty Ltd", None, False, 5.0, True), ("Finch Foods", None, True, 0.0, False)]
    assert parse_cells(page)[:3] == rows and parse_cells([]) == parse_cells(["No", "$5.00"]) == parse_cells(["Yes"] * 3) == []
    pages = spark.createDataFrame([(1, "\n".join(page), "MALLOW STEEL"), (2, None, None), (3, "", "x"), (4, "Fees of $3.00\nno amount", None)], "p int, t string, d string").withColumn("row_no", F.lit("clash"))
    got = [(r.p, r.row_no, r.creditor_name, r.address, r.amount_aud, r.amount_known) for r in cell_rows(pages, "p", "t", "d").collect()]
    assert got == [(1, 0, "Larkspur Timber", "12 Mill Rd Northtown VIC", 1250.0, True), (1, 2, "Finch Foods", None, 0.0, False)]
    assert [r.creditor_name for r in cell_rows(pages, "p", "t").collect()] == ["Larkspur Timber", "Report for Mallow Steel Pty Ltd", "Finch Foods"]
    assert cell_rows(pages.limit(0), "p", "t").count() == line_rows(pages.limit(0), "p", "t").count() == 0
    counts = page_counts(F.coalesce("t", F.lit("")))
    assert [r[0] for r in pages.orderBy("p").select(is_listing(counts)).collect()] == [True, False, False, False]
    docs = spark.createDataFrame([(1, "Intro\nName\tAddress\tRelated Party\tAmount\nLarkspur\t1 Mill Rd\tNo\t$1,000.50\nFinch\t\tYes\tTBC\na\tb"), (2, None)], "d int, t string")
    got = [(r.creditor_name, r.address, r.related_party, float(r.amount_aud), r.amount_known) for r in tab_rows(docs, "d", "t").collect()]
    assert got == [("Larkspur", "1 Mill Rd", False, 1000.5, True), ("Finch", None, True, 0.0, False)]


def test_rows_on_one_line(spark):
    lines = [
        "Larkspur Timber Pty Ltd 12 Mill Rd Northtown VIC No 42,500.00", "Finch Foods  Yes | $1,000", "eFreight by Mallow 3/12 Quay St C/- 99.00", "Fees: 3,405.70", "Sorrel Tiles .......... 5,000.00", "Total 9,000.00",
        "the report of 10 September in the amount of $31,500.00", "A sentence that ends with an amount of 500.00", "Yarrow Glass 1234", "Bramble Steel Pty Ltd No 7.50", "word " * 20 + "5.00", "ab 1.00",
    ]
    pages = spark.createDataFrame([(1, "\r\n".join(lines), "Bramble Steel Limited"), (2, None, None)], "p int, t string, d string")
    got = [(r.creditor_name, r.address, r.related_party, r.amount_aud) for r in line_rows(pages, "p", "t", "d").orderBy("row_no").collect()]
    assert got == [("Larkspur Timber Pty Ltd", "12 Mill Rd Northtown VIC", False, 42500.0), ("Finch Foods", None, True, 1000.0), ("eFreight by Mallow", "3/12 Quay St C/", False, 99.0)]


def test_the_layout_of_a_page_is_the_one_that_gives_rows(spark):
    cells, rows, prose = "List of creditors\nLarkspur\nNo\n$5.00\nFinch\nYes\nTBC", "Schedule of debts and claims\nLarkspur No 500.00\nFinch Yes 600.00", "List of creditors\nThey owe 500.00"
    pages = spark.createDataFrame([(1, cells), (2, rows), (3, prose), (4, None)], "p int, t string")
    assert sorted((r.p, r.layout, r.creditor_name) for r in listing_rows(pages, "p", "t").collect()) == [(1, "cells", "Finch"), (1, "cells", "Larkspur"), (2, "lines", "Finch"), (2, "lines", "Larkspur")]


def test_register_pages(spark):
    html = "<table><tr><td>x</td></tr></table><table><tr><th>Company</th><th>ACN</th><th>Name of firm</th></tr><tr><td>A &amp; B <a href='/n/1'>i</a></td><td></td><td>Q</td></tr><tr><td> </td><td>1</td></tr></table>"
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<table><tr><th>Date</th></tr><tr><td>1</td></tr></table>")], "p int, h string")
    got = headed_rows(pages, "p", "h", (("company", "company_name"), ("name", "company_name"), ("acn", "acn")), "company_name").collect()
    assert [(r.p, r.company_name, r.acn, r.href) for r in got] == [(1, "A & B i", None, "/n/1"), ]
    links = spark.createDataFrame([(1, f"<a href='/FileInformation/{'a' * 32}'></a><a href='/fileinformation/{'A' * 32}'>One</a><a href='/x/{'b' * 32}'>No</a><a href='/d/r.pdf?x=1'>First Advice</a><a href='/d/s.PDF'>Minutes</a>"), (2, None)], "p int, h string")
    assert [tuple(r) for r in file_links(links, "p", "h", "fileinformation").collect()] == [("a" * 32, "One", 1)]
    assert [(r.name, r["rank"]) for r in document_links(links, "p", "h", ("initial", "first advice")).orderBy("rank").collect()] == [("First Advice", 1), ("Minutes", 2)]
    forms = spark.createDataFrame([(1, "<table><tr><td>15604</td><td>123456789</td></tr><tr><td>Form 5604</td><td>no 0123456789</td><td>1/2/2026</td></tr></table>"), (2, "<p>5604</p>")], "p int, h string")
    assert [(r.p, r.doc_number, str(r.lodged)) for r in form_rows(forms, "p", "h", "5604").collect()] == [(1, "0123456789", "2026-02-01")]
    assert [r[0] for r in spark.createDataFrame([("LOG IN <b>Forgot your password</b>",), ("log",), (None,)], "h string").select(asks_to_log_in(F.col("h"))).collect()] == [True, False, False]


def test_desk(spark):
    first = spark.createDataFrame([("a", "", "x"), ("b", "1", None)], "k string, acn string, industry string")
    panel = spark.createDataFrame([("a", "12 3", "y"), ("b", "9", "z"), ("c", "1", "1")], "k string, acn string, industry string")
    assert {tuple(r) for r in filled(first, panel, "k", ["acn", "industry"]).collect()} == {("a", "000000123", "x"), ("b", "1", "z")}
    notes = spark.createDataFrame([(1, 5, ["A", "B"]), (2, 5, ["A"]), (3, 6, ["A"])], "p int, org int, debtors array<string>")
    there = spark.createDataFrame([(5, "[m] A only"), (6, "A without a mark")], "org int, content string")
    assert {r.p for r in unnoted(notes, there, "org", "debtors", "[m]").collect()} == {1, 3}
    assert first_only(first, "series", F.lit(False)).count() == 2 and first_only(first, "acn", F.col("acn") == "1").count() == 1
    feed = spark.createDataFrame([("s", "2026-01-01"), ("t", None)], "source string, d string")
    got = {r.source: (r.lag_days, r.stale) for r in stale_feeds(feed, "source", F.col("d").try_cast("date"), F.lit("2026-03-02").cast("date"), 30).collect()}
    assert got == {"s": (60, True), "t": (None, False)}


def test_markup(spark):
    html = "<title>ABN 51 824 753 556 | Larkspur</title><p><b>Company:</b> A &amp; B</p><p>State: VIC</p><a href='/x.pdf'>x</a><table><tr><th>H</th></tr><tr><td>a <i>b</i></td><td>c</td></tr></table>"
    df = spark.createDataFrame([(1, html), (2, None)], "p int, h string")
    got = df.orderBy("p").select(link_targets(F.col("h")), business_number(F.col("h")), label_values(F.col("h"), ["Company", "State"])).collect()
    assert got[0][0] == ["/x.pdf"] and got[0][1] == "51824753556" and got[0][2]["Company"] == "A & B"
    assert got[1][0] is None and got[1][1] is None
    assert [(r.p, r.row_no, r.cells) for r in table_rows(df, "p", "h").collect()] == [(1, 0, ["H"]), (1, 1, ["a b", "c"])]
