import datetime as dt
import hashlib
import itertools

from pyspark.sql import functions as F

from debtloom.functions.canon import acn_canon, date_canon, present, type_canon
from debtloom.functions.people import is_person
from debtloom.functions.text import (
    abn_print, abn_valid, absolute_url, acn_or_null, cut_address, distinctive, exposure_score, file_stem, header_key, html_text, local_gate, looks_like_name, name_key, short_id, token_sort_ratio, trailing_amount, truthy,
)


def one(spark, values, f):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").orderBy("i").select(f(F.col("v"))).collect()]


def test_name_key(spark):
    got = one(spark, ["Larkspur & Finch Pty. Ltd.", "LARKSPUR AND FINCH LIMITED", "The Company Pty Ltd", None, ""], name_key)
    assert got == ["larkspur finch", "larkspur finch", "", "", ""]
    assert one(spark, got, name_key) == got  # doing it twice changes nothing


def test_identifiers(spark):
    assert one(spark, ["25712", "612 000 001", "1234567890", "", None, "ACN 1"], acn_or_null) == ["000025712", "612000001", None, None, None, "000000001"]
    assert one(spark, ["82173001", "1234567890", "-"], acn_canon) == ["082173001", "1234567890", None]
    # The number's checksum: the first digit less one, weights 10, 1, 3 ... 19.
    def valid(n):
        d = [int(c) for c in n]
        d[0] -= 1
        return len(d) == 11 and sum(a * b for a, b in zip(d, (10, 1, 3, 5, 7, 9, 11, 13, 15, 17, 19))) % 89 == 0

    numbers = [str(10_000_000_000 + 7 * i) for i in range(300)]
    assert one(spark, numbers, abn_valid) == [valid(n) for n in numbers] and any(map(valid, numbers))
    assert one(spark, ["123", None, "abc"], abn_valid) == [False] * 3
    assert one(spark, ["12345678901", "5"], abn_print) == ["12 345 678 901", "5"]
    assert one(spark, ["x"], lambda c: short_id(F.lit("asic"), c)) == [hashlib.sha256(b"asic|x").hexdigest()[:16]]


def test_dates(spark):
    day = dt.date(2026, 9, 1)
    assert one(spark, ["1/9/2026", "2026-09-01", "1 Sep 2026", "01-09-2026", "2026-09-01 00:00:00", " 1 September 2026 "], date_canon) == [day] * 6
    assert one(spark, ["not a date", "", None, "31/2/2026", "2026-13-01"], date_canon) == [None] * 5


def test_folding(spark):
    assert one(spark, ["Creditors' Voluntary", "CREDITORS’ VOLUNTARY", "creditors  voluntary ", " "], type_canon) == ["creditorsvoluntary"] * 3 + [None]
    assert one(spark, ["n/a", " Unknown ", "x  y", None], present) == [None, None, "x y", None]
    assert one(spark, ["ACN\nNo ", "Period (Year month)"], header_key) == ["acn no", "period year month"]
    assert one(spark, ["1", "1.0", "Y", "yes", "TRUE", "0", None, "no"], truthy) == [True] * 5 + [False] * 3


def test_scores_and_shapes(spark):
    rows = spark.createDataFrame([(1, 100000.0, True), (2, 60000.0, True), (1, 0.0, False), (10, 5e7, True), (1, 0.0, True)], "m int, e double, k boolean")
    assert [r[0] for r in rows.select(exposure_score(F.col("m"), F.col("e"), F.col("k"))).collect()] == [50, 72, 0, 100, 0]
    assert one(spark, ["studio", "larkspurco", "123456789", "ab cd efgh"], distinctive) == [False, True, False, True]
    assert [float(x) if x is not None else None for x in one(spark, ["Fees 3,405.70", "in 2024", "x $1,250,000", "y 12.5"], trailing_amount)] == [3405.70, None, 1250000.0, None]
    assert one(spark, ["Name", "3M", "eFreight", "lower", ""], looks_like_name) == [True, True, True, False, False]
    cut = spark.createDataFrame([("Larkspur Timber Pty Ltd 12 Mill Rd Northtown",), ("No Number Here",)], "v string")
    name, address = cut_address(F.col("v"))
    assert [tuple(r) for r in cut.select(name, address).collect()] == [("Larkspur Timber Pty Ltd", "12 Mill Rd Northtown"), ("No Number Here", None)]
    assert one(spark, ["inbox/abc__list.pdf", "abc.pdf"], file_stem) == ["abc", "abc"]
    assert one(spark, ["<p>A&amp;B<script>x</script> <b>C</b></p>"], html_text) == ["A&B C"]
    assert one(spark, ["/x.pdf", "https://a.invalid/y", "z.pdf"], lambda c: absolute_url(F.lit("https://h.invalid/d/e"), c)) == ["https://h.invalid/x.pdf", "https://a.invalid/y", "https://h.invalid/d/z.pdf"]


def test_weekly_gate(spark):
    times = ["2026-09-28 01:51:00", "2026-09-27 23:00:00", "2026-09-29 02:00:00"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t string").orderBy("i").select(local_gate(F.col("t").cast("timestamp"), "Australia/Adelaide", 1, 10, F.lit(None).cast("date"))).collect()]
    assert got == [True, False, False]


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_token_sort_ratio_against_brute_force(spark):
    words = ["larkspur finch", "finch larkspurr", "abc", "", "timber larkspur co", "finch  larkspur"]
    pairs = list(itertools.product(words, words))
    got = [r[0] for r in spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string").orderBy("i").select(token_sort_ratio(F.col("a"), F.col("b"))).collect()]
    for (a, b), g in zip(pairs, got):
        x, y = (" ".join(sorted(t.split())) for t in (a, b))
        assert abs(g - (100.0 if not x + y else 200 * lcs(x, y) / (len(x) + len(y)))) < 1e-9


def test_people(spark):
    names = ["Ada Larkspur", "A. B. Larkspur", "Mr Finch", "Ada Larkspur and Ben Finch", "Larkspur Timber", "LARKSPUR FINCH", "Ada & Co", "Ada 2", "Ada", "", None]
    assert one(spark, names, is_person) == [True, True, True, True, False, False, False, False, False, False, False]
