import pytest
from pyspark.sql import functions as F

from debtloom.llm.addresses import parse, same_place, same_place_pairs
from debtloom.llm.graph import connected_components
from debtloom.llm.history import BatchIndex, known_notices
from debtloom.llm.linkage import em_weights
from debtloom.llm.matching import match_entities
from debtloom.llm.vectors import BITS, RADIUS, bit_vector, hamming_cores, near_word_cores, piece_keys, place_keys, whole_keys
from debtloom.llm.names import parse_name
from debtloom.llm.companies import companies
from debtloom.llm.truth import CHANGE, claims, judged_rows, present_values, source_quality, true_values
from debtloom.functions.text import letter_bits
from debtloom.llm.variants import entities_of_names, may_be_near, near_words, similar_cores, variant_pairs


def test_letter_bits_rule_out_no_near_word(spark):
    import random

    random.seed(7)
    word = lambda: "".join(random.choice("aabceillmnorstz") for _ in range(random.randrange(2, 15)))
    def typo(w):
        for _ in range(random.randrange(5)):
            i = random.randrange(len(w) + 1)
            w = random.choice([w[:i] + w[i + 1 :], w[:i] + random.choice("abelé7") + w[i:], w[:i] + random.choice("abel") + w[i + 1 :], "".join(random.sample(w, len(w)))]) or "a"
        return w

    pairs = [(w, typo(w), False) for w in (word() for _ in range(3000))] + [(word(), word(), True) for _ in range(1000)]
    maybe = may_be_near(F.col("a"), F.col("b"), letter_bits(F.col("a")), letter_bits(F.col("b")))
    seen = spark.createDataFrame(pairs, "a string, b string, random boolean").select("random", near_words(F.col("a"), F.col("b")).alias("near"), maybe.alias("maybe")).collect()
    assert not [r for r in seen if r.near and not r.maybe] and sum(r.near for r in seen) > 500
    assert sum(r.maybe for r in seen if r.random) < 100


def test_components(spark):
    import random

    random.seed(5)
    links = [(random.randrange(60), random.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(12)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    want = {x: find(x) for x in root if any(x in p and p[0] != p[1] for p in links)}
    df = spark.createDataFrame([*links, (None, 1)], "a bigint, b bigint")
    assert {r.node: r.component for r in connected_components(df, "a", "b").collect()} == want
    assert connected_components(df.limit(0), "a", "b").count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Larkspur & Sons Timber Merchants Pty Ltd", ("company", "larkspur", "timber", "merchants")),
        ("TMBR. MCHTS (LARKSPUR &amp; SONS) P/L", ("company", "larkspur", "timber", "merchants")),
        ("LarkspurTimber", ("company", "larkspur", "timber", "")),
        ("The Larkspur T.M. Pty. Ltd. (In Liq)", ("company", "larkspur", "t", "m")),
        ("Larkspur Timebr - Port Mallow Branch", ("company", "larkspur", "timber", "")),
        ("Mrs Mallow, Deb Anne", ("person", "mallow", "deborah", "anne")),
        ("M. A. Mallow (sole trader)", ("person", "mallow", "m", "a")),
        ("City of Mallow", ("body", "mallow", "city", "")),
        (None, ("other", "", "", "")),
        ("", ("other", "", "", "")),
    ],
)
def test_names(text, want):
    assert tuple(parse_name(text)) == want


def test_names_of_any_length_are_parsed():
    import time

    began = time.process_time()
    for text in ("x" * 100_000, "ab " * 20_000, "(a" * 20_000, "a&b, " * 10_000, "timber" * 10_000):
        assert parse_name(text) is not None
    assert time.process_time() - began < 20


NAMES = ["Larkspur Timber Works Pty Ltd", "Larkspru Tmbr. Works P/L", "Larkspur Timber", "Larkspur Steel Pty Ltd", "Larkspur T.W. Pty Ltd", "Deborah Anne Mallow", "Mallow, Deb Anne", "Deborah Joy Mallow", "D. Mallow", "", None, " "]


def test_variants(spark):
    df = spark.createDataFrame([(n,) for n in NAMES + NAMES], "name string")
    got = {(r.name_a, r.name_b) for r in variant_pairs([(df, "name")]).collect()}
    timber = sorted(n for n in NAMES if n and "teel" not in n and n[0] == "L")
    assert got == {(a, b) for a in timber for b in timber if a < b} | {("Deborah Anne Mallow", "Mallow, Deb Anne")}
    assert variant_pairs([(df.limit(0), "name")]).count() == 0
    assert entities_of_names([(df, "name")]).count() == len({n for n in NAMES if n and n.strip()})


def test_trades_that_no_list_has_are_learnt(spark):
    import random

    from debtloom.llm.vocabulary import learn_words

    random.seed(8)
    syllables = ["bel", "dra", "fen", "gol", "hul", "jor", "kel", "mip", "nov", "pru", "qui", "ras", "tov", "wex", "yan", "zub"]
    rare = sorted({"".join(random.choices(syllables, k=3)) for _ in range(400)})[:150]
    trades, roles = {"apiary": "apry", "velodrome": "vldrm", "carillon": "crln", "observatory": "obsvty"}, ["ensemble", "assembly"]
    names = [f"{w.title()} {form} {role}" for i, w in enumerate(rare) for t in (list(trades)[i % 4], list(trades)[(i + 1) % 4]) for form in (t, trades[t]) for role in (roles[i % 2], "")]
    df = spark.createDataFrame([(" ".join(n.split()),) for n in names], "name string").distinct()
    learnt = {w: (kind, full) for w, kind, full in learn_words(df, "name")}
    assert {w: full for w, (_, full) in learnt.items()} == {**{t: t for t in trades}, **{a: t for t, a in trades.items()}, **{r: r for r in roles}}
    assert all(learnt[t][0] == "trade" for t in trades) and all(learnt[r][0] == "role" for r in roles)
    # Spellings of one name are put together, sisters in another trade are not.
    found = {r.name: r.entity for r in entities_of_names([(df, "name")]).collect()}
    w = rare[0].title()
    same = [f"{w} apiary ensemble", f"{w} apry ensemble", f"{w} apiary", f"{w} apry"]
    assert len({found[n] for n in same}) == 1 and found[f"{w} velodrome"] != found[same[0]]
    assert learn_words(df.limit(5), "name") == () == learn_words(df.limit(0), "name")


def cores(spark):
    import random

    random.seed(6)
    base = ["larkspurton", "mallowfield", "sorrelgate", "yarrowdale"]

    def typo(w):
        i = random.randrange(len(w))
        return random.choice([w[:i] + w[i + 1 :], w[:i] + random.choice("aeix") + w[i:], w[:i] + "x" + w[i + 1 :]])

    words = sorted({w for b in base for w in [b, *(typo(b) for _ in range(8)), *(typo(typo(b)) for _ in range(8))]})
    return spark.createDataFrame([(i, "company", w, h) for i, (w, h) in enumerate((w, h) for w in words for h in ("timber", "steel"))], "u bigint, family string, core string, head string")


def test_prefix_join_against_brute_force(spark):
    from debtloom.llm.variants import GRAM_SIMILARITY, near_words

    u = cores(spark)
    a, b = u.alias("a"), u.alias("b")
    near = a.join(b, (F.col("a.u") < F.col("b.u")) & (F.col("a.head") == F.col("b.head"))).where(near_words(F.col("a.core"), F.col("b.core"))).select("a.u", "a.core", F.col("b.u").alias("v"), F.col("b.core").alias("other")).collect()

    def jaccard(x, y):
        g = [{f"^{w}$"[i : i + 2] for i in range(len(w) + 1)} for w in (x, y)]
        return len(g[0] & g[1]) / len(g[0] | g[1])

    want = {(r.u, r.v) for r in near if jaccard(r.core, r.other) >= GRAM_SIMILARITY}
    got = {(r.a, r.b) for r in similar_cores(u).collect()}
    assert want <= got <= {(r.u, r.v) for r in near} and want


def test_multi_index_against_brute_force(spark):
    u = cores(spark).withColumn("v", bit_vector(F.col("core")))
    a, b = u.alias("a"), u.alias("b")
    bits = F.bit_count(F.col("a.v").bitwiseXOR(F.col("b.v")))
    ends = (F.substring("a.core", 1, 1) == F.substring("b.core", 1, 1)) | (F.substring("a.core", -1, 1) == F.substring("b.core", -1, 1))
    want = {tuple(r) for r in a.join(b, (F.col("a.u") < F.col("b.u")) & (F.col("a.head") == F.col("b.head")) & (bits <= RADIUS) & ends).select("a.u", "b.u").collect()}
    units = u.drop("v").withColumn("sought", F.lit(True))
    got = {(r.a, r.b) for r in hamming_cores(units).collect()}
    assert want <= got and want and BITS == 64
    # What is found beyond is equal but for both ends.
    words = {r.u: r.core for r in u.collect()}
    assert all(words[x][1:-1] == words[y][1:-1] for x, y in got - want)
    some = units.withColumn("sought", F.col("u") % 3 == 0)
    assert {(r.a, r.b) for r in hamming_cores(some).collect()} == {(x, y) for x, y in got if x % 3 == 0 or y % 3 == 0}


def test_near_words_from_short_lists(spark):
    """The pairs of the multi-index search that are near words, without lists that grow with all words of a trade."""
    import random

    from debtloom.llm.variants import near_words

    random.seed(11)
    letter = lambda: random.choice("aeinrst")

    def altered(w):
        for _ in range(random.randrange(1, 5)):
            i = random.randrange(len(w))
            w = random.choice([w[:i] + w[i + 1 :] or w, w[:i] + letter() + w[i:], w[:i] + letter() + w[i + 1 :], w[:i] + w[i + 1 : i + 2] + w[i : i + 1] + w[i + 2 :], w[-1] + w[1:-1] + w[0]])
        return w

    bases = ["".join(letter() for _ in range(n)) for n in range(1, 17) for _ in range(3)]
    words = sorted({w for b in bases for w in [b, *(altered(b) for _ in range(12))]})
    heads = ["steel", "steel", "glass", "s", "g", ""]
    units = spark.createDataFrame([(i, "company", w, random.choice(heads), i % 3 > 0) for i, w in enumerate(words)], "u bigint, family string, core string, head string, sought boolean").repartition(4).cache()
    near = near_words(F.col("x"), F.col("y"))
    want, got = ({(r.a, r.b) for r in search(units, near).collect()} for search in (hamming_cores, near_word_cores))
    assert got == want and len(want) > 300 and near_word_cores(units.limit(0), near).count() == 0
    # Of words that are not near, few share a key.
    plain = ["".join(random.choice("abcdefghijklmnoprstuwy") for _ in range(random.randrange(7, 13))) for _ in range(200)]
    shared = sum(bool((whole_keys(x) & whole_keys(y)) | (piece_keys(x) & place_keys(y))) for x in plain for y in plain if x != y)
    assert shared < 0.01 * len(plain) ** 2


def test_matches(spark):
    left = spark.createDataFrame([(1, "Larkspur Timber Pty Ltd", "123"), (2, "Larkspur Steel Pty Ltd", None), (3, None, "5"), (1, "Larkspur Timber Pty Ltd", "123")], "l int, n string, acn string")
    right = spark.createDataFrame([(10, "Larkspru Timber P/L"), (11, "Finch Foods"), (12, None), (13, "Timber Larkspur")], "r int, d string")
    alias = spark.createDataFrame([(11, "Finch Fds Pty Ltd")], "r int, o string")
    numbers = spark.createDataFrame([(13, "123"), (11, "123")], "r int, number string")
    got = {(x.l, x.r): x.confidence for x in match_entities(left, "l", "n", F.col("acn"), right, "r", "d", [(alias, "o", "org")], numbers, "number").collect()}
    assert set(got) == {(1, 10), (1, 13)} and all(0.5 <= c <= 1 for c in got.values())
    assert match_entities(left.limit(0), "l", "n", F.col("acn"), right, "r", "d", [(alias, "o", "org")], numbers, "number").count() == 0


def test_matches_by_what_the_lookups_lead_to(spark):
    left = spark.createDataFrame([(1, "Finch Foods Pty Ltd", None, "NSW"), (2, "Mallow Steel Pty Ltd", "123", "SA"), (3, "Mallow Stl P/L", None, "SA"), (4, "Yarrow Glass", "77", "WA"), (5, "Sorrel Tiles", "77", "WA"), (6, "Sorrel Tiles", "88", "WA")], "l int, n string, acn string, state string")
    right = spark.createDataFrame([(10, "Larkspur Timber Pty Ltd", "NSW"), (11, "LARKSPRU TIMBER", None), (12, "Bramble Marine", "SA"), (13, "Teasel Hire", "WA"), (14, "Clover Fuel", "QLD")], "r int, d string, state string")
    alias = spark.createDataFrame([(10, "Finch Fds P/L"), (14, "Ada Finch")], "r int, o string")
    numbers = spark.createDataFrame([(12, "123"), (13, "77")], "r int, number string")
    args = (left, "l", "n", F.col("acn"), right, "r", "d", [(alias, "o", "client")], numbers, "number")
    got = {(x.l, x.r): x.confidence for x in match_entities(*args, check=("state", "state")).collect()}
    # A name unlike the row's own, by an alias of any spelling of the row, and a number's company with all its rows.
    assert set(got) == {(1, 10), (1, 11), (2, 12), (3, 12), (4, 13)} and all(0.5 <= c <= 1 for c in got.values())
    # A route whose pairs never agree is not trusted.
    wrong = match_entities(left.withColumn("state", F.lit("TAS")), *args[1:], check=("state", "state"), least=0.0).collect()
    assert {(x.l, x.r) for x in wrong} >= set(got) and all(x.confidence < 0.5 for x in wrong if x.r == 13)


def test_names_in_custom_fields_lead_to_companies(spark, tmp_path):
    from debtloom.llm.queries import p2_found

    for name, rows, schema in [
        ("matter", [(1, "Finch Foods Pty Ltd", None, "NSW")], "matter_row bigint, company_name string, acn string, state string"),
        ("prospect", [(10, "Larkspur Timber", None, 5, None, "NSW"), (11, "Clover Fuel", "none", None, None, None)], "prospect_id bigint, display_name string, policylist_match string, pipedrive_org_id bigint, abn string, state string"),
        ("crm_org", [(5, "Larkspur Tmbr", ["www.larkspur.invalid", "Finch Fds P/L", "accounts@larkspur.invalid", None])], "org_id bigint, org_name string, custom_fields array<string>"),
        ("policy_list", [("P1", "x", "y")], "policy_no string, policy_name string, client_name string"),
    ]:
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert [tuple(r) for r in p2_found(spark, str(tmp_path)).collect()] == [(1, 10)]


PLACES = [
    "Level 41, 227 Larkspur Court, Mallow Park QLD 4375", "Lvl41/227 Larkspur Crt, Mallow Pk QLD", "LVL 41, NO. 227 LARKSPRU CT\nMALLOW PARK 4375", "41/227 Larkspur Ct, Mallow Park 4375 QLD AUST", "Mallow Pk QLD, C/- Registered Office, Level 41, 227 Larkspur Court",
    "227 Larkspur Court, Mallow Park QLD 4375", "Level 42, 227 Larkspur Court, Mallow Park QLD 4375", "Level 41, 227 Larkspur Lane, Mallow Park QLD 4375", "Level 41, 227A Larkspur Court, Mallow Park QLD 4375",
    "PO Box 120, North Finch VIC 3000", "P.O. BOX 120 NTH FINCH 3000", "PO Box 121, North Finch VIC 3000", "PO Box 120, South Finch VIC 3001", "no number", None, "", "   ",
    *[f"Level 41, 227 {s} Road, {t} QLD 4375" for s, t in (("Sorrel", "Yarrow"), ("Bramble", "Teasel"), ("Clover", "Sedge"))], *[f"PO Box 120, {t} VIC 3000" for t in ("Yarrow", "Teasel", "Sedge")],
]


def test_places(spark):
    df = spark.createDataFrame([(p,) for p in PLACES * 2], "address string")
    got = {(r.address_a, r.address_b) for r in same_place_pairs(df, "address").collect()}
    same = [sorted(PLACES[:5]), sorted(PLACES[9:11])]
    assert got == {(a, b) for s in same for a in s for b in s if a < b}
    assert same_place(df, "address").count() == 20
    assert same_place_pairs(df.limit(0), "address").count() == 0
    assert parse(None).number == "" and parse("x" * 50000).street == ""


def test_weights_know_matches_from_chance():
    patterns = [((4, 4), 900), ((4, 0), 40), ((0, 4), 60), ((0, 0), 5000), ((4, 1), 80)]
    base, (a, b) = em_weights(patterns, [{4: 0.9, 0: 0.1}, {4: 0.8, 1: 0.1, 0: 0.1}])
    assert base + a[4] + b[4] > 0 > base + a[0] + b[0] and a[4] > 0 > a[0] and b[4] > b[0]


def test_batches(spark):
    rows = [
        (1, 1, "N1-00", "Larkspur Timber Pty Ltd", "1", "Receiver", "2026-01-05"), (2, 1, "n1 00", "LARKSPUR TMBR P/L", None, "receiver", "5/1/2026"), (3, 2, None, "Larkspru Timber", None, "Receiver", "7 Jan 2026"),
        (4, 2, None, "Larkspur Steel", None, "Receiver", "2026-01-05"), (5, 3, None, "Larkspur Timber", "1", "Court Liquidation", "2026-05-05"), (6, 3, "N1-00", "Finch Foods", None, "Receiver", "2026-01-05"),
        (7, 4, None, "Larkspur Timber Pty Ltd", "ACN 1", "Court  Liquidation", "2026-05-05"), (8, 4, None, None, None, None, None), (9, 4, None, None, None, None, None), (None, 4, None, "x", None, None, None),
    ]
    df = spark.createDataFrame(rows, "arrival_id bigint, batch_no int, source_id string, company_name string, acn string, appointment_type string, appointment_date string").withColumn("key", F.lit("clash")).withColumn("day", F.lit(1))
    for each in (1, 2, 24):
        got = {(r.first_arrival_id, r.arrival_id) for r in known_notices(df, batches_a_round=each).collect()}
        assert got == {(1, 2), (1, 3), (5, 7)}, each
    assert known_notices(df.limit(0)).count() == 0


NOTICE = "arrival_id bigint, batch_no int, source_id string, company_name string, acn string, appointment_type string, appointment_date string"


def test_an_index_is_used_again(spark, tmp_path):
    first = spark.createDataFrame([(1, 1, None, "Larkspur Timber", None, "Receiver", "2026-01-05"), (3, 1, "N9", None, "0", "Receiver", "2026-01-05")], NOTICE)
    assert known_notices(first, BatchIndex(spark, str(tmp_path / "index"))).count() == 0
    later = spark.createDataFrame([(12, 2, None, "Larkspru Timber", None, "Receiver", "2026-01-05"), (13, 2, "n/9", "Finch Foods", None, "Receiver", "2026-01-06"), (14, 2, None, "Mallow Steel", "000", "Receiver", "2026-01-05")], NOTICE)
    # Another object on the same path, and a third one that sees the segments of both.
    assert {tuple(r) for r in known_notices(later, BatchIndex(spark, str(tmp_path / "index"))).collect()} == {(1, 12)}
    last = spark.createDataFrame([(21, 3, None, "Larkspr Timber", None, "Receiver", "2026-01-05"), (22, 3, "N9", "Finch Foods P/L", None, "Receiver", "2026-01-06")], NOTICE)
    index = BatchIndex(spark, str(tmp_path / "index"))
    assert {tuple(r) for r in known_notices(last, index).collect()} == {(1, 21), (3, 22)}
    assert index.segments("names") and sum(s[2] for s in index.segments("notices")) >= 6


def test_chains_of_notices_lead_to_the_first_however_they_are_batched(spark):
    names = ["larkspurton", "larkspurtin", "larksqurtin", "parksqurtin", "parksqurtix", "parxsqurtix"]
    rows = [(i + 1, i + 1, None, f"{n} Timber", None, "Receiver", "2026-01-05") for i, n in enumerate(names)]
    want = None
    for each in (1, 2, 6):
        got = {tuple(r) for r in known_notices(spark.createDataFrame(rows, NOTICE), batches_a_round=each).collect()}
        want = want or got
        assert got == want == {(1, i) for i in range(2, 7)}, each


def test_minwise_bands_find_words_half_alike():
    from debtloom.llm.history import minwise_bands

    assert set(minwise_bands("larkspurton")) & set(minwise_bands("larkspurtn")) and len(minwise_bands("")) == len(minwise_bands("x" * 5000))
    assert len(set(minwise_bands("larkspurton")) & set(minwise_bands("yarrowdale"))) <= 2


def weigh(said, quality=(0.85, 0.9)):
    """The probabilities of claims ``(day, value)`` of sources of one quality."""
    import math

    pos, neg = math.log(quality[0] / (1 - quality[1])), math.log((1 - quality[0]) / quality[1])
    steps = [(d, v, pos * sum(x == (d, v) for x in said), neg * sum(x == (d, v) for x in said)) for d, v in sorted(set(said))]
    return present_values(iter(steps), len({d for d, _ in said}), len({v for _, v in said}))


def brute_force(said, quality=(0.85, 0.9)):
    """The same by every value and every day of change."""
    import math

    days, values = sorted({d for d, _ in said}), sorted({v for _, v in said})
    if len(values) == 1:
        return {values[0]: 1.0}
    pos, neg = math.log(quality[0] / (1 - quality[1])), math.log((1 - quality[0]) / quality[1])
    of = lambda v, ds: sum(pos if x == v else neg for d, x in said if d in ds)
    share = CHANGE / max(1, len(days) - 1) / max(1, len(values) - 1)
    score = {v: (1 - CHANGE) * math.exp(of(v, days)) + sum(share * math.exp(of(v, days[k:]) + of(u, days[:k])) for k in range(1, len(days)) for u in values if u != v) for v in values}
    return {v: s / sum(score.values()) for v, s in score.items()}


def test_present_values():
    import random

    assert weigh([(1, "x"), (1, "x"), (5, "y"), (6, "y")])["y"] > 0.5  # what may change goes by the last ones
    assert weigh([(1, "x")]) == {"x": 1.0}
    random.seed(4)
    for _ in range(200):
        said = [(random.randrange(1, 6), random.choice("xyzw"[: random.randrange(1, 5)])) for _ in range(random.randrange(1, 9))]
        got, want = weigh(said), brute_force(said)
        assert got.keys() == want.keys() and all(abs(got[v] - want[v]) < 1e-9 for v in want), said


def test_truth(spark):
    rows = [("g", s, f"2026-01-0{d}", v) for s, d, v in [("a", 1, "x"), ("b", 2, "x"), ("c", 3, "y"), ("a", 4, None)]] + [("h", "a", None, "z")]
    df = spark.createDataFrame(rows, "g string, s string, d string, v string")
    c = claims(df, "g", "s", F.col("d").try_cast("date"), {"v": F.col("v")})
    assert {(r.g, r.value) for r in true_values(c, "g", []).collect()} == {("g", "x"), ("h", "z")}
    assert true_values(c.limit(0), "g", ["v"]).count() == 0
    # A source trusted elsewhere outweighs two that are mostly wrong.
    votes = [(f"t{i}", s, None, "x" if s in "pqr" else f"w{s}") for i in range(40) for s in "pqrlm"] + [("g", "p", None, "x"), ("g", "l", None, "y"), ("g", "m", None, "y")]
    trusted = claims(spark.createDataFrame(votes, "g string, s string, d string, v string"), "g", "s", F.col("d").try_cast("date"), {"v": F.col("v")})
    assert {r.value for r in true_values(trusted, "g").where("g = 'g'").collect()} == {"x"}


def test_fields_of_many_values_keep_all_that_are_true(spark):
    rows = [(f"g{i}", s, "2026-01-01", v) for i in range(6) for s in "abcdef" for v in ("x", "y")] + [("g0", "a", "2026-01-01", "w"), ("h", "a", None, "q")]
    df = spark.createDataFrame(rows, "g string, s string, d string, v string")
    many = true_values(claims(df, "g", "s", F.col("d").try_cast("date"), {"v": F.col("v")}), "g", many=["v"])
    got = {}
    for r in many.collect():
        got.setdefault(r.g, set()).add(r.value)
    assert got == {**{f"g{i}": {"x", "y"} for i in range(6)}, "h": {"q"}}
    # What a source leaves out counts against it: its sensitivity falls, its specificity stays.
    lists = [(f"g{i}", s, None, v) for i in range(30) for s in "abc" for v in ("x", "y") if s != "c" or v == "x"]
    quality = {r.source: r for r in source_quality(claims(spark.createDataFrame(lists, "g string, s string, d string, v string"), "g", "s", F.col("d").try_cast("date"), {"v": F.col("v")}), "g", many=["v"]).collect()}
    assert quality["a"].sensitivity > 0.9 and quality["c"].sensitivity < 0.7 and quality["c"].specificity >= 0.9


def test_names_that_keep_to_different_numbers_are_different_companies(spark):
    cols = "r int, n string, acn string"
    rows = [(1, "Larkspurton Timber Pty Ltd", "123456789"), (2, "Larkspurton Timber", "123456798"), (3, "Larkspurtn Timber", "123456789"), (4, "Larksdurton Timber Works", "555666777"), (5, "Larksdurton Timber", "555666777"), (6, "Larkspurton Timber", None), (7, None, "555666777"), (8, None, None), (9, "Larkspurton Tmbr", "555")]
    got = {r.r: r.company for r in companies(spark.createDataFrame(rows, cols), "r", "n", F.col("acn")).collect()}
    assert len(got) == 9 and got[1] == got[2] == got[3] == got[6] == got[9] and got[4] == got[5] == got[7] and len({got[1], got[4], got[8]}) == 3
    assert companies(spark.createDataFrame(rows, cols).limit(0), "r", "n", F.col("acn")).count() == 0


def test_judged_rows(spark):
    cols = "matter_row bigint, source string, company_name string, acn string, practitioner string, industry string, appointment_type string, last_checked string"
    rows = [
        (1, "asic", "Larkspur Timber Pty Ltd", "123456789", "Ada Finch", "Construction", "Receiver", "2026-01-01"), (2, "asic", "Larkspur Tmbr P/L", "123 456 789", "FINCH, ADA", "CONSTRUCTION", "receiver ", "2026-01-02"),
        (3, "notices", "Larkspur Timber", "123456798", "A. Finch", "n/a", "Court Liquidation", "2026-02-01"), (4, "notices", "Larkspur Timber", None, None, "Retail Trade", "Court Liquidation", "2026-03-01"),
        (5, "asic", "Larkspur Steel", "1", "Ben Yarrow", None, "Receiver", None), (6, None, None, None, None, None, None, None), (None, "asic", "x", "1", "y", "z", "t", "2026-01-01"),
    ]
    df = spark.createDataFrame(rows, cols).withColumn("company", F.lit("clash")).withColumn("value", F.lit(1))
    bad = {(r.matter_row, r.field_name) for r in judged_rows(df).where("value != true_value").collect()}
    assert bad == {(3, "acn"), (4, "industry"), (1, "appointment_type"), (2, "appointment_type")}
    assert judged_rows(df.limit(0)).count() == 0
