import random

from debtloom.llm.leaks import LeakFinder, WuManber, folded, leaks

ITEM = "Judge how far 87,711 dollars of unpaid canoe repairs weaken the lien that the bookbinder asserts against Moldener. Name the register that would settle the quarrel over the turbine in Wunteville."


def test_all_occurrences_against_brute_force():
    random.seed(2)
    text = "".join(random.choice("abc") for _ in range(3000))
    patterns = [text[i : i + 9] for i in random.sample(range(2900), 40)] + ["ccccccccc", "abcabcabc"]
    for block in (2, 4, 7):
        got = sorted(WuManber(patterns, 9, block).occurrences(text))
        assert got == sorted((i + 9, k) for k, p in enumerate(patterns) for i in range(len(text) - 8) if text.startswith(p, i))


def test_copies(spark):
    half = ITEM.split(". ")[0] + "."
    docs = [
        (1, "Intro. " + ITEM.upper().replace(" ", "\n") + " End"), (2, "x " + half.replace("the", "this").replace(",", "") + " y"), (3, ITEM[:30]), (4, None), (5, ""), (1, "again " + ITEM),
        (6, "Filler words only. " * 3000 + ITEM + " more" * 3000), (7, half.replace(" lien", " lien. Other words stand here, and")),
    ]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumnRenamed("text", "text")
    e = spark.createDataFrame([(9, ITEM), (9, ITEM), (10, None), (11, "..."), (12, "")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): round(r.share, 2) for r in leaks(d, "doc_id", "text", e, "item_id", "text").collect()}
    assert set(got) == {(1, 9), (2, 9), (6, 9), (7, 9)} and got[1, 9] == got[6, 9] == 1.0
    assert leaks(d.limit(0), "doc_id", "text", e, "item_id", "text").count() == 0
    assert leaks(d, "doc_id", "text", e.limit(0), "item_id", "text").count() == 0
    blocks = leaks(d, "doc_id", "text", e.unionByName(spark.createDataFrame([(13, "Other passage about a lantern in Gridlanard, quite long enough to count.")], "item_id bigint, text string")), "item_id", "text", block_chars=50)
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == set(got)


def test_sign_script():
    item = "设想一家叫Charthot的灯笼作坊在9月停止付款，仓里还有17,924件货。排列两人在92,427元财产中的先后。"
    f = LeakFinder([(1, item)])
    assert [i for _, i, s in f.shares(["前文。" + item.replace("的", "") + "后文", "无关的文字。" * 50]) if s > 0.9] == [0]
    assert folded("The  Cat, of MATS!") == "catmats"
