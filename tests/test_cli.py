import datetime as dt

from debtloom.cli import due, main
from debtloom.sources.files import sheets_of


def test_commands(spark, tmp_path):
    t = tmp_path / "t"
    c = "creditor_id bigint, creditor_name string, matter_id string, amount_aud double, amount_known boolean, related_party boolean, debtor_industry string"
    spark.createDataFrame([(1, "Larkspur Ltd", "m1", 9000.0, True, False, "x"), (2, "Finch", "m2", 10.0, True, False, None)], c).write.parquet(f"{t}/creditor.parquet")
    m = "matter_row bigint, matter_id string, source string, company_name string, acn string, appointment_type string, appointment_date string, practitioner string, industry string, state string, postcode string, last_seen string, first_seen string, last_checked string, creditors_captured boolean, document_status string"
    spark.createDataFrame([(1, "m1", "asic", "Mallow", "", "Receiver", None, None, None, None, None, None, "2026-06-01", None, False, None)], m).write.parquet(f"{t}/matter.parquet")
    b = "arrival_id bigint, source string, company_name string, acn string, appointment_type string, appointment_date string, practitioner string, state string, postcode string"
    spark.createDataFrame([(1, "asic", "Sorrel", "5", "Receiver", None, None, None, None)], b).write.parquet(f"{t}/matter_batch.parquet")
    page = "\n".join(["List of creditors", "Yarrow Hire", "1 Mill Rd", "No", "$50.00", "Teasel", "Yes", "TBC"])
    spark.createDataFrame([("m1", 1, page), ("m9", 1, None)], "matter_id string, page int, text string").write.parquet(f"{t}/pages.parquet")
    assert main(["report", "--tables", str(t), "--out", f"{tmp_path}/r.xlsx"]) == 0
    book = sheets_of((tmp_path / "r.xlsx").read_bytes())
    assert list(book) == ["Prospects", "Repeat Exposure", "Purchase Queue", "Excluded", "Matters"] and book["Prospects"][1][1] == "Larkspur Ltd"
    (tmp_path / "rules.yml").write_text("trade:\n  reason: Own trade\n  patterns: [larkspur]\n")
    spark.createDataFrame([("1", "Finch", None)], "policy_no string, policy_name string, client_name string").write.parquet(f"{t}/policies.parquet")
    assert main(["report", "--tables", str(t), "--out", f"{tmp_path}/q.xlsx", "--rules", f"{tmp_path}/rules.yml", "--policylist", f"{t}/policies.parquet", "--floor", "5"]) == 0
    assert [(r[0], r[3]) for r in sheets_of((tmp_path / "q.xlsx").read_bytes())["Excluded"][1:]] == [("Finch", "Client: Finch"), ("Larkspur Ltd", "Own trade")]
    assert main(["collect", "--tables", str(t), "--sources", "asic", "--out", f"{tmp_path}/c", "--as-of", "2026-06-30"]) == 0
    assert spark.read.parquet(f"{tmp_path}/c").where("is_new").count() == 1
    assert main(["watch", "--tables", str(t), "--as-of", "2026-06-30", "--out", f"{tmp_path}/w"]) == 0
    assert spark.read.parquet(f"{tmp_path}/w").count() == 1
    assert main(["ingest", "--tables", str(t), "--inbox", f"{t}/pages.parquet", "--out", f"{tmp_path}/i"]) == 0
    assert sorted(r[0] for r in spark.read.parquet(f"{tmp_path}/i").select("creditor_name").collect()) == ["Finch", "Teasel", "Yarrow Hire"]
    assert main(["ingest", "--tables", str(t)]) == 1 and main(["report", "--tables", str(tmp_path / "none")]) == 1


def test_due(tmp_path):
    marker = tmp_path / "m"
    monday = dt.datetime(2026, 9, 28, 11)
    assert due(str(marker), monday) and not due(str(marker), monday.replace(hour=9)) and not due(str(marker), monday.replace(day=29))
    marker.write_text("2026-09-28")
    assert not due(str(marker), monday)
