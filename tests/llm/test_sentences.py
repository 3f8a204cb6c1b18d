import pytest

from debtloom.llm.sentences import lattice_words, sentence_units, sentences

CASES = [
    ["Dr. T. Finch of Larkspur read it at 5 a.m. in Port Mallow.", "The vote was tied!", "Nobody came?!", "Rent accrues at 5.5% p.a. until paid."],
    ["Notice was sent to Larkspur Timber Pty. Ltd.", "The landlord changed the locks.", "The office moved to 54 Mallow St.", "A copy is kept at files.larkspur.invalid for members only."],
    ["A proof must reach No. 38 Mallow St. Saint Finch by 2:15 p.m. on 19 March 2024.", "See cl. 5.2 and s. 56A, cf. the note in app. B.", "2024 was a year of losses.", "23 employees left in Dec. 2024."],
    ['"Nobody told us. The trucks were gone," Ada Finch told the meeting.', 'Ben Larkspur asked: "Where did it go?"', "The minutes record a pause.", 'He told Ada, "Wait until Monday," and left.'],
    ["The forklift ... was sold twice; the rest was kept.", "Books (see p. 5. and on) are closed.", "eFreight by Mallow billed $1,790.56 of hire."],
    ["Die Verwalterin wurde am 2. April 2026 eingesetzt.", "Nach Abs. 58 Nr. 59 gilt z. B. der Vorbehalt.", "Das Lager ist leer."],
    ["« La banque a refusé. Tout s'est arrêté », a dit Ada Finch.", "Selon l'art. 38 et la p. 23 du rapport, M. Larkspur reste débiteur.", "Un seul créancier s'est opposé."],
    ["¿Cómo siguió Larkspur comprando a crédito?", "El Sr. Finch abrió la junta a las 16:30.", "¡Un solo acreedor votó en contra!"],
]


@pytest.mark.parametrize("units", CASES)
def test_spaced_scripts(units):
    text = " ".join(units)
    assert [text[a:b] for a, b in sentences(text)] == units
    wrapped = text.replace(" ", "\n")
    assert [wrapped[a:b].replace("\n", " ") for a, b in sentences(wrapped)] == units


def units(text):
    return [text[a:b] for a, b in sentences(text)]


def test_other_scripts():
    assert units("预计分配率为28.5%。账簿不完整……审计仍在进行。“银行不肯等。车都没了！”Ada Finch说。完成了！") == ["预计分配率为28.5%。", "账簿不完整……审计仍在进行。", "“银行不肯等。车都没了！”Ada Finch说。", "完成了！"]
    assert units("「もう終わりだ。」とAdaは述べた。配当率は40.5%である。") == ["「もう終わりだ。」とAdaは述べた。", "配当率は40.5%である。"]
    assert units("कुल 5 लेनदारों का शेष है। डॉ. N. Finch ने बैठक की!") == ["कुल 5 लेनदारों का शेष है।", "डॉ. N. Finch ने बैठक की!"]
    assert units("ترأس د. Ada الاجتماع؛ ثم غادر. لماذا؟ أُغلق المستودع!") == ["ترأس د. Ada الاجتماع؛ ثم غادر.", "لماذا؟", "أُغلق المستودع!"]
    assert units("คลังสินค้าที่ Port Finch ถูกขายแล้ว โปรดส่งเอกสารถึง Larkspur Recovery ภายใน 43 วัน เจ้าหนี้ทั้งหมดมี 11 ราย") == ["คลังสินค้าที่ Port Finch ถูกขายแล้ว", "โปรดส่งเอกสารถึง Larkspur Recovery ภายใน 43 วัน", "เจ้าหนี้ทั้งหมดมี 11 ราย"]
    assert units("เรียน เจ้าหนี้") == ["เรียน เจ้าหนี้"] and "".join(lattice_words("เจ้าหนี้ทั้งหมดมี")) == "เจ้าหนี้ทั้งหมดมี"


def test_paragraphs_and_listings():
    assert units("22. Assets\n\nDear Dr. Finch,\n \nAll was\nsold.It is over. \r\n\r\nEnd") == ["22. Assets", "Dear Dr. Finch,", "All was\nsold.", "It is over.", "End"]
    assert units("Rows follow.\nName\tAmount\nA. B. Co\t$1.50\nThat is all. Bye.") == ["Rows follow.", "Name\tAmount", "A. B. Co\t$1.50", "That is all.", "Bye."]
    assert units("") == units(" \n\n ") == [] and units("....") == ["...."]


def test_units_cover_the_text_and_long_texts_are_whole(spark):
    long = "The vote was tied. " * 20000 + "😀 End.".encode("utf-16", "surrogatepass").decode("utf-16")
    df = spark.createDataFrame([(1, long), (2, None), (3, ""), (1, "One. Two"), (None, "x")], "doc_id bigint, text string").withColumnRenamed("doc_id", "start_char")
    rows = sentence_units(df.withColumnRenamed("start_char", "doc_id"), "doc_id", "text").collect()
    assert len(rows) == 20001 + 2 and all(r.doc_id == 1 for r in rows)
    ends = max(r.end_char for r in rows)
    assert ends == len(long)
    text = "A b. C d!  E\n\nF"
    assert "".join(text[a:b] for a, b in sentences(text)).replace(" ", "") == "".join(text.split())


def test_the_best_path_leaves_no_quotation_open():
    assert units('He said "No. It is late." We left. The 5" pipe broke. It leaked.') == ['He said "No. It is late."', "We left.", 'The 5" pipe broke.', "It leaked."]
    assert units("(See p. 5. It is long.) We left. A stray ( bracket. It stays.") == ["(See p. 5. It is long.) We left.", "A stray ( bracket.", "It stays."]
    assert units("“One. Two. The end. “Three.” Four.")[-1] == "Four."


def test_time_grows_with_the_text():
    import time

    def took(n, piece):
        began = time.process_time()
        assert list(sentences(piece * n))
        return time.process_time() - began

    for piece in ('He said "no. ', "( a. B ", "« a. B ", '" ' , "A. ( B. ) \" C. \" "):
        assert took(8000, piece) < 20 * max(took(1000, piece), 0.02), piece


def test_other_spaceless_scripts():
    assert units("ບໍລິສັດປິດແລ້ວ ກະລຸນາສົ່ງເອກະສານ") == ["ບໍລິສັດປິດແລ້ວ", "ກະລຸນາສົ່ງເອກະສານ"]
    assert units("ကုမ္ပဏီပိတ်ခဲ့သည် ဘဏ်ကပြောသည်။ သူလာမည်။") == ["ကုမ္ပဏီပိတ်ခဲ့သည်", "ဘဏ်ကပြောသည်။", "သူလာမည်။"]
    assert units("ក្រុមហ៊ុនបិទហើយ សូមផ្ញើឯកសារ។") == ["ក្រុមហ៊ុនបិទហើយ", "សូមផ្ញើឯកសារ។"]
