"""Sentence boundaries across languages and scripts."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Abbreviations after which a sentence never ends.
NEVER = frozenset(
    "dr mr mrs ms mx prof rev hon jr sr messrs cf vs viz approx incl excl esp ca etal eg ie ph tel ext ref fig figs vol nos para paras cl ss art arts sec secs app pp ed eds "
    "sra srta dña núm pág págs aprox mme mlle mm env réf abs nr tel az hr fr frl str bzw zzgl inkl exkl ggf evtl vgl bspw zb dh sog st ste mt pty डॉ श्री رقم".split()
)
#: Abbreviations before a number only.
BEFORE_NUMBER = frozenset("no nr nos jan feb mar apr jun jul aug sep sept oct nov dec jän mär mai okt dez janv févr avr juil déc ene abr ago dic p pp s ss cl art".split())
#: Words after which a lone capital letter is a label and may end a sentence.
LABELS = frozenset("app appendix annexure annex schedule section part plan exhibit item anhang anlage annexe anexo".split())
#: Month names after the ordinal of a day.
MONTHS = frozenset(
    "januar februar märz april mai juni juli august september oktober november dezember jänner jan feb mär apr jun jul aug sep okt nov dez".split()
)
#: Words that open a sentence when capitalised.
OPENERS = frozenset(
    "the a an this that these those we our it its he she they there his her their i you your my no not nothing nobody none some several many most all each every both few one two three four "
    "in on at by for from to with under after before since when while where why how what who which if although because however but and so yet thus then also please kindly see compare is are was were "
    "did do does has have had will would should can could may der die das ein eine er sie es wir ihr ihre sein nach bei im am zum zur wenn als da dass warum wie wer was wo kein keine nicht "
    "le la les un une des il elle ils elles nous vous ce cette ces comment pourquoi selon el los las una según cómo por".split()
)


class Lexicon(NamedTuple):
    """Words of a spaceless script: that open a sentence, that close one, that leave one open, that carry one on, and others that a lattice needs."""

    opening: tuple[str, ...]
    final: tuple[str, ...]
    leading: tuple[str, ...]
    carrying: tuple[str, ...]
    other: tuple[str, ...] = ()


#: Words of everyday and business prose by script; a lattice needs the closed classes above all, open ones may stay unknown.
LEXICONS = {
    "thai": Lexicon(
        tuple(
            "โปรด กรุณา บริษัท คุณ นาย นาง นางสาว ท่าน ผม ฉัน ดิฉัน เธอ มัน เรา พวกเรา เขา พวกเขา คลังสินค้า โรงงาน อัตรา เจ้าหนี้ ลูกหนี้ เหตุใด ทำไม ใคร ผู้ชำระบัญชี ผู้จัดการทรัพย์ ผู้จัดการ ผู้สอบบัญชี ผู้ถือหุ้น กรรมการ "
            "ศาล ธนาคาร รัฐบาล สำนักงาน การ ความ รายงาน เอกสาร หนี้ สินค้า อย่างไรก็ตาม นอกจากนี้ ดังนั้น เพราะฉะนั้น เนื่องจาก ต่อมา จากนั้น ขณะนี้ ปัจจุบัน วันนี้ เมื่อวานนี้ ในที่สุด ทั้งนี้ อีกทั้ง สุดท้าย ประการแรก".split()
        ),
        tuple("แล้ว ราย วัน อยู่ ประชุม คนงาน ผู้ขาย ครับ ค่ะ คะ จ้ะ นะ ล่ะ สิ ด้วย เลย ปี เดือน บาท คน แห่ง ฉบับ เท่านั้น เช่นกัน ต่อไป เป็นต้น ไหม หรือไม่ หรือเปล่า".split()),
        tuple("เรียน ที่ ถึง ของ เมื่อ และ หรือ แก่ ภายใน ประมาณ มี เป็น โดย กับ ให้ จาก ใน แต่ ว่า คือ เพื่อ ซึ่ง อัน ตาม ต่อ ตั้งแต่ จนถึง ระหว่าง สำหรับ เกี่ยวกับ รวมถึง เช่น".split()),
        tuple("ถูก จึง ได้รับ ได้ แต่งตั้ง ยัง กู้เงิน สั่งซื้อ ขาย ปิด จ่าย คืน คาด จะ ส่ง ค้าง ชำระ ทั้งหมด ค้างชำระ ความเป็นมา ทรัพย์สิน ทรัพย์ ไม่ เคย กำลัง ควร ต้อง อาจ สามารถ ย่อม ก็ คง".split()),
        tuple("นี้ นั้น โน้น ทุก แต่ละ บาง หลาย มาก น้อย กว่า ที่สุด ครั้ง ก่อน หลัง ขึ้น ลง เข้า ออก ไป มา ทำ พบ เห็น ขอ รับ ใช้ เปิด เริ่ม สิ้นสุด เงิน ราคา มูลค่า สัญญา งาน เวลา พนักงาน ลูกค้า บัญชี จำนวน".split()),
    ),
    "lao": Lexicon(
        tuple("ກະລຸນາ ບໍລິສັດ ທ່ານ ຂ້ອຍ ຂ້າພະເຈົ້າ ເຮົາ ພວກເຮົາ ເຂົາ ເພິ່ນ ລາວ ທະນາຄານ ສານ ລັດຖະບານ ເຈົ້າໜີ້ ລູກໜີ້ ດັ່ງນັ້ນ ນອກຈາກນັ້ນ ເນື່ອງຈາກ ປັດຈຸບັນ ມື້ນີ້ ການ ຄວາມ ເປັນຫຍັງ".split()),
        tuple("ແລ້ວ ຢູ່ ເດີ ບໍ ເນາະ ດ້ວຍ ເລີຍ ປີ ເດືອນ ວັນ ຄົນ ກີບ ເທົ່ານັ້ນ".split()),
        tuple("ທີ່ ຂອງ ແລະ ຫຼື ໃນ ຈາກ ຫາ ໃຫ້ ແກ່ ກັບ ໂດຍ ເປັນ ມີ ແຕ່ ວ່າ ເພື່ອ ຊຶ່ງ ຕາມ ເຖິງ".split()),
        tuple("ຖືກ ຈຶ່ງ ໄດ້ ຈະ ຍັງ ບໍ່ ເຄີຍ ກຳລັງ ຄວນ ຕ້ອງ ອາດ ກໍ".split()),
    ),
    "khmer": Lexicon(
        tuple("សូម ក្រុមហ៊ុន លោក អ្នក ខ្ញុំ យើង គាត់ ពួកគេ ធនាគារ តុលាការ រដ្ឋាភិបាល ម្ចាស់បំណុល ដូច្នេះ ដោយសារ បច្ចុប្បន្ន ថ្ងៃនេះ ការ ហេតុអ្វី".split()),
        tuple("ហើយ ទេ ផង ណា ឆ្នាំ ខែ ថ្ងៃ នាក់ រៀល ប៉ុណ្ណោះ".split()),
        tuple("ដែល របស់ និង ឬ ក្នុង ពី ទៅ ឱ្យ ជាមួយ ដោយ ជា មាន ប៉ុន្តែ ថា ដើម្បី តាម ដល់".split()),
        tuple("ត្រូវ បាន នឹង នៅ មិន ធ្លាប់ កំពុង គួរ អាច ក៏".split()),
    ),
    "burmese": Lexicon(
        tuple("ကျွန်တော် ကျွန်မ သူ သူတို့ ကျွန်ုပ်တို့ ကုမ္ပဏီ ဘဏ် တရားရုံး အစိုးရ မြီရှင် ထို့ကြောင့် သို့သော် ယနေ့ ယခု ဦး ဒေါ် ဘာကြောင့်".split()),
        tuple("သည် တယ် မည် မယ် ပါ ပြီ ၏ ဘူး လား နော် ခဲ့သည် ပါသည် ပါတယ်".split()),
        tuple("နှင့် သို့ မှ တွင် ၌ ကို အတွက် ဖြင့် သော နဲ့ ရဲ့".split()),
        tuple("လည်း ကား သာ ပင်".split()),
    ),
}
_BLOCKS = {"thai": "\u0e01-\u0e5b", "lao": "\u0e81-\u0edf", "khmer": "\u1780-\u17dd", "burmese": "\u1000-\u109f"}
_KNOWN = {name: {w for kind in lexicon for w in kind} for name, lexicon in LEXICONS.items()}
_LONGEST = {name: max(map(len, words)) for name, words in _KNOWN.items()}

_BLANK = re.compile(r"(?:\r\n|[\n\r\x0b\x0c\x85 ])[^\S\n\r\x0b\x0c\x85 ]*(?:\r\n|[\n\r\x0b\x0c\x85 ])\s*| \s*")
_LINE = re.compile(r"\r\n|[\n\r\x0b\x0c\x85 ]")
_MARK = re.compile(r"[.!?。！？｡؟۔।॥။។…‽]+|[\"“”„‟«»「」『』()（）\[\]]")
_STRONG = frozenset("。！？｡؟۔।॥။។")
_NUMBERED = re.compile(r"\(?\d{1,3}[.、．)）][\s　]*")
_EDGES = "\"“”„«»「」『』()（）[]"
#: Abbreviations that may end a sentence.
_ENDABLE = frozenset("ltd co inc rd ave st a.m p.m p.a etc usf usw".split())
_WORD = re.compile(r"[^\W\d_]+")
_CLOSERS = {"“": "”", "„": "“”", "‟": "”", "«": "»", "「": "」", "『": "』", '"': '"', "»": "«"}
_OPENING = frozenset("\"“„«「『¿¡(（[")
_INTRODUCED = re.compile(r"[^ \t\r\n\-–—]")
_SPACELESS = "".join(_BLOCKS.values())
_HAS_SPACELESS = re.compile(f"[{_SPACELESS}]")
_GAP = re.compile(rf"\s+(?=[{_SPACELESS}])")
_RUN, _RUN_END = re.compile(f"[{_SPACELESS}]+"), re.compile(f"[{_SPACELESS}]+$")
_SCRIPT = {name: re.compile(f"[{block}]") for name, block in _BLOCKS.items()}
#: What it costs to go against the evidence at a mark, to take a quotation sign that could be one for a mere sign, and to leave a quotation open.
AGAINST, LITERAL, LEFT_OPEN = 4, 3, 50


def script_of(run: str) -> str:
    """The spaceless script of a run, by its first letter."""
    return next((name for name, letters in _SCRIPT.items() if letters.match(run)), "thai")


@lru_cache(maxsize=20_000)
def lattice_words(run: str) -> tuple[str, ...]:
    """The cheapest path through the lattice of dictionary words over an unspaced run; letters outside it cost more."""
    script = script_of(run)
    known, longest = _KNOWN[script], _LONGEST[script]
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(run) + 1):
        choice = (best[end - 1][0] + 2.0, end - 1)
        for start in range(max(0, end - longest), end):
            if run[start:end] in known and best[start][0] + 1.0 <= choice[0]:
                choice = (best[start][0] + 1.0, start)
        best.append(choice)
    out: list[str] = []
    end = len(run)
    while end:
        out.append(run[best[end][1] : end])
        end = best[end][1]
    out.reverse()
    return tuple(out)


@lru_cache(maxsize=20_000)
def _gap_ends(before: str, after: str) -> bool:
    """Whether a gap before the run ``after`` parts two sentences; ``before`` is the run before it, or empty."""
    words = LEXICONS[script_of(after)]
    following = lattice_words(after)[0]
    last = lattice_words(before)[-1] if before else ""
    if last in words.leading or following in words.carrying or following in words.leading[1:]:
        return False
    if following in words.opening or following == words.leading[0] == "เรียน":
        return True
    return last in words.final


def _opens(text: str, at: int, end: int) -> str:
    """How what stands at ``at`` could begin a sentence: ``opener``, ``yes`` or empty."""
    c = text[at]
    if c.islower():
        return "yes" if at + 1 < end and text[at + 1].isupper() else ""
    if c.isalpha():
        word = _WORD.match(text, at, end)
        return "opener" if word and word[0].lower() in OPENERS else "yes"
    if c in _OPENING:
        nxt = at + 1
        while nxt < end and (text[nxt].isspace() or text[nxt] in _OPENING):
            nxt += 1
        return "yes" if nxt < end and not text[nxt].islower() or c in "¿¡" else ""
    if c.isdigit():
        return "digit"
    # Other symbols (So: emoji, arrows, ticks) stand before words, not inside a sentence's run of text.
    return "yes" if unicodedata.category(c) in ("Sc", "So") else ""


def _caseless(text: str, a: int, end: int) -> bool:
    """Whether a stretch of some length has letters, and none of them large."""
    part = text[a:end].strip()
    return len(part) > 20 and part[0].islower() and part.islower()


def _after_full_stop(text: str, a: int, dot: int, end: int) -> bool:
    """Whether the full stop at ``dot`` ends a sentence that began at ``a``; text follows it up to ``end``."""
    at = dot + 1
    spaced = text[at].isspace()
    while at < end and text[at].isspace():
        at += 1
    if at >= end:
        return True
    near = text[max(a, dot - 40) : dot]
    token = "" if not near or near[-1].isspace() or near[-1] in _EDGES else near.split()[-1].lstrip(_EDGES)
    if spaced and text[at].isupper() and token.islower() and token.isalpha() and len(token) > 1 and token not in NEVER and token not in BEFORE_NUMBER:
        return True
    if not spaced:
        c = text[at]
        if not (c.isupper() or c in "“„«「¿¡\"" or "぀" <= c <= "鿿" or (c.islower() and at + 1 < end and text[at + 1].isupper())):
            return False
        if not token:
            return text[dot - 1] in ")]）”»\""
        core = token.rsplit("/", 1)[-1]
        if "." in core and core.lower() not in ("a.m", "p.m", "p.a"):
            last = core.rsplit(".", 1)[-1]
            return bool(re.fullmatch(r"[$€£]?[\d.,]+%?|[a-z]{4,}", core)) and not re.match(r"[a-z-]+\.[a-z-]+$", core) or (last.isdigit() and c.isupper())
        word = _WORD.match(text, at, end)
        tail = core.lower()
        if tail in NEVER or (len(core) == 1 and core.isalpha()):
            return False
        if tail in ("ltd", "co", "inc", "rd", "ave", "etc"):
            return _opens(text, at, end) == "opener"
        if word and len(word[0]) == 1 and word[0].lower() not in OPENERS and text[at + 1 : at + 2] == ".":
            return core[-1].islower() or core[-1].isdigit()
        return core[-1].islower() or core[-1].isdigit() or core[-1] in "%€$"
    how = _opens(text, at, end)
    if not how:
        # Text all in lower case has no other sign than its full stops.
        return token.isalpha() and token.islower() and len(token) > 2 and token not in NEVER and token not in BEFORE_NUMBER and token not in _ENDABLE and text[at].isalpha() and _caseless(text, a, dot)
    if not token:
        return True
    if text[at].isalpha() and not text[at].isupper() and how == "yes" and not text[at].islower() and (token.lower() in _ENDABLE or _HAS_SPACELESS.match(text[at])):
        return False
    core = token.lstrip("'‘’—–-/$€£")
    if "'" in core or "’" in core:
        core = re.split("['’]", core)[-1]
    low = core.lower()
    if low in NEVER:
        return low == "st" and not re.search(r"\bNo\.\s+\d+\w?\s+\S+\s+$", text[max(a, dot - 60) : dot - 2]) and how != "digit" and bool(re.search(r"\d\w?\s+(?:\S+\s+){1,2}$", text[max(a, dot - 60) : dot - 2]))
    if low in BEFORE_NUMBER and (how == "digit" or re.match(r"[A-Z]{1,2}[.\d/]", text[at : at + 4])):
        return False
    if "." in core:
        if low in ("i.e", "e.g", "z.b", "d.h", "u.a", "p.ej", "c.-à-d"):
            return False
        last = core.rsplit(".", 1)[-1]
        if len(last) == 1 and last.isupper() and re.fullmatch(r"(?:[A-Z]\.)+[A-Z]", core):
            return how == "opener"
        return True
    if len(core) == 1 and core.isalpha():
        before = re.search(r"([^\W\d_]+)[.]?\s+$", text[max(a, dot - 16) : dot - 1])
        return bool(core.isupper() and before and before[1].lower() in LABELS)
    if core.isdigit() and len(core) <= 2:
        word = _WORD.match(text, at, end)
        if word and word[0].lower() in MONTHS:
            return False
    return True


def _opens_after(text: str, at: int, end: int) -> bool:
    while at < end and text[at].isspace():
        at += 1
    return at >= end or bool(_opens(text, at, end))


def _depths(marks: list[re.Match]) -> list[int]:
    """How many brackets are open before each mark; a bracket counts only with its counterpart."""
    pairs = {")": "(", "]": "[", "）": "（"}
    stack: list[int] = []
    change = [0] * (len(marks) + 1)
    for i, m in enumerate(marks):
        c = m[0][0]
        if c in "([（":
            stack.append(i)
        elif c in pairs:
            at = next((k for k in range(len(stack) - 1, max(-1, len(stack) - 9), -1) if marks[stack[k]][0][0] == pairs[c]), None)
            if at is not None:
                change[stack[at] + 1] += 1
                change[i] -= 1
                del stack[at:]
    out, depth = [], 0
    for i in range(len(marks)):
        depth += change[i]
        out.append(depth)
    return out


def _ends_at(text: str, start: int, m: re.Match, end: int) -> bool:
    """Whether the evidence on both sides of a terminator speaks for an end of the sentence that began at ``start``."""
    mark, at, after = m[0], m.start(), m.end()
    if not _STRONG.isdisjoint(mark):
        return True
    if mark == ".." and text[max(start, at - 3) : at].lower() == "ltd" and _opens_after(text, after, end):
        return True
    if mark[0] == "…" or (len(mark) > 1 and not mark.strip(".…")):
        return False
    if "!" in mark or "?" in mark or "‽" in mark:
        nxt = _skip(text, after, end)
        return nxt >= end or bool(_opens(text, nxt, end)) or not (text[nxt].islower() and not _caseless(text, start, at) or text[nxt] in ",;:)…-–—")
    return _after_full_stop(text, start, at, end)


def _ends_after_quote(text: str, at: int, after: int, end: int, introduced: bool) -> bool:
    """Whether a sentence ends with the quotation that is closed at ``at``: it has its own end, and what follows is no speaker."""
    k = at
    while k > 0 and text[k - 1].isspace():
        k -= 1
    inner = text[k - 1] if k else ""
    nxt = _skip(text, after, end)
    if inner not in (".", "!", "?", "。", "！", "？", "｡", "؟", "।") or nxt >= end:
        return False
    how = _opens(text, nxt, end)
    cased = text[nxt].isupper() or text[nxt].islower()
    return bool((introduced and how) or (not introduced and (how == "opener" or text[nxt] in "\"“„«「"))) and not (not cased and text[nxt] == "と")


def _skip(text: str, at: int, end: int) -> int:
    while at < end and text[at].isspace():
        at += 1
    return at


def _cuts(text: str, a: int, end: int, marks: list[re.Match]) -> list[int]:
    """Where the sentences end, by the best path through the lattice of terminators.

    A node is a mark with the quotation that is open there, if any. From each mark go two arcs, one that ends a sentence and one that doesn't; the one
    against the evidence costs. A quotation sign opens a quotation or stands for itself; no path may leave a quotation open. Brackets hold no ends. The
    nodes of a mark are no more than there are kinds of quotations, so the work grows with the number of marks.
    """
    depths = _depths(marks)
    last = {q: text.rfind(q, a, end) for q in set("".join(_CLOSERS.values()))} if any(m[0][0] in _CLOSERS for m in marks) else {}
    # By open quotation (its closing signs): cost, start of the sentence, whether words introduce the quotation, the ends so far (a linked list).
    nodes: dict[str, tuple[int, int, bool, tuple | None]] = {"": (0, a, False, None)}
    for m, depth in zip(marks, depths):
        c, at, after = m[0][0], m.start(), m.end()
        reached: dict[str, tuple[int, int, bool, tuple | None]] = {}

        def arc(state: str, cost: int, start: int, introduced: bool, cuts: tuple | None, reached=reached) -> None:
            if state not in reached or cost < reached[state][0]:
                reached[state] = (cost, start, introduced, cuts)

        def part(cost: int, start: int, cuts: tuple | None, ends: bool, after=after) -> None:
            arc("", cost + (0 if ends else AGAINST), after, False, (after, cuts))
            arc("", cost + (AGAINST if ends else 0), start, False, cuts)

        for state, (cost, start, introduced, cuts) in nodes.items():
            if state and c not in state:
                arc(state, cost, start, introduced, cuts)
            elif state:
                if after < end and depth == 0:
                    part(cost, start, cuts, _ends_after_quote(text, at, after, end, introduced))
                else:
                    arc("", cost, start, False, cuts)
            elif c in _CLOSERS:
                closers = _CLOSERS[c]
                could = any(last[q] >= after for q in closers)
                if could:
                    arc(closers, cost, start, _INTRODUCED.search(text, start, at) is not None, cuts)
                arc("", cost + (LITERAL if could else 0), start, False, cuts)
            elif c in "([（)]）”‟»」』" or after >= end or depth:
                arc("", cost, start, False, cuts)
            else:
                part(cost, start, cuts, _ends_at(text, start, m, end))
        nodes = reached
    _, cuts = min(((cost + (LEFT_OPEN if state else 0), cuts) for state, (cost, _, _, cuts) in nodes.items()), key=lambda x: x[0])
    out: list[int] = []
    while cuts:
        out.append(cuts[0])
        cuts = cuts[1]
    out.reverse()
    return out


def _prose(text: str, a: int, end: int) -> Iterator[tuple[int, int]]:
    """The sentences of a stretch without blank lines and listings."""
    a = _skip(text, a, end)
    while end > a and text[end - 1].isspace():
        end -= 1
    if a >= end:
        return
    numbered = _NUMBERED.match(text, a, end)
    marks = list(_MARK.finditer(text, numbered.end() if numbered else a, end))
    spaceless = _HAS_SPACELESS.search(text, a, end) is not None
    if not spaceless and (not marks or (len(marks) == 1 and marks[0].end() == end)):
        yield a, end
        return
    cuts = _cuts(text, a, end, marks)
    if spaceless:
        for m in _GAP.finditer(text, a, end):
            before = _RUN_END.search(text, max(a, m.start() - 60), m.start())
            if _gap_ends(before[0] if before else "", _RUN.match(text, m.end(), end)[0]):
                cuts.append(m.start())
        cuts = sorted(set(cuts))
    for cut in [*cuts, end]:
        stop = cut
        while stop > a and text[stop - 1].isspace():
            stop -= 1
        a = _skip(text, a, stop)
        if a < stop:
            yield a, stop
        a = cut


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """``(start, end)`` in code points of each unit, without white space at either end."""
    a = 0
    while a < len(text):
        blank = _BLANK.search(text, a)
        end = blank.start() if blank else len(text)
        if text.find("\t", a, end) < 0:
            yield from _prose(text, a, end)
        else:
            at = pending = a
            while at <= end:
                line = _LINE.search(text, at, end)
                stop = line.start() if line else end
                cells = text[at:stop].strip(" ")
                if "\t" in cells:
                    yield from _prose(text, pending, at)
                    s, e = at, stop
                    while s < e and text[s].isspace():
                        s += 1
                    while e > s and text[e - 1].isspace():
                        e -= 1
                    if s < e:
                        yield s, e
                    pending = line.end() if line else end
                if not line:
                    break
                at = line.end()
            yield from _prose(text, pending, end)
        if not blank:
            return
        a = blank.end()


def sentence_units(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, start_char, end_char``: the sentences of every document, offsets in code points, end exclusive.

    Blank lines end a unit; lines of cells parted by tabs are one unit each; a heading's number, a quotation with the words
    that name its speaker, abbreviations, decimals and ellipses stay whole. Spaced scripts, and spaceless ones with full stops, are parted by the best
    path through a lattice of terminators. Runs of a spaceless script without full stops (Thai, Lao, Khmer, Burmese) are parted into words by a
    lattice over a dictionary, and each gap is judged by final particles before and opening words behind it.

    Documents stream through once; nothing is shuffled. Defined cases: null, empty and blank texts have no units; a text of any
    length is taken whole; rows are not merged, so a document given twice has its units twice.
    """
    docs = documents.select(documents[doc_id].alias("__d"), documents[text].alias("__t")).where("__d is not null and length(__t) > 0")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, ends = [], [], []
            for row, body in enumerate(batch.column(1).to_pylist()):
                for a, b in sentences(body):
                    rows.append(row)
                    starts.append(a)
                    ends.append(b)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.array(rows, np.int64))), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["d", "s", "e"])

    kind = docs.schema["__d"].dataType.simpleString()
    out = docs.mapInArrow(run, f"d {kind}, s bigint, e bigint")
    return out.toDF(doc_id, "start_char", "end_char")
