"""Scalar functions over text, all as Columns that stay in the JVM."""

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from debtloom.functions.canon import digits, squeeze

#: Words without meaning in a company's key.
KEY_STOP_WORDS = ("pty", "ltd", "limited", "proprietary", "inc", "incorporated", "nl", "co", "company", "holdings", "group", "australia", "aust", "the", "and")
#: Weights of the eleven digits of a business number, and its modulus.
ABN_WEIGHTS, ABN_MODULUS = (10, 1, 3, 5, 7, 9, 11, 13, 15, 17, 19), 89


def chars(c: Column) -> Column:
    """The characters of a text."""
    return F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))


def name_key(c: Column) -> Column:
    """The key under which spellings of a company meet: lower case, ``&`` as and, ASCII letters and digits, no legal words."""
    # In one pass: what parts words, with the legal words behind it. An ampersand parts words and is a legal word itself.
    parted = rf"[^a-z0-9]++(?:(?:{'|'.join(KEY_STOP_WORDS)})[^a-z0-9]++)*+"
    return F.coalesce(F.trim(F.regexp_replace(F.concat(F.lit(" "), F.lower(c), F.lit(" ")), parted, " ")), F.lit(""))


def short_id(*parts: Column) -> Column:
    """Sixteen hex digits of a hash of the parts."""
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)


def matter_key(source: Column, acn: Column, company: Column) -> Column:
    """A matter's id: its source with the ACN, or with the company's key where there is none."""
    return short_id(source, F.coalesce(F.nullif(acn, F.lit("")), name_key(company)))


def header_key(c: Column) -> Column:
    """A column heading without case, line breaks, punctuation and doubled spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "), " +", " "))


def truthy(c: Column) -> Column:
    """Whether a flag cell says yes."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("1", "1.0", "y", "yes", "true"), F.lit(False))


def acn_or_null(c: Column) -> Column:
    """Nine digits, zero-padded; null for none or more than nine."""
    d = digits(c)
    return F.when(F.length(d) <= 9, F.lpad(d, 9, "0"))


def abn_valid(c: Column) -> Column:
    """The checksum of a business number: the first digit less one, weighed, divisible by the modulus."""
    d = digits(c)
    weighed = F.aggregate(
        F.zip_with(F.transform(chars(d), lambda x: x.try_cast("int")), F.lit(list(ABN_WEIGHTS)), lambda x, w: x * w), F.lit(-ABN_WEIGHTS[0]), lambda acc, x: acc + x
    )
    return F.coalesce(F.when(F.length(d) == 11, weighed % ABN_MODULUS == 0), F.lit(False))


def abn_print(c: Column) -> Column:
    """Eleven digits in groups of 2, 3, 3, 3; anything else as it is."""
    d = digits(c)
    return F.when(F.length(d) == 11, F.regexp_replace(d, r"^(\d{2})(\d{3})(\d{3})(\d{3})$", "$1 $2 $3 $4")).otherwise(c)


def identifier(c: Column) -> Column:
    """The digits of a 9- or 11-digit identifier, else empty."""
    d = F.coalesce(digits(c), F.lit(""))
    return F.when(F.length(d).isin(9, 11), d).otherwise("")


def distinctive(key: Column) -> Column:
    """Whether a key says enough to match by its beginning: nine characters, not a lone number."""
    return (F.length(key) >= 9) & ~key.rlike("^[0-9]+$")


def token_sort(c: Column) -> Column:
    """The words of a text in alphabetical order."""
    return F.array_join(F.array_sort(F.filter(F.split(c, " "), lambda w: w != "")), " ")


def letter_bits(text: Column) -> Column:
    """The letters of a text as bits, one for the first and one for the second of each, beside a third of the ten most frequent: an edit changes one bit at most."""
    out, at = F.lit(0).cast("bigint"), 0
    for c in "abcdefghijklmnopqrstuvwxyz":
        width = 3 if c in "aeilnorstd" else 2
        seen = F.least(F.length(text) - F.length(F.replace(text, F.lit(c), F.lit(""))), F.lit(width))
        out = out.bitwiseOR(F.call_function("shiftleft", F.call_function("shiftleft", F.lit(1).cast("bigint"), seen) - 1, F.lit(at)))
        at += width
    return out


def longest_common(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table as the bits of one number."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    whole = (1 << len(a)) - 1
    row = whole
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & whole
    return len(a) - row.bit_count()


def common_subsequence(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, in Arrow batches; null where either text is."""

    @F.arrow_udf("int")
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([None if s is None or t is None else longest_common(s, t) for s, t in zip(x.to_pylist(), y.to_pylist())], pa.int32())

    return run(a, b)


def ratio(a: Column, b: Column) -> Column:
    """Twice the common subsequence over both lengths, times 100; 100 for two empty texts."""
    both = F.length(a) + F.length(b)
    return F.when(both == 0, 100.0).otherwise(200.0 * common_subsequence(a, b) / both)


def token_sort_ratio(a: Column, b: Column) -> Column:
    """``ratio`` of the texts with their words in alphabetical order."""
    return ratio(token_sort(a), token_sort(b))


def trailing_amount(c: Column) -> Column:
    """The amount at the end of a line, if it has thousands separators or two decimals; else null."""
    found = F.regexp_extract(c, r"\$?\s*(\d{1,3}(?:,\d{3})+(?:\.\d{2})?|\d+\.\d{2})\s*$", 1)
    return F.replace(F.nullif(found, F.lit("")), F.lit(","), F.lit("")).try_cast("decimal(18,2)")


def looks_like_name(c: Column) -> Column:
    """Whether a cell starts as names do: a capital, a digit, or a small letter run into a capital."""
    return c.rlike(r"^(\p{Lu}|\p{Nd}|[a-z]+[A-Z])")


def cut_address(c: Column) -> tuple[Column, Column]:
    """A name and the street address behind it, cut before the first number that a capital follows, if that is past the fourth character."""
    at = F.regexp_instr(c, F.lit(r"\s(?=\d+[/\-]?\d*\s+[A-Z])"))
    found = at > 4
    return F.when(found, F.trim(F.substring(c, F.lit(1), at - 1))).otherwise(c), F.when(found, F.trim(F.substring(c, at, F.length(c))))


def file_stem(c: Column) -> Column:
    """The part of a file's name before a double underscore or its extension."""
    return F.split_part(F.regexp_replace(F.regexp_extract(c, "([^/]*)$", 1), r"\.[^.]*$", ""), F.lit("__"), F.lit(1))


def safe_file_name(c: Column) -> Column:
    """Letters, digits, spaces, dots, dashes and underscores, trimmed, sixty characters."""
    return F.substring(F.trim(F.regexp_replace(c, r"[^A-Za-z0-9 ._-]", "")), 1, 60)


def search_url(base: Column, term: Column) -> Column:
    """The address of a search for a term."""
    return F.concat(base, F.lit("?SearchText="), F.url_encode(term))


def organisation_url(base: Column, number: Column) -> Column:
    """The address of an organisation's page by the digits of its number."""
    return F.concat(base, F.lit("?acn="), F.coalesce(digits(number), F.lit("")))


def file_url(base: Column, reference: Column) -> Column:
    """The address of a file's page from any reference with its 32 hex digits; null without."""
    return F.concat(base, F.nullif(F.regexp_extract(reference, "([0-9A-Fa-f]{32})", 1), F.lit("")))


def html_escape(c: Column) -> Column:
    out = c
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def html_text(c: Column) -> Column:
    """The text of markup: tags become spaces, common entities their characters."""
    t = F.regexp_replace(F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1>", " "), r"<[^>]*>", " ")
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return squeeze(t)


def absolute_url(base: Column, link: Column) -> Column:
    """A link made absolute: as it is with a scheme, else behind the base's host."""
    host = F.regexp_extract(base, r"^(https?://[^/]+)", 1)
    return F.when(link.rlike("^https?://"), link).when(link.startswith("/"), F.concat(host, link)).otherwise(F.concat(F.regexp_replace(base, r"[^/]*$", ""), link))


def exposure_score(matters: Column, exposure: Column, known: Column, repeat_weight: float = 25, log_weight: float = 10, cap: float = 100) -> Column:
    """A score of 0 to ``cap`` from the number of matters and the order of magnitude of a known exposure, cut to a whole number."""
    size = F.when(known & (exposure > 0), F.log10(exposure) * log_weight).otherwise(0.0)
    return F.least(F.lit(float(cap)), F.greatest(F.lit(0.0), (matters - 1) * float(repeat_weight) + size)).cast("int")


def money(c: Column) -> Column:
    """Whole dollars with separators, half to even."""
    return F.concat(F.lit("$"), F.format_number(F.bround(c.cast("decimal(18,2)"), 0), 0))


def local_gate(utc: Column, zone: str, weekday: int, hour: int, last_run: Column) -> Column:
    """Whether a weekly run is due: the day of the week and the hour have come in the zone, and it hasn't run on that day."""
    at = F.from_utc_timestamp(utc, zone)
    return (F.weekday(at) + 1 == weekday) & (F.hour(at) >= hour) & (last_run.isNull() | (last_run != F.to_date(at)))
