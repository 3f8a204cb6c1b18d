"""Whether a name is that of a person."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Titles, and words that only businesses and bodies have in their names.
TITLES = ("mr", "mrs", "ms", "miss", "mx", "dr", "prof", "sir", "rev")
BUSINESS_WORDS = (
    "pty ltd limited proprietary inc co company group holdings trust bros sons daughters services service systems supplies solutions works wholesale equipment industries international management merchants contractors "
    "distributors council city shire library university water corporation commissioner office department bank finance insurance hire glass steel timber tyres fuel foods freight logistics marine paints tiles waste "
    "windows electrical automotive recruitment irrigation concrete building furniture nurseries catering joinery cleaning roofing printing fabrication refrigeration insulation plumbing surveying produce scaffolding engineering "
    "quarries earthmoving security textiles packaging"
).split()


def is_person(name: Column, business: Sequence[str] = BUSINESS_WORDS, keep: Sequence[str] = ()) -> Column:
    """Whether a name, or each of several joined by "and", has two to four words that are initials or capitalised and no business word.

    A title decides for a person; a digit or ``&`` against. ``keep`` names businesses that look like people.
    """
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(name, r"(?i)\bc/[o-].*$", ""), r"\([^)]*\)", " "), r"\s+\d{1,4}$", "")
    bare = F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(bare, " +", " ")), r"^[ .,\-]+|[ .,\-]+$", ""), " +", " ")

    def one(part: Column) -> Column:
        words = F.filter(F.split(part, " "), lambda w: w != "")
        fine = F.forall(words, lambda w: w.rlike(r"^[A-Za-z]\.?$") | (w.rlike(r"^[A-Z][A-Za-z'\-]*$") & ~w.rlike("^[A-Z]{2,}$") & ~F.lower(w).isin(*business)))
        return F.size(words).between(2, 4) & fine

    def decide(bare: Column) -> Column:
        first = F.lower(F.replace(F.get(F.split(bare, " "), F.lit(0)), F.lit("."), F.lit("")))
        return F.when((bare == "") | bare.rlike("[0-9&]"), False).when(first.isin(*TITLES), True).otherwise(F.forall(F.split(bare, r"(?i) and "), one))

    # In a lambda the bare name is made once, not wherever it is read.
    decided = F.get(F.transform(F.array(bare), decide), F.lit(0))
    return F.coalesce(F.when(F.lower(F.trim(name)).isin(*keep), False).otherwise(decided) if keep else decided, F.lit(False))
