"""Pieces of SQL that several queries' checks share."""

from __future__ import annotations

from debtloom.functions.text import KEY_STOP_WORDS

#: White space of any kind, as a pattern.
SPACES = r"'[\s\x{00a0}\x{2000}-\x{200b}\x{202f}\x{3000}\x{feff}]+'"


def key_sql(c: str) -> str:
    return f"coalesce(trim(regexp_replace(regexp_replace(regexp_replace(replace(lower({c}), '&', ' and '), '[^a-z0-9 ]', ' ', 'g'), '\\b({'|'.join(KEY_STOP_WORDS)})\\b', ' ', 'g'), ' +', ' ', 'g')), '')"
