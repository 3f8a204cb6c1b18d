"""Evaluation texts leaking into training text: Wu-Manber multi-pattern search over whole texts."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Small words, which may be exchanged without making another passage.
SMALL_WORDS = frozenset(
    "a an the this that these those which who whom whose what to towards toward in during into within of for from by with at on upon onto and or nor but as if when while once since "
    "because so than then there their they them it its is are was were be been being has have had do does did not no may must shall should will would can could his her he she we you "
    "your our my me us him any some each every all both either neither one "
    "der die das den dem des ein eine einen einem einer eines dieser diese dieses diesen diesem jener jene jenes jenen welcher welche welches welchen und oder aber im am auf aus bei "
    "beim mit nach von vom vor zu zum zur für über unter um durch gegen ohne bis seit während ob dass daß wenn wie weil da ist sind war waren wird werden wurde wurden hat haben hatte "
    "hatten nicht kein keine keinen sich er sie es ihr ihre ihren sein seine seinen man "
    "el la los las lo un una unos unas del al en con por para sin sobre entre desde hasta que quien cual cuando como y o u pero si se su sus este esta estos estas ese esa esos esas es son era fue ha han "
    "le les une des du au aux et ou où dans par pour avec sans sur sous entre vers chez dont qui que quand comme si mais ce cet cette ces se sa ses leur leurs est sont était a ont ne pas "
    "il gli di da su nel nella dei delle della o e um uma os as do da dos das no na nos nas ao "
    "का की के को में से पर और या है हैं था थे थी यह वह ये वे इस उस जो कि ने तक भी "
    "في من على إلى عن مع أو أن إن هذا هذه ذلك تلك التي الذي كان كانت قد لم لا ما ثم".split()
)
SMALL_SIGNS = frozenset("的这那该此其了在于从与和及或被把将由向对以为是有又再之而则")

_WORD = re.compile(r"[^\W_]+")
_CJK = re.compile(r"[㐀-鿿豈-﫿぀-ヿ가-힯]")
#: Pattern length and block length, of word scripts and of scripts whose signs are words.
WORD_SCRIPT, SIGN_SCRIPT = (18, 12), (6, 4)
#: Text of so many characters is searched at once.
CHUNK_CHARS = 2_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def folded(text: str) -> str:
    """Letters and digits only, lower case, without small words; what may differ in a copy is gone."""
    words = [w for w in _WORD.findall(text.lower()) if w not in SMALL_WORDS]
    joined = "".join(words)
    return "".join(c for c in joined if c not in SMALL_SIGNS) if not joined.isascii() and _CJK.search(joined) else joined


class WuManber:
    """All occurrences of many patterns of one length.

    ``shift`` holds, for the hash of every block in a pattern, how far the window may move on before a pattern could
    end there; a block of no pattern lets it move by ``length - block + 1``. Blocks with shift 0 lead by their hash to
    the patterns with that suffix, which are compared directly.
    """

    def __init__(self, patterns: Sequence[str], length: int, block: int):
        self.length, self.block = length, block
        self.most = length - block + 1
        self.by_suffix: dict[str, dict[str, list[int]]] = {}
        shift: dict[str, int] = {}
        for i, p in enumerate(patterns):
            for at in range(length - block + 1):
                b, s = p[at : at + block], length - block - at
                if s < shift.get(b, self.most):
                    shift[b] = s
            self.by_suffix.setdefault(p[-block:], {}).setdefault(p, []).append(i)
        self.shift = shift
        keys = np.unique(self._hash(self._codes("".join(shift)), block)) if shift else np.zeros(0, np.uint64)
        self.keys = keys
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(keys >> np.uint64(44)).astype(np.int64)] = True

    @staticmethod
    def _codes(text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)

    def _hash(self, codes: np.ndarray, step: int) -> np.ndarray:
        """Hashes of the blocks at every ``step``-th place."""
        n = (len(codes) - self.block) // step + 1
        out = np.zeros(max(n, 0), np.uint64)
        if n > 0:
            for k in range(self.block):
                out = (out + codes[k : k + (n - 1) * step + 1 : step].astype(np.uint64) + np.uint64(1)) * _ODD
                out ^= out >> np.uint64(29)
        return out

    def occurrences(self, text: str) -> Iterator[tuple[int, int]]:
        """``(end, pattern)`` of every occurrence.

        While blocks are of no pattern, the window moves by the longest shift each time, so the blocks at these places
        are looked up all at once. Where one is in the table, the window is moved step by step up to the next such place.
        """
        hashes = self._hash(self._codes(text), self.most)
        near = np.flatnonzero(self.filter[(hashes >> np.uint64(44)).astype(np.int64)])
        if not len(near):
            return
        near = near[np.isin(hashes[near], self.keys)]
        shift, block, length, most = self.shift, self.block, self.length, self.most
        for place in near.tolist():
            at = place * most
            stop = min(at + most, len(text) - block + 1)
            while at < stop:
                b = text[at : at + block]
                s = shift.get(b, most)
                if s:
                    at += s
                    continue
                end = at + block
                for i in self.by_suffix[b].get(text[max(0, end - length) : end], ()):
                    yield end, i
                at += 1


class LeakFinder:
    """Which items a text holds, and how much of each."""

    def __init__(self, items: Sequence[tuple[object, str]]):
        self.items: list[tuple[object, int, int]] = []  # key, folded length, pattern length
        self.searches: list[tuple[WuManber, list[tuple[int, int]], bool]] = []
        grouped: dict[tuple[int, int, bool], tuple[list[str], list[tuple[int, int]]]] = {}
        for key, text in items:
            f = folded(text)
            if not f:
                continue
            signs = len(_CJK.findall(f)) * 3 > len(f)
            length, block = SIGN_SCRIPT if signs else WORD_SCRIPT
            if len(f) < length:
                length = len(f)
                block = max(1, min(block, length - 1))
            patterns, where = grouped.setdefault((length, block, signs), ([], []))
            for at in range(len(f) - length + 1):
                patterns.append(f[at : at + length])
                where.append((len(self.items), at))
            self.items.append((key, len(f), length))
        for (length, block, signs), (patterns, where) in grouped.items():
            self.searches.append((WuManber(patterns, length, block), where, signs))

    def shares(self, texts: Sequence[str | None]) -> Iterator[tuple[int, int, float]]:
        """``(index of text, index of item, share of the item)`` of all that is held in part."""
        start = 0
        while start < len(texts):
            stop, size, held = start, 0, []
            while stop < len(texts) and size < CHUNK_CHARS:
                held.append(folded(texts[stop] or ""))
                size += len(held[-1])
                stop += 1
            yield from ((start + t, i, s) for t, i, s in self._chunk(held))
            start = stop

    def _chunk(self, held: list[str]) -> Iterator[tuple[int, int, float]]:
        covered: dict[tuple[int, int], np.ndarray] = {}
        for search, where, signs in self.searches:
            use = [k for k, h in enumerate(held) if h and (not signs or (not h.isascii() and _CJK.search(h)))]
            if not use:
                continue
            ends = np.cumsum([len(held[k]) + 1 for k in use])
            for end, pattern in search.occurrences("\n".join(held[k] for k in use) + "\n"):
                t = use[int(np.searchsorted(ends, end - 1, side="right"))]
                item, at = where[pattern]
                seen = covered.get((t, item))
                if seen is None:
                    seen = covered[t, item] = np.zeros(self.items[item][1], bool)
                seen[at : at + search.length] = True
        for (t, item), seen in sorted(covered.items()):
            yield t, item, float(seen.mean())


@lru_cache(maxsize=4)
def _finder(items: tuple[tuple[object, str], ...]) -> LeakFinder:
    return LeakFinder(items)


def leaks(
    documents: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, least: float = 0.5, block_chars: int = 4_000_000
) -> DataFrame:
    """Documents that hold at least ``least`` of an item's text, in one piece or more: ``doc_id, item_id, share``.

    Texts are compared without case, spacing, punctuation and small words (``SMALL_WORDS``, ``SMALL_SIGNS``). Every stretch of
    18 letters (6 in sign scripts) of an item is a pattern; its share is the part of the item covered by patterns found.

    The items are a stated query set. They are read to the driver in blocks of at most ``block_chars`` characters, and each block
    is searched in all documents, so no task holds more than one block's tables. Documents stream through; none is shuffled.

    Defined cases: null and empty texts hold nothing; an item without letters or digits is held by no document; an item shorter
    than a pattern is one pattern; repeated document or item rows give one row; empty tables give none.
    """
    spark = documents.sparkSession
    docs = documents.select(documents[doc_id].alias("__d"), documents[text].alias("__t")).where("__d is not null and length(__t) > 0")
    kinds = (docs.schema["__d"].dataType.simpleString(), items.schema[item_id].dataType.simpleString())
    blocks: list[list[tuple[object, str]]] = [[]]
    size = 0
    for key, body in items.select(item_id, item_text).where(F.col(item_id).isNotNull() & (F.length(item_text) > 0)).distinct().orderBy(item_id).toLocalIterator():
        if size + len(body) > block_chars and blocks[-1]:
            blocks.append([])
            size = 0
        blocks[-1].append((key, body))
        size += len(body)

    def search(block: tuple[tuple[object, str], ...]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = _finder(block)
            for batch in batches:
                ids, texts = batch.column(0), batch.column(1).to_pylist()
                found = [(t, i, s) for t, i, s in finder.shares(texts) if s >= least]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array([t for t, _, _ in found])), pa.array([finder.items[i][0] for _, i, _ in found], schema_item), pa.array([s for *_, s in found], pa.float64())], ["d", "i", "s"]
                    )

        return run

    from pyspark.sql.pandas.types import to_arrow_type

    schema_item = to_arrow_type(items.schema[item_id].dataType)
    out = spark.createDataFrame([], f"d {kinds[0]}, i {kinds[1]}, s double")
    for block in blocks:
        if block:
            out = out.unionByName(docs.mapInArrow(search(tuple(block)), f"d {kinds[0]}, i {kinds[1]}, s double"))
    return out.groupBy("d", "i").agg(F.max("s").alias("s")).select(F.col("d").alias(doc_id), F.col("i").alias(item_id), F.col("s").alias("share"))
