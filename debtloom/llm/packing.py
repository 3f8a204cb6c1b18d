"""Filling fixed-capacity containers with items: a linear grouping scheme over the histogram of sizes."""

from __future__ import annotations

import base64
import bisect
import os
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from debtloom.session import settle

DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the tokenizer's authors part text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A size above this share of the capacity is large; there are at most GROUPS groups of large sizes.
LARGE, GROUPS = 1 / 8, 128
#: Histograms have one row per size, so a capacity bounds what the driver holds.
MAX_CAPACITY = 4_000_000
#: Shares into which the items of one size are parted to be numbered.
SHARES = 64


@lru_cache(maxsize=2)
def _encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, doc_id: str, text: str, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """``doc_id, n_tokens`` by a byte-level BPE vocabulary file in rank format; whole texts, streamed. Null text has no row, empty text 0."""
    docs = documents.select(documents[doc_id].alias("__d"), documents[text].alias("__t")).where("__d is not null and __t is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer).encode_ordinary
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(encode(t)) for t in batch.column(1).to_pylist()], pa.int64())], ["d", "n"])

    return docs.mapInArrow(run, f"d {docs.schema['__d'].dataType.simpleString()}, n bigint").toDF(doc_id, "n_tokens")


class _Gaps:
    """Runs of containers with equal free space, by that space."""

    def __init__(self) -> None:
        self.runs: dict[int, list[tuple[int, int]]] = {}
        self.spaces: list[int] = []

    def put(self, space: int, first: int, count: int) -> None:
        if space > 0 and count > 0:
            if space not in self.runs:
                self.runs[space] = []
                bisect.insort(self.spaces, space)
            self.runs[space].append((first, count))

    def take(self, least: int) -> tuple[int, int, int] | None:
        """A run with the smallest space of at least ``least``."""
        at = bisect.bisect_left(self.spaces, least)
        if at == len(self.spaces):
            return None
        space = self.spaces[at]
        first, count = self.runs[space].pop()
        if not self.runs[space]:
            del self.runs[space]
            self.spaces.pop(at)
        return space, first, count


def _best_configuration(sizes: list[int], left: list[int], capacity: int) -> list[tuple[int, int]]:
    """The largest remaining size with the choice of others that fills the container best: ``(index, copies)``."""
    lead = next(i for i, n in enumerate(left) if n)
    room = capacity - sizes[lead]
    mask = (1 << room + 1) - 1
    reach, steps = 1, []
    for i in range(lead, len(sizes)):
        copies = min(left[i] - (i == lead), room // sizes[i])
        for _ in range(copies):
            grown = (reach | reach << sizes[i]) & mask
            if grown == reach:
                break
            steps.append((i, reach))
            reach = grown
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    chosen = {lead: 1}
    for i, before in reversed(steps):
        if not before >> at & 1:
            chosen[i] = chosen.get(i, 0) + 1
            at -= sizes[i]
    return sorted(chosen.items())


def plan_packing(histogram: Mapping[int, int], capacity: int, large: float = LARGE, groups: int = GROUPS) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Where the items of each size go, for a histogram ``size -> count`` with sizes 1 to ``capacity``.

    1. Large sizes, in falling order, are parted into groups of equal cardinality; each is rounded up to its group's largest.
    2. Configurations of these few sizes are chosen, each as often as the counts allow.
    3. Actual items take the places of their group; this leaves gaps.
    4. Small items go, largest first, to the gap that they fill best, else to new containers.

    Runs of containers stand for single ones, so work and memory follow the number of sizes and not that of items. Returns rows
    ``(size, first_rank, first_container, offset, modulo, per)``, by size and rank: an item of ``rank`` is in
    ``first_container + (rank - first_rank + offset) % modulo // per``; and the number of containers.
    """
    out: list[tuple[int, int, int, int, int, int]] = []
    gaps, used = _Gaps(), 0
    big = sorted(((s, n) for s, n in histogram.items() if s > large * capacity and n), reverse=True)
    total = sum(n for _, n in big)
    each = -(-total // groups) if total else 1
    # Stretches (size, rank of its first item, count) of each group.
    stretches: list[list[tuple[int, int, int]]] = []
    room = 0
    for s, n in big:
        rank = 0
        while n:
            if not room:
                stretches.append([])
                room = each
            k = min(n, room)
            stretches[-1].append((s, rank, k))
            rank, n, room = rank + k, n - k, room - k
    rounded: list[int] = []
    pools: list[list[tuple[int, int, int]]] = []
    for g in stretches:
        if rounded and rounded[-1] == g[0][0]:
            pools[-1] += g
        else:
            rounded.append(g[0][0])
            pools.append(list(g))
    left = [sum(k for *_, k in p) for p in pools]
    filled = [0] * len(pools)
    while any(left):
        chosen = _best_configuration(rounded, left, capacity)
        times = min(left[i] // a for i, a in chosen)
        cuts = {0, times}
        parts: list[list[tuple[int, int]]] = []
        for i, a in chosen:
            for copy in range(a):
                start, at, steps = filled[i] + copy * times, 0, []
                for size, rank, count in pools[i]:
                    lo, hi = max(at, start), min(at + count, start + times)
                    if lo < hi:
                        out.append((size, rank + lo - at, used, lo - start, times, 1))
                        steps.append((lo - start, size))
                        cuts.add(lo - start)
                    at += count
                parts.append(steps)
            filled[i] += a * times
            left[i] -= a * times
        edges = sorted(cuts)
        for lo, hi in zip(edges, edges[1:]):
            space = capacity - sum(steps[bisect.bisect_right(steps, (lo, capacity + 1)) - 1][1] for steps in parts)
            gaps.put(space, used + lo, hi - lo)
        used += times
    for size, n in sorted(((s, n) for s, n in histogram.items() if s <= large * capacity and n), reverse=True):
        rank = 0
        while rank < n:
            run = gaps.take(size)
            if run is None:
                count = -(-(n - rank) // (capacity // size))
                run = capacity, used, count
                used += count
            space, first, count = run
            per = space // size
            full = min(count, (n - rank) // per)
            if full:
                out.append((size, rank, first, 0, full * per, per))
                gaps.put(space - per * size, first, full)
                rank += full * per
            if full < count and rank < n:
                some = n - rank
                out.append((size, rank, first + full, 0, some, some))
                gaps.put(space - some * size, first + full, 1)
                rank, full = n, full + 1
            gaps.put(space, first + full, count - full)
    out.sort()
    return out, used


def pack(counts: DataFrame, doc_id: str, n_tokens: str, packs: DataFrame, pack_id: str, capacity: str) -> DataFrame:
    """``pack_id, container_id, doc_id, piece_no, token_start, token_end``: every token of every item once, for each capacity.

    An item above the capacity is split into full pieces and a rest; no other item is split. Only histograms, with one row per
    size up to the capacity, reach the driver, and the plan made of them is as small; items learn their container from their
    rank among those of their size. Ranks are counted in SHARES shares per size, so no size is numbered by one task.

    Defined cases: items of no tokens have no row; null ids, sizes and capacities are left out; capacities below 1 raise, as do
    those above MAX_CAPACITY; an item given twice is put in twice; empty tables give no rows.
    """
    spark = counts.sparkSession
    wanted = sorted({(r[0], r[1]) for r in packs.select(pack_id, capacity).where(F.col(pack_id).isNotNull() & F.col(capacity).isNotNull()).distinct().limit(1001).collect()})
    if len(wanted) > 1000 or any(not 1 <= c <= MAX_CAPACITY for _, c in wanted):
        raise ValueError(f"1 to {MAX_CAPACITY} tokens a container and at most 1000 packs are provided for")
    id_kind, pack_kind = counts.schema[doc_id].dataType.simpleString(), packs.schema[pack_id].dataType.simpleString()
    schema = f"{pack_id} {pack_kind}, container_id bigint, {doc_id} {id_kind}, piece_no int, token_start bigint, token_end bigint"
    if not wanted:
        return spark.createDataFrame([], schema)
    capacities = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(c).cast("bigint").alias("c")) for k, (_, c) in enumerate(wanted)])
    pieces = (
        counts.select(F.col(doc_id).alias("d"), F.col(n_tokens).cast("bigint").alias("n")).where("d is not null and n > 0").select("d", "n", F.explode(capacities).alias("p"))
        .select("d", "n", F.col("p.k").alias("k"), F.col("p.c").alias("c"))
        .select("d", "n", "k", "c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / F.col("c")))).alias("i"))
        .select("d", "k", "i", (F.col("i") * F.col("c")).alias("a"), F.least("n", (F.col("i") + 1) * F.col("c")).alias("b"), F.pmod(F.xxhash64("d", "i"), F.lit(SHARES)).cast("int").alias("h"))
        .withColumn("s", F.col("b") - F.col("a"))
    )
    shares = settle(pieces.groupBy("k", "s", "h").agg(F.count("*").alias("m")), "pack-shares")
    histograms: list[dict[int, int]] = [{} for _ in wanted]
    for r in shares.groupBy("k", "s").agg(F.sum("m").alias("m")).toLocalIterator():
        histograms[r["k"]][r["s"]] = r["m"]
    rows = [(k, *row) for k, h in enumerate(histograms) for row in plan_packing(h, wanted[k][1])[0]]
    keys = np.array([r[:3] for r in rows], np.int64).reshape(-1, 3)
    values = np.array([r[3:] for r in rows], np.int64).reshape(-1, 4)
    names = [p for p, _ in wanted]

    offsets = shares.withColumn("before", F.sum("m").over(Window.partitionBy("k", "s").orderBy("h").rowsBetween(Window.unboundedPreceding, -1))).select("k", "s", "h", F.coalesce("before", F.lit(0)).alias("before"))
    ranked = (
        pieces.withColumn("r", F.row_number().over(Window.partitionBy("k", "s", "h").orderBy("d", "i")))
        .join(offsets, ["k", "s", "h"])
        .select("d", "k", F.col("i").cast("int").alias("i"), "a", "b", "s", (F.col("before") + F.col("r") - 1).cast("bigint").alias("r"))
    )
    from pyspark.sql.pandas.types import to_arrow_type

    pack_type = to_arrow_type(packs.schema[pack_id].dataType)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One number for pack and size, which finds the rows of the plan; the rank finds the row among them.
        base = keys[:, 0] * (MAX_CAPACITY + 1) + keys[:, 1]
        firsts, at = np.unique(base, return_index=True)
        ends = np.append(at[1:], len(base))
        dense = np.searchsorted(firsts, base).astype(np.float64)
        top = float(keys[:, 2].max(initial=0) + 1)
        composed = dense + keys[:, 2] / top
        for batch in batches:
            k, s, r = (batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("k", "s", "r"))
            slot = np.searchsorted(firsts, k * (MAX_CAPACITY + 1) + s)
            row = np.searchsorted(composed, slot + np.minimum(r / top, 0.999999999999), side="right") - 1
            row = np.clip(row, at[slot], ends[slot] - 1)
            # The quotient of large ranks may be off by a hair; step to the exact row.
            row = np.where((row > at[slot]) & (keys[row, 2] > r), row - 1, row)
            up = np.minimum(row + 1, ends[slot] - 1)
            row = np.where((up > row) & (keys[up, 2] <= r), up, row)
            first, offset, modulo, per = values[row].T
            container = first + (r - keys[row, 2] + offset) % modulo // per
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[x] for x in k.tolist()], pack_type), pa.array(container, pa.int64()), batch.column("d"), batch.column("i"), batch.column("a"), batch.column("b")],
                ["p", "container_id", "d", "piece_no", "token_start", "token_end"],
            )

    return ranked.mapInArrow(place, f"p {pack_kind}, container_id bigint, d {id_kind}, piece_no int, token_start bigint, token_end bigint").toDF(
        pack_id, "container_id", doc_id, "piece_no", "token_start", "token_end"
    )
