"""Deduplicating new batches against all history: a persisted index of minwise band keys."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from debtloom.functions.canon import acn_canon, date_canon, present, type_canon
from debtloom.llm.names import agrees, with_name_parts
from debtloom.llm.variants import near_words
from debtloom.llm.vectors import head_contexts
from debtloom.session import scratch_path, settle

#: Bands of two minwise hashes: bigram sets with two fifths in common share a band with a probability of 0.97, with half in common of 0.997. Names of
#: which one has no trade, or its initial only, meet in FEWER bands: with two thirds in common, as one wrong letter leaves them, 0.99.
BANDS, ROWS, FEWER = 20, 2, 8
#: Rows that a bucket of the index holds about; the number of buckets grows with what is stored.
BUCKET_ROWS = 500_000
#: Two feeds may date one appointment so many days apart; WINDOW is the width of the windows of time in the keys.
NEAR_DAYS, WINDOW = 7, 16
MAX_BATCHES = 100_000

_CELLS = 4096
_HASHES = np.random.default_rng(7).integers(1, 2**31, (BANDS * ROWS, _CELLS), dtype=np.int64)


def source_id_canon(c: Column) -> Column:
    """Letters and digits of a source's id, lower case, without the source's name before a slash; null for fillers."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_replace(present(c), r"^\s*[A-Za-z]+\s*/", "")), "[^a-z0-9]", ""), F.lit(""))


def number_canon(c: Column) -> Column:
    """A number's digits; null for fillers and for zeros only."""
    n = F.when(present(c).isNotNull(), acn_canon(c))
    return F.when(~n.rlike("^0*$"), n)


def minwise_bands(word: str) -> list[int]:
    """A key for each band of the least hashes of a word's bigrams."""
    w = f"^{word}$"
    cells = [(ord(a) * 63 + ord(b)) % _CELLS for a, b in zip(w, w[1:])]
    least = _HASHES[:, cells].min(axis=1).reshape(BANDS, ROWS)
    return (least[:, 0] * 2_147_483_659 + least[:, 1]).tolist()


def signed(names: DataFrame) -> DataFrame:
    """``nid, core, head`` with ``bands``, the band keys of the rare word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([minwise_bands(w) for w in b.column(1).to_pylist()], pa.list_(pa.int64()))], ["nid", "core", "head", "bands"])

    return names.select("nid", "core", "head").mapInArrow(run, "nid bigint, core string, head string, bands array<bigint>")


class BatchIndex:
    """Keys of accepted notices in files bucketed by the hash of the key, in a folder of their own; opened again, it goes on with what is there.

    ``names`` has the minwise band keys of each different name once; ``notices`` what was reported under a name or number in a window of time,
    with the first such notice. Both are kept in segments, bucketed and sorted by key, so a join moves the keys that are looked up and none
    that are stored. A new segment takes in those that aren't larger than twice itself; so their number is the logarithm of the rows, and a row
    is written again as often.
    """

    TABLES = {"names": "key bigint, nid bigint, core string, head string", "notices": "key bigint, first bigint, first_batch bigint, core string, head string, acn string, sid string, day int, kind string"}

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.opened = spark, path.rstrip("/"), {}

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def segments(self, table: str) -> list[tuple[int, int, int, str]]:
        """``(number, buckets, rows, path)`` of the complete segments, as their folders are named."""
        where, fs = self._fs(f"{self.path}/{table}")
        found = []
        for f in fs.listStatus(where) if fs.exists(where) else []:
            name = f.getPath().getName()
            if fs.exists(self._fs(f"{self.path}/{table}/{name}/_SUCCESS")[0]):
                found.append((*map(int, name.split("-")), f"{self.path}/{table}/{name}"))
        return sorted(found)

    def read(self, table: str) -> list[DataFrame]:
        """The segments, each as a table that Spark knows to be bucketed and sorted by ``key``."""
        out = []
        for _, buckets, _, path in self.segments(table):
            if path not in self.opened:
                name = f"segment_{uuid.uuid4().hex}"
                self.spark.sql(f"CREATE TABLE {name} ({self.TABLES[table]}) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{path}'")
                self.opened[path] = name
            out.append(self.spark.table(self.opened[path]))
        return out

    def lookup(self, table: str, keys: DataFrame) -> DataFrame | None:
        """``keys`` joined with what is stored under them; None while nothing is."""
        # What is exploded is never broadcast: its size isn't known beforehand.
        found = [keys.alias("b").hint("merge").join(s.alias("a"), F.col("a.key") == F.col("b.key")) for s in self.read(table)]
        return reduce(DataFrame.union, found) if found else None

    def append(self, table: str, rows: DataFrame) -> None:
        """Add a segment, with the smaller ones before it; ``rows`` are read twice."""
        rows = rows.select(*[c.split()[0] for c in self.TABLES[table].split(", ")])
        n, old, merged = rows.count(), self.segments(table), []
        if not n:
            return
        for segment in reversed(old):
            if segment[2] > 2 * n:
                break
            merged.append(segment)
            n += segment[2]
        rows = reduce(DataFrame.unionByName, [s for s, o in zip(self.read(table), old) if o in merged], rows)
        buckets = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BUCKET_ROWS))
        path = f"{self.path}/{table}/{old[-1][0] + 1 if old else 0:06d}-{buckets}-{n}"
        name = f"segment_{uuid.uuid4().hex}"
        rows.repartition(buckets, "key").sortWithinPartitions("key").write.bucketBy(buckets, "key").sortBy("key").format("parquet").option("path", path).saveAsTable(name)
        self.opened[path] = name
        for *_, gone in merged:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.opened.pop(gone)}")
            where, fs = self._fs(gone)
            fs.delete(where, True)


    def close(self) -> None:
        """Take the segments' names out of the catalogue; their files stay."""
        for name in self.opened.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.opened.clear()


def name_keys(names: DataFrame, probing: bool) -> DataFrame:
    """One row per name, context of its head and band; and one for its own id, under which it is known."""
    few = F.when(F.col("c").startswith("T"), F.col("bands")).otherwise(F.slice("bands", 1, FEWER))
    each = names.select("nid", "core", "head", F.explode(head_contexts(probing)).alias("c"), "bands").select("nid", "core", "head", F.transform(few, lambda h, i: F.xxhash64(i, h, F.col("c"))).alias("keys"))
    own = names.select("nid", "core", "head", F.array("nid").alias("keys"))
    return each.unionByName(own).select("nid", "core", "head", F.explode("keys").alias("key"))


def notice_keys(notices: DataFrame, probing: bool) -> DataFrame:
    """``notices`` with ``key``: its name (or those near it, column ``near``) and its numbers, each in its window of time, when probing in every window within NEAR_DAYS."""
    window = lambda d: F.floor((F.col("day") + d) / WINDOW)
    windows = F.array_distinct(F.array(window(-NEAR_DAYS), window(NEAR_DAYS))) if probing else F.array(window(0))
    windows = F.when(F.col("day").isNull(), F.array(F.lit(-1_000_000).cast("bigint"))).otherwise(windows)
    own = F.transform("near", lambda n: F.xxhash64(F.lit("name"), n)) if probing else F.array_compact(F.array(F.when(F.col("core") != "", F.xxhash64(F.lit("name"), "nid"))))
    numbers = F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.xxhash64(F.lit(f), f)) for f in ("acn", "sid")]))
    each = notices.select("*", F.explode(F.concat(own, numbers)).alias("k"), windows.alias("ws")).select("*", F.explode("ws").alias("w"))
    return each.withColumn("key", F.xxhash64("k", "w")).drop("k", "ws", "w", *(["near"] if probing else []))


def same_name(a: str, b: str) -> Column:
    x, y = (lambda f: F.col(f"{a}.{f}")), (lambda f: F.col(f"{b}.{f}"))
    return (F.length(x("core")) > 0) & near_words(x("core"), y("core")) & F.coalesce(agrees(x("head"), y("head")), F.lit(True))


def same_appointment(a: str, b: str) -> Column:
    """Whether two notices report one appointment of one company.

    The company: near rare words and trades that can be one; with an equal ACN or source id rare words half alike do, or one that is missing. The
    appointment: the same day, or the same type within NEAR_DAYS; without days, the same type.
    """
    x, y = (lambda f: F.col(f"{a}.{f}")), (lambda f: F.col(f"{b}.{f}"))
    loosely = F.levenshtein(x("core"), y("core")) <= F.greatest(F.length(x("core")), F.length(y("core"))) / 2
    number = F.coalesce(x("acn") == y("acn"), F.lit(False)) | F.coalesce(x("sid") == y("sid"), F.lit(False))
    # Two numbers may differ by a slip, not in most of their digits.
    slip = F.coalesce(F.levenshtein(x("acn"), y("acn")) <= 2, F.lit(True))
    company = slip & F.coalesce(agrees(x("head"), y("head")), F.lit(True)) & (same_name(a, b) | (number & (loosely | (x("core") == "") | (y("core") == ""))))
    apart = F.abs(x("day") - y("day"))
    kind = F.coalesce(x("kind") == y("kind"), F.lit(True))
    return company & F.when(apart.isNotNull(), (apart == 0) | ((apart <= NEAR_DAYS) & kind)).otherwise(x("day").isNull() & y("day").isNull() & kind)


_WHAT = ["core", "head", "acn", "sid", "day", "kind"]


def _near_names(index: BatchIndex, notices: DataFrame) -> DataFrame:
    """``nid, near``: the names of this round with all near ones known or new, themselves among them; new ones are stored."""
    names = settle(signed(notices.where("core != ''").select("nid", "core", "head").distinct()), "round-names")
    probing = name_keys(names, True)
    stored = index.lookup("names", probing)
    near = lambda df: df.where(same_name("a", "b")).select(F.col("b.nid").alias("nid"), F.col("a.nid").alias("near")).distinct()
    if stored is None:
        new, pairs = names, []
    else:
        known = settle(near(stored), "near-known-names")
        new, pairs = names.join(known.where("nid = near").select("nid"), "nid", "left_anti"), [known]
        new = settle(new, "new-names")
    keys = name_keys(new, False)
    pairs.append(near(probing.alias("b").hint("merge").join(keys.alias("a"), F.col("a.key") == F.col("b.key"))))
    index.append("names", keys)
    return settle(reduce(DataFrame.unionByName, pairs).groupBy("nid").agg(F.collect_set("near").alias("near")), "near-names")


def _first_notices(notices: DataFrame, links: DataFrame) -> DataFrame:
    """``id, first, first_batch``: the earliest notice that each leads to over links to earlier ones, handed on until nothing changes."""
    own = F.struct(F.col("batch"), F.col("id"))
    first = settle(notices.join(links.where("inside = false").groupBy("id").agg(F.min(F.struct("first_batch", "first")).alias("m")), "id", "left").select("id", F.least(own, F.when(F.col("m").isNotNull(), F.struct(F.col("m.first_batch").alias("batch"), F.col("m.first").alias("id")))).alias("f")), "round-first")
    inside = links.where("inside").select("id", F.col("first").alias("q"))
    while True:
        better = inside.join(first.select(F.col("id").alias("q"), F.col("f").alias("g")), "q").groupBy("id").agg(F.min("g").alias("g"))
        after = settle(first.join(better, "id", "left").select("id", F.least("f", "g").alias("f"), F.coalesce(F.col("g") < F.col("f"), F.lit(False)).alias("moved")), "round-first")
        moved = after.where("moved").limit(1).count()
        first = after.select("id", "f")
        if not moved:
            return first.select("id", F.col("f.id").alias("first"), F.col("f.batch").alias("first_batch"))


def known_notices(batches: DataFrame, index: BatchIndex | None = None, batches_a_round: int = 12) -> DataFrame:
    """``first_arrival_id, arrival_id``: every notice whose appointment an earlier row reported, with the first such row.

    ``batches`` has ``arrival_id, batch_no, source_id, company_name, acn, appointment_type, appointment_date``; earlier means a lower
    (``batch_no``, ``arrival_id``). Batches are taken in rounds of ``batches_a_round``; the result does not depend on it. Rows equal in all
    that counts are one notice, the earliest, so that a notice delivered over and over costs one row. Of each different name the near ones
    are looked up by minwise band keys, among those of the index and of the round; then notices under near names or equal numbers within a
    window of time are compared, and the keys of all are stored, each with the first notice it stands for.

    Defined cases: rows without an id or batch are left out; notices without any rare word and number are news; null names match by their
    numbers only, fillers and zeros being none; unreadable dates match only each other, with the same type; repeated ids count as one row;
    empty tables give no rows.
    """
    spark = batches.sparkSession
    own = index is None
    index = BatchIndex(spark, scratch_path(spark, "batch-index")) if own else index
    rows = batches.where("arrival_id is not null and batch_no is not null")
    names = with_name_parts(rows.select("company_name").distinct(), "company_name", "company_name")
    canon = rows.join(names, rows["company_name"].eqNullSafe(names["company_name"]), "left").select(
        rows["arrival_id"].cast("bigint").alias("id"), rows["batch_no"].cast("bigint").alias("batch"), F.coalesce("core", F.lit("")).alias("core"), F.coalesce("head", F.lit("")).alias("head"),
        number_canon(rows["acn"]).alias("acn"), source_id_canon(rows["source_id"]).alias("sid"), F.datediff(date_canon(rows["appointment_date"]), F.lit("1970-01-01").cast("date")).alias("day"), type_canon(rows["appointment_type"]).alias("kind"),
    )
    telling = (F.col("core") != "") | F.col("acn").isNotNull() | F.col("sid").isNotNull()
    canon = settle(canon.where(telling).groupBy("id").agg(F.min(F.struct("batch", *_WHAT)).alias("m")).select("id", "m.*"), "notices")
    numbers = sorted(r[0] for r in canon.select("batch").distinct().limit(MAX_BATCHES + 1).collect())
    if len(numbers) > MAX_BATCHES:
        raise ValueError("more batches than provided for")
    key = F.xxhash64(*_WHAT)
    out = []
    for at in range(0, len(numbers), batches_a_round):
        part = canon.where(F.col("batch").isin(numbers[at : at + batches_a_round]))
        notices = settle(part.groupBy(*_WHAT).agg(F.min(F.struct("batch", "id")).alias("m")).select("*", "m.*", F.xxhash64("core", "head").alias("nid"), key.alias("g")).drop("m"), "round-notices")
        near = _near_names(index, notices)
        none = F.array().cast("array<bigint>")
        probing = settle(notice_keys(notices.join(near, "nid", "left").withColumn("near", F.coalesce("near", none)), True), "round-keys")
        mine = notice_keys(notices.select("*", F.col("id").alias("first"), F.col("batch").alias("first_batch")), False)
        earlier = F.struct("a.first_batch", "a.first") < F.struct("b.batch", "b.id")
        kept = lambda df, inside: df.where(same_appointment("a", "b") & earlier).select("b.id", "a.first", "a.first_batch", F.lit(inside).alias("inside")).distinct()
        links = kept(probing.alias("b").hint("merge").join(mine.alias("a"), F.col("a.key") == F.col("b.key")), True)
        before = index.lookup("notices", probing)
        if before is not None:
            links = links.unionByName(kept(before, False))
        first = _first_notices(notices, settle(links, "round-links"))
        index.append("notices", settle(notice_keys(notices.join(first, "id"), False), "notice-keys"))
        members = part.select("id", key.alias("g")).join(notices.select("g", F.col("id").alias("n")), "g").join(first.withColumnRenamed("id", "n"), "n").where("first != id")
        out.append(settle(members.select(F.col("first").alias("first_arrival_id"), F.col("id").alias("arrival_id")), "round-known"))
    if own:
        index.close()
    if not out:
        return spark.createDataFrame([], "first_arrival_id bigint, arrival_id bigint")
    return reduce(DataFrame.unionByName, out)
