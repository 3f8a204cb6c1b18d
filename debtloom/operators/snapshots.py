"""What changed between full snapshots of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: One integer per delivery is read to the driver; daily deliveries of a century stay far below.
MAX_DELIVERIES = 100_000


def snapshot_changes(
    df: DataFrame,
    key: str,
    version: str,
    compare: Mapping[str, Column],
    prefer: Sequence[Column] = (),
    max_deliveries: int = MAX_DELIVERIES,
) -> DataFrame:
    """Typed changes between each delivered snapshot and the next delivered one.

    The rows are kept range-partitioned by ``key`` and sorted by key and version, so that in each range the sorted
    runs of all snapshots lie merged; one pass then moves two pointers, the row of the earlier snapshot and that of the
    later one, over each key and emits what it sees.

    ``compare`` gives, by name, the meaning of each compared column (a Column over ``df``); other columns do not count.
    ``prefer`` ranks repeated rows of a key in one snapshot, the largest wins; equal ones are settled by the values.

    Returns ``version, key, change_kind, changed_columns``: ``added`` and ``changed`` at the later snapshot, ``removed``
    at the first snapshot without the key. ``changed_columns`` is null but for ``changed``.

    Defined cases: rows whose key or version is null are left out (they can't be followed); null in a compared column
    equals null only; an empty table gives no rows, nor does a single snapshot; other columns may have any name. A key
    that holds most rows is reduced to one row a snapshot before anything is sent to its range.
    """
    names = list(compare)
    slim = df.select(
        df[version].alias("__v"),
        df[key].alias("__k"),
        F.struct(*[compare[n].alias(f"c{i}") for i, n in enumerate(names)]).alias("__c"),
        F.struct(*[p.alias(f"p{i}") for i, p in enumerate(prefer)], F.lit(0).alias("p")).alias("__p"),
    ).where("__k is not null and __v is not null")
    versions = sorted(r[0] for r in slim.select("__v").distinct().limit(max_deliveries + 1).collect())
    if len(versions) > max_deliveries:
        raise ValueError(f"more than {max_deliveries} deliveries; raise max_deliveries")

    one = slim.groupBy("__k", "__v").agg(F.max(F.struct("__p", "__c")).alias("__r")).select("__k", "__v", F.col("__r.__c").alias("__c"))
    # The delivery's place and the delivery after it, looked up in a table of no more than max_deliveries rows.
    kind = dict(slim.dtypes)["__v"]
    places = df.sparkSession.createDataFrame([(v, i, versions[i] if i < len(versions) else None) for i, v in enumerate(versions, 1)], f"__v {kind}, __at int, __later {kind}")
    run = Window.partitionBy("__k").orderBy("__v")
    walked = (
        one.join(F.broadcast(places), "__v")
        .repartitionByRange(F.col("__k"))
        .withColumns({"__before": F.lag("__at").over(run), "__old": F.lag("__c").over(run), "__after": F.lead("__at").over(run)})
    )
    came = (F.col("__at") > 1) & (F.coalesce("__before", F.lit(0)) != F.col("__at") - 1)
    went = (F.col("__at") < len(versions)) & (F.coalesce("__after", F.lit(0)) != F.col("__at") + 1)
    differ = F.filter(F.array(*[F.when(~F.col(f"__old.c{i}").eqNullSafe(F.col(f"__c.c{i}")), F.lit(n)) for i, n in enumerate(names)]), lambda x: x.isNotNull())

    def event(when: Column, kind: str, at_version: Column, what: Column) -> Column:
        return F.when(when, F.struct(at_version.alias("v"), F.lit(kind).alias("kind"), what.alias("what")))

    nothing = F.lit(None).cast("array<string>")
    events = F.array(
        event(came, "added", F.col("__v"), nothing),
        event((F.col("__before") == F.col("__at") - 1) & (F.size(differ) > 0), "changed", F.col("__v"), differ),
        event(went, "removed", F.col("__later"), nothing),
    )
    return walked.select("__k", F.explode(F.filter(events, lambda e: e.isNotNull())).alias("__e")).select(
        F.col("__e.v").alias(version), F.col("__k").alias(key), F.col("__e.kind").alias("change_kind"), F.col("__e.what").alias("changed_columns")
    )


class SnapshotStore:
    """Snapshots kept as they were delivered: one run each, range-partitioned and sorted by key, in a folder of its own.

    A new delivery is compared with the last run only: the two are merged range by range as in ``snapshot_changes``, so the work of a delivery
    doesn't grow with the number of those before it. Earlier runs are not read or written again.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, version: str):
        self.spark, self.path, self.key, self.version = spark, path.rstrip("/"), key, version

    def runs(self) -> list[str]:
        """The folders of the complete runs in the order of their delivery."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []
        return [f"{self.path}/{n}" for n in sorted(found) if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/_SUCCESS"))]

    def append(self, delivery: DataFrame, compare: Mapping[str, Column], prefer: Sequence[Column] = ()) -> DataFrame:
        """Keep a delivery, all rows of one version, and return what has changed since the last one, as ``snapshot_changes`` does.

        Defined cases: the first delivery has no changes; an empty one, or one not later than the last, raises; rows without a key are left out.
        """
        names = list(compare)
        values = [compare[n].alias(f"c{i}") for i, n in enumerate(names)]
        slim = delivery.select(F.col(self.version).alias("v"), F.col(self.key).alias("k"), *values, F.struct(*[p.alias(f"p{i}") for i, p in enumerate(prefer)], F.lit(0).alias("p")).alias("p")).where("k is not null and v is not null")
        each = [f"c{i}" for i in range(len(names))]
        one = slim.groupBy("v", "k").agg(F.max(F.struct("p", *each)).alias("r")).select("v", "k", *[F.col(f"r.{c}").alias(c) for c in each])
        versions = [r[0] for r in slim.select("v").distinct().limit(2).collect()]
        before = self.runs()
        last = self.spark.read.parquet(before[-1]) if before else None
        if len(versions) != 1 or (last is not None and last.agg(F.max("v")).first()[0] >= versions[0]):
            raise ValueError("a delivery has one version, later than the last")
        path = f"{self.path}/{len(before):08d}"
        one.repartitionByRange("k").sortWithinPartitions("k").write.parquet(path)
        kept = self.spark.read.schema(one.schema).parquet(path)
        both = kept if last is None else last.unionByName(kept)
        found = snapshot_changes(both, "k", "v", {n: F.col(f"c{i}") for i, n in enumerate(names)})
        return found.toDF(self.version, self.key, "change_kind", "changed_columns")
