"""State that is merged, replaced, pruned and kept open, one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def absent(c: Column, kind: str) -> Column:
    """Null, and what counts as nothing: empty text, zero, false."""
    if kind == "string":
        return c.isNull() | (c == "")
    return F.coalesce(~c, F.lit(True)) if kind == "boolean" else (c.isNull() | (c == 0) if kind in ("int", "bigint", "double") else c.isNull())


def merge_state(known: DataFrame, found: DataFrame, key: str, stamp: Column, stamp_name: str = "last_seen") -> DataFrame:
    """Known rows with their absent fields filled from found ones, and new rows; found keys are stamped. ``is_new`` tells which.

    A present field is never overwritten. Both sides must have one row per key. One full outer join.
    """
    kinds = dict(known.dtypes)
    fields = [c for c in known.columns if c not in (key, stamp_name)]
    k, f = known.alias("k"), found.alias("f")
    merged = k.join(f, F.col(f"k.{key}") == F.col(f"f.{key}"), "full_outer")
    there = F.col(f"f.{key}").isNotNull()
    old = F.col(f"k.{stamp_name}") if stamp_name in known.columns else F.lit(None)
    return merged.select(
        F.coalesce(F.col(f"k.{key}"), F.col(f"f.{key}")).alias(key),
        *[(F.when(absent(F.col(f"k.{c}"), kinds[c]), F.coalesce(F.col(f"f.{c}"), F.col(f"k.{c}"))).otherwise(F.col(f"k.{c}")) if c in found.columns else F.col(f"k.{c}")).alias(c) for c in fields],
        F.when(there, stamp).otherwise(old).alias(stamp_name),
        F.col(f"k.{key}").isNull().alias("is_new"),
    )


def replace_by_key(existing: DataFrame, new: DataFrame, key: str, touched: DataFrame | None = None) -> DataFrame:
    """Existing rows but for those of touched keys, and the new rows; ``touched`` adds keys that were read again to nothing."""
    keys = new.select(key)
    if touched is not None:
        keys = keys.unionByName(touched.select(key))
    return existing.join(keys.distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def first_by(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order; pre-aggregated, so no key is sorted in one task."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("__r")).select(*key, *[F.col(f"__r.{c}").alias(c) for c in rest])


def open_rows(df: DataFrame, captured: str, first_seen: Column, as_of: Column, days: int, status: str, closed: Sequence[str]) -> DataFrame:
    """Rows not captured, first seen within ``days`` (a missing date counts as within), and in no closed status (null is none)."""
    return df.where(~F.coalesce(captured, F.lit(False)) & (first_seen.isNull() | (first_seen >= F.date_sub(as_of, days))) & ~F.coalesce(F.col(status).isin(*closed), F.lit(False)))


def within(date: Column, as_of: Column, days: int) -> Column:
    """Undated, or no older than ``days``; zero days are all."""
    return F.lit(True) if days == 0 else date.isNull() | (date >= F.date_sub(as_of, days))


def recent(date: Column, as_of: Column, days: int, configured: int) -> Column:
    """As ``within``; zero days fall back to the configured window."""
    return within(date, as_of, days or configured)


def upsert(known: DataFrame, queued: DataFrame, key: str, refreshed: Sequence[str]) -> DataFrame:
    """Known rows with ``refreshed`` columns from the queue, their other columns kept; new rows as queued."""
    k, q = known.alias("k"), queued.alias("q")
    cols = [c for c in known.columns if c != key]
    there = F.col(f"q.{key}").isNotNull()
    value = lambda c: (F.coalesce(F.col(f"q.{c}"), F.col(f"k.{c}")) if c in refreshed else F.coalesce(F.col(f"k.{c}"), F.col(f"q.{c}"))) if c in queued.columns else F.col(f"k.{c}")
    return k.join(q, F.col(f"k.{key}") == F.col(f"q.{key}"), "full_outer").select(F.coalesce(F.col(f"k.{key}"), F.col(f"q.{key}")).alias(key), *[value(c).alias(c) for c in cols], there.alias("is_queued"))


def prune(rows: DataFrame, keep: Column) -> DataFrame:
    """Rows that are still queued or that someone has answered."""
    return rows.where(F.col("is_queued") | F.coalesce(keep, F.lit(False)))


def ordinal_in(df: DataFrame, key: Sequence[str], order: Sequence[Column], name: str = "ordinal") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
