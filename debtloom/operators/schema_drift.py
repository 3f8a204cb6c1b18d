"""Schemas that drift between files: per-file schemas, their changes, and one consistent table."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from debtloom.session import settle

if TYPE_CHECKING:
    import pandas as pd

#: A removed and an added column whose score stays below are two changes, not a renaming.
RENAME_SCORE = 0.45
#: Rounds of flooding at most; it stops earlier once scores move by less than FLOOD_EPS.
FLOOD_ROUNDS, FLOOD_EPS = 30, 1e-3

_SKETCH = ("n_values", "avg_len", "avg_words", "digit_share", "upper_share", "b0", "b1", "b2", "b3")
_SKETCH_TYPE = "n_values:bigint,avg_len:double,avg_words:double,digit_share:double,upper_share:double,b0:bigint,b1:bigint,b2:bigint,b3:bigint"
_PROFILE = f"struct<fold:string,shown:string,json_type:string,nested:string,{_SKETCH_TYPE},usage:array<struct<json_type:string,{_SKETCH_TYPE}>>>"


def fold_key(c: Column) -> Column:
    """Keys that differ only in letter case, white space (line breaks too) or underscores are one key."""
    return F.regexp_replace(F.lower(c), r"[\s_ ]+", "")


def cells(df: DataFrame, file_key: str, payload: str) -> DataFrame:
    """One row per key of each JSON object: ``file_key, key, fold, value`` (text; objects as JSON), ``kind``.

    ``kind`` is string, number, boolean, object, array or null. Payloads that are no JSON object have no cells.
    """
    parsed = df.select(df[file_key].alias("__f"), F.try_parse_json(df[payload]).alias("__j")).where(F.schema_of_variant("__j").startswith("OBJECT"))
    each = parsed.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("__j").outer())).select("__f", "key", "value")
    schema = F.schema_of_variant("value")
    kind = (
        F.when(F.col("value").isNull() | (schema == "VOID"), "null")
        .when(schema == "STRING", "string")
        .when(schema == "BOOLEAN", "boolean")
        .when(schema.startswith("OBJECT"), "object")
        .when(schema.startswith("ARRAY"), "array")
        .otherwise("number")
    )
    return each.select(
        F.col("__f").alias(file_key), "key", fold_key(F.col("key")).alias("fold"), F.try_variant_get("value", "$", "string").alias("value"), kind.alias("kind"),
        F.when(kind.isin("object", "array"), schema).alias("nested"),
    )


def column_profiles(df: DataFrame, file_key: str, payload: str) -> DataFrame:
    """The schema of each file: ``file_key, fold, shown, json_type`` and a content sketch of fixed size per column.

    ``json_type`` is that of most non-null values (ties: the first by name), null where all are null; ``shown`` is the
    most frequent writing of the key (ties: the smallest). The sketch holds means and a 256-bit map of word hashes, so
    a file or column with most of all rows is no more than one row after the map-side aggregation.
    """
    c = cells(df, file_key, payload)
    # Values without the syntax and keys of JSON; digits by their number only.
    text = F.when(F.col("kind").isin("object", "array"), F.regexp_replace(F.regexp_replace("value", r'"[^"]*"\s*:', " "), r'[\[\]{}",]|\bnull\b', " ")).otherwise(F.col("value"))
    plain = F.trim(text)
    words = F.filter(F.split(F.translate(F.lower(plain), "012345678", "999999999"), r"[^\p{L}9]+"), lambda w: w != "")
    bits = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(256)).cast("int"))
    known = F.col("kind") != "null"

    def block(i: int) -> Column:
        return F.aggregate(F.filter("bits", lambda b: F.floor(b / 64) == i), F.lit(0).cast("bigint"), lambda acc, b: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b % 64)))

    row = c.select(file_key, "fold", "key", "kind", "nested", F.when(known, plain).alias("plain"), F.when(known, bits).alias("bits"))
    row = row.select(
        file_key, "fold", "key", "kind", "nested", F.length("plain").alias("len"), F.size("bits").alias("words"),
        F.length(F.regexp_replace("plain", "[^0-9]", "")).alias("nd"), F.length(F.regexp_replace("plain", r"[^\p{Lu}]", "")).alias("nu"), *[block(i).alias(f"b{i}") for i in range(4)],
    )
    kinds = ("array", "boolean", "number", "object", "string")
    by_key = row.groupBy(file_key, "fold", "key").agg(
        F.count("*").alias("n"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds], F.max("nested").alias("nested"),
        F.sum("len").alias("len"), F.sum(F.when(F.col("len").isNotNull(), F.col("words"))).alias("words"), F.sum("nd").alias("nd"), F.sum("nu").alias("nu"),
        *[F.bit_or(f"b{i}").alias(f"b{i}") for i in range(4)],
    )
    total = by_key.groupBy(file_key, "fold").agg(
        F.min(F.struct((-F.col("n")).alias("n"), "key"))["key"].alias("shown"), F.sum("n").alias("n_rows"), *[F.sum(f"n_{k}").alias(f"n_{k}") for k in kinds], F.max("nested").alias("nested"),
        F.sum("len").alias("len"), F.sum("words").alias("words"), F.sum("nd").alias("nd"), F.sum("nu").alias("nu"), *[F.bit_or(f"b{i}").alias(f"b{i}") for i in range(4)],
    )
    most = F.array_min(F.array(*[F.struct((-F.col(f"n_{k}")).alias("n"), F.lit(k).alias("k")) for k in kinds]))
    values = sum((F.col(f"n_{k}") for k in kinds), F.lit(0))
    per = lambda x, y: F.coalesce(F.try_divide(F.col(x), y), F.lit(0.0))
    return total.select(
        file_key, "fold", "shown", F.when(values > 0, most["k"]).alias("json_type"), "nested", "n_rows", values.alias("n_values"),
        per("len", values).alias("avg_len"), per("words", values).alias("avg_words"), per("nd", F.col("len")).alias("digit_share"), per("nu", F.col("len")).alias("upper_share"),
        *[F.coalesce(f"b{i}", F.lit(0).cast("bigint")).alias(f"b{i}") for i in range(4)],
    )


def _name_parts(shown: str) -> set[str]:
    return {w for w in re.split(r"[\W_]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", shown).lower()) if w}


def _grams(text: str) -> set[str]:
    return {f" {text} "[i : i + 3] for i in range(len(text))}


def _overlap(a: set, b: set) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0.0


def _bits(c: Mapping) -> int:
    return sum((int(c[f"b{i}"]) & (2**64 - 1)) << 64 * i for i in range(4))


def _content(a: Mapping, b: Mapping) -> float:
    """How alike the values of two columns are, by sketch, 0 to 1; 0.3 where one has no values."""
    if not a["n_values"] or not b["n_values"]:
        return 0.3
    x, y = _bits(a), _bits(b)
    nx, ny, both = x.bit_count(), y.bit_count(), (x & y).bit_count()
    chance = nx * ny / 256
    alike = max(0.0, (both - chance) / max(1e-9, min(nx, ny) - chance)) if min(nx, ny) > chance else 0.5
    near = np.exp(-abs(np.log((a["avg_len"] + 2) / (b["avg_len"] + 2))) * 1.5)
    shape = np.exp(-3 * (abs(a["digit_share"] - b["digit_share"]) + abs(a["upper_share"] - b["upper_share"])))
    few = np.exp(-abs(np.log((nx + 2) / (ny + 2))))
    return float((0.45 * alike + 0.2 * near + 0.2 * shape + 0.15 * few))


def _usage(a: Mapping, b: Mapping) -> float:
    """How alike two keys are used over all files: their contents, type by type, weighed by the share they have in common."""
    of_a, of_b = ({u["json_type"]: u for u in (() if c.get("usage") is None else c["usage"])} for c in (a, b))
    n_a, n_b = (max(1, sum(u["n_values"] for u in of.values())) for of in (of_a, of_b))
    common = [(min(of_a[t]["n_values"] / n_a, of_b[t]["n_values"] / n_b), _content(of_a[t], of_b[t])) for t in of_a.keys() & of_b.keys()]
    weight = sum(w for w, _ in common)
    return (sum(w * x for w, x in common) + 0.1 * 0.3) / (weight + 0.1)


def flood(left: Sequence[Mapping], right: Sequence[Mapping], apart: frozenset[tuple[str, str]] = frozenset()) -> np.ndarray:
    """Similarity flooding over two schema graphs; the scores of all pairs of columns, 0 to 1.

    The graphs' nodes are columns, words of their names, JSON types and nested members. A pair of columns is joined to the
    pairs of their name words, types and members; scores flow along these edges in both directions until they stay put. Keys that are ``apart``
    (in order) stand side by side somewhere and can't mean the same.
    """

    def first(a: Mapping, b: Mapping) -> float:
        name = max(_overlap(_name_parts(a["shown"]), _name_parts(b["shown"])), _overlap(_grams(a["fold"]), _grams(b["fold"])))
        if (min(a["fold"], b["fold"]), max(a["fold"], b["fold"])) in apart:
            return 0.0
        return 0.3 * _content(a, b) + 0.55 * _usage(a, b) + 0.15 * name

    start = np.array([[first(a, b) for b in right] for a in left])

    def parts(c: Mapping) -> set[tuple[str, str]]:
        members = set(re.findall(r"(\w+): ", c["nested"] or ""))
        return {("word", w) for w in _name_parts(c["shown"])} | {("type", c["json_type"] or "none")} | {("member", m) for m in members}

    of_left, of_right = [parts(c) for c in left], [parts(c) for c in right]
    a_nodes, b_nodes = (sorted(set().union(*of)) for of in (of_left, of_right))
    link_a = np.array([[n in p for n in a_nodes] for p in of_left], float)
    link_b = np.array([[n in p for n in b_nodes] for p in of_right], float)
    same_kind = np.array([[x[0] == y[0] for y in b_nodes] for x in a_nodes], float)
    equal = np.array([[x == y for y in b_nodes] for x in a_nodes], float)
    # Outgoing weights share a pair's score equally among its neighbours of one kind.
    fan = np.maximum(1, link_a.sum(0)[:, None] * link_b.sum(0)[None, :])
    degree = np.maximum(1, link_a @ same_kind @ link_b.T)
    columns, nodes = start.copy(), equal * 0.5
    for _ in range(FLOOD_ROUNDS):
        up = (link_a @ (nodes / fan) @ link_b.T)
        down = (link_a.T @ (columns / degree) @ link_b) * same_kind
        new_columns, new_nodes = start + 0.15 * (columns + up), equal * 0.5 + 0.5 * (nodes + down)
        new_columns = new_columns / max(1.0, new_columns.max(initial=0))
        new_nodes = new_nodes / max(1.0, new_nodes.max(initial=0))
        moved = float(np.abs(new_columns - columns).max(initial=0))
        columns, nodes = new_columns, new_nodes
        if moved < FLOOD_EPS:
            break
    return columns


def correspondences(scores: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Consistent pairs: each column once, the best pair first (ties: the first), none below ``least``."""
    order = sorted(((-scores[i, j], i, j) for i in range(scores.shape[0]) for j in range(scores.shape[1]) if scores[i, j] >= least))
    used_i: set[int] = set()
    used_j: set[int] = set()
    out = []
    for _, i, j in order:
        if i not in used_i and j not in used_j:
            used_i.add(i)
            used_j.add(j)
            out.append((i, j))
    return out


def compare_schemas(before: Sequence[Mapping], now: Sequence[Mapping], least: float = RENAME_SCORE, apart: frozenset[tuple[str, str]] = frozenset()) -> list[tuple[str, str, str | None]]:
    """Changes from one file's columns to the next one's: ``(column_name, change_kind, earlier_name)``."""
    old, new = {c["fold"]: c for c in before}, {c["fold"]: c for c in now}
    gone, come = [c for k, c in sorted(old.items()) if k not in new], [c for k, c in sorted(new.items()) if k not in old]
    pairs = [(old[k], c) for k, c in sorted(new.items()) if k in old]
    renamed = correspondences(flood(gone, come, apart), least) if gone and come else []
    out: list[tuple[str, str, str | None]] = []
    for i, j in renamed:
        out.append((come[j]["shown"], "renamed", gone[i]["shown"]))
        pairs.append((gone[i], come[j]))
    out += [(c["shown"], "added", None) for j, c in enumerate(come) if j not in {j for _, j in renamed}]
    out += [(c["shown"], "removed", c["shown"]) for i, c in enumerate(gone) if i not in {i for i, _ in renamed}]
    out += [(b["shown"], "retyped", a["shown"]) for a, b in pairs if a["json_type"] and b["json_type"] and a["json_type"] != b["json_type"]]
    return out


def with_usage(profiles: DataFrame) -> DataFrame:
    """Adds ``usage``, what all files say of a column's key: the sketch of its values, one entry per JSON type."""
    mean = lambda c: F.try_divide(F.sum(F.col(c) * F.col("n_values")), F.sum("n_values")).alias(c)
    by_type = profiles.where("json_type is not null").groupBy("fold", "json_type").agg(
        F.sum("n_values").alias("n_values"), *[mean(c) for c in _SKETCH[1:5]], *[F.bit_or(c).alias(c) for c in _SKETCH[5:]]
    )
    usage = by_type.groupBy("fold").agg(F.sort_array(F.collect_list(F.struct("json_type", *_SKETCH))).alias("usage"))
    return profiles.join(usage, "fold", "left")


def side_by_side(profiles: DataFrame, file_key: str) -> DataFrame:
    """``a, b``: keys that stand beside each other in some file, in order. Equal schemas are put together before pairs of keys are made."""
    shapes = profiles.groupBy(file_key).agg(F.sort_array(F.collect_list("fold")).alias("all")).select("all").distinct()
    return shapes.select(F.explode("all").alias("a"), "all").select("a", F.explode("all").alias("b")).where("a < b").distinct()


def schema_changes(df: DataFrame, feed: str, file_key: str, file_order: Sequence[str], payload: str, least: float = RENAME_SCORE) -> DataFrame:
    """``feed, file_key, column_name, change_kind, earlier_name`` of each file against the one before it in its feed.

    ``file_order`` (columns that are constant in a file) puts the files of a feed in order; ``file_key`` settles ties. Defined cases:
    a feed's first file has no changes; a row without a feed, file or JSON object counts for nothing; a column whose values are all
    null has no type and is never retyped; an empty table gives no rows. Only schemas, one row a file, are put in order.
    """
    files = df.where(df[feed].isNotNull() & df[file_key].isNotNull()).groupBy(df[file_key]).agg(F.min(df[feed]).alias("__feed"), F.min(F.struct(*[df[o] for o in file_order])).alias("__order"))
    profiles = settle(column_profiles(df, file_key, payload), "profiles")
    schemas = with_usage(profiles).groupBy(file_key).agg(F.sort_array(F.collect_list(F.struct("fold", "shown", "json_type", "nested", *_SKETCH, "usage"))).cast(f"array<{_PROFILE}>").alias("__now"))
    run = Window.partitionBy("__feed").orderBy("__order", file_key)
    pairs = files.join(schemas, file_key).withColumn("__before", F.lag("__now").over(run)).where("__before is not null")
    # Nothing to say of files whose columns and types stand as before.
    mark = lambda c: F.transform(c, lambda x: F.struct(x["fold"], x["json_type"]))
    pairs = settle(pairs.where(mark("__now") != mark("__before")).select("__feed", F.col(file_key).alias("__file"), "__before", "__now"), "schema-pairs")
    # Of the keys that went and those that came, the pairs that are not one since they stand side by side elsewhere.
    folds = lambda c: F.transform(c, lambda x: x["fold"])
    swaps = pairs.select("__file", F.explode(F.array_except(folds("__before"), folds("__now"))).alias("g"), F.array_except(folds("__now"), folds("__before")).alias("cs")).select("__file", "g", F.explode("cs").alias("c"))
    apart = swaps.select("__file", F.least("g", "c").alias("a"), F.greatest("g", "c").alias("b")).join(side_by_side(profiles, file_key), ["a", "b"]).groupBy("__file").agg(F.collect_set(F.struct("a", "b")).alias("__apart"))
    pairs = pairs.join(apart, "__file", "left").select("__feed", "__file", "__before", "__now", "__apart")

    def changes(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        for part in parts:
            rows = [(r[0], r[1], *x) for r in part.itertuples(index=False, name=None) for x in compare_schemas(list(r[2]), list(r[3]), least, frozenset((p["a"], p["b"]) for p in (() if r[4] is None else r[4])))]
            yield pd.DataFrame(rows, columns=["feed", "file", "column_name", "change_kind", "earlier_name"])

    kinds = dict(pairs.dtypes)
    found = pairs.mapInPandas(changes, f"feed {kinds['__feed']}, file {kinds['__file']}, column_name string, change_kind string, earlier_name string")
    return found.select(F.col("feed").alias(feed), F.col("file").alias(file_key), "column_name", "change_kind", "earlier_name")


def _leaf(value: Column, kind: Column) -> Column:
    """One text of a nested value: year, month and day as a date, else the longest text member, else the first element."""
    part = lambda p: F.get_json_object(value, f"$.{p}")
    texts = F.regexp_extract_all(value, F.lit(r':\s*"((?:[^"\\]|\\.)*)"'), F.lit(1))
    longest = F.array_max(F.transform(texts, lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))["t"]
    first = F.coalesce(F.get_json_object(value, "$[0]"), F.regexp_extract(value, r"\[\s*([^,\]]*)", 1))
    return F.when(kind == "object", F.coalesce(F.when(part("y").isNotNull(), F.concat_ws("-", part("y"), part("m"), part("d"))), longest)).when(kind == "array", first).otherwise(value)


def key_mapping(profiles: DataFrame, file_key: str, fields: Sequence[str], least: float = RENAME_SCORE) -> DataFrame:
    """``fold, field, score``: which field of the wanted table each key of any file stands for.

    The wanted fields take their content from the keys of their own name; every other key is flooded against them, and keys
    that stand beside a field's own key in some file can't mean it. One row per distinct key; the fields' sketches, one row
    per field of the wanted schema, are all that the driver holds.
    """
    named = dict(zip([re.sub(r"[\s_]+", "", f.lower()) for f in fields], fields))
    vocabulary = with_usage(profiles).groupBy("fold").agg(
        F.max("shown").alias("shown"), F.first("usage").alias("usage"), F.max("nested").alias("nested"), F.max_by("json_type", "n_values").alias("json_type"),
        *[F.max_by(c, F.struct("n_values", c)).alias(c) for c in _SKETCH],
    )
    targets = [r.asDict(recursive=True) for r in vocabulary.where(F.col("fold").isin(*named)).collect()]
    targets.sort(key=lambda t: t["fold"])
    # Which of the wanted fields' own keys a key stands beside: no more than there are fields.
    beside = side_by_side(profiles, file_key)
    beside = beside.unionByName(beside.select(F.col("b").alias("a"), F.col("a").alias("b"))).where(F.col("b").isin(*named)).groupBy(F.col("a").alias("fold")).agg(F.collect_set("b").alias("beside"))
    vocabulary = vocabulary.join(beside, "fold", "left")

    def match(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        for part in parts:
            rows = []
            for c in part.to_dict("records"):
                if c["fold"] in named:
                    rows.append((c["fold"], named[c["fold"]], 1.0))
                elif targets:
                    apart = frozenset((min(c["fold"], o), max(c["fold"], o)) for o in (() if c["beside"] is None else c["beside"]))
                    scores = flood([c], targets, apart)[0]
                    best = int(scores.argmax())
                    if scores[best] >= least:
                        rows.append((c["fold"], named[targets[best]["fold"]], float(scores[best])))
            yield pd.DataFrame(rows, columns=["fold", "field", "score"])

    return vocabulary.mapInPandas(match, "fold string, field string, score double")


def unified_table(df: DataFrame, row_keys: Sequence[str], file_key: str, payload: str, fields: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """All files as one table: ``row_keys`` and the ``fields``, each cast by its function of a text Column.

    Rows without any mapped key come out with nulls; where two keys of a row mean one field, a present value wins over null,
    then the smaller key's. Row keys must be unique; payloads that are no JSON object give no row.
    """
    profiles = settle(column_profiles(df, file_key, payload), "profiles")
    mapping = key_mapping(profiles, file_key, list(fields)).select("fold", "field")
    tagged = df.select(F.struct(*row_keys).alias("__row"), payload)
    each = cells(tagged, "__row", payload).join(mapping, "fold", "left")
    text = F.when(F.col("kind") != "null", _leaf(F.col("value"), F.col("kind")))
    slim = each.select("__row", "field", "key", text.alias("text"))
    wide = slim.groupBy("__row").agg(*[F.min_by("text", F.when((F.col("field") == f) & F.col("text").isNotNull(), F.col("key"))).alias(f"__{i}") for i, f in enumerate(fields)])
    return wide.select("__row.*", *[cast(F.col(f"__{i}")).alias(f) for i, (f, cast) in enumerate(fields.items())])
