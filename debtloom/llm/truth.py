"""Best representative of each duplicate group: a latent two-sided quality model of the sources."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from debtloom.functions.canon import acn_canon, date_canon, present, type_canon
from debtloom.llm.companies import companies
from debtloom.llm.names import parse_person, with_name_parts
from debtloom.session import forget, settle

#: The quality of the sources is settled once none moves by more than EPS.
EPS = 2e-3
#: Sensitivity and specificity of a source that nothing is known of, and the bounds of both.
PRIOR, BOUNDS = (0.85, 0.9), (0.55, 0.995)
#: How likely a value that may change has done so within the records of one group.
CHANGE = 0.3


def claims(df: DataFrame, group: str, source: str, when: Column, fields: Mapping[str, Column]) -> DataFrame:
    """``group, field, day, source, value, n``: what each source says of each field of each group, and how often.

    Equal claims of a source on a day are one row with their number, added up before anything is sent; an array column claims each of its
    values. Null values claim nothing.
    """
    kinds = dict(df.select(*[c.alias(f) for f, c in fields.items()]).dtypes)
    values = lambda f, c: c.cast("array<string>") if kinds[f].startswith("array") else F.array(c.cast("string"))
    each = df.select(
        group, F.coalesce(F.col(source), F.lit("")).alias("source"), F.coalesce(F.datediff(when, F.lit("1970-01-01").cast("date")), F.lit(0)).alias("day"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("field"), values(f, c).alias("values")) for f, c in fields.items()])).alias("x"),
    ).select(group, "source", "day", "x.field", F.explode("x.values").alias("value"))
    return each.where("value is not null").groupBy(group, "field", "day", "source", "value").agg(F.count("*").alias("n"))


def with_odds(claimed: DataFrame, quality: DataFrame | None) -> DataFrame:
    """``claimed`` with ``pos``, what a claim adds to the log odds of its value, and ``neg``, what it adds to those of every other one."""
    if quality is None:
        sensitivity, specificity = (F.lit(x) for x in PRIOR)
        known = claimed
    else:
        known = claimed.join(quality, ["field", "source"], "left")
        sensitivity, specificity = F.coalesce("sensitivity", F.lit(PRIOR[0])), F.coalesce("specificity", F.lit(PRIOR[1]))
    return known.select(*claimed.columns, F.log(sensitivity / (1 - specificity)).alias("pos"), F.log((1 - sensitivity) / specificity).alias("neg"))


def present_values(steps: Iterator[tuple[int, str, float, float]], n_days: int, n_values: int, change: float = CHANGE) -> dict[str, float]:
    """The probability of each claimed value to be the true present one, of a value that may change once.

    ``steps`` are, in order of time, ``(day, value, for, against)``: what the claims of a value on a day add to its log odds, and to those of all
    others. Either a value held all the time, or it has held since some day and another one before; a running sum per value is all that is kept.
    """
    share = math.log(change / max(1, n_days - 1) / max(1, n_values - 1))
    whole: dict[str, float] = {}  # a value has held so far
    since: dict[str, float] = {}  # it has held since some day, another one before
    none, none_since, began = 0.0, -math.inf, False

    def add(xs: list[float]) -> float:
        top = max(xs, default=-math.inf)
        return top + math.log(sum(math.exp(x - top) for x in xs)) if top > -math.inf else top

    def day_of(said: dict[str, tuple[float, float]]) -> None:
        nonlocal none, none_since, began
        against = sum(a for _, a in said.values())
        for v in said.keys() - whole.keys():
            whole[v], since[v] = none, none_since
        unseen = n_values - len(whole)
        if began:
            others = add([*whole.values(), *([none + math.log(unseen)] if unseen > 0 else [])])
            for v in since:
                rest = math.exp(min(0.0, whole[v] - others))
                past = others + math.log1p(-rest) if rest < 1 - 1e-12 else add([x for u, x in whole.items() if u != v] + ([none + math.log(unseen)] if unseen > 0 else []))
                since[v] = add([since[v], share + past])
            if unseen > 0:
                none_since = add([none_since, share + add([*whole.values(), *([none + math.log(unseen - 1)] if unseen > 1 else [])])])
        for v in whole:
            pos, neg = said.get(v, (0.0, 0.0))
            whole[v] += against - neg + pos
            since[v] += against - neg + pos
        none, none_since, began = none + against, none_since + against, True

    said: dict[str, tuple[float, float]] = {}
    last = None
    for day, value, pos, neg in steps:
        if said and day != last:
            day_of(said)
            said = {}
        said[value], last = (pos, neg), day
    if said:
        day_of(said)
    scores = {v: add([math.log(1 - change) + whole[v], since[v]]) for v in whole}
    total = add(list(scores.values()))
    return {v: math.exp(s - total) for v, s in scores.items()}


def _changing(odds: DataFrame, group: str) -> DataFrame:
    """``group, field, value, p`` of fields that may change. Groups stream by in order of time; what is kept of one is a sum per value."""
    by_day = odds.groupBy(group, "field", "day", "value").agg(F.sum(F.col("n") * F.col("pos")).alias("pos"), F.sum(F.col("n") * F.col("neg")).alias("neg"))
    # The windows bring each group together in one task and keep it there, which a join below, replanned at run time, would not.
    run_of = Window.partitionBy(group, "field")
    ranked = by_day.withColumn("i", F.dense_rank().over(run_of.orderBy("value"))).withColumn("j", F.dense_rank().over(run_of.orderBy("day")))
    sized = ranked.withColumn("days", F.max("j").over(run_of)).withColumn("values", F.max("i").over(run_of))
    ordered = sized.select(group, "field", "day", "value", "pos", "neg", "days", "values").sortWithinPartitions(group, "field", "day", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
        out: list[tuple] = []
        row = next(rows, None)
        while row is not None:
            key, days, values = row[:2], row[6], row[7]

            def steps() -> Iterator[tuple[int, str, float, float]]:
                nonlocal row
                while row is not None and row[:2] == key:
                    yield row[2:6]
                    row = next(rows, None)

            out += [(*key, v, p) for v, p in present_values(steps(), days, values).items()]
            if len(out) >= 10_000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    kind = pa.schema([("g", _arrow(odds, group)), ("field", pa.string()), ("value", pa.string()), ("p", pa.float64())])

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), kind)], schema=kind)

    return ordered.mapInArrow(run, f"g {odds.schema[group].dataType.simpleString()}, field string, value string, p double").withColumnRenamed("g", group)


def _arrow(df: DataFrame, c: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32()}.get(df.schema[c].dataType.simpleString(), pa.string())


def probabilities(claimed: DataFrame, group: str, quality: DataFrame | None, changing: Sequence[str], many: Sequence[str]) -> DataFrame:
    """``group, field, value, p, last_day``: how likely each claimed value is the true (present) one.

    Of a field with one lasting value each claim speaks for its value and against all others, and the values' odds add up to one; of a field in
    ``many`` a value is judged by itself, for by the sources that name it, against by those that speak of the group and leave it out.
    """
    odds = with_odds(claimed, quality)
    lasting, multiple, moving = (odds.where(c) for c in (~F.col("field").isin(*changing, *many), F.col("field").isin(*many), F.col("field").isin(*changing)))
    run = Window.partitionBy(group, "field")
    score = lasting.groupBy(group, "field", "value").agg(F.sum(F.col("n") * (F.col("pos") - F.col("neg"))).alias("s")).withColumn("top", F.max("s").over(run))
    one = score.withColumn("e", F.exp(F.col("s") - F.col("top"))).select(group, "field", "value", (F.col("e") / F.sum("e").over(run)).alias("p"))
    each = multiple.groupBy(group, "field", "source", "value").agg(F.first("pos").alias("pos"), F.first("neg").alias("neg"))
    left_out = each.groupBy(group, "field", "source").agg(F.first("neg").alias("neg")).groupBy(group, "field").agg(F.sum("neg").alias("all"))
    named = each.groupBy(group, "field", "value").agg(F.sum(F.col("pos") - F.col("neg")).alias("s"))
    several = named.join(left_out, [group, "field"]).select(group, "field", "value", (1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), F.col("s") + F.col("all")))))).alias("p"))
    found = one
    if many:
        found = found.unionByName(several)
    if changing:
        found = found.unionByName(_changing(moving, group))
    return found.join(claimed.groupBy(group, "field", "value").agg(F.max("day").alias("last_day")), [group, "field", "value"])


def source_quality(claimed: DataFrame, group: str, changing: Sequence[str] = (), many: Sequence[str] = ()) -> DataFrame:
    """``field, source, sensitivity, specificity`` of each source, by expectation-maximization over all groups that more than one claim speaks of.

    Sensitivity is the share of the true values of the groups a source speaks of that it names, so a true value left out counts against it;
    specificity is the share of their false values that it leaves unnamed. Of a value that has changed, claims before the true present one came up
    are not judged. The rounds go on until no quality moves by more than EPS; the driver sees one number a round.
    """
    told = claimed.join(claimed.groupBy(group, "field").agg(F.sum("n").alias("m")).where("m > 1").select(group, "field"), [group, "field"])
    told = settle(told, "telling-claims")
    quality = None
    while True:
        p = settle(probabilities(told, group, quality, changing, many).drop("last_day"), "round-probabilities")
        judged = told.join(p, [group, "field", "value"])
        came = F.min(F.when(F.col("p") >= 0.5, F.col("day"))).over(Window.partitionBy(group, "field"))
        judged = judged.withColumn("came", came).where(~F.col("field").isin(*changing) | F.col("came").isNull() | (F.col("day") >= F.col("came")))
        weight = F.when(F.col("field").isin(*many), 1).otherwise(F.col("n")).cast("double")
        per = judged.groupBy(group, "field", "source", "value").agg(F.first("p").alias("p"), F.sum(F.col("n")).alias("n")).withColumn("n", weight)
        per = per.groupBy(group, "field", "source").agg(F.sum(F.col("n") * F.col("p")).alias("tp"), F.sum(F.col("n") * (1 - F.col("p"))).alias("fp"), F.sum("n").alias("rows"))
        held = p.groupBy(group, "field").agg(F.sum("p").alias("true"), F.sum(1 - F.col("p")).alias("false"))
        times = F.when(F.col("field").isin(*many), F.lit(1.0)).otherwise(F.col("rows"))
        sums = per.join(held, [group, "field"]).groupBy("field", "source").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum(times * F.col("true")).alias("true"), F.sum(times * F.col("false")).alias("false"))
        bounded = lambda c: F.least(F.greatest(c, F.lit(BOUNDS[0])), F.lit(BOUNDS[1]))
        now = settle(sums.select("field", "source", bounded((F.col("tp") + 4) / (F.col("true") + 5)).alias("sensitivity"), bounded(1 - (F.col("fp") + 1) / (F.col("false") + 10)).alias("specificity")), "source-quality")
        forget(p)
        if quality is not None:
            old = quality.toDF("field", "source", "s", "c")
            moved = now.join(old, ["field", "source"]).agg(F.max(F.greatest(F.abs(F.col("sensitivity") - F.col("s")), F.abs(F.col("specificity") - F.col("c"))))).first()[0]
            forget(quality)
            if moved is None or moved < EPS:
                return now
        quality = now


def true_values(claimed: DataFrame, group: str, changing: Sequence[str] = (), many: Sequence[str] = (), least: float = 0.5) -> DataFrame:
    """``group, field, value, probability``: the true present value of each field; of fields in ``many`` every value of at least ``least``.

    Defined cases: a field nobody claims has no row; a single value is true; of equally likely values the later one is taken, then the smaller; a field in
    ``many`` keeps its likeliest value at least.
    """
    found = settle(probabilities(claimed, group, source_quality(claimed, group, changing, many), changing, many), "probabilities")
    best = found.groupBy(group, "field").agg(F.min_by(F.struct("value", "p"), F.struct(-F.round("p", 9), -F.col("last_day"), "value")).alias("b")).select(group, "field", F.col("b.value").alias("value"), F.col("b.p").alias("probability"))
    if not many:
        return best
    more = found.where(F.col("field").isin(*many) & (F.col("p") >= least)).select(group, "field", "value", F.col("p").alias("probability"))
    return best.unionByName(more).distinct()


#: The fields of a company and whether they may change; a company may have places in several states.
FIELDS = ("acn", "practitioner", "industry", "appointment_type")
CHANGING = ("practitioner", "appointment_type")
MANY = ("state",)


def canonical_fields(matter: DataFrame) -> DataFrame:
    """``matter_row`` with one writing per meaning of each field; null for blanks and fillers.

    A practitioner is a surname with the first letter of the given name, since names are shortened and turned round.
    """
    base = matter.select(
        "matter_row", "source", date_canon(F.col("last_checked")).alias("day"), F.when(present(F.col("acn")).isNotNull(), acn_canon(F.col("acn"))).alias("acn"), present(F.col("practitioner")).alias("who"),
        F.lower(present(F.col("industry"))).alias("industry"), F.when(present(F.col("appointment_type")).isNotNull(), type_canon(F.col("appointment_type"))).alias("appointment_type"),
        *([F.upper(present(F.col("state"))).alias("state")] if "state" in matter.columns else []),
    )
    people = with_name_parts(base.select("who").where("who is not null").distinct(), "who", "who", parse_person)
    return base.join(people, "who", "left").withColumn("practitioner", F.when(F.col("who").isNotNull(), F.concat_ws("|", "core", F.substring("head", 1, 1))))


def _fields_of(matter: DataFrame, fields: Sequence[str]) -> DataFrame:
    members = settle(companies(matter, "matter_row", "company_name", acn_canon(F.col("acn"))), "companies")
    return settle(canonical_fields(matter.where("matter_row is not null")).join(members, "matter_row").select("matter_row", "company", "source", "day", *fields), "matter-fields")


def judged_rows(matter: DataFrame) -> DataFrame:
    """``matter_row, company, field_name, value, true_value, probability`` of every present value of the four fields."""
    rows = _fields_of(matter, FIELDS)
    claimed = settle(claims(rows, "company", "source", F.col("day"), {f: F.col(f) for f in FIELDS}), "claims")
    truth = settle(true_values(claimed, "company", CHANGING), "truth").select("company", F.col("field").alias("field_name"), F.col("value").alias("true_value"), "probability")
    long = rows.select("matter_row", "company", F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in FIELDS])).alias("x")).select("matter_row", "company", "x.field_name", "x.value")
    return long.where("value is not null").join(truth, ["company", "field_name"])


def best_records(matter: DataFrame) -> DataFrame:
    """``company, n_rows``, the true present value of each of the four fields, and ``states``, every state judged true, in order."""
    rows = _fields_of(matter, (*FIELDS, *MANY))
    claimed = settle(claims(rows, "company", "source", F.col("day"), {f: F.col(f) for f in (*FIELDS, *MANY)}), "claims")
    truth = settle(true_values(claimed, "company", CHANGING, MANY), "truth")
    one = truth.groupBy("company").agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in FIELDS], F.array_sort(F.collect_set(F.when(F.col("field") == MANY[0], F.col("value")))).alias("states"))
    return rows.groupBy("company").agg(F.count_distinct("matter_row").alias("n_rows")).join(one, "company", "left")
