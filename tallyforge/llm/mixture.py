"""Mixing sources to target weights, with a curriculum over the training run.

Sizes are tokens of a public tokenizer. Each source is asked for its target share of
the whole, up to its tokens times its permitted repeats; what a source can't give is
asked from the others in proportion to their targets (water filling). A source's weight
may vary over the run: its schedule is a list of relative weights at evenly spaced
times, linear between them. The schedule is integrated to the source's cumulative
demand, and the demand is inverted: a record that begins behind x tokens of its source
gets the time at which the source's demand reaches x. The mixture is the range sort of
all records by that time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.tokens import TOKENIZER, TOKENIZER_DIR, token_counts
from tallyforge.session import small_or_shuffled, stored

#: Relative weights at even times: boards early, curated sources late. Others are constant.
CURRICULUM = {
    "icims_board": (1.4, 1.1, 0.7), "greenhouse_board": (1.4, 1.0, 0.8), "workday_board": (1.3, 1.0, 0.8),
    "company_profiles": (0.7, 1.0, 1.3), "recruiter_notes": (0.6, 1.0, 1.4), "salary_survey": (0.4, 1.0, 1.8),
}
#: Parts of a source's order, so that running totals need no task with a whole source.
PARTS_BITS = 12


def supply(sizes: DataFrame, targets: DataFrame, budget: int | None = None) -> DataFrame:
    """One row per target source: what it has, may give and is asked for (demand).

    budget is the mixture's size in tokens, by default all tokens of the target sources,
    and never more than what repeats permit. The window without partitions runs over the
    target table only, one row per source.
    """
    t = targets.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")).filter("source is not null and target_share > 0")
    have = sizes.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"), F.count("*").alias("available_records"))
    s = t.join(have, "source", "left").fillna(0, ["available_tokens", "available_records", "max_repeats"])
    s = s.withColumn("cap", F.col("available_tokens") * F.greatest("max_repeats", F.lit(0)))
    every = Window.partitionBy()
    by = Window.orderBy(F.col("cap") / F.col("target_share"), "source")
    whole = F.least(F.sum("cap").over(every), F.lit(budget).cast("long") if budget is not None else F.sum("available_tokens").over(every)).cast("double")
    s = s.withColumns({"whole": whole, "cap_to": F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), "share_to": F.sum("target_share").over(by.rowsBetween(Window.unboundedPreceding, -1)), "share_all": F.sum("target_share").over(every)})
    # Were all sources before this one exhausted, the rest would give this much per unit of share.
    level = (F.col("whole") - F.coalesce("cap_to", F.lit(0))) / (F.col("share_all") - F.coalesce("share_to", F.lit(0)))
    s = s.withColumns({"level": level, "ratio": F.col("cap") / F.col("target_share")})
    # The first source in this order that isn't exhausted at its level sets the level for itself and all behind it.
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source", "level"))).over(every)
    water = F.coalesce(first["level"], F.max("ratio").over(every))
    demand = F.least(F.col("cap").cast("double"), water * F.col("target_share"))
    return s.withColumn("demand", F.floor(demand + 1e-6).cast("long")).select(
        "source", "target_share", "max_repeats", "available_tokens", "available_records", "demand"
    )


def _with_curriculum(sources: DataFrame, curriculum: dict[str, tuple[float, ...]]) -> DataFrame:
    """Adds knots (weights at even times) and area (the integral up to each later knot)."""
    for name, k in curriculum.items():
        if len(k) < 2 or min(k) < 0 or sum(k) <= 0:
            raise ValueError(f"a schedule needs two weights or more, none negative, not all zero: {name}")
    flat = [F.lit(1.0), F.lit(1.0)]
    knots = F.coalesce(*[F.when(F.col("source") == n, F.array(*[F.lit(float(x)) for x in k])) for n, k in curriculum.items()], F.array(*flat))
    s = sources.withColumn("knots", knots)
    steps = F.sequence(F.lit(1), F.size("knots") - 1)
    trapezia = lambda upto: F.aggregate(F.slice("knots", 1, upto), F.lit(0.0), lambda a, x: a + x) + F.aggregate(F.slice("knots", 2, upto), F.lit(0.0), lambda a, x: a + x)
    return s.withColumn("area", F.transform(steps, lambda i: trapezia(i) / 2 / (F.size("knots") - 1)))


def _time(part: Column) -> Column:
    """The time at which the share part of a source's demand is reached: the inverse of its integrated schedule."""
    m = F.size("knots") - 1
    y = part * F.element_at("area", -1)
    i = F.least(F.size(F.filter("area", lambda a: a < y)), m - 1)
    k0, k1 = F.get("knots", i), F.get("knots", i + 1)
    r = F.greatest(y - F.when(i > 0, F.get("area", i - 1)).otherwise(0.0), F.lit(0.0))
    root = k0 + F.sqrt(F.greatest(k0 * k0 + 2 * (k1 - k0) * m * r, F.lit(0.0)))
    return F.least(i / m + F.when(root > 0, 2 * r / root).otherwise(0.0), F.lit(1.0))


class Mixture:
    """The mixture of docs (doc_id, source, text) under targets (source, target_share, max_repeats).

    Null and unlisted sources and records without tokens take no part; a source without
    records gives nothing and is reported with share 0. A record enters whole, once per
    pass over its source, if more than half of it lies within the source's demand, so no
    source misses its demand by more than half a record. A null doc_id is an id as any
    other; repeated rows are records of their own. Extra columns are ignored.
    """

    def __init__(
        self, docs: DataFrame, targets: DataFrame, budget: int | None = None, curriculum: dict[str, tuple[float, ...]] | None = None,
        seed: int = 1, name: str = TOKENIZER, folder: str = TOKENIZER_DIR,
    ) -> None:
        self.seed, self.curriculum = seed, CURRICULUM if curriculum is None else curriculum
        wanted = small_or_shuffled(targets.select("source").filter("source is not null").distinct(), 100_000)
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source"), "text").filter("text <> ''").join(wanted, "source", "left_semi")
        counted = token_counts(texts.select("doc_id", "source", "text"), "doc_id long, source string", name, folder)
        self.sizes = stored(counted.filter("n_tokens > 0"))
        self.supply = stored(supply(self.sizes, targets, budget))

    def placed(self) -> DataFrame:
        """(doc_id, source, pass_no, n_tokens, position): every record of the mixture with its time in the run, unsorted."""
        asked = small_or_shuffled(_with_curriculum(self.supply.filter("demand > 0"), self.curriculum), 100_000)
        d = self.sizes.withColumn("h", F.xxhash64(F.lit(self.seed), "doc_id")).withColumn("part", F.shiftright("h", 64 - PARTS_BITS))
        totals = d.groupBy("source", "part").agg(F.sum("n_tokens").alias("n"))
        before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        starts = totals.select("source", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before_part"))
        w = Window.partitionBy("source", "part").orderBy("h", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
        run = d.withColumn("in_part", F.coalesce(F.sum("n_tokens").over(w), F.lit(0))).join(starts, ["source", "part"]).join(asked, "source")
        passes = F.sequence(F.lit(0).cast("long"), F.ceil(F.col("demand") / F.col("available_tokens")).cast("long") - 1)
        e = run.withColumn("pass_no", F.explode(passes))
        middle = F.col("pass_no") * F.col("available_tokens") + F.col("before_part") + F.col("in_part") + F.col("n_tokens") / 2
        e = e.withColumn("middle", middle).filter("middle <= demand")
        return e.select("doc_id", "source", F.col("pass_no").cast("int").alias("pass_no"), "n_tokens", _time(F.col("middle") / F.col("demand")).alias("position"))

    def ordered(self) -> DataFrame:
        """placed(), sorted by position (a range sort)."""
        return self.placed().orderBy("position", "source", "doc_id", "pass_no")

    def shares(self) -> DataFrame:
        """One row per target source: its target, what it has and may give, and what it gives."""
        got = self.placed().groupBy("source").agg(F.sum("n_tokens").alias("mixed_tokens"), F.count("*").alias("mixed_records"), (F.max("pass_no") + 1).alias("passes"))
        s = self.supply.join(got, "source", "left").fillna(0, ["mixed_tokens", "mixed_records", "passes"])
        share = F.coalesce(F.try_divide(F.col("mixed_tokens"), F.sum("mixed_tokens").over(Window.partitionBy())), F.lit(0.0))
        return s.withColumn("actual_share", share)
