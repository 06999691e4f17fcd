"""A statistical detector of languages: naive Bayes over runs of three characters, trained on labelled texts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.session import small_or_shuffled, stored

#: Labelled texts per language that the model is fitted on, at most, and the least number of a language.
MOST_TEXTS, LEAST_TEXTS = 2_000, 3
#: Grams up to which the model is broadcast.
MAX_BROADCAST = 500_000


def evened(text: Column) -> Column:
    """The text in lower case, digits and marks as blanks, with a blank at both ends."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[\s\d\p{P}\p{S}\x{00a0}]+", " ")), F.lit(" "))


def _counted(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, gram, n): the runs of three characters. Texts are taken apart once, so that the work grows in proportion to them."""
    chars = df.select(*keys, F.split(evened(F.col(text)), "").alias("_chars"))
    run = F.transform("_chars", lambda x, i: F.concat(x, F.get("_chars", i + 1), F.get("_chars", i + 2)))
    return chars.select(*keys, F.explode(run).alias("gram")).filter("length(gram) = 3").groupBy(*keys, "gram").agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class LanguageModel:
    """scores: (gram, weights), a weight for each of languages: the log of the gram's share in the language over its least share."""

    scores: DataFrame
    languages: list[str]

    @staticmethod
    def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
        """From at most MOST_TEXTS texts of each label, chosen by a hash; labels with fewer than LEAST_TEXTS texts are left out."""
        from pyspark.sql import Window

        w = Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")
        some = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang is not null and length(trim(text)) > 0").withColumn("place", F.row_number().over(w)).filter(F.col("place") <= MOST_TEXTS)
        kept = stored(some.withColumn("all", F.count("*").over(Window.partitionBy("lang"))).filter(F.col("all") >= LEAST_TEXTS).select("lang", "text"))
        per = stored(_counted(kept, ["lang"], "text"))
        totals = {r.lang: (r.total, r.kinds) for r in per.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).collect()}  # a row per language
        langs = sorted(totals)
        seen = per.groupBy("gram").pivot("lang", langs).agg(F.sum("n")) if langs else per.select("gram").distinct()
        # A gram that a language never had counts half a time there.
        weight = lambda x: F.ln((F.coalesce(F.col(f"`{x}`"), F.lit(0)) + 0.5) / F.lit(0.5))
        base = lambda x: F.ln(F.lit((totals[x][0] + 0.5 * totals[x][1])))
        weights = F.array(*[weight(x) - base(x) for x in langs]).cast("array<double>")
        return LanguageModel(stored(seen.select("gram", weights.alias("weights"))), langs)

    def detect(self, docs: DataFrame, key: str, text: str = "text") -> DataFrame:
        """(key, lang, confidence) of every row's whole text; 'unknown' with 0 without a known gram. keys are unique.

        Equal grams of a text are counted before they meet the model.
        """
        n = len(self.languages)
        if not n:
            return docs.select(key, F.lit("unknown").alias("lang"), F.lit(0.0).alias("confidence"))
        hits = _counted(docs.select(key, text), [key], text).join(small_or_shuffled(self.scores, MAX_BROADCAST), "gram")
        sums = hits.groupBy(key).agg(F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col("weights")[i]).alias(f"_s{i}") for i in range(n)])
        sums = sums.select(key, "n", F.array(*[F.struct(F.col(f"_s{i}").alias("s"), F.lit(x).alias("lang")) for i, x in enumerate(self.languages)]).alias("all"))
        best = F.array_max("all")
        # How much likelier than the others, by the square root of the text's grams, as these don't come independently.
        apart = F.aggregate(F.transform("all", lambda a: F.exp((a["s"] - best["s"]) / F.sqrt("n"))), F.lit(0.0), lambda x, y: x + y)
        found = sums.select(key, best["lang"].alias("lang"), (1 / apart).alias("confidence"))
        return docs.select(key).join(found, key, "left").select(key, F.coalesce("lang", F.lit("unknown")).alias("lang"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
