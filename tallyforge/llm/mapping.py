"""Mapping of freely typed values to the entries of reference lists.

Token-level repair: each distinct token that is typed anywhere is joined to the
vocabulary of its reference list, as a word, as a known short form, by edit distance, as
the beginning of a word, or as two words typed as one. All of these are equi-joins with one
table of the parts of the vocabulary's words: what is left of a word when one or two
characters are deleted, and its beginnings. Complete entries are then ranked by soft
TF-IDF over the repaired tokens. An entry is the one meant if all its tokens are there,
nothing in the value speaks against it (a word that is neither of the entry, nor of its
context such as the state, nor filler), and no other entry ranks as high.

Several lists, each with its own rules, go through one pass, told apart by a column.
Joins run over distinct tokens and distinct values. Sides made of the reference lists are
broadcast only if they are counted to be small.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.fold import fold, tokens
from tallyforge.session import small_or_shuffled, stored

#: Rows of a table made of the lists up to which it's broadcast.
MAX_BROADCAST = 200_000
#: Similarity of a repaired token: as a short form, as a beginning, as part of two words typed as one.
SHORT_FORM, BEGINNING, RUN_TOGETHER = 0.98, 0.9, 0.97

# Short forms and filler words.
PLACE_SHORT = {
    "ft": "fort", "mt": "mount", "st": "saint", "lk": "lake", "jct": "junction", "pt": "port", "spgs": "springs", "hts": "heights",
    "n": "north", "e": "east", "s": "south", "w": "west", "usa": "us", "gb": "uk", "cty": "city", "fls": "falls",
}
PLACE_FILLER = ("office", "hybrid", "metro", "greater", "area", "days", "day", "on", "site", "only", "fully", "anywhere", "region")
KEYWORD_SHORT = {"mgmt": "management", "ops": "operations", "analytics": "analysis", "mgt": "management", "dev": "development"}
KEYWORD_FILLER = (
    "of", "skills", "skill", "a", "plus", "hands", "on", "required", "strong", "proven", "knowledge", "experience", "experienced", "in",
    "with", "and", "the", "advanced", "basic", "solid", "preferred",
)


@dataclass(frozen=True)
class Rules:
    """How a kind of value is typed. edits is 1 or 2."""

    short: Mapping[str, str] = field(default_factory=dict)
    filler: Sequence[str] = ()
    beginnings: bool = False
    digits_are_filler: bool = True
    letters_are_filler: bool = False
    edits: int = 1

    @property
    def idle(self) -> str | None:
        """Pattern of the tokens that say nothing."""
        kinds = [r"\d+"] * self.digits_are_filler + [r"\p{L}"] * self.letters_are_filler
        return f"^(?:{'|'.join(kinds)})$" if kinds else None


PLACES = Rules(PLACE_SHORT, PLACE_FILLER)
KEYWORDS = Rules(KEYWORD_SHORT, KEYWORD_FILLER, beginnings=True, digits_are_filler=False, letters_are_filler=True, edits=2)


def distance(a: str, b: str) -> int:
    """Insertions, deletions, replacements and swaps of neighbours that make b of a, no place changed twice; 3 for more than two."""
    if abs(len(a) - len(b)) > 2:
        return 3
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        before, last = last, row
    return min(last[-1], 3)


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        d = [distance(x, y) for x, y in zip(b.column("tok").to_pylist(), b.column("word").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(d, pa.int32())], names=[*b.schema.names, "d"])


def _per_list(rules: Mapping[str, Rules], value) -> Column:
    """A column by the list; value gives it for some rules, or None."""
    return F.coalesce(*[F.when(F.col("list") == name, v) for name, r in rules.items() if (v := value(r)) is not None], F.lit(None))


def _cuts(tok: Column) -> Column:
    """The token and what is left of it when one character is deleted."""
    i = F.sequence(F.lit(1), F.length(tok))
    cut = F.transform(i, lambda k: F.concat(F.substring(tok, F.lit(1), k - 1), F.substring(tok, k + 1, F.length(tok))))
    return F.array_distinct(F.concat(F.array(tok), cut))


def _parts(tok: str, least: int, rules: Mapping[str, Rules]) -> Column:
    """What is left of a token when as many characters are deleted as its list allows; tokens of fewer than least characters stay whole (for two deletions least + 2)."""
    c, n = F.col(tok), F.length(tok)
    twice = F.array_distinct(F.flatten(F.transform(_cuts(c), _cuts)))
    two = F.coalesce(_per_list(rules, lambda r: F.lit(r.edits == 2)), F.lit(False))
    return F.when(n < least, F.array(c)).when(two & (n >= least + 2), twice).otherwise(_cuts(c))


def _worded(texts: DataFrame, phrases: DataFrame, keys: Sequence[str]) -> DataFrame:
    """texts (list, keys, text) with their tokens (words); a run of tokens that is a phrase of the list becomes one token, longer phrases first."""
    t = texts.select("list", *keys, tokens(fold(F.col("text"))).alias("ts"))
    sizes = sorted(r.n for r in phrases.select("n").distinct().collect())  # as many as there are lengths in words
    if not sizes:
        return t.withColumnRenamed("ts", "words")

    def runs(n: int) -> Column:
        """The places of the runs of n tokens."""
        at = F.transform(F.sequence(F.lit(1), F.size("ts") - n + 1), lambda i: F.struct(i.alias("i"), F.lit(n).alias("n")))
        return F.when(F.size("ts") >= n, at).otherwise(F.array().cast("array<struct<i:int,n:int>>"))

    at = F.flatten(F.array(*map(runs, sizes)))
    grams = t.select("list", *keys, "ts", F.explode(at).alias("at")).select("list", *keys, F.array_join(F.slice("ts", F.col("at.i"), F.col("at.n")), " ").alias("phrase"), "at.i", "at.n")
    met = grams.join(small_or_shuffled(phrases.drop("n"), MAX_BROADCAST), ["list", "phrase"]).groupBy("list", *keys)
    met = met.agg(F.array_sort(F.collect_set(F.struct((-F.length("phrase")).alias("size"), "i", "n"))).alias("met"))
    apart = lambda kept, m: ~F.exists(kept, lambda k: (k["i"] < m["i"] + m["n"]) & (m["i"] < k["i"] + k["n"]))
    kept = F.aggregate("met", F.array().cast("array<struct<size:int,i:int,n:int>>"), lambda acc, m: F.when(apart(acc, m), F.concat(acc, F.array(m))).otherwise(acc))
    t = t.join(met.withColumn("kept", kept).drop("met"), [*("list", *keys)], "left")

    def word(x: Column, i: Column) -> Column:
        start = F.filter("kept", lambda k: k["i"] == i + 1)
        inside = F.exists("kept", lambda k: (k["i"] < i + 1) & (i + 1 < k["i"] + k["n"]))
        return F.when(F.size(start) > 0, F.array_join(F.slice("ts", i + 1, start[0]["n"]), "")).when(~inside, x)

    joined = F.filter(F.transform("ts", word), lambda x: x.isNotNull())
    return t.select("list", *keys, F.when(F.col("kept").isNull(), F.col("ts")).otherwise(joined).alias("words"))


@dataclass(frozen=True)
class Lists:
    """Reference lists made ready: entries (list, entry_id, need, context, open_context), vocabulary and parts of its words."""

    entries: DataFrame
    vocab: DataFrame
    parts: DataFrame
    phrases: DataFrame
    longest: int

    @staticmethod
    def of(entries: DataFrame, rules: Mapping[str, Rules]) -> Lists:
        plain = F.array_join(tokens(fold(F.col("c"))), " ")
        phrases = entries.select("list", F.explode("context").alias("c")).select("list", plain.alias("phrase")).filter("phrase like '% %'").distinct()
        phrases = stored(phrases.withColumn("n", F.size(F.split("phrase", " "))))
        said = F.concat(F.array(F.struct(F.lit(True).alias("need"), F.col("name").alias("text"))), F.transform("context", lambda c: F.struct(F.lit(False).alias("need"), c.alias("text"))))
        texts = entries.select("list", "entry_id", "open_context", F.explode(said).alias("x")).select("list", "entry_id", "open_context", "x.need", "x.text")
        words = stored(_worded(texts, phrases, ["entry_id", "open_context", "need", "text"]).select("list", "entry_id", "open_context", "need", F.explode("words").alias("word")).distinct())
        needed = words.filter("need")
        n = needed.groupBy("list").agg(F.count_distinct("entry_id").alias("n"))
        df = needed.groupBy("list", "word").agg(F.count_distinct("entry_id").alias("df"))
        weight = df.join(F.broadcast(n), "list").select("list", "word", "df", (F.ln((1 + F.col("n")) / F.col("df")) + 0.1).alias("w"))  # a row per list
        need, context = F.when(F.col("need"), F.struct("df", "word", "w")), F.when(~F.col("need"), F.col("word"))
        full = words.join(weight, ["list", "word"], "left").groupBy("list", "entry_id").agg(
            F.array_sort(F.collect_set(need)).alias("need"), F.collect_set(context).alias("context"), F.max("open_context").alias("open_context")
        )
        spark = entries.sparkSession
        filler = spark.createDataFrame([(name, w) for name, r in rules.items() for w in r.filler], "list string, word string")
        vocab = words.select("list", "word", (~F.col("need")).alias("ctx"), F.lit(False).alias("filler")).unionByName(filler.select("list", "word", F.lit(False).alias("ctx"), F.lit(True).alias("filler")))
        vocab = stored(vocab.groupBy("list", "word").agg(F.max("ctx").alias("ctx"), F.max("filler").alias("filler")))
        begins = F.coalesce(_per_list(rules, lambda r: F.lit(r.beginnings)), F.lit(False)) & (F.length("word") >= 5)
        starts = F.when(begins, F.transform(F.sequence(F.lit(3), F.length("word") - 1), lambda k: F.struct(F.substring("word", F.lit(1), k).alias("part"), F.lit(True).alias("begins"))))
        cut = F.transform(_parts("word", 4, rules), lambda p: F.struct(p.alias("part"), F.lit(False).alias("begins")))
        parts = stored(vocab.select("list", F.struct("word", "ctx", "filler").alias("x"), F.explode(F.concat(cut, F.coalesce(starts, F.array().cast("array<struct<part:string,begins:boolean>>")))).alias("p")).select("list", "p.part", "p.begins", "x"))
        longest = vocab.agg(F.coalesce(F.max(F.length("word")), F.lit(0))).first()[0]
        return Lists(stored(full.filter(F.size("need") > 0)), small_or_shuffled(vocab.select("list", "word", F.struct("word", "ctx", "filler").alias("x")), MAX_BROADCAST), small_or_shuffled(parts, MAX_BROADCAST), phrases, longest)


def repairs(toks: DataFrame, lists: Lists, rules: Mapping[str, Rules]) -> DataFrame:
    """(list, tok, alts): for each distinct token the word sequences it may stand for, with a similarity. toks has (list, tok), distinct.

    A token that is a word or a short form is only that; else the words at one edit, then
    those at two (where the list allows two); else beginnings and two words typed as one, of
    which one must be exact and the other at one edit at most. Of tokens and words that are
    an edit apart the token has 3 and the word 4 characters at least, for two edits 5 and 6.
    Tokens longer than two words and one more character can't be two words. Tokens without
    any reading are not in the result.
    """
    reading = lambda sim, *xs: F.struct(F.array(*xs).alias("seq"), sim.alias("sim"))
    short = _per_list(rules, lambda r: F.element_at(F.create_map(*[F.lit(x) for kv in r.short.items() for x in kv]), F.col("tok")) if r.short else None)
    asked = F.filter(F.array(F.struct(F.col("tok").alias("word"), F.lit(1.0).alias("sim")), F.struct(short.cast("string").alias("word"), F.lit(SHORT_FORM).alias("sim"))), lambda a: a["word"].isNotNull())
    known = toks.select("list", "tok", F.explode(asked).alias("a")).select("list", "tok", "a.word", "a.sim").join(lists.vocab, ["list", "word"], "left")
    known = stored(known.groupBy("list", "tok").agg(F.collect_set(F.when(F.col("x").isNotNull(), reading(F.col("sim"), F.col("x")))).alias("alts")))
    unknown = known.filter(F.size("alts") == 0)
    met = unknown.filter(F.length("tok") >= 3).select("list", "tok", F.explode(_parts("tok", 3, rules)).alias("part")).join(lists.parts, ["list", "part"]).filter("not begins")
    met = met.filter((F.length("x.word") >= 4) & (F.levenshtein("tok", "x.word") <= 4)).select("list", "tok", "x.*").distinct()
    met = met.mapInArrow(_distances, "list string, tok string, word string, ctx boolean, filler boolean, d int")
    two = F.coalesce(_per_list(rules, lambda r: F.lit(r.edits == 2)), F.lit(False)) & (F.length("tok") >= 5) & (F.length("word") >= 6)
    met = met.filter((F.col("d") == 1) | ((F.col("d") == 2) & two))
    near = met.groupBy("list", "tok").agg(F.min("d").alias("least"), F.collect_set(F.struct("d", reading(1 - F.col("d") / F.length("word"), F.struct("word", "ctx", "filler")).alias("r"))).alias("all"))
    near = near.select("list", "tok", F.transform(F.filter("all", lambda a: a["d"] == F.col("least")), lambda a: a["r"]).alias("near"))
    read = stored(unknown.drop("alts").join(near, ["list", "tok"], "left"))
    rest = read.filter("near is null").select("list", "tok")
    # Beginnings have their own rows among the parts; they go through the same join as the other halves of tokens.
    starts = rest.select("list", "tok", F.col("tok").alias("part")).join(lists.parts, ["list", "part"]).filter("begins").select("list", "tok", reading(F.lit(BEGINNING), F.col("x")).alias("r"))
    cut = F.transform(F.sequence(F.lit(1), F.length("tok") - 1), lambda i: F.struct(F.substring("tok", F.lit(1), i).alias("l"), F.substring("tok", i + 1, F.length("tok")).alias("r")))
    halves = rest.filter(F.length("tok").between(4, 2 * lists.longest + 1)).select("list", "tok", F.explode(cut).alias("p"))
    ways = F.array(F.struct(F.col("p.l").alias("word"), F.col("p.r").alias("half"), F.lit(True).alias("first")), F.struct(F.col("p.r").alias("word"), F.col("p.l").alias("half"), F.lit(False).alias("first")))
    halves = halves.select("list", "tok", F.explode(ways).alias("w")).select("list", "tok", "w.*")
    # Single letters would let any typo pass as two words.
    halves = halves.filter(F.length("half") >= 2).join(lists.vocab, ["list", "word"]).select("list", "tok", "half", "first", F.col("x").alias("y"))
    one = F.when(F.length("half") < 3, F.array("half")).otherwise(_cuts(F.col("half")))
    both = halves.withColumn("part", F.explode(one)).join(lists.parts, ["list", "part"]).filter("not begins")
    d, chars = F.levenshtein("half", "x.word"), lambda c: F.array_sort(F.split(c, ""))
    exact = F.col("half") == F.col("x.word")
    # A swap is two edits to Levenshtein; the two then leave the same part and have the same characters.
    close = (F.length("x.word") >= 4) & ((d == 1) | ((d == 2) & (chars("half") == chars("x.word"))))
    both = both.filter(exact | close).withColumn("exact", exact)
    sim = F.when(F.col("exact"), F.lit(1.0)).otherwise(1 - 1 / F.length("x.word")) * RUN_TOGETHER
    both = both.groupBy("list", "tok", "half", "first", "y").agg(F.max("exact").alias("sure"), F.collect_set(F.struct("exact", "x", sim.alias("sim"))).alias("xs"))
    both = both.select("list", "tok", "first", "y", F.explode(F.filter("xs", lambda a: a["exact"] == F.col("sure"))).alias("a"))
    pair = F.when(F.col("first"), reading(F.col("a.sim"), F.col("y"), F.col("a.x"))).otherwise(reading(F.col("a.sim"), F.col("a.x"), F.col("y")))
    late = starts.unionByName(both.select("list", "tok", pair.alias("r"))).groupBy("list", "tok").agg(F.collect_set("r").alias("alts"))
    return known.filter(F.size("alts") > 0).unionByName(read.filter("near is not null").select("list", "tok", F.col("near").alias("alts"))).unionByName(late)


def map_lists(values: DataFrame, entries: DataFrame, rules: Mapping[str, Rules]) -> DataFrame:
    """(list, value, entry_id, score) of the values (list, value) that mean an entry of their list; other values have no row.

    entries: (list, entry_id, name, context array<string>, open_context boolean). name's words
    must all be in the value; context words may be (any context word of the list, if
    open_context). Null and empty values mean none, so does a value for which two entries
    rank highest. rules has the rules of each list.
    """
    lists = Lists.of(entries, rules)
    texts = values.filter("value is not null").select("list", "value").distinct().withColumn("text", F.col("value"))
    v = stored(_worded(texts, lists.phrases, ["value"]).select("list", "value", F.explode("words").alias("tok")))
    alts = stored(repairs(v.select("list", "tok").distinct(), lists, rules))
    read = v.join(small_or_shuffled(alts, MAX_BROADCAST // 4), ["list", "tok"], "left")
    # A record of each value: its tokens with their readings.
    val = read.groupBy("list", "value").agg(F.collect_list(F.struct("tok", F.coalesce("alts", F.array().cast(alts.schema["alts"].dataType)).alias("alts"))).alias("toks"))
    # An entry needs all its words, so its rarest word finds it.
    e = small_or_shuffled(lists.entries, MAX_BROADCAST // 4).withColumn("word", F.col("need")[0]["word"])
    found = F.array_distinct(F.flatten(F.flatten(F.transform("toks", lambda t: F.transform(t["alts"], lambda a: F.transform(a["seq"], lambda s: s["word"]))))))
    both = val.withColumn("word", F.explode(found)).join(e, ["list", "word"]).withColumn("need_words", F.transform("need", lambda x: x["word"]))

    fits = lambda a: F.forall(a["seq"], lambda s: s["filler"] | F.array_contains("need_words", s["word"]) | F.array_contains("context", s["word"]) | (F.col("open_context") & s["ctx"]))
    idle = lambda t: F.coalesce(_per_list(rules, lambda r: t.rlike(r.idle) if r.idle else None), F.lit(False))
    both = both.filter(~F.exists("toks", lambda t: ~(idle(t["tok"]) | F.exists(t["alts"], fits))))
    both = both.withColumn("readings", F.filter(F.flatten(F.transform("toks", lambda t: t["alts"])), fits))
    has = lambda a, w: F.exists(a["seq"], lambda s: s["word"] == w)
    sim = lambda w: F.aggregate("readings", F.lit(0.0), lambda m, a: F.when(has(a, w), F.greatest(m, a["sim"])).otherwise(m))
    both = both.withColumn("sims", F.transform("need", lambda x: F.struct(x["w"].alias("w"), sim(x["word"]).alias("s"))))
    total = lambda f: F.aggregate("sims", F.lit(0.0), lambda m, x: m + f(x))
    score = F.round(total(lambda x: x["w"] * x["w"] * x["s"]) / total(lambda x: x["w"] * x["w"]), 9)
    scored = both.filter(F.forall("sims", lambda x: x["s"] > 0)).select("list", "value", "entry_id", score.alias("score"))
    # The least and the greatest entry of the highest score: one entry, if they are the same.
    top = scored.groupBy("list", "value").agg(F.max(F.struct("score", "entry_id")).alias("hi"), F.min(F.struct((-F.col("score")).alias("score"), "entry_id")).alias("lo"))
    return top.filter("hi.entry_id = lo.entry_id").select("list", "value", "hi.entry_id", "hi.score")


def map_values(values: DataFrame, entries: DataFrame, rules: Rules) -> DataFrame:
    """(value, entry_id, score) of each distinct value, for one list; entry_id is null if none is meant."""
    one = F.lit("list")
    found = map_lists(values.select(one.alias("list"), "value"), entries.withColumn("list", one), {"list": rules}).drop("list")
    return values.select("value").distinct().join(found, "value", "left")


def place_entries(ref: DataFrame) -> DataFrame:
    """Entries of a place list: the city (or, without one, the name) with its state and country as context."""
    named = F.coalesce("city", "location_name")
    ctx = F.filter(F.array("state_code", "state", "country", "country_code", F.when(F.col("country_code") == "GB", F.lit("uk")), F.when(F.col("country_code") == "UK", F.lit("gb"))), lambda x: x.isNotNull())
    return ref.select(F.col("location_id").alias("entry_id"), named.alias("name"), ctx.alias("context"), F.col("country").isNull().alias("open_context"))


def keyword_entries(ref: DataFrame) -> DataFrame:
    return ref.select(F.col("keyword_ref_id").alias("entry_id"), F.col("keyword_name").alias("name"), F.array().cast("array<string>").alias("context"), F.lit(False).alias("open_context"))


def mapped(rows: DataFrame, mapping: DataFrame, on: Sequence[str] = ("value",), keep: Sequence[str] = ("record_id",)) -> DataFrame:
    """The columns keep of rows with the ref_id meant, 'NONE' if none is; rows with null values included."""
    j = rows.select(*keep, *on).join(mapping.select(*on, "entry_id"), [*on], "left")
    return j.select(*keep, F.coalesce("entry_id", F.lit("NONE")).alias("ref_id"))
