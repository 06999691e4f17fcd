"""Linking the spellings of organisations' names.

A name is taken apart into its legal form, its kind (holdings, services, ...), the
industry words that the industry columns use as well or short forms of them, and what is
left: the tokens of its proper part.

Suffix blocking finds proper parts that may be the same. Indexed are the suffixes of every
proper token and of all of them put together (as blanks and hyphens come and go), of two
lengths, and the same of each read backwards, so that a typo at either end leaves one of
them. Suffixes are far too common by themselves; as two spellings are linked only if their
industry or city agree, long suffixes are refined by one of these and short ones by
several fields. A block that is overly common even so is refined by each further field
that is known and by a longer suffix, round by round; what is too common in the last round
is discarded. Names of equal proper parts and fields are one node and need no block.

Pairs are compared by the ratio of their longest common subsequence, in the order typed
or with sorted tokens, whichever is closer, so that reordered parts meet. The ratio may be
lower the more fields agree; links that any field contradicts are dropped. Links are
closed to groups. A name without industry that no field links joins a group only if no
other group fits its spelling, and so do names without industry that only their city
links, together.

Records that don't differ in any of these fields are one node, so that an organisation
with very many records costs no more than one with few.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallyforge.functions.fold import fold, tokens
from tallyforge.session import small_or_shuffled, stored

#: Lengths of the suffixes, and the fields that refine them. The shortest length is also the least of an indexed token.
BLOCKS = ((5, "industry"), (5, "city"), (3, "industry city"), (3, "industry legal kind"))
#: Nodes of a block beyond which it is refined, characters by which its suffix then grows, and how often.
OVERLY_COMMON, GROWTH, ROUNDS = 400, 3, 4
#: Keys that must use a short form of an industry word, and their least share of all keys that use it.
SHORT_FORM_KEYS, SHORT_FORM_SHARE = 2, 0.5
#: Least ratios with one, two, and three or more agreeing fields.
RATIOS = (0.9, 0.84, 0.78)
#: Industry words up to which they're broadcast.
MAX_INDUSTRY_WORDS = 100_000

# Legal forms, kinds of company, words that don't count.
LEGAL = {
    "inc": "inc", "incorporated": "inc", "corp": "corp", "corporation": "corp", "co": "co", "company": "co", "ltd": "ltd", "limited": "ltd",
    "llc": "llc", "plc": "plc", "gmbh": "gmbh", "ag": "ag", "sa": "sa", "lp": "lp", "llp": "llp", "bv": "bv", "srl": "srl", "spa": "spa",
}
KIND = {
    "holdings": "holdings", "holding": "holdings", "hldgs": "holdings", "partners": "partners", "ptnrs": "partners", "sons": "sons",
    "solutions": "solutions", "solns": "solutions", "technologies": "technologies", "technology": "technologies", "techs": "technologies",
    "tech": "technologies", "services": "services", "service": "services", "serv": "services", "svcs": "services", "svc": "services",
    "international": "international", "intl": "international", "consulting": "consulting", "cons": "consulting", "group": "group",
    "grp": "group", "gp": "group", "systems": "systems", "sys": "systems", "manufacturing": "manufacturing", "mfg": "manufacturing",
    "associates": "associates", "assoc": "associates", "assocs": "associates",
}
IDLE = ("the", "and", "of", "a", "und", "y", "et")
NOTHING = ("unknown", "n a", "na", "tbd", "tba", "not provided", "null", "none", "nil", "not available", "not specified", "unspecified", "not known", "undisclosed", "")


def _map(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def _plain(c: Column) -> Column:
    return F.array_join(tokens(fold(c)), " ")


def _said(c: Column) -> Column:
    p = _plain(c)
    return F.when(~p.isin(*NOTHING), p)


def name_tokens(c: Column) -> Column:
    """Tokens of a name; dots and apostrophes within short forms (L.L.C., Int'l) don't divide."""
    return tokens(F.regexp_replace(fold(c), "[.'\\u2019`]", ""))


def industry_words(records: DataFrame) -> DataFrame:
    """(tok, word): the words of the industry columns, and short forms of them that names use in their place.

    A token is a short form of the one word that most of its keys have as industry if it
    begins like that word, its letters stand in the word in their order, and the names don't
    have the word itself.
    """
    industry = F.filter(tokens(_said(F.col("industry"))), lambda x: ~x.isin(*KIND, *LEGAL, *IDLE) & (F.length(x) >= 3))
    r = records.select("key", F.array_distinct(name_tokens(F.col("name"))).alias("toks"), industry.alias("words"))
    words = stored(r.select(F.explode("words").alias("word")).distinct())
    used = r.filter(F.size("words") > 0).select("key", "toks", "words", F.explode("toks").alias("tok")).filter(~F.col("tok").isin(*KIND, *LEGAL, *IDLE) & (F.length("tok") >= 2))
    fits = lambda w: (F.substring(w, 1, 1) == F.substring("tok", 1, 1)) & (F.length(w) > F.length("tok")) & (F.levenshtein(w, F.col("tok")) == F.length(w) - F.length("tok"))
    meant = F.filter("words", lambda w: fits(w) & ~F.array_contains("toks", w))
    per = used.select("key", "tok", F.explode_outer(meant).alias("word")).groupBy("tok", "word").agg(F.count_distinct("key").alias("n"))
    per = per.groupBy("tok").agg(F.sum("n").alias("all"), F.max(F.when(F.col("word").isNotNull(), F.struct("n", "word"))).alias("m"))
    short = per.filter((F.col("m.n") >= SHORT_FORM_KEYS) & (F.col("m.n") >= SHORT_FORM_SHARE * F.col("all"))).select("tok", "m.word")
    short = short.join(words.select(F.col("word").alias("tok")), "tok", "left_anti")
    return words.select(F.col("word").alias("tok"), "word").unionByName(short)


def parsed(records: DataFrame) -> DataFrame:
    """Distinct names with their proper tokens (toks), those put together (core) and sorted (ordered), and industry, kind and legal (null where the name doesn't say)."""
    words = small_or_shuffled(stored(industry_words(records)), MAX_INDUSTRY_WORDS)
    names = records.select("name").filter("name is not null").distinct()
    t = names.select("name", F.posexplode(F.filter(name_tokens(F.col("name")), lambda x: ~x.isin(*IDLE))).alias("i", "tok")).join(words, "tok", "left")
    legal, kind = F.element_at(_map(LEGAL), F.col("tok")), F.element_at(_map(KIND), F.col("tok"))
    t = t.withColumns({"legal": legal, "kind": kind})
    proper = F.when(F.col("legal").isNull() & F.col("kind").isNull() & F.col("word").isNull(), F.struct("i", "tok"))
    p = t.groupBy("name").agg(F.array_sort(F.collect_list(proper)).alias("parts"), F.min("word").alias("industry"), F.min("kind").alias("kind"), F.min("legal").alias("legal"))
    # A name of common words only is its own proper part.
    p = p.withColumn("toks", F.when(F.size("parts") > 0, F.transform("parts", lambda x: x["tok"])).otherwise(name_tokens(F.col("name"))))
    return p.select("name", "toks", F.array_join("toks", "").alias("core"), F.array_join(F.array_sort("toks"), "").alias("ordered"), "industry", "kind", "legal").filter("core <> ''")


def _common(a: str, b: str) -> float:
    """The ratio of the longest common subsequence to the mean length."""
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | 1 << i
    mask = (1 << len(a)) - 1
    v = mask
    for ch in b:
        u = v & at.get(ch, 0)
        v = ((v + u) | (v - u)) & mask
    return 2 * (len(a) - v.bit_count()) / (len(a) + len(b))


def _lcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the ratio of cores as typed or of sorted tokens, whichever is greater."""
    for batch in batches:
        a, b, x, y = (batch.column(c).to_pylist() for c in ("core_a", "core_b", "ordered_a", "ordered_b"))
        out = [max(_common(p, q), _common(r, s) if (r, s) != (p, q) else 0.0) for p, q, r, s in zip(a, b, x, y, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names=[*batch.schema.names, "ratio"])


FIELDS = ("industry", "city", "legal", "kind")


def _suffix() -> Column:
    """The end of a text of the given size, or of the text read backwards."""
    text = F.when(F.col("mirrored"), F.reverse("text")).otherwise(F.col("text"))
    return F.concat(F.when(F.col("mirrored"), "<").otherwise(">"), F.substr(text, F.greatest(F.length("text") - F.col("size") + 1, F.lit(1)), F.col("size")))


def _keyed(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """rows with their block: the suffix and the values of the fields used; rows in which one of these is unknown have no block."""
    uses = lambda f: F.array_contains("used", f)
    known = reduce(lambda x, y: x & y, [~uses(f) | F.col(f).isNotNull() for f in fields], F.lit(True))
    return rows.filter(known).withColumn("block", F.concat_ws("\u0001", "scope", _suffix(), *[F.when(uses(f), F.concat(F.lit(f"{f}="), F.col(f))) for f in fields]))


def blocks(df: DataFrame, suffixes: Sequence[tuple[int, str]], fields: Sequence[str]) -> DataFrame:
    """df, once for each of its blocks: df has toks, core, scope (rows of different scopes never meet) and the fields.

    suffixes are sizes with the fields that refine them. Blocks of more than OVERLY_COMMON
    rows are left for finer ones.
    """
    texts = F.array_union(F.filter("toks", lambda t: F.length(t) >= min(n for n, _ in suffixes)), F.array("core"))
    ways = F.array(*[F.struct(F.lit(n).alias("size"), F.split(F.lit(f), " ").alias("used")) if f else F.struct(F.lit(n).alias("size"), F.array().cast("array<string>").alias("used")) for n, f in suffixes])
    rows = df.withColumn("text", F.explode(texts)).withColumn("way", F.explode(ways)).withColumn("mirrored", F.explode(F.array(F.lit(False), F.lit(True))))
    rows = rows.select(*df.columns, "text", "mirrored", "way.size", "way.used")
    kept = []
    for last in range(ROUNDS + 1):
        rows = _keyed(rows, fields)
        common = stored(rows.groupBy("block").count().filter(F.col("count") > OVERLY_COMMON).select("block"))
        if common.isEmpty():
            kept.append(rows)
            break
        common = small_or_shuffled(common, MAX_INDUSTRY_WORDS)
        kept.append(rows.join(common, "block", "left_anti"))
        if last == ROUNDS:
            break
        # Each further field that is known, and a longer suffix, whatever the fields.
        more = F.array(*[F.when(~F.array_contains("used", f) & F.col(f).isNotNull(), F.struct(F.col("size"), F.array_sort(F.array_append("used", F.lit(f))).alias("used"))) for f in fields], F.when(F.length("text") > F.col("size"), F.struct((F.col("size") + GROWTH).alias("size"), F.col("used"))))
        rows = rows.join(common, "block", "left_semi").drop("block").withColumn("way", F.explode(F.filter(more, lambda x: x.isNotNull()))).drop("size", "used").select(*df.columns, "text", "mirrored", "way.size", "way.used")
        rows = stored(rows.distinct())
    return reduce(DataFrame.unionByName, [k.select(*df.columns, "block") for k in kept]).distinct()


def _close(met: DataFrame, least: tuple[float, ...] = RATIOS) -> DataFrame:
    """The rows of met (columns ending in _a and _b, agree) whose proper parts are close enough."""
    longest = F.greatest(F.length("core_a"), F.length("core_b"))
    # Edits beyond this keep the ratio below the least one.
    within = lambda c: F.levenshtein(f"{c}_a", f"{c}_b") <= F.ceil(2 * (1 - least[-1]) * longest)
    met = met.filter(within("core") | within("ordered"))
    ratio = met.mapInArrow(_lcs, StructType([*met.schema.fields, StructField("ratio", DoubleType())]))
    enough = F.when(F.col("agree") >= 3, least[2]).when(F.col("agree") == 2, least[1]).otherwise(least[0])
    return ratio.filter(F.col("ratio") >= enough)


def _pairs(nodes: DataFrame) -> DataFrame:
    """(a, b): representatives of nodes that meet in a block, with no field against them and proper parts that are close enough."""
    rows = blocks(nodes.withColumn("scope", F.lit("")), BLOCKS, FIELDS).drop("toks", "scope")
    side = lambda x: rows.select("block", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "rep", "core", "ordered", *FIELDS)])
    same = lambda c: F.coalesce(F.col(f"{c}_a") == F.col(f"{c}_b"), F.lit(False))
    apart = reduce(lambda x, y: x | y, [F.coalesce(F.col(f"{c}_a") != F.col(f"{c}_b"), F.lit(False)) for c in FIELDS])
    agree = reduce(lambda x, y: x + y, [same(c).cast("int") for c in FIELDS])
    met = side("a").join(side("b"), "block").filter((F.col("node_a") < F.col("node_b")) & ~apart & (same("industry") | same("city")))
    met = met.select("rep_a", "rep_b", "core_a", "core_b", "ordered_a", "ordered_b", agree.alias("agree")).distinct()
    return _close(met).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).filter("a <> b")


def _fitting(lone: DataFrame, settled: DataFrame) -> DataFrame:
    """(node, lo, hi): the least and greatest group that fits each lone node: settled (spellings with org) of the same city, if both have one, and no other legal form or kind.

    Spellings are reduced to the groups at their ends before they are compared, by city for
    nodes with a city and over all cities for those without.
    """
    what = ["toks", "core", "ordered", "legal", "kind"]
    ends = lambda by, scope: settled.groupBy(*what, *by).agg(F.min("org").alias("lo"), F.max("org").alias("hi")).select(*what, scope.alias("scope"), "lo", "hi", F.lit(None).cast("string").alias("node"))
    there = ends(["city"], F.coalesce(F.concat(F.lit("in "), F.col("city")), F.lit("nowhere"))).unionByName(ends([], F.lit("anywhere")))
    where = F.when(F.col("city").isNull(), F.array(F.lit("anywhere"))).otherwise(F.array(F.concat(F.lit("in "), F.col("city")), F.lit("nowhere")))
    asked = lone.select(*what, F.explode(where).alias("scope"), F.lit(None).cast("string").alias("lo"), F.lit(None).cast("string").alias("hi"), "node").distinct()
    rows = blocks(there.unionByName(asked), ((BLOCKS[0][0], ""),), ("legal", "kind")).drop("toks", "scope")
    side = lambda x, is_asked, *more: rows.filter(F.col("node").isNotNull() == is_asked).select("block", *more, *[F.col(c).alias(f"{c}_{x}") for c in ("core", "ordered", "legal", "kind")])
    apart = lambda c: F.coalesce(F.col(f"{c}_a") != F.col(f"{c}_b"), F.lit(False))
    met = side("a", True, "node").join(side("b", False, "lo", "hi"), "block").filter(~apart("legal") & ~apart("kind"))
    met = met.select("node", "core_a", "core_b", "ordered_a", "ordered_b", "lo", "hi", F.lit(1).alias("agree")).distinct()
    return _close(met, (RATIOS[0],) * 3).groupBy("node").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def components(edges: DataFrame) -> DataFrame:
    """(v, label): the least vertex of each vertex's component; edges (a, b) of strings.

    Labels go to neighbours and then jump to their label's label; each round is stored.
    As labels only fall, it ends: when a round changes nothing, which takes about as many
    rounds as the logarithm of the longest chain.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct())
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("label")))
    while True:
        seen = both.join(labels.withColumnRenamed("v", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(seen, F.col("v") == F.col("a"), "left").select("v", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("v").alias("new"), F.col("label").alias("further"))
        after = stored(step.join(jump, "new", "left").select("v", F.least("new", "further").alias("label"), (F.least("new", "further") != F.col("label")).alias("changed")))
        if after.filter("changed").isEmpty():
            return after.select("v", "label")
        labels = after.select("v", "label")


def linked_names(records: DataFrame) -> DataFrame:
    """(key, org): the organisation of each key, named by its least key; records are (key, name, industry, city).

    Null keys and names take no part, nor do names without a letter or digit; a key of
    such names only has no row. Null, blank and unknown industries and cities are
    missing: they neither link nor part. A key's field is its most frequent one.
    """
    records = records.select("key", "name", "industry", "city").filter("key is not null and name is not null")
    names = parsed(records)
    said = F.element_at(tokens(_said(F.col("industry"))), 1)
    r = records.select("key", "name", F.when(F.size(tokens(_said(F.col("industry")))) > 0, said).alias("col_industry"), _said(F.col("city")).alias("city")).distinct()
    r = stored(r.join(names, "name"))
    most = lambda c: F.mode(c, deterministic=True)
    of_key = r.groupBy("key").agg(most(F.coalesce("industry", "col_industry")).alias("industry"), most("city").alias("city"), most("legal").alias("legal"), most("kind").alias("kind"))
    spelt = r.select("key", "toks", "core", "ordered").distinct().join(of_key, "key")
    node = F.md5(F.concat_ws("\u0001", F.array_join("toks", " "), *[F.coalesce(c, F.lit("\u0002")) for c in FIELDS]))
    spelt = stored(spelt.withColumn("node", node))
    nodes = stored(spelt.groupBy("node", "toks", "core", "ordered", *FIELDS).agg(F.min("key").alias("rep")))
    rep = nodes.select("node", "rep")
    across = _pairs(nodes)
    bare = F.col("industry").isNull() & F.col("city").isNull()
    within = spelt.filter(~bare).join(rep, "node").select(F.col("key").alias("a"), F.col("rep").alias("b"))
    keys = spelt.select("key").distinct()
    labels = stored(keys.join(components(across.unionByName(within)), F.col("key") == F.col("v"), "left").select("key", F.coalesce("label", "key").alias("org")))
    # Names that nothing but their spelling places.
    told = spelt.groupBy("key").agg(F.max("industry").alias("told"))
    alone = labels.join(told, "key").groupBy("org").agg(F.count("*").alias("n"), F.max("told").alias("told")).filter("told is null").select("org", "n")
    lone = stored(spelt.join(labels.join(alone, "org"), "key"))
    placed = stored(_fitting(lone.select("node", "toks", "core", "ordered", "legal", "kind", "city"), spelt.filter("industry is not null").join(labels, "key")))
    # One group fits: that one. None: those of one spelling are together. Several: each stays alone.
    moved = lone.filter("n > 1").join(placed, "node").groupBy("org").agg(F.min("lo").alias("moved"), F.max("hi").alias("hi")).filter("moved = hi").select("org", "moved")
    own = lone.filter("n = 1").join(placed, "node", "left").join(rep, "node")
    own = own.withColumn("to", F.when(F.col("lo") == F.col("hi"), F.col("lo")).when(F.col("lo").isNull() & bare, F.col("rep")).otherwise(F.col("key")))
    own = own.groupBy("key").agg(F.min("to").alias("x"), F.max("to").alias("y")).select("key", F.when(F.col("x") == F.col("y"), F.col("x")).otherwise(F.col("key")).alias("placed"))
    return labels.join(own, "key", "left").join(moved, "org", "left").select("key", F.coalesce("placed", "moved", "org").alias("org"))


def key_pairs(orgs: DataFrame) -> DataFrame:
    """(key_a, key_b), smaller first: every two keys of one organisation."""
    a, b = orgs.select(F.col("key").alias("key_a"), "org"), orgs.select(F.col("key").alias("key_b"), "org")
    return a.join(b, "org").filter("key_a < key_b").select("key_a", "key_b")
