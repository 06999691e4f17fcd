"""Long exact spans shared between records, and what is left of records without their repeats.

Runs of sentences are hashed and joined globally, with two changes that exactness
needs. Sentences are cut by content, not by punctuation: a shared run may begin and
end within a sentence, and a sentence may be longer than the run. So the cuts are the
places of least hash (winnowing): every run of min_chars characters holds, wherever it
stands, a span of half that length, an anchor, that is cut in all records alike. And the
ends of a run are found to the character. Around an anchor that stands in more than one
record lies its context, all windows of min_chars characters that hold the anchor. Records
with the same context share all of it at once, as one interval; that is so all through the
inside of a repeated passage. Only where contexts of an anchor differ, at the ends of
passages, their windows are hashed one by one, once for each different context and once
for each record that is alone with its context. A character is shared if it lies in a
window that also stands in another record.

Joins are on hashes of single spans; no pairs of records are made, so a passage that a
third of the records share costs no more than its anchors. Whole copies are collapsed to
one text before all that. Contexts and windows are the same if two hashes of 64 bits are.

The first record, by id, that has a window keeps it; in the others it's a repeat. Sentences
that lie in repeats are removed by kept().
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.session import release, stored

MIN_CHARS = 200
#: Multipliers of the rolling hash (odd) and of its finish.
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX[0]
        x = (x ^ (x >> np.uint64(27))) * MIX[1]
        return x ^ (x >> np.uint64(31))


def _inverse(a: int) -> int:
    return pow(a, -1, 1 << 64)


class Hasher:
    """Hashes of spans of a text, from one pass of prefix sums."""

    def __init__(self, base: np.uint64 = BASES[0]) -> None:
        self.base = base
        self._up = self._down = np.ones(1, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            with np.errstate(over="ignore"):
                m = max(n, 2 * len(self._up))
                b = np.full(m, self.base)
                b[0] = 1
                self._up = np.multiply.accumulate(b)
                b[1:] = np.uint64(_inverse(int(self.base)))
                self._down = np.multiply.accumulate(b)
        return self._up[:n], self._down[:n]

    def prefix(self, codes: np.ndarray) -> np.ndarray:
        up, _ = self.powers(len(codes))
        out = np.zeros(len(codes) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_mix(codes.astype(np.uint64) + np.uint64(1)) * up, out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, starts: np.ndarray, sizes: int | np.ndarray) -> np.ndarray:
        _, down = self.powers(len(prefix))
        with np.errstate(over="ignore"):
            return _mix((prefix[starts + sizes] - prefix[starts]) * down[starts] + np.asarray(sizes).astype(np.uint64))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _slide(x: np.ndarray, w: int, op) -> np.ndarray:
    """op over every window of w values, by doubling."""
    size = 1
    while size < w:
        step = min(size, w - size)
        x = op(x[:-step], x[step:])
        size += step
    return x


#: Characters that are hashed at once, so that short texts cost no call each and memory stays bounded; a longer text goes by itself.
AT_ONCE = 1 << 19


class Texts:
    """Some texts put together, with the place where each begins."""

    def __init__(self, rows: list[tuple], texts: list[str]) -> None:
        self.rows = rows
        self.codes = _codes("".join(texts))
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.of = np.repeat(np.arange(len(texts)), self.sizes)

    @staticmethod
    def batches(b: pa.RecordBatch) -> Iterator[Texts]:
        """Texts of column 1 and rows of the other columns, in portions."""
        columns = [c.to_pylist() for c in b.columns]
        rows, texts, n = [], [], 0
        for row in zip(*columns, strict=True):
            rows.append((row[0], *row[2:]))
            texts.append(row[1])
            n += len(row[1])
            if n >= AT_ONCE:
                yield Texts(rows, texts)
                rows, texts, n = [], [], 0
        if rows:
            yield Texts(rows, texts)

    def within(self, starts: np.ndarray, size: int) -> np.ndarray:
        """Whether spans of a size end in the text in which they start."""
        own = self.of[starts]
        return starts + size <= self.begins[own] + self.sizes[own]


def winnow(h: np.ndarray, w: int, whole: np.ndarray) -> np.ndarray:
    """Places that hold the least hash of some window of w places; whole tells by its start whether a window counts."""
    least = np.where(whole, _slide(h, w, np.minimum), np.uint64(0))
    pad = np.zeros(w - 1, np.uint64)
    return np.nonzero(_slide(np.concatenate([pad, least, pad]), w, np.maximum) == h)[0]


ANCHOR = "doc_id long, at int, lo int, hi int, h long, c long, e long, l long, r long"


def _anchors(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """The anchors of each text (of min_chars characters or more) with their contexts: where they begin and end, two hashes, and a hash of the anchor with half of what is left and right of it."""
    one, two = (Hasher(b) for b in BASES)
    size = min_chars // 2
    around = min_chars - size
    half = around // 2
    for t in (t for b in batches for t in Texts.batches(b)):
        x, y, n = one.prefix(t.codes), two.prefix(t.codes), len(t.codes)
        at = np.arange(n - size + 1)
        inside = t.within(at, size)
        h = np.where(inside, one.spans(x, at, size), np.uint64(2**64 - 1))
        p = winnow(h, around + 1, t.within(at[: n - min_chars + 1], min_chars))
        p = p[inside[p]]
        own = t.of[p]
        begin, end = t.begins[own], t.begins[own] + t.sizes[own]
        lo, hi = np.maximum(p - around, begin), np.minimum(p + size + around, end)
        left, right = p - half, p + size + around - half
        cut_left, cut_right = left < begin, right > end
        ids = np.array([r[0] for r in t.rows], np.int64)[own]
        whole = lambda v: pa.array(v.view(np.int64))
        columns = [
            pa.array(ids), *[pa.array((v - begin).astype(np.int32)) for v in (p, lo, hi)], whole(h[p]), whole(one.spans(x, lo, hi - lo)), whole(two.spans(y, lo, hi - lo)),
            pa.array(one.spans(x, np.where(cut_left, p, left), np.where(cut_left, size, size + half)).view(np.int64), mask=cut_left),
            pa.array(one.spans(x, p, np.where(cut_right, size, right - p)).view(np.int64), mask=cut_right),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "at", "lo", "hi", "h", "c", "e", "l", "r"])


WINDOW = "doc_id long, last long, at int, c long, e long"


def _windows(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """Two hashes of the windows of min_chars characters that start near anchors: column 2 has (at, least, most, last), the window starting least to most characters before the anchor."""
    one, two = (Hasher(b) for b in BASES)
    for t in (t for b in batches for t in Texts.batches(b)):
        last = np.full(len(t.codes), np.iinfo(np.int64).min)
        for (_, places), begin, n in zip(t.rows, t.begins.tolist(), t.sizes.tolist(), strict=True):
            for x in places:
                s = slice(begin + max(0, x["at"] - x["most"]), begin + max(0, min(x["at"] - x["least"], n - min_chars) + 1))
                last[s] = np.maximum(last[s], x["last"])
        s = np.nonzero(last > np.iinfo(np.int64).min)[0]
        own = t.of[s]
        ids = np.array([r[0] for r in t.rows], np.int64)[own]
        hashes = [pa.array(k.spans(k.prefix(t.codes), s, min_chars).view(np.int64)) for k in (one, two)]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(last[s]), pa.array((s - t.begins[own]).astype(np.int32)), *hashes], names=["doc_id", "last", "at", "c", "e"])


SENTENCE = re.compile(r"[^.!?\u3002\n]*[.!?\u3002\n]*\s*")


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the sentences (with the blanks behind them) that lie in the union of spans."""
    n = len(text)
    edge = np.zeros(n + 1, np.int64)
    for lo, hi in spans:
        edge[lo] += 1
        edge[hi] -= 1
    free = np.concatenate([[0], np.cumsum(np.cumsum(edge[:n]) == 0)])
    left = []
    for m in SENTENCE.finditer(text):
        said = m.start() + max(len(m.group().rstrip()), min(len(m.group()), 1))
        if free[said] > free[m.start()]:
            left.append(m.group())
    return "".join(left)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").to_pylist()
        left = [t if not s else without(t, [(x["lo"], x["hi"]) for x in s]) for t, s in zip(texts, b.column("repeats").to_pylist(), strict=True)]
        removed = np.array([len(t or "") - len(x or "") for t, x in zip(texts, left, strict=True)], np.int64)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(left, pa.string()), pa.array(removed)], names=["doc_id", "text", "removed_chars"])


class SharedSpans:
    """What documents (doc_id, text) share with others in runs of min_chars characters (code points) or more.

    Null, empty and shorter texts share nothing; a text repeated within one document only
    is not shared. Rows with one doc_id count as one document each text; rows with a null
    doc_id share nothing. Other columns are ignored.
    """

    def __init__(self, docs: DataFrame, min_chars: int = MIN_CHARS) -> None:
        if min_chars < 2:
            raise ValueError("min_chars must be 2 or more")
        self.docs, self.min_chars = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), min_chars
        d = self.docs.filter(F.col("doc_id").isNotNull() & (F.length("text") >= min_chars)).withColumn("m", F.md5("text"))
        # Copies: the text is shared as a whole, and one document stands for all.
        groups = d.groupBy("m").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"), F.max(F.length("text")).alias("n"))
        self.copies = stored(groups.filter("rep <> last").select("m", "rep", "n"))
        self.whole = d.select("doc_id", "m").join(self.copies, "m").select("doc_id", "m", "rep", F.col("n").cast("long").alias("n")).distinct()
        self._reps = d.join(self.copies.select("m", "rep"), "m", "left").filter("rep is null or rep = doc_id").select("doc_id", "text")
        self._found: DataFrame | None = None

    def intervals(self) -> DataFrame:
        """(doc_id, lo, hi, repeated): intervals that stand in another document too, of one document for each text; repeated if the other comes before."""
        if self._found is None:
            n = self.min_chars
            anchors = stored(self._reps.mapInArrow(partial(_anchors, min_chars=n), ANCHOR))
            # Hashes are reduced to a first and a last document before the shuffle.
            twice = anchors.groupBy("h").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a <> b").select("h")
            near = stored(anchors.join(twice, "h"))
            release(anchors)
            contexts = near.groupBy("h", "c", "e").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.max("doc_id").alias("last"))
            kinds = contexts.groupBy("h").agg(F.count("*").alias("kinds"))
            contexts = contexts.join(kinds, "h").select("h", "c", "e", "first", "last", (F.col("first.doc_id") != F.col("last")).alias("several"), (F.col("kinds") > 1).alias("differ")).filter("several or differ")
            first = F.struct("doc_id", "at") == F.col("first")
            met = stored(near.join(contexts, ["h", "c", "e"]).select(
                "doc_id", "at", "lo", "hi", "l", "r", "last", "several", (F.col("doc_id") != F.col("first.doc_id")).alias("repeated"), (F.col("differ") & (~F.col("several") | first)).alias("alone")
            ))
            release(near)
            inside = met.filter(F.col("several") & (F.col("hi") - F.col("lo") >= n)).select("doc_id", "lo", "hi", "repeated")
            # One document for each context is compared with the other contexts of the anchor. A window that both have
            # reaches half of what is left of the anchor or half of what is right of it.
            alone = met.filter("alone").select("doc_id", "at", "last", "l", "r")
            around = n - n // 2
            ways = F.array(F.struct(F.lit("l").alias("side"), F.col("l").alias("x"), F.lit(around // 2).alias("least"), F.lit(around).alias("most")), F.struct(F.lit("r").alias("side"), F.col("r").alias("x"), F.lit(0).alias("least"), F.lit(around // 2 - 1).alias("most")))
            sides = stored(alone.select("doc_id", "at", "last", F.explode(ways).alias("w")).select("doc_id", "at", "last", "w.*").filter("x is not null and least <= most"))
            reached = sides.groupBy("side", "x").agg(F.min("doc_id").alias("a"), F.max("last").alias("b")).filter("a <> b").select("side", "x")
            places = sides.join(reached, ["side", "x"]).groupBy("doc_id").agg(F.collect_list(F.struct("at", "least", "most", "last")).alias("places"))
            windows = stored(self._reps.join(places, "doc_id").mapInArrow(partial(_windows, min_chars=n), WINDOW))
            release(sides)
            again = windows.groupBy("c", "e").agg(F.min("doc_id").alias("a"), F.max("last").alias("b")).filter("a <> b").select("c", "e", "a")
            ends = windows.join(again, ["c", "e"]).select("doc_id", F.col("at").alias("lo"), (F.col("at") + n).alias("hi"), (F.col("doc_id") != F.col("a")).alias("repeated"))
            self._found = inside.unionByName(ends)
        return self._found

    def shared(self) -> DataFrame:
        """(doc_id, shared_chars): the documents that share something, with how many of their characters lie in it, each counted once."""
        hits = self.intervals().groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("at"))
        # Each interval adds what lies behind all those before it.
        start = F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n"))
        total = F.aggregate("at", start, lambda s, x: F.struct(F.greatest(s["to"], x["hi"]).alias("to"), (s["n"] + F.greatest(F.lit(0), x["hi"] - F.greatest(s["to"], x["lo"]))).alias("n")), lambda s: s["n"])
        whole = self.whole.select("doc_id", F.col("n").alias("shared_chars"))
        return whole.unionByName(hits.select("doc_id", total.alias("shared_chars")).join(whole.select("doc_id"), "doc_id", "left_anti"))

    def kept(self) -> DataFrame:
        """(doc_id, text, removed_chars) of every row of docs: the text without the sentences that lie in repeats; copies of an earlier document lose all."""
        repeats = self.intervals().filter("repeated").groupBy("doc_id").agg(F.collect_set(F.struct("lo", "hi")).alias("repeats"))
        again = self.whole.filter("doc_id <> rep").select("doc_id", "m", F.array(F.struct(F.lit(0).alias("lo"), F.col("n").cast("int").alias("hi"))).alias("all"))
        d = self.docs.withColumn("m", F.md5("text")).join(again, ["doc_id", "m"], "left").join(repeats, "doc_id", "left")
        spans = F.when(F.length("text") >= self.min_chars, F.coalesce("all", "repeats"))
        return d.select("doc_id", "text", spans.alias("repeats")).mapInArrow(_kept, "doc_id long, text string, removed_chars long")


def shared_spans(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """SharedSpans(...).shared()"""
    return SharedSpans(docs, min_chars).shared()
