import random

import pytest

from tallyforge.llm.spans import SENTENCE, SharedSpans, shared_spans, without

S = "doc_id long, text string, at int, h string"


def brute(docs, least):
    seen = {}
    for i, t in docs:
        for k in range(len(t or "") - least + 1):
            seen.setdefault(t[k : k + least], set()).add(i)
    out = {}
    for i, t in docs:
        got = set()
        for k in range(len(t or "") - least + 1):
            if len(seen[t[k : k + least]]) > 1:
                got.update(range(k, k + least))
        if got:
            out[i] = len(got)
    return out


def check(make, docs, least):
    got = {r.doc_id: r.shared_chars for r in shared_spans(make(S, *[(i, t, 0, "") for i, t in docs]), least).collect()}
    assert got == brute(docs, least)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(make, seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé漢🙂 .") for _ in range(r.randint(1, 8)))
    parts = ["".join(word() for _ in range(r.randint(4, 30))) for _ in range(12)]
    docs = []
    for i in range(40):
        t = "".join(r.choice(parts) if r.random() < 0.5 else word() * r.randint(1, 3) for _ in range(r.randint(0, 9)))
        docs.append((i, t[r.randint(0, 5) :]))
    docs += [(100, docs[3][1]), (101, docs[3][1]), (102, None), (103, ""), (104, "ab" * 200), (105, "ab" * 130), (106, "-" * 300)]
    check(make, docs, 40)


def test_run_of_exactly_the_least_length(make):
    run = "".join(chr(97 + (i * i) % 26) for i in range(200))
    check(make, [(1, "XX" + run + "YY"), (2, "QQ" + run + "ZZ"), (3, "X" + run[:199] + "Y")], 200)


def test_repeats_within_one_document_are_not_shared(make):
    check(make, [(1, "abc" * 300), (2, "nothing of that kind here")], 200)


def test_empty_nulls_and_repeated_rows(make):
    assert shared_spans(make(S)).count() == 0
    t = "word " * 60
    rows = [(1, t, 0, ""), (1, t, 0, ""), (None, t, 0, "")]
    assert shared_spans(make(S, *rows)).count() == 0
    got = shared_spans(make(S, *rows, (2, t, 0, ""))).collect()
    assert {(r.doc_id, r.shared_chars) for r in got} == {(1, 300), (2, 300)}


def test_a_third_of_all_records_share_one_passage(spark, make):
    from pyspark.sql import functions as F

    passage = " ".join(f"w{i * 7919 % 1000}" for i in range(60))
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("head "), F.col("id").cast("string"), F.lit(" " + passage))).otherwise(F.sha2(F.col("id").cast("string"), 512)).alias("text"))
    got = shared_spans(d, 200)
    assert got.count() == 1000


def test_one_context_at_two_places_of_a_document(make):
    r = random.Random(5)
    part = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    u, p, v = part(300), part(230), part(300)
    check(make, [(1, u + p + v + u + p + v), (2, part(300) + p + part(300)), (3, part(900))], 200)


def test_a_document_with_two_contexts_of_one_anchor(make):
    """The only other document with the windows of the one context shares the other context whole."""
    r = random.Random(6)
    part = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    p, u, v = part(260), part(300), part(300)
    check(make, [(1, part(300) + p[:230] + part(300) + u + p + v), (2, part(250) + u + p + v + part(250)), (3, part(700))], 200)
    check(make, [(5, part(300) + p[:230] + part(300) + u + p + v), (2, part(250) + u + p + v + part(250)), (3, p[10:215])], 200)


@pytest.mark.parametrize("least", [2, 3, 7])
def test_short_runs(make, least):
    r = random.Random(least)
    check(make, [(i, "".join(r.choice("ab漢🙂") for _ in range(r.randint(0, 30)))) for i in range(12)], least)


def brute_kept(docs, least):
    """Texts without the sentences whose every character lies in a window that also stands in a document before."""
    first = {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        for k in range(len(t or "") - least + 1):
            first.setdefault(t[k : k + least], i)
    out = {}
    for i, t in docs:
        gone = {x for k in range(len(t or "") - least + 1) if first[t[k : k + least]] < i for x in range(k, k + least)}
        parts = [m for m in SENTENCE.finditer(t or "") if m.group()]
        out[i] = None if t is None else "".join(m.group() for m in parts if not {*range(m.start(), m.start() + max(1, len(m.group().rstrip())))} <= gone)
    return out


def test_repeats_are_removed_against_brute_force(make):
    r = random.Random(7)
    sentence = lambda: "".join(r.choice("abcde f") for _ in range(r.randint(5, 60))) + r.choice([". ", "! ", "\n", "。", " "])
    passages = ["".join(sentence() for _ in range(r.randint(2, 6))) for _ in range(6)]
    docs = [(i, "".join(r.choice(passages) if r.random() < 0.5 else sentence() for _ in range(r.randint(0, 7)))) for i in range(30)]
    docs += [(50, docs[4][1]), (51, docs[4][1]), (52, None), (53, ""), (54, " " + passages[0]), (55, "x")]
    rows = SharedSpans(make(S, *[(i, t, 0, "") for i, t in docs]), 40).kept().collect()
    assert {x.doc_id: x.text for x in rows} == brute_kept(docs, 40) and len(rows) == len(docs)
    text = dict(docs)
    assert all(x.removed_chars == len(text[x.doc_id] or "") - len(x.text or "") for x in rows) and sum(x.removed_chars for x in rows) > 500


def test_without():
    assert without(" Aa. Bb!  Cc", [(1, 4)]) == " Aa. Bb!  Cc"  # the blank before belongs to the sentence
    assert without("Aa. Bb!  Cc", [(0, 3)]) == "Bb!  Cc" and without("Aa. Bb!  Cc", [(4, 7), (9, 11)]) == "Aa. " and without("", []) == ""
