from tallyforge.llm import names

S = "key string, name string, industry string, city string, core string, legal string"


def groups(make, *rows):
    got = names.linked_names(make(S, *[(*r, "x", "y") for r in rows])).collect()
    out = {}
    for r in got:
        out.setdefault(r.org, set()).add(r.key)
    return sorted(map(sorted, out.values()))


def test_spellings_meet_and_others_stay_apart(make):
    got = groups(
        make,
        ("a", "Plelgrintrumkura Freight Holdings Company", "Freight", "Here"), ("b", "The  Plelgrintrumkúra Freight Hldgs Co.", None, "here"), ("c", "Freight Holdings (Plelgrin trumkura) Co", "freight", None),
        ("d", "PLELGRINTRUMKUAR FREIGHT HOLDINGS CO", "Freight and Services", None), ("e", "Plelgrintrumkura Mining Holdings Co", "Mining", "There"), ("f", "Plelgrintrumkura Co.", "Freight", "Here"),
        ("g", "Freight Holdings Company", "Freight", "Here"), ("h", None, "Freight", "Here"), (None, "Plelgrintrumkura Freight", "Freight", "Here"), ("i", "???", None, None), ("j", "", None, None),
    )
    assert got == [["a", "b", "c", "d", "f"], ["e"], ["g"]]


def test_contradicting_fields_part(make):
    got = groups(
        make, ("a", "Vexolmundrika Optics Group Ltd", "Optics", "One"), ("b", "Vexolmundrika Optics Group Ltd", "Optics", "Two"),
        ("c", "Vexolmundrika Optics Group GmbH", "Optics", None), ("x", "Optics", "Optics", None),
    )
    assert got == [["a"], ["b"], ["c"], ["x"]]


def test_bare_name_joins_only_an_unambiguous_group(make):
    got = groups(make, ("a", "Nokrelbun Marine Ltd", "Marine", "X"), ("b", "Nokrelbun", None, None), ("c", "Tolvarkin Marine Ltd", "Marine", "X"), ("d", "Tolvarkin Mining", "Mining", "Y"), ("e", "Tolvarkin", None, None))
    assert got == [["a", "b"], ["c"], ["d"], ["e"]]


def test_empty_and_repeated(make):
    assert groups(make) == []
    assert groups(make, *[("a", "Nokrelbun Marine Ltd", "Marine", "X")] * 3, ("b", "Nokrelbun Marine Ltd", "Marine", "X")) == [["a", "b"]]


def test_long_name(make):
    assert groups(make, ("a", "Q" * 5000 + " Marine", "Marine", None), ("b", "Q" * 5000 + " Marine Ltd", "Marine", None)) == [["a", "b"]]


def test_components_of_a_chain(make):
    n = 40
    e = make("a string, b string", *[(f"{i:03}", f"{i + 1:03}") for i in range(n)], ("x", "y"), ("y", "x"), ("z", "z"))
    got = {r.v: r.label for r in names.components(e).collect()}
    assert got == {f"{i:03}": "000" for i in range(n + 1)} | {"x": "x", "y": "x"}


def test_pairs_are_ordered_and_complete(make):
    orgs = make("key string, org string", ("c2", "o"), ("p1", "o"), ("c1", "o"), ("q", "r"))
    assert {(r.key_a, r.key_b) for r in names.key_pairs(orgs).collect()} == {("c1", "c2"), ("c1", "p1"), ("c2", "p1")}


def test_keys_linked_by_city_join_a_group_together(make):
    same = [("a", "Nokrelbun Marine Ltd", "Marine", None), ("b", "Nokrelbun", None, "X"), ("c", "Nokrelbun Ltd", None, "X")]
    several = [("d", "Tolvarkin Marine Ltd", "Marine", None), ("e", "Tolvarkin Mining", "Mining", None), ("f", "Tolvarkin", None, "Y"), ("g", "Tolvarkin", None, "Y")]
    assert groups(make, *same, *several) == [["a", "b", "c"], ["d"], ["e"], ["f", "g"]]


def test_reordered_parts_meet(make):
    got = groups(
        make, ("a", "Harlow Benton Inc", "Marine", "X"), ("b", "Benton Harlow Inc", "Marine", "X"), ("c", "Northwind Traders Ltd", "Food", None), ("d", "Traders, Northwind Ltd.", "Food", None),
        ("e", "Northwind Growers Ltd", "Food", None),
    )
    assert got == [["a", "b"], ["c", "d"], ["e"]]


def test_short_forms_of_industries_are_learned(make):
    rows = [(f"{t}{i}", f"{n} {w} Ltd", "Aviation", c) for i, (n, c) in enumerate([("Nokrelbun", "X"), ("Tolvarkin", "Y"), ("Vexolmundrika", "Z")]) for t, w in (("a", "Aviation"), ("b", "Avn"))]
    got = groups(make, *rows, ("q", "Avin Aviation", "Aviation", "Q"), ("r", "Avin Aviation Ltd", "Aviation", "Q"))
    assert got == [["a0", "b0"], ["a1", "b1"], ["a2", "b2"], ["q", "r"]]


def test_overly_common_suffixes_are_refined(make, monkeypatch):
    """Many names of one industry end alike; with blocks of four at most the spellings still meet through city and longer suffixes."""
    monkeypatch.setattr(names, "OVERLY_COMMON", 4)
    heads = ["Bralk", "Crond", "Drusp", "Flenz", "Gromv", "Hurnt", "Jesqu", "Klimp", "Morvd", "Pluxt", "Quosh", "Rindg"]
    rows = [(f"{h}{t}", f"{h}ington {t}", "Marine", None if t == "" else h) for h in heads for t in ("", "Ltd", "Ltd.")]
    assert groups(make, *rows) == sorted(sorted(f"{h}{t}" for t in ("", "Ltd", "Ltd.")) for h in heads)
