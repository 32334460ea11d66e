import pytest

from heddle.operators import packed
from heddle.operators.packed import PRIOR, Code, parse

CODE = Code(PRIOR)
NAMES = ["Ann Walbury", "John Ferring", "Maria Delstone", "Peter Ollgren", "Ruth Kimbal", "Carl Vennerby", "Jane Tosk"]

CASES = [
    ('["Walbury, Ann", "John Ferring"]', ["Walbury, Ann", "John Ferring"]),
    ('["Bj\\u00f6rn Orr", "Leo \\"Lee\\" Pym"]', ["Björn Orr", 'Leo "Lee" Pym']),
    ("['Ann Walbury', 'J. Ferring']", ["Ann Walbury", "J. Ferring"]),
    ("Ann Walbury; John Ferring ;; Maria Delstone;", ["Ann Walbury", "John Ferring", "Maria Delstone"]),
    ("Ann Walbury|Ferring, John|", ["Ann Walbury", "Ferring, John"]),
    ("Walbury, A. · John Ferring", ["Walbury, A.", "John Ferring"]),
    ("Ann Walbury\r\nJohn Ferring\tMaria Delstone", ["Ann Walbury", "John Ferring", "Maria Delstone"]),
    ('"Walbury, Ann","John Ferring"', ["Walbury, Ann", "John Ferring"]),
    ('Ann Walbury,"Ferring, J."', ["Ann Walbury", "Ferring, J."]),
    ("By Ann Walbury and John Ferring", ["Ann Walbury", "John Ferring"]),
    ("BY Ann Walbury, John Ferring and Maria Delstone", ["Ann Walbury", "John Ferring", "Maria Delstone"]),
    ("Ann Walbury with John Ferring, Maria Delstone & Peter Ollgren, et al.", ["Ann Walbury", "John Ferring", "Maria Delstone", "Peter Ollgren"]),
    ("Walbury, Ann and Ferring, John and Maria Delstone", ["Walbury, Ann", "Ferring, John", "Maria Delstone"]),
    ("Ann Walbury & John Ferring", ["Ann Walbury", "John Ferring"]),
    ("Ann Walbury &amp; John Ferring", ["Ann Walbury", "John Ferring"]),
    ("Ann Walbury/John Ferring // Maria Delstone", ["Ann Walbury", "John Ferring", "Maria Delstone"]),
    ("Orsted Council on Transit and Towns and Ann Walbury", ["Orsted Council on Transit and Towns", "Ann Walbury"]),
    ("Ann Walbury, Jr. and John Ferring", ["Ann Walbury, Jr.", "John Ferring"]),
    ("Walbury, Ann", ["Walbury, Ann"]),
    ('"Ann Walbury" and "John Ferring"', ["Ann Walbury", "John Ferring"]),
    ('Ann "Annie" Walbury, John Ferring', ['Ann "Annie" Walbury', "John Ferring"]),
    ("Sean O&#39;Neil; Ann Walbury", ["Sean O&#39;Neil", "Ann Walbury"]),
    ("Ann Walbury and Sean O&#39;Neil", ["Ann Walbury", "Sean O&#39;Neil"]),
    ("Ministry of Trade; Energy and Water; Ann Walbury", ["Ministry of Trade", "Energy and Water", "Ann Walbury"]),
    ("Walbury, Ann\r\nFerring, John\r\nDelstone, Maria", ["Walbury, Ann", "Ferring, John", "Delstone, Maria"]),
    (" Ann Walbury ", ["Ann Walbury"]),
    ("", []),
    ("   ", []),
    (None, []),
]


@pytest.mark.parametrize(("text", "values"), CASES)
def test_parse(text, values):
    assert parse(text, CODE)[1] == values


def test_an_organisation_of_many_delimiters_is_one_value():
    known = {**PRIOR, **{(p, None): 1000 for p in "GF"}, **{("G", w): 100 for w in ("ann", "john")}, **{("F", w): 100 for w in ("walbury", "ferring")}}
    name = "Center for Law, Land, Labor, Water, Wood, Work, Wind and Waves"
    assert parse(f"{name}, Ann Walbury and John Ferring", Code(known))[1] == [name, "Ann Walbury", "John Ferring"]


def test_code_is_learned_and_bounded(spark):
    rows = [(i, "; ".join(NAMES[(i + j) % 7] for j in range(3))) for i in range(300)]
    code = packed.learned_code(spark.createDataFrame(rows, "id bigint, authors string"), "authors")
    mixed = packed.learned_code(spark.createDataFrame([*rows, *[(900 + i, "Zora Quillfeather, Ann Walbury and John Ferring") for i in range(50)]], "id bigint, authors string"), "authors")
    assert mixed.counts[("G", "zora")] == 50  # fields parted by commas are counted too
    assert code.counts[("S", "GF")] == 900 and code.counts[("G", "ann")] > 100
    assert code.value("Ann Walbury") < code.value("Walbury, Ann") < code.value("Walbury and Ann")


def test_rows(spark):
    long = ", ".join(NAMES * 3000)
    rows = [(i, ", ".join(NAMES[(i + j) % 7] for j in range(3))) for i in range(60)] + [(2**60 + 1, "Ann Walbury; Jane Tosk"), (None, "Ann Walbury; Jane Tosk"), (70, None), (71, ""), (72, long), (0, "Ann Walbury, John Ferring, Maria Delstone")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "id bigint, authors string, pos int, value string")
    got = packed.unpacked(df, "id", "authors").collect()
    assert sorted((r.pos, r.value) for r in got if r.item_id == 2**60 + 1) == [(1, "Ann Walbury"), (2, "Jane Tosk")]
    assert len([r for r in got if r.item_id is None]) == 2 and len([r for r in got if r.item_id == 72]) == 21000
    assert len([r for r in got if r.item_id == 0]) == 6 and not [r for r in got if r.item_id in (70, 71)]
    assert packed.unpacked(df.limit(0), "id", "authors").count() == 0
