"""Packed fields: every delimiter, quoting and defect, and round trips of random values."""

import random

import pytest

from lavra.operators.packed import parse_packed, split_packed

A, B = "https://a.example/cap_1,2,3.pdf", "http://b.example/download?id=1;formato=pdf&versao=2"
C = "https://c.example/busca?termo=tese|1&campo=id"


@pytest.mark.parametrize("field", [
    f"{A}; {B}", f"{A};{B}", f"{A} ; {B}", f"{A}, {B}", f"{A} | {B}", f"{A}||{B}", f"{A}\n{B}", f"{A}\r\n{B}", f"{A} {B}", f"{A} e {B}", f"{A} ou {B}", f"<{A}> <{B}>", f"<{A}>, <{B}>",
    f"[{A}][{B}]", f"{{{A}}}{{{B}}}", f"({A})({B})", f"{A}\u00a0{B}", f"“{A}”“{B}”", f"«{A}»«{B}»", f"“{A}”<{B}>",
    f'"{A}";"{B}"', f'"{A}", "{B}"', f"'{A}' ;\n'{B}'", f'["{A}", "{B}"]', f'["{A}","{B}"] ;', f"(1) {A} (2) {B}", f"(1) {A}; (2) {B}", f"1. {A} 2. {B}", f" {A} ;; {B}| ",
])
def test_two_values(field):
    assert [v for v, _ in parse_packed(field)] == [A, B]


def test_defects_are_flagged():
    assert parse_packed(f'"{A}; {B}') == [(A, "unclosed"), (B, None)]
    assert parse_packed(f'{A}" ; {B}') == [(A, "unopened"), (B, None)]
    assert parse_packed(f'["{A}", "{B}"') [0][0] == A


def test_others():
    assert parse_packed(None) == parse_packed("  ") == parse_packed("ver na biblioteca") == []
    assert [v for v, _ in parse_packed(f"{C} | doi:10.1/x | hdl:1/2 | urn:obra:3")] == [C, "doi:10.1/x", "hdl:1/2", "urn:obra:3"]
    assert [v for v, _ in parse_packed('["https:\\/\\/a.example\\/1", "' + A + '"]')] == ["https://a.example/1", A]
    proxy = "https://p.example/entrar?url=https://a.example/obra/1"
    assert [v for v, _ in parse_packed(f"{proxy}, {A}")] == [proxy, A]
    assert [v for v, _ in parse_packed(f"{A};{A}")] == [A, A]  # a repeated value counts each time


def test_round_trip():
    r = random.Random(4)
    pool = [A, B, C, "doi:10.5/z", "https://d.example/x;v=2", "https://e.example/a%20b", "urn:obra:7"]
    shapes = [("", "; ", ""), ("", ", ", ""), ("", " | ", ""), ("", "\n", ""), ("<", "> <", ">"), ('"', '";"', '"'), ('["', '", "', '"]'), ("", "||", "")]
    for _ in range(500):
        vs, (a, sep, z) = [r.choice(pool) for _ in range(r.randint(1, 5))], r.choice(shapes)
        assert [v for v, _ in parse_packed(a + sep.join(vs) + z)] == vs


def test_table(spark):
    long = "; ".join([A] * 5000)
    rows = [(1, f"{A}; {B}", 9), (2, None, 9), (3, "", 9), (4, A, 9), (5, long, 9), (1, f"{A}; {B}", 9)]
    df = spark.createDataFrame(rows, "k bigint, v string, pos int")  # a column named as one of the result's
    got = split_packed(df, "k", "v", least=2).groupBy("k").count().collect()
    assert {x["k"]: x["count"] for x in got} == {1: 4, 5: 5000}
    close = spark.createDataFrame([(i, v) for i, v in enumerate((f"[{A}][{B}]", f"({A})({B})", f"{A}\u00a0{B}", f"“{A}”“{B}”"))], "k int, v string")
    assert split_packed(close, "k", "v", least=2).count() == 8
    assert split_packed(df, "k", "v").where("k = 4").count() == 1
    assert split_packed(df.limit(0), "k", "v").count() == 0
