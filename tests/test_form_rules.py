"""Required groups, conditions of groups, and conditions as the form writes them."""

import pytest

from canvass.functions.relevance import relevance_sql
from canvass.operators import formlogic
from canvass.operators.formlogic import FormRule
from canvass.sources import tables

FORM = "variable string, label string, required string, relevant string, group string, position int"


def test_three_nested_groups(spark):
    rows = [
        ("outer", "Outer", "yes", "${age} >= 18", None, 1),
        ("middle", "Middle", None, "selected(${has}, 'b')", "outer", 2),
        ("inner", "Inner", "no", None, "middle", 3),
        ("q1", "One", None, "${q2} != ''", "inner", 5),
        ("q1", "Later rule of the same question", "no", None, None, 9),
        ("q2", "Two", "yes", None, "no_such_group", 6),
        ("q3", "Three", None, None, None, 7),
    ]
    rules = tables.form_rules(spark.createDataFrame(rows, FORM), ["q1", "q2", "q3", "q4"])
    assert [(r.variable, r.required, r.label) for r in rules] == [("q1", True, "One"), ("q2", True, "Two"), ("q3", False, "Three")]
    assert rules[1].relevant is None
    data = spark.createDataFrame(
        [(1, "20", "a b", None, "x"), (2, "20", "ab", None, "x"), (3, "9", "b", None, "x"), (4, "18", "b", None, None), (5, "018", "b", "y", "x"), (6, None, "b", "y", None)],
        "id int, age string, has string, q1 string, q2 string",
    )
    out = formlogic.flag_skips(formlogic.flag_missing(data, rules), rules)
    assert {r["id"]: (r["m_q1"], r["s_q1"], r["m_q2"]) for r in out.collect()} == {1: (1, 0, 0), 2: (0, 0, 0), 3: (0, 0, 0), 4: (0, 0, 1), 5: (0, 0, 0), 6: (0, 1, 1)}


def test_deep_groups_take_few_rounds_and_circles_are_errors(spark):
    rows = [(f"g{i}", None, "yes" if i == 0 else None, None, f"g{i - 1}" if i else None, i) for i in range(40)]
    deep = tables.with_groups(spark.createDataFrame(rows, FORM).withColumn("required", formlogic.F.expr("required = 'yes'")), relevant="relevant")
    assert all(r["required"] for r in deep.collect()) and deep.count() == 40
    circle = spark.createDataFrame([("a", None, None, None, "b", 1), ("b", None, None, None, "a", 2)], FORM)
    with pytest.raises(ValueError, match="hold each other"):
        tables.form_rules(circle, ["a"])


ANSWERS = [
    {"a": "1", "b": "x y", "n": "5", "e": None},
    {"a": "01", "b": "xy", "n": "5.0", "e": ""},
    {"a": "2", "b": None, "n": None, "e": "z"},
    {"a": None, "b": "y", "n": "-3", "e": "it's"},
]
CONDITIONS = [
    ("${a} = '1'", [1, 1, 0, 0]),
    ("${a} = 1", [1, 1, 0, 0]),
    ("${a} != '1'", [0, 0, 1, 1]),
    ("'2' = ${a}", [0, 0, 1, 0]),
    ("${n} > 4 and ${n} <= '5'", [1, 1, 0, 0]),
    ("${n} < 0 or not(selected(${b}, 'y'))", [0, 1, 1, 1]),
    ("selected( ${b} , 'y') and ${a} = '1'", [1, 0, 0, 0]),
    ("${e} = ''", [1, 1, 0, 0]),
    ("${e} != ''", [0, 0, 1, 1]),
    ('${e} = "it\'s"', [0, 0, 0, 1]),
    ("count-selected(${b}) >= 2", [1, 0, 0, 0]),
    ("string-length(${b}) = 3", [1, 0, 0, 0]),
    ("${n} + 1 = 6", [1, 1, 0, 0]),
    ("${n} * 2 > 9 or ${a} = '2'", [1, 1, 1, 0]),
    ("${n} = -3", [0, 0, 0, 1]),
    ("${n} mod 2 = 1", [1, 1, 0, 0]),
    ("${a} = '1' or ${a} = '2' and ${e} = 'nothing'", [1, 1, 0, 0]),
    ("(${a} = '1' or ${a} = '2') and ${e} = 'z'", [0, 0, 1, 0]),
    ("if(${a} = 2, ${b} = '', true())", [1, 1, 1, 1]),
    ("contains(${b}, 'x') and regex(${n}, '^5')", [1, 1, 0, 0]),
    ("starts-with(${e}, 'it') and true()", [0, 0, 0, 1]),
    ("${a} = ${n}", [0, 0, 0, 0]),
]


def test_conditions_of_a_form(spark):
    data = spark.createDataFrame([(i, *r.values()) for i, r in enumerate(ANSWERS)], "id int, a string, b string, n string, e string")
    out = data.selectExpr("id", *[f"{relevance_sql(c)} as c{i}" for i, (c, _) in enumerate(CONDITIONS)]).orderBy("id").collect()
    for i, (text, want) in enumerate(CONDITIONS):
        assert [int(r[f"c{i}"]) for r in out] == want, text


def test_the_same_flags_as_sql_predicates(spark):
    data = spark.createDataFrame([(i, *r.values()) for i, r in enumerate(ANSWERS)], "id int, a string, b string, n string, e string")
    form = [FormRule("e", True, relevance_sql("${a} = '1' and selected(${b}, 'x')")), FormRule("n", True, relevance_sql("${a} != '1'"))]
    plain = [FormRule("e", True, "a in ('1', '01') and concat(' ', b, ' ') like '% x %'"), FormRule("n", True, "coalesce(a, '') not in ('1', '01')")]
    flags = [formlogic.flag_skips(formlogic.flag_missing(data, r), r).orderBy("id").collect() for r in (form, plain)]
    assert flags[0] == flags[1]


def test_conditions_that_are_none(spark):
    assert relevance_sql(None) is None and relevance_sql("  ") is None
    for text in ("${a} = 'x", "today() > ${a}", "(${a} = 1", "${a} = 1)", "pulldata('x', ${a}) = 1"):
        with pytest.raises(ValueError):
            relevance_sql(text)
