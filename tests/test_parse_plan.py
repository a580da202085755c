"""Corpus parsing, JSON extraction and sample allocation edge rows."""
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import one_col
from sqlmill.functions.jsontext import is_json, with_extracted_json
from sqlmill.operators import parse as P
from sqlmill.operators import planning as PL


def conv_frame(spark, rows):
    schema = "ord long, conversations array<struct<role:string,content:string>>"
    return spark.createDataFrame(rows, schema)


def test_sharegpt_edge_rows(spark):
    rows = [
        (1, [("user", "q")]),                                        # one turn: dropped
        (2, [("system", "s"), ("user", "q")]),                       # no answer: dropped
        (3, [("user", "q1"), ("assistant", "a1"), ("assistant", " ")]),  # last answer blank: dropped
        (4, [("assistant", "a"), ("user", "q")]),                    # answer first: kept
        (5, [("human", " q "), ("gpt", "a")]),                       # human/gpt roles
        (6, [("User", "q"), ("assistant", "a")]),                    # roles are case-sensitive
        (7, [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ]
    got = {r["ord"]: (r["question"], r["sql"]) for r in P.parse_sharegpt(conv_frame(spark, rows)).collect()}
    assert got == {4: ("q", "a"), 5: ("q", "a"), 7: ("q", "a")}


def test_alpaca_edge_rows(spark):
    df = spark.createDataFrame([(1, " I ", None, " o "), (2, "I", "", "o"), (3, "I", " x ", "o")],
                               "ord long, instruction string, input string, output string")
    got = {r["ord"]: (r["question"], r["sql"]) for r in P.parse_alpaca(df).collect()}
    assert got == {1: ("I", "o"), 2: ("I", "o"), 3: ("I\n x", "o")}


JSON_CASES = [
    ('{"a": 1}', '{"a": 1}', None),
    ('Here: {"a": [1, 2]} thanks', '{"a": [1, 2]}', None),
    ('list [1, 2] end', '[1, 2]', None),
    ('```json\n{"a": 1\n```', None, "invalid JSON in fence"),
    ('```\n[3]\n```', '[3]', None),
    ('nothing', None, "no JSON found"),
    ('{"a": {"b": 1}} and {"c": 2}', None, "invalid JSON between brackets"),
    ('{"input":"a","output":"b"}] junk', '{"input":"a","output":"b"}', None),
    ('[{"a":1}] junk}', '[{"a":1}]', None),
    ('{"a":1}] junk}', None, "invalid JSON between brackets"),
    ('{"a":1,"a":2}', '{"a":1,"a":2}', None),
]


def test_json_validity_is_pythons(spark):
    import json
    texts = ['{"a":1,"a":2}', '{"a":1}] junk', '{"a":1}]', '1, 2', '1', '"x"', "{'a':1}", '[1,]', '', ' ', 'null', '{"a":1} ', '01', '{"a":"\t"}',
             '1,"end":0', '[]', '{}', '{"a":{"b":[1,2,{"c":null}]}}', 'tru', '{"a" 1}', '"\\x"', '{"a":1}{"b":2}', '[1][2]', '-', '1e5', '{"a":"\\u00e9"}']

    def valid(t):
        try:
            json.loads(t)
            return True
        except ValueError:
            return False
    assert dict(zip(texts, one_col(spark, texts, is_json("v")))) == {t: valid(t) for t in texts}


def test_sample_lines_take_the_last_of_equal_keys(spark):
    from sqlmill.operators import generation as G
    text = '{"input":"a","input":"b","output":"c"}\n{"input":"a","output":"b"}] junk\n[{"input":"a","output":"b"}]'
    good, bad = G.parse_samples(spark.createDataFrame([(1, text)], "topic_id long, response string"))
    assert [(r["line_no"], r["input"], r["output"]) for r in good.collect()] == [(0, "b", "c")]
    assert sorted(r["line_no"] for r in bad.collect()) == [1, 2]


def test_extract_json_rules(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _, _) in enumerate(JSON_CASES)], "i long, v string")
    got = [r["x"] for r in with_extracted_json(df, "v").orderBy("i").collect()]
    assert [(g["json"], g["error"]) for g in got] == [(j, e) for _, j, e in JSON_CASES]


def allocate(spark, counts, total):
    valid = spark.createDataFrame([(1, i, float(c)) for i, c in enumerate(counts)], "plan_id long, ord long, count double")
    totals = spark.createDataFrame([(1, total)], "plan_id long, total long")
    return [r["count"] for r in PL.allocate_samples(valid, totals).orderBy("ord").collect()]


def test_allocation_hand_cases(spark):
    assert allocate(spark, [10, 20, 30], 60) == [10, 20, 30]        # already equal: untouched
    assert allocate(spark, [0, 0, 5], 5) == [0, 0, 5]                # equal with zeros: untouched
    assert allocate(spark, [1, 1, 1], 6) == [2, 2, 2]
    assert allocate(spark, [5, 5, 5], 2) == [1, 1]                   # total < n: capped to 2 topics
    assert allocate(spark, [5, 5], 0) == [1]                         # total 0: one topic, count 1
    assert allocate(spark, [0, 0], 4) == [1, 3]                      # all zero: ratio 1, last takes the rest
    assert allocate(spark, [1, 3], 2) == [1, 1]                      # 0.5 rounds half-even to 0 -> max(1, 0)
    assert allocate(spark, [5, 1], 4) == [3, 1]                      # 10/3 -> 3 (3.33)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=50), min_size=1, max_size=6), st.integers(min_value=1, max_value=200))
def test_allocation_sums_to_total(spark, counts, total):
    got = allocate(spark, counts, total)
    if sum(counts) != total and total >= len(counts):
        assert sum(got) == total
        assert all(c >= 1 for c in got)
