import json

import pytest

from strata.llm.tool_calls import broken_rules, canonical_json, link_tool_calls, orphan_results

SCHEMA = {
    "f": {
        "type": "object",
        "properties": {"n": {"type": "integer", "minimum": 1}, "s": {"enum": ["x", "y"]}, "l": {"type": "array", "items": {"type": "number"}}},
        "required": ["n"],
        "additionalProperties": False,
    }
}
CALLS = "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>, level string"
RESULTS = "conv_id long, turn long, call_id string, content string, n string"


def test_links_orders_and_validates(spark):
    calls = [
        (1, 1, "a", "f", '{"n": 2, "s": "x"}', ["c"], "z"),  # needs a later call
        (1, 3, "b", "f", '{"n": 0, "zz": 1}', ["a", "b", None, "nope"], "z"),
        (1, 5, "c", "f", '{"n": 1.0}', [], "z"),
        (1, 5, "c", "f", '{"n": 9}', [], "z"),  # the id again: the first by arguments stays
        (2, 1, "a", "g", "{}", None, "z"),
        (2, 2, "x", "f", "[1]", ["y"], "z"),
        (2, 3, "y", "f", "no json", ["x"], "z"),
        (2, 4, "w", "f", None, ["x"], "z"),
        (None, 1, "a", "f", "{}", [], "z"),
        (3, 1, None, "f", "{}", [], "z"),
    ]
    results = [(1, 2, "a", "late"), (1, 2, "a", "early"), (1, 4, "b", None), (2, 9, "q", "orphan"), (None, 1, "a", "lost")]
    calls = spark.createDataFrame(calls, CALLS)
    results = spark.createDataFrame([(*r, "z") for r in results], RESULTS)
    got = {(r.conv_id, r.call_id): r for r in link_tool_calls(calls, results, SCHEMA).collect()}
    assert set(got) == {(1, "a"), (1, "b"), (1, "c"), (2, "a"), (2, "x"), (2, "y"), (2, "w")}
    assert {k: (r.level, r.position) for k, r in got.items()} == {
        (1, "c"): (0, 1), (1, "a"): (1, 2), (1, "b"): (2, 3),
        (2, "a"): (0, 1), (2, "x"): (None, None), (2, "y"): (None, None), (2, "w"): (None, None),
    }
    assert got[1, "a"].message == '{"arguments":{"n":2,"s":"x"},"id":"a","name":"f","result":"early"}'
    assert (got[1, "a"].status, got[1, "a"].n_results, got[1, "a"].errors) == ("linked", 2, [])
    assert (got[1, "b"].status, got[1, "b"].errors, got[1, "b"].n_unknown) == ("invalid", ["/n: below the minimum", "/zz: unknown"], 3)
    assert got[1, "c"].errors == ["/n: not of type integer"] and got[1, "c"].message == '{"arguments":{"n":1},"id":"c","name":"f"}'
    assert got[2, "a"].errors == ["unknown tool"] and got[2, "x"].errors == ["/: not an object"]
    assert got[2, "y"].errors == ["/: not JSON"] and json.loads(got[2, "w"].message)["arguments"] is None
    orphans = sorted(((r.conv_id, r.call_id) for r in orphan_results(calls, results).collect()), key=str)
    assert orphans == [(2, "q"), (None, "a")]


def test_long_conversation_positions(spark):
    calls = [(1, t, f"c{t}", "f", '{"n":1}', [], "z") for t in range(2500)]
    got = link_tool_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame([], RESULTS), SCHEMA).collect()
    assert sorted((r.turn, r.position) for r in got) == [(t, t + 1) for t in range(2500)]
    assert {r.status for r in got} == {"unanswered"}


def test_empty(spark):
    assert link_tool_calls(spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS), {}).count() == 0


@pytest.mark.parametrize(
    "value,text",
    [
        ({"b": 1, "a": [True, None, "é\n\u2028"]}, '{"a":[true,null,"é\\n\u2028"],"b":1}'),
        ({"\U0001f600": 1, "\ufb33": 2}, '{"\U0001f600":1,"\ufb33":2}'),
        (1e21, "1e+21"), (1e-7, "1e-7"), (100.0, "100"), (0.1, "0.1"), (-0.0, "0"),
    ],
)
def test_canonical_json(value, text):
    assert canonical_json(value) == text


def test_rules():
    assert broken_rules({"n": True}, SCHEMA["f"]) == ["/n: not of type integer"]
    assert broken_rules({"n": 1, "l": [1, "x"], "s": "z"}, SCHEMA["f"]) == ["/l/1: not of type number", "/s: not one of the allowed values"]
    assert broken_rules({}, SCHEMA["f"]) == ["/n: missing"]


@pytest.mark.parametrize(
    "arguments, error",
    [
        ("[" * 100_000 + "]" * 100_000, "/: nested too deep"),
        ('{"n":1,"l":' + "[" * 5_000 + "]" * 5_000 + "}", "/: nested too deep"),
        ('{"n": NaN}', "/: not JSON"), ('{"n": -Infinity}', "/: not JSON"), ('{"n": 1e999}', "/: not JSON"),
        ('{"n": 1, "n": 2}', "/: not JSON"), ('{"n": ' + "9" * 5_000 + "}", "/: not JSON"), ("{", "/: not JSON"),
    ],
)
def test_arguments_that_cannot_be_read(spark, arguments, error):
    calls = spark.createDataFrame([(1, 1, "a", "f", arguments, [], "z"), (1, 2, "b", "f", '{"n":3}', [], "z")], CALLS)
    got = {r.call_id: r for r in link_tool_calls(calls, spark.createDataFrame([], RESULTS), SCHEMA).collect()}
    assert (got["a"].status, got["a"].errors) == ("invalid", [error])
    assert json.loads(got["a"].message)["arguments"] == arguments  # the text it came as
    assert got["b"].status == "unanswered"
