import pytest
from pyspark.sql import functions as F

from inkframe.operators import model


def test_render():
    assert model.render("a {{x}} {{ y }}", {"x": "{{y}}", "y": "2"}) == "a {{y}} 2"
    for template, values in (("{{x}}", {}), ("x", {"x": "1"}), ("{{x y}}", {}), ("{{x}} }}", {"x": "1"})):
        with pytest.raises(ValueError):
            model.render(template, values)


def test_retry_only_what_can_pass():
    tries = []

    def flaky():
        tries.append(1)
        if len(tries) < 3:
            raise TimeoutError
        return "ok"

    assert model.with_retry(flaky, sleep=lambda s: None) == "ok"
    with pytest.raises(ValueError):
        model.with_retry(lambda: (_ for _ in ()).throw(ValueError("no")))


def test_apply_model(spark):
    asks = spark.createDataFrame([("s", "good"), ("s", "good"), ("s", "bad"), ("s", "old")], "system string, user string")
    answers = {"good": '{"a": 1}', "bad": '{"a": 1, "a": 2}', "old": "{}"}
    call = lambda system, user: answers[user]
    first = model.apply_model(asks, call, parallelism=2).collect()
    assert sorted((r.answer, r.rounds) for r in first if r.answer) == [('{"a": 1}', 1), ("{}", 1)]
    assert [(r.rounds, r.error) for r in first if not r.answer] == [(2, "repeated key")]
    stored = spark.createDataFrame([(r.request_hash, r.answer) for r in first if r.answer], "request_hash string, answer string")
    again = model.apply_model(asks, lambda s, u: "null", stored).collect()
    assert sorted((r.reused, r.answer) for r in again) == [(False, "null"), (True, '{"a": 1}'), (True, "{}")]


def test_selectors(spark):
    df = spark.createDataFrame([(["R0", "L1", "L0", "R0"], ["a", "b"], ["c"]), (["L2"], ["a", "b"], ["c"]), (["x"], ["a"], []), ([], ["a"], ["c"])], "s array<string>, l array<string>, r array<string>")
    got = [r.x for r in df.select(model.resolve_selectors(F.col("s"), F.col("l"), F.col("r")).alias("x")).collect()]
    assert got == [["a", "b", "c"], None, None, []]
