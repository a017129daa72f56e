"""The pluggable table function: rows go through an injected callable, once for each distinct request.

The callable takes (system, user) and returns JSON text; in production it calls a model, in tests it
is a lookup. Requests are identified by a hash of what they say, never of how they are sent, and
answers already stored are reused.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FIELD = re.compile(r"\{\{\s*([A-Za-z_][A-Za-z0-9_]*)\s*\}\}")


def render(template: str, values: dict[str, str]) -> str:
    """One pass over the template; values are not looked into again. Missing and superfluous values,
    and braces that are no field, raise."""
    fields = set(_FIELD.findall(template))
    if fields != set(values):
        raise ValueError(f"fields {sorted(fields)} but values {sorted(values)}")
    if "{{" in _FIELD.sub("", template) or "}}" in _FIELD.sub("", template):
        raise ValueError("malformed field")
    return _FIELD.sub(lambda m: values[m.group(1)], template)


def strict_json(text: str):
    """The value of a JSON text; repeated keys and numbers that are not finite raise."""

    def pairs(items):
        if len({k for k, _ in items}) < len(items):
            raise ValueError("repeated key")
        return dict(items)

    def bad(x):
        raise ValueError(x)

    return json.loads(text, object_pairs_hook=pairs, parse_constant=bad)


def with_retry(call: Callable[[], str], attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> str:
    """Up to so many tries; only connection errors and time-outs are tried again."""
    for n in range(1, attempts + 1):
        try:
            return call()
        except (ConnectionError, TimeoutError):
            if n == attempts:
                raise
            sleep(min(2.0, 0.25 * 2 ** (n - 1)))
    raise ValueError("attempts must be at least 1")


def apply_model(requests: DataFrame, call: Callable[[str, str], str], stored: DataFrame | None = None, rounds: int = 2, parallelism: int | None = None) -> DataFrame:
    """(request_hash, answer, error, rounds, reused) for the distinct requests (system, user).

    An answer that is no strict JSON is asked for again, `rounds` times in all; then `answer` is null
    and `error` says why. `stored` (request_hash, answer) is not asked again.
    """
    asked = requests.select("system", "user", F.sha2(F.to_json(F.struct("system", "user")), 256).alias("request_hash")).dropDuplicates(["request_hash"])
    old = None
    if stored is not None:
        old = asked.join(stored.select("request_hash", "answer"), "request_hash").select("request_hash", "answer", F.lit(None).cast("string").alias("error"), F.lit(0).alias("rounds"), F.lit(True).alias("reused"))
        asked = asked.join(stored.select("request_hash"), "request_hash", "left_anti")
    if parallelism:
        asked = asked.repartition(parallelism, "request_hash")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for system, user, key in zip(f["system"], f["user"], f["request_hash"]):
                answer, error = None, None
                for n in range(1, rounds + 1):
                    try:
                        text = with_retry(lambda: call(system, user))  # noqa: B023
                        strict_json(text)
                        answer, error = text, None
                        break
                    except ValueError as e:
                        error = str(e)[:500]
                out.append((key, answer, error, n, False))
            yield pd.DataFrame(out, columns=["request_hash", "answer", "error", "rounds", "reused"])

    new = asked.select("system", "user", "request_hash").mapInPandas(run, "request_hash string, answer string, error string, rounds int, reused boolean")
    return new if old is None else old.unionByName(new)


def resolve_selectors(selectors, left, right):
    """Elements named L0, L1, ... and R0, ... of two arrays, left first, each once, as a column.

    An array of `selectors` with one that names nothing gives null: the answer is invalid as a whole."""
    index = lambda s: F.substring(s, 2, 9).try_cast("int")
    known = lambda s: (s.rlike(r"^L\d{1,8}$") & (index(s) < F.size(left))) | (s.rlike(r"^R\d{1,8}$") & (index(s) < F.size(right)))
    order = F.array_sort(F.transform(F.array_distinct(selectors), lambda s: F.struct(F.substring(s, 1, 1).alias("side"), index(s).alias("i"))))
    got = F.transform(order, lambda x: F.when(x["side"] == "L", F.get(left, x["i"])).otherwise(F.get(right, x["i"])))
    return F.when(F.forall(selectors, known), F.array_distinct(got))
