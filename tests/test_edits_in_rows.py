"""Edits within a record's row, and of records with many edits in rows of their own."""

import json
import random

import pytest

from rollcall.operators import edits
from test_edits import run

RECORD = json.dumps({"a": {"b": [1, {"c": "x"}, [True]], "d": 'q"\\'}, "e": [], "f": None, "g": 2.5})
PATHS = ["a.b[1].c", "a.b[4].n", "a.d", "e[0]", "e[2]", "new.deep.one", "a.b[2][0]", "a.b.name", "f", "h",
         "a", "e", "a.b[0]", 'a.ü "x', "f.x", "g.y.z", "e[5000]", ".".join("x" * 70)]


@pytest.fixture
def names(monkeypatch):
    found, real = [], edits.written

    def written(df, name):
        found.append(name)
        return real(df, name)

    monkeypatch.setattr(edits, "written", written)
    return found


def test_levels_of_a_record_are_not_written(spark, names):
    rows = [("r", 1, "a.b[1].c", "text", "y"), ("s", 1, "new.deep.one", "number", "3")]
    got = run(spark, {"r": RECORD, "s": "{}"}, rows)
    assert json.loads(got["r"][0])["a"]["b"][1] == {"c": "y"}
    assert got["s"] == ('{"new":{"deep":{"one":3}}}', None) and names == ["edits"]


def test_both_ways_say_the_same(spark, names, monkeypatch):
    rng = random.Random(5)
    rows = [(f"r{i}", n, path, *rng.choice([("number", "4"), ("text", "t"), ("array-primitive", "a,b")]))
            for i in range(150) for n, path in enumerate(rng.choices(PATHS, k=rng.randint(1, 4)))]
    records = {f"r{i}": RECORD for i in range(150)}
    near = run(spark, records, rows)
    assert names == ["edits"] and {p for _, p in near.values()} == {
        None, edits.THROUGH, edits.BEYOND, edits.INSIDE, edits.TOO_DEEP}
    monkeypatch.setattr(edits, "MANY", 0)
    assert run(spark, records, rows) == near and len(names) > 2


def test_a_record_with_many_edits(spark):
    rows = [("r", i, f"list[{i}].n", "number", str(i)) for i in range(edits.MANY + 50)]
    got = run(spark, {"r": '{"list": [], "x": 1}', "s": "{}"}, [*rows, ("s", 1, "a", "text", "v")])
    assert json.loads(got["r"][0]) == {"list": [{"n": i} for i in range(edits.MANY + 50)], "x": 1}
    assert got["s"] == ('{"a":"v"}', None)
