"""Edits as data against a plain function."""

import json
import random
import re

from rollcall.operators import edits

EDITS = "k string, seq int, path string, data_type string, value string"


def put(record, path, value):
    """The record after one edit, or a ValueError."""
    parts = re.sub(r"\[(\d+)\]", r".\1", path).split(".")
    now = record
    for i, part in enumerate(parts):
        last = i == len(parts) - 1
        if isinstance(now, list):
            if not part.isdigit():
                return record
            at = int(part)
            while len(now) <= at:
                now.append(None if len(now) < at or last else {})
            if last:
                now[at] = value
            now = now[at]
        elif isinstance(now, dict):
            if last:
                now[part] = value
            now = now.setdefault(part, {})
        else:
            raise ValueError(path)
    return record


def run(spark, records, rows):
    r = spark.createDataFrame(list(records.items()), "k string, data string")
    got = edits.apply_edits(r, spark.createDataFrame(rows, EDITS), ["k"]).collect()
    return {x.k: (x.data, x.edit_problem) for x in got}


def test_random_paths_against_a_plain_function(spark):
    rng = random.Random(3)
    records, rows, want = {}, [], {}
    for i in range(60):
        record = {"a": {"b": [1, {"c": "x"}, [True]], "d": 'q"\\'}, "e": [], "f": None, "g": 2.5}
        records[f"r{i}"] = json.dumps(record)
        path = rng.choice(["a.b[1].c", "a.b[4].n", "a.d", "e[0]", "e[2]", "new.deep.one", "a.b[2][0]",
                           "a.b.name", "f", "h", "a", "e", "a.b[0]", 'a.ü "x'])
        kind, value, made = rng.choice([
            ("number", " 12.50", 12.5), ("number", "7", 7), ("number", "", 0), ("number", "z", None),
            ("boolean", "true", True), ("boolean", "yes", False), ("text", 'ä"\n\\', 'ä"\n\\'),
            ("array-primitive", " a, ,b", ["a", "b"]), ("array-primitive", "", [])])
        rows.append((f"r{i}", 1, path, kind, value))
        want[f"r{i}"] = put(record, path, made)
    got = run(spark, records, rows)
    assert {k: json.loads(v) for k, (v, _) in got.items()} == want
    assert {p for _, p in got.values()} == {None}


def test_several_edits_of_a_record(spark):
    got = run(spark, {"r": '{"a": {"b": 1}, "z": [1]}', "other": "{}", "text": "not json"}, [
        ("r", 1, "a.b", "number", "5"), ("r", 2, "a.b", "number", "6"), ("r", 3, "a.c.d", "text", "n"),
        ("r", 4, "x.y", "text", "gone"), ("r", 5, "x", "text", "whole"), ("text", 1, "a[0]", "text", "v"),
        ("nobody", 1, "a", "text", "v")])
    assert {k: json.loads(v) for k, (v, _) in got.items() if k != "other"} == {
        "r": {"a": {"b": 6, "c": {"d": "n"}}, "z": [1], "x": "whole"}, "text": {"a": {"0": "v"}}}
    assert got["other"] == ("{}", None)


def test_records_that_stay_as_they_were(spark):
    whole = '{"a": "text", "b": null, "c": [1]}'
    got = run(spark, {k: whole for k in "abcde"}, [
        ("a", 1, "a.x", "text", "v"), ("b", 1, "b.x", "text", "v"), ("c", 1, "c[5000]", "text", "v"),
        ("d", 1, "n", "text", "v"), ("d", 2, "n.m", "text", "v"),
        ("e", 1, ".".join("x" * 70), "text", "v")])
    assert got == {"a": (whole, edits.THROUGH), "b": (whole, edits.THROUGH),
                   "c": (whole, edits.BEYOND), "d": (whole, edits.INSIDE), "e": (whole, edits.TOO_DEEP)}


def test_no_edits(spark):
    assert run(spark, {"r": '{"a":1}'}, []) == {"r": ('{"a":1}', None)}
