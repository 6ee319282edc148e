"""Large JSON files read by many tasks against the same files read whole."""

import json
import random

import pytest

from rollcall.sources import artifacts, elements

ARRAYS = {
    "plain": [{"email": "a@x.io", "sources": ["s"]}, {"email": "b@x.io"}],
    "tricky": [{"email": 'q"u}o,te\\', "employee": "[,{\\\"}]", "sources": ["a,b", "}"]},
               {"email": "é{", "employee": "\n\t ", "sources": []}, None, {}],
    "empty": [], "one": [{"email": "only"}],
}


@pytest.fixture
def splits(spark, monkeypatch):
    """Both passes over the files, and nothing else, read splits of the given size."""
    key = "spark.sql.files.maxPartitionBytes"
    old, plain = spark.conf.get(key), elements.written

    def written(df, name):
        out = plain(df, name)
        spark.conf.set(key, old)
        return out

    monkeypatch.setattr(elements, "written", written)
    yield lambda size: spark.conf.set(key, str(size))
    spark.conf.set(key, old)


def whole_and_split(spark, splits, root, name, tiny):
    read, scan = ((artifacts.read_array, artifacts.scan_array) if name in artifacts.ARTIFACTS
                  else (artifacts.read_map, artifacts.scan_map))
    whole = read(spark, root, name).collect()
    splits(tiny)
    return [sorted(map(str, rows)) for rows in (whole, scan(spark, root, name).collect())]


def put(tmp_path, tenant, name, text):
    (tmp_path / tenant).mkdir(exist_ok=True)
    (tmp_path / tenant / f"{name}.json").write_text(text, encoding="utf-8")


@pytest.mark.parametrize("tiny", [31, 10_000])
def test_arrays_equal_the_whole_read(spark, splits, tmp_path, tiny):
    rng = random.Random(tiny)
    for tenant, rows in ARRAYS.items():
        put(tmp_path, tenant, "candidate_emails", json.dumps(rows, ensure_ascii=False))
        put(tmp_path, f"{tenant} lines", "candidate_emails", json.dumps(rows, indent=2) + "\n")
    many = [{"email": "".join(rng.choice('ab{}[],:"\\ ') for _ in range(rng.randint(0, 30))),
             "sources": [rng.choice('{}"x') * rng.randint(0, 5) for _ in range(rng.randint(0, 3))]}
            for _ in range(20)]
    put(tmp_path, "many", "candidate_emails", json.dumps(many))
    whole, split = whole_and_split(spark, splits, str(tmp_path), "candidate_emails", tiny)
    assert whole == split and len(split) == 20 + 2 * (2 + 4 + 0 + 1)


@pytest.mark.parametrize("tiny", [23, 10_000])
def test_files_that_are_no_array_give_nothing(spark, splits, tmp_path, tiny):
    good = json.dumps(ARRAYS["plain"])
    for i, text in enumerate([
            '{"email": "x"}', '[{"email": "x"}', '[{"email": "x"}]]', '[{"email": "x"}, {"a": }]',
            '[{"email": "x"},]', '[,{"email": "x"}]', 'x [{"email": "y"}]', '[{"email": "x"}] y',
            '[{"email": "x"}] [{"email": "y"}]', '"text}"', '[{"email": "x}]', "5", "{}}",
            '[{"email": "x"} {"email": "y"}]', "[{}}]"]):
        put(tmp_path, f"bad{i}", "candidate_emails", text)
    put(tmp_path, "good", "candidate_emails", good)
    whole, split = whole_and_split(spark, splits, str(tmp_path), "candidate_emails", tiny)
    assert len(split) == 2 and whole == split


@pytest.mark.parametrize("tiny", [40, 10_000])
def test_maps(spark, splits, tmp_path, tiny):
    value = {f"d{i}.example": [{"subdomain": f"w{j},}}", "sources": ["a]"]} for j in range(i % 4)]
             for i in range(25)}
    put(tmp_path, "t1", "dns_infra", json.dumps(value))
    put(tmp_path, "t2", "dns_infra", json.dumps(value, indent=1))
    put(tmp_path, "t3", "dns_infra", "{}")
    put(tmp_path, "t4", "dns_infra", "[1]")
    whole, split = whole_and_split(spark, splits, str(tmp_path), "dns_infra", tiny)
    assert whole == split and len(split) == 50
    put(tmp_path, "t5", "dns_infra", '{"a": [], "b": [], "a": [{"subdomain": "last"}]}')
    got = artifacts.scan_map(spark, str(tmp_path), "dns_infra").where("tenant = 't5'").collect()
    assert sorted((r.domain, len(r.value)) for r in got) == [("a", 1), ("b", 0)]


def test_one_file_is_read_by_many_tasks(spark, splits, tmp_path):
    rows = [{"email": f"{i}@x.io", "sources": [str(i)] * 5} for i in range(5000)]
    put(tmp_path, "t", "candidate_emails", json.dumps(rows))
    splits(20_000)
    found = elements.pieces(spark, f"{tmp_path}/*/candidate_emails.json")
    assert found.select("start").distinct().count() > 8
    got = artifacts.scan_array(spark, str(tmp_path), "candidate_emails")
    assert sorted(map(tuple, got.select("seq", "email").collect())) == [
        (i, f"{i}@x.io") for i in range(5000)]


def test_summaries_do_not_grow_with_the_elements(spark, splits, tmp_path):
    """Read as if within a string, brackets in texts lead to ever new depths."""
    rows = [{"email": f"{i}@x.io", "employee": '"},{ \\[é'} for i in range(2000)]
    put(tmp_path, "t", "candidate_emails", json.dumps(rows, ensure_ascii=False))
    splits(20_000)
    found = elements.pieces(spark, f"{tmp_path}/*/candidate_emails.json")
    told = found.mapInArrow(elements.summaries, elements.SUMMARY).collect()
    assert len(told) > 3 and max(len(str(r)) for r in told) < 400
    got = artifacts.scan_array(spark, str(tmp_path), "candidate_emails")
    assert sorted(map(tuple, got.select("seq", "email").collect())) == [
        (i, f"{i}@x.io") for i in range(2000)]


def test_missing(spark, tmp_path):
    assert artifacts.scan_array(spark, str(tmp_path), "candidate_emails").collect() == []
    assert artifacts.scan_map(spark, str(tmp_path), "dns_infra").columns == [
        "tenant", "domain", "value"]
