"""Readers and file checks on real files."""

import json

import pytest
from pyspark.sql import functions as F

from rollcall.functions.variants import canonical
from rollcall.sources import artifacts, eventlines


@pytest.fixture
def root(tmp_path):
    a, b = tmp_path / "acme co", tmp_path / "b+c"
    for d in (a, b):
        d.mkdir()
    (a / "domains.json").write_text(json.dumps(
        [{"domain": "a.com", "sources": ["x"]}, {"domain": "b.com"}], indent=2))
    (b / "domains.json").write_text('{"domain": "not-a-list.com"}')
    (b / "documents.json").write_text("{broken")
    (a / "dns_infra.json").write_text(json.dumps(
        {"a.com": [{"subdomain": "s.a.com", "sources": ["ct"]}], "b.com": []}))
    (b / "dns_infra.json").write_text("[1]")
    (a / "candidate_emails.jsonl").write_text(
        '{"seq": 5, "email": "x@a.com", "sources": ["s"]}\n{"seq": 6, "email": "y@a.com"}\n')
    return str(tmp_path)


def test_array_keeps_place_and_skips_non_lists(spark, root):
    rows = artifacts.read_array(spark, root, "domains").orderBy("seq").collect()
    assert [(r.tenant, r.seq, r.domain, r.sources) for r in rows] == [
        ("acme co", 0, "a.com", ["x"]), ("acme co", 1, "b.com", None)]


def test_broken_and_missing_files_are_empty(spark, root):
    assert artifacts.read_array(spark, root, "documents").count() == 0
    missing = artifacts.read_array(spark, root, "breaches")
    assert missing.count() == 0 and missing.columns[:3] == ["tenant", "seq", "email"]
    assert artifacts.read_map(spark, root, "dns_infra_raw").count() == 0


def test_map_gives_one_row_per_key(spark, root):
    rows = artifacts.read_map(spark, root, "dns_infra").orderBy("domain").collect()
    assert [(r.tenant, r.domain, len(r.value)) for r in rows] == [
        ("acme co", "a.com", 1), ("acme co", "b.com", 0)]


def test_rows_are_splittable_lines_with_their_own_seq(spark, root):
    rows = artifacts.read_rows(spark, root, "candidate_emails").orderBy("seq").collect()
    assert [(r.tenant, r.seq, r.email) for r in rows] == [
        ("acme co", 5, "x@a.com"), ("acme co", 6, "y@a.com")]


def test_file_exists_against_a_listing(spark, tmp_path):
    d = tmp_path / "acme" / "apify" / "a.com"
    d.mkdir(parents=True)
    (d / "r 1.pdf").write_bytes(b"%PDF-1.7")
    docs = spark.createDataFrame(
        [("acme", "apify-google", "a.com", "r 1.pdf"), ("acme", "metagoofil", "a.com", "r 1.pdf"),
         ("acme", "other", "a.com", "r 1.pdf")],
        "tenant string, discovery_method string, source_domain string, filename string")
    c = F.col
    docs = docs.withColumn("filepath", artifacts.document_path(
        c("tenant"), c("discovery_method"), c("source_domain"), c("filename")))
    got = artifacts.attach_file_exists(docs, artifacts.list_files(spark, str(tmp_path)))
    assert {r.discovery_method: r.file_exists for r in got.collect()} == {
        "apify-google": True, "metagoofil": False, "other": False}


def test_signature(spark):
    df = spark.createDataFrame(
        [(b"%PDF-1", "PDF", "text/html"), (b"PK\x03\x04", "docx", None), (b"PK\x03\x04", "pdf", None),
         (b"<html>", "xls", "application/vnd.ms-Excel"), (b"<html>", "doc", "text/html"), (None, None, None)],
        "content binary, ext string, kind string")
    got = [r[0] for r in df.select(
        artifacts.signature_ok(F.col("content"), F.col("ext"), F.col("kind"))).collect()]
    assert got == [True, True, False, True, False, False]


def test_a_line_is_json_only_from_end_to_end(spark):
    lines = ["470344 seen a.b@x.example", "true c@x.example", '"q" d@x.example', "[1] e@x.example",
             '{"type": "EMAILADDR", "data": "no"} f@x.example', "1] g@x.example", '1, "w": "h@x.example"',
             '"i@x.example"', '["j@x.example"]', '{"type": "OTHER", "data": "k@x.example"}',
             '{"type": "EMAILADDR", "data": "L@x.example", "of": [1]}']
    df = spark.createDataFrame(list(enumerate(lines)), "n int, line string")
    found = {r.n: r.email[0] for r in eventlines.address_events(df, "line").collect()}
    assert "".join(found[n] for n in sorted(found)) == "acdefghil" and len(found) == 9
    assert sorted(r.n for r in eventlines.unparsed_lines(df, "line").collect()) == list(range(7))
    same = df.select(canonical(F.col("line")).alias("c")).collect()
    assert [r.c for r in same[:7]] == lines[:7] and same[8].c == lines[8]
