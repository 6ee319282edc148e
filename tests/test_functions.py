"""Golden rows for the column library."""

import pytest
from pyspark.sql import functions as F

from rollcall.functions import addresses, hosts, names, text


def one(spark, fn, *values):
    row = ", ".join(f"string(:a{i}) as a{i}" for i in range(len(values)))
    args = {f"a{i}": v for i, v in enumerate(values)}
    df = spark.sql(f"select {row}", args=args)
    return df.select(fn(*[F.col(f"a{i}") for i in range(len(values))]).alias("r")).first()[0]


CASES = [
    (text.slugify, ("Banque Tunisienne de Solidarité",), "banque-tunisienne-de-solidarite"),
    (text.slugify, ("Straße AG",), "strae-ag"),
    (text.slugify, ("!!!",), "default"),
    (text.slugify, (None,), "default"),
    (text.abbreviation, ("Banque Tunisienne de Solidarité",), "BTS"),
    (text.abbreviation, ("The-House of Cards",), "HC"),
    (text.acronym, ("Banque Tunisienne de Solidarite",), "btds"),
    (text.fold_accents, ("Łódź Ørsted é",), "odz rsted e"),
    (text.format_timestamp, ("2024-03-05T07:08:09.123456+00:00",), "March 05, 2024 at 07:08 UTC"),
    (text.format_timestamp, ("2024-03-05T07:08:09+02:00",), "March 05, 2024 at 07:08 UTC"),
    (text.format_timestamp, ("soon",), "soon"),
    (text.format_timestamp, (None,), "unknown"),
    (hosts.normalize_host, ("HTTPS://WWW.Example.com:8443/x",), "example.com"),
    (hosts.normalize_host, ("ftp://example.com",), "ftp"),
    (hosts.normalize_host, ("www.www.a.com",), "www.a.com"),
    (hosts.normalize_host, ("http://[bad/x",), ""),
    (hosts.normalize_host, ("http://[::1]:80/x",), "::1"),
    (hosts.normalize_host, ("http://my_host.com/%%%",), "my_host.com"),
    (hosts.normalize_host, ("user:p@ss@a.com",), "a.com"),
    (hosts.normalize_host, (" a.com　",), "a.com"),
    (hosts.normalize_host, (None,), ""),
    (hosts.valid_host, ("a.com",), True),
    (hosts.valid_host, ("my_host.com",), False),
    (hosts.valid_host, ("localhost",), False),
    (hosts.valid_host, ("-a.com",), False),
    (hosts.valid_host, ("a.c",), False),
    (hosts.subdomain_of, ("x api.example.com.evil.org", "example.com"), "api.example.com"),
    (hosts.subdomain_of, ("example.com", "example.com"), None),
    (hosts.subdomain_of, ("_dmarc.example.com", "example.com"), None),
    (hosts.subdomain_of, ("*.dev.example.com", "example.com"), "dev.example.com"),
    (hosts.host_matches_name, ("bts.com.tn", "Banque Tunisienne", "BT"), True),
    (hosts.host_matches_name, ("other.com", "Banque Tunisienne", ""), False),
    (hosts.host_matches_name, ("banquetunisienne.com", "Banque Tunisienne", None), True),
    (hosts.denylisted, ("fedex.com",), True),
    (lambda h: hosts.denylisted(h, label_boundary=True), ("fedex.com",), False),
    (lambda h: hosts.denylisted(h, label_boundary=True), ("www.x.com",), True),
    (hosts.infrastructure_host, ("Mail.example.com",), True),
    (hosts.infrastructure_host, ("mailer.example.com",), False),
    (hosts.host_keyword, ("mail.bts.com.tn",), "bts"),
    (hosts.host_keyword, ("www.mail.com",), "mail"),
    (hosts.host_keyword, ("www.com",), "www"),
    (hosts.host_keyword, (None,), ""),
    (names.query_variants, ("Foo-Bar Baz",), ["Foo Bar Baz", "Foo-Bar-Baz"]),
    (names.split_name, ("Jean-Pierre", "O'Brien", None), ("jean-pierre", "obrien")),
    (names.split_name, ("X", "undefined", "Ann Bo Cé"), ("ann", "ce")),
    (names.split_name, (None, None, "Single"), None),
    (names.dedup_key, (None, "https://X.example/in/A?x=1", None, "n"), "url:https://x.example/in/a"),
    (names.dedup_key, (" AB ", None, None, "n"), "pid:ab"),
    (names.dedup_key, (None, "", None, " N "), "name:n"),
    (names.title_case, ("o'brien 3d x-y",), "O'Brien 3D X-Y"),
    (names.name_terms, ("Café du Monde-XY",), ["café", "monde"]),
    (addresses.address_domain, ("a@b@c",), "b@c"),
    (addresses.mailbox_domain, ("a@b@c",), "c"),
    (addresses.valid_address, (" A.b@X.com ",), True),
    (addresses.valid_address, ("é@x.com",), False),
    (addresses.local_part_rank, ("x.doe@d.com",), 0),
    (addresses.local_part_rank, ("x_doe@d.com",), 1),
    (addresses.local_part_rank, ("xdoe@d.com",), 2),
    (addresses.mentions_account, ("INVALID mailbox",), True),
    (lambda t: addresses.mentions_account(t, whole_word=True), ("INVALID mailbox",), False),
    (addresses.verifier_status, ("ACCEPT_ALL",), ("risky", 0.5)),
    (addresses.verifier_status, ("odd",), ("unknown", 0.0)),
]


@pytest.mark.parametrize("i", range(len(CASES)))
def test_golden(spark, i):
    fn, args, want = CASES[i]
    got = one(spark, fn, *args)
    got = tuple(got) if hasattr(got, "asDict") else got
    assert got == want, (args, got)


def test_guess_only(spark):
    df = spark.sql(
        "select array('Pattern-Generation') a, array('Inferred-Pattern','Pattern-Generation') b,"
        " cast(array() as array<string>) c, cast(null as array<string>) d"
    )
    got = df.select(*[addresses.guess_only(F.col(c)).alias(c) for c in "abcd"]).first()
    assert tuple(got) == (True, False, False, False)


def test_a_bound_value_is_no_array_element(spark):
    """An element of a transformed array walks the whole body for its type on every row."""
    from rollcall.functions.text import let

    df = spark.sql("select * from values ('A b'), (null) t(x)")
    out = df.select(let(F.lower("x"), lambda v: F.concat_ws("|", F.coalesce(v, F.lit("none")), v)).alias("y"))
    assert [r.y for r in out.collect()] == ["a b|a b", "none"]
    assert "transform(" not in out._jdf.queryExecution().optimizedPlan().toString()
