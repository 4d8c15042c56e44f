"""URL filters and pseudonyms."""

import re
import tempfile
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from labelbench.llm import hosts, pseudonyms, queries
from labelbench.llm.queries import URL_RULES
from odd_docs import odd_rows

URLS = [
    "https://WWW.Example.NET/en/1?x#y",
    "http://example.net/de",
    "http://a.b.example.com/de/5#top",
    "http://example.com/fr/",
    "http://x.org/fr/2",
    "http://notexample.net",
    "http://n.net?x=/en/",
    "no scheme/path",
    "",
    None,
    "http:///only/path",
    "x://h://i/j",
    "http://bad.org/1",
    "http://bad.org/1",
    "http://good.org/1\nmore",
    "HTTP://ÄÖ.Org/en",
]


def _place(url):
    match = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = match.groups() if match else ("", "")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def _rule(host, path):
    fits = [
        (len(rule), rule, verdict)
        for verdict, rule in URL_RULES
        for name, _, start in [rule.partition("/")]
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start)
    ]
    return max(fits)[1:] if fits else (None, None)


@pytest.fixture
def pages(spark):
    rows = [(i, url, "x", "y") for i, url in enumerate(URLS)] + [(None, URLS[0], None, None)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, bad string")


def test_hosts_paths_and_rules(spark, pages):
    outcomes = spark.createDataFrame([], "page_id long, bad int")
    rows = hosts.judged(pages, outcomes, URL_RULES).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        url = URLS[r["page_id"]] if r["page_id"] is not None else URLS[0]
        assert (r["host"], r["path"]) == _place(url)
        rule, verdict = _rule(r["host"], r["path"])
        assert r["rule"] == rule and (verdict is None or r["verdict"] == verdict)
        assert verdict is not None or r["verdict"] in ("allow", "block")
    assert hosts.judged(pages.limit(0), outcomes, URL_RULES).count() == 0


def test_many_bad_pages_block_a_host_and_few_do_not(spark):
    names = ["bad.x.org"] * 200 + ["good.y.org"] * 1000 + ["few.z.org"] * 2 + ["new.x.org"]
    pages = spark.createDataFrame([(i, f"http://{n}/") for i, n in enumerate(names)], "page_id long, url string")
    bad = [(i, int(n != "good.y.org" and i % 10 != 0)) for i, n in enumerate(names) if n != "new.x.org"]
    outcomes = spark.createDataFrame([*bad, (0, None)], "page_id long, bad int")
    found = {r["host"]: r for r in hosts.judged(pages, outcomes, []).collect()}
    assert found["bad.x.org"]["verdict"] == "block" and found["good.y.org"]["verdict"] == "allow"
    places = pages.select("page_id", hosts.site_of(hosts.host_of("url")).alias("site"))
    seen = {r["site"]: r for r in hosts.host_reputations(places, outcomes).collect()}
    assert seen["few.z.org"]["n"] == 2 and seen["few.z.org"]["mean"] < 0.95
    # A new host stands near its registered domain, not near the mean of all.
    assert seen["new.x.org"]["n"] == 0 and seen["new.x.org"]["mean"] > seen["good.y.org"]["mean"] + 0.2


def _numeric_share(x, a, b, steps=400_000):
    """The beta share up to ``x`` by summing the density over a fine grid, densest at 0."""
    grid = (np.arange(steps) + 0.5) / steps
    t = grid**6
    density = t ** (a - 1) * (1 - t) ** (b - 1) * 6 * grid**5
    return density[t <= x].sum() / density.sum()


def test_the_bound_is_a_beta_quantile():
    rng = np.random.default_rng(1)
    for a, b in [(1, 1), (0.7, 1.3), (5, 2), (30, 90), (3000, 7000), (1.5, 800)]:
        x = hosts.lower_quantile(0.05, np.array([float(a)]), np.array([float(b)]))[0]
        share = hosts.beta_share(np.array([x]), np.array([float(a)]), np.array([float(b)]))[0]
        assert share == pytest.approx(0.05, abs=1e-9)
        assert np.mean(rng.beta(a, b, 400_000) <= x) == pytest.approx(0.05, abs=2e-3)
        if a < 1000:
            assert _numeric_share(0.3, a, b) == pytest.approx(
                hosts.beta_share(np.array([0.3]), np.array([float(a)]), np.array([float(b)]))[0], abs=1e-3
            )


def _reputed(spark, outcomes, urls):
    """(verdict by page, the SQL's too) of pages and their outcomes, in the registered query's form."""
    rows = [(i, url, "") for i, url in enumerate(urls)]
    folder = tempfile.mkdtemp(prefix="pages-")
    spark.createDataFrame(rows, "page_id long, url string, html string").toPandas().to_parquet(
        f"{folder}/pages.parquet"
    )
    labels = pd.DataFrame(outcomes, columns=["doc_id", "quality", "toxic"]).astype("Int32")
    labels.to_parquet(f"{folder}/labels.parquet")
    found = {r["page_id"]: r["verdict"] for r in queries.op8_url_filter(spark, folder).collect()}
    db = duckdb.connect()
    for name in ("pages", "labels"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    db.execute("SELECT * FROM (" + queries.ORACLES["op8_url_filter"] + ")")
    names = [d[0] for d in db.description]
    twin = {r[names.index("page_id")]: r[names.index("verdict")] for r in db.fetchall()}
    assert found == twin
    return found


FIVE = [f"http://h{i % 5}.site{i % 5}.info/p{i}" for i in range(10)]


@pytest.mark.parametrize(
    "outcomes", [[], [(0, 1, 0)], [(0, 0, 0)], [(0, 0, 1), (1, 1, 0)], [(0, None, None)]]
)
def test_little_evidence_blocks_nothing(spark, outcomes):
    assert set(_reputed(spark, outcomes, FIVE).values()) == {"allow"}


def test_the_method_blocks_hosts_that_no_rule_names(spark):
    """Bad pages block their host, and many bad hosts of one domain its unknown hosts, but not other
    domains of its suffix."""
    urls = [f"https://user@spam.com:{8000 + i}/x" for i in range(9)]
    urls += [f"http://sub{i}.bad.co.uk/y" for i in range(12)] + ["http://new.bad.co.uk/z"]
    urls += [f"http://fine{i}.org/" for i in range(30)] + ["http://other.co.uk/", "http://one.info", "x"]
    urls += [f"http://10.0.0.{i}/" for i in range(3)]
    outcomes = [(i, 0, 0) for i in range(21)] + [(i, 1, 0) for i in range(22, 52)] + [(55, 0, 0)]
    found = _reputed(spark, outcomes, urls)
    blocked = {i for i, verdict in found.items() if verdict == "block"}
    assert blocked == set(range(22))


VALUES = {
    "card": ["4111111111111111", "4111-1111-1111-1111", "5500 0000 0000 0004", "378282246310005"],
    "phone": ["+1 (212) 555-0100", "212-555-0100", "(999) 999-9999"],
    "address": ["10.0.0.1", "255.255.255.255", "1.2.3.4"],
    "date": ["2024-02-29", "29.02.2024", "29/02/2024", "02/29/2024", "1900-01-01", "2099-12-31"],
    "social": ["123-45-6789", "899-99-9999", "001-01-0001"],
    "email": ["jo.doe+x@mail.example.com", "A1@b.co"],
}
FALSE = ["4111111111111112", "256.1.1.1", "2023-02-29", "666-45-6789", "000-12-3456", "1.2.3.4.5", "12345678"]


def _luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_values_keep_their_form_and_stay_linked(spark):
    values = [v for vs in VALUES.values() for v in vs] + FALSE
    docs = spark.createDataFrame([(i, f"é {v}, and\n({v})") for i, v in enumerate(values)], "doc_id int, text string")
    out = {r["doc_id"]: r for r in pseudonyms.pseudonymised(docs, "k").collect()}
    new = {}
    for i, v in enumerate(values):
        text = out[i]["text"]
        new[v] = text[2 : 2 + (len(text) - len("é , and\n()")) // 2]
        assert text == f"é {new[v]}, and\n({new[v]})"
        assert out[i]["n_replaced"] == (0 if v in FALSE else 2), v
        assert (new[v] == v) == (v in FALSE)
    form = {v: re.sub(r"\d", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", v))) for v in values}
    for kind, group in VALUES.items():
        for v in group:
            if kind != "address":
                assert re.sub(r"\d", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", new[v]))) == form[v] or kind == "email"
        assert len({re.sub(r"\W", "", new[v]) for v in group}) == len({re.sub(r"\W", "", v) for v in group}) or kind in ("card", "phone", "date")
    assert all(map(_luhn, (new[v] for v in VALUES["card"])))
    assert re.sub(r"\D", "", new["4111111111111111"]) == re.sub(r"\D", "", new["4111-1111-1111-1111"])
    assert new["2024-02-29"].split("-")[::-1] == new["29.02.2024"].split(".")
    assert all(0 <= int(x) < 256 for v in VALUES["address"] for x in new[v].split("."))
    other = pseudonyms.pseudonymised(docs, "another key").collect()
    assert sum(a["text"] == out[a["doc_id"]]["text"] for a in other) == len(FALSE)


@pytest.mark.parametrize("sizes", [(10, 7), (1, 30)])
def test_numbers_are_permuted(spark, sizes):
    pairs = spark.range(sizes[0] * sizes[1]).select(
        pseudonyms.permuted(F.floor(F.col("id") / sizes[1]), F.col("id") % sizes[1], sizes, "k", "x").alias("p")
    )
    found = {tuple(r["p"]) for r in pairs.collect()}
    assert found == {(a, b) for a in range(sizes[0]) for b in range(sizes[1])}


def test_texts_are_permuted(spark):
    texts = [f"{a}{b}{c}" for a in "0123456789" for b in "abcdefghijklmnopqrstuvwxyz" for c in "01234"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in frame.select(pseudonyms.permuted_text(F.col("t"), "k", "x")).collect()]
    assert len(set(found)) == len(texts) and all(re.fullmatch(r"\d[a-z]\d", f) for f in found)


def test_other_texts_stay(odd, no_docs):
    out = pseudonyms.pseudonymised(odd, "k")
    assert Counter((r["doc_id"], r["text"], r["n_replaced"]) for r in out.collect()) == Counter(
        (r[0], r[1], 0) for r in odd_rows()
    )
    assert pseudonyms.pseudonymised(no_docs, "k").count() == 0


def test_it_is_native(odd):
    plan = pseudonyms.pseudonymised(odd, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange hash" not in plan.split("InMemoryTableScan")[0]


def test_phones_of_any_area_and_form_are_replaced(spark):
    phones = ["+1 (017) 555-7713", "+1 (136) 555-7479", "+12025550143", "2025550143", "12025550143"]
    phones += ["(000) 000-0000", "017-555-7713", "(202) 5550143", "+1 202-555-0143", "199.200.0001"]
    docs = spark.createDataFrame([(i, f"call {v}.") for i, v in enumerate([*phones, "1700000000"])], "i int, text string")
    out = {r["i"]: r for r in pseudonyms.pseudonymised(docs, "k").collect()}
    new = [out[i]["text"][5:-1] for i in range(len(phones))]
    for old, made in zip(phones, new):
        assert made != old and re.sub(r"\d", "0", made) == re.sub(r"\d", "0", old), old
    assert [re.sub(r"\D", "", new[i])[-10:] for i in (2, 4, 7, 8)] == [new[3]] * 4
    assert len({re.sub(r"\D", "", made)[-10:] for made in new}) == 5
    assert out[len(phones)]["n_replaced"] == 0
    again = pseudonyms.pseudonymised(spark.createDataFrame([(m,) for m in new], "text string"), "k")
    assert again.where("n_replaced = 1").count() == len(new)


def test_every_planted_phone_is_replaced(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    form = re.compile(r"\+1 \(\d{3}\) \d{3}-\d{4}")
    old = {r["doc_id"]: form.findall(r["text"] or "") for r in docs.collect()}
    new = {r["doc_id"]: form.findall(r["text"] or "") for r in pseudonyms.pseudonymised(docs, "k").collect()}
    assert sum(map(len, old.values())) > 10
    for doc, values in old.items():
        assert len(values) == len(new[doc]) and not set(values) & set(new[doc])


CARD_TEXTS = [
    "4111 1111 1111 1111 12/27",
    "4111111111111111 123",
    "12 4111111111111111",
    "4111111111111111 97.51.17.173",
    "4111111111111111 a.b@c.org",
    "2024 4111-1111-1111-1111",
    "4111111111111111 12th",
    "4111111111111111 5500 0000 0000 0004 378282246310005",
    "41111 11111 111111",
    "41111 11111 111111 12",
    "7 378282246310005 123",
    "4111111111111111 123-45-6789 202-555-0143",
]


def test_cards_beside_other_numbers_are_replaced(spark):
    docs = spark.createDataFrame(list(enumerate([*CARD_TEXTS, "4111111111111113 1/2", "1 " * 500])), "i int, text string")
    out = {r["i"]: r for r in pseudonyms.pseudonymised(docs, "k").collect()}
    card = re.compile(r"4111[ -]?1111[ -]?1111[ -]?1111|41111 11111 111111|3782822463100005|5500 0000 0000 0004")
    for i, old in enumerate(CARD_TEXTS):
        new = out[i]["text"]
        assert not card.search(new), old
        form = r"[\d.]+" if "97.51" in old else r"\d"
        assert re.sub(form, "0", re.sub("[a-z]", "a", new)) == re.sub(form, "0", re.sub("[a-z]", "a", old)), old
    alone = out[1]["text"].split()[0]
    assert _luhn(alone)
    for i in (0, 2, 3, 4, 5, 6, 7, 8, 9, 11):
        assert alone in re.sub(r"[ -]", "", out[i]["text"]), CARD_TEXTS[i]
    assert out[0]["text"].endswith(" 12/27") and out[1]["text"].endswith(" 123")
    assert out[2]["text"].startswith("12 ") and out[5]["text"].startswith("2024 ")
    assert "97.51.17.173" not in out[3]["text"] and "a.b@" not in out[4]["text"]
    assert [out[i]["n_replaced"] for i in (0, 3, 4, 7, 11)] == [1, 2, 2, 3, 3]
    assert out[len(CARD_TEXTS)]["n_replaced"] == 0


def test_dates_of_timestamps_and_of_one_digit_are_replaced(spark):
    dates = ["2024-02-29T12:00:00Z", "2024-02-29", "29.2.2024", "2/29/2024", "2024-2-29", "3/7/2024", "03/07/2024", "2024-02-29Test"]
    docs = spark.createDataFrame([(i, f"on {v}, x") for i, v in enumerate(dates)], "i int, text string")
    new = [r["text"][3:-3] for r in pseudonyms.pseudonymised(docs, "k").orderBy("i").collect()]
    assert new[7] == dates[7] and new[0][10:] == "T12:00:00Z" and new[0][:10] == new[1] != dates[1]
    year, month, day = new[1].split("-")
    short = month.lstrip("0"), day.lstrip("0")
    assert new[2] == f"{day}.{short[0]}.{year}" and new[3] == f"{short[0]}/{day}/{year}"
    assert new[4] == f"{year}-{short[0]}-{day}"
    assert new[5] != dates[5] and [int(x) for x in new[5].split("/")] == [int(x) for x in new[6].split("/")]


def test_registrants_under_a_public_suffix_are_apart(spark):
    wanted = {
        "www.a.co.uk": ("a.co.uk", "co.uk"),
        "b.co.uk": ("b.co.uk", "co.uk"),
        "x.c.github.io": ("c.github.io", "github.io"),
        "co.uk": ("co.uk", "co.uk"),
        "www.notco.uk": ("notco.uk", "uk"),
        "m.d.com": ("d.com", "com"),
        "": ("", ""),
    }
    rows = spark.createDataFrame([(h,) for h in wanted], "host string")
    found = rows.select("host", hosts.domain_of("host"), hosts.suffix_of("host")).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == wanted
