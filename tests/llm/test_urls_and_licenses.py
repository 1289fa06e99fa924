import re

import pytest

from millrace.llm import licenses, queries, urls


@pytest.mark.parametrize("name", ["op9_url_filters", "op6_license_scans"])
@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_against_sql(spark, name, folder):
    import duckdb

    frame = queries.QUERIES[name](spark, folder)
    for t in ("pages", "documents"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    wanted = duckdb.sql(queries.ORACLES[name])
    order = [wanted.columns.index(c) for c in frame.columns]
    assert sorted(str(tuple(r)) for r in frame.collect()) == sorted(str(tuple(r[i] for i in order)) for r in wanted.fetchall())


def brute(url, rules):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in rules if re.search(r.pattern.replace("$", r"\Z"), host + path)]
    named = sorted((r for r in fits if r.named), key=lambda r: (len(r.name), r.name))
    if named:
        return host, path, named[-1].name, named[-1].action
    actions = {r.action for r in fits}
    return host, path, None, "block" if "block" in actions else "allow"


def test_rules_of_all_kinds(spark):
    rules = [*urls.HOST_RULES, *urls.PATTERN_RULES, urls.pattern_rule("block", "*evil*"), urls.host_rule("block", "net", ""),
             urls.host_rule("allow", "ex.net", "/A/b"), urls.pattern_rule("block", "é"), urls.host_rule("block", "münchen.de", "/x")]
    given = [None, "", "no scheme", "http://EXAMPLE.org/en/12?x", "http://example.org/en/2", "https://a.example.org/es/#t", "x://com/de/",
             "http://notexample.org/es/", "http://q.com/fr/free-bets", "http://free-bets.com", "http://a.ex.net/A/bc", "http://a.ex.net/a/bc",
             "http://net", "http://xnet/", "http://u.info/devilish", "http://u.info/casino-9-bonus/", "http://u.info/casinos-bonus",
             "http://u.info/é/", "http://münchen.de/xy", "http://u.info/" + "a/" * 20000 + "ads/", "http://x://y/ads/", "http://u.info/XXX"]
    frame = spark.createDataFrame([(i, u, "r", "s") for i, u in enumerate(given * 2)], "page_id long, url string, rule string, site string")
    got = {r.page_id: tuple(r)[1:] for r in urls.judged(frame, rules).collect()}
    assert len(got) == len(given) * 2
    for i, u in enumerate(given * 2):
        assert got[i] == brute(u, rules), u
    assert urls.judged(frame.limit(0), rules).count() == 0


def test_canonical_forms(spark):
    mit = licenses.KNOWN["MIT"]
    same = [mit, mit.upper(), mit.replace("<year> <holders>", "2019 A. Person & Co"), mit.replace("\n", " \n\t"), "# " + mit.replace("\n", "\n# "),
            mit.replace("MIT License", "MIT Licence").replace("NONINFRINGEMENT", "NON-INFRINGEMENT")]
    other = [mit + " more", mit[:-20], None, "", "!!!", "x " * 50000]
    notice = ["intro\nreleased under the MIT licence\nbody", "Released under the MIT License"]
    frame = spark.createDataFrame([(i, t, "n") for i, t in enumerate(same + other + notice)], "doc_id long, text string, license string")
    got = {r.doc_id: r for r in licenses.scanned(frame).collect()}
    assert [got[i].license for i in range(6)] == ["MIT"] * 6
    assert [got[i].license for i in range(6, 12)] == [None] * 6
    assert [got[i].digest is None for i in range(6, 12)] == [False, False, True, True, True, False]
    assert got[12].notices == ["MIT notice"] and got[12].license is None
    assert got[13].license == "MIT notice" and got[13].notices == ["MIT notice"]
    assert licenses.scanned(frame.limit(0)).count() == 0 and licenses.scanned(frame, {}).filter("license is not null").count() == 0
