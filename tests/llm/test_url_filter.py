from flowmetrics.llm import url_filter

RULES = [("org", "/", "allow"), ("bad.org", "/x/", "block"), ("com", "/spam", "block")]


def _judge(session, rows, rules=RULES, redirects=None):
    pages = session.createDataFrame(rows, "page_id bigint, url string, html string, rule string").repartition(3)
    if redirects is not None:
        redirects = session.createDataFrame(redirects, "url string, target string")
    out = url_filter.judged_pages(pages, url_filter.rules_table(session, rules), redirects)
    assert out.columns == ["page_id", "url", "html", "host", "path", "rule", "verdict"]
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}


def test_parts_and_longest_rule(session):
    urls = {
        1: "HTTP://WWW.Bad.ORG/x/y?q#f", 2: "http://bad.org/X/", 3: "https://notbad.org", 4: "x://a.com/spammy#/b",
        5: "http://com/spam", 6: "http://a.com?x=/spam", 7: None, 8: "no scheme/org", 9: "", 10: "a://b://c.org/",
        11: "http:///spam", 12: "http://É.com/spam\nx",
    }
    got = _judge(session, [(i, u, None, "old") for i, u in urls.items()])
    assert got == {
        1: ("www.bad.org", "/x/y", "bad.org/x/", "block"), 2: ("bad.org", "/X/", "org/", "allow"),
        3: ("notbad.org", "", None, "allow"), 4: ("a.com", "/spammy", "com/spam", "block"),
        5: ("com", "/spam", "com/spam", "block"), 6: ("a.com", "", None, "allow"),
        7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("", "", None, "allow"),
        10: ("b:", "//c.org/", None, "allow"), 11: ("", "/spam", None, "allow"),
        12: ("É.com", "/spam\nx", "com/spam", "block"),
    }


def _page(i, url, link="", refresh=""):
    html = f'<html><link rel="canonical" href="{link}">' if link else ""
    html += f'<META HTTP-EQUIV=refresh content="0; URL={refresh}">' if refresh else ""
    return (i, url, html or None, None)


def test_blocks_reach_aliases_and_allows_come_first(session):
    chain = [_page(100 + i, f"http://c{i}.net/p", refresh=f"https://c{i + 1}.net/p#top") for i in range(20)]
    star = [_page(200 + i, f"http://s{i}.net/", link="//hub.net/") for i in range(30)]
    rows = [
        *chain, *star,
        _page(1, "http://c20.net/p", link="http://z.com/spam"),
        _page(2, "http://hub.net/", refresh="http://q.com/spam/2"),
        _page(3, "http://mixed.net/", link="http://q2.com/spam"),
        _page(4, "http://mixed2.net/", link="http://mixed.net/"),
        _page(5, "http://good.org/", link="http://mixed2.net/"),
        _page(6, "http://plain.net/", link="/self"), _page(7, "http://q2.com/spam"), _page(7, "http://q2.com/spam"),
        _page(8, None, link="http://q2.com/spam"), _page(9, "http://r.net/a"),
    ]
    got = _judge(session, rows, redirects=[("http://r.net/a", "http://q9.com/spam"), (None, None)])
    for i in range(20):
        assert got[100 + i][2:] == (None, "block")
    for i in range(30):
        assert got[200 + i][2:] == (None, "block")
    assert got[1][3] == got[2][3] == got[9][3] == "block"
    # good.org/ is allowed by rule, so what shares its component without a rule is, too.
    assert got[3][3] == got[4][3] == got[5][3] == "allow"
    assert got[7][2:] == ("com/spam", "block")
    assert got[6][3] == got[8][3] == "allow"


def test_all_links_of_a_page_count(session):
    rows = [
        (1, "http://two.net/", '<link rel=canonical href="http://a.net/">\n<LINK href=\'http://b.net/\'rel="canonical">', None),
        (2, "http://a.net/", None, None), (3, "http://b.net/", None, None), (4, "http://b.net/", "", None),
        (5, "http://e.net/", '<link rel="nofollow  canonical" href="http://q.com/spam"><link rel="me" href="/x">', None),
        (6, "http://f.net/", "<meta http-equiv=refresh content='0;url=/y'><meta http-equiv=refresh content='0;url=//q.com/spam'>", None),
        (7, "http://g.net/", '<link rel="canonically" href="http://q.com/spam"><link rel="x" title="canonical" href="http://q.com/spam">', None),
        (8, "http://h.net/", "<link href=//q.com/spam rel='alternate canonical'/>", None),
        (9, "http://i.net/", '<link rel="canonical-x" href="http://q.com/spam">', None),
    ]
    got = _judge(session, rows, redirects=[("http://b.net/", "http://q.com/spam")])
    verdicts = {i: v[3] for i, v in got.items()}
    blocked = {1, 2, 3, 4, 5, 6, 8}
    assert verdicts == {i: "block" if i in blocked else "allow" for i in range(1, 10)}


def test_empty_table_and_no_rules(session):
    assert _judge(session, []) == {}
    assert _judge(session, [_page(1, "http://a.org/")], rules=[])[1] == ("a.org", "/", None, "allow")
