"""Top-k search and URL rules against brute force."""

import random
import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF_SMALL, duck
from llm_fixtures import llm  # noqa: F401
from kasir.llm import topk, url_rules


def test_top_k_against_sql(llm):
    con = duck(SF_SMALL)
    res = con.execute(topk.OP4_SQL)
    cols = [d[0] for d in res.description]
    want = sorted(tuple(r) for r in res.fetchall())
    assert sorted(tuple(r) for r in topk.op4_top_k(llm, SF_SMALL).select(*cols).collect()) == want


def brute(rows, k, is_query):
    import math
    vecs = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in vecs:
        if is_query(q):
            best = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in vecs if i != q and len(a) == len(b)))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def run(llm, rows, k):
    df = llm.createDataFrame([(i, v, "x", 1.0) for i, v in rows],
                             "vec_id bigint, embedding array<double>, rank string, score double")
    got = topk.top_k(df.repartition(3), F.col("vec_id") % 5 == 0, k)
    return sorted(tuple(r) for r in got.collect())


def test_top_k_with_ties_nulls_and_odd_vectors(llm, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 100)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 30)
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(4)]) for i in range(400)]
    rows += [(500 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(200)]         # a third ties
    rows += [(800, None), (805, [None, 1.0, 1.0, 1.0]), (810, [float("nan"), 0.0, 0.0, 0.0]),
             (815, [float("inf")] * 4), (820, [1.0, 2.0]), (825, [0.0] * 4), (None, [1.0] * 4),
             (830, [1e9, -1e9, 1e9, 1e9])]
    assert run(llm, rows, 10) == brute(rows, 10, lambda i: i % 5 == 0)


def test_top_k_with_few_candidates(llm):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.25, -1.0])]
    assert run(llm, rows, 10) == brute(rows, 10, lambda i: i % 5 == 0)
    assert run(llm, rows[:1], 10) == []
    assert run(llm, [], 10) == []


# --- URLs ------------------------------------------------------------------------

RULES = url_rules.OP8_RULES
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return host.translate(LOWER), re.split("[?#]", rest[len(host):], maxsplit=1)[0]


def stated(url):
    host, path = cut(url)
    fits = [(len(h + p), h + p, v) for v, h, p in RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme.org/", "http://A.Example.ORG/es/x", "http://example.org/en/1?q", "http://org/",
        "http://borg/", "http://a.com/fr/", "http://a.com/de/#x", "http://a.com", "ftp://x.net/a://b/c",
        "://org/a", "http://a.com?x=/de/", "http://a.com/DE/", "http://é.ORG/\n/x", "http://x.org/" + "a/" * 4000]


def test_stated_rules_and_parts(llm):
    rows = [(i, u, "h", "v") for i, u in enumerate(URLS)] + [(3, URLS[3], "h", "v"), (None, URLS[3], "h", "v")]
    df = llm.createDataFrame(rows, "page_id bigint, url string, host string, verdict string")
    got = url_rules.judge(df, RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        rule, verdict = stated(r.url)
        assert (r.host, r.path, r.rule) == (*cut(r.url), rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")
    assert url_rules.judge(df.limit(0), RULES).count() == 0


def test_mined_rules_against_counting(llm):
    """All rules there are, with support and confidence, and every verdict, by
    counting over every set of items."""
    rng = random.Random(8)
    urls = [f"http://{rng.choice(['www', 'm', 'bad'])}.{rng.choice(['x', 'y', 'spam'])}.{rng.choice(['com', 'net'])}"
            f"/{rng.choice(['en', 'de'])}/{rng.randint(1, 400)}" for _ in range(400)]
    label = lambda u: None if rng.random() < 0.2 else "block" if "spam" in u or "bad" in u else "allow"
    rows = [(u, label(u)) for u in urls]
    df = llm.createDataFrame(rows, "url string, label string")
    tokens = {r.url: frozenset(r.t) for r in df.select("url", url_rules.url_tokens(F.col("url")).alias("t")).collect()}
    mined = url_rules.mine_rules(df, min_support=0.02, min_confidence=0.8)
    known = [(tokens[u], v) for u, v in rows if v]
    rules = mined.collect()
    assert {(r["items"] and tuple(r["items"]), r.verdict): (round(r.confidence, 9), round(r.support, 9)) for r in rules} \
        == brute_rules(known, 0.02, 0.8)
    assert all(r.key in r.of[0] and [min(a) for a in r.of] != [] and sorted(min(a) for a in r.of) == r["items"]
               for r in rules)
    check_verdicts(url_rules.judge_mined(df, mined, "url", "out").collect(), rules, tokens, "allow")
    assert all(r.out == "block" for r in url_rules.judge_mined(df, mined, "url", "out").collect() if "spam" in r.url)


def brute_rules(known, min_support, min_confidence):
    """{(items, verdict): (confidence, support)} by enumeration: items are
    tokens of the same labelled URLs, named by the first of them."""
    import itertools
    import math
    least = math.ceil(min_support * len(known))
    held: dict = {}
    for t in set().union(*(t for t, _ in known)):
        at = frozenset(i for i, (tokens, _) in enumerate(known) if t in tokens)
        if len(at) >= least:
            held.setdefault(at, []).append(t)
    items = {min(ts): at for at, ts in held.items()}
    rules = {}
    level = [((n,), at) for n, at in sorted(items.items())]
    while level:
        for names, at in level:
            for v in {known[i][1] for i in at}:
                n = sum(known[i][1] == v for i in at)
                if n >= least and n / len(at) >= min_confidence:
                    rules[names, v] = (n / len(at), n / len(known))
        level = [((*names, n), both) for names, at in level for n, other in sorted(items.items())
                 if n > names[-1] and len(both := at & other) >= least]
    best: dict = {}
    for (names, _), rank in rules.items():
        best[names] = max(best.get(names, rank), rank)
    return {(names, v): (round(rank[0], 9), round(rank[1], 9)) for (names, v), rank in rules.items()
            if not any(best.get(fewer, (0, 0)) >= rank for fewer in itertools.combinations(names, len(names) - 1) if fewer)}


def check_verdicts(got, rules, tokens, default, verdict="out"):
    for r in got:
        fits = [(x.confidence, x.support, len(x["items"]), x["items"], x.verdict)
                for x in rules if all(set(a) & tokens[r.url] for a in x.of)]
        assert r[verdict] == (max(fits)[-1] if fits else default)


def test_every_part_of_a_url_is_mined(llm):
    """A host label, a late path segment or one query key among several decides,
    wherever it stands; a long URL does not multiply the rules."""
    good = [(f"http://www.site{i}.com/a/b/c{i}/d?k{i}=1&page=2", "allow") for i in range(40)]
    bad = ([(f"http://{'www.' * (i % 2)}casino-win.x.com/a/{i}", "block") for i in range(10)]
           + [(f"http://www.site{i}.com/a/b/c{i}/deep/malware/{i}", "block") for i in range(10)]
           + [(f"http://www.site{i}.com/a/b?k{i}=1&track=3&z{i}=2", "block") for i in range(10)]
           + [("http://long.net/" + "/".join(f"s{i}" for i in range(300)), "block")])
    df = llm.createDataFrame(good + bad, "url string, label string")
    mined = url_rules.mine_rules(df, min_support=0.01, min_confidence=0.8)
    asked = {"http://m.casino-win.x.com/en/1": "block", "http://q.org/1/2/3/4/malware": "block",
             "http://q.org/?a=1&track=1&b=2": "block", "http://other.net/s250": "block", "http://q.org/": "allow"}
    got = url_rules.judge_mined(llm.createDataFrame([(u,) for u in asked], "url string"), mined, "url", "out")
    assert {r.url: r.out for r in got.collect()} == asked


def test_no_labels_and_no_pages(llm):
    df = llm.createDataFrame([("http://a.net/x", None)], "url string, label string")
    mined = url_rules.mine_rules(df)
    assert mined.count() == 0
    assert [r.out for r in url_rules.judge_mined(df, mined, "url", "out", "block").collect()] == ["block"]


def test_url_query(llm):
    got = {r.page_id: r for r in url_rules.op8_url_rules(llm, SF_SMALL).collect()}
    pages = pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist()
    assert len(got) == len(pages)
    rest = []
    for p in pages:
        r = got[p["page_id"]]
        rule, verdict = stated(p["url"])
        assert (r.host, r.path, r.rule) == (*cut(p["url"]), rule)
        if verdict:
            assert r.verdict == verdict
        else:
            rest.append((r.verdict, p["url"]))
    # The others follow the rules mined from the URLs that a stated rule decides.
    df = llm.createDataFrame([(p["url"], stated(p["url"])[1]) for p in pages], "url string, label string")
    rules = url_rules.mine_rules(df).collect()
    tokens = {r.url: frozenset(r.t) for r in df.select("url", url_rules.url_tokens(F.col("url")).alias("t")).collect()}
    for verdict, url in rest:
        fits = [(x.confidence, x.support, len(x["items"]), x["items"], x.verdict)
                for x in rules if all(set(a) & tokens[url] for a in x.of)]
        assert verdict == (max(fits)[-1] if fits else "allow")
    assert rules and rest


def test_rules_do_not_multiply(llm):
    """Long paths whose parts come together are one item: a rule per token of
    the rarest one, not per choice of tokens."""
    rows = [(f"http://a{i}.net/" + "/".join(f"p{k}" for k in range(16)) + "/" + "/".join(f"q{k}" for k in range(i % 2 * 16)),
             "block" if i % 2 else "allow") for i in range(60)]
    mined = url_rules.mine_rules(llm.createDataFrame(rows, "url string, label string"), min_support=0.05, min_confidence=0.8)
    assert mined.count() <= 40


def test_clashing_url_columns_pass_through(llm):
    df = llm.createDataFrame([(1, "http://org/a", "s", "m", "t", "v")],
                             "page_id bigint, url string, stated string, learned string, tokens string, Verdict string")
    r = url_rules.judge(df, RULES).first()
    assert (r.stated, r.learned, r.tokens, r.verdict, r.rule) == ("s", "m", "t", "allow", "org/")
