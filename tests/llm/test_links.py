import re
from collections import Counter, defaultdict

import pytest

from skyledger.llm.links import BLOCK_ABOVE, JUMP, RULES, host_scores, judge, op1_url_filter

SCHEMA = "page_id long, url string, html string, host string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def plain_scores(seeds, edges, rounds=200):
    """Both walks in a loop; seeds {host: (trust, distrust)}, edges {(src, dst): weight}."""
    out = []
    for kind, turned in ((0, False), (1, True)):
        links = {((b, a) if turned else (a, b)): w for (a, b), w in edges.items()}
        whole = Counter()
        for (a, _), w in links.items():
            whole[a] += w
        now = {h: s[kind] for h, s in seeds.items()}
        for _ in range(rounds):
            new = defaultdict(float, {h: JUMP * s[kind] for h, s in seeds.items()})
            for (a, b), w in links.items():
                new[b] += (1 - JUMP) * now.get(a, 0) * w / whole[a]
            now = new
        out.append(now)
    return out


def test_walks_against_a_loop(spark):
    seeds = {"a": (3, 0), "b": (0, 2), "c": (1, 1)}
    edges = {("a", "d"): 2, ("d", "e"): 1, ("e", "a"): 1, ("f", "b"): 1, ("f", "a"): 3, ("g", "f"): 1, ("c", "b"): 5, ("h", "i"): 1}
    got = host_scores(
        spark.createDataFrame([(h, *s) for h, s in seeds.items()], "host string, trust long, distrust long"),
        spark.createDataFrame([(*e, w) for e, w in edges.items()], "src string, dst string, weight long"),
    ).collect()
    trust, distrust = plain_scores(seeds, edges)
    for r in got:
        assert abs(r.trust - trust.get(r.host, 0)) < 0.05 and abs(r.distrust - distrust.get(r.host, 0)) < 0.05
    assert {r.host for r in got} == {h for h in "abcdefghi" if trust.get(h, 0) + distrust.get(h, 0) > 0}


def test_pages_rules_links_nulls_and_clashing_columns(spark):
    bad, good = '<p><a href="https://x.example.org/es/1">x</a>', "<A class=k HREF='//W.example.org/fr/'>w</A><a href='/rel'>r</a>"
    rows = [
        (1, "http://x.example.org/es/1", None, "c"),
        (2, "https://Farm.example.net/en/1?q#f", bad * 3, "c"),
        (3, "https://nice.example.net/en/1", "nothing", "c"),
        (4, "http://w.example.org/fr/9", '<a href="https://nice.example.net/">n</a>', None),
        (5, None, good, "c"),
        (6, "no scheme", None, "c"),
        (7, "http://example.org/en/12", "", "c"),
        (8, "http://com?x", "", "c"),
        (9, "http://a.b.com/fr/" + "x" * 50_000, "y" * 300_000, "c"),
        (9, "http://a.b.com/de/2", "", "c"),
        (None, "ftp://É.COM/de/", good, "c"),
        (10, "http://notexample.org/es/", good, "c"),
        (10, "http://notexample.org/es/", good, "c"),
    ]
    got = judge(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    want = Counter((r[0], *split(r[1]), getattr(rule(*split(r[1])), "text", None)) for r in rows)
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in got) == want
    by_id = {r.page_id: r.verdict for r in got}
    assert by_id[2] == "block" and by_id[3] == "allow" and by_id[5] == by_id[6] == "allow" and by_id[7] == "block"
    assert judge(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_against_a_loop(spark):
    sf = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    seeds = defaultdict(lambda: [0, 0])
    for p in pages:
        if r := rule(*split(p.url)):
            seeds[split(p.url)[0]][r.verdict == "block"] += 1
    trust, distrust = plain_scores(seeds, {})
    want = Counter()
    for p in pages:
        host, path = split(p.url)
        r = rule(host, path)
        t, d = trust.get(host, 0), distrust.get(host, 0)
        want[p.page_id, host, path, r and r.text, r.verdict if r else "block" if d > BLOCK_ABOVE * (t + d) else "allow"] += 1
    assert not any("://" in re.sub(r'"https?://[^"]*schema', "", p.html) and re.search(r'<a [^>]*href="?(https?:)?//', p.html) for p in pages)
    assert Counter(tuple(r)[:5] for r in op1_url_filter(spark, sf).collect()) == want


def test_plan_runs_no_python(spark):
    plan = op1_url_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and not re.search("Python|Pandas|Arrow", plan)


def test_unrelated_hosts_and_long_chains_cut_no_walk(spark):
    """A chain of links to a blocked host, among many seed hosts that nothing leads to."""
    chain = 35
    seeds = spark.createDataFrame([("h0", 0, 1)], "host string, trust long, distrust long")
    others = spark.range(100_000).selectExpr("concat('other', id) as host", "20L as trust", "0L as distrust")
    edges = spark.createDataFrame([(f"h{i + 1}", f"h{i}", 1) for i in range(chain)], "src string, dst string, weight long")
    got = {r.host: r for r in host_scores(seeds.unionByName(others), edges).where("host like 'h%'").collect()}
    assert set(got) == {f"h{i}" for i in range(chain + 1)}
    for i in range(chain + 1):
        want = JUMP * (1 - JUMP) ** i
        assert got[f"h{i}"].trust == 0 and abs(got[f"h{i}"].distrust - want) < 1e-5 * want


def test_small_scores_settle_as_well_as_large_ones(spark):
    """Relative to each score, also behind a cycle and far below the seeds; not settled in time is an error."""
    seeds = {"a": (1_000_000, 0), "b": (0, 1)}
    edges = {("a", "c"): 1, ("c", "a"): 1, ("d", "b"): 1, ("d", "e"): 999, ("e", "d"): 1, ("e", "f"): 99, ("f", "e"): 1}
    frames = (
        spark.createDataFrame([(h, *s) for h, s in seeds.items()], "host string, trust long, distrust long"),
        spark.createDataFrame([(*e, w) for e, w in edges.items()], "src string, dst string, weight long"),
    )
    trust, distrust = plain_scores(seeds, edges, 1000)
    for r in host_scores(*frames).collect():
        for got, want in ((r.trust, trust.get(r.host, 0)), (r.distrust, distrust.get(r.host, 0))):
            assert abs(got - want) <= 1e-4 * want
    with pytest.raises(RuntimeError):
        host_scores(*frames, rounds=3)
