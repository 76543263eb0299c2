import re

from ledgerlens.llm import urlfilter
from ledgerlens.llm.queries import URL_RULES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = host.translate(LOWER)
    best = None
    for rule in URL_RULES:
        own, _, begin = rule.text.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + begin) and (best is None or len(rule.text) > len(best.text)):
            best = rule
    return host, path, best and best.text, best and best.verdict


URLS = [None, "", "no scheme", "http://", "http://A.Example.COM", "http://a.example.com/en", "http://a.example.com/en/1", "https://www.example.com/en/2?x=/fr/",
        "http://b.www.example.com/en/", "http://xexample.com/en/", "http://q.net/es/3#top", "http://q.net/ES/3", "http://Q.NET/fr/", "http://net/es/",
        "http://q.org/fr/1", "x://y.net/es/://z.com/", "http://q.com\n/a", "http://é.com/ü", "http://q.net?/es/", "http://com/", "http://q.net//es/"]


def test_hosts_paths_and_rules_equal_brute_force(spark):
    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate(URLS)] + [(3, URLS[3], 1)], "page_id long, url string, host int")
    got = urlfilter.judge_urls(df, URL_RULES).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path, rule, verdict = brute_rule(URLS[r.id])
        assert (r.host, r.path, r.rule) == (host, path, rule), URLS[r.id]
        if verdict:
            assert r.verdict == verdict
        assert r.verdict in ("allow", "block")


def test_templates_generalise_ids_and_many_children(spark):
    urls = [f"http://a.org/en/{i}.html" for i in range(30)] + [f"http://a.org/user/name{chr(97 + i % 26)}{i}x/posts" for i in range(40)]
    urls += [f"http://a.org/{s}/about" for s in ("x", "y") for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.template for r in urlfilter.judge_urls(df, []).collect()}
    assert got == {"/en/*", "/user/*/posts", "/x/about", "/y/about"}


def test_rejection_by_smoothed_share(spark):
    rows = [("a", "/bad/*", 1)] * 60 + [("a", "/bad/*", None)] * 5 + [("a", "/worse/*", 1)] * 40 + [("a", "/mixed/*", 1)] * 20 + [("a", "/mixed/*", 0)] * 20
    rows += [("a", "/few/*", 1)] * 2 + [("a", "/good/*", 0)] * 200 + [("a", "/none/*", None)] * 50 + [("b", "/bad/*", 0)] * 10
    df = spark.createDataFrame(rows, "host string, template string, bad int")
    got = {(r.host, r.template) for r in urlfilter.rejected_templates(df).collect()}
    assert got == {("a", "/bad/*"), ("a", "/worse/*"), ("a", "/few/*")}   # the few are pooled with their like
    lone = spark.createDataFrame([r for r in rows if r[1] not in ("/bad/*", "/worse/*")], df.schema)
    assert urlfilter.rejected_templates(lone).count() == 0                  # two rows alone are no evidence


def test_method_rejects_urls_without_a_rule(spark):
    urls = [f"http://h.org/list/{i}/spam" for i in range(200)]
    rules = [urlfilter.UrlRule(f"h.org/list/{i}/", "block") for i in range(0, 200, 2)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = urlfilter.judge_urls(df, rules[:60]).collect()
    assert {r.verdict for r in got} == {"block"} and sum(r.rule is None for r in got) == 140


def test_deep_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.org/" + "a/" * 50), (2, "http://a.org")], "page_id long, url string")
    got = {r.id: r.template for r in urlfilter.judge_urls(df, []).collect()}
    assert got == {1: "/a" * 50, 2: ""}
    shared = spark.createDataFrame([(i, "http://a.org/" + "b/" * 12 + x) for i, x in enumerate(["x/y/z", "x/y", "", "q/7/r/8"])], df.schema)
    got = {r.id: r.template for r in urlfilter.judge_urls(shared, []).collect()}
    assert got == {0: "/b" * 12 + "/x/y/z", 1: "/b" * 12 + "/x/y", 2: "/b" * 12, 3: "/b" * 12 + "/q/*/r/*"}
    long = spark.createDataFrame([(1, "http://a.org/" + "s" * 200_000 + "/" + "/".join(f"k{i}" for i in range(3000)))], df.schema)
    assert urlfilter.judge_urls(long, URL_RULES).first().template.endswith("/k2999")
    assert urlfilter.judge_urls(spark.createDataFrame([], df.schema), URL_RULES).count() == 0


def verdicts(spark, urls, rules):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {urls[r.id]: r.verdict for r in urlfilter.judge_urls(df, rules).collect()}


def test_clean_sections_beside_a_blocked_one(spark):
    """Neither the number of sections nor their rarity passes one section's labels to the others."""
    bad = [f"http://x.net/es/{i}" for i in range(100)]
    for sections, pages in ((200, 12), (201, 12), (201, 2), (60, 1)):
        clean = [f"http://x.net/sec{chr(97 + i % 26)}{chr(97 + i // 26)}/{j}" for i in range(sections) for j in range(pages)]
        got = verdicts(spark, bad + clean, URL_RULES)
        assert {got[u] for u in bad} == {"block"} and {got[u] for u in clean} == {"allow"}, (sections, pages)


def test_a_rare_blocked_section_does_not_speak_for_the_rest(spark):
    bad = [f"http://x.net/es/{i}" for i in range(9)]
    clean = [f"http://x.net/sec{chr(97 + i % 26)}{chr(97 + i // 26)}/{i}" for i in range(60)]
    got = verdicts(spark, bad + clean, URL_RULES)
    assert {got[u] for u in bad} == {"block"} and {got[u] for u in clean} == {"allow"}


def brute_templates(urls):
    """Template of each different (host, path), node by node."""
    found = {}

    def grow(host, members, at, template):
        by = {}
        for path, segs in members:
            if at == len(segs):
                found[host, path] = template
            else:
                own = segs[at]
                by.setdefault("*" if re.match(urlfilter.ID_SEGMENT, own) else own, []).append((path, segs))
        total = sum(map(len, by.values()))
        rare = [k for k, v in by.items() if k != "*" and len(v) < total * urlfilter.LITERAL_SHARE]
        if len(rare) >= urlfilter.MANY_CHILDREN:
            for k in rare:
                by.setdefault("*", []).extend(by.pop(k))
        for k, v in by.items():
            grow(host, v, at + 1, f"{template}/{k}")

    hosts = {}
    for u in set(urls):
        host, path, _, _ = brute_rule(u)
        hosts.setdefault(host, set()).add(path)
    for host, paths in hosts.items():
        grow(host, [(p, [x for x in p.split("/") if x]) for p in paths], 0, "")
    return found


def test_tree_equals_brute_force(spark):
    import random
    g = random.Random(3)
    names = ["".join(g.choice("abcdefgh") for _ in range(g.randint(2, 7))) for _ in range(60)]
    urls = [f"http://{g.choice('pq')}.org/" + "/".join(g.choice([g.choice(names), g.choice(names[:4]), str(g.randint(0, 40)), "index.html"])
                                                     for _ in range(g.randint(0, 5))) for _ in range(900)]
    want = brute_templates(urls)
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {(r.host, r.path): r.template for r in urlfilter.judge_urls(df, []).collect()}
    assert got == want and any("*" in t for t in want.values())


def test_verdicts_do_not_change_with_repeated_rows(spark):
    urls = [f"http://x.org/name{chr(97 + i % 26)}{chr(97 + i // 26)}q/post" for i in range(100)] + [f"http://y.org/s{chr(97 + i)}/{j}" for i in range(5) for j in range(9)]
    rules = [urlfilter.UrlRule(f"x.org/name{chr(97 + i % 26)}{chr(97 + i // 26)}q/", "block") for i in range(60)]
    found = []
    for times in (1, 3, 10, 100):
        df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", f"explode(sequence(1, {times})) AS copy")
        got = urlfilter.judge_urls(df, rules).distinct().collect()
        assert len(got) == len(urls)
        found.append({(r.id, r.verdict, r.template) for r in got})
    assert found[0] == found[1] == found[2] == found[3]
    assert {v for i, v, _ in found[0] if i < 100} == {"block"} and {v for i, v, _ in found[0] if i >= 100} == {"allow"}


def test_unlabelled_branches_join_labelled_ones_of_their_shape(spark):
    """Ten blocked sections speak for an eleventh like them, two of four do not, nor do they for another shape."""
    many = [f"http://m.org/s{chr(97 + i)}x/{j}" for i in range(11) for j in range(9)]
    other = [f"http://m.org/other/{chr(97 + j)}-long-title-without-any-numbers" for j in range(5)]
    few = [f"http://f.net/{s}/{j}" for s in ("en", "es", "fr", "de") for j in range(30)]
    rules = [urlfilter.UrlRule(f"m.org/s{chr(97 + i)}x/", "block") for i in range(10)] + URL_RULES
    got = verdicts(spark, many + other + few, rules)
    assert {got[u] for u in many} == {"block"} and {got[u] for u in other} == {"allow"}
    assert {got[u] for u in few if "/en/" in u or "/de/" in u} == {"allow"}
