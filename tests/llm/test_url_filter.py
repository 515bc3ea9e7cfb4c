import math
import random
from collections import defaultdict

import pytest

from tagpulse.llm import url_filter as U


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "<p>", "x", 1) for i, u in urls], "page_id long, url string, html string, template string, pages int")


def labels(spark, rows):
    return spark.createDataFrame(rows, "page_id long, bad int")


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    stop = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), path[:stop]


def brute_rule(host, path):
    fits = [(h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[0]), default=None)


URLS = ["http://a.net", "http://a.net/", "http://net/x", "http://xnet/x", "HTTP://A.Example.NET/en/1?q#f", "http://example.net/en", "http://example.net/EN/1",
        "https://x.y.example.com/de/1", "https://example.com/de", "http://b.org/fr/2", "http://b.org/de/2", "http://b.org?/fr/", "http://b.org#://net/",
        None, "", "no scheme", "ftp://", "://net/z", "http://É.net/é", "http://a.com/a\nb/c", "http://u:p@a.net:80/x", "http://a.net:80/x"]


def test_hosts_paths_and_rules(spark):
    found = {r.page_id: r for r in U.judge(pages(spark, list(enumerate(URLS))), labels(spark, [])).collect()}
    assert len(found) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = host_path(url)
        rule = brute_rule(host, path)
        r = found[i]
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[0]), url
        assert r.verdict == (rule[1] if rule else "allow")


def closed(group, tally, overall):
    """A class whose lowest and highest rates differ is no class: each branch goes with the nearer end."""
    rated = [((bad + U.PRIOR * overall) / (n + U.PRIOR), bad, n, b) for b in group for bad, n in [tally(b[2])]]
    known = sorted((r[:3] for r in rated if r[2] >= U.PRIOR))
    if known:
        (low, bad, n), (high, last, m) = known[0], known[-1]
        pooled = (bad + last) / (n + m)
        if abs(bad / n - last / m) > U.SIMILAR_Z * math.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m)):
            near_low = [b for rate, _, _, b in rated if rate - low <= high - rate]
            near_high = [b for rate, _, _, b in rated if rate - low > high - rate]
            return [*closed(near_low, tally, overall), *closed(near_high, tally, overall)]
    return [group]


def brute_templates(rows, marked):
    """The tree, node by node."""
    info = {i: (*host_path(u), marked.get(i)) for i, u in rows}
    total = [b for *_, b in info.values() if b is not None]
    overall = sum(total) / len(total) if total else 0.0
    walk = {i: "" for i in info}
    segments = {i: [s for s in p.split("/") if s] for i, (_, p, _) in info.items()}
    for depth in range(min(max(map(len, segments.values())), U.MAX_DEPTH)):
        nodes = defaultdict(list)
        for i, t in walk.items():
            nodes[info[i][0], t].append(i)
        for (_, template), members in nodes.items():
            by = defaultdict(list)
            for i in members:
                by[segments[i][depth] if depth < len(segments[i]) else ""].append(i)
            branches = [(0, s, m) for s, m in by.items() if len(m) >= U.MIN_PAGES and len(m) >= U.MIN_SHARE * len(members)]
            own = {i for _, _, m in branches for i in m}
            wild = [i for i in members if i not in own]
            branches += [(1, "*", wild)] if wild else []

            def tally(m):
                seen = [info[i][2] for i in m if info[i][2] is not None]
                return sum(seen), len(seen)

            branches.sort(key=lambda b: ((tally(b[2])[0] + U.PRIOR * overall) / (tally(b[2])[1] + U.PRIOR), b[0], b[1]))
            groups = []
            for b in branches:
                bad, n = tally(b[2])
                if groups:
                    last, m = tally(groups[-1][-1][2])
                    pooled = (bad + last) / max(n + m, 1)
                    if n and m and abs(bad / n - last / m) > U.SIMILAR_Z * math.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m)):
                        groups.append([b])
                        continue
                    groups[-1].append(b)
                else:
                    groups.append([b])
            groups = [part for g in groups for part in closed(g, tally, overall)]
            for g in groups:
                name = "{" + "|".join(sorted(b[1] for b in g)) + "}"
                for b in g:
                    for i in b[2]:
                        walk[i] = f"{template}/{name}"
    tallies = defaultdict(lambda: [0, 0])
    for i, t in walk.items():
        if info[i][2] is not None:
            for key in ((info[i][0],), (info[i][0], t)):
                tallies[key][0] += info[i][2]
                tallies[key][1] += 1
    smooth = lambda key, prior: (tallies[key][0] + U.PRIOR * prior) / (tallies[key][1] + U.PRIOR)
    return {i: (t, smooth((info[i][0], t), smooth((info[i][0],), overall))) for i, t in walk.items()}


@pytest.mark.parametrize("seed", range(2))
def test_templates_equal_brute_force(spark, seed):
    rng, rows, marked = random.Random(seed), [], {}
    for i in range(900):
        host = rng.choice(["a.com", "a.com", "b.org", "c.com"])
        section = rng.choice(["spam", "news", "blog", "shop", f"rare{i}", ""])
        rows.append((i, f"http://{host}/{section}/{rng.choice(['x', 'y', str(i)])}/{i}" if section else f"http://{host}"))
        if rng.random() < 0.7:
            marked[i] = int(rng.random() < {"spam": 0.95, "shop": 0.25}.get(section, 0.05))
    found = U.judge(pages(spark, rows).repartition(3), labels(spark, list(marked.items()) + [(None, 1), (3, None)])).collect()
    want = brute_templates(rows, marked)
    assert {r.page_id: r.template for r in found} == {i: t for i, (t, _) in want.items()}
    for r in found:
        assert r.purity == pytest.approx(want[r.page_id][1])
        if r.rule is None:
            assert r.verdict == ("block" if r.purity >= U.REJECT else "allow")
    blocked = [r.path.split("/")[1] for r in found if r.rule is None and r.verdict == "block"]
    assert blocked.count("spam") > 0.9 * len(blocked) > 0


def test_no_labels_repeated_pages_and_no_pages(spark):
    found = U.judge(pages(spark, [(1, "http://a.com/x"), (1, "http://a.com/x"), (1, "http://b.com/y"), (None, "http://c.com/z")]), labels(spark, [])).collect()
    assert len(found) == 4 and {r.verdict for r in found} == {"allow"}
    assert U.judge(pages(spark, []), labels(spark, [(1, 1)])).count() == 0


def test_small_directories_of_a_large_host_are_branches(spark):
    names = ["spam", *[f"d{k}" for k in range(100)]]
    rows = [(n, f"http://a.com/{name}/{n}") for n, name in enumerate(name for name in names for _ in range(30))]
    found = U.judge(pages(spark, rows), labels(spark, [(n, int("/spam/" in u)) for n, u in rows])).collect()
    assert len(found) == len(rows)
    assert {r.path.split("/")[1] for r in found if r.verdict == "block"} == {"spam"}
    assert sum(r.verdict == "block" for r in found) == 30
    assert len({r.template for r in found}) == 2 and max(len(r.template) for r in found) < 300


def test_segments_at_any_depth_take_part(spark):
    ends = ["spam", "news"]
    rows = [(n, f"http://a.com/1/2/3/4/5/6/7/{ends[n % 2]}/{n}") for n in range(120)]
    marked = [(n, 1 - n % 2) for n, _ in rows]
    rows += [(1000, "http://a.com/" + "/".join("x" * 60)), (1001, "http://b.com/y")]
    found = U.judge(pages(spark, rows), labels(spark, marked)).collect()
    assert sorted(r.page_id for r in found) == [n for n, _ in rows]
    assert {r.page_id for r in found if r.verdict == "block" and r.page_id < 1000} == set(range(0, 120, 2))


def test_a_row_of_rates_from_clean_to_bad_is_no_single_class(spark):
    """41 directories of 40 pages with 0, 1, ... 40 bad ones: neighbours differ by chance, the ends don't."""
    rows, marked = [], []
    for k in range(41):
        for j in range(40):
            rows.append((len(rows), f"http://a.com/d{k:02d}/{j}"))
            marked.append((len(rows) - 1, int(j < k)))
    found = U.judge(pages(spark, rows), labels(spark, marked)).collect()
    by = {}
    for r in found:
        by.setdefault(r.path.split("/")[1], set()).add(r.verdict)
    assert by["d00"] == by["d05"] == {"allow"} and by["d40"] == by["d35"] == {"block"}


def test_a_literal_star_is_not_the_wildcard(spark):
    rows = [(n, "http://a.com/*/x") for n in range(100)] + [(100 + n, f"http://a.com/p{n}/x") for n in range(300)]
    found = U.judge(pages(spark, rows), labels(spark, [(n, int(n < 100)) for n, _ in rows])).collect()
    assert {r.page_id for r in found if r.verdict == "block"} == set(range(100))


def test_a_segment_that_reads_like_a_class_is_its_own(spark):
    rows = [(n, "http://a.com/a|b/x") for n in range(60)] + [(60 + n, f"http://a.com/{'ab'[n % 2]}/x") for n in range(200)]
    found = U.judge(pages(spark, rows), labels(spark, [(n, int(n < 60)) for n, _ in rows])).collect()
    assert {r.page_id for r in found if r.verdict == "block"} == set(range(60))
