"""URL filters against a plain version that walks a tree of dictionaries."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm_frames import FOLDER
from tidemark.llm import queries, url_templates

RULES = queries.URL_RULES
KNOWN = (
    ("https://WWW.Example.ORG/en/12.html?x=1", "www.example.org", "/en/12.html", "example.org/en/1", "block"),
    ("http://example.org/es/4#top", "example.org", "/es/4", "example.org/es/", "block"),
    ("http://a.example.org/ES/4", "a.example.org", "/ES/4", "org/", "allow"),
    ("http://b.com/de/1", "b.com", "/de/1", "com/de/", "block"),
    ("http://b.com/fr/1://x/de/", "b.com", "/fr/1://x/de/", "com/fr/", "allow"),
    ("http://com/fr/", "com", "/fr/", "com/fr/", "allow"),
    ("x://org", "org", "", None, None),
    ("http://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
    ("http://telecom/de/1", "telecom", "/de/1", None, None),
    ("http://b.com:80/de/1", "b.com:80", "/de/1", None, None),
    ("no scheme example.org/es/1", "", "", None, None),
    ("http://?a/b", "", "", None, None),
    ("://b.com/de/x://y", "b.com", "/de/x://y", "com/de/", "block"),
    ("ftp://Ünï.net/a b/%20\n/?q", "Ünï.net", "/a b/%20\n/", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
)


def plain_parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path, rules=RULES):
    fits = [
        r
        for r in rules
        for name, start in [(r[: r.index("/")], r[r.index("/") :])]
        if (host == name or host.endswith("." + name)) and path.startswith(start)
    ]
    return max(fits, key=lambda r: (len(r), r.index("/")), default=None)


def plain_segments(path, depth):
    path = path.removeprefix("/").removesuffix("/")
    out = []
    for part in path.split("/") if path else []:
        ending = re.search(r"\.[A-Za-z0-9]{1,5}\Z", part)
        stem = part[: ending.start()] if ending else part
        kind = "?n" if re.fullmatch("[0-9]+", stem) else "?x" if re.search("[0-9]", stem) else None
        kind = kind or ("?w" if len(part) > 64 else None)
        out.append(kind + ".*" * bool(ending) if kind else part)
    return tuple(out) if len(out) <= depth else (*out[: depth - 1], "?**")


def plain_templates(pages, depth, literal):
    """(host, segments) -> (template, purity); ``pages`` are (host, segments, label)."""
    good = sum(label == 0 for *_, label in pages)
    bad = sum(label == 1 for *_, label in pages)
    share, found = (bad + 1) / (good + bad + 2), {}

    def grow(rows, level, template, purity):
        for segs in {s for s, _ in rows if len(s) == level}:
            found[host, segs] = template, purity
        rows = [(s, label) for s, label in rows if len(s) > level]
        counts = Counter(s[level] for s, _ in rows)

        def general(seg):
            if seg[:1] == "?" or counts[seg] >= literal * len(rows):
                return seg
            return "?w.*" if re.search(r"\.[A-Za-z0-9]{1,5}\Z", seg) else "?w"

        branches = {}
        for s, label in rows:
            branches.setdefault(general(s[level]), []).append((s, label))
        groups = []
        for name, own in sorted(branches.items(), key=lambda b: (-len(b[1]), b[0])):
            labels = Counter(str(label) for _, label in own)
            after = Counter(
                "end" if len(s) == level + 1 else s[level + 1] if s[level + 1][:1] == "?" else "literal"
                for s, _ in own
            )
            for group in groups:
                if similar(group[1], labels) and similar(group[2], after):
                    group[0].append(name)
                    group[1].update(labels)
                    group[2].update(after)
                    group[3].extend(own)
                    break
            else:
                groups.append([[name], labels, after, list(own)])
        for names, labels, _, own in groups:
            known = labels["0"] + labels["1"]
            name = names[0] if len(names) == 1 else "(" + "|".join(sorted(names)) + ")"
            grow(own, level + 1, f"{template}/{name}", (labels["1"] + 5 * purity) / (known + 5))

    by_host = {}
    for host, segs, label in pages:
        by_host.setdefault(host, []).append((segs, label))
    for host, rows in by_host.items():
        good, bad = (sum(label == k for _, label in rows) for k in (0, 1))
        grow(rows, 0, "", (bad + 5 * share) / (good + bad + 5))
    return found


def similar(a, b):
    keys, n_a, n_b = sorted({*a, *b}), a.total(), b.total()
    square = 0.0
    for k in keys:
        for own, n in ((a, n_a), (b, n_b)):
            wanted = (a[k] + b[k]) * n / (n_a + n_b)
            square += (own[k] - wanted) ** 2 / wanted
    df = len(keys) - 1
    if not df:
        return True
    return square <= df * (1 - 2 / 9 / df + 3.09 * (2 / 9 / df) ** 0.5) ** 3 or square <= 0.01 * (n_a + n_b)


def plain_verdicts(urls, rules=RULES, depth=6, literal=0.02):
    rows = []
    for url in urls:
        host, path = plain_parse(url)
        rule = plain_rule(host, path, rules)
        label = None if rule is None else int(rules[rule] == "block")
        rows.append((host, path, rule, label, plain_segments(path, depth)))
    tree = plain_templates([(h, s, label) for h, _, _, label, s in rows], depth, literal)
    out = []
    for host, path, rule, label, segs in rows:
        template, purity = tree[host, segs]
        verdict = ("allow", "block")[int(purity >= 0.75) if label is None else label]
        out.append((host, path, rule, verdict, template, purity))
    return out


def same(found, ids, wanted):
    rows = sorted(map(tuple, found.collect()), key=repr)
    expected = sorted(((i, *w) for i, w in zip(ids, wanted)), key=repr)
    assert [r[:6] for r in rows] == [r[:6] for r in expected]
    assert all(abs(r[6] - e[6]) < 1e-9 for r, e in zip(rows, expected))


def framed(ready, urls):
    rows = [(i, u) for i, u in enumerate(urls)]
    names = "host path rule verdict template purity key node seg segs n good bad label tm_page html".split()
    return ready.createDataFrame(rows, "page_id long, url string").withColumns({n: F.lit(n) for n in names})


def test_known_urls(ready):
    rows = url_templates.judge_urls(framed(ready, [k[0] for k in KNOWN]), RULES).collect()
    for r in rows:
        _, host, path, rule, verdict = KNOWN[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict or verdict is None
    assert len(rows) == len(KNOWN)


@pytest.mark.parametrize("folder", (FOLDER, "/root/testdata/sf0.1"))
def test_whole_table_equals_plain_version(ready, folder):
    rows = ready.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()
    found = queries.op12_url_templates(ready, folder)
    same(found, [r["page_id"] for r in rows], plain_verdicts([r["url"] for r in rows]))


def many_urls():
    urls = [k[0] for k in KNOWN]
    for i in range(150):  # slugs, dates, ids, files, deep paths; a hot host with good and bad parts
        urls += [
            f"http://hot.com/de/{i}",
            f"http://hot.com/fr/{i}/",
            f"http://hot.com/news/{2000 + i % 9}/{chr(97 + i % 26) * 3}{chr(97 + i % 7)}-story.html",
            f"http://hot.com/{'abc'[i % 3]}/list/{i}",
            f"http://deep.net/a/b/c/d/e/f/g/{i}",
            f"http://bad.com/de/x{i}y.php",
            "http://hot.com/fr/same",
        ]
    urls += ["http://bad.com/en/page", "http://bad.com/" + "z" * 100_000, "http://s.net//a//", "http://s.net/?/a"]
    urls += ["http://s.net/a/\n", "http://s.net/12\n", "http://s.net/a.htm\n/b"]
    return urls


@pytest.mark.parametrize("depth, literal", ((6, 0.02), (2, 0.3), (1, 0.0)))
def test_many_kinds_equal_plain_version(ready, depth, literal):
    urls = many_urls()
    found = url_templates.judge_urls(framed(ready, urls).repartition(5), RULES, depth=depth, literal=literal)
    same(found, range(len(urls)), plain_verdicts(urls, RULES, depth, literal))


def test_templates_generalise_merge_and_judge(ready):
    urls = many_urls()
    rows = url_templates.judge_urls(framed(ready, urls), RULES).collect()
    templates = {r["template"] for r in rows if r["host"] == "hot.com"}
    assert "/(a|b|c)/list/?n" in templates  # alike, so one branch
    assert not any("(de|fr)" in t for t in templates)  # told apart by their labels
    verdicts = {urls[r["page_id"]]: (r["verdict"], r["rule"]) for r in rows}
    assert verdicts["http://bad.com/en/page"] == ("block", None)
    assert verdicts["http://hot.com/fr/same"] == ("allow", "com/fr/")


def test_without_rules_or_rows(ready):
    frame = framed(ready, ["http://a.net/x", "http://a.net/x", None])
    assert {(r["verdict"], r["purity"]) for r in url_templates.judge_urls(frame, {}).collect()} == {("allow", 0.5)}
    assert url_templates.judge_urls(frame.filter("false"), RULES).count() == 0
    with pytest.raises(ValueError):
        url_templates.judge_urls(frame, {"a.net/": "maybe"})
