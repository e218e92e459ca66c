"""URL rules and propagation against plain code with the same whole numbers."""

import random
import re
from collections import Counter, defaultdict

from colsight.llm import op13_links as op13

SCHEMA = "page_id bigint, url string, html string"
LOWER = str.maketrans(op13.UPPER, op13.LOWER)


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match("[^?#]*", rest[len(host) :])[0]


def ruled(host, path, rules):
    fit = [(len(h + p), len(h), h + p, v) for v, h, p in rules if h and host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, default=(0, 0, None, None))[2:]


def plain(rows, rules=op13.RULES, rounds=op13.ROUNDS, threshold=op13.THRESHOLD):
    n, said, edges = Counter(), Counter(), set()
    for _, url, html in rows:
        host, path = split(url)
        if not host:
            continue
        n[host] += 1
        said[host, ruled(host, path, rules)[1]] += 1
        seen = re.sub(r"(?is)<!--.*?(-->|\Z)|<(script|style)\b.*?(</\2|\Z)", " ", html or "")
        for tag in re.findall(r"(?i)<a\s[^<>]*", seen):
            m = re.match(r"""(?is)<a\s(?:.*?\s)?href\s*=\s*["']?\s*([^"'\s]+)""", tag)
            if m and re.match("(?i)([a-z][a-z0-9+.-]*:)?//", m[1]):
                to = split(m[1] if "://" in m[1] else ":" + m[1])[0]
                if to and to != host:
                    edges.add((host, to))
    totals = []
    for kind, pairs in (("allow", edges), ("block", {(b, a) for a, b in edges})):
        out = defaultdict(list)
        for a, b in pairs:
            out[a].append(b)
        moving = {h: op13.MASS * said[h, kind] // n[h] for h in n}
        total = Counter()
        for _ in range(rounds + 1):
            after = Counter()
            for h, mass in moving.items():
                total[h] += mass - mass // 20 * 17
                for b in out[h]:
                    after[b] += mass // 20 * 17 // len(out[h])
            moving = after
        totals.append(total)
    trust, distrust = totals
    result = []
    for i, url, _ in rows:
        host, path = split(url)
        rule, verdict = ruled(host, path, rules)
        if host:
            rest = op13.MASS - op13.MASS * said[host, "allow"] // n[host] - op13.MASS * said[host, "block"] // n[host]
            whole = trust[host] + distrust[host] + rest - rest // 20 * 17
            blocked = distrust[host] > 0 and 100 * distrust[host] >= threshold * whole
        verdict = verdict or ("block" if host and blocked else "allow")
        result.append((i, host, path, rule, verdict, trust[host] if host else None, distrust[host] if host else None))
    return sorted(result, key=repr)


ODD = [
    (1, None, None), (2, "", "<a href=http://x.net/>"), (3, "no scheme", None), (4, "://", None), (5, "http://", "<p>"),
    (6, "HTTP://WWW.Example.COM/en/a?b#c", None), (7, "http://example.com/en/", None), (8, "http://a.www.example.com/en/x", None),
    (9, "http://notexample.com/en/x", None), (10, "http://com/", None), (11, "http://com", None), (12, "http://x.net/es", None),
    (13, "http://x.net/es/?q://z", None), (14, "http://x.net?u=://y.com/", None), (15, "x://y.org/a://b.com/c", None), (16, "http://ÀB.net/fr/", None),
    (17, "http://x.net:80/es/", None), (18, "http://a..net/es/x\ny", None), (19, "ht\ntp://q.net/fr/", None), (None, "http://x.net/es/1", None),
]


def graph(seed, n=400, hosts=60):
    rnd = random.Random(seed)
    names = [rnd.choice(["", "www.", "blog."]) + f"h{i}." + rnd.choice(["example.com", "net", "example.net", "org", "org", "org"]) for i in range(hosts)]
    rows = []
    for i in range(n):
        links = []
        for _ in range(rnd.randint(0, 5)):
            to = names[int(len(names) * rnd.random() ** 2)]
            links.append(
                rnd.choice(
                    ['<a href="https://{}/x">t</a>', "<A class=b HREF='//{}'>t</A>", "<a  href = http://{}?q>t</a>", '<!-- <a href="http://{}/"> -->',
                     '<script>"<a href=http://{}/>"</script>', '<a name="x">{}</a>', '<a href="/local?u=http://{}/">', '<a data-href="http://{}/" >', '<link href="http://{}/">',
                     '<a title="a" href="HTTP://{}:80/">']
                ).format(to)
            )
        rows.append((i, f"https://{rnd.choice(names)}/{rnd.choice(['en', 'es', 'fr', 'de'])}/{i}", "<p>".join(links)))
    return rows


def test_rules_and_graph(spark, rows):
    data = ODD + graph(1)
    got = rows(op13.judge(spark.createDataFrame(data + [data[30]], SCHEMA).repartition(3), rounds=8))
    assert got == plain(data + [data[30]], rounds=8)
    verdicts = Counter(r[4] for r in got if r[3] is None)
    assert verdicts["block"] > 3 and verdicts["allow"] > 3


def test_distrust_goes_to_those_who_link(spark, rows):
    data = [(1, "http://bad.net/es/", None), (2, "http://fan.org/", '<a href="http://bad.net/">'), (3, "http://calm.org/", '<a href="http://good.com/">'),
            (4, "http://good.com/", '<a href="http://liked.org/">'), (5, "http://liked.org/", '<a href="http://bad.net/">'), (6, "http://bad.net/de/", None)]
    got = {r[0]: r[4:] for r in rows(op13.judge(spark.createDataFrame(data, SCHEMA), threshold=15))}
    assert got[2][0] == "block" and got[2][2] > 0  # links to a blocked host
    assert got[3][0] == "allow" and 0 < got[3][2] < got[2][2]  # three links away from it
    assert got[5][0] == "allow" and got[5][1] > got[5][2] > 0  # trusted more than distrusted
    assert got[6][0] == "block"


def test_other_rules_rounds_and_empty_tables(spark, rows):
    rules = [("block", "h1.org", "/"), ("allow", "org", "/de"), ("allow", "", "/"), ("block", "net", ""), ("allow", "b.net", ""), ("block", "a.b.net", "")]
    data = graph(2, 150, 25) + [(900, "http://x.b.net", None), (901, "http://z.a.b.net", None)]
    table = spark.createDataFrame([*rules, ("allow", None, "/"), ("allow", "org", None)], "verdict string, host string, path string")
    assert rows(op13.judge(spark.createDataFrame(data, SCHEMA), table, rounds=3, threshold=10)) == plain(data, rules, 3, 10)
    assert rows(op13.judge(spark.createDataFrame([], SCHEMA))) == []
    assert rows(op13.judge(spark.createDataFrame(data[:40], SCHEMA), table.limit(0))) == plain(data[:40], [])


def test_clashing_columns_and_long_pages(spark, rows):
    names = ["host", "path", "n", "rule", "said", "ending", "start", "source", "target", "kind", "mass", "trust", "verdict", "blocked"]
    data = graph(3, 60, 12)
    wide = spark.createDataFrame([(*r, *["z"] * len(names)) for r in data], SCHEMA + ", " + ", ".join(f"{n} string" for n in names))
    assert rows(op13.judge(wide, rounds=2)) == plain(data, rounds=2)
    long = [(1, "http://a.org/", "<!--" * 100_000), (2, "http://b.org/", "<a " * 200_000), (3, "http://c.org/", "<a href=" * 50_000), (4, "http://d.org/" + "x." * 20_000, "<script " * 30_000)]
    assert [r[4] for r in rows(op13.judge(spark.createDataFrame(long, SCHEMA)))] == ["allow"] * 4


def test_sql_on_a_graph(spark, tmp_path):
    """The registered SQL where there are links between hosts; the given tables have none."""
    import duckdb

    from colsight.llm.queries import ORACLES

    data = graph(4, 300, 40) + ODD
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "pages"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages/*.parquet'")
    assert sorted(con.execute(ORACLES["op13_links"]).fetchall(), key=repr) == plain(data)
