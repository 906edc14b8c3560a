"""The URL filter, against a plain version over one list of rows."""

import math
import re
from collections import Counter
from functools import cache

from starmill.llm.host_words import NAME, RULES, judge, op12_host_words, segment

PAGE = "page_id long, url string, html string"
RUN = re.compile(r"[^\x00-\x60\x7B-\x7F]+|[0-9]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    tail = rest[end:]
    stop = min([tail.index(c) for c in "?#" if c in tail], default=len(tail))
    return lower(rest[:end]), tail[:stop]


def rule_for(host, path):
    fit = [
        (len(r), r, v) for v, r in RULES
        if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])
    ]
    return max(fit)[1:] if fit else (None, None)


def splitter(pages):
    counts = Counter()
    for _, _, html in pages:
        text = lower(re.sub("<[^<>]*>", " ", html or ""))
        counts.update(w for w in re.findall(r"[^\x00-\x60\x7B-\x7F]+", text) if len(w) <= 24)
    total = max(sum(counts.values()), 1)

    def cost(word):
        return math.log(counts[word]) if word in counts else math.log(10) * (1 - len(word))

    @cache
    def words(name):
        if len(name) > NAME:
            return (name,)
        best = {0: (0.0, ())}
        for end in range(1, len(name) + 1):
            best[end] = max(
                ((best[end - k][0] + cost(name[end - k:end]) - math.log(total), k) for k in range(1, min(24, end) + 1))
            )
        out, end = [], len(name)
        while end:
            out.insert(0, name[end - best[end][1]:end])
            end -= best[end][1]
        return tuple(out)

    return words


def brute(pages):
    words = splitter(pages)

    def tokens(host, path):
        out = []
        for run in RUN.findall(host.rpartition(".")[0] if "." in host else host):
            out += [f"host #{len(run)}"] if run[0].isdigit() and run.isascii() else [f"host {w}" for w in words(run)]
        return out + [f"path #{len(r)}" if r[0] in "0123456789" else f"path {r}" for r in RUN.findall(lower(path))]

    urls = {parts(u) for _, u, _ in pages}
    counts, n = {"block": Counter(), "allow": Counter()}, Counter()
    for u in urls:
        if verdict := rule_for(*u)[1]:
            counts[verdict].update(tokens(*u))
            n[verdict] += 1
    known = set(counts["block"]) | set(counts["allow"])
    whole = {v: sum(c.values()) + len(known) for v, c in counts.items()}
    out = set()
    for page, url, _ in pages:
        host, path = parts(url)
        rule, verdict = rule_for(host, path)
        if not verdict:
            score = math.log((n["block"] + 1) / (n["allow"] + 1)) + sum(
                math.log((counts["block"][t] + 1) / whole["block"]) - math.log((counts["allow"][t] + 1) / whole["allow"])
                for t in tokens(host, path) if t in known
            )
            assert abs(score) > 1e-4, "too near for two ways of adding"
            verdict = "block" if score > 0 else "allow"
        out.add((page, host, path, rule, verdict))
    return out


def found(df):
    return [tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict").collect()]


def test_whole_table(spark, sf_dir):
    pages = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    got = found(op12_host_words(spark, sf_dir))
    assert len(got) == len(pages) and set(got) == brute(pages)
    assert {v for *_, rule, v in got if rule is None} == {"block", "allow"}


TEXT = "<p>buy cheap pills here</p> cheap pills and casino bonus; bonus casino for garden books, books on the garden " * 9


def odd_pages():
    urls = [
        None, "", "no scheme", "http://", "http:///x", "HTTP://WWW.Example.NET/en/a?q=://b/c", "http://a.net", "http://a.net?x",
        "http://a.net/", "http://notexample.com/de/1", "http://x.example.com/de/", "http://x.example.com/DE/", "ftp://org/fr/",
        "http://org/fr", "http://a.org/fr/b#c/d", "x://y://z/net/", "http://1.2.3.4:80/12/345", "http://münchen.example.com/über/Äx",
        "http://" + "abc" * 3000 + ".com/en/", "http://a.com/" + "long/" * 20_000, "http://a.com/\nline?x", "://b.org/fr/ü", "http://net/",
    ]
    pages = [(i, u, [None, "", "<b", TEXT][i % 4]) for i, u in enumerate(urls)]
    return pages + [(3, "http://a.net/", None)] * 3 + [(None, "http://www.example.org/en/", "<" * 200_000)]


def test_odd_urls(spark, tables):
    pages = odd_pages()
    got = found(op12_host_words(spark, tables(pages=(pages, PAGE))))
    assert len(got) == len(pages) and set(got) == brute(pages)


def test_words_inside_names_decide(spark):
    bad = ["cheappills", "pillscasino", "casinobonus", "bonuscheap"]
    good = ["gardenbooks", "booksgarden", "thegarden", "onbooks"]
    pages = [(i, f"http://{n}{j}.example.net/{'xx' if n in bad else 'en'}/", TEXT) for j in range(3) for i, n in enumerate(bad + good)]
    new = [(100, "http://cheapcasino.com/"), (101, "http://pillsbonus.com/"), (102, "http://booksonthegarden.com/"), (103, "http://thebooks.com/")]
    got = {r[0]: r[4] for r in found(judge(spark.createDataFrame(pages + [(*n, None) for n in new], PAGE), RULES))}
    assert [got[i] for i in range(100, 104)] == ["block", "block", "allow", "allow"]


def test_segments():
    found = {(0, 3): 50, (3, 4): 20, (0, 4): 1}
    assert segment("thebook", found, 1000) == ["the", "book"]
    assert segment("", {}, 0) == [] and segment("qq", {}, 10) == ["qq"]


def test_empty_tables_no_rules_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "http://a.com/b", None, 1, 2, 3, 4)], PAGE + ", host int, rule int, token int, n int")
    assert found(judge(df, RULES)) == found(judge(df, [])) == [(1, "a.com", "/b", None, "allow")]
    assert found(judge(df.limit(0), RULES)) == []
