import random
import re

from plotwright.llm.url_rules import Automaton, host_glob, judge_urls, split_url, text_glob

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def run(frame, urls, rules=RULES, **more):
    df = judge_urls(frame(list(enumerate(urls)), "page_id long, url string"), rules, **more)
    return [tuple(r)[2:] for r in sorted(df.collect(), key=lambda r: r["page_id"])]


def test_hosts_paths_and_longest_rule(frame):
    urls = [
        "https://www.Example.NET/en/1?x=/de/#t",
        "http://example.net/EN/1",
        "http://myexample.com/de/1",
        "http://a.b.example.com/de/",
        "http://x.org/fr/2",
        "http://x.org/fr",
        "http://net",
        "http://net/",
        "http://e.com/.net/a",
        "http://e.net?/a",
    ]
    assert run(frame, urls) == [
        ("www.example.net", "/en/1", "example.net/en/", "allow"),
        ("example.net", "/EN/1", "net/", "block"),
        ("myexample.com", "/de/1", None, "allow"),
        ("a.b.example.com", "/de/", "example.com/de/", "block"),
        ("x.org", "/fr/2", "org/fr/", "allow"),
        ("x.org", "/fr", None, "allow"),
        ("net", "", None, "allow"),
        ("net", "/", "net/", "block"),
        ("e.com", "/.net/a", None, "allow"),
        ("e.net", "", None, "allow"),
    ]


def test_keywords_odd_urls_and_ties(frame):
    urls = [None, "", "nothing", "http://", "http://big-casino.org/a", "http://a.org/casino", "http://a.org/fr/casino", "a://b://c/d", "http://ÉÀ.org/fr/é"]
    assert run(frame, urls) == [
        ("", "", None, "block"),
        ("", "", None, "block"),
        ("", "", None, "block"),
        ("", "", None, "block"),
        ("big-casino.org", "/a", None, "block"),
        ("a.org", "/casino", None, "block"),
        ("a.org", "/fr/casino", "org/fr/", "allow"),
        ("b:", "//c/d", None, "allow"),
        ("ÉÀ.org", "/fr/é", "org/fr/", "allow"),
    ]
    assert run(frame, ["http://a.b/c"], [("b/", "allow"), ("b/", "block"), ("a/x", "block")])[0][2:] == ("b/", "allow")


def regex_of(glob):
    return re.compile("".join(".*" if s == "*" else "." if s == "?" else re.escape(chr(s)) for s in glob[:-1]) + r"\Z", re.S)


def test_automaton_as_regular_expressions():
    rnd = random.Random(9)
    for _ in range(40):
        globs = [text_glob("".join(rnd.choice("ab*?") for _ in range(rnd.randrange(0, 40)))) for _ in range(rnd.randrange(1, 12))]
        texts = ["".join(rnd.choice("ab") for _ in range(rnd.randrange(0, 40))) for _ in range(60)]
        got = Automaton.of(globs).fits([[*t.encode(), 257] for t in texts]).tolist()
        patterns = [regex_of(g) for g in globs]
        assert got == [next((k for k, p in enumerate(patterns) if p.match(t)), -1) for t in texts]


def test_many_rules_fill_many_words(frame):
    rules = [(f"h{i}.example/{'p' * (i % 50)}/", "block" if i % 2 else "allow") for i in range(300)]
    automaton = Automaton.of([host_glob(r) for r, _ in rules])
    assert len(automaton.first) > 100
    got = run(frame, [f"http://sub.h{i}.example/{'p' * (i % 50)}/x" for i in range(300)], rules)
    assert [g[2:] for g in got] == rules


def test_long_url_empty_table_and_clashing_columns(frame):
    long = "http://a.net/" + "x" * 100_000 + "casino"
    assert run(frame, [long, long, "http://a.com/"])[0][2:] == ("net/", "block")
    assert judge_urls(frame([], "page_id long, url string"), RULES).count() == 0
    df = judge_urls(frame([("http://a.net/", "mine", 1)], "url string, Host string, n int"), RULES)
    assert df.columns == ["url", "n", "host", "path", "rule", "verdict"]
    assert run(frame, ["http://a.net/"], [])[0][2:] == (None, "allow")


def test_split_url():
    assert split_url("HTTP://A.b#c/d") == ("a.b", "")
    assert split_url("x://Y/z?://q") == ("y", "/z")
