"""Block lists with deep and capitalised paths, against brute force over URLs and changes."""

import random
from urllib.parse import urlsplit

from fleetpulse.llm import url_lists


def brute_hits(url, at, changes):
    """The list entries that are active at a time and lead to the URL."""
    parts = urlsplit(url)
    labels = parts.hostname.split(".")
    steps = [s for s in parts.path.split("/") if s]
    hits = []
    for name, entry in {(n, e) for n, e, _, _ in changes}:
        host, _, path = entry.partition("/")
        if path:
            leads = host.lower() == parts.hostname and path.split("/") == steps[: path.count("/") + 1]
        else:
            leads = host.lower().split(".") == labels[-host.count(".") - 1 :]
        past = [(t, a) for n, e, t, a in changes if (n, e) == (name, entry) and t <= at]
        if leads and past and max(past)[1] == "add":
            hits.append((-len(entry), host.lower() + entry[len(host) :], name))
    return sorted(hits)


def test_paths_of_any_depth_and_case(spark):
    draw = random.Random(11)
    path = lambda n: "/".join(draw.choices(["a", "B", "Cc"], k=n))
    entries = {f"{h}/{path(n)}" for h in ("x.example", "Y.example") for n in (1, 2, 5, 6, 9) for _ in range(12)} | {"q.Y.example"}
    changes = [(draw.choice("kl"), e, draw.randrange(0, 50), "add") for e in sorted(entries)]
    changes += [(n, e, t + draw.randrange(1, 50), "remove") for n, e, t, _ in changes[::2]]
    urls = [f"http://{e}/{path(2)}?q#f" for e in sorted(entries)] + [f"https://x.example//{path(draw.randrange(0, 12))}" for _ in range(80)]
    urls.append("http://X.example/" + "/".join(["deep"] * 300))
    changes.append(("l", "x.example/" + "/".join(["deep"] * 299), 0, "add"))
    captures = [(k, u, draw.randrange(0, 100)) for k, u in enumerate(urls)]
    pages = spark.createDataFrame(captures, "page_id long, url string, fetched_at long")
    spans = url_lists.validity(spark.createDataFrame(changes, "list_name string, entry string, changed_at long, action string"))
    found = {r["page_id"]: r for r in url_lists.judge(pages, spans, slice_seconds=13).collect()}
    expected = {k: brute_hits(u, t, changes) for k, u, t in captures}
    assert {k: (r["entry"], r["list_name"], r["n_matches"]) for k, r in found.items()} == {
        k: (hits[0][1], hits[0][2], len(hits)) if hits else (None, None, 0) for k, hits in expected.items()
    }
    assert {r["page_id"] for r in url_lists.allowed(pages, spans).collect()} == {k for k, hits in expected.items() if not hits}
    assert any(hits and hits[0][1].count("/") > 4 for hits in expected.values()) and found[len(urls) - 1]["blocked"]


def test_an_entry_blocks_its_own_url(spark):
    pages = spark.createDataFrame([(1, "http://Z.example/One/Two", 5), (2, "http://z.example/one/two", 5)], "page_id long, url string, fetched_at long")
    spans = url_lists.validity(spark.createDataFrame([("l", "Z.Example/One/Two", 1, "add")], "list_name string, entry string, changed_at long, action string"))
    assert [r["page_id"] for r in url_lists.judge(pages, spans).filter("blocked").collect()] == [1]


def test_entries_and_captures_have_one_normal_form(spark):
    entries = ["bad.example/ads/", "Dot.example.", "port.example:8080", "HTTPS://user@full.example:1/A//b/?q#f", "slash.example/", ":80", "/path", ""]
    changes = [("l", e, 1, "add") for e in entries] + [("l", "dot.example", 9, "remove")]
    spans = url_lists.validity(spark.createDataFrame(changes, "list_name string, entry string, changed_at long, action string"))
    assert sorted((r["entry"], r["valid_to"]) for r in spans.collect()) == [
        ("bad.example/ads", url_lists.OPEN_END), ("dot.example", 9), ("full.example/A/b", url_lists.OPEN_END),
        ("port.example", url_lists.OPEN_END), ("slash.example", url_lists.OPEN_END),
    ]
    urls = ["http://bad.example/ads/x", "http://bad.example//ads", "http://www.dot.example./", "ftp://port.example", "http://full.example/A/b/c",
            "http://slash.example/any", "http://bad.example/adsx", "http://full.example/a/b"]
    pages = spark.createDataFrame([(k, u, 5) for k, u in enumerate(urls)], "page_id long, url string, fetched_at long")
    assert sorted(r["page_id"] for r in url_lists.judge(pages, spans).filter("blocked").collect()) == [0, 1, 2, 3, 4, 5]
