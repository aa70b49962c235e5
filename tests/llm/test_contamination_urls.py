"""Containment against brute force; url rules and mined rules against plain code."""

import random
from collections import Counter
from itertools import combinations

from burstwatch.llm import contamination, urlrules
from burstwatch.llm.queries import URL_RULES


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(documents, items, width=5, percent=80):
    found = set()
    for item, said in items:
        q = shingles(said, width)
        if not q:
            continue
        own = min(width, len(next(iter(q))))
        for doc, text in documents:
            shared = len(q & shingles(text, own)) if len((text or "").split()) >= own else 0
            if 100 * shared >= percent * len(q) and shared:
                found.add((doc, item, len(q), shared))
    return found


def test_containment(docs, spark):
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(80)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 5, 8, 20, 45])))) for i in range(25)] + [(90, None), (91, " ")]
    documents = []
    for i in range(60):
        text = [word() for _ in range(rng.choice([0, 3, 60, 400]))]
        held = rng.choice(items[:25])[1].split()
        for _ in range(rng.choice([0, 0, 1, 2])):  # few edits leave the item in, more do not
            held[rng.randrange(len(held))] = "edited"
        at = rng.randrange(len(text) + 1)
        documents.append((i, " ".join(text[:at] + held + text[at:])))
    documents += [(100, None), (101, ""), (102, items[0][1].upper())]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = contamination.contained_items(docs(documents), table)
    assert {tuple(r) for r in found.collect()} == brute(documents, items)


def test_a_sketch_entry_is_in_every_document_above_the_threshold():
    for size in range(1, 500):
        assert contamination.sketch_size(size, 80) > size - -(-80 * size // 100) or contamination.sketch_size(size, 80) == size


def test_dropping(docs, spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (1, "alpha beta gamma delta epsilon zeta")], "item_id long, text string")
    held = "x alpha beta gamma delta epsilon zeta y"
    rows = docs([(1, held), (1, held), (2, "clean text of its own"), (None, held), (3, None)], extra="item")
    kept = contamination.drop_contaminated(rows, items)
    assert kept.columns == rows.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert contamination.drop_contaminated(docs([]), items).collect() == []
    assert len(contamination.drop_contaminated(rows, items.limit(0)).collect()) == 5


def test_parsing_and_given_rules(spark):
    urls = [
        None, "", "no scheme", "http://A.Net", "http://a.net/x", "https://sub.Example.net/en/1?q=1#f", "http://example.com/de/",
        "http://badexample.com/de/", "http://x.org/fr/2", "http://x.org/fr", "x://y://z/", "http://?q", "http://net/",
    ]
    table = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule) for r in urlrules.judge(table, URL_RULES).collect()}
    assert got == {
        0: ("", "", None), 1: ("", "", None), 2: ("", "", None), 3: ("a.net", "", None), 4: ("a.net", "/x", "net/"),
        5: ("sub.example.net", "/en/1", "example.net/en/"), 6: ("example.com", "/de/", "example.com/de/"),
        7: ("badexample.com", "/de/", None), 8: ("x.org", "/fr/2", "org/fr/"), 9: ("x.org", "/fr", None),
        10: ("y:", "//z/", None), 11: ("", "", None), 12: ("net", "/", "net/"),
    }


def test_mined_rules(spark):
    rng = random.Random(7)
    baskets = [
        (sorted(rng.sample(["a", "b", "c", "d", "e"], rng.randint(1, 4))), rng.choice(["allow", "block", "block"])) for _ in range(60)
    ]
    found = urlrules.mined_rules(spark.createDataFrame(baskets, "tokens array<string>, verdict string"), 0.05, 0.7)
    got = {(tuple(r["items"]), r.verdict): (round(r.confidence, 9), round(r.support, 9)) for r in found.collect()}
    whole, by = Counter(), Counter()
    for items, verdict in baskets:
        for n in (1, 2, 3, 4):
            for combo in combinations(items, n):
                whole[combo] += 1
                by[combo, verdict] += 1
    assert got == {
        k: (round(n / whole[k[0]], 9), round(n / 60, 9)) for k, n in by.items() if n / 60 >= 0.05 and n / whole[k[0]] >= 0.7
    }


def test_verdicts_and_odd_tables(spark):
    urls = [f"http://h{i}.net/de/{i}" for i in range(20)] + [f"http://h{i}.example.net/en/{i}" for i in range(20)]
    urls += ["http://q.com/de/7", "http://q.com/en/7", "http://q.com/de/7", "http://" + "a." * 300 + "com/" + "p/" * 300, None]
    table = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, tokens string")
    got = {r.page_id: r.verdict for r in urlrules.judge(table, URL_RULES).collect()}
    assert [got[40], got[41], got[42], got[44]] == ["block", "allow", "block", "allow"] and len(got) == len(urls)
    assert urlrules.judge(table.limit(0), URL_RULES).collect() == []
    assert {r.verdict for r in urlrules.judge(table.where("page_id = 40"), URL_RULES).collect()} == {"allow"}


def test_rules_on_late_parts(spark):
    """Verdicts that hang on the third path part, a later query name or a middle host label."""
    shop = [f"http://s{i}.a.b.c.shop.net/x/{i}/sale/{i}?id={i}&ref={i}&ad=1" for i in range(40)]
    wiki = [f"http://s{i}.a.d.c.shop.example.net/en/{i}/read/{i}?id={i}&ref={i}" for i in range(40)]
    asked = ["http://q.com/1/2/sale", "http://q.com/1/2/read", "http://q.com/?id=2&ad=3", "http://x.b.y.z.com/", "http://x.e.y.z.com/"]
    table = spark.createDataFrame(list(enumerate(shop + wiki + asked)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in urlrules.judge(table, URL_RULES).collect()}
    assert [got[80 + i] for i in range(5)] == ["block", "allow", "block", "block", "allow"]


def test_a_long_url_that_fills_the_table(spark):
    """Its hundreds of tokens are in the same rows and make one item; any of them finds the rule."""
    long = "http://x.net/" + "/".join(f"part{'abcdefghij'[i % 10] * (i + 1)}" for i in range(200))
    urls = [long] * 30 + [f"http://y.example.net/en/{i}" for i in range(30)] + ["http://q.com/r/s/t/" + long.split("/")[6]]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in urlrules.judge(table, URL_RULES, default="allow").collect()}
    assert len(got) == 61 and got[60] == "block" and got[0] == "block" and got[30] == "allow"


def test_an_item_over_two_rows_of_one_id(docs, spark):
    """Either row may be the one without a sketch entry; a null id is one id as well."""
    said = {i: [f"w{i}x{k}" for k in range(20)] for i in range(30)}
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in said.items()], "item_id long, text string")
    of = lambda i: i if i else None
    rows = [(of(i), " ".join(["x", *w[:16], "y"])) for i, w in said.items()] + [(of(i), " ".join(w[12:])) for i, w in said.items()]
    found = contamination.contained_items(docs(rows), items).collect()
    assert sorted(tuple(r) for r in found if r.doc_id) == [(i, i, 16, 16) for i in range(1, 30)]
    assert [tuple(r) for r in found if r.doc_id is None] == [(None, 0, 16, 16)]
