"""Wrapper induction: tree matching against brute force, bounded memory, and hosts whose markup misleads."""

import random
import resource
import subprocess
import sys
from functools import lru_cache

import pytest
from llm_helpers import prose

from lifeboat.llm import html_extract as H


def random_tree(rng, depth):
    n = H.Node("e", rng.choice("abc"))
    if depth:
        n.kids = [random_tree(rng, depth - 1) for _ in range(rng.randint(0, 4))]
    return n


def force(a, b):
    """Simple tree matching, straight from its definition."""
    if a.key != b.key:
        return 0
    m = [[0] * (len(b.kids) + 1) for _ in range(len(a.kids) + 1)]
    for i, x in enumerate(a.kids):
        for j, y in enumerate(b.kids):
            m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + force(x, y))
    return m[-1][-1] + 1


@pytest.mark.parametrize("cells", [250_000, 1])
def test_alignment_is_simple_tree_matching(cells, monkeypatch):
    monkeypatch.setattr(H, "_WHOLE_CELLS", cells)       # 1: every table is halved
    rng = random.Random(7)
    for _ in range(400):
        a, b = random_tree(rng, 3), random_tree(rng, 3)
        a.key = b.key = "root"
        pairs = H.align(a, b)
        assert len(pairs) == force(a, b)
        order = {id(n): i for i, n in enumerate(H._flat(b))}
        up = {id(k): n for t in (a, b) for n in H._flat(t) for k in n.kids}
        at = [(i, pairs[id(n)]) for i, n in enumerate(H._flat(a)) if id(n) in pairs]
        assert [order[id(r)] for _, r in at] == sorted({order[id(r)] for _, r in at})      # order is kept, one to one
        for n in H._flat(a):
            if id(n) in pairs and n is not a:
                assert n.key == pairs[id(n)].key and up[id(pairs[id(n)])] is pairs[id(up[id(n)])]


MANY = """
import resource, sys, time
from lifeboat.llm import html_extract as H
sys.setrecursionlimit(1000000)
def page(tag, n):
    root = H.Node("", "")
    root.kids = [H.Node("e", tag + str(i % 3)) for i in range(n)]
    return root
p, r = page("x", N), page("y", N)
for k in range(0, len(p.kids), 5):
    p.kids[k].key = "same"
for k in range(0, len(r.kids), 7):
    r.kids[k].key = "same"
t = time.time()
pairs = H.align(p, r)
print(len(pairs), time.time() - t, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024)
"""


def test_very_many_differing_children():
    """Memory stays linear: 20,000 children that differ on either side."""
    out = subprocess.run([sys.executable, "-c", MANY.replace("N)", "20_000)")], capture_output=True, text=True, timeout=400)
    assert out.returncode == 0, out.stderr[-1000:]
    pairs, _, mb = out.stdout.split()
    assert int(pairs) == 1 + 20_000 // 7 + 1 and float(mb) < 1000


def test_deep_trees():
    sys.setrecursionlimit(1_000_000)
    deep = H.parse("<div>" * 20_000 + "x")
    other = H.parse("<div>" * 15_000 + "<p>y")
    assert len(H.align(deep, other)) == 15_001


def hosts(spark, makes, n=14):
    rows = [(k * 100 + i, f"http://h{k}.org/{i}", make(i)) for k, make in enumerate(makes) for i in range(n)]
    return {r["id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_text_outside_the_article(spark):
    story = lambda i: f"<article><p>Story {i} {prose(i, 5)}</p></article>"
    lists = [lambda i: story(i) + "<div>" + "".join(f"<p>Other story {i * 9 + j} {prose(i * 9 + j, 20)}</p>" for j in range(5)) + "</div>",
             lambda i: story(i) + "".join(f"<div><h3>Other {i * 9 + j}</h3><p>{prose(i * 9 + j, 30)}</p></div>" for j in range(4)),
             lambda i: story(i) + "<ul>" + "".join(f"<li><a href='/{j}'>{prose(i * 9 + j, 9)}</a></li>" for j in range(6)) + "</ul>",
             lambda i: story(i) + "<section id='comments'>" + "".join(f"<p>{prose(i * 9 + j, 40)}</p>" for j in range(3)) + "</section>",
             lambda i: story(i) + f"<div>Read {i * 31} times, last on day {i}</div>"]
    got = hosts(spark, lists)
    assert all(got[k * 100 + i] == f"Story {i} {prose(i, 5)}" for k in range(len(lists)) for i in range(14))


def test_articles_that_are_not_the_page_s(spark):
    """An article of links only is a teaser; one that is the same on all pages is template."""
    link = lambda i: f"<article><a href='/{i + 1}'>Next: {prose(i, 4)}</a></article><div><p>{prose(i, 30)}</p><p>{prose(i + 50, 30)}</p></div><p>Imprint</p>"
    same = lambda i: f"<article><p>Welcome to our site</p></article><div><p>{prose(i, 30)}</p><p>{prose(i + 50, 30)}</p></div><p>Imprint</p>"
    got = hosts(spark, [link, same])
    assert all(got[k * 100 + i] == f"{prose(i, 30)}\n{prose(i + 50, 30)}" for k in range(2) for i in range(14))


def test_ties_of_templates(spark):
    """Blocks that could be aligned in two ways: the one further left is, on every page alike."""
    got = hosts(spark, [lambda i: f"<div><p>note</p><p>{prose(i, 8)}</p><p>note</p></div>", lambda i: "<div>" + f"<p>{prose(i, 8)}</p>" * (1 + i % 3) + "</div>"])
    assert all(got[i] == prose(i, 8) for i in range(14))
    assert all(got[100 + i] == "\n".join([prose(i, 8)] * (1 + i % 3)) for i in range(14))
