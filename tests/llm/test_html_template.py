"""Template deduction against a plain version of it, and article text that names and broken markup must not lose."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from starloom.llm import html_extract
from starloom.llm.common import table


def plain_templates(pages: dict[str, list[str]]) -> dict[str, set]:
    """Template tokens per host by vectors written out in full."""
    found = {}
    for host, htmls in pages.items():
        distinct = [[(t.place, t.text) for t in html_extract.page_tokens(h)] for h in dict.fromkeys(htmls)]
        counts = [Counter(p) for p in distinct]
        by_vector = defaultdict(set)
        for token in set().union(*counts):
            vector = tuple(c[token] for c in counts)
            on = sum(v > 0 for v in vector)
            if on >= 5 and on >= 0.3 * len(counts):
                by_vector[vector].add(token)
        ranks = defaultdict(set)
        for page in distinct:
            for v, ts in by_vector.items():
                for i, t in enumerate(x for x in page if x in ts):
                    ranks[t].add(i % len(ts))
        firm = {v: {t for t in ts if len(ranks[t]) == 1} for v, ts in by_vector.items() if len(ts) > 1}
        classes = {v: ts for v, ts in firm.items() if len(ts) > 1}
        of = {t: v for v, ts in classes.items() for t in ts}
        orders, slots, bad = defaultdict(set), defaultdict(set), set()
        for page in distinct:
            mine = {v: [t for t in page if of.get(t) == v] for v in classes}
            broken = set()
            for v, ts in mine.items():
                k = len(classes[v])
                if any(ts[i : i + k] != ts[:k] for i in range(0, len(ts), k)) or len(set(ts[:k])) != len(ts[:k]):
                    broken.add(v)
                elif ts:
                    orders[v].add(tuple(ts[:k]))
            bad |= broken
            around: list = []
            for t in page:
                v = of.get(t)
                if v is None or v in broken:
                    continue
                k = len(classes[v])
                if t == mine[v][0]:
                    slots[v].add(tuple(around[-1]) if around else None)
                    around.append((v, 1))
                    continue
                while v in [x for x, _ in around] and around[-1][0] != v:
                    bad.add(around.pop()[0])
                if not around or around[-1][0] != v:
                    bad.add(v)
                elif around[-1][1] + 1 == k:
                    around.pop()
                else:
                    around[-1] = (v, around[-1][1] + 1)
        good = [v for v in classes if v not in bad and len(orders[v]) == 1 and len(slots[v]) == 1]
        found[host] = {t for v in good for t in classes[v]}
    return found


def plain_text(page: str, template: set) -> str:
    tokens = html_extract.page_tokens(page)
    names = [(t.place, t.text) for t in tokens]
    blocks = [(i, t) for i, t in enumerate(tokens) if t.text and not t.out]
    if any(t.main for _, t in blocks):
        kept = [t.text for _, t in blocks if t.main and not any(names[i] in template for i in t.by)]
    else:
        kept = [t.text for i, t in blocks if names[i] not in template]
    return "\n\n".join(kept)


def made_pages() -> dict[str, list[str]]:
    pages = defaultdict(list)
    for i in range(30):
        rows = "".join(f"<tr><td>name<td>{i} {j}<td>price" for j in range(i % 4))
        swap = "<h2>one</h2><h3>two</h3>" if i % 2 else "<h3>two</h3><h2>one</h2>"
        pages["shop.org"].append(f"<div>top</div><table>{rows}</table><section>text {i}<p>more</section>{swap}<div class=x>end</div>")
        related = "<div class=related><p>post it</div>"
        pages["news.org"].append(f"<main><p>story {i}</p>{related}{'<p class=share>my share</p>' * (i == 3)}<aside>read on</aside></main><div>tail</div>")
        pages["few.org" if i < 4 else "copies.org"].append(f"<div>boiler</div><p>own {i if i < 4 else 0}")
    return pages


def texts(spark, pages):
    rows = [(i, f"http://{h}/{i}", p) for i, (h, p) in enumerate((h, p) for h, ps in pages.items() for p in ps)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    return rows, got


def test_templates_against_the_plain_version(spark):
    pages = made_pages()
    rows, got = texts(spark, pages)
    known = plain_templates(pages)
    for i, url, page in rows:
        assert got[i] == plain_text(page, known[url.split("/")[2]])
    assert got[1] == "name\n\n1 0\n\nprice\n\ntext 1\n\none\n\ntwo" or "text 1" in got[1] and "top" not in got[1] and "one" in got[1]
    news = {url: got[i] for i, url, _ in rows if "news.org" in url}
    assert all("post it" not in t and "read on" not in t and "story" in t for t in news.values())
    assert sum("my share" in t for t in news.values()) == 1  # a name that the template does not confirm
    assert all(got[i].startswith("boiler") for i, url, _ in rows if "few.org" in url or "copies.org" in url)


def test_given_pages_against_the_plain_version(spark):
    folder = "/root/testdata/sf0.01"
    pages = table(spark, folder, "pages")
    by_host = defaultdict(list)
    rows = pages.withColumn("host", html_extract.host_of("url")).collect()
    for r in rows:
        by_host[r["host"]].append(r["html"] or "")
    known = plain_templates(by_host)
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    assert len(got) == len(rows)
    for r in rows:
        assert got[r["page_id"]] == plain_text(r["html"] or "", known[r["host"]])


def test_classes_that_cross_or_change_order():
    sizes = {1: 2, 2: 2, 3: 2}
    order = html_extract.judge([(1, 10), (2, 20), (2, 21), (1, 11)], sizes)
    assert order[1][1] and order[2][1] and order[1][2] == 0 != order[2][2]
    crossed = html_extract.judge([(1, 10), (2, 20), (1, 11), (2, 21)], sizes)
    assert crossed[1][1] and not crossed[2][1]
    assert not html_extract.judge([(3, 30), (3, 31), (3, 31), (3, 30)], sizes)[3][1]
    assert html_extract.judge([(3, 30), (3, 31), (3, 30), (3, 31)], sizes)[3][1]


@pytest.mark.parametrize(
    "page, kept",
    [
        ("<article><p class=share>a<h2 id=social>b</h2><p id=alert>c<div class=side>d</div><section id=related>e</section></article>", "abcde"),
        ("<article><p>one<noscript><p>two<p>three</article>", ["one", "two", "three"]),
        ("<article><p>one<noscript>no</noscript> two</article>", ["one two"]),
        ("<article><p>Let <math><mi>x</mi></math> be</article>", ["Let x be"]),
        ("<article><p>a<svg><svg><text>in</text></svg><text>in</text></svg>b<object>o</article>", ["abo"]),
        ("<article><aside>a</aside><fieldset>b</fieldset><label>c</label></article>", "abc"),
        ("<article><p>text<div class=comments>reader</div><div class=ad>buy</div></article>", ["text"]),
        ("<body><aside>side</aside><div class=related>more</div><p>text", ["text"]),
    ],
)
def test_article_text_is_kept(page, kept):
    assert [t.text for t in html_extract.page_tokens(page) if t.text and not t.out] == list(kept)


def test_very_long_pages_and_null_ids(spark):
    long = "<article>" + "<p>word " * 60_000 + "</article>"
    frame = spark.createDataFrame([(None, None, long), (None, "http://a/", None), (1, "http://a/", "")], "page_id long, url string, html string")
    got = html_extract.extract(frame).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 0, 60_000 * 4 + 59_999 * 2]
