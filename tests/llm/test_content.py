import html
import itertools
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanscope.llm import content, dom, labelled_pages
from loanscope.sources.tables import read_table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return content.fit(read_table(spark, SF, "pages"))


def blocks_of(source):
    return [t for _, t in dom.read_page(source).blocks]


def random_page(rng, n):
    page = dom.Page()
    for i in range(n):
        page.parent.append(rng.randrange(i) if i else -1)
        page.depth.append(page.depth[page.parent[i]] + 1 if i else 0)
        page.kind.append(rng.randrange(len(dom.KINDS)))
        page.active.extend(rng.sample(range(len(dom.FEATURES)), rng.randint(0, 4)))
        page.first.append(len(page.active))
    return page


def likelihoods(page, model):
    """Weight of every labelling of a page."""
    out = {}
    for y in itertools.product((0, 1), repeat=len(page.parent)):
        total = model.root * y[0]
        for i, label in enumerate(y):
            total += label * sum(model.weights[a] for a in page.active[page.first[i]:page.first[i + 1]])
            if i:
                total += model.pairs[page.kind[i], y[page.parent[i]], label]
        out[y] = math.exp(total)
    return out


def random_model(seed):
    rng = np.random.RandomState(seed)
    return content.ContentModel(rng.normal(size=len(dom.FEATURES)), rng.normal(size=(len(dom.KINDS), 2, 2)) * 2, float(rng.normal()))


def test_marginals_are_exact():
    rng, model = random.Random(2), random_model(2)
    pages = [random_page(rng, rng.randint(1, 9)) for _ in range(12)]
    p, joint = model.marginals(content.Forest.of(pages))
    start = 0
    for page in pages:
        weight = likelihoods(page, model)
        total = sum(weight.values())
        for i in range(len(page.parent)):
            assert p[start + i] == pytest.approx(sum(w for y, w in weight.items() if y[i]) / total, abs=1e-9)
            for a, b in itertools.product((0, 1), repeat=2) if i else ():
                assert joint[start + i, a, b] == pytest.approx(sum(w for y, w in weight.items() if (y[page.parent[i]], y[i]) == (a, b)) / total, abs=1e-9)
        start += len(page.parent)


def test_learning_raises_the_likelihood_to_the_optimum():
    rng = random.Random(4)
    pages = [random_page(rng, rng.randint(2, 7)) for _ in range(30)]
    labels = [np.array([rng.random() < .3 for _ in p.parent], np.int64) for p in pages]
    ridge = 1e-2

    def objective(model):
        nodes = sum(len(p.parent) for p in pages)
        fit = sum(math.log(likelihoods(p, model)[tuple(y)] / sum(likelihoods(p, model).values())) for p, y in zip(pages, labels)) / nodes
        return fit - ridge / 2 * (np.sum(model.weights ** 2) + np.sum(model.pairs ** 2) + model.root ** 2)

    model = content.learn(list(zip(pages, labels)), steps=600, ridge=ridge)
    best = objective(model)
    assert best > objective(content.learn(list(zip(pages, labels)), steps=5, ridge=ridge))
    for k in range(12):  # no small step from the optimum is better
        step = random_model(k)
        for scale in (0.02, -0.02):
            assert objective(content.ContentModel(model.weights + scale * step.weights, model.pairs + scale * step.pairs, model.root + scale * step.root)) < best + 1e-6


def test_held_out_labelled_pages(model):
    right = blocks = 0
    for source in labelled_pages.labelled_pages(300, seed=77):
        page, label = content.marked_page(source)
        p = content.block_probabilities([page], model)[0]
        right += sum((x > .5) == bool(label[i]) for (i, _), x in zip(page.blocks, p))
        blocks += len(p)
    assert right / blocks > 0.985


def article_text(source):
    """Paragraphs and headings of the given tables' only article, by cutting at tags."""
    inner = source[source.index("<article>") + 9:source.index("</article>")]
    parts = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>|<br>", inner)]
    return "\n".join(x for x in parts if x)


def test_every_page_of_the_table(spark, model):
    pages = read_table(spark, SF, "pages")
    found = {r["page_id"]: r for r in content.extract(pages, model).collect()}
    for r in pages.collect():
        assert found[r["page_id"]]["text"] == article_text(r["html"])
        assert found[r["page_id"]]["n_chars"] == len(found[r["page_id"]]["text"]) and found[r["page_id"]]["url"] == r["url"]
    again = {}
    for r in content.blocks(pages, model).orderBy("page_id", "block").collect():
        if r["probability"] > content.THRESHOLD:
            again.setdefault(r["page_id"], []).append(r["text"])
    assert {k: "\n".join(v) for k, v in again.items()} == {k: r["text"] for k, r in found.items() if r["text"]}


PAGE = """<!doctype html><html><body><div class="cookie-consent">We use cookies. <button>OK</button></div>
<header><h1>Daily News</h1><nav><a href=/>Home</a><a href=/w>World</a></nav></header>
<main><article><header><h1>Town rebuilds &quot;old&quot; bridge</h1></header><p>The town council voted on Monday to rebuild the old
 bridge   after years of debate, and the mayor&nbsp;agreed with all of them.</p><div class="ad">Buy now! Cheap shoes for everybody.</div>
<p>Work starts in <a href="/june">June</a>, and the bridge will be <em>closed</em> until autumn, officials said on Tuesday.</p>
<form class="newsletter"><p>Subscribe to our newsletter!</p><input></form><p>It is the third bridge to be rebuilt this year in the region.</article>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I think this is great news for all of us who live by the river, well done.</p></div></section></main>
<aside class="sidebar"><h3>Popular</h3><p>Ten things you should know about bridges, a long read about them all.</p></aside>
<script>document.write("<p>no</p>")</script><footer><p>&copy; 2024 Daily News. All rights reserved.</p></footer></body></html>"""


def test_a_page_with_everything_around_the_article(spark, model):
    rows = content.extract(spark.createDataFrame([(1, "u", PAGE)], "page_id long, url string, html string"), model).collect()
    assert rows[0]["text"].split("\n") == [
        'Town rebuilds "old" bridge',
        "The town council voted on Monday to rebuild the old bridge after years of debate, and the mayor agreed with all of them.",
        "Work starts in June, and the bridge will be closed until autumn, officials said on Tuesday.",
        "It is the third bridge to be rebuilt this year in the region."]


@pytest.mark.parametrize("source,blocks", [
    ("", []), (" \n ", []), ("<!-- a <p>b", []), ("a < b", ["a < b"]), ("x<3 y>2 &lt;c&gt;", ["x<3 y>2 <c>"]), ("<p>a<p>b</p>c", ["a", "b", "c"]),
    ("<ul><li>a<li>b<ul><li>c</ul>d</ul>", ["a", "b", "c", "d"]), ("<table><tr><td>a<td>b<tr><th>c</table>", ["a", "b", "c"]),
    ("<p>a<br>b <b>c</b>d</p>", ["a b cd"]), ("<script>if (a<b) '</p>'</script>t<style>p</style>", ["t"]), ("a<script>never closed <p>b", ["a"]),
    ("<title>no</title>yes<textarea><p>no</textarea>", ["yes"]), ("a<button>no</button>b", ["a b"]), ("a<button>open b", ["a open b"]),
    ("<P CLASS=x>A</P><DIV>B</DIV>", ["A", "B"]), ("<div>a</section>b</div></div>c", ["a", "b", "c"]), ("<a href='x>y'>z</a>", ["z"]),
    ('<p title="never closed>a</p>b', ["a", "b"]), ("<p>a</p", ["a"]), ("<![CDATA[x]]>y<?php z ?>w", ["yw"]), ("&amp &am; &#233;&#x4e2d;&nbsp;", ["& &am; é中"]),
    ("<dl><dt>a<dd>b<dt>c</dl>", ["a", "b", "c"]), ("<h1>a<h2>b</h2>", ["a", "b"]), ("<td>a</div>b</td>", ["a", "b"]), ("<hr>a<hr>b", ["a", "b"]),
])
def test_reading_markup(source, blocks):
    assert blocks_of(source) == blocks


texts = st.text(alphabet="ab <&\"'é", min_size=1, max_size=6)
trees = st.recursive(texts, lambda inner: st.tuples(st.sampled_from(["div", "section", "blockquote", "article"]), st.lists(inner, max_size=4)), max_leaves=12)


@given(st.lists(trees, max_size=4))
def test_well_formed_pages_give_their_texts(forest):
    def write(tree):
        return html.escape(tree) if isinstance(tree, str) else f"<{tree[0]} class=\"{tree[0]}\">{''.join(map(write, tree[1]))}</{tree[0]}>"

    def cut(tree):  # texts with a mark at each block boundary
        return tree if isinstance(tree, str) else "\x00" + "".join(map(cut, tree[1])) + "\x00"

    want = [" ".join(x.split()) for x in "".join(map(cut, forest)).split("\x00")]
    assert blocks_of("<body>" + "".join(map(write, forest)) + "</body>") == [x for x in want if x]


def test_nulls_repeats_clashes_and_empty_tables(spark, model):
    schema = "page_id long, url string, html string"
    rows = [(1, None, None), (2, "u", ""), (None, "v", "<p>One paragraph of text, and a second sentence here.</p>"), (3, "w", "<nav><a href=x>only a menu</a></nav>"), (3, "w", PAGE), (3, "w", PAGE)]
    df = spark.createDataFrame(rows, schema).repartition(3)
    got = sorted((str(r["page_id"]), r["url"] or "", r["n_chars"], r["n_blocks"] > 0, r["text"] == "") for r in content.extract(df, model).collect())
    assert [g[0] for g in got] == ["1", "2", "3", "3", "3", "None"] and [g[4] for g in got] == [True, True, True, False, False, False]
    assert got[3] == got[4] and got[0][3] is False
    more = df.select("*", *[F.lit("clash").alias(c) for c in ("text", "n_chars", "n_blocks", "block", "probability", "certainty", "a.b")])
    assert sorted(map(str, content.extract(more, model).collect())) == sorted(map(str, content.extract(df, model).collect()))
    assert content.extract(df.limit(0), model).collect() == [] == content.blocks(df.limit(0), model).collect()
    assert content.fit(df.limit(0), seed_pages=0).root == 0.0


def test_long_and_deep_pages(spark, model):
    n = 30_000
    long = "<body><nav><a href=a>menu</a></nav><article><h1>Title of it</h1>" + "".join(f"<p>Paragraph {i} of the page, it has some more words.</p>" for i in range(n)) + "</article></body>"
    deep = "<div>" * 5000 + "<p>Deep text, that is far down in the page.</p>"
    df = spark.createDataFrame([(1, "a", long), (2, "b", deep)], "page_id long, url string, html string")
    rows = {r["page_id"]: r for r in content.extract(df, model).collect()}
    assert rows[1]["n_main"] == n + 1 and rows[1]["text"].endswith(f"Paragraph {n - 1} of the page, it has some more words.")
    assert rows[2]["n_blocks"] == 1


def test_training_pages_are_bounded_and_stable(spark):
    pages = read_table(spark, SF, "pages")
    many = pages.unionAll(pages.withColumn("page_id", F.lit(1)))
    some = content.training_pages(many, 20)
    assert 5 < len(some) <= 20 and some == content.training_pages(many.repartition(7), 20)
    one = pages.limit(1)
    for _ in range(7):
        one = one.unionAll(one)
    assert len(content.training_pages(one.unionAll(pages), 300)) == 250
