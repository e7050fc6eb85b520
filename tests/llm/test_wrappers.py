"""Articles of hosts with several layouts, titles in names, nested parts and copies."""

import re

from canvass.llm.wrappers import Wrapper, _bare, _merged, expression, extract_pages, page_tree


def texts(spark, rows):
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in extract_pages(table).collect()}


def test_layouts_of_one_host(spark):
    side = '<nav>Home</nav><div class="sidebar">Other</div>'
    layouts = [
        '<body class="single">{side}<article><h1>T{k}</h1><p>one {k}</p></article></body>',
        '<body class="page-id-{k} page-story">{side}<div class="post"><h1>T{k}</h1><p>one {k}</p></div></body>',
        '<body>{side}<article id="post-how-to-share-more-comments-{k}" class="post category-ads"><h1>T{k}</h1><p>one {k}</p></article></body>',
        '<body>{side}<div id="post-a-notice-on-ads-number-{k}"><h1>T{k}</h1><p>one {k}</p></div></body>',
        '<body>{side}<div class="content"> </div><div><h1>T{k}</h1><p>one {k}</p></div></body>',
        "<body>{side}<section><h1>T{k}</h1><p>one {k}</p></section></body>",
    ]
    rows = []
    for url in ("https://a.example/x", None):
        for n, layout in enumerate(layouts):
            for _ in range(1 + 5 * (n == 0)):
                k = len(rows)
                rows.append((k, url, layout.replace("{side}", side).replace("{k}", str(k))))
    assert texts(spark, rows) == {k: f"T{k}\n\none {k}" for k, _, _ in rows}


def test_nothing_but_other_parts_goes(spark):
    """Title and intro beside the content of an article, its fixed paragraphs, and pages without a named part."""
    nested = '<nav>Home</nav><article><div class="entry-header"><h1>T{k}</h1></div><p>intro {k}</p><div class="content"><p>{long}</p></div><p class="end">always</p><aside>no</aside></article>'
    bare = "<div><h1>T{k}</h1><p>short {k}</p></div><div><section><p>{long}</p></section></div>"
    long = " ".join(["word"] * 90)
    rows = [(k, f"https://{'ab'[k % 2]}.example/", (nested, bare)[k % 2].replace("{k}", str(k)).replace("{long}", long)) for k in range(16)]
    want = {k: f"T{k}\n\nintro {k}\n\n{long}\n\nalways" if k % 2 == 0 else f"T{k}\n\nshort {k}" for k in range(16)}
    found = texts(spark, rows)
    assert {k: t for k, t in found.items() if k % 2 == 0} == {k: t for k, t in want.items() if k % 2 == 0}
    assert all(found[k].startswith(want[k]) for k in range(1, 16, 2))


def test_copies_count_once(spark):
    rows = [(k, "https://a.example/", "<div><h1>Title</h1><p>all there is</p></div>") for k in range(9)]
    rows += [(k, "https://b.example/", f"<div><h1>Site</h1><p>text {k}</p></div>") for k in range(20, 26)]
    rows += [(k, "https://c.example/", "<p>the same</p>" + "<!-- -->" * k) for k in range(30, 36)]
    found = texts(spark, rows)
    assert {found[k] for k in range(9)} == {"Title\n\nall there is"}
    assert [found[k] for k in range(20, 26)] == [f"text {k}" for k in range(20, 26)]
    assert {found[k] for k in range(30, 36)} == {"the same"}


def inferred(*pages):
    trees = [page_tree(p) for p in pages]
    wrapper = _bare(trees[0])
    for tree in trees[1:]:
        wrapper = _merged(wrapper, _bare(tree))
    return wrapper


def test_mismatches_become_slots_and_groups():
    page = "<div><h2>Books of</h2><b>{}</b><p>intro</p>{}<ul>{}</ul></div>"
    one = page.format("Ann", "", "<li>x<li>y")
    two = page.format("Bo", "<table><tr><td>1<td>2</table>", "<li>z")
    three = page.format("Cy", "", "")
    assert expression(inferred(one, two, three)) == "<div> <h2> = </> # <p> = </> (<table> <tr> (<td> # </>)+ </> </>)? <ul> (<li> # </>)+? </> </>"
    # The same whatever the order; alternating parts are one repeated group.
    assert expression(inferred(two, three, one)) == expression(inferred(one, two, three))
    assert expression(inferred("<h3>a</h3><p>1</p><h3>b</h3><p>2</p><h3>c</h3><p>3</p>")) == "(<h3> # </> <p> # </>)+"
    assert expression(inferred("<p>same</p>", "<p>same</p><p>more</p>")) == "(<p> # </>)+"


def test_an_article_is_never_lost_for_a_word_around_it(spark):
    around = [
        '<div class="content-sidebar-wrap"><article>{}</article></div>',
        '<div id="page" class="has-sidebar"><main><article>{}</article></main></div>',
        '<div class="page-header-fixed"><article>{}</article></div>',
        '<div class="wrapper no-comments"><div class="post">{}</div></div>',
    ]
    body = '<h1>T</h1><section class="discussion">of it</section><p class="alert">be warned</p><p class="notice">noted</p><ul class="user-feedback"><li>great</ul><div class="ad">buy</div>'
    rest = '<nav>Home</nav><div class="ad">buy</div><section class="comments"><article>first!</article></section><footer>us</footer>'
    rows = [(k, f"https://{'a' if k < 4 else f'h{k}'}.example/", f"<body>{around[k % 4].format(body)}{rest}</body>") for k in range(8)]
    assert set(texts(spark, rows).values()) == {"T\n\nof it\n\nbe warned\n\nnoted"}


def test_every_text_is_read_whatever_the_order(spark):
    """Pages whose parts come in any order: the alignment loses none."""
    import random

    chance = random.Random(4)
    tags = ["<h2>{}</h2>", "<p>{}</p>", "<div><p>{}</p></div>", "<section><h3>{}</h3></section>", '<div class="x">{}</div>']
    rows, want = [], {}
    for k in range(60):
        parts = [(chance.choice(tags), f"t{k} {j}") for j in range(chance.randint(1, 14))]
        rows.append((k, "https://a.example/", "<article>" + "".join(t.format(x) for t, x in parts) + "</article><aside>no</aside>"))
        want[k] = "\n\n".join(x for _, x in parts)
    assert texts(spark, rows) == want


def test_awkward_tables_of_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string, host string, part int, page string")
    assert extract_pages(empty).collect() == []
    long = "word " * 200_000
    mixed = "".join("<p>x</p>" if k * k % 7 < 3 else "<h2>y</h2>" if k % 3 else "<ul><li>z</ul>" for k in range(4000))
    rows = [(1, None, None, "x", 1, "y"), (None, "https://a.example/", f"<article><p>{long}</p></article>", None, None, None), (3, "https://a.example/", "<article>" + "<p>x</p><h2>y</h2>" * 3000, "x", 1, "y")] * 2
    rows += [(5, "https://a.example/", f"<article>{mixed}</article>", "", 0, ""), (6, "https://a.example/", f"<article><h2>y</h2>{mixed}</article>", "", 0, "")]
    found = sorted((str(r.page_id), r.text, r.n_chars) for r in extract_pages(spark.createDataFrame(rows, empty.schema)).collect())
    both = "\n\n".join(["x", "y"] * 3000)
    joined = "\n\n".join(re.findall("[xyz](?=<)", mixed))
    assert found == [("1", "", 0)] * 2 + [("3", both, len(both))] * 2 + [("5", joined, len(joined)), ("6", "y\n\n" + joined, len(joined) + 3)] + [("None", long.strip(), len(long.strip()))] * 2
