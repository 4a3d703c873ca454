import random
import re

import pyarrow.parquet as pq
import pytest

from placemill.llm.html_text import LONG_RUN, SHARE, WINDOW, extract, main_lines, main_text, page_lines

CASES = [
    (None, ""), ("", ""), ("plain   text", "plain text"),
    ("<p>a &lt;b&gt; &#x41;&nbsp;c<br>d</p><p>e", "a <b> A c d\n\ne"),
    ("<head><title>T</title><style>p{}</style></head><nav><p>menu</p></nav><script>var a='<p>no</p>'</script><article><h1>H</h1><p>x</p></article><footer>f</footer>",
     "H\n\nx"),
    ("<body><header>top</header><main><p>One <a href=x>link</a> two.</p><aside>no</aside><p>Z</p><form><input></form></main></body>", "One link two.\n\nZ"),
    ('<div class="cookie-notice">We use cookies</div><p>Only text.</p><div id=comments><p>me too</p></div>', "Only text."),
    ('<article><p>x</p><section class="comments"><article><p>nice post</p></article></section><p>y</p></article>', "x\n\ny"),
    ('<div class="with-sidebar"><p>kept</p><div class="sidebar"><div>in</div> side</div></div>', "kept"),
    ("<article><p>broken <b>off &amp", "broken off &"), ("<article>x<!-- never closed <p>y", "x"), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
    ('<article><p title="a > b">q</p><div class="ad">buy</div><p>r</p></article>', "q\n\nr"),
    ('<article><div class="article-header"><h1>T</h1></div><p>x</p></article><div class="page-header">no</div>', "T\n\nx"),
    ("<ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul><hr><hr><hr>" + "".join(f"<p>{'word ' * 30}{i}</p>" for i in range(3)),
     "\n\n".join(f"{'word ' * 30}{i}" for i in range(3))),
]


@pytest.mark.parametrize("page,text", CASES)
def test_main_text(page, text):
    assert main_text(page) == text


def test_long_page_and_many_blocks():
    body = "".join(f"<p>{i}</p>" for i in range(20_000))
    assert main_text(f"<article>{body}</article>") == "\n\n".join(map(str, range(20_000)))
    assert main_text("<div" * 30_000) == "" and main_text("<p>" + "&" * 50_000) == "&" * 50_000


def test_window_sums_decide_on_pages_with_an_article():
    long = "word " * 30 + "end"
    apart = "<nav><p>menu</p></nav>" * 3
    assert main_text(f"<article><p>{long}</p></article>{apart}<p>{long} too</p>") == f"{long}\n\n{long} too"
    assert main_text(f"<article><p>{long}</p>{apart}<p>short</p></article>") == long
    assert main_text(f"<article><p>{long}</p><p><a href=x>{long}</a></p></article>") == f"{long}\n\n{long}"


def test_extract(spark):
    rows = [(i, f"u{i}", h, "x") for i, (h, _) in enumerate(CASES)] + [(None, None, None, None), (1, "u1", "", "x")]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == len(rows)
    assert {r["page_id"]: (r["text"], r["n_chars"]) for r in got if r["page_id"] == 3} == {3: (CASES[3][1], len(CASES[3][1]))}
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def plain_main_lines(lines):
    """The rule of the module, one line at a time."""
    size = lambda i: 0 if i >= len(lines) or not lines[i][0] else len(lines[i][0]) if lines[i][2] else lines[i][1]
    total = [sum(size(i + k) for k in range(WINDOW)) for i in range(len(lines))]
    needed = max(1, min(LONG_RUN, max(total, default=0) * SHARE))
    run_of, runs = {}, 0
    for i, t in enumerate(total):
        if t:
            runs += i == 0 or not total[i - 1]
            run_of[i] = runs
    high = {run for i, run in run_of.items() if total[i] >= needed}
    begun, kept = set(), []
    for i, (text, _, _) in enumerate(lines):
        run = run_of.get(i)
        if run and min(high, default=run + 1) <= run <= max(high, default=0):
            if size(i):
                begun.add(run)
            if text and run in begun:
                kept.append(text)
    return kept


def test_windows_against_a_plain_rule():
    draw = random.Random(5)
    for _ in range(3_000):
        lines = []
        for _ in range(draw.randint(0, 30)):
            text = "x" * draw.choice([0, 0, 1, 20, 90, 200, 500])
            lines.append((text, draw.choice([0, len(text)]), bool(text) and draw.random() < 0.2))
        assert main_lines(lines) == plain_main_lines(lines)


def test_pages_whose_boilerplate_has_no_telling_names():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"]).column(0).to_pylist()
    same = 0
    for page in pages:
        plain = re.sub(r"<(/?)(?:nav|footer|article)\b", r"<\1div", page.replace(' class="ad"', ""))
        assert plain != page and main_text(plain) != "\n\n".join(t for t, _, _ in page_lines(plain) if t)
        same += main_text(plain) == main_text(page)
    assert same >= 0.9 * len(pages)  # short articles are hard to tell from adverts and footers
