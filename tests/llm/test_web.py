from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from compare import connect, from_duckdb, from_spark
from pyspark.sql import functions as F

from cohortry.llm import html_text, warc
from cohortry.llm.html_text import blocks, main_text, minimum_cut

STATED = np.array(list(html_text.WEIGHTS.values()))


def cut_cost(gain, joins, side):
    cost = sum(-g if s else 0.0 for g, s in zip(gain, side))
    return cost + sum(c for i, j, c in joins if side[i] != side[j])


def test_minimum_cut_is_the_best_labelling():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randrange(1, 9)
        gain = [rng.uniform(-2, 2) for _ in range(n)]
        joins = [
            (i, j, rng.uniform(0, 1.5)) for i in range(n) for j in range(i) if rng.random() < 0.6
        ]
        best = min(cut_cost(gain, joins, s) for s in itertools.product((False, True), repeat=n))
        assert cut_cost(gain, joins, minimum_cut(gain, joins)) == pytest.approx(best)


ARTICLE = "<p>The first paragraph tells a long story about something of note.</p>"
SECOND = "<p>A second one goes on with it, and says &amp; means the same&nbsp;thing.</p>"
STORY = (
    "The first paragraph tells a long story about something of note.\n"
    "A second one goes on with it, and says & means the same thing."
)


@pytest.mark.parametrize(
    "page",
    [
        f"<nav><a href=x>Home</a></nav><main>{ARTICLE}{SECOND}</main><footer>&copy; us</footer>",
        f"<div class='navbar'><a href=x>Home</a> <a>News</a></div><div id=content>{ARTICLE}{SECOND}</div>",
        f"<body>{ARTICLE}<div class=ad>Buy our very fine thing today, it is cheap.</div>{SECOND}</body>",
        f"<article>{ARTICLE}{SECOND}<section id='comments'><p>I do not agree with this at all, sorry.</p></section></article>",
        f"<script>var t='</p><p>no text';</script><style>p {{}}</style>{ARTICLE}<!-- <p>gone</p> -->{SECOND}",
        f"{ARTICLE}<form><p>Please sign in to go on with your reading here.</p><input></form>{SECOND}",
        f"<div class='cookie-notice'>We use cookies to make this site better for you.</div>{ARTICLE}{SECOND}",
        f"{ARTICLE}{SECOND}<aside><p>Other stories that you might like to read some day.</p></aside>",
        f"<header><h1>The Daily Site</h1></header>{ARTICLE}{SECOND}<div style='display:none'>Hidden words of no use at all here.</div>",
        f"{ARTICLE}<ul class=menu><li><a>One</a><li><a>Two</a></ul>{SECOND}<div class=sidebar><p>Weather: it is going to rain.</p></div>",
    ],
)
def test_boilerplate_goes_and_text_stays(page):
    assert main_text(page, STATED) == STORY


def test_blocks_read_broken_markup():
    page = "a<b>b</b>c<p>one<p>two <a title='x > y'>li\nnk</a><br>three</div><li>q<li>r&lt;s &#x41;&bad;<!-- x"
    assert [b.text for b in blocks(page)] == ["abc", "one", "two li nk three", "q", "r<s A&bad;"]
    assert blocks("") == [] and blocks("<p></p><script>x") == []
    assert [b.text for b in blocks("x < y and z <p>&amp;lt;</p>")] == ["x < y and z", "&lt;"]
    assert [b.text for b in blocks('<p>a <i title="un>closed>b</p><p>c</p>')][-1] == "c"


SKIPPED_PAGES = [
    "<header><button>Menu</header>{a}{b}<footer><button>Up</button></footer>",
    "{a}<button>Menu{b}",
    "<button>Menu{a}{b}<button>Up</button>",
    "{a}<div><select><option>One<option>Two</div>{b}<div><select><option>x</select></div>",
    "<select><option>One<option>Two{a}{b}",
    "{a}<video src=x controls>{b}",
    "<div><video src=x>No video</div>{a}{b}<video>none</video>",
    "<object data=x>{a}<object data=y><p>No plug-in here.</p></object>{b}",
    "{a}<svg><title>Icon</svg>{b}<svg><title>x</title></svg>",
    "{a}<svg><path d=x><text>Icon{b}",
    "{a}<noscript><p>Turn scripts on, please.</p></noscript><template><li>No.</li></template>{b}",
    "{a}<object data=x><div><p>Some other words.</p></div></object><button><b>Go</b></button>{b}",
    "{a}<button>Go <script>var t='</button><p>no text';</script></button>{b}",
    "{a}</button>{b}</select><datalist><option>q",
]


@pytest.mark.parametrize("page", SKIPPED_PAGES)
def test_unclosed_skipped_elements_end(page):
    page = page.format(a=ARTICLE, b=SECOND)
    assert [b.text for b in blocks(page)] == STORY.split("\n")
    assert [b.text for b in blocks(f"<html><body>{page}</body></html>")] == STORY.split("\n")


def test_many_unclosed_elements_are_read_in_one_pass():
    page = ("<object><button>x<video>" + ARTICLE) * 5000
    assert len(blocks(page)) == 5000


def test_titles_inside_the_article_stay():
    page = f"<article><header class='entry-header'><h1>A title of some length</h1></header>{ARTICLE}</article>"
    assert main_text(page, STATED).split("\n")[0] == "A title of some length"


def test_huge_and_deep_pages():
    page = "<article>" + "<div>" * 3000 + ARTICLE * 2000 + "</article>"
    assert main_text(page, STATED).count("\n") == 1999


PAGES = "page_id BIGINT, url STRING, html STRING, text STRING"


def test_extraction_of_a_table(spark, small):
    rows = [(1, None, None, "x"), (2, "u", "", None), (3, "u", f"<main>{ARTICLE}{SECOND}</main>", ""), (None, None, "<p>", "")]
    rows.append(rows[2])
    found = html_text.extract(spark.createDataFrame(rows, PAGES).repartition(2)).collect()
    expected = [(1, None, "", 0), (2, "u", "", 0), (3, "u", STORY, len(STORY)), (None, None, "", 0), (3, "u", STORY, len(STORY))]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert html_text.extract(spark.createDataFrame([], PAGES)).collect() == []
    pages = spark.read.parquet(f"{small}/pages.parquet")
    for r in html_text.extract(pages).join(pages.drop("url"), "page_id").collect():
        inner = r["html"].split("<article>")[1].split("</article>")[0]
        title = blocks(inner)[0].text
        assert r["text"].startswith(title)
        assert r["text"].split("\n") == [b.text for b in blocks(inner)]


def test_revisits_of_the_derived_archive(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    assert from_spark(warc.revisits(pages)) == from_duckdb(connect(small), warc.ORACLE)


RECORDS = (
    "record_id BIGINT, target_uri STRING, warc_date BIGINT, record_type STRING, status INT,"
    " http_headers STRING, payload STRING, url STRING"
)
OK = "HTTP/1.1 200 OK\r\n"
SAME = "HTTP/1.1 304 Not Modified\r\n"


def resolved(spark, rows, **keep):
    frame = spark.createDataFrame([(*r, "x") for r in rows], RECORDS).repartition(3)
    found = warc.with_payloads(warc.resolve_revisits(frame), frame)
    return {r["record_id"]: r for r in found.collect()}


def test_revisits_take_the_latest_earlier_response(spark):
    page = "http://a.org/p"
    found = resolved(
        spark,
        [
            (1, page, 10, "response", 200, OK + 'ETag: "a"\r\nX: 1\r\nContent-Type: t\r\nX: 2\r\n\r\n', "one"),
            (2, page, 20, "response", 200, OK + 'etag:"b"\r\nLast-Modified: m\r\n', "two"),
            (3, page, 15, "revisit", 304, SAME + 'ETag: W/"a"\r\nX: 3\r\nContent-Type: z\r\nContent-Length: 0\r\n', None),
            (4, "HTTP://A.org:80/p#q", 30, "revisit", 304, SAME + 'ETag: "a"\r\n', None),
            (5, page, 30, "revisit", 304, SAME + "Last-Modified: m\r\n", None),
            (6, page, 10, "revisit", 304, SAME, None),
            (7, page, 25, "response", 404, OK, "error"),
            (8, page, 26, "response", 200, OK, None),
            (9, page, 40, "revisit", 304, None, None),
            (10, None, 40, "revisit", 304, SAME, None),
            (11, page, None, "revisit", 304, SAME, None),
            (12, "", 40, "revisit", 304, SAME, None),
            (13, "http://a.org", 41, "response", 200, OK, "root"),
            (14, "http://a.org/", 42, "revisit", 304, SAME, None),
            (15, "http://A.org?x", 42, "revisit", 304, SAME, None),
            (2, page, 20, "response", 200, OK + 'etag:"b"\r\nLast-Modified: m\r\n', "two"),
            (16, page, 50, None, 200, None, "?"),
        ],
    )
    brief = {k: (r["outcome"], r["refers_to"], r["payload"]) for k, r in found.items()}
    assert brief == {
        3: ("resolved", 1, "one"), 4: ("mismatch", 2, None), 5: ("resolved", 2, "two"),
        6: ("no_response", None, None), 9: ("unverified", 2, "two"), 10: ("no_response", None, None),
        11: ("no_response", None, None), 12: ("no_response", None, None),
        14: ("unverified", 13, "root"), 15: ("no_response", None, None),
    }
    assert found[3]["headers"] == 'content-type: t\netag: W/"a"\nx: 3'
    assert found[4]["headers"] is None


def test_no_header_field_is_dropped(spark):
    page, many = "http://a.org/p", "".join(f"X-{k}: {k}\r\n" for k in range(10_500))
    rows = [
        (1, page, 10, "response", 200, OK + many + 'ETag: "a"\r\n', "one"),
        (2, page, 20, "revisit", 304, SAME + 'ETag: "a"\r\n', None),
        (3, page, 20, "revisit", 304, SAME + many + 'ETag: "b"\r\n', None),
    ]
    found = resolved(spark, rows)
    assert (found[2]["outcome"], found[3]["outcome"]) == ("resolved", "mismatch")
    assert found[2]["headers"].count("\n") == 10_500


def test_a_url_with_most_records_spans_ranges(spark):
    rng = random.Random(3)
    rows, answers, last = [], {}, None
    for at in range(900):
        kind = rng.random()
        if kind < 0.05:
            last = at
            rows.append((at, "http://hot.org/", at, "response", 200, OK, f"body {at}"))
        else:
            answers[at] = last
            rows.append((at, "http://hot.org/", at, "revisit", 304, SAME, None))
    rows += [(2000 + k, f"http://cold{k}.org/", 5, "revisit", 304, SAME, None) for k in range(50)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = resolved(spark, rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {k: r["refers_to"] for k, r in found.items() if k < 2000} == answers
    assert all(r["payload"] == f"body {r['refers_to']}" for k, r in found.items() if answers.get(k))


def test_no_records(spark):
    assert warc.resolve_revisits(spark.createDataFrame([], RECORDS)).collect() == []


COUNCIL = "".join(
    f"<p>The council met on a rainy evening to discuss the new bridge and its many costs, number {i}. {'It was late. ' * 20}</p>"
    for i in range(4)
)
MENU = "<nav><a href=a>Home</a> <a href=b>News</a></nav>"
FOOT = "<footer>© 2020 All rights reserved</footer>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body>{MENU}<form id=all><div>{COUNCIL}</div><input name=q></form>{FOOT}",
        f"<body>{MENU}<div class='content no-sidebar'>{COUNCIL}</div>{FOOT}",
        f"<body>{MENU}<div class='has-header'>{COUNCIL}</div>{FOOT}",
        f"<body>{MENU}<div class='with-ads wide'>{COUNCIL}</div>{FOOT}",
        f"<body>{MENU}<div id=noSidebar>{COUNCIL}</div>{FOOT}",
        f"<body>{MENU}<div class='page header-fixed'>{COUNCIL}</div>{FOOT}",
    ],
)
def test_wrappers_do_not_hide_the_article(page):
    weights = np.array(list(html_text.WEIGHTS.values()))
    lines = html_text.main_text(page, weights).split("\n")
    assert len(lines) == 4 and all("council" in line for line in lines)


def test_long_comments_and_forms_stay_apart():
    weights = np.array(list(html_text.WEIGHTS.values()))
    page = (
        f"<body>{MENU}<article>{COUNCIL}</article><form><p>{'Tell us what you think of it. ' * 9}</p></form>"
        f"<section class=comments>{COUNCIL.replace('council', 'readers') * 6}</section>{FOOT}"
    )
    text = html_text.main_text(page, weights)
    assert text.count("council") == 4 and "readers" not in text and "Tell us" not in text


def test_the_sample_does_not_grow(spark):
    html = [(i, f"u{i % 7}", f"<article><p>page {i % 1500} {'word ' * 30}</p></article>") for i in range(3000)]
    html += [(9000 + i, None, "<p>the same page</p>") for i in range(2000)]
    pages = spark.createDataFrame(html, "page_id BIGINT, url STRING, html STRING").repartition(16)
    seen = []
    plain, html_text.fit = html_text.fit, lambda found: seen.append(found) or plain(found)
    try:
        weights = html_text.learn(pages)
        assert np.allclose(weights, html_text.learn(pages.repartition(3)))
    finally:
        html_text.fit = plain
    assert len(seen[0]) == len(set(seen[0])) == html_text.SAMPLE_PAGES and seen[0] == seen[1]


def test_the_revisits_of_one_response_are_spread(spark):
    """Eight in ten records are revisits of the same response."""
    revisits = spark.range(20_000).selectExpr(
        "id + 100 AS record_id", "IF(id % 10 < 8, 'http://hot.org/', concat('http://o.org/', id % 50)) AS target_uri",
        "id + 100 AS warc_date", "'revisit' AS record_type", "304 AS status",
        "concat('HTTP/1.1 304 Not Modified\\r\\nDate: d', id, '\\r\\n\\r\\n') AS http_headers", "CAST(NULL AS STRING) AS payload",
    )
    responses = spark.range(51).selectExpr(
        "id AS record_id", "IF(id = 50, 'http://hot.org/', concat('http://o.org/', id)) AS target_uri", "id AS warc_date",
        "'response' AS record_type", "200 AS status", "'HTTP/1.1 200 OK\\r\\nX: 1\\r\\n\\r\\n' AS http_headers",
        "concat('body ', id) AS payload",
    )
    records = revisits.unionByName(responses)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    plain = sorted(map(tuple, warc.resolve_revisits(records).collect()))
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = warc.resolve_revisits(records, slice_rows=500)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) < 6000
        bodies = warc.with_payloads(found, records, slice_rows=500)
        sizes = [r["count"] for r in bodies.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) < 6000
        assert bodies.where("payload = 'body 50'").count() == 16_000
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert sorted(map(tuple, found.collect())) == plain
