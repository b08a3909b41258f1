"""Edge cases of the column functions."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from townpulse.constants import DISTRICT_COORDS
from townpulse.functions import categories, geo, notice_text, text, times
from townpulse.plans.notices import extract_events, notice_days


def column(spark, values, expr, schema="v STRING"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i INT, {schema}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_clock_texts(spark):
    values = ["08:30", "9:00", "24:00", "bad", None, "00:00", "23:59"]
    assert column(spark, values, times.clock_minutes(F.col("v"))) == [510, None, None, None, None, 0, 1439]


def test_durations_wrap_past_midnight(spark):
    df = spark.createDataFrame([(600, 700), (600, 600), (1380, 60)], "a INT, b INT")
    assert [r[0] for r in df.select(times.wrapped_duration(F.col("a"), F.col("b"))).collect()] == [100, 0, 120]


def test_timestamps_with_all_offsets(spark):
    values = [
        "2024-01-02 08:00:00.123456+00", "2024-01-02 15:00:00.123456+07:00", "2024-01-02 15:00:00.123456+0700",
        "2024-01-02 15:00:00.123+07", "garbage", None,
    ]
    got = column(spark, values, times.parse_timestamp(F.col("v")))
    assert got[:3] == [datetime(2024, 1, 2, 8, 0, 0, 123456)] * 3
    assert got[3:] == [datetime(2024, 1, 2, 8, 0, 0, 123000), None, None]


def test_elapsed_days_round_towards_the_past(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-02 12:00:00'),
        (2, TIMESTAMP '2024-01-01 12:00:00', TIMESTAMP '2024-01-01 00:00:00'), (3, TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-01') t(i, a, b)""")
    assert [r[0] for r in df.orderBy("i").select(times.elapsed_days(F.col("a"), F.col("b"))).collect()] == [1, -1, 0]


def test_parse_types(spark):
    values = ["{a,b}", "{ a , }", "{}", None, "ไม่ระบุ", "plain", "{ , }"]
    got = column(spark, values, categories.parse_types(F.col("v")))
    assert got == [["a", "b"], ["a"], ["Unknown"], ["Unknown"], ["Unknown"], ["plain"], ["Unknown"]]


def test_one_hot_drop_first_unknown_and_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("z",)], "c STRING")
    hot = categories.one_hot(df, {"c": ["a", "b", None]}, drop_first=True)
    assert hot.columns == ["c_b", "c_nan"]
    assert sorted(tuple(r) for r in hot.collect()) == [(0.0, 0.0), (0.0, 0.0), (0.0, 1.0), (1.0, 0.0)]
    assert categories.present_values(df, {"c": ["a", "absent", "b", "z", None]}) == {"c": ["a", "b", "z", None]}


def test_one_hot_vector_of_many_values(spark):
    df = spark.range(6000).select((F.col("id") % 5001).alias("k"), F.when(F.col("id") > 0, F.col("id") % 3).alias("small"))
    hot, labels = categories.one_hot_vector(df, ["k", "small"])
    assert len(labels["k"]) == 5001 and labels["small"] == ["0", "1", "2"]
    for r in hot.limit(50).collect():
        assert [labels["k"][i] for i in r.k_vector.indices] == [str(r.k)] and r.k_vector.size == 5002
        assert list(r.small_vector) == [float(r.small == i) for i in range(3)] + [float(r.small is None)]


def test_districts_prefer_earlier_places(spark):
    df = spark.createDataFrame(
        [(0, "near RAMA 9 and sukhumvit", None), (1, "", "Bang Kapi"), (2, None, "วัฒนา"), (3, None, "Atlantis"), (4, None, "Unknown")],
        "i INT, loc STRING, d STRING",
    )
    got = [r[0] for r in df.orderBy("i").select(geo.district_from_location(F.col("loc"), F.col("d"))).collect()]
    assert got == ["วัฒนา", "บางกะปิ", "วัฒนา", "default", "default"]


def test_coordinates_exact_partial_default(spark):
    values = ["ดินแดง", "เขตดินแดง", "จตุ", "nowhere", "", None]
    got = [tuple(p) for p in column(spark, values, geo.district_coords(F.col("v")))]
    default = DISTRICT_COORDS["default"]
    assert got == [DISTRICT_COORDS["ดินแดง"], DISTRICT_COORDS["ดินแดง"], DISTRICT_COORDS["จตุจักร"], default, default, default]


def test_split_coords(spark):
    lon, lat = geo.split_coords(F.col("v"))
    got = column(spark, ["100.5, 13.7", "100.5", "x,y", None], F.array(lon, lat))
    assert got == [[100.5, 13.7], [100.5, None], [None, None], [None, None]]


def test_notice_cleaning(spark):
    raw = [
        "0 9. 0 0 AM - 08. 3 0 PM", "SoiSukhumvit RoadSide oneTwo", "We sincerely apologize", "Moo 1 We sincerely apologize x",
        "ab\nabc\n5\n", "1 0 - 2 0", "a , b.c", "0\n9\n.30", "We sincerely apologize A We sincerely apologize B",
    ]
    got = column(spark, raw, text.clean_notice(F.col("v")))
    assert got == [
        "09:00 AM - 08:30 PM", "Soi Sukhumvit Road Side one Two", "We sincerely apologize", "Moo 1", "abc", "1 0-2 0", "a, b. c",
        "09. 30", "We sincerely apologize A We sincerely apologize B",
    ]


def test_notice_days_and_events(spark):
    notices = spark.createDataFrame([
        (1, "u1", "no header here"),
        (2, "u2", "Saturday, Sep 6, 2025\nFrom 08.30 AM - 04.00 PM Soi 5\nSUNDAY September 7 2025\n\nMonday, Foo 8, 2025\n9.00 to 10.30 Rama 9, Vadhana District"),
        (3, "u3", "Friday, Feb 30, 2025\nsomething here"),
        (4, "u4", "  "),
        (5, "u5", "Saturday, Sep ๖, ๒๐๒๕\nFrom ๐๘.๓๐ AM - ๐๔.๐๐ PM Soi ๕"),
    ], "id INT, announcement_url STRING, content STRING")
    days = notice_days(notices, keep=["id"]).orderBy("id", "section").collect()
    assert [(d.id, d.outage_date, d.day_of_week) for d in days] == [(2, date(2025, 9, 6), "Saturday"), (2, None, ""), (3, None, ""), (5, date(2025, 9, 6), "Saturday")]
    events = extract_events(notice_days(notices, keep=["id"]), keep=["id"]).orderBy("id", "start").collect()
    assert [(e.start, e.end, e.location, e.district) for e in events] == [
        ("08:30", "16:00", "Soi 5", "Unknown"), ("09:00", "10:30", "Rama 9, Vadhana District", "Vadhana"), ("08:30", "16:00", "Soi 5", "Unknown"),
    ]


def test_sections_keep_every_match(spark):
    [got] = column(spark, ["x 1a2b3"], notice_text.sections(F.col("v"), r"\d"))
    assert [tuple(s) for s in got] == [("1", "a"), ("2", "b"), ("3", "")]


def test_html_text_takes_the_whole_nested_block(spark):
    page = (
        '<div class="x content-description y"><p>one &amp; two</p><div>in<script>no()</script>ner</div> tail </div>'
        '<div class="content-description">second</div>'
    )
    got = column(spark, [page, "<p>none</p>", None], text.html_text(F.col("v")))
    assert got == ["one & two\nin\nner\ntail", None, None]


def test_links_are_absolute_and_distinct(spark):
    html = (
        '<div class="col-sm-6 col-md-4 col-lg-4 mb-4"><a href="/news/1">a</a><a href="/news/9">b</a></div>'
        '<div class="col-sm-6 col-md-4 col-lg-4 mb-4"><a class="k" href="https://x.org/news/2">a</a></div>'
        '<div class="col-sm-6 col-md-4 col-lg-4 mb-4"><a href="/other/3">a</a></div>'
        '<div class="col-sm-6 col-md-4 col-lg-4 mb-4"><a href="/news/1">again</a></div><ul class="pagination"><li>1</li></ul>'
    )
    from townpulse.plans.notices import LISTING_ITEM

    [got] = column(spark, [html], text.first_links(F.col("v"), LISTING_ITEM, "https://s.example"))
    assert got == ["https://s.example/news/1", "https://x.org/news/2"]
    assert column(spark, [html, "<p/>", None], text.has_next_page(F.col("v"))) == [True, False, False]


def test_links_behind_nested_boxes_and_other_class_orders(spark):
    from townpulse.plans.notices import LISTING_ITEM

    html = (
        '<div id=i class="mb-4 card col-lg-4 col-md-4 col-sm-6"><div class="img"><img src="x"></div><a href="/news/1">a</a></div>'
        "<div class='col-sm-6 col-md-4 col-lg-4 mb-4'><div><div><a href='/news/2'>b</a></div></div></div>"
        '<div class="col-sm-6 col-md-4 col-lg-4"><a href="/news/3">not an item</a></div>'
    )
    [got] = column(spark, [html], text.first_links(F.col("v"), LISTING_ITEM, "https://s.example"))
    assert got == ["https://s.example/news/1", "https://s.example/news/2"]


def test_pagination_needs_an_entry(spark):
    pages = [
        '<ul class="pagination"></ul><li>x', '<ul class="a pagination b"><li>1</li></ul>', '<div class="pagination"><span><a href=x>2</a></span></div>',
        '<div class="pagination"></div><p><a href="/">home</a>', '<div class="paginations"><a>', '<div class="pagination"><div><a href=x>2</a></div></div>',
    ]
    assert column(spark, pages, text.has_next_page(F.col("v"))) == [False, True, True, False, False, True]


def test_phrases_cut_once(spark):
    got = column(spark, ["aXbXc", "XaXb", "abc", "a\nX", ""], text.cut_at_phrase(F.col("v"), "X"))
    assert got == ["a", "XaXb", "abc", "a\n", ""]
    plan = spark.range(1).select(text.clean_notice(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
    assert plan.count("cast(id") == 1


def test_selectors_see_nesting_and_attributes_in_any_order(spark):
    from townpulse.functions.html import Scan, Selector

    page = (
        "<!-- <div class='box'> --><DIV id=a class='x box'><ul><li><ul CLASS=\"in box\"><li><b>one</b> &lt;two</li></ul></li></ul>"
        "<script>if (a < b) { '</div>' }</script><div title='a > b' class=box>inner<br>line</div></p> tail</div><div class=box>next</div>"
    )
    assert Scan(text="div.box")(page)[0] == "one\n<two\ninner\nline\ntail"
    assert Scan(text="div.box div.box")(page)[0] == "inner\nline"
    assert Scan(text="ul.box li")(page)[0] == "one\n<two"
    assert [Scan(exists=s)(page)[2] for s in ("ul ul li", "li div", "b li", ".in b", "div ul.box", "ul.box.in, i", "i, b", "script li")] == [True, False, False, True, True, True, True, False]
    items = "<ul><li>a<a name=n>no</a><a href='/1'>x</a><a href=/2>y</a><ul><li><a href=/3>z</a></ul></li><li>none</li></ul><a href=/4>out</a>"
    assert Scan(items="li")(items)[1] == ["/1", "/3"]
    assert Scan(items="ul li li")(items)[1] == ["/3"]
    assert Scan(text="p", items="li", exists="ul a")(items + "<p>x")[:] == ("x", ["/1", "/3"], True)
    assert Scan(text="p")("") == (None, [], False) and Scan(text="p")("<p>") == ("", [], False)
    assert Selector("ul.a.b li").chains == [[("ul", frozenset("ab")), ("li", frozenset())]]


def test_selectors_agree_with_a_walk_of_the_tree():
    import random

    from townpulse.functions.html import Scan

    draw, names = random.Random(3), ["div", "ul", "li", "p"]

    def build(depth):
        tag, classes = draw.choice(names), draw.sample("abc", draw.randint(0, 2))
        return tag, classes, [build(depth - 1) if depth and draw.random() < 0.6 else f"t{draw.randint(0, 99)}" for _ in range(draw.randint(0, 3))]

    def markup(node):
        if isinstance(node, str):
            return f" {node} "
        return f"<{node[0]} id=q class='{' '.join(node[1])}'>{'<br/>'.join(map(markup, node[2]))}</{node[0]}>"

    def text(node):
        return node if isinstance(node, str) else "\n".join(filter(None, map(text, node[2])))

    def matches(node, chain, above=()):
        if isinstance(node, str):
            return []
        path, steps = (*above, node), list(chain)
        fits = lambda n, step: step[0] in ("", n[0]) and set(step[1]) <= set(n[1])
        left = steps[:-1]
        for a in above:
            if left and fits(a, left[0]):
                left = left[1:]
        own = [node] if not left and fits(node, steps[-1]) else []
        return own + [m for child in node[2] for m in matches(child, chain, path)]

    for _ in range(300):
        tree = ("div", [], [build(5) for _ in range(3)])
        chain = [(draw.choice([*names, ""]), draw.sample("abc", draw.randint(0, 1))) for _ in range(draw.randint(1, 3))]
        chain = [(tag or ("" if classes else "p"), classes) for tag, classes in chain]
        selector = " ".join(tag + "".join("." + c for c in classes) for tag, classes in chain)
        want = matches(tree, chain)
        assert Scan(text=selector, exists=selector)(markup(tree)) == (text(want[0]) if want else None, [], bool(want)), (selector, markup(tree))


def test_places_are_found_by_priority_and_in_order(spark):
    from townpulse.functions.places import PlaceIndex

    index = PlaceIndex(spark, {"Soi 5": "a", "Lat Phrao": "b", "Phrao": "c", "พระราม": "d", "soi 5": "later", "": "none"})
    texts = ["LAT PHRAO 71 and soi 55, พระราม 9", "phrao", "none", "", None]
    assert column(spark, texts, index.first_in(F.col("v"))) == ["a", "c", None, None, None]
    got = column(spark, texts, index.all_in(F.col("v")))
    assert [g and [tuple(x) for x in g] for g in got] == [[("Lat Phrao", "b"), ("Soi 5", "a"), ("พระราม", "d")], [("Phrao", "c")], [], [], None]
    assert column(spark, texts[:1], PlaceIndex(spark, {}).first_in(F.col("v"))) == [None]


def test_rewrites_are_only_left_out_where_nothing_fits(spark):
    import random

    rng = random.Random(3)
    parts = ["1", "2", "30", " ", "  ", "\n", "\n\n\n", ".", ",", ":", "-", "AM", "pm", "SoiA", "RoadB", "aB", "​", "﻿", "๕", "x"]
    df = spark.createDataFrame([("".join(rng.choice(parts) for _ in range(rng.randrange(25))),) for _ in range(400)], "t STRING")
    plain = [F.regexp_replace("t", *r) for r in text.NOTICE_REWRITES]
    guarded = [text.rewritten(F.col("t"), i) for i in range(len(plain))]
    wrong = [F.count_if(~a.eqNullSafe(b)) for a, b in zip(plain, guarded)]
    changed = [F.count_if(~a.eqNullSafe(F.col("t"))) for a in plain]
    row = df.agg(*wrong, *changed).first()
    assert not any(row[:len(plain)]) and sum(c > 0 for c in row[len(plain):]) > 9
