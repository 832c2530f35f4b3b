from mirrorflow.sources import pages

HTML = """<html><body>
<select id="other"><option value="9">No</option></select>
<select class="InputText big" id="list"><option value="">All</option>
<option value="8,12" selected>Alba &amp; Co
<option  VALUE='x'> <b>Al</b>geria</option></select>
<table id="x"><tr><td>skip</td></tr></table>
<table border=1 id="notes">
 <tr><th>Reporter</th><th>Trade Flow</th><th> Valuation </th></tr>
 <tr class="a"><td>Chile</td><td>Import</td><td>CIF</td></tr>
 <tr><td> Peru&nbsp;</td><td>Export</td><td><i>FOB</i></td></tr>
 <tr><td>Short</td></tr>
 <tr><td>1</td><td>2</td></tr>
</table></body></html>"""


def page(spark):
    return spark.createDataFrame([(1, HTML), (2, "<p>nothing</p>"), (3, None)], "page int, html string")


def test_elements(spark, rows):
    out = pages.extract_elements(
        page(spark), "select", "option", "value", {"id": "list", "class": "InputText"}, keys=["page"]
    )
    assert rows(out) == [(1, 0, "All", ""), (1, 1, "Alba & Co", "8,12"), (1, 2, "Algeria", "x")]


def test_table(spark, rows):
    out = pages.extract_table(
        page(spark), ["reporter", "valuation", "trade_flow", "absent"], {"id": "notes"}, keys=["page"]
    )
    kept = pages.drop_pager_rows(out)
    assert rows(kept) == [
        (1, 0, "Chile", "CIF", "Import", None), (1, 1, "Peru", "FOB", "Export", None),
        (1, 2, "Short", None, None, None),
    ]
    assert out.count() == 4


def test_split_ids(spark, rows):
    df = spark.createDataFrame([("8,12",), ("all",), ("12, 31",), ("",), (None,)], "ids string")
    assert rows(pages.split_ids(df, "ids")) == [(12,), (31,), (8,)]


def test_attributes_match_whole_names_and_values(spark, rows):
    html = """<nav data-id='list'><a href='wrong'>w</a></nav><!-- <nav id="list"><a href='gone'>g</a></nav> -->
<nav title="x id=list" id='my-list'><a href='wrong'>w</a></nav>
<nav class="top bar-menu" id="list"><a data-href='no' href='yes'>one</a><a data-href='no'>two</a><a href=bare>three</a></nav>"""
    df = spark.createDataFrame([(html,)], "html string")
    want = [(0, "one", "yes"), (1, "two", None), (2, "three", "bare")]
    assert rows(pages.extract_elements(df, "nav", "a", "href", {"id": "list"})) == want
    assert rows(pages.extract_elements(df, "nav", "a", "href", {"id": "list", "class": "bar-menu"})) == want
    assert pages.extract_elements(df, "nav", "a", "href", {"class": "menu"}).count() == 0
    assert pages.extract_elements(df, "nav", "a", "href", {"id": "l.st"}).count() == 0


def test_table_is_not_taken_for_another_id(spark, rows):
    html = """<table id='my-notes'><tr><th>Reporter</th></tr><tr><td>Wrong</td></tr></table>
<table data-id='notes'><tr><th>Reporter</th></tr><tr><td>Wrong</td></tr></table>
<table id=notes><tr><th>Reporter</th><th>Value</th><th>value</th></tr><tr><td>Right</td><td>1</td><td>2</td></tr></table>"""
    df = spark.createDataFrame([(html,)], "html string")
    out = pages.extract_table(df, ["reporter", "value", "value_2"], {"id": "notes"})
    assert rows(out) == [(0, "Right", "1", "2")]


def test_entities(spark):
    cases = [
        ("C&ocirc;te d&#39;Ivoire", "Côte d'Ivoire"), ("S&#xE3;o Tom&eacute;", "São Tomé"),
        ("&lt;b&gt; &amp;amp; &#233;", "<b> &amp; é"), ("a &unknown; b &#9999999; c & d", "a &unknown; b &#9999999; c & d"),
        ("&#128512;", "\U0001f600"), ("a&nbsp;&nbsp;b", "a b"), ("&Eacute;&eacute;", "Éé"), ("", ""), (None, None),
    ]
    df = spark.createDataFrame([(a,) for a, _ in cases], "t string")
    assert [r[0] for r in df.select(pages.element_text(df.t)).collect()] == [b for _, b in cases]


def test_long_tags_and_many_attributes(spark, rows):
    """Neither a long tag nor many attributes nor deep nesting recurses."""
    many = " ".join(f"a{i}='{i}'" for i in range(100_000))
    html = [
        f"<nav {'x' * 1_000_000} id=list><a {many} href='far'>one</a></nav>",
        f"<nav title=\"{'> ' * 500_000}\" {many} id='list'><a href=b>two</a></nav>",
        "<nav>" * 20_000 + "<nav id=list><a href=c>three<nav><a href=d>four</a></nav></a>" + "</nav>" * 20_000,
        "<nav id='list'" + " \"'" * 200_000,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(html)], "page int, html string")
    out = pages.extract_elements(df, "nav", "a", "href", {"id": "list"}, keys=["page"])
    assert rows(out) == [(0, 0, "one", "far"), (1, 0, "two", "b"), (2, 0, "three", "c"), (2, 1, "four", "d")]
    table = [
        f"<table {many} id=t><tr><th {many}>A</th></tr><tr><td {'y' * 1_000_000}>1</td></tr></table>",
        "<table>" * 5_000 + "<table id=t><tr><th>A<tr><td>x" + "<table><tr><td>y" * 5_000,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(table)], "page int, html string")
    got = rows(pages.extract_table(df, ["a"], {"id": "t"}, keys=["page"]))
    assert got == [(0, 0, "1"), (1, 0, "x" + "y" * 5_000)]


def test_nested_and_spanning_cells(spark, rows):
    html = """</table><table id=t><tr><th>A</th><th colspan='2'>B</th><th>C</th></tr>
<tr><td rowspan=2>1<table><tr><td> in</td></tr><tr><td>ner</table></td><td>2</td><td>3</td><td rowspan=0>4</td></tr>
<tr><td colspan="2">5</td></tr>
<tr><td>6</td><td rowspan=9>7</td></tr></table>
<script>var x = "<table id=t>";</script>"""
    df = spark.createDataFrame([(html,)], "html string")
    got = rows(pages.extract_table(df, ["a", "b", "b_2", "c"], {"id": "t"}))
    assert got == [(0, "1 inner", "2", "3", "4"), (1, "1 inner", "5", "5", "4"), (2, "6", "7", None, "4")]


def test_spans_against_a_drawn_grid():
    """Every cell laid down on a grid drawn in full, for random tables."""
    import random

    rnd = random.Random(4)
    for _ in range(300):
        n, cells = rnd.randint(1, 6), []
        for row in range(n):
            for _ in range(rnd.randint(0, 4)):
                cells.append((row, f"c{len(cells)}", rnd.choice([None, "1", "2", "3", "x"]), rnd.choice([None, "1", "2", "3"])))
        grid = {}
        for row, text, down, right in cells:
            column = next(c for c in range(1000) if (row, c) not in grid)
            for c in range(column, column + int(right or 1)):
                if (row, c) in grid:
                    break
                for r in range(row, row + (int(down) if down in ("1", "2", "3") else 1)):
                    grid[r, c] = text
        last = max((r for r, *_ in cells), default=-1)
        want = []
        for r in range(last + 1):
            width = max((c for rr, c in grid if rr == r), default=-1) + 1
            want.append([grid.get((r, c)) for c in range(width)])
        assert pages.spread_cells(cells) == want
