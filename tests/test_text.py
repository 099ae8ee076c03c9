import html

from dossierflow.functions import text as T
from dossierflow.operators import text as ops


def test_clean_html_cases(texts):
    pages = [
        ("<h2>Досвід <b>роботи</b></h2><p>x</p>", "Досвід роботи\n\nx"),
        ("<dl><dt>Місто:</dt>\n <dd>Київ<br>центр</dd><dt>Ключ</dt></dl>", "Місто: Київ центр\n\nКлюч:"),
        ("<ul><li><p>one <i>x</i></p></li><li> </li><li>two<li>three</ul>", "• one x\n\n• two\n\n• three"),
        ("a<br>b<!-- c -->d<br/>e", "a\nb\nd\ne"),
        ("<p>a<script>var t='</p>';</script>b</p>", "a b"),
        ("<p><b>one<br><p>two</p>", "one\n\ntwo"),
        ("<div class='x hidden-print y'><div>in</div><p>q</p></div>after", "after"),
        ("<div class=\"hidden-print\">" + "<div>" * 9 + "x" + "</div>" * 9 + "</div>kept", "kept"),
        ("<p>&nbsp;K&amp;lt; &#1082;&#x43A; &copy; &foo; &</p>", "K&lt; кк © &foo; &"),
        ("<p>x</p>OK<br>•<br>y", "x\n\ny"),
        ("a\u200bb\u00a0c \t d", "ab c d"),
        ("<STYLE>x</STYLE><P>up</P>", "up"),
        ("", ""),
    ]
    got = texts(T.clean_html, [p for p, _ in pages])
    assert got == [w for _, w in pages]
    assert texts(T.clean_html, [None]) == [""]


def test_element_nesting(texts):
    deep = "<div>" * 30 + "x" + "</div>" * 30
    cases = [
        ("<div id='a'><div>x</div><!-- </div> --><script></div></script>y</div>z<div>",
         "<div id='a'><div>x</div><!-- </div> --><script></div></script>y</div>"),
        (deep + "tail</div>", deep),
        ("<div>open", "<div>open"),
        ("<div><divx></divx>a</div>b", "<div><divx></divx>a</div>"),
    ]
    assert texts(T.div_element, [c for c, _ in cases]) == [w for _, w in cases]
    assert texts(lambda c: T.first_element(c, "div").element, [c for c, _ in cases]) == [w for _, w in cases]


def test_lines(texts):
    assert texts(T.lines_of, [" a\u00a0 b \r\n\r\n c\x0bd\u2028e ", "", None]) == [["a b", "c", "d", "e"], [], []]


def test_line_table_bullets(spark):
    df = spark.createDataFrame([(1, "• a\n-\n b"), (2, ""), (3, None)], "id int, t string")
    rows = ops.line_table(df, "t", ["id"], drop_bullets=True).orderBy("id", "line_no").collect()
    assert [(r.id, r.line_no, r.line) for r in rows] == [(1, 1, "a"), (1, 2, "b")]


def test_classify(spark):
    df = spark.createDataFrame(
        [("ОСВІТА",), ("a:\nb:\nc:\nd:\ne: f",), ("a:\nb:",), (None,)], "cleaned_text string"
    )
    assert [r.format for r in ops.classify_format(df).collect()] == ["structured", "br_only", "unknown", "unknown"]


def test_container_modes(spark):
    pages = spark.createDataFrame(
        [
            ("https://x/resumes/5/", "<p>a</p><div class=c id=resume_5><div>b</div></div><p>c</p>"),
            ("https://x/resumes/5/", "<div id='resume_55'>b</div>"),
            ("https://x/resumes/5", "<div id='resume_5'>b</div>"),
            ("https://x/resumes/5/", "<script>\"<div id='resume_5'>\"</script><div id='resume_5'>r</div>x"),
        ],
        "source_url string, html string",
    )
    rows = ops.select_container(pages).collect()
    assert [r.parse_mode for r in rows] == [
        "resume_id_block", "whole_page_fallback", "whole_page_fallback", "resume_id_block"
    ]
    assert rows[0].raw_html == "<div class=c id=resume_5><div>b</div></div>"
    assert rows[1].warnings == ["missing_main_resume_block", "used_whole_page_fallback"]
    assert rows[2].warnings == ["used_whole_page_fallback"]
    assert rows[3].raw_html == "<div id='resume_5'>r</div>"


def test_list_helpers(texts):
    from pyspark.sql import functions as F

    distinct = texts(lambda c: T.distinct_by(c, F.lower), [["b", "a", "B", "c", "a"], []], "array<string>")
    assert distinct == [["b", "a", "c"], []]
    assert texts(lambda c: T.runs(c, lambda x: x), [["a", "a", "b"], []], "array<string>") == [[["a", "a"], ["b"]], []]


def test_character_references_follow_html(texts):
    same = [
        "caf&eacute; &frac12; &rarr; &copy 2024 &nbsp x", "&#150;&#x80;&#0150;&#129;", "&#8211 &#65b &#x41;", "a &amp;lt; b",
        "&#0; &#xD800; &#x110000; &#99999999999; &#x99999999999;", "&#1;&#11;&#127;&#xFFFE;x", "&NotEqualTilde;&bsol;&apos;",
        "&unknown; & &; &#; &#x; &amp", "&CounterClockwiseContourIntegral;&ZeroWidthSpace;", "", "no reference",
    ]
    assert texts(T.decode_entities, same) == [html.unescape(t) for t in same]
    links = ["?a=1&copy=2&amp;b=3", "?x=1&region=2&notit"]
    assert texts(T.decode_entities, links) == ["?a=1&copy=2&b=3", "?x=1&region=2&notit"]


NESTED = {
    "<dl><dt>City:</dt><dd><p>Київ</p></dd><dt>A</dt>\n<dd>b</dd></dl>": ["City: Київ", "A: b"],
    "<ul><li><p>a</p><p>b</p></li><li>c</li></ul>": ["• a b", "• c"],
    "<ul><li>a<ul><li>b</li><li>c</li></ul></li><li>d</li></ul>": ["• a b c", "• d"],
    "<ul><li><div><p>a</p></div></li></ul>x": ["• a", "x"],
    "<ul><li>a<li>b</ul><p>z</p>": ["• a", "• b", "z"],
    "<div><p>a</div><div>b</div>": ["a", "b"],
    "<p>a<br>b</p>c<br>d": ["a b", "c", "d"],
    "<li><dl><dt>k</dt><dd>v</dd></dl></li>": ["• k: v"],
    "<p/>a<p>b</p>": ["a", "b"],
    "<h2>T <p>u</p></h2><p>v</p>": ["T u", "v"],
    "<p title='a > b'>x</p><a href=\"?a>b\">y</a>": ["x", "y"],
    "<li><p></p></li><li>q</li>": ["• q"],
    "<dl><dt>k<dd>v<dt>m<dd>n</dl><p>w": ["k: v", "m: n", "w"],
    "<p>it's = \"fine</p><p>two": ["it's = \"fine", "two"],
    "<blockquote><p>q<p>r</blockquote>s": ["q", "r", "s"],
    "<li>a<ul><li>b<li>c</ul>d</li><li>e": ["• a b c d", "• e"],
    "<ul>" + "<li>x" * 300 + "</ul>end": ["• x"] * 300 + ["end"],
    "<div><li>" + "<p>word</p>" * 2000 + "</li></div>z": ["• " + " ".join(["word"] * 2000), "z"],
}


def test_outermost_of_nested_blocks_is_one_line(texts):
    got = texts(T.clean_html, list(NESTED))
    assert [[line for line in t.split("\n") if line] for t in got] == list(NESTED.values())
