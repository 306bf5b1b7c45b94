"""Text functions: what texts become. Over whole tables they are held against SQL in ``test_queries``."""

import base64

import pytest
from pyspark.sql import functions as F

from foliospark.functions import html as H
from foliospark.functions import render
from foliospark.functions import text as T
from foliospark.functions import tokens as K

#: Per transform: texts and what they become.
PAIRS = {
    "strip_html_entities": [("&lt;b&gt;x&lt;/b&gt; &copy 2024 &notit; &#x80; &#150;", "<b>x</b> © 2024 ¬it; € –"), ("&amp;lt;", "&lt;"), ("R&D & co", "R&D & co"), ("&#99999999;", "\ufffd"), ("", "")],
    "strip_html_tags": [("a < b and c > d", "a   d"), ("<b>x</b>", " x "), ("<a\nhref='x'>y", " y"), ("<>", "<>"), ("a<b", "a<b"), ("<" * 3_000 + ">", " "), ("<i>" * 3_000, " " * 3_000)],
    "strip_markdown_links": [("[l](http://x.y/(z)) end", "l) end"), ("![i](u)", "!i"), ("[a][b](c)", "[a]b"), ("[](x)", "[](x)"), ("[x]()", "[x]()")],
    "strip_urls": [("see https://a.b/c?d=1. end", "see  end"), ("http://x", ""), ("HTTP://X", "HTTP://X"), ("http://a\u3000b", "\u3000b"), ("http://a\x1cb", "\x1cb")],
    "strip_control_chars": [("a\u200bb\ufeffc\x0b\x85\td\n", "abc\td\n"), ("x\r\n", "x\n"), ("soft\xadhyphen", "softhyphen"), ("\ue000", "")],
    "strip_control_chars_exact": [("a\u200bb\ufeffc\x0b\x85\td\n", "abc\td\n"), ("\U0001fae0 stays", "\U0001fae0 stays"), ("\u0378 unassigned", " unassigned"), ("plain", "plain")],
    "strip_pdf_artefacts": [("homepage 12 of 300 Page 3 x", "home x"), ("a\n 17 \n\nb", "a\n\nb"), ("Page \u0661\u0662\n\u0663\n", ""), ("12345", "12345"), ("PAGE\u00a07", ""), ("pages", "pages")],
    "collapse_whitespace": [("a\u00a0b\u3000 \t c\n\n\n\nd ", "a b c\n\nd"), ("\n\n\n", ""), ("\x1c x \r\n y", "x \n y"), ("a b", "a b"), ("\u2003", "")],
    "strip": [("  lead and trail\u00a0\x1f", "lead and trail"), ("\n\t", ""), ("x", "x")],
    "strip_markdown": [
        ("# C# x\n![i](u) **b** _e_ snake_case_name `code`", "Cx\ni b e snakecasename "), ("> q\n- a\n* b\n1. c\n---\n", "q\na\nb\nc\n\n"), ("---\n----\n--", "\n\n--"), ("***a _b_ c***", "a b c"), ("```\nx\n```y", "y"), ("a\r\n---\r\nb", "a\r\n---\r\nb"),
    ],
    "sentences": [("One. Two! Three? \u00c9 no. Yes", ["One.", "Two!", "Three? \u00c9 no.", "Yes"]), ("A.B. c. D", ["A.B. c.", "D"]), (" \n ", []), ("x.\u00a0\n Y ", ["x.", "Y"]), ("no end", ["no end"])],
    "paragraphs": [("a\n\n\n b \n\n\u3000\n\nc\nd", ["a", "b", "c\nd"]), ("", [])],
}


def apply(spark, f, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in sorted(df.select("i", f(F.col("t"))).collect())]


@pytest.mark.parametrize("name", sorted(PAIRS))
def test_transforms(spark, name):
    assert apply(spark, getattr(T, name), [t for t, _ in PAIRS[name]] + [None]) == [w for _, w in PAIRS[name]] + [None]


def test_chain_and_custom_ones(spark):
    page = "&lt;b&gt;Head&lt;/b&gt;  see [the list](u) at http://x.y\u200b now\n\n\n\nPage 3 of 9\n 17 \nEnd\u00a0."
    assert apply(spark, T.normalize, [page, "<p> </p>"]) == ["Head see the list at now\n\nEnd .", ""]
    assert apply(spark, lambda c: T.normalize(c, ()), [page]) == [page]
    assert apply(spark, lambda c: T.normalize(c, (T.strip, T.as_transform(str.upper, python=True))), [" a ", None]) == ["A", None]
    assert apply(spark, T.is_empty, [None, "", " \n \x1c", "a"]) == [True, True, True, False]


def test_normalising_twice_changes_nothing_more(spark):
    texts = [t for pairs in PAIRS.values() for t, _ in pairs if "&" not in t]
    once = apply(spark, T.normalize, texts)
    assert apply(spark, T.collapse_whitespace, once) == once


def test_tokens(spark, tmp_path):
    assert apply(spark, K.estimated, ["", " \n", "one", "two words", "a\u00a0b\x1cc d", "x " * 10, None]) == [0, 0, 1, 2, 5, 13, None]
    (tmp_path / "v.tiktoken").write_text("".join(f"{base64.b64encode(t).decode()} {i}\n" for i, t in enumerate([bytes([b]) for b in range(256)] + [b"ab", b" ab"])))
    path = K.tokenizer_path("v", str(tmp_path))
    assert apply(spark, lambda c: K.exact(c, path), ["ab ab", "abc", "\u00e9", "", None]) == [2, 2, 2, 0, None]
    with pytest.raises(FileNotFoundError):
        K.tokenizer_path("w", str(tmp_path))


def test_line_buckets(spark):
    text = "".join(f"line {i}\n" for i in range(450))
    got = apply(spark, T.line_buckets, [text, "", "a\r\nb\rc", "\n\n", None])
    assert [x.count("\n") for x in got[0]] == [200, 200, 50] and "".join(got[0]) == text
    assert got[1:4] == [[], ["a\nb\nc"], ["\n\n"]] and not got[4]


def test_html(spark):
    page = "<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style></head><body><NAV>n</NAV><p>One &lt;x&gt;</p>\n\n<div><b>Two</b> more</div><!-- no --><script>if (a<b) {}</script><footer>f</footer></body></html>"
    assert apply(spark, H.html_paragraphs, [page, "", None]) == [["T & U\nOne <x>", "Two\n more"], [], None]
    assert apply(spark, H.html_title, [page, "<p>x</p>", "<title> </title>", None]) == ["T & U", None, None, None]


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("a\x01b<p>c", "a\x01b\nc"), ("<p>x</p><nav>menu<p>y", "x"), ("<div><nav>menu</div>text", "text"), ("<header>a<header>b</header>c</header>d", "d"), ('<p title="x>y">z</p>', "z"), ("<b title = 'a>b' c>q</b>", "q"),
        ("a < b and <3 c", "a < b and <3 c"), ("<nav/>x", "x"), ("<!-- c -->x<!-- y", "x"), ("<script>if(a<b)</script>z<style>", "z"), ("</", "</"), ("x</p", "x"), ('<a href="x', ""), ("<table><tr><td><nav>m</td><td>k</table>z", "k\nz"),
        ("<b><nav>x</b>y</nav>z", "z"), ("<SCRIPT >x</script >y", "y"), ("<textarea><p></textarea>z", "<p>\nz"), ("<p a=b/c>z", "z"), ("</nav>x", "x"), ("<section><aside>a</span></section>b", "b"), ("&lt;b&gt;<i>&eacute;", "<b>\n\u00e9"),
    ],
)
def test_html_as_a_parser_reads_it(source, text):
    assert H.page(source)[0] == text


def test_html_of_any_number_of_tags(spark):
    many = ["<b>" * 200_000 + "x" + "</b>" * 200_000, "<div>" * 100_000 + "x" + "</p>" * 100_000, "<a " * 100_000, '<a b="' * 50_000, "<!--" * 100_000, "<nav>" * 50_000 + "y" + "</div>" * 50_000, "<" * 200_000]
    assert apply(spark, H.html_paragraphs, many) == [["x"], ["x"], [], [], [], [], ["<" * 200_000]]


def test_json_and_rows(spark):
    raw = ['{"k":1,"n":{"z":[1,"é"],"t":true,"f":1.0,"o":null}}', "{}", '{"a":{}}', "5", "[1]", "no", None]
    assert apply(spark, render.flatten_json, raw) == ['k: 1\nn.z: [1, "é"]\nn.t: True\nn.f: 1.0\nn.o: None', "", "", "5", ": [1]", None, None]
    df = spark.createDataFrame([("1", "", None), (None, "x", "y")], "a string, b string, c string")
    assert [r[0] for r in df.select(render.row_text(["a", "b", "c"])).collect()] == ["a: 1", "b: x | c: y"]
    assert spark.range(1).select(render.table_text(F.array(F.array(F.lit(" a "), F.lit("b")), F.array(F.lit("c"), F.lit("d"))))).first()[0] == "a | b\nc | d"


def test_metadata(spark):
    meta = "struct<source_path:string,page_or_section:string,timestamp:string,extra:map<string,string>>"
    df = spark.createDataFrame([(("p", "1", "t", {"timestamp": "own", "style": "s"}),), (("q", "2", "u", None),)], f"m {meta}")
    assert [r[0] for r in df.select(render.metadata_map(F.col("m"))).collect()] == [{"source_path": "p", "page_or_section": "1", "timestamp": "own", "style": "s"}, {"source_path": "q", "page_or_section": "2", "timestamp": "u"}]
