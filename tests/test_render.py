"""The renderer: what markup gives, piece by piece, and in which time."""

import time

import pytest

from anchorwise.functions.render import render

# markup: what its HTML is, without line ends
RENDERED = {
    "": "", "a\nb\n\nc": "<p>a b</p><p>c</p>",
    "* a\n** b\n*# c\n* d": "<ul><li>a<ul><li>b</li></ul><ol><li>c</li></ol></li><li>d</li></ul>",
    "; t : d\n: e\n;; x": "<dl><dt>t</dt><dd>d</dd><dd>e<dl><dt>x</dt></dl></dd></dl>",
    "#a\ntext": "<ol><li>a</li></ol><p>text</p>", "*:* deep": "<ul><li><dl><dd><ul><li>deep</li></ul></dd></dl></li></ul>",
    "{|\n|+ Cap\n! h !! i\n|-\n| style=x | a || b\nmore\n* l\n|}": "<table><caption>Cap</caption><tr><th>h</th><th>i</th></tr><tr><td>a</td><td>b more<ul><li>l</li></ul></td></tr></table>",
    "{|\n|\n{|\n| in\n|}\n| out\n|}": "<table><tr><td><table><tr><td>in</td></tr></table></td><td>out</td></tr></table>",
    "{|\n| open": "<table><tr><td>open</td></tr></table>", "|} x\n| y": "<p>|} x | y</p>",
    "{|\n| [[A|b]] || {{t|x||y}}\n|}": '<table><tr><td><a href="/A">b</a></td><td>{{t|x||y}}</td></tr></table>',
    "'''''both''' i'' '''b ''bi'''''": "<p><b><i>both</i></b><i> i</i> <b>b <i>bi</i></b></p>", "''''q''' '''open": "<p>'<b>q</b> <b>open</b></p>", "it's l''x": "<p>it's l<i>x</i></p>",
    "[[File:a.png|thumb|see [[B|b]] and [http://x y]]]": '<p>see <a href="/B">b</a> and <a href="http://x">y</a></p>', "[[Category:Z|k]]x": "<p>x</p>", "[[:Category:Z]]y": '<p><a href="/Category:Z">:Category:Z</a>y</p>',
    "[[A#b c|x]] [[A]]s [[A|]] [[O'B \"q\"]]": '<p><a href="/A#b_c">x</a> <a href="/A">A</a>s <a href="/A">A</a> <a href="/O&#x27;B_%22q%22">O\'B "q"</a></p>',
    "[[open [[X]] ]": '<p>[[open <a href="/X">X</a> ]</p>', "[http://a b [[C]] ] [x]": '<p><a href="http://a">b <a href="/C">C</a> </a> [x]</p>',
    "<nowiki>[[a]] '''b''' {{c}} <</nowiki>": "<p>[[a]] '''b''' &#123;&#123;c}} &lt;</p>", "x<pre>\n* a\n== b ==</pre>": "<p>x<pre>* a== b ==</pre></p>",
    "a<!-- b\n* c -->d<!-- open": "<p>ad</p>", "a<ref name=x>y {{z</ref>b<ref name=x/>c<references/>": "<p>abc</p>", "<ref>open": "<p>open</p>",
    "{{a\n| b = [[C|d]]\n|}} x": '<p>{{a | b = <a href="/C">d</a> |}} x</p>', "{{open [[A]]": '<p>{{open <a href="/A">A</a></p>', "a }} b": "<p>a }} b</p>", "{{a|{{b}}}}": "<p>{{a|{{b}}}}</p>",
    "=== H ''i'' ===\n----\n pre\n__TOC__": "<h3>H <i>i</i></h3><hr><pre>pre</pre>", "a<br>b <span class='x'>c</span>": "<p>a<br>b <span class='x'>c</span></p>",
    "x\n<gallery>\nFile:a|one [[A]]\nFile:b\n</gallery>": '<p>x <p>one <a href="/A">A</a></p></p>',
}


@pytest.mark.parametrize("markup", RENDERED)
def test_rendered(markup):
    assert render(markup).replace("\n", "") == RENDERED[markup]


PIECES = ["[[", "[[a|", "[[a|b]] ", "{{", "{{a|", "}}", "'''", "''x ", "* a\n", "*", "{|\n|a\n", "|}\n", "<ref>", "<nowiki>", "<!--", "[http://x ", "a b c\n", "; a : b\n", "{{a|[[b]]", "]]", "{|\n"]


def test_long_pages_are_rendered_in_linear_time():
    def spent(piece, n):
        begin = time.perf_counter()
        render(piece * (n // len(piece)))
        return time.perf_counter() - begin

    for piece in PIECES:
        assert spent(piece, 400_000) < 12 * max(spent(piece, 100_000), 0.05), piece
