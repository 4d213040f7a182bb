import html as escapes
import random
import re
from html.parser import HTMLParser

import pytest
from cases import rows

from loadpanel.llm.common import table
from loadpanel.llm.html_text import DEEPEST, extract, main_text

LINE = "Plain running text, with a comma, and enough words to look like a paragraph of an article."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "body, text",
    [
        (f"<nav><a href=x>Home</a></nav><article><h1>T</h1><p>{LINE}</p></article><footer>&copy; us</footer>", f"T\n\n{LINE}"),
        (f"<div class='ad'>{LINE * 5}</div><article><p>Short.</p></article>", "Short."),
        (f"<div id=content><p>{LINE}<p>{LINE}</div><div class='comments'><p>{LINE * 9}</p></div>", f"{LINE}\n\n{LINE}"),
        (f"<section id=comments><article><p>{LINE * 3}</p></article></section><main><p>{LINE}</p></main>", LINE),
        (f"<div class=has-sidebar><div class=post><p>{LINE}</p></div><div class=sidebar><p>{LINE}</p></div></div>", LINE),
        (f"<article><header><h1>Name</h1><p>by line</p></header><p>{LINE}</p><aside>{LINE}</aside></article>", f"Name\n\n{LINE}"),
        (f"<main><div class='article-header'><h1>Name</h1><span>share</span></div><p>{LINE}</p><div class='adsbygoogle'>buy</div></main>", f"Name\n\n{LINE}"),
        (f"<form><input><main><p>{LINE}</p></main><select><option>a<option>b</select></form>", LINE),
        (f"<div><p>{LINE}</p><ul><li><a href=a>one</a><li><a href=b>two</a><li><a href=c>three</a></ul></div>", LINE),
        (f"<article><p>a <!-- {LINE} --> b<br>c &amp; d&nbsp;&#233;&lt;p&gt;</p></article>", "a b c & d é<p>"),
        (f"<article><p>{LINE}<script>if (a < b) '</p>'</script></p><table><tr><td>x<td>y<tr><th>z</table></article>", f"{LINE}\n\nx\n\ny\n\nz"),
        ("<article>direct <b>bold</b>ly<p>one<div>two</div>three</article>", "direct boldly\n\none\n\ntwo\n\nthree"),
        ("<article><p>kept</p></article><p>cut off <a hre", "kept\n\ncut off"[:4]),
        ("<article><p>1 < 2 and 3 > 2 &am", "1 < 2 and 3 > 2 &am"),
        ("<nav><a href=x>only a menu</a></nav><footer>and a footer</footer>", ""),
        ("<article><a href=x>only a link</a></article>", "only a link"),
        ("<div role=alert>We use cookies, yes, we do.</div><div role=main><p>Text.</p></div>", "Text."),
    ],
)
def test_article_without_its_surroundings(body, text):
    assert main_text(page(body)) == text


def test_sections_of_an_article_stay_together():
    parts = [f"<section><h2>Part {i}</h2><p>{LINE}</p></section>" for i in range(4)]
    want = "\n\n".join(f"Part {i}\n\n{LINE}" for i in range(4))
    assert main_text(page(f"<div>{''.join(parts)}</div><div class=related>{parts[0] * 9}</div>")) == want
    beside = f"<div><p>{LINE * 4}</p></div><div><p>{LINE * 2}</p></div><div><a href=x>{LINE}</a></div>"
    assert main_text(page(beside)) == f"{LINE * 4}\n\n{LINE * 2}"


class _Direct(HTMLParser):
    """Blocks of ``article`` by another parser: for pages of p, h1, b, br, div, section and entities."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.held = 0, [], []

    def cut(self):
        if text := " ".join("".join(self.held).split()):
            self.blocks.append(text)
        self.held = []

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.held.append(" ")
        elif tag not in ("b", "i"):
            self.cut()
        self.inside += tag == "article"

    def handle_endtag(self, tag):
        if tag not in ("b", "i"):
            self.cut()
        self.inside -= tag == "article"

    def handle_data(self, data):
        if self.inside:
            self.held.append(data)


def test_made_pages_against_another_parser():
    rng = random.Random(5)
    for _ in range(300):
        def words():
            return escapes.escape(" ".join(rng.choice(("tree", "a&b", "<x>", "über", "red,", '"q"', "end.")) for _ in range(rng.randint(1, 30))))

        article = "".join(
            rng.choice(("<p>{}</p>", "<p><b>{}</b>", "<p>{}<br>", "<section><p>{}</p></section>", "<h2>{}</h2>", "<div>{}</div>")).format(words())
            for _ in range(rng.randint(1, 12))
        )
        whole = f"<nav><ul><li><a href=/>{words()}</a></ul></nav><div class=ad>{words()}</div><article>{article}</article><footer>{words()}</footer>"
        direct = _Direct()
        direct.feed(whole)
        direct.close()
        assert main_text(page(whole)) == "\n\n".join(direct.blocks)


def test_every_page_of_the_table(spark, sf_dir):
    """These pages have one article of headings and paragraphs, which a regular expression can read."""
    got = {r["page_id"]: r for r in extract(table(spark, sf_dir, "pages")).collect()}
    for r in table(spark, sf_dir, "pages").collect():
        inside = re.search(r"<article>(.*?)(?:</article>|<footer|$)", r["html"] or "", re.S)
        blocks = re.split(r"</?(?:p|h1)>", inside[1] if inside else "")
        plain = [" ".join(escapes.unescape(re.sub(r"<[^>]*(?:>|$)", "", b)).split()) for b in blocks]
        want = "\n\n".join(b for b in plain if b)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"]) == (want, len(want))


def test_awkward_rows_and_no_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string, size int"
    deep = "<div>" * 20_000 + f"<p>{LINE}</p>"
    long = "<article>" + f"<p>{LINE}</p>" * 20_000 + "</article>"
    table = [(1, "u", None), (2, None, ""), (3, "u", "no markup"), (3, "u", "no markup"), (None, "u", "<<<>>><!-- <"), (4, "u", deep), (5, "u", long)]
    frame = spark.createDataFrame([(*r, None, "x", 0) for r in table], schema)
    got = extract(frame)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    want = ["", "", "no markup", "no markup", "<<<>>>", LINE, "\n\n".join([LINE] * 20_000)]
    assert rows(got) == sorted([(p, u, t, len(t)) for (p, u, _), t in zip(table, want)], key=lambda r: [(v is not None, str(v)) for v in r])
    assert rows(extract(frame.limit(0))) == []
    assert DEEPEST < 20_000
