"""Labelled pages for the extraction model: drawn from a grammar of common page layouts."""

from __future__ import annotations

import random
from collections.abc import Iterator
from html import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.frames import by_batch, ship

# Names that page authors give to the parts of a page.
CONTENT_NAMES = "article content main post entry story body text article-body post-content entry-content main-content page-content".split()
NEUTRAL_NAMES = "container wrapper row col page site layout inner grid box clearfix section block".split()
REST_NAMES = {
    "nav": "nav navbar menu navigation main-menu breadcrumb breadcrumbs topbar pagination toc".split(),
    "head": "header site-header masthead banner logo branding top".split(),
    "foot": "footer site-footer copyright legal bottom colophon".split(),
    "side": "sidebar side widget related recommended popular trending tags author-bio promo teaser more".split(),
    "ad": "ad ads advert advertisement sponsored ad-slot adsbygoogle banner-ad".split(),
    "notice": "cookie cookie-notice consent gdpr notice alert popup modal newsletter subscribe overlay paywall".split(),
    "form": "form search login signup contact-form search-box".split(),
    "comments": "comments comment-list comment reply discussion responses disqus replies".split(),
    "share": "share social social-share buttons toolbar tools meta byline".split(),
}
TAGS = {
    "nav": ["nav", "div", "ul"], "head": ["header", "div"], "foot": ["footer", "div"], "side": ["aside", "div", "section"],
    "ad": ["div", "aside", "section"], "notice": ["div", "section", "dialog"], "form": ["form", "div"],
    "comments": ["section", "div", "ol"], "share": ["div", "ul", "p"],
}
SYLLABLES = "ka lo mi ten ra su vel dor an is pe tur ga lin mo sche ue é ção ñe über та ни ко".split()


class Writer:
    def __init__(self, seed: int):
        self.random = random.Random(seed)
        self.lines: list[str] = []

    def maybe(self, share: float) -> bool:
        return self.random.random() < share

    def pick(self, options: list[str]) -> str:
        return self.random.choice(options)

    def words(self, count: int) -> str:
        return " ".join("".join(self.pick(SYLLABLES) for _ in range(self.random.randint(1, 4))) for _ in range(count))

    def sentence(self, low: int = 3, high: int = 25) -> str:
        text = self.words(self.random.randint(low, high)).capitalize()
        return text + self.pick([".", ".", ".", "!", "?", "", " &", " %%%", " ###"])

    def prose(self) -> str:
        return " ".join(self.sentence() for _ in range(self.random.choice([1, 1, 1, 2, 3, 5, 9])))

    def named(self, names: list[str], share: float = 0.8) -> str:
        if not self.maybe(share):
            return ""
        return f' {self.pick(["class", "class", "id"])}="{self.pick(names)}{self.pick(["", "", " " + self.pick(NEUTRAL_NAMES)])}"'

    def marked(self, text: str, content: bool) -> str:
        """Escaped text, noted as a line if it is content."""
        if content:
            self.lines.append(" ".join(text.split()))
        out = escape(text, quote=False)
        if self.maybe(0.3) and " " in out:
            head, tail = out.split(" ", 1)
            tag = self.pick(["b", "i", "em", "strong", "span", 'a href="/x"'])
            out = f"<{tag}>{head}</{tag.split()[0]}> {tail}"
        return out

    def block(self, tag: str, text: str, content: bool) -> str:
        inner = self.marked(text, content)
        if tag in ("p", "li") and self.maybe(0.15):
            return f"<{tag}>{inner}"
        if tag == "p" and self.maybe(0.12):
            return f"<p><b>{inner}<br>"
        return f"<{tag}>{inner}</{tag}>"

    def links(self, count: int, content: bool = False) -> str:
        items = [f'<li><a href="/{i}">{self.marked(self.words(self.random.randint(1, 5)), content)}</a>' for i in range(count)]
        return f"<ul>{'</li>'.join(items)}</li></ul>"

    def part(self, kind: str) -> str:
        """A part of the page that is not content."""
        names = REST_NAMES[kind]
        tag = self.pick(TAGS[kind])
        attributes = self.named(names, 1.0 if tag in ("div", "section", "ul", "p", "ol") else 0.5)
        if kind in ("nav", "share") or kind in ("side", "foot", "head") and self.maybe(0.5):
            inner = self.links(self.random.randint(2, 9))
            if kind in ("side", "foot") and self.maybe(0.6):
                inner = self.block(self.pick(["h3", "h4", "p"]), self.words(3), False) + inner
        elif kind == "form":
            inner = f'<label>{self.words(2)}</label><input name="q"><select><option>{self.words(1)}<option>{self.words(1)}</select><button>{self.words(1)}</button>'
            inner = self.pick(["", self.block("p", self.sentence(), False)]) + inner
            inner = inner if tag == "form" else f"<form>{inner}</form>"
        elif kind == "comments":
            inner = self.block("h3", self.words(2), False) + "".join(
                f'<{t}{self.named(["comment", "reply", "comment-body"])}>{self.block("p", self.prose(), False)}</{t}>'
                for t in [self.pick(["div", "li", "article"])] * self.random.randint(1, 5)
            )
        elif kind == "foot":
            inner = f"&copy; {self.words(2)} &middot; {escape(self.sentence())}"
            inner = self.pick([inner, f"<p>{inner}</p>"])
        elif kind == "notice":
            inner = self.block("p", self.prose(), False) + f"<button>{self.words(1)}</button>"
        else:
            inner = self.pick([self.marked(self.sentence(), False), self.block("p", self.prose(), False)])
        return f"<{tag}{attributes}>{inner}</{tag}>"

    def story(self) -> str:
        out = []
        if self.maybe(0.85):
            out.append(self.block("h1", self.sentence(2, 12), True))
        for _ in range(self.random.choice([1, 2, 4, 8, 14])):
            kind = self.random.random()
            if kind < 0.75:
                out.append(self.block("p", self.prose(), True))
            elif kind < 0.83:
                out.append(self.block(self.pick(["h2", "h3"]), self.words(self.random.randint(1, 6)), True))
            elif kind < 0.88:
                items = "".join(self.block("li", self.sentence(), True) for _ in range(self.random.randint(1, 5)))
                list_tag = self.pick(["ul", "ol"])
                out.append(f"<{list_tag}>{items}</{list_tag}>")
            elif kind < 0.91:
                out.append(f"<blockquote>{self.block('p', self.prose(), True)}</blockquote>")
            elif kind < 0.93:
                cells = "".join(self.block("td", self.words(2), True) for _ in range(3))
                out.append(f"<table><tr>{cells}</tr></table>")
            elif kind < 0.95:
                out.append(f"<figure><img src='a.png'>{self.block('figcaption', self.sentence(), True)}</figure>")
            elif kind < 0.96:
                out.append(f"<pre>{self.marked(self.words(6), True)}</pre>")
            else:
                out.append(self.part(self.pick(["ad", "share", "side", "form", "notice"])))
        return "".join(out)

    def page(self) -> tuple[str, str]:
        tag = self.pick(["article", "article", "main", "div", "section", "td", "none"])
        above = [self.part(k) for k in ("head", "nav", "notice", "ad", "form", "side") if self.maybe(0.45)]
        story = self.story()
        if self.maybe(0.2):
            story += self.part("comments")
        if tag == "td":
            story = f"<table><tr><td{self.named(REST_NAMES['side'])}>{self.links(4)}</td><td{self.named(CONTENT_NAMES)}>{story}</td></tr></table>"
        elif tag != "none":
            named = self.named(CONTENT_NAMES, 1.0 if tag in ("div", "section") else 0.4)
            story = f"<{tag}{named}>{story}</{tag}>"
        below = [self.part(k) for k in ("share", "side", "ad", "comments", "form", "nav") if self.maybe(0.3)]
        if self.maybe(0.8):
            below.append(self.part("foot"))
        body = "".join(above) + story + "".join(below)
        for _ in range(self.random.choice([0, 0, 0, 1, 2])):
            body = f"<div{self.named(NEUTRAL_NAMES)}>{body}</div>"
        head = f"<head><title>{self.words(4)}</title><style>p{{margin:0}}</style><script>var a = '</p>';</script></head>"
        closing = self.pick(["</body></html>", ""])
        return f"<!DOCTYPE html><html>{head}<body><!-- {self.words(2)} -->{body}{closing}", "\n".join(self.lines)


def labelled_pages(spark: SparkSession, count: int, seed: int = 1) -> DataFrame:
    """``html`` and ``text`` (the main text's blocks, joined by line ends) of ``count`` pages."""
    ship(spark)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        drawn = [Writer(seed * 1_000_003 + i).page() for i in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in drawn]), pa.array([t for _, t in drawn])], names=["html", "text"])

    return by_batch(spark.range(0, count, 1, 6).select(F.col("id")), work, "html string, text string")
