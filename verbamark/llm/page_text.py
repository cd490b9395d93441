"""Main text of web pages: site templates are found by counting element subtrees per host.

Every page is read into text blocks and the hashes of the element subtrees
around them. A subtree that recurs on many pages of its host, beside different
articles, is part of the site's template. Spark counts the hashes per host and
drops the blocks inside such subtrees, within the article as well as around
it. Elements whose tag, role or whole class name says what they are (menus,
footers, adverts, forms, comments) go while reading, unless they hold the
article.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbamark.session import stage

MIN_PAGES = 3
# of a host's different articles, so many must share a subtree of the article itself; one around it needs far fewer
OWN_SHARE = 0.5
MAX_DEPTH = 512  # elements nested deeper are taken as children of the last one, as browsers do

# fixed names of HTML
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
             "sub sup time tt u var wbr img".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}}
HOLDERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
           "option": {"select"}}
DROPPED = set("head script style noscript template iframe object svg math canvas audio video nav footer aside form button select "
              "textarea dialog menu".split())
DROPPED_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
DROPPED_NAMES = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr "
                    "notice popup modal overlay newsletter subscribe signup sidebar menu nav navbar navigation breadcrumb breadcrumbs "
                    "footer share sharing social related recommended comment comments commentlist respond reply replies disqus "
                    "pagination pager widget toolbar skip login".split())
# what a text is written in; anything else is a box
WRITTEN = set("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote figcaption".split()) | INLINE
CONTENT_NAMES = set("article content entry post story main".split())
UNFINISHED = re.compile(r"<[A-Za-z/!?][^<>]*\Z")


class _Reader(HTMLParser):
    """Blocks of one page, each with its element, and for every element its parent, hash and kind."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.names, self.parts, self.digest, self.region = [], [], [], [], [], []
        self.place: list[str] = []
        self.hard, self.soft, self.holds = [], [], []  # dropped whatever it holds; unless it holds the article; does so
        self.stack: list[int] = []
        self.dropped = 0
        self.text: list[str] = []
        self.linked: list[bool] = []
        self.blocks: list[tuple[str, int]] = []
        self.plain: list[bool] = []

    def _flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text and self.stack:
            self.blocks.append((text, self.stack[-1]))
            self.parts[self.stack[-1]].append(text)
            if not all(linked for part, linked in zip(self.text, self.linked) if part.strip()):
                self.plain[self.stack[-1]] = True
        self.text.clear()
        self.linked.clear()

    def _open(self, tag: str, attributes: dict[str, str]) -> None:
        up = self.stack[-1] if self.stack else -1
        inside = self.region[up] if up >= 0 else 0
        names = set(f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split())
        style = attributes.get("style", "").replace(" ", "").lower()
        role = attributes.get("role", "").lower()
        hard = tag in DROPPED or "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in style
        soft = (tag not in ("html", "body", "main", "article") and bool(names & DROPPED_NAMES) or role in DROPPED_ROLES
                or tag == "header" and inside < 2)
        own = 3 if tag == "article" else 2 if tag == "main" or role == "main" else 1 if names & CONTENT_NAMES and tag != "body" else 0
        self.dropped += hard
        if own >= 2:
            for at in self.stack:
                self.holds[at] = True
        self.stack.append(len(self.parent))
        self.parent.append(up)
        self.place.append(f"{self.place[up] if up >= 0 else ''}/{tag}.{attributes.get('class', '')}"[-200:])
        self.tag.append(tag)
        self.names.append(attributes.get("class", ""))
        self.parts.append([])
        self.digest.append(0)
        self.hard.append(hard)
        self.soft.append(soft)
        self.holds.append(own >= 2)
        self.region.append(max(inside, own))
        self.plain.append(False)

    def _close(self) -> None:
        at = self.stack.pop()
        self.dropped -= self.hard[at]
        self.digest[at] = xxhash.xxh64_intdigest(f"{self.tag[at]}\x1f{self.names[at]}\x1f" + "\x1f".join(self.parts[at]))
        if self.stack and self.parts[at]:
            self.parts[self.stack[-1]].append(str(self.digest[at]))
            self.plain[self.stack[-1]] |= self.plain[at]
        self.parts[at] = self.parts[at][:1]

    def _close_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            self._close()

    def handle_starttag(self, tag: str, attributes: list) -> None:
        if tag not in INLINE:
            self._flush()
        if tag in VOID:
            return
        if tag not in INLINE:
            for k in range(len(self.stack) - 1, -1, -1):
                name = self.tag[self.stack[k]]
                if name in CLOSED_BY.get(tag, {"p"}) or name == "p":
                    self._close_to(k)
                elif name in HOLDERS.get(tag, ()) or name not in INLINE and tag not in HOLDERS:
                    break
        if len(self.stack) >= MAX_DEPTH:
            self._flush()
            self._close()
        self._open(tag, {k: v or "" for k, v in attributes})

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self._flush()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.tag[self.stack[k]] == tag:
                self._flush() if tag not in INLINE else None
                self._close_to(k)
                return
            if tag in INLINE and self.tag[self.stack[k]] not in INLINE:
                return

    def handle_data(self, data: str) -> None:
        if not self.dropped:
            if not self.stack:
                self._open("body", {})
            self.text.append(data)
            self.linked.append(any(self.tag[k] == "a" for k in self.stack[-4:]))

    def finish(self) -> None:
        self.close()
        self._flush()
        self._close_to(0)


def read_page(html: str) -> tuple[list[tuple[str, list[int]]], list[int], list[int]]:
    """The blocks of a page's main region with the hashes of the subtrees they lie in, and all such hashes, those of
    the article's own text apart from the others.

    The region is the page's ``article`` elements, else its ``main`` element,
    else elements called content, else everything. The article's own are the
    subtrees in it that hold text that is no link; their hashes count with the
    place they stand in. What text is written in, such as a paragraph, is no
    template by itself there, nor is it on a page without such elements.
    """
    reader = _Reader()
    reader.feed(UNFINISHED.sub("", html))
    reader.finish()
    gone = []
    for at, up in enumerate(reader.parent):
        gone.append(up >= 0 and gone[up] or reader.soft[at] and not reader.holds[at])
    blocks = [(text, at) for text, at in reader.blocks if not gone[at]]
    best = max((reader.region[at] for _, at in blocks), default=0)
    found, own_marks, other_marks = [], set(), set()
    for text, at in blocks:
        marks = []
        up = at
        while up >= 0:
            tag = reader.tag[up]
            if tag not in ("html", "body", "main", "article"):
                inside = reader.region[up] >= 2 if best >= 2 else tag in WRITTEN
                if inside and reader.plain[up]:
                    if tag in WRITTEN:  # a passage may recur in articles, too
                        up = reader.parent[up]
                        continue
                    # with the names of the elements down to it, as a box stands in one place and a quotation anywhere
                    mark = xxhash.xxh64_intdigest(f"{reader.digest[up]}\x1f{reader.place[up]}") - (1 << 63)
                    own_marks.add(mark)
                else:
                    mark = reader.digest[up] - (1 << 63)
                    other_marks.add(mark)
                marks.append(mark)
            up = reader.parent[up]
        if reader.region[at] == best:
            found.append((text, marks))
    return found, sorted(own_marks - other_marks), sorted(other_marks)


def main_text(pages: DataFrame, html: str = "html", url: str = "url", page_id: str = "page_id") -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per row of ``pages``.

    Character references are decoded, white space inside a block becomes one
    space, blocks are joined by one space in page order. A subtree is template
    if ``MIN_PAGES`` different articles of its host stand beside it and
    ``OWN_SHARE`` of them do; around the article ``MIN_PAGES`` and one more for
    every doubling of their number are enough, while in the article's own text
    it must be in the same place. Copies of a page count
    once, so they can't turn their own article into template. Null html gives
    the empty text, a null url belongs to a host without a name. A tag that is
    cut off at the end is left out. Other columns are not read. Pages are read
    twice, once for the hashes and once for the text, so that no text is
    written in between.
    """
    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in batches:
            own, others, articles = [], [], []
            for value in batch.column(2).to_pylist():
                found, own_marks, other_marks = read_page(value or "")
                own.append(own_marks)
                others.append(other_marks)
                articles.append(xxhash.xxh64_intdigest("\x1f".join(t for t, _ in found)) - (1 << 63))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, kind), pa.array(others, kind),
                                              pa.array(articles, pa.int64())], ["page", "host", "own", "others", "article"])

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value, template in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                gone = set(template or ())
                texts.append(" ".join(t for t, marks in read_page(value or "")[0] if gone.isdisjoint(marks)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    key = rows.schema["page_id"].dataType.simpleString()
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    # equal pages share a name, as they share their template
    named = rows.withColumn("page", F.unhex(F.md5(F.concat_ws("\0", host, F.coalesce("html", F.lit(""))))))
    seen = stage(named.select("page", host.alias("host"), "html").mapInArrow(
        marked, "page binary, host string, own array<bigint>, others array<bigint>, article long"), "page-marks")
    articles = seen.select("host", "article").distinct().groupBy("host").agg(F.count("*").alias("articles"))

    def of(column: str, own: bool) -> DataFrame:
        return seen.select("page", "host", "article", F.explode(column).alias("mark"), F.lit(own).alias("own"))

    marks = of("own", True).unionByName(of("others", False))
    share, slow = OWN_SHARE * F.col("articles"), MIN_PAGES + F.floor(F.log2(F.col("articles")))
    enough = F.when(F.col("own"), share).otherwise(F.least(share, slow))
    # a mark on many pages is counted once per task and article before it is shuffled
    template = stage(marks.select("host", "mark", "own", "article").distinct().groupBy("host", "mark", "own")
                     .agg(F.count("*").alias("n")).where(F.col("n") >= MIN_PAGES).join(articles, "host")
                     .where(F.col("n") >= enough).select("host", "mark", "own"), "templates")
    hits = (marks.select("page", "host", "mark", "own").join(template, ["host", "mark", "own"]).groupBy("page")
            .agg(F.collect_set("mark").alias("template")))
    return (named.join(hits, "page", "left").select("page_id", "url", "html", "template")
            .mapInArrow(written, f"page_id {key}, url string, text string")
            .withColumn("n_chars", F.length("text").cast("long")))
