"""Main text of web pages, with site templates removed.

Every element subtree is hashed (tag, class, id, text and children); hashes
are counted per host in Spark over distinct pages, and subtrees that recur on
many pages of their host are deleted.  Parts that are no article by their
own mark-up go as well: menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments.  No text goes merely for its place.

Tags and roles that say so leave a part out.  A class name or id does only if
all its words name such a part (``cookie-notice``, ``adBox2``, not
``share-price``), and not where the part holds most of the text that it could
be: of the main element around it, or of a page that has none (parts named as
comments: all of it).  Outside the main element of a page that has one, names
always count.

All subtrees with text are candidates; equal pages count once.  An article is
not a template because others quote or copy it, so a stricter rule holds for
running text (all but boxes such as ``div``, ``section`` or ``ul``) inside the
main element (``main``, else the ``article`` elements): it must recur
on ``MAIN_PAGES`` pages, and ``MAIN_GROWTH`` times the root of the host's
pages, where pages count by the smallest hash of a word 4-gram in their main
text, and no more than half of its pages may share theirs: near copies of
one article do.

The parser closes elements as browsers do where it matters for text (``p``,
``li``, table parts), ignores end tags without a start, and takes unclosed
comments and scripts to the end of the page.

Defined cases: a NULL or empty page has an empty text; a NULL URL is on the
empty host; repeated pages are each extracted and count once; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkline.llm.common import map_arrow, stored
from perkline.llm.url_filter import host_path

#: a subtree on so many distinct pages of a host, and on this many times the
#: root of their number, is a template
MIN_PAGES = 5
GROWTH = 0.5
#: the same for running text inside the main element, by distinct main texts
MAIN_PAGES = 20
MAIN_GROWTH = 2.0
#: words in a gram of a main text
GRAM = 4
#: sets such subtrees apart from equal ones elsewhere
_RUNNING = 0x5851F42D4C957F2D

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z) | <!\[CDATA\[.*?(?:\]\]>|\Z) | <[!?][^>]*(?:>|\Z)
      | <(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^"'>])*+)>
      | </?[a-zA-Z][^>]*> | [^<]+ | <""",
    re.S | re.X,
)
_ATTR = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+|[^\W\d_]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody "
    "tfoot thead title tr td th caption ul".split()
)
CLOSES_P = BLOCKS - frozenset("body head html tbody tfoot thead title tr td th caption legend".split())
#: start tag -> open elements it ends, and where the search for them stops
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "option": (("option",), ("select",)),
}
#: elements that are no article text
OUT = frozenset(
    "script style noscript template svg math iframe object canvas video audio select button form input textarea nav "
    "footer aside menu dialog head title search map noembed noframes xmp".split()
)
#: words of class names and ids, and roles, of what is no article text
COMMENT_NAMES = frozenset("comment comments disqus respond replies".split())
HEADER_NAMES = frozenset("header masthead".split())
OUT_NAMES = COMMENT_NAMES | HEADER_NAMES | frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar widget widgets ad ads advert adverts "
    "advertisement advertising adsense banner promo promotion sponsor sponsored cookie cookies consent gdpr notice "
    "notices popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended pagination pager copyright toolbar skip".split()
)
#: words that may stand beside them in a name
BESIDE = frozenset(
    "site page global main user reader article post top bottom left right upper lower side primary secondary mobile "
    "desktop js box bar list section area wrapper wrap container inner outer block content panel slot unit item items "
    "form link links button buttons icons group thread module".split()
)
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: inside the main element all others are running text
BOXES = frozenset("div section ul ol dl table details figure".split())
#: never left out for their names, never templates
SPINE = frozenset("html body main article".split())


class Element:
    __slots__ = (
        "tag", "name", "parent", "parts", "hash", "out", "named", "main", "holds_main", "heading", "text", "within", "size"
    )

    def __init__(self, tag: str, name: str, parent: "Element | None"):
        self.tag, self.name, self.parent = tag, name, parent
        self.parts: list[str] = []
        self.hash, self.text = 0, False
        #: characters of its text, without parts that tags and roles leave out
        self.size = 0
        #: words of its names, if they name a part that is no article
        self.named: frozenset[str] = frozenset()
        self.out = self.main = self.holds_main = self.heading = self.within = False

    def close(self) -> None:
        self.hash = xxhash.xxh3_64_intdigest(f"{self.tag}\0{self.name}\0{'\0'.join(self.parts)}") - (1 << 63)
        if self.parent is not None:
            self.parent.parts.append(f"\1{self.hash}")
            self.parent.text |= self.text
            self.parent.size += 0 if self.out else self.size
            self.parent.holds_main |= self.main or self.holds_main
            self.parent.heading |= self.heading or self.tag == "h1"


def _marked_out(attrs: dict[str, str]) -> bool:
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", ""):
        return True
    return attrs.get("role", "").lower() in OUT_ROLES


def _named_out(attrs: dict[str, str]) -> frozenset[str]:
    """Words of the class names and ids that name nothing but a part that is
    no article."""
    found: set[str] = set()
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        words = {w.lower() for w in _PART.findall(name)}
        if not OUT_NAMES.isdisjoint(words) and all(w in OUT_NAMES or w in BESIDE or w.isdigit() for w in words):
            found |= words & OUT_NAMES
    return frozenset(found)


class Page:
    """Elements of one page, and its blocks of text with the elements that
    they lie in."""

    def __init__(self, source: str):
        self.elements: list[Element] = []
        self.blocks: list[tuple[str, Element]] = []
        self._run: list[tuple[str, Element]] = []
        self._root = Element("", "", None)
        self._open = [self._root]
        self._parse(source)
        mains = [e for e in self.elements if e.main]
        top = {id(e) for e in mains if e.tag != "article"} or {id(e) for e in mains}
        #: elements come after their parents
        for e in self.elements:
            e.within = e.parent.within or id(e.parent) in top
        self._top = top
        #: what a named part is compared with where it lies in no main element
        self._size = 0 if top else self._root.size

    def _flush(self) -> None:
        """A block lies in the innermost element that holds all its text."""
        if self._run:
            text = " ".join("".join(t for t, _ in self._run).split())
            if text:
                holders = [e for t, e in self._run if t.strip()]
                at = holders[0]
                if any(e is not at for e in holders):
                    at = self._common(holders)
                self.blocks.append((text, at))
            self._run = []

    @staticmethod
    def _common(holders: list[Element]) -> Element:
        path = []
        e = holders[0]
        while e is not None:
            path.append(e)
            e = e.parent
        place, low = {id(x): n for n, x in enumerate(path)}, 0
        last = None
        for e in holders[1:]:
            if e is last:
                continue
            last = e
            while id(e) not in place:
                e = e.parent
            low = max(low, place[id(e)])
        return path[low]

    def _pop(self) -> None:
        if self._open[-1].tag in BLOCKS:
            self._flush()
        self._open.pop().close()

    def _end(self, tags: tuple[str, ...], stop: tuple[str, ...] = ()) -> None:
        for n in range(len(self._open) - 1, 0, -1):
            if self._open[n].tag in tags:
                while len(self._open) > n:
                    self._pop()
                return
            if self._open[n].tag in stop:
                return

    def _start(self, tag: str, attrs: str) -> None:
        if tag in CLOSES_P:
            self._end(("p",), ("article", "aside", "body", "div", "section", "td", "li", "button"))
        if tag in ENDS:
            self._end(*ENDS[tag])
        if tag in BLOCKS:
            self._flush()
        known, name = {}, ""
        if attrs and not attrs.isspace():
            known = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)}
            name = f"{known.get('class', '')} {known.get('id', '')}"
        if tag in VOID:
            if tag in ("br", "wbr", "hr"):
                self._run.append((" ", self._open[-1]))
            return
        e = Element(tag, name, self._open[-1])
        marked = bool(known) and _marked_out(known)
        if known and tag not in ("html", "body", "main"):
            e.named = _named_out(known)
        e.main = tag == "main" or ((tag == "article" or known.get("role") == "main") and not marked and not e.named)
        e.out = tag in OUT or (marked and tag not in ("html", "body", "main"))
        self.elements.append(e)
        self._open.append(e)

    def _parse(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            m = _TOKEN.match(source, at)
            at = m.end()
            tag = m["tag"]
            if tag is None:
                found = m[0]
                if found[0] != "<" or found == "<":
                    self._text(found)
                elif found.startswith("<![CDATA["):
                    self._text(found[9:].removesuffix("]]>"), plain=True)
                continue
            tag = tag.lower()
            if m["end"]:
                self._end((tag,))
                continue
            self._start(tag, m["attrs"])
            if tag in RAW:
                close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
                self._end((tag,))
                at = close.end() if close else size
        while len(self._open) > 1:
            self._pop()
        self._flush()

    def _text(self, text: str, plain: bool = False) -> None:
        if "&" in text and not plain:
            text = html.unescape(text)
        self._run.append((text, self._open[-1]))
        words = " ".join(text.split())
        if words:
            self._open[-1].parts.append(words)
            self._open[-1].text = True
            self._open[-1].size += len(words)

    def kept(self) -> list[tuple[str, list[int]]]:
        """Blocks in page order that their mark-up does not leave out, each
        with the hashes of the candidates that it lies in."""
        out = []
        for text, e in self.blocks:
            path = []
            while e is not None:
                if self.left_out(e):
                    break
                if self.candidate(e):
                    path.append(self.key(e))
                e = e.parent
            else:
                out.append((text, path))
        return out

    def sketch(self) -> int:
        """Smallest hash of a word gram in the main text."""
        words = " ".join(text for text, e in self.blocks if e.within or id(e) in self._top).split()
        grams = (" ".join(words[i : i + GRAM]) for i in range(max(1, len(words) - GRAM + 1)))
        return min(xxhash.xxh3_64_intdigest(g) for g in grams) - (1 << 63)

    def left_out(self, e: Element) -> bool:
        if e.holds_main:
            return False
        if e.tag == "header":
            return not e.within or self.left_out_by_name(e)
        if e.heading and e.tag not in OUT and not e.within:
            return False
        return e.out or self.left_out_by_name(e)

    def left_out_by_name(self, e: Element) -> bool:
        named = e.named - HEADER_NAMES if e.within else e.named
        if not named:
            return False
        around = self._size
        if e.within:
            at = e.parent
            while id(at) not in self._top:
                at = at.parent
            around = at.size
        return e.size < around if named <= COMMENT_NAMES and around else not around or 2 * e.size <= around

    @staticmethod
    def candidate(e: Element) -> bool:
        return bool(e.tag) and e.tag not in SPINE and not e.main and not e.holds_main and e.text

    @staticmethod
    def running(e: Element) -> bool:
        return e.within and e.tag not in BOXES

    def key(self, e: Element) -> int:
        return e.hash ^ _RUNNING if self.running(e) else e.hash

    def subtrees(self) -> tuple[set[int], set[int]]:
        """Keys of the candidate subtrees with text: all but running text, and
        running text."""
        boxes, texts = set(), set()
        for e in self.elements:
            if self.candidate(e):
                (texts if self.running(e) else boxes).add(self.key(e))
        return boxes, texts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages -> their candidate subtrees, and what a page counts as in running
    text; ``live`` if a kept block lies in it, as it must there."""
    for batch in batches:
        hosts, marks, hashes, live, seen, running = [], [], [], [], [], []
        for host, mark, source in zip(*(batch.column(c).to_pylist() for c in ("host", "mark", "html")), strict=True):
            page = Page(source or "")
            used = {h for _, path in page.kept() for h in path}
            boxes, texts = page.subtrees()
            texts &= used
            sketch = page.sketch() if texts else 0
            for found, strict in ((boxes, False), (texts, True)):
                for h in found:
                    hosts.append(host)
                    marks.append(mark)
                    hashes.append(h)
                    live.append(h in used)
                    seen.append(sketch if strict else None)
                    running.append(strict)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(hosts, pa.string()),
                pa.array(marks, pa.int64()),
                pa.array(hashes, pa.int64()),
                pa.array(live, pa.bool_()),
                pa.array(seen, pa.int64()),
                pa.array(running, pa.bool_()),
            ],
            names=["host", "mark", "hash", "live", "seen", "running"],
        )


_BLOCKS = pa.list_(pa.struct([("text", pa.string()), ("path", pa.list_(pa.int64()))]))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            [{"text": text, "path": path} for text, path in Page(source or "").kept()]
            for source in batch.column("html").to_pylist()
        ]
        own = [batch.column(c) for c in ("page_id", "url", "host", "mark")]
        yield pa.RecordBatch.from_arrays([*own, pa.array(rows, _BLOCKS)], names=["page_id", "url", "host", "mark", "blocks"])


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, growth: float = GROWTH) -> DataFrame:
    """``host, mark, hashes``: for the pages that need it, the template
    subtrees in which kept text lies."""
    found = map_arrow(pages, _counted, "host string, mark bigint, hash bigint, live boolean, seen bigint, running boolean")
    found = stored(found, "html-subtrees")
    size = pages.groupBy("host").agg(F.countDistinct("mark").alias("pages"))
    strict = (F.col("n") >= F.greatest(F.lit(float(MAIN_PAGES)), MAIN_GROWTH * F.sqrt("pages"))) & (2 * F.col("n") >= F.col("on"))
    # rows bound distinct pages from above; few subtrees are left to count
    enough = found.groupBy("host", "hash").agg(F.count("*").alias("n"), F.max("live").alias("live"))
    enough = stored(enough.where((F.col("n") >= min_pages) & F.col("live")).select("host", "hash"), "html-recurring")
    often = (
        found.join(enough, ["host", "hash"], "left_semi")
        .groupBy("host", "hash", "running", "seen", "mark")
        .agg(F.max("live").alias("live"))
        .groupBy("host", "hash", "running", "seen")
        .agg(F.count("*").alias("same"), F.max("live").alias("live"))
        .groupBy("host", "hash", "running")
        .agg(F.count("*").alias("texts"), F.sum("same").alias("on"), F.max("live").alias("live"))
        .withColumn("n", F.when(F.col("running"), F.col("texts")).otherwise(F.col("on")))
        .where((F.col("n") >= min_pages) & F.col("live"))
        .join(size, "host")
        .where(F.when(F.col("running"), strict).otherwise(F.col("n") >= growth * F.sqrt("pages")))
        .select("host", "hash")
    )
    return (
        found.where("live").join(often, ["host", "hash"]).groupBy("host", "mark").agg(F.collect_set("hash").alias("hashes"))
    )


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, growth: float = GROWTH) -> DataFrame:
    """``page_id, url, text`` of each row of ``pages (page_id, url, html)``;
    blocks are parted by an empty line."""
    rows = pages.select("page_id", "url", host_path(F.col("url"))[0].alias("host"), F.xxhash64("html").alias("mark"), "html")
    gone = templates(rows.select("host", "mark", "html"), min_pages, growth)
    schema = T.StructType(rows.select("page_id", "url", "host", "mark").schema.fields)
    schema.add("blocks", T.ArrayType(T.StructType().add("text", "string").add("path", T.ArrayType(T.LongType()))))
    blocks = map_arrow(rows, _blocks, schema).join(gone, ["host", "mark"], "left")
    left = F.filter(
        "blocks", lambda b: F.col("hashes").isNull() | ~F.arrays_overlap(b["path"], F.coalesce("hashes", F.array().cast("array<bigint>")))
    )
    return blocks.select("page_id", "url", F.array_join(F.transform(left, lambda b: b["text"]), "\n\n").alias("text"))
