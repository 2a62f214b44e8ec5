"""Main text of web pages by two passes of block rules: stop-word density, length and link density decide on clear blocks; short blocks that stay open take the label of the nearest decided neighbours."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from textmill.llm.common import prepare

#: Elements whose whole content is left out.
SKIPPED = frozenset("script style noscript template svg iframe object canvas head nav header footer aside form button select textarea menu dialog title video audio".split())
#: Elements that never have an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block.
BLOCKS = frozenset("address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html legend li main ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
#: Words in class, id or role that mark furniture.
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|popup|modal|overlay|newsletter|subscribe|subscription|paywall|nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|sidebar|side-bar|widget|related|recommend\w*|share|sharing|social|footer|header|masthead|topbar|toolbar|comments?|commentlist|respond|replies|disqus|copyright|legal|disclaimer|login|signup|search|tags?|skip-link|complementary|contentinfo)(?:$|[\s_-])",
    re.I,
)
#: The same inside an article: adverts, notices, menus, side parts, sign-ups and comments alone. Other names may be those of its own text.
FURNITURE_INSIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|popup|modal|overlay|newsletter|subscribe|subscription|paywall|nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|sidebar|side-bar|footer|comments?|commentlist|respond|replies|disqus)(?:$|[\s_-])",
    re.I,
)
#: Elements that hold the page's own text; what furniture-like names they bear is ignored.
OWN = frozenset("html body main article".split())
STOP_WORDS = frozenset(
    # fixed values: frequent words of English, French, German and Spanish
    "the of and to in is that it for was on are as with be by at this from or an have not they which you his her their has had but were we been will would can there what all if more when who its than so about into out up them then these some could he she i a "
    "le la les de des du un une et est en que qui dans pour pas sur au aux avec ce se il elle ne plus par son sa ses sont ou mais comme on nous vous cette ces leur été être à "
    "der die das und ist in den von zu mit dem des auf für nicht ein eine einen einer im sich auch es an als am wird bei aus er sie nach wie dass oder war haben hat noch nur über vor zum zur "
    "el los las y que en un una es por con no su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante ni contra otros ese eso ante ellos esto".split()
)
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(/?)(?:>|\Z)", re.S)
NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
SPACE = re.compile(r"\s+")
RAW = {x: re.compile(rf"</{x}\b[^>]*>", re.I) for x in ("script", "style", "textarea", "title", "noscript", "iframe")}
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())


#: Elements that end an open one of the same name, if it is the innermost block.
SIBLINGS = frozenset("li td th tr dd dt option".split())


class _Page:
    """The open elements of a page while it is read; every step costs no more than the elements that it closes."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, bool]] = []  # open elements, and whether their content is left out
        self.open: dict[str, int] = {}  # how many of each name are open
        self.scopes: list[list] = [["", False]]  # open block elements but p, and whether a p is open right in them
        self.skip = self.own = self.anchors = 0
        self.out: list[tuple[str, int, bool, bool]] = []
        self.parts: list[tuple[str, bool]] = []
        self.heading = False

    def push(self, name: str, hides: bool) -> None:
        self.stack.append((name, hides))
        self.open[name] = self.open.get(name, 0) + 1
        if name == "p":
            self.scopes[-1][1] = True
        elif name in BLOCKS:
            self.scopes.append([name, False])
        self.skip += hides
        self.own += name in ("article", "main")
        self.anchors += name == "a"

    def pop_to(self, name: str) -> None:
        """Closes the innermost element of the name, and what was left open inside."""
        while True:
            x, hides = self.stack.pop()
            self.open[x] -= 1
            if x == "p":
                self.scopes[-1][1] = False
            elif x in BLOCKS:
                self.scopes.pop()
            self.skip -= hides
            self.own -= x in ("article", "main")
            self.anchors -= x == "a"
            if x == name:
                return

    def text(self, piece: str) -> None:
        if not self.skip:
            self.parts.append((piece, self.anchors > 0))

    def close_block(self) -> None:
        if self.parts:
            body = SPACE.sub(" ", unescape("".join(p for p, _ in self.parts))).strip()
            if body:
                linked = sum(len(SPACE.sub(" ", unescape(p)).strip()) for p, link in self.parts if link)
                self.out.append((body, linked, self.heading, self.own > 0))
            self.parts = []
        self.heading = False

    def end(self, name: str) -> None:
        if not self.open.get(name):
            if name == "p":
                self.close_block()
            return
        if name in BLOCKS or name in SKIPPED:
            self.close_block()
        self.pop_to(name)

    def start(self, name: str, attributes: str, empty: bool) -> None:
        if name in BLOCKS or name in SKIPPED:
            self.close_block()
            if name == "p" and self.scopes[-1][1] or name in SIBLINGS and self.scopes[-1][0] == name:
                self.pop_to(name)
            self.heading = name in HEADING and not self.skip
        if name == "br":
            self.text(" ")
        if name in VOID or empty:
            return
        hides = name in SKIPPED and not (name == "header" and self.own)  # an article's own header bears its title
        if not hides and name not in OWN and name != "header" and attributes:
            names = FURNITURE_INSIDE if self.own else FURNITURE
            hides = any(names.search(a or b or c) for a, b, c in NAMED.findall(attributes)) or bool(HIDDEN.search(attributes))
        self.push(name, hides)


def blocks(html: str) -> list[tuple[str, int, bool, bool]]:
    """(text, characters in links, heading, inside article or main) of each block of a page, in order, without what is skipped."""
    page, at, n = _Page(), 0, len(html)
    while at < n:
        m = TAG.search(html, at)
        end = m.start() if m else n
        if end > at:
            page.text(html[at:end])
        if not m:
            break
        at = m.end()
        name = m[3]
        if name is None:
            if m[1]:
                page.text(m[1].replace("&", "&amp;"))
            continue
        name = name.lower()
        if m[2]:
            page.end(name)
        elif name in RAW:
            if name in BLOCKS or name in SKIPPED:
                page.close_block()
            end = RAW[name].search(html, at)
            at = end.end() if end else n
        else:
            page.start(name, m[4] or "", bool(m[5]))
    page.close_block()
    return page.out


def classify(found: list[tuple[str, int, bool, bool]], *, max_links: float = 0.33, short: int = 70, long: int = 200, low: float = 0.15, high: float = 0.3) -> list[bool]:
    """Whether each block is main text. First pass: many links: bad; short: open; else by stop-word density and length good, nearly good or bad. Second pass: open and nearly good blocks take the label of the nearest decided block on either side, good if the two differ and the block is nearly good, or one of them is missing. Being inside an article or main element is one feature: blocks there are nearly good instead of open or bad for want of stop words, links weigh less (there a short block of nothing but a link is bad only beside another one, as in a menu), and only decided blocks of the same stretch inside are their neighbours."""
    labels: list[str] = []
    item = [own and linked > 0.8 * len(body) and body.count(" ") < 3 for body, linked, _, own in found]
    for i, (body, linked, heading, own) in enumerate(found):
        words = body.lower().split()
        density = sum(w.strip(".,;:!?") in STOP_WORDS for w in words) / len(words)
        menu = item[i] and (i > 0 and item[i - 1] or i + 1 < len(item) and item[i + 1])
        if menu or linked > max_links * len(body) and not own:
            label = "bad"
        elif len(body) < short:
            label = "near" if own else "open"
        elif density >= high or density >= low and len(body) > long:
            label = "good"
        elif density >= low or own or heading:
            label = "near"
        else:
            label = "bad"
        labels.append(label)
    n = len(labels)
    sides: list[set[str]] = [set() for _ in labels]
    for order in (range(n), range(n - 1, -1, -1)):
        last = inner = ""
        was = False
        for i in order:
            if found[i][3] != was:
                was, inner = found[i][3], ""
            sides[i] |= {inner if was else last} - {""}
            if labels[i] in ("good", "bad"):
                last = inner = labels[i]
    keep = []
    for i, label in enumerate(labels):
        if label == "near":
            keep.append(sides[i] != {"bad"})
        elif label == "open":
            keep.append(sides[i] == {"good"})
        else:
            keep.append(label == "good")
    return keep


def extract(html: str | None) -> str:
    found = blocks(html or "")
    return "\n".join(b[0] for b, keep in zip(found, classify(found), strict=True) if keep)


def extract_main_text(pages: DataFrame, *, html: str = "html", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row a page: page_id, url, text, n_chars (code points).

    Null and empty pages and pages without main text give an empty string. Broken markup ends with the page; elements left open end with the element around them, and end tags without a start are passed over, in time that grows with the page's length alone. Pages are judged alone, whole, however long; repeated rows and ids give repeated results, null ids and urls stay null, an empty table gives none; other columns of pages, whatever their names, are not read.
    """
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.selectExpr(f"cast(`{page_id}` as bigint) as page_id", f"cast(`{url}` as string) as url", f"cast(`{html}` as string) as html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
