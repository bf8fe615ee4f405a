"""Main text of web pages by two-pass block rules.

A page is cut into blocks at its block elements. The first pass labels every block by where
it stands and by its length, the share of its characters in links and the share of stop
words among its words: good, bad, or ambiguous, as short blocks are. In the second pass an
ambiguous block takes the label of the nearest decided blocks before and behind it. Where a
page marks its article, blocks outside of it are bad and those inside are good unless they
are mostly links or stand in an element named after menus, adverts or comments.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from siltbed.llm.words import slices

#: A comment, a declaration, a tag with its attributes, or a tag that never ends.
MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'=]|=\s*"[^"]*"|=\s*'[^']*'|[="'])*+)>|<[a-zA-Z/][^>]*\Z""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
HIDDEN = re.compile(r"display\s*:\s*none", re.IGNORECASE)

#: Elements whose content is text that is no markup.
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
#: Elements whose content never shows as text.
UNSEEN = frozenset("head template select datalist button object canvas audio video svg math map noscript".split())
#: Elements that stand for something other than the article.
ASIDE = frozenset("nav aside footer form menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | ASIDE | frozenset(
    "address article blockquote body caption center dd details dir div dl dt fieldset figcaption figure header hgroup "
    "hr html legend li main ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: An element that starts closes an open one of the first kinds unless one of the second lies between.
ENDS = {
    **{tag: (frozenset(["p"]), BLOCKS - {"p"}) for tag in BLOCKS},
    "li": (frozenset(["li", "p"]), frozenset(["ul", "ol", "menu", "dir", "div", "td"])),
    "dt": (frozenset(["dt", "dd", "p"]), frozenset(["dl", "div", "td"])),
    "dd": (frozenset(["dt", "dd", "p"]), frozenset(["dl", "div", "td"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
}
#: Words in names of classes, ids and roles of what is not the article.
NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies copyright disqus footer gdpr masthead menu modal nav navbar navigation newsletter "
    "notice notices outbrain paywall popup promo related reply respond search share sharing sidebar signup skip "
    "social sponsor sponsored subscribe taboola teaser toolbar widget".split()
)
#: The same at the top of a page only: an article may have a header with its heading.
PAGE_NAMES = frozenset(["header"])
WHOLE_PAGE = frozenset(["html", "body", "main"])
#: Classes that say what an element has, not what it is.
ABOUT = ("has-", "with-", "no-", "without-", "is-")
NAME_WORD = re.compile(r"[a-z]+")
#: Elements nested deeper than this are read as if they were not there, as browsers do.
DEEPEST = 512

#: Frequent words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    (
        "a an and are as at be been but by can do for from had has have he her his if in is it its not of on or "
        "she so than that the their they this to was we were what when which who will with you "
        "aber als am auch auf aus bei bin bis das dass dem den der des die ein eine einem einen einer er es für "
        "hat ich im ist mit nach nicht noch nur oder sein sich sie sind so um und uns von vor war wie wir zu zum zur "
        "au aux avec ce ces dans de des du elle en est et il je la le les leur mais ne nous on ou par pas plus pour "
        "que qui sa se ses son sont sur un une vous "
        "al como con del el ella es está este esta fue ha hay lo los las más me mi muy no para pero por se si sin "
        "sobre su sus también un una y ya"
    ).split()
)
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Rules:
    """Lengths in characters; densities as shares of characters (links) or words (stop words)."""

    link_density: float = 0.2
    short: int = 70
    long: int = 200
    stop_low: float = 0.30
    stop_high: float = 0.32
    heading_reach: int = 200


@dataclass
class Block:
    """Text of a block; ``aside`` if an element around it is not the article, ``article`` if one is."""

    heading: bool
    aside: bool
    article: bool
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    text: str = ""


def _joined(parts: list[str]) -> str:
    return " ".join(references.unescape("".join(parts)).split())


def _named_aside(tag: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """Whether names of the element say that it is not the article, and whether it is hidden."""
    aside = hidden = False
    for kind, double, single, bare in ATTRIBUTE.findall(attributes):
        kind, value = kind.lower(), double or single or bare
        if kind == "hidden":
            hidden = True
        elif kind == "aria-hidden":
            hidden = hidden or value.strip().lower() == "true"
        elif kind == "style":
            hidden = hidden or bool(HIDDEN.search(value))
        elif tag not in WHOLE_PAGE:
            for name in value.lower().split():
                words = () if name.startswith(ABOUT) else NAME_WORD.findall(name)
                aside = aside or any(w in NAMES or (not inside and w in PAGE_NAMES) for w in words)
    return aside, hidden


class Page:
    """Reads a page into blocks."""

    def __init__(self, page: str):
        self.blocks: list[Block] = []
        #: Open elements: tag, aside, article, unseen.
        self.open: list[tuple[str, bool, bool, bool]] = [("", False, False, False)]
        self.count: Counter[str] = Counter()
        self.block: Block | None = None
        self.link = False
        self.breaks = 0
        at = 0
        while found := MARKUP.search(page, at):
            self.text(page[at : found.start()])
            at = found.end()
            tag = found[2]
            if tag is None:
                continue
            tag = tag.lower()
            if found[1]:
                self.end(tag)
                continue
            self.start(tag, found[3])
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
                at = close.start() if close else len(page)
        self.text(page[at:])
        self.cut()

    def text(self, piece: str) -> None:
        tag, aside, article, unseen = self.open[-1]
        if unseen or not piece:
            return
        if self.block is None:
            if piece.isspace():
                return
            heading = any(t in HEADINGS for t, *_ in self.open[-3:])
            self.block = Block(heading, aside, article)
        if not piece.isspace():
            self.breaks = 0
        self.block.parts.append(piece)
        if self.link:
            self.block.linked.append(piece)

    def cut(self) -> None:
        """The block ends here."""
        block, self.block, self.breaks = self.block, None, 0
        if block is not None:
            block.text = _joined(block.parts)
            if block.text:
                self.blocks.append(block)

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            # One break is white space, two in a row are the end of a paragraph.
            self.breaks += 1
            if self.breaks > 1:
                self.cut()
            elif self.block is not None:
                self.block.parts.append(" ")
            return
        if tag in BLOCKS:
            self.cut()
            ends, between = ENDS[tag]
            if any(self.count[t] for t in ends):
                for i in range(len(self.open) - 1, 0, -1):
                    if self.open[i][0] in ends:
                        self.close_to(i)
                        break
                    if self.open[i][0] in between:
                        break
        if tag in VOID or len(self.open) > DEEPEST:
            return
        if tag == "a":
            self.link = True
        _, aside, article, unseen = self.open[-1]
        named, hidden = _named_aside(tag, attributes, article) if "=" in attributes or "hidden" in attributes.lower() else (False, False)
        aside = aside or named or tag in ASIDE or (tag == "header" and not article)
        article = article or tag in ("article", "main") or bool(re.search(r"articlebody|role\s*=\s*[\"']?main", attributes.lower()))
        unseen = unseen or hidden or tag in UNSEEN or tag in RAW
        self.open.append((tag, aside, article, unseen))
        self.count[tag] += 1

    def close_to(self, i: int) -> None:
        for tag, *_ in self.open[i:]:
            self.count[tag] -= 1
        del self.open[i:]

    def end(self, tag: str) -> None:
        if tag == "a":
            self.link = False
        if tag in BLOCKS:
            self.cut()
            self.link = False
        if self.count[tag]:
            i = len(self.open) - 1
            while self.open[i][0] != tag:
                i -= 1
            # An inline end tag does not end blocks that were opened inside.
            if tag in BLOCKS or not any(t in BLOCKS for t, *_ in self.open[i + 1 :]):
                self.close_to(i)


def first_label(block: Block, rules: Rules) -> str:
    """good, bad, short or near (likely good); short and near are ambiguous."""
    n = len(block.text)
    linked = len(_joined(block.linked)) if block.linked else 0
    if block.aside or linked > rules.link_density * n:
        return "bad"
    if block.article:
        return "short" if n < rules.short else "good"
    if "©" in block.text:
        return "bad"
    if n < rules.short:
        return "bad" if linked else "short"
    found = WORD.findall(block.text.lower())
    density = sum(w in STOP_WORDS for w in found) / len(found) if found else 0.0
    if density < rules.stop_low:
        return "bad"
    return "good" if density >= rules.stop_high and n > rules.long else "near"


def main_blocks(blocks: list[Block], rules: Rules = Rules()) -> list[Block]:
    """The blocks of the article, by both passes."""
    marked = [b for b in blocks if b.article and not b.aside]
    if marked:
        blocks = [b for b in blocks if b.article]
    labels = [first_label(b, rules) for b in blocks]
    n = len(blocks)
    before, behind, near = [""] * n, [""] * n, ""
    for i in range(n):
        before[i] = near
        near = labels[i] if labels[i] in ("good", "bad") else near
    near = ""
    for i in reversed(range(n)):
        behind[i] = near
        near = labels[i] if labels[i] in ("good", "bad") else near
    reach, heads = None, [False] * n
    for i in reversed(range(n)):
        # Characters up to the next good block, without what is bad.
        heads[i] = blocks[i].heading and reach is not None and reach <= rules.heading_reach
        reach = 0 if labels[i] == "good" else None if labels[i] == "bad" or reach is None else reach + len(blocks[i].text)
    kept = []
    for i, block in enumerate(blocks):
        sides = {before[i], behind[i]} - {""}
        if labels[i] == "short":
            # Inside a marked article only blocks between two bad ones are bad.
            good = heads[i] or ((before[i], behind[i]) != ("bad", "bad") if marked else sides == {"good"})
        elif labels[i] == "near":
            good = "good" in sides or not sides
        else:
            good = labels[i] == "good"
        if good:
            kept.append(block)
    return kept


def page_text(page: str, rules: Rules = Rules()) -> str:
    return "\n".join(b.text for b in main_blocks(Page(page).blocks, rules))


def extract_text(
    pages: DataFrame, html: str = "html", id: str = "page_id", url: str = "url", rules: Rules = Rules()
) -> DataFrame:
    """(id, url, text, n_chars) of every page: the text of its article, blocks joined by line ends.

    Character references are decoded, white space inside a block becomes one space and empty
    blocks are left out. Null pages and pages without an article have an empty text. Rows
    with equal or null ids are pages of their own; further columns are not read, whatever
    their names. An empty table gives no rows. Pages are read one by one where they lie;
    nothing is shuffled, and time is linear in a page's length.
    """
    kinds = {f.name: f for f in pages.schema.fields}
    text_kind = pa.string()
    schema = StructType(
        [kinds[id], kinds[url], StructField("text", StringType()), StructField("n_chars", LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2, most=8 << 20):
            texts = [page_text(p or "", rules) for p in part.column(2).to_pylist()]
            found = pa.array(texts, text_kind)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), found, pc.cast(pc.utf8_length(found), pa.int64())],
                names=[id, url, "text", "n_chars"],
            )

    return pages.select(id, url, html).mapInArrow(run, schema)
