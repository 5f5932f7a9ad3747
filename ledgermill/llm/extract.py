"""Main text of raw HTML pages by two passes over blocks.

The first pass decides blocks that their place, length, stop words and links make clear. The
second gives the others, mostly short ones, the verdict of their nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgermill.llm.text import with_results

# HTML element names by role.
SKIPPED = frozenset(
    "script style noscript template svg canvas iframe object select textarea button head "
    "video audio map datalist".split()
)
RAW_TEXT = frozenset("script style textarea title noscript template iframe svg".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog fieldset".split())
BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption "
    "thead tbody tfoot tr td th blockquote pre figure figcaption address details summary hr "
    "center nav header footer aside form menu dialog fieldset".split()
)
VOID = frozenset("br hr img input meta link area base col embed source track wbr param".split())
# Elements whose end tag is often left out: the next one of the group ends it.
OPTIONAL_END = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "a": {"a"},
}
# Words of class and id attributes that mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion "
    "banner nav navbar navigation menu breadcrumb breadcrumbs sidebar widget footer masthead "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended comment comments "
    "disqus reply replies respond toc pagination pager skip search copyright legal disclaimer "
    "toolbar topbar hidden".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu "
    "menubar".split()
)
# Frequent words of the four languages of the pages.
STOP_WORDS = frozenset(
    "the of and to in a is that it for was on are as with be by this not at from or an have his "
    "her they which you were had has but their one all we there can been if more will would who "
    "le la les de des du un une et est en que qui dans pour pas sur avec ce il elle au par plus "
    "ne se son sa ses ou mais comme nous vous sont aux cette leur "
    "der die das und ist von den dem mit für auf ein eine einer nicht sich auch als es an werden "
    "aus er hat dass sie nach wird bei einem oder zur zum wie über so "
    "el los las y no una por con para su lo como más pero sus al o este sí porque esta entre "
    "cuando muy sin sobre también me hasta hay donde quien desde todo nos".split()
)
# Those of the marks that articles carry as well. They count while other text remains.
DOUBTFUL = frozenset(
    "promo promotion banner widget alert overlay login signup subscription share sharing social "
    "related recommended reply replies respond copyright legal disclaimer search".split()
)
# Marks that lists of other articles carry, and words that make a class say
# what its element has or lacks.
LISTED = frozenset("comment comments reply ad advert related promo".split())
HAVING = frozenset("has have with no not without hide show".split())
# How an element is excluded: for good, together with the articles in it, or up to an article.
NEVER, HIDDEN, APART, AROUND = 0, 1, 2, 3
SHORT, LONG = 70, 200  # characters
STOP_LOW, STOP_HIGH = 0.15, 0.25
LINKS_HIGH = 0.4
TEASER = 2  # prose elsewhere of more than so many times its length makes an article a teaser
SENTENCE_ENDS = tuple(".!?…。！？")

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)/?>"""
    r"|<![^>]*+>|<\?[^>]*+>",
    re.S,
)
_LOOSE = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_WORD = re.compile(r"[^\W\d_]+")
_SPACE = re.compile(r"\s+")
_SPLIT = re.compile(r"[^a-z0-9]+")


@dataclass
class Block:
    text: str
    link_chars: int
    excluded: bool
    inside: bool  # of an article or main element
    apart: bool = False  # excluded only by what is around its article
    all_links: bool = False  # no letter or digit outside of links
    verdict: str = ""


def exclusion(tag: str, attributes: str, doubtful: bool = True) -> int:
    """How an element's attributes say that it is not the article; without ``doubtful``, only
    by marks that articles do not carry."""
    if not attributes.strip():
        return NEVER
    words, firsts, parts = set(), set(), _ATTRIBUTE.findall(attributes)
    bare = attributes.lower()
    if re.search(r"(?:^|\s)hidden(?:\s|$)", bare):
        return HIDDEN
    apart = False
    for name, a, b, c in parts:
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id"):
            for own in map(_SPLIT.split, value.split()):
                own = [w for w in own if w]
                if own and own[0] not in HAVING:
                    words.update(own)
                    firsts.add(own[0])
        elif name == "role" and value in ROLES:
            apart = True
        elif name == "aria-hidden" and value == "true":
            return HIDDEN
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return HIDDEN
    if apart:
        return APART
    if tag in ("html", "body", "main"):
        return NEVER
    if not doubtful:
        words, firsts = words - DOUBTFUL, firsts - DOUBTFUL
    if tag == "article":
        return APART if words & LISTED else NEVER
    if firsts & LISTED:
        return APART
    return AROUND if words & MARKS else NEVER


class BlockReader:
    """One pass over the markup of a page that collects its blocks.

    A main element ends the marks around it, an article those of a page's layout. Only what
    is hidden stays so. Text of an excluded element inside a block goes by itself.
    """

    def __init__(self, doubtful: bool = True):
        self.doubtful = doubtful
        self.blocks: list[Block] = []
        self.pieces: list[str] = []
        self.link_chars = 0
        self.all_links = True
        self.place: tuple[bool, bool, bool] | None = None  # where the block's text began
        # tag, kind, counts around an article, excluded elements since the last block began
        self.stack: list[tuple[str, int, tuple | None, int]] = []
        self.open: dict[str, int] = {}
        self.excluded = [0, 0, 0, 0]  # open elements by kind of exclusion
        self.outside = 0  # those of kind APART around the innermost article

    def _end_block(self) -> None:
        text = _SPACE.sub(" ", "".join(self.pieces)).strip()
        if text:
            inside, own, outside = self.place
            self.blocks.append(
                Block(text, self.link_chars, own or outside, inside, outside and not own, self.all_links)
            )
        self.pieces, self.link_chars, self.all_links, self.place = [], 0, True, None

    def _where(self) -> tuple[bool, bool, bool]:
        """Inside an article, excluded by an element in it, excluded by one around it."""
        inside = bool(self.open.get("article") or self.open.get("main"))
        _, hidden, apart, around = self.excluded
        return inside, hidden + around + apart - self.outside > 0, self.outside > 0

    def _pop(self) -> None:
        tag, kind, before, _ = self.stack.pop()
        self.open[tag] -= 1
        self.excluded[kind] -= 1
        if before is not None:
            self.excluded[APART], self.excluded[AROUND], self.outside = before

    def _start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self._end_block()
        for other in OPTIONAL_END.get(tag, ()):
            if self.open.get(other):
                self._close(other)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            if tag in ("br", "img"):
                self.pieces.append(" ")
            return
        in_article = self.open.get("article") or self.open.get("main")
        kind = HIDDEN if tag in SKIPPED else exclusion(tag, attributes, self.doubtful)
        kept = tag == "header" and in_article or tag == "form" and not self.doubtful
        if tag in BOILERPLATE and not kept and kind != HIDDEN:
            kind = AROUND if tag in ("header", "form", "fieldset") else APART
        before = None
        if tag in ("article", "main"):
            before = self.excluded[APART], self.excluded[AROUND], self.outside
            self.excluded[AROUND] = 0
            if tag == "main":
                self.excluded[APART] = 0
            self.outside = self.excluded[APART]
            if in_article:  # an article within an article: what is around it counts
                self.excluded[APART], self.excluded[AROUND], self.outside = before
        inline = 0 if tag in BLOCKS else self._dropped() + (kind != NEVER)
        self.stack.append((tag, kind, before, inline))
        self.open[tag] = self.open.get(tag, 0) + 1
        self.excluded[kind] += 1

    def _dropped(self) -> int:
        """The open excluded elements that began inside the current block."""
        return self.stack[-1][3] if self.stack else 0

    def _close(self, tag: str) -> None:
        """End an element; an inline one never ends the block around it."""
        if not self.open.get(tag):
            return
        strong = tag in BLOCKS and tag not in OPTIONAL_END
        for at in range(len(self.stack) - 1, -1, -1):
            name = self.stack[at][0]
            if name == tag:
                while len(self.stack) > at:
                    self._pop()
                return
            if not strong and name in BLOCKS and name not in ("p", "tr", "td", "li"):
                return

    def read(self, page: str) -> list[Block]:
        at, size = 0, len(page)
        last_end = page.rfind(">")
        endless = set()  # elements whose end does not follow any more
        while at < size:
            start = page.find("<", at)
            if start < 0:
                self._text(page[at:])
                break
            if start > at:
                self._text(page[at:start])
            token = None
            if start < last_end or page.startswith("<!--", start):
                token = _TOKEN.match(page, start) or _LOOSE.match(page, start)
            if token is None:
                self._text("<")
                at = start + 1
                continue
            at = token.end()
            if token.group(2) is None:
                continue
            tag = token.group(2).lower()
            if token.group(1):
                if tag in BLOCKS:
                    self._end_block()
                self._close(tag)
            elif tag == "svg" and token.group(3).endswith("/"):
                continue
            elif tag in RAW_TEXT:
                end = None
                if tag not in endless:
                    end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                if end:
                    at = end.end()
                elif tag == "svg":  # the text after an svg that is never ended ends it
                    endless.add(tag)
                else:
                    at = size
            else:
                self._start(tag, token.group(3))
        self._end_block()
        return self.blocks

    def _text(self, piece: str) -> None:
        if self._dropped():
            return
        text = html.unescape(piece)
        self.pieces.append(text)
        if self.place is None and text.strip():
            self.place = self._where()
        if self.open.get("a"):
            self.link_chars += len(text.strip())
        elif self.all_links:
            self.all_links = not any(map(str.isalnum, text))


def stop_density(block: Block) -> float:
    words = [w.lower() for w in _WORD.findall(block.text)]
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def first_verdict(block: Block, foreign: bool = False) -> str:
    """good, bad, or near / short for blocks that their neighbours decide. On a ``foreign``
    page, one without the known stop words, whole sentences count in their place."""
    if block.excluded:
        return "bad"
    size = len(block.text)
    if block.link_chars > LINKS_HIGH * size:
        if not block.inside or block.all_links and size <= LONG:
            return "bad"
    if size < SHORT:
        return "short"
    stops = stop_density(block)
    if stops >= STOP_HIGH:
        return "good" if size > LONG or block.inside else "near"
    if foreign and block.text.endswith(SENTENCE_ENDS):
        return "good"
    if stops >= STOP_LOW or block.inside or size > LONG:
        return "near"
    return "bad"


def is_prose(block: Block) -> bool:
    """Whether the first pass keeps a block without regard to an article around it."""
    return first_verdict(replace(block, inside=False)) == "good"


def second_verdict(blocks: list[Block]) -> None:
    """Ambiguous blocks take the verdict of the nearest decided ones, good winning a tie.

    Blocks of an article look at its other blocks only, and stay if none is decided.
    """
    decided = [i for i, b in enumerate(blocks) if b.verdict in ("good", "bad")]
    before: list[int | None] = []
    last = None
    for i, block in enumerate(blocks):
        if block.verdict in ("good", "bad") and not block.excluded:
            last = i
        before.append(last)
    after: list[int | None] = [None] * len(blocks)
    last = None
    for i in range(len(blocks) - 1, -1, -1):
        if blocks[i].verdict in ("good", "bad") and not blocks[i].excluded:
            last = i
        after[i] = last
    final = {}
    for i, block in enumerate(blocks):
        if i in final or block.verdict in ("good", "bad"):
            continue
        around = [
            (abs(j - i), blocks[j].verdict)
            for j in (before[i], after[i])
            if j is not None and (blocks[j].inside or not block.inside)
        ]
        if not around:
            lone = block.inside or block.verdict == "near" or not decided
            final[i] = "good" if lone else "bad"
        elif block.verdict == "near" or block.inside:
            final[i] = "good" if any(v == "good" for _, v in around) or block.inside else "bad"
        else:
            nearest = min(d for d, _ in around)
            final[i] = "good" if any(v == "good" for d, v in around if d == nearest) else "bad"
    for i, verdict in final.items():
        blocks[i].verdict = verdict


def keep_to_article(blocks: list[Block]) -> None:
    """Exclude what lies outside of articles, unless the prose of the page lies there: an
    article without prose beside much of it is a teaser or a heading, and has no say."""
    if not any(b.inside and not b.excluded for b in blocks):
        for b in blocks:  # the only articles of the page lie in a part like an aside
            b.excluded &= not (b.inside and b.apart)
    within = [b for b in blocks if b.inside and not b.excluded]
    if not within:
        return
    size = sum(len(b.text) for b in within)
    prose = (len(b.text) for b in blocks if not b.inside and is_prose(b))
    teaser = sum(prose) > TEASER * size and not any(map(is_prose, within))
    for b in blocks:
        if teaser:
            b.inside = False
        else:
            b.excluded |= not b.inside


def judged(page: str, doubtful: bool = True) -> list[Block]:
    """The blocks of a page with their verdicts."""
    blocks = BlockReader(doubtful).read(page)
    keep_to_article(blocks)
    sized = [b for b in blocks if not b.excluded and len(b.text) >= SHORT]
    foreign = all(stop_density(b) < STOP_LOW for b in sized)
    for block in blocks:
        block.verdict = first_verdict(block, foreign)
    second_verdict(blocks)
    return blocks


def main_text(page: str) -> str:
    """The article's blocks in page order, one per line.

    A page that keeps nothing is read again without the doubtful marks and without the rule
    against forms, and keeps what it has then if there is a block of prose.
    """
    kept = [b for b in judged(page) if b.verdict == "good"]
    if not kept:
        kept = [b for b in judged(page, doubtful=False) if b.verdict == "good"]
        if not any(map(is_prose, kept)):
            kept = []
    return "\n".join(b.text for b in kept)


def extract_main_text(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``pages`` plus text and n_chars (code points).

    Null and empty pages give an empty text. Markup may be broken: unknown, unclosed and
    misnested elements are read as browsers do in the common cases, anything that is no tag
    is text. Long pages take time in proportion to their length, also if elements, comments or
    tags never end. Repeated rows are each extracted; columns named like results are replaced.
    """

    def extract(array: pa.Array) -> pa.Array:
        texts = [main_text(page or "") for page in array.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["text", "n_chars"],
        )

    return with_results(pages, [html_column], extract, "text string, n_chars long")
