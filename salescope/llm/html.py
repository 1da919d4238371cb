"""Main text of web pages by two passes over their blocks.

A page is cut into tags and text; text between block-level tags is a block. The first pass judges each block by itself:
by where it stands (inside a menu, footer, form, advert and the like it is out), by its link density, its length and its
density of stop words. Blocks too short for that are left open. The second pass settles them: an open block takes the
label of the nearest decided blocks before and after it; where these differ, it is kept only beside text and unlinked.

A form may be a part of the page or wrap all of it: like other wrappers it is out unless it holds most of the text. The header
of an article is the article's own, that of the page is not. The end of the page's head need not be marked. Embedded
elements that are never closed hide nothing; scripts, styles and the like do, to the end of the page. Every tag is read in a
bounded number of steps, however broken the page: a tag that the next ``<`` interrupts is text.

Contract: a null or empty page has an empty text; pages are read whole; markup that is broken is text, or ends with the
page; character references are decoded, white space inside a block is one blank, blocks are joined by one blank; repeated
rows each get their result; extra columns stay out of the way; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm.common import ship

ship(__name__)

# Elements whose content is no text, elements apart from the article, and those that end a block.
NO_TEXT = frozenset("script style noscript template textarea iframe svg math canvas object audio video title".split())
APART = frozenset("nav header footer aside menu select button dialog".split())
# Of the elements without text, those whose text runs to the end of the page if they are not closed.
RAW_TEXT = frozenset("script style textarea title".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in class, id or role that mark what is not the article.
APART_WORDS = frozenset(
    "ad ads adv advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies disclaimer disqus footer gdpr header hidden login masthead menu modal nav navbar "
    "navigation newsletter notice notification pager pagination popup promo promoted promotion recommended related "
    "respond replies reply search share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "tags toolbar widget widgets".split()
)
# First parts of compound classes that mark as surely as whole words, parts after which a class only tells
# about the page (has-sidebar), and first parts of classes for what belongs to an article (entry-header).
SURE_PREFIXES = frozenset("advert advertisement comment comments cookie cookies disqus gdpr newsletter related".split())
NO_MARK = frozenset("has no not with without hide show".split())
OF_ARTICLE = frozenset("article category content entry post story tag title".split())
# Frequent short words of the languages at hand.
STOP_WORDS = frozenset(
    "a an and are as at be by for from had has have he her his in is it its not of on or she that the their they this to "
    "was were which will with you au aux avec ce ces cette dans de des du elle en est et il ils la le les leur mais ne "
    "nous ou par pas plus pour que qui sa se ses son sont sur un une vous aber als am auch auf aus bei das dass dem den der "
    "die durch ein eine einem einen einer er es für hat ich ihr im ist mit nach nicht noch oder sich sie sind so um und "
    "von vor war wenn wie wird zu zum zur al como con cuando del desde el ella ellos entre era esta este ha hay las lo los "
    "más muy no para pero por porque según ser si sin sobre su sus también y ya".split()
)
# Characters below which a block is open, and from which a dense block is surely text.
SHORT, LONG = 70, 200
# Densities: links beyond the first are out; stop words from the second on are text, below the third are not.
MOST_LINKED, STOP_HIGH, STOP_LOW = 0.4, 0.15, 0.03

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*>"
    r"|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.DOTALL,
)
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.IGNORECASE)
_WORD = re.compile(r"[^\W\d_]+")
GOOD, BAD, OPEN = 1, -1, 0


def _marked_apart(word: str) -> int:
    """2 for a class that marks what is not the article, 1 for one that a layout may bear as well, 0 for others."""
    if word in APART_WORDS:
        return 2
    parts = re.split(r"[-_]+", word)
    if parts[0] in SURE_PREFIXES:
        return 2
    for i, part in enumerate(parts):
        if part in NO_MARK or (i == 0 and part in OF_ARTICLE):
            return 0
        if part in APART_WORDS:
            return 1
    return 0


def _is_apart(name: str, attributes: str) -> int:
    """Whether an element stands apart from the article, by its name or by its marks: 2 surely, 1 perhaps, 0 not."""
    if name in APART:
        return 2
    least = int(name == "form")
    if not attributes or name in ("html", "body", "main"):
        return least
    if _HIDDEN.search(attributes):
        return 2
    words = (w for found in _MARKS.findall(attributes) for w in "".join(found).lower().split())
    most = max(map(_marked_apart, words), default=0)
    most = max(most, least)
    # An article is never apart by a part of a class.
    return 0 if name == "article" and most < 2 else most


class _Block:
    """A run of text with its tag, place and linked characters."""

    __slots__ = ("heading", "inside", "apart", "wrapper", "parts", "linked")

    def __init__(self, heading: bool, inside: bool, apart: bool, wrapper: int):
        self.heading, self.inside, self.apart, self.wrapper, self.parts, self.linked = heading, inside, apart, wrapper, [], 0


def blocks_of(page: str) -> list[tuple[str, float, bool, bool, bool, int]]:
    """(text, link density, is heading, inside an article, surely apart, wrapper) of each block with text, in page order.

    The wrapper is the number of the outermost open element that is perhaps apart, or 0.
    """
    done, at, block = [], 0, _Block(False, False, False, 0)
    # The names of the open elements, and the places among them of each name, of block-level tags, and of those apart.
    names, places, levels, marks = [], {}, [], []
    wrappers, unclosed = [], set()
    apart = articles = links = 0

    def add(raw: str) -> None:
        if raw:
            block.parts.append(raw)
            if links:
                block.linked += len(raw.strip())

    def cut(heading: bool = False) -> None:
        nonlocal block
        if block.parts:
            text = " ".join(html.unescape("".join(block.parts)).split())
            if text:
                done.append((text, min(1.0, block.linked / len(text)), block.heading, block.inside, block.apart, block.wrapper))
        block = _Block(heading, articles > 0, apart > 0, wrappers[0] if wrappers else 0)

    def close(index: int) -> None:
        """Close the element at ``index`` of the open ones, and all it holds."""
        nonlocal apart, articles, links
        while marks and marks[-1][0] >= index:
            if marks.pop()[1] == 2:
                apart -= 1
            else:
                wrappers.pop()
        while levels and levels[-1] >= index:
            levels.pop()
        for name in reversed(names[index:]):
            if name:
                places[name].pop()
            articles -= name in ("article", "main")
            links -= name == "a"
        del names[index:]

    while match := _TAG.search(page, at):
        add(page[at:match.start()])
        at = match.end()
        closing, name, attributes = match.groups()
        if name is None:
            if match[0].startswith("<![CDATA["):
                add(html.escape(match[0][9:].removesuffix("]]>")))
            continue
        name = name.lower()
        if closing:
            index = places[name][-1] if places.get(name) else None
            if name in BLOCK_TAGS:
                if index is not None:
                    close(index)
                cut()
            elif index is not None and not (levels and levels[-1] >= index):
                close(index)
            elif index is not None and name == "a":
                # A link across blocks: only the link ends.
                links -= 1
                names[index] = ""
                places[name].pop()
            continue
        if name in NO_TEXT:
            if not attributes.rstrip().endswith("/") and name not in unclosed:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
                if end:
                    at = end.end()
                elif name in RAW_TEXT:
                    at = len(page)
                else:
                    unclosed.add(name)
            if name == "title":
                cut()
            continue
        if name == "head":
            cut()
            continue
        if name == "br":
            add(" ")
            continue
        is_apart = _is_apart(name, attributes)
        if name == "header" and articles:
            is_apart = 0
        if name in ("article", "main") and not is_apart and (apart or wrappers) and not articles:
            # An article does not begin inside a menu: what stood apart was never closed.
            apart = 0
            marks.clear()
            wrappers.clear()
        if name in ("p", "li") and names and names[-1] == name:
            close(len(names) - 1)
        if name not in VOID and not attributes.rstrip().endswith("/"):
            places.setdefault(name, []).append(len(names))
            if name in BLOCK_TAGS:
                levels.append(len(names))
            if is_apart:
                marks.append((len(names), is_apart))
            names.append(name)
            apart += is_apart == 2
            if is_apart == 1:
                wrappers.append(at)
            articles += name in ("article", "main")
            links += name == "a"
        if name in BLOCK_TAGS or is_apart:
            cut(heading=len(name) == 2 and name[0] == "h" and name[1].isdigit())
    add(page[at:])
    cut()
    return done


def stop_share(text: str) -> float:
    """The share of stop words among the words."""
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(len(words), 1)


def judge(text: str, density: float, apart: bool, in_article: bool, known: bool = True) -> int:
    """The first pass: a block by itself. Inside a marked article, links and rare stop words do not speak against a block.

    ``known``: the page has a block dense in stop words. Without one its language may not be listed, and only length, place
    and links count.
    """
    if apart or (density > MOST_LINKED and not in_article):
        return BAD
    if len(text) < SHORT:
        return OPEN
    stop = stop_share(text)
    if stop >= STOP_HIGH:
        return GOOD
    if len(text) >= LONG and not in_article:
        if not known:
            return GOOD
        if stop < STOP_LOW:
            return BAD
    return OPEN


def _settled(found):
    """(text, link density, is heading, inside, apart) of each block: a wrapper is apart unless it holds most of the text."""
    weight, total = {}, 0
    for text, density, _, _, apart, wrapper in found:
        if not apart and density <= MOST_LINKED and len(text) >= SHORT:
            weight[wrapper] = weight.get(wrapper, 0) + len(text)
            total += len(text)
    kept = {wrapper for wrapper, held in weight.items() if 2 * held > total} | {0}
    return [(*block[:4], block[4] or block[5] not in kept) for block in found]


def main_text(page: str | None) -> str:
    """The blocks that are kept, joined by one blank."""
    found = _settled(blocks_of(page or ""))
    # Where a page marks its article, only what is inside can be text.
    marked = any(inside and not apart for _, _, _, inside, apart in found)
    known = any(
        not apart and density <= MOST_LINKED and len(text) >= SHORT and stop_share(text) >= STOP_HIGH
        for text, density, _, _, apart in found
    )
    first = [
        judge(text, density, apart or (marked and not inside), marked, known) for text, density, _, inside, apart in found
    ]
    before, last = [], None
    for label in first:
        before.append(last)
        last = label if label != OPEN else last
    after, last = [], None
    for label in reversed(first):
        after.append(last)
        last = label if label != OPEN else last
    after.reverse()
    kept = []
    for (text, density, heading, inside, _), label, b, a in zip(found, first, before, after):
        if label == OPEN:
            # Open blocks of a marked article have only its own edges beside them: nothing there speaks against them.
            if (inside and marked) or GOOD == a == b or (GOOD in (a, b) and BAD not in (a, b)):
                label = GOOD
            elif a is None and b is None:
                # No block of the page is decided: what is not linked is all there is.
                label = GOOD if density == 0 or (not known and len(text) >= SHORT) else BAD
            elif GOOD in (a, b):
                label = GOOD if density == 0 and (a == GOOD if heading else b == GOOD) else BAD
            else:
                label = BAD
        if label == GOOD:
            kept.append(text)
    return " ".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each page."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def of_batches(batches):
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    return pages.select("page_id", "url", F.col("html").cast("string")).mapInArrow(of_batches, schema)


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
