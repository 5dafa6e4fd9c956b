"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides what is clear: blocks in
page furniture (by tag, role, class or id) and blocks made of links are dropped, long blocks with
many stop words are kept, long ones almost without are dropped. A page that as a whole is almost
without stop words is in another language: its long blocks that aren't made of links are kept. The
second pass gives each block still open the label of the nearest decided block of its own part of
the page; where that part has none decided, an article keeps its blocks and other parts follow the
nearest decided block. Links dropped in an article decide nothing for their neighbours. A class or
id makes no furniture of what holds an article without being in one, nor of what holds most of the
page's long text while no long text of an article is outside.

Contract. A null or empty page has an empty text. Character references are decoded once, white
space inside a block becomes one space, blocks are joined in page order by one space. Unclosed
tags, comments and scripts end with the page. Repeated rows are extracted alike.
"""

from __future__ import annotations

import html
import re
from bisect import bisect
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import in_batches

#: Characters from which a block is long enough to be judged by its stop words.
LONG = 60
#: Shares of stop words from which a long block is text, and below which it is not.
MANY_STOPS, FEW_STOPS = 0.15, 0.03
#: Share of characters in links beyond which a block is a list of links.
MANY_LINKS = 0.5

# Common function words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    """
    a an and are as at be been but by can for from had has have he her his i if in is it its not of on or she so
    that the their there they this to was we were what when which who will with would you
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus
    pour qu que qui sa se ses son sur un une vous
    aber als am auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich im
    in ist mit nach nicht noch nur oder sich sie sind so über um und von vor war was wie wird zu zum zur
    al como con del el ella en entre era es esta este la las lo los más me mi muy no o para pero por que se si sin
    sobre su sus también un una y ya
    """.split()
)
# Element names.
BLOCKS = frozenset(
    """
    address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol option p pre search
    section summary table tbody td tfoot th thead title tr ul
    """.split()
)
CONTAINERS = frozenset(
    """
    article aside blockquote body button details dialog div dl fieldset figure footer form head header li main menu
    nav ol search section span table td ul
    """.split()
)
FURNITURE = frozenset("aside button dialog fieldset footer form head label legend menu nav option search".split())
RAW = frozenset(
    "audio canvas iframe math noscript object script select style svg template textarea title video".split()
)
FURNITURE_ROLES = frozenset(
    "alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
FURNITURE_WORDS = frozenset(
    """
    ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs byline comment commentlist comments
    consent cookie cookies copyright disclaimer disqus discussion footer gdpr header login masthead menu modal nav
    navbar navigation newsletter notice pager pagination popup promo promotion recommended related replies reply
    respond rss share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toc toolbar
    widget
    """.split()
)

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)
    |<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<fields>[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+|[^>]*+)(?:>|\Z)""",
    re.S | re.X,
)
_FIELD = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[^\W\d_]+")
_PART = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")


def _is_furniture(name: str, fields: str, in_article: bool) -> bool | None:
    """Whether an element is furniture; None if no more than a piece of its class or id says so."""
    if name in FURNITURE or (name == "header" and not in_article):
        return True
    if not fields or name in ("body", "html"):
        return False
    found = {k.lower(): a or b or c for k, a, b, c in _FIELD.findall(fields)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True
    if found.get("role", "").lower() in FURNITURE_ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "").lower()):
        return True
    if name in ("article", "main"):
        words = found.get("class", "").split() + [found.get("id", "")]
        return any(w.lower() in FURNITURE_WORDS for w in words)
    parts = _PART.findall(f"{found.get('class', '')} {found.get('id', '')}")
    return None if any(p.lower() in FURNITURE_WORDS for p in parts) else False


@dataclass
class Block:
    """A run of text without block-level tags, and where it stands."""

    text: str
    link_chars: int
    part: int
    furniture: bool
    in_article: bool
    #: Containers around it that are furniture by a class or id only.
    named: tuple[int, ...] = ()
    keep: bool | None = field(default=None)


def blocks(page: str) -> list[Block]:
    """Blocks of a page with text in them, in page order."""
    out: list[Block] = []
    # An open container: its name, its part of the page, whether it is furniture, whether in an article,
    # and the parts around it that are furniture by name only.
    stack = [("", 0, False, False, ())]
    with_article: set[int] = set()
    parts, links, held, linked, at = 0, 0, [], 0, 0

    def take(text: str) -> None:
        nonlocal linked
        if text:
            held.append(text)
            if links:
                linked += len(text.strip())

    def close() -> None:
        nonlocal held, linked
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            _, part, furniture, in_article, named = stack[-1]
            out.append(Block(text, linked, part, furniture, in_article, named))
        held, linked = [], 0

    while token := _TOKEN.search(page, at):
        take(page[at : token.start()])
        at = token.end()
        if token["name"] is None:
            continue
        name, end, fields = token["name"].lower(), token["end"], token["fields"] or ""
        if name in RAW and not end:
            if not fields.endswith("/") or name in ("script", "style"):
                closing = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = closing.end() if closing else len(page)
            continue
        if name == "br":
            held.append(" ")
        elif name == "a":
            links = max(0, links - 1) if end else links + 1
        if name in BLOCKS:
            close()
            links = 0 if name != "a" and not end and name in CONTAINERS else links
        if name not in CONTAINERS:
            continue
        if end:
            open_at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if open_at:
                del stack[open_at:]
        elif not fields.endswith("/"):
            _, part, furniture, in_article, named = stack[-1]
            if name == "span":
                stack.append((name, part, furniture, in_article, named))
                continue
            own = _is_furniture(name, fields, in_article)
            if name in ("article", "main", "aside", "section", "nav", "footer", "header", "body") or own is not False:
                parts += 1
                part = parts
            if own is None:
                named = (*named, part)
            article = name in ("article", "main") and own is False and not furniture
            with_article.update(named if article and not in_article else ())
            stack.append((name, part, furniture or bool(own), in_article or (name in ("article", "main") and not own), named))
    take(page[at:])
    close()
    _judge_named(out, with_article)
    return out


def _judge_named(found: list[Block], with_article: set[int]) -> None:
    """Make furniture of the blocks in containers so named, but for those that hold the page's main text."""
    sizes: dict[int, int] = {}
    total = 0
    for b in found:
        if not b.furniture and len(b.text) >= LONG and b.link_chars <= MANY_LINKS * len(b.text):
            total += len(b.text)
            for name in b.named:
                sizes[name] = sizes.get(name, 0) + len(b.text)
    articles = [b.named for b in found if b.in_article and not b.furniture and len(b.text) >= LONG]
    most = {name for name, size in sizes.items() if 2 * size > total and all(name in around for around in articles)}
    main = with_article | most
    for b in found:
        b.furniture = b.furniture or any(name not in main for name in b.named)


def classify(found: list[Block]) -> None:
    """Set ``keep`` of every block: first by its own marks, then by its neighbours."""
    words = [_WORD.findall(b.text.lower()) for b in found]
    stopped = [sum(w in STOP_WORDS for w in own) for own in words]
    open_ = [i for i, b in enumerate(found) if not b.furniture and b.link_chars <= MANY_LINKS * len(b.text)]
    listed = sum(stopped[i] for i in open_) >= FEW_STOPS * sum(len(words[i]) for i in open_)
    for b, own, hits in zip(found, words, stopped, strict=True):
        stops = hits / len(own) if own else 0.0
        if b.furniture or b.link_chars > MANY_LINKS * len(b.text):
            b.keep = False
        elif len(b.text) >= LONG and (stops >= MANY_STOPS or not listed):
            b.keep = True
        elif len(b.text) >= LONG and stops < FEW_STOPS and not b.in_article:
            b.keep = False
    decided = [b.keep for b in found]
    by_part: dict[int, list[int]] = {}
    for i, b in enumerate(found):
        # In an article, what is dropped is links or furniture.
        if decided[i] or (decided[i] is False and not b.in_article):
            by_part.setdefault(b.part, []).append(i)
    anywhere = [i for i, keep in enumerate(decided) if keep is not None]
    for near, chosen in ((by_part, True), ({}, False)):
        _inherit(found, decided, near, anywhere, chosen)


def _inherit(found: list[Block], decided: list, by_part: dict[int, list[int]], anywhere: list[int], own_part: bool) -> None:
    """Labels for open blocks from the nearest decided one; of two equally near, from one that is kept."""
    for i, b in enumerate(found):
        if b.keep is not None:
            continue
        if own_part and b.part not in by_part:
            if b.in_article:
                b.keep = True
            continue
        places = by_part[b.part] if own_part else anywhere
        at = bisect(places, i)
        sides = [(abs(p - i), not decided[p]) for p in places[max(0, at - 1) : at + 1]]
        b.keep = not min(sides)[1] if sides else True


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    classify(found)
    return " ".join(b.text for b in found if b.keep)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p) for p in batch.column(2).to_pylist()]
        sizes = pa.array([len(t) for t in texts], pa.int64())
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes]
        return pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (page_id, url)]
    schema = f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long"
    return in_batches(pages, [page_id, url, page], step, schema)
