"""Main text of web pages by tree scoring."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamframe.llm.common import whole_text

# Element kinds of the HTML standard.
SKIPPED = frozenset(
    "script style noscript template head nav header footer aside form button select option textarea input label fieldset "
    "iframe object embed svg canvas math audio video map dialog menu".split()
)
RAW = frozenset("script style textarea title noscript template iframe svg math".split())
BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "blockquote pre figure figcaption address hr center details summary hgroup search".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_PARAGRAPH = BLOCKS | SKIPPED - frozenset("script style noscript template button select option textarea input label iframe object embed svg canvas math audio video map".split())
# An open element of the second kind ends where one of the first begins, within the third.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Whole parts of a class or id, or a role, that name what is not the article.
ASIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promo(?:s|tion|tions)?|banner|banners|cookie|cookies|consent|gdpr|"
    r"notice|notices|alert|popup|modal|overlay|sidebar|sidebars|side|aside|rail|widget|widgets|menu|menus|nav|navbar|navigation|navi|"
    r"breadcrumb|breadcrumbs|pagination|pager|toolbar|topbar|masthead|header|footer|foot|comment|comments|commentlist|disqus|respond|replies|discussion|"
    r"share|sharing|social|related|recommended|recommendations|newsletter|subscribe|subscription|signup|login|search|searchbox|skip|hidden)(?=$|[\s_-])",
    re.I,
)
# Parts of a name that tell what an element has or lacks, or a header of the article's own.
OTHERS = re.compile(r"(?:^|(?<=[\s_-]))(?:(?:has|no|with|without)[_-]\S*|(?:entry|post|article|story|content|page|title)[_-]+header(?=$|[\s_-]))", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")
COMMAS = re.compile("[,،、，﹐﹑]")


class Node:
    __slots__ = ("tag", "parent", "score", "chars", "linked", "blocks", "children", "quiet", "named", "weight", "count", "titled")

    def __init__(self, tag: str, parent: Node | None, quiet: bool, named: bool = False):
        self.tag, self.parent, self.quiet, self.named = tag, parent, quiet, named
        self.score, self.chars, self.linked, self.weight, self.count, self.titled = 0.0, 0, 0, 0.0, 0, False
        self.children: list[Node] = []
        self.blocks: list[int] = []


def _quiet(tag: str, rest: str) -> tuple[bool, bool]:
    """Whether an element is never part of the article, and whether its class or
    id names something beside the article."""
    if tag in SKIPPED:
        return True, False
    if not rest or tag in ("html", "body", "main", "article"):
        return False, False
    named = False
    for name, *values in ATTRIBUTE.findall(rest):
        name, value = name.lower(), next((v for v in values if v), "")
        if name in ("class", "id") and ASIDE.search(OTHERS.sub("", value)):
            named = True
        if name == "role" and value.strip().lower() in ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True, named
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, named
    return False, named


def _points(said: str, linked: int) -> float:
    """What a block of text is worth."""
    return (1 + len(COMMAS.findall(said)) + min(len(said) / 100, 3)) * (1 - linked / len(said)) if len(said) >= 25 else 0.0


def _without_named(root: Node, blocks: list[tuple[Node, str, int]]) -> list[tuple[Node, str, int]]:
    """The blocks that are in no named element, but for named elements that hold
    most of the page's points (of its characters outside links if it has none).
    One block alone is an advert or a notice, unless the page has no other."""
    weights = [_points(said, linked) for _, said, linked in blocks]
    if not any(weights):
        weights = [float(len(said) - linked) for _, said, linked in blocks]
    for (at, _, _), weight in zip(blocks, weights):
        while at:
            at.weight += weight
            at.count += 1
            at = at.parent

    def dropped(at: Node) -> bool:
        while at:
            if at.named and (at.weight * 2 <= root.weight or at.count == 1 < root.count):
                return True
            at = at.parent
        return False

    return [b for b in blocks if not dropped(b[0])]


def parse(page: str) -> tuple[Node, list[tuple[Node, str, int]]]:
    """Block elements as a tree, and the blocks of text in page order, each with
    the element that holds it and its characters inside links."""
    root = Node("html", None, False)
    here, links, blocks = root, 0, []
    text: list[str] = []
    linked: list[str] = []

    def flush() -> None:
        nonlocal text, linked
        if text:
            # Character references are decoded once, after markup is gone.
            said = SPACE.sub(" ", "".join(text)).strip()
            if said and not here.quiet:
                blocks.append((here, said, min(len(said), len(SPACE.sub(" ", "".join(linked)).strip()))))
            text, linked = [], []

    def say(piece: str, raw: bool = False) -> None:
        if piece:
            piece = piece if raw else entities.unescape(piece)
            text.append(piece)
            if links:
                linked.append(piece)

    def close(tags: frozenset | set, within: frozenset | set = frozenset()) -> bool:
        """Ends the nearest open element of the given kinds, if any."""
        nonlocal here
        at = here
        while at is not root and at.tag not in tags and at.tag not in within:
            at = at.parent
        if at is root or at.tag not in tags:
            return False
        here = at.parent
        return True

    at = 0
    while at < len(page):
        found = TOKEN.search(page, at)
        if not found:
            say(page[at:])
            break
        say(page[at : found.start()])
        at = found.end()
        tag = found["tag"]
        if tag is None:
            say(found["data"] or "", raw=True)
            continue
        tag, ending = tag.lower(), bool(found["close"])
        if tag == "a":
            links = 0 if ending else 1
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in RAW and not ending:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at) if not found["rest"].endswith("/") or tag not in ("svg", "math") else None
            if end:
                at = end.end()
            elif not (tag in ("svg", "math") and found["rest"].endswith("/")):
                at = len(page)  # never closed: the rest belongs to it
            continue
        block = tag in BLOCKS or tag in SKIPPED
        if not ending:
            quiet, named = _quiet(tag, found["rest"])
            if not block and not quiet:
                continue
            if tag in VOID:
                if block:
                    flush()
                continue
            flush()
            if tag in ENDS_PARAGRAPH:
                p = here
                while p is not root and p.tag not in BLOCKS | SKIPPED:
                    p = p.parent
                if p.tag == "p":
                    here = p.parent
            if tag in IMPLIED:
                while close(*IMPLIED[tag]):
                    pass
            if tag in ("html", "body"):
                continue
            node = Node(tag, here, here.quiet or quiet, named and block)
            here.children.append(node)
            here = node
        else:
            if block:
                flush()
                if tag not in ("html", "body"):
                    close({tag}, {"table"} if tag == "p" else frozenset())
            else:
                # An inline element opened a node only if it was to be left out.
                probe = here
                while probe is not root and probe.tag not in BLOCKS and probe.tag not in SKIPPED and probe.tag != tag:
                    probe = probe.parent
                if probe is not root and probe.tag == tag:
                    flush()
                    here = probe.parent
    flush()
    return root, _without_named(root, blocks)


def main_text(page: str) -> str:
    """The article of a page.

    A block of 25 characters or more is worth 1 point, 1 per comma and 1 per
    hundred characters (3 at most); its element's parent gets all of it, the
    grandparent half, further ancestors a third, a quarter and so on. A
    container's points are discounted by its share of linked characters, and
    the best one is the article, together with those of its siblings that score
    a fifth as much, hold the title or are paragraphs or headings that are
    mostly not links. Elements with a name like "sidebar" are left out unless
    they hold several blocks with most of the page's points. Of all else that is kept no block is
    dropped but for lists of links.
    """
    root, blocks = parse(page)
    if not blocks:
        return ""
    nodes: list[Node] = []
    for n, (node, said, linked) in enumerate(blocks):
        node.blocks.append(n)
        at = node
        while at:
            at.chars += len(said)
            at.linked += linked
            at.titled |= node.tag == "h1"
            at = at.parent
        points = _points(said, linked)
        if len(said) < 25:
            continue
        # Text right inside a container counts for that container.
        at, share = (node if node.tag in ("article", "main", "section", "div", "td", "html") else node.parent or node), 1
        while at:
            if not at.score:
                nodes.append(at)
            at.score += points / share
            at, share = at.parent, share + 1
    value = lambda x: x.score * (1 - x.linked / max(1, x.chars))
    named = [x for x in nodes if x.tag in ("article", "main")]
    if not nodes:
        # No long block at all: what is not a list of links is the text.
        return "\n\n".join(said for _, said, linked in blocks if linked * 2 <= len(said))
    best = max(named or nodes, key=value)
    # The article is an inner part only where it holds most of the points.
    while best.parent and best.tag not in ("article", "main") and value(best.parent) > value(best):
        best = best.parent
    family = best.parent.children if best.parent and best.tag not in ("article", "main") else [best]
    keep = {id(best)}
    for x in family:
        mostly_text = x.chars and x.linked * 2 <= x.chars
        if value(x) * 5 >= value(best) or mostly_text and (x.titled or x.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "ul", "ol", "table", "figure")):
            keep.add(id(x))
    if best.parent and best.tag == "article":
        keep |= {id(x) for x in best.parent.children if x.tag == "article" and value(x) * 5 >= value(best)}
    out = []
    for node, said, linked in blocks:
        at, inside, menu = node, False, False
        while at:
            inside |= id(at) in keep
            menu |= at.tag in ("ul", "ol", "table") and at.linked > 0.8 * at.chars
            at = at.parent
        if inside and not menu or node is best.parent and linked * 2 <= len(said):
            out.append(said)
    return "\n\n".join(out)


def extract_text(pages: DataFrame, html: str = "html", columns: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``columns`` of every page and its main ``text`` (empty if there is none).

    A null page is empty. Repeated rows, null keys and very long pages are
    treated like any other; columns not named are dropped; an empty table gives
    no rows. Each page is read on its own, so nothing is shuffled.
    """
    kept = [c for c in columns if c in pages.columns]
    schema = pages.select(*kept).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = pa.array([main_text(p.as_py()) for p in b.column(len(kept))], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], said], names=[*kept, "text"])

    return pages.select(*kept, whole_text(html).alias("_html")).mapInArrow(run, schema)
