"""A lenient HTML reader that gives a page's leaf blocks with their ancestors.

Its time is linear in the page: tags are found by searching forward only, open elements are
looked up by name, and blocks share their ancestors as linked nodes.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9:-]*")
QUOTE_OR_END = re.compile(r"[\"'>]")
NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
LETTERS = re.compile(r"[a-z]+")
SPACE = re.compile(r"[ \t\n\r\f\v]+")
#: Elements whose content is no text of the page.
RAW = frozenset("script style template textarea title iframe noembed noframes".split())
#: Elements whose content is text as it stands, without markup.
PLAIN = frozenset("xmp plaintext".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that don't end a block; formulas, drawings and embedded objects stand in the line.
INLINE = frozenset(
    "a abbr acronym audio b bdi bdo big canvas cite code data del dfn em font i img ins kbd label mark object picture q rp rt ruby s samp small span strike strong sub sup time tt u var video wbr".split()
)
#: Formulas and drawings, whose own elements all stand in the line, and what ends them if they aren't closed.
FOREIGN = frozenset(("math", "svg"))
BREAKS = frozenset("p div table h1 h2 h3 h4 h5 h6 ul ol dl li dt dd blockquote pre hr center menu section article main aside nav header footer form td th tr body html".split())
#: Start tags that end an open paragraph: every block but these.
KEEPS_PARAGRAPH = frozenset("button select option optgroup source track".split())
#: An end tag of these doesn't reach beyond the nearest one of the scopes.
SCOPES = frozenset("table td th article section main aside nav header footer form body html".split())
BARRIERS = SCOPES - {"td", "th"}
SELF_NESTING = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr"}, "th": {"tr"}, "option": {"select"}}
SAME = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
SECTIONS = frozenset("article main nav header footer aside form section".split())


@dataclass(eq=False)
class Node:
    """An open element. ``added``: its tag and words as far as no element around it has them."""

    parent: Node | None
    tag: str
    words: tuple[str, ...]
    added: tuple[str, ...]
    near: str  # the nearest sectioning element
    named: tuple[str, ...]  # words of the nearest element that has any
    score: float | None = field(default=None)

    @property
    def chain(self) -> tuple[str, ...]:
        out, node = [], self
        while node.parent is not None:
            out.append(".".join((node.tag, *node.words)))
            node = node.parent
        return tuple(reversed(out))


def root() -> Node:
    return Node(None, "none", (), (), "none", ())


@dataclass
class Block:
    text: str
    node: Node  # the innermost element around it
    link_chars: int

    @property
    def chain(self) -> tuple[str, ...]:
        """Ancestors from the root, as tag or tag.word.word."""
        return self.node.chain


def words_of(attributes: str) -> tuple[str, ...]:
    """The words of class, id and role attributes, each once."""
    if "=" not in attributes:
        return ()
    return tuple(dict.fromkeys(w for m in NAMED.findall(attributes) for w in LETTERS.findall("".join(m).lower())))


def clean(raw: str) -> str:
    """Character references decoded, white space made one space, trimmed."""
    return SPACE.sub(" ", entities.unescape(raw) if "&" in raw else raw).strip(" ")


class _Open:
    """The stack of open elements, with the places of each tag in it."""

    def __init__(self):
        self.nodes: list[Node] = [root()]
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        self.around: dict[str, int] = {}

    @property
    def top(self) -> Node:
        return self.nodes[-1]

    def push(self, tag: str, attributes: str) -> None:
        words, above = words_of(attributes), self.top
        added = []
        for mark in (f"in={tag}", *(f"word={w}" for w in words)):
            count = self.around[mark] = self.around.get(mark, 0) + 1
            if count == 1:
                added.append(mark)
        self.places.setdefault(tag, []).append(len(self.nodes))
        if tag in SCOPES:
            self.scopes.append(len(self.nodes))
        self.nodes.append(Node(above, tag, words, tuple(added), tag if tag in SECTIONS else above.near, words or above.named))

    def cut(self, at: int) -> None:
        """Closes the element at this place and all within it."""
        while len(self.nodes) > at:
            node = self.nodes.pop()
            for mark in (f"in={node.tag}", *(f"word={w}" for w in node.words)):
                self.around[mark] -= 1
            self.places[node.tag].pop()
            if node.tag in SCOPES:
                self.scopes.pop()

    def last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close(self, tag: str) -> None:
        at = self.last((tag,))
        if at and (tag in SCOPES or not self.scopes or self.scopes[-1] <= at):
            self.cut(at)

    def make_room(self, tag: str) -> None:
        """Ends what can't stand around a new element of this tag."""
        if tag not in KEEPS_PARAGRAPH and self.top.tag == "p":
            self.cut(len(self.nodes) - 1)
        if tag in SELF_NESTING:
            same = SAME.get(tag, (tag,))
            at = self.last(same)
            if at and at >= self.last(SELF_NESTING[tag]) and at >= self.last(BARRIERS):
                self.cut(at)
        if tag == "body" and self.top.tag == "head":
            self.cut(len(self.nodes) - 1)


class _Tags:
    """Finds tags, forward only. A tag ends at the first ``>`` outside quotes; if there is none, at
    the first one, and from there on quotes are no longer heeded."""

    def __init__(self, page: str):
        self.page, self.quoted, self.last = page, True, page.rfind(">")

    def end(self, at: int) -> int:
        """Where the tag that holds ``at`` ends (the place of its ``>``), or -1."""
        if at > self.last:
            return -1
        if not self.quoted:
            return self.page.find(">", at)
        place = at
        while True:
            match = QUOTE_OR_END.search(self.page, place)
            if match is None:
                break
            if match[0] == ">":
                return match.start()
            closing = self.page.find(match[0], match.end())
            if closing < 0:
                break
            place = closing + 1
        self.quoted = False
        return self.page.find(">", at)


def blocks(page: str) -> list[Block]:
    """The leaf blocks in page order: text between block-level tags, where there is any.

    ``br`` counts as white space. Comments, scripts, styles and the like are left out, without
    ending the block that they stand in. Open paragraphs, list items and cells are ended by
    what can't stand within them.
    """
    out: list[Block] = []
    open_, tags = _Open(), _Tags(page)
    text: list[str] = []
    links = depth = foreign = at = 0
    bang = page.find("--!>")

    def flush() -> None:
        nonlocal links
        if text:
            whole = clean("".join(text))
            if whole:
                out.append(Block(whole, open_.top, links))
            text.clear()
        links = 0

    def add(part: str) -> None:
        nonlocal links
        if part:
            text.append(part)
            if depth:
                links += len(part)

    def after_end_tag(tag: str, start: int) -> tuple[int, int]:
        """Where the element's content ends, and where its end tag does."""
        found = re.compile(rf"</{tag}\b", re.I).search(page, start)
        if not found:
            return len(page), len(page)
        end = page.find(">", found.end())
        return found.start(), end + 1 if end >= 0 else len(page)

    while True:
        begin = page.find("<", at)
        add(page[at : begin if begin >= 0 else len(page)])
        if begin < 0:
            break
        if page.startswith("<!--", begin):
            if 0 <= bang < begin + 4:
                bang = page.find("--!>", begin + 4)
            end = page.find("-->", begin + 2)
            if 0 <= bang and (bang < end or end < 0):
                end = bang + 1
            at = end + 3 if end >= 0 else len(page)
            continue
        if page.startswith(("<!", "<?"), begin):
            end = page.find(">", begin) if begin < tags.last else -1
            if end < 0:
                add("<")
            at = end + 1 if end >= 0 else begin + 1
            continue
        slash = page.startswith("/", begin + 1)
        name = NAME.match(page, begin + 1 + slash)
        end = tags.end(name.end()) if name else -1
        if end < 0:
            add("<")
            at = begin + 1
            continue
        at = end + 1
        tag, attributes = name[0].lower(), page[name.end() : end]
        if tag in RAW and not slash:
            if not attributes.endswith("/"):
                _, at = after_end_tag(tag, at)
            continue
        if tag in FOREIGN:
            foreign = 0 if slash else max(foreign, int(not attributes.endswith("/")))
            continue
        if foreign and tag not in BREAKS:
            continue
        foreign = 0
        if tag in INLINE:
            if tag == "a":
                depth = max(0, depth - 1) if slash else 1
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in RAW:
            continue
        flush()
        depth = 0
        if slash:
            open_.close(tag)
            continue
        open_.make_room(tag)
        if tag in PLAIN:
            stop, after = after_end_tag(tag, at)
            whole = SPACE.sub(" ", page[at:stop]).strip(" ")
            if whole:
                out.append(Block(whole, open_.top, 0))
            at = after
        elif tag not in VOID:
            open_.push(tag, attributes)
    flush()
    return out
