"""Page cleaning by whole nodes: a tag stream, the node that each tag opens, and rules that see a node's attributes and its whole text.

A page is read once into a list of tags and texts. The texts, trimmed, make up one string, in which every node is a slice; so a rule looks at the start, the
length and the contained marks of a slice, and nested nodes do not copy each other's text. Work is linear in the page.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable

from harvestry.specs import words

#: A comment (an open one takes the rest), or a tag.
TOKEN = re.compile(r"<!--(?:.*?-->|.*)|<(/?)([A-Za-z][\w:-]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"""([\w:-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset("div table ul ol section article".split())
FURNITURE_TAGS = frozenset("p div li span td".split())
HIDING = re.compile(r"(?i)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*;?\s*")
HIDE_CLASS = re.compile(r"(?i)(?<!\S)hide(?!\S)")


class Tag:
    """An opening tag and, once read, its node: last token, slice of the page's text, and what it holds."""

    __slots__ = ("attributes", "end", "frames", "has_block", "high", "low", "name", "page", "raw")

    def __init__(self, raw: str, name: str, inside: str):
        self.raw, self.name, self.has_block, self.frames = raw, name, False, False
        self.attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(inside)} if inside.strip("/ \n\t") else {}

    def get(self, name: str) -> str:
        return " ".join(self.attributes.get(name, "").split())

    def reads(self, *whole: str) -> bool:
        return any(self.high - self.low == len(x) and self.page.text.startswith(x, self.low) for x in whole)

    def starts(self, *beginnings: str) -> bool:
        return any(self.page.lowered.startswith(x.lower(), self.low, self.high) for x in beginnings)

    def holds(self, mark: str) -> bool:
        found = self.page.places(mark.lower())
        at = bisect_left(found, self.low)
        return at < len(found) and found[at] + len(mark) <= self.high


class Page:
    """Tokens of a page: ``Tag`` for an opening tag, (name,) for a closing one, text as it is, comments as ``Comment``."""

    def __init__(self, tokens: list):
        self.tokens, self.found = tokens, {}
        pieces, size, open_, names = [], 0, [], Counter()
        for at, token in enumerate(tokens):
            if isinstance(token, Tag):
                if open_:
                    open_[-1].has_block |= token.name in BLOCKS
                if token.attributes.get("id") == words.POPUP_FRAME_ID:
                    for above in reversed(open_):
                        if above.frames:
                            break
                        above.frames = True
                token.page, token.low, token.high, token.end = self, size, size, at
                if token.name not in VOID and not token.raw.endswith("/>"):
                    open_.append(token)
                    names[token.name] += 1
            elif isinstance(token, Closing):
                while names[token.name]:  # a stray end tag closes nothing
                    last = open_.pop()
                    names[last.name] -= 1
                    last.high, last.end = size, at if last.name == token.name else at - 1
                    if last.name == token.name:
                        break
            elif not isinstance(token, Comment):
                pieces.append(" ".join(token.split()))
                size += len(pieces[-1])
        for left in open_:
            left.high, left.end = size, len(tokens) - 1
        self.text = "".join(pieces)
        lowered = self.text.lower()
        self.lowered = lowered if len(lowered) == size else "".join(c.lower() if len(c.lower()) == 1 else c for c in self.text)

    def places(self, mark: str) -> list[int]:
        """Where the text holds ``mark``; looked up once a page."""
        if mark not in self.found:
            self.found[mark] = [m.start() for m in re.finditer(f"(?={re.escape(mark)})", self.lowered)]
        return self.found[mark]

    def without(self, unwanted: Callable[[Tag], bool]) -> Page:
        """The page without the outermost nodes that the rule names."""
        kept, at = [], 0
        while at < len(self.tokens):
            token = self.tokens[at]
            if isinstance(token, Tag) and unwanted(token):
                at = token.end
            else:
                kept.append(token)
            at += 1
        return Page(kept)


class Closing(str):
    """An end tag; ``name`` is the tag's."""

    name: str


class Comment(str):
    """A comment or another mark-up declaration."""


def read(html: str) -> Page:
    tokens, at = [], 0
    for m in TOKEN.finditer(html):
        if m.start() > at:
            tokens.append(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            tokens.append(Comment(m[0]))
        elif m[1]:
            tokens.append(Closing(m[0]))
            tokens[-1].name = m[2].lower()
        else:
            tokens.append(Tag(m[0], m[2].lower(), m[3]))
    return Page([*tokens, html[at:]] if at < len(html) else tokens)


def is_control(tag: Tag) -> bool:
    """Buttons, the close link, the list entry of changes, and the popup around a known frame."""
    kinds = tag.get("class").split()
    return (tag.get("value") in words.BUTTON_VALUES or (tag.get("onclick").startswith(words.CLOSING_CALL) and tag.reads(words.CLOSING_TEXT))
            or (tag.name == "li" and words.CHANGES_CLASS in kinds and tag.reads(words.CHANGES_TEXT)) or (tag.frames and set(words.POPUP_CLASSES) <= set(kinds)))


def is_file(tag: Tag) -> bool:
    """An anchor to a file, by its address or by its text."""
    return tag.name == "a" and (any(x in tag.get("href").lower() for x in words.FILE_MARKS) or tag.starts(words.FILE_TEXT))


def is_noise(tag: Tag) -> bool:
    """The node's whole text is page furniture and holds no keep-marker."""
    if tag.low == tag.high or any(map(tag.holds, words.KEEP_TEXT_MARKERS)):
        return False
    return (tag.starts(words.NOISE_BREADCRUMB, *words.NOISE_PREFIXES) or tag.reads(*words.NOISE_EXACT_TEXTS) or tag.holds(words.NOISE_HELP_PATH)
            or (tag.starts("http") and tag.holds(words.NOISE_LOGIN_PATH)))


def is_furniture(tag: Tag) -> bool:
    """A node of nothing but furniture, without blocks of its own."""
    return tag.name in FURNITURE_TAGS and not tag.has_block and (is_noise(tag) or tag.starts(words.GREETING))


def shown(tag: Tag) -> str:
    """The tag without what hides it, where its node has text that is no furniture."""
    a = tag.attributes
    if tag.low == tag.high or not ("hidden" in a or "style" in a or "hide" in a.get("class", "").lower().split()) or is_noise(tag):
        return tag.raw
    style = HIDING.sub(" ", a["style"]).strip(" ;") if "style" in a else ""
    kept = a | {k: v for k, v in (("style", style), ("class", HIDE_CLASS.sub("", a.get("class", "")))) if k in a}
    kept.pop("hidden", None)
    return f"<{tag.name}" + "".join(f' {k}="{v}"' for k, v in kept.items() if v.strip() or k not in ("style", "class")) + ">"


def clean_page(html: str) -> str:
    """Controls, file anchors and furniture out as whole nodes, other anchors unwrapped, hidden text shown."""
    page = read(html)
    page = Page([t for t in page.tokens if not (isinstance(t, Comment) and words.CLOSING_TEXT in t)])
    page = page.without(is_control).without(is_file)
    page = Page([t for t in page.tokens if not (isinstance(t, (Tag, Closing)) and t.name == "a")]).without(is_furniture)
    return "".join(shown(t) if isinstance(t, Tag) else t for t in page.tokens).strip()
