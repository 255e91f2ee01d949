"""Leaf blocks of HTML pages with their ancestors, and the features a labeller sees (plain Python, per page)."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+>|[^>]*>|[^<]*\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|data-main)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# How HTML elements behave.
RAW = frozenset("script style template noscript iframe svg head title textarea select".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody "
    "td tfoot th thead tr ul video audio".split()
)
#: A start tag closes an open element of these kinds, looked for up to the elements that hold them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
SECTIONS = frozenset("article main nav header footer aside form section".split())
#: Words in class, id and role by what they hint at.
HINTS = {
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toc",
    "head": "header masthead top topbar banner logo branding tagline",
    "foot": "footer foot bottom copyright colophon contentinfo legal imprint",
    "side": "sidebar side aside widget complementary rail column",
    "ad": "ad ads adv advert adverts advertisement sponsor sponsored promo promotion promoted banner",
    "notice": "notice cookie cookies consent gdpr alert warning popup modal overlay toast message",
    "form": "form login signup signin subscribe subscription newsletter search contact",
    "comment": "comment comments reply replies discussion disqus respond reader",
    "share": "share sharing social follow tags tag related recommended more also popular trending",
    "main": "content article post entry story main text body page prose",
}
_HINT_OF: dict[str, list[str]] = {}
for _name, _words in HINTS.items():
    for _word in _words.split():
        _HINT_OF.setdefault(_word, []).append(_name)


@dataclass(slots=True)
class Element:
    tag: str
    hints: frozenset
    main: bool


@dataclass(slots=True)
class Block:
    text: str
    path: list
    link_chars: int = 0
    n_chars: int = 0
    labelled: bool = field(default=False)


def _element(tag: str, rest: str) -> Element:
    if "=" not in rest:
        return Element(tag, frozenset(), False)
    hints, main = set(), False
    for m in _ATTRIBUTE.finditer(rest):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "data-main":
            main = True
            continue
        for word in _TOKEN.findall(value):
            hints.update(_HINT_OF.get(word.lower(), ()))
    return Element(tag, frozenset(hints), main)


def blocks(html: str | None) -> list[Block]:
    """Leaf blocks in page order: runs of text between the borders of block elements, white space as one
    space, character references decoded; blank ones are left out. Elements that show no text of the page
    are skipped; unclosed and stray tags are met as browsers do in the usual cases."""
    html = html or ""
    stack: list[Element] = []
    out: list[Block] = []
    parts: list[str] = []
    held: list[Element] = []
    links = chars = depth = 0

    def close() -> None:
        nonlocal parts, links, chars
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, held, links, max(1, chars), any(e.main for e in held)))
            parts, links, chars = [], 0, 0

    def add(raw: str) -> None:
        nonlocal held, links, chars
        text = unescape(raw) if "&" in raw else raw
        if not parts or not held and stack:
            held = list(stack)
        parts.append(text)
        n = len(text.strip())
        chars += n
        if depth:
            links += n

    def pop_to(i: int) -> None:
        nonlocal depth
        for e in stack[i:]:
            depth -= e.tag == "a"
        del stack[i:]

    at = 0
    while True:
        m = _TAG.search(html, at)
        if m is None:
            add(html[at:])
            break
        if m.start() > at:
            add(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        block = tag in BLOCK
        if m[1]:
            if block:
                close()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    pop_to(i)
                    break
                if not block and stack[i].tag in BLOCK:
                    break
            continue
        if tag == "br":
            parts.append("\n") if parts else None
            continue
        if block:
            close()
            for i in range(len(stack) - 1, -1, -1):  # an open paragraph ends here
                if stack[i].tag == "p":
                    pop_to(i)
                    break
                if stack[i].tag in BLOCK:
                    break
            if tag in CLOSES:
                ends, holders = CLOSES[tag]
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i].tag in holders:
                        break
                    if stack[i].tag in ends:
                        pop_to(i)
                        break
        if tag in VOID or m[3].endswith("/>") and tag not in BLOCK:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
            # An unclosed head ends where the body begins; anything else at the end of the page.
            body = re.compile(r"<body\b", re.I).search(html, at) if tag == "head" else None
            if body and (end is None or body.start() < end.start()):
                at = body.start()
            else:
                at = end.end() if end else len(html)
            continue
        stack.append(_element(tag, m[3]))
        depth += tag == "a"
    close()
    return out


def features(page: list[Block]) -> list[list[str]]:
    """Names of the features that hold for each block."""
    out = []
    n = len(page)
    for i, b in enumerate(page):
        path = b.path
        tags = [e.tag for e in path]
        nearest = next((t for t in reversed(tags) if t in BLOCK), "none")
        section = next((t for t in reversed(tags) if t in SECTIONS), "none")
        f = ["bias", f"tag={nearest}", f"section={section}"]
        f += [f"in={t}" for t in {t for t in tags if t in SECTIONS or t in ("ul", "ol", "table", "figure", "dl")}]
        hints = frozenset().union(*[e.hints for e in path]) if path else frozenset()
        f += [f"hint={h}" for h in hints] or ["hint=none"]
        # The hint that stands nearest: a comment inside the content is a comment.
        near = next((e.hints for e in reversed(path) if e.hints), frozenset())
        f += [f"near={h}" for h in near]
        words = b.text.count(" ") + 1
        f.append("words=" + ("1" if words < 3 else "3" if words < 8 else "8" if words < 20 else "20" if words < 50 else "50"))
        links = b.link_chars / b.n_chars
        f.append("links=" + ("0" if links == 0 else "some" if links < 0.5 else "most" if links < 0.9 else "all"))
        last = b.text.rstrip("\"'”’)»")[-1:]
        f.append("stop" if last in ".!?…。！？" else "nostop")
        if b.text.count(",") > 1:
            f.append("commas")
        if "©" in b.text:
            f.append("mark")
        f.append("place=" + ("first" if i == 0 else "early" if i < n * 0.15 else "last" if i == n - 1 else "late" if i > n * 0.85 else "mid"))
        f.append(f"{nearest}&{section}")
        out.append(f)
    return out
