"""A small tolerant reader of HTML: a tree of elements and texts."""

from __future__ import annotations

import re
from html import unescape

# Element kinds of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|svg|iframe|object|textarea|math|xmp|noembed|noframes"
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section select "
    "summary table tbody td tfoot th thead title tr ul button option optgroup search".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: An opening tag on the left ends an open element on the right, unless one of SCOPE comes between.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
ENDS |= {"td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "body": {"head"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
SCOPE |= dict.fromkeys(("tr", "td", "th", "tbody"), {"table"})
ENDS_P = BLOCK - {"button", "caption", "html", "head", "body", "legend", "option", "optgroup", "select", "title"}
ENDS_P -= {"tbody", "td", "tfoot", "th", "thead", "tr"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:svg|math)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*(?<=/)>"
    rf"|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Elements nested deeper than this are taken as texts of the element around them.
DEPTH = 200


class Element:
    __slots__ = ("tag", "names", "inside", "drop")

    def __init__(self, tag: str, names: tuple[str, ...] = ()):
        self.tag, self.names, self.inside, self.drop = tag, names, [], False


def _names(attributes: str) -> tuple[str, ...]:
    """Words of class, id and role, in lower case; digits part them."""
    if "=" not in attributes:
        return ()
    found = (a or b or c for _, a, b, c in ATTRIBUTE.findall(attributes))
    return tuple(sorted({word.lower() for value in found for word in NAME.findall(value)}))


def _close(open_: list[Element], ended: set[str], scope: set[str]) -> None:
    """Close up to the innermost open element of ``ended``, if no element of ``scope`` is in between."""
    for k in range(len(open_) - 1, 0, -1):
        if open_[k].tag in ended:
            del open_[k:]
            return
        if open_[k].tag in scope:
            return


P_SCOPE = {"button", "td", "th", "caption", "table", "object"}


def parse(html: str) -> Element:
    """The tree of a whole page; broken markup gives some tree, never an error."""
    root, at = Element("#root"), 0
    open_ = [root]
    for token in TOKEN.finditer(html):
        if token.start() > at:
            text = html[at : token.start()]
            open_[-1].inside.append(unescape(text) if "&" in text else text)
        at, tag = token.end(), token[3]
        if not tag:
            continue
        tag = tag.lower()
        if token[2]:
            if tag == "br":
                open_[-1].inside.append(Element("br"))
            else:
                _close(open_, {tag}, set() if tag in BLOCK else BLOCK - {"p"})
            continue
        if tag in ENDS_P:
            _close(open_, {"p"}, P_SCOPE)
        if tag in ENDS:
            for _ in ENDS[tag]:
                _close(open_, ENDS[tag], SCOPE.get(tag, set()))
        new = Element(tag, _names(token[4]))
        open_[-1].inside.append(new)
        if tag not in VOID and not token[4].rstrip().endswith("/") and len(open_) < DEPTH:
            open_.append(new)
    if at < len(html):
        open_[-1].inside.append(unescape(html[at:]))
    return root


def blocks(top: Element, keep=lambda element: not element.drop) -> list[str]:
    """The texts of the blocks below ``top``, white space made single and trimmed, empty ones left out."""
    found, run, work = [], [], [top]

    def flush():
        if run:
            text = " ".join("".join(run).split())
            if text:
                found.append(text)
            run.clear()

    while work:
        one = work.pop()
        if one is None:
            flush()
        elif isinstance(one, str):
            run.append(one)
        elif keep(one):
            if one.tag == "br":
                run.append(" ")
            elif one.tag in BLOCK:
                flush()
                work.append(None)
            work.extend(reversed(one.inside))
    flush()
    return found
