"""Leaf blocks of an HTML page, with the features by which they are told apart."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# Fixed values of HTML: elements whose text is not shown or not prose, elements without an end
# tag, and elements that begin a block of text of their own.
HIDDEN = "script style noscript template textarea select svg annotation-xml annotation iframe object head title".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html label legend li main "
    "menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
# What may stand in a head; anything else ends one that is left open.
IN_HEAD = set("base basefont bgsound head link meta noscript script style template title".split())
LANDMARKS = set("article aside body footer form header main nav section".split())
# An element of the first kind ends where one of the second kind begins.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|(?P<empty><svg(?=[\s/>])[^>]*/>)"
    # A name ends at white space or a mark: "svg-icon" is another element.
    r"|<(?P<hidden>" + "|".join(HIDDEN[:-2]) + r")(?=[\s/>])[^>]*>.*?(?:</(?P=hidden)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/<>\"']*)(?P<attributes>(?:\s[^<>\"']*(?:\"[^\"]*\"|'[^']*'|[^<>\"'])*)?)/?>"
    r"|<[!?/][^>]*>",
    re.IGNORECASE | re.DOTALL,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
WORDS = re.compile(r"[a-z]+")
SENTENCE_ENDS = (".", "!", "?", "…", "。", ":", ";", "”", '"', "»")


@dataclass
class Block:
    """A run of text between block boundaries: its text, the letters of it in links, and the
    features of the elements around it."""

    text: str
    linked: int
    around: frozenset


@dataclass
class _Element:
    tag: str
    around: frozenset
    landmark: str


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order. Text before the body's elements counts, that of the head
    and of hidden elements doesn't; unclosed and stray tags are put up with."""
    found: list[Block] = []
    stack = [_Element("", frozenset(), "")]
    pieces: list[str] = []
    linked = links = at = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                found.append(Block(text, linked, stack[-1].around))
            pieces.clear()
        linked = 0

    for token in TOKEN.finditer(page):
        start = token.start()
        _end_head(stack, "", page[at:start])
        if start > at and not _in_head(stack):
            piece = page[at:start]
            pieces.append(piece)
            if links:
                linked += len(piece.strip())
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            if token["hidden"] or token["empty"]:
                pieces.append(" ")
            continue
        if not token["end"]:
            _end_head(stack, tag, "")
        if tag in BLOCKS:
            flush()
        elif tag == "br":
            pieces.append(" ")
        if token["end"]:
            links = max(0, links - (tag == "a"))
            _close(stack, tag)
        elif tag not in VOID and not (tag == "math" and token[0].endswith("/>")):
            links += tag == "a"
            _open(stack, tag, token["attributes"] or "")
    _end_head(stack, "", page[at:])
    if at < len(page) and not _in_head(stack):
        pieces.append(page[at:])
    flush()
    return found


def _in_head(stack: list[_Element]) -> bool:
    return stack[-1].tag in ("head", "title") or len(stack) > 2 and stack[-2].tag == "head"


def _end_head(stack: list[_Element], tag: str, text: str) -> None:
    """An open head ends at the first element or text that may not stand in it."""
    if stack[-1].tag == "head" and (text.strip() or tag and tag not in IN_HEAD):
        stack.pop()


def _close(stack: list[_Element], tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return


def _open(stack: list[_Element], tag: str, attributes: str) -> None:
    if tag == "body":
        _close(stack, "head")
    if tag in BLOCKS:
        _end_paragraph(stack)
    for open_tag, ended_by in ENDED_BY.items():
        if tag in ended_by and stack[-1].tag == open_tag:
            stack.pop()
    above = stack[-1]
    if tag not in BLOCKS:  # inline elements say nothing about the block
        stack.append(_Element(tag, above.around, above.landmark))
        return
    around, landmark = set(above.around), above.landmark
    around.difference_update([f for f in around if f.startswith("own:")])
    around.update((f"in:{tag}", f"own:{tag}"))
    if tag in LANDMARKS:
        around.discard(f"near:{landmark}")
        around.add(f"near:{tag}")
        if landmark:
            around.add(f"within:{landmark}>{tag}")
        landmark = tag
    for match in NAMES.finditer(attributes):
        for word in WORDS.findall((match[1] or match[2] or match[3] or "").lower()):
            around.add(f"name:{word}")
    stack.append(_Element(tag, frozenset(around), landmark))


def _end_paragraph(stack: list[_Element]) -> None:
    """A paragraph ends where a block begins; so do the inline elements left open in it."""
    i = len(stack) - 1
    while i > 0 and stack[i].tag not in BLOCKS:
        i -= 1
    if stack[i].tag == "p":
        del stack[i:]


def text_features(block: Block) -> list[str]:
    text = block.text
    words = text.count(" ") + 1
    density = block.linked / len(text)
    found = [
        f"words:{min(words.bit_length(), 8)}",
        "links:" + ("none" if not density else "some" if density < 0.5 else "most"),
        "sentence" if text.endswith(SENTENCE_ENDS) else "no sentence",
    ]
    if "©" in text[:200] or "copyright" in text[:200].lower():
        found.append("copyright")
    if "|" in text or "»" in text or "›" in text:
        found.append("separators")
    if words >= 4 and text.count(",") + text.count(".") > 1:
        found.append("punctuated")
    return found
