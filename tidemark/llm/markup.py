"""HTML, Markdown, wiki and LaTeX texts to clean text with their structure kept.

A text is cut into flat blocks, each with its markup cue, word count, link density and those of its
neighbours; a decision tree trained on the small table BLOCKS names each block's role. Whatever the
role, the block's text is kept.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.encoding import CHAINS, garble
from tidemark.llm.tree import Tree
from tidemark.runtime import spread

CUES = ("none", "heading", "item", "bullet", "code", "formula", "cell")
#: Labelled blocks: cue, words, link density, words of the block before and after, link density of the block before and after, role.
#: `label` is a short line that stands over what follows without being marked as a heading, `nav` and
#: `nav_item` are links among links, `table` is a cell of a grid of short values.
BLOCKS = [
    ("heading", 2, 0.0, 40, 30, 0.0, 0.0, "heading"), ("heading", 3, 0.0, 0, 12, 0.0, 0.0, "heading"), ("heading", 4, 0.0, 9, 8, 0.1, 0.0, "heading"), ("heading", 1, 0.0, 25, 0, 0.0, 0.0, "heading"),
    ("heading", 2, 1.0, 14, 33, 0.0, 0.1, "heading"), ("heading", 12, 0.0, 30, 30, 0.0, 0.0, "heading"), ("heading", 3, 1.0, 2, 2, 1.0, 1.0, "heading"), ("heading", 0, 0.0, 20, 20, 0.0, 0.0, "empty"), ("heading", 0, 0.0, 0, 3, 0.0, 0.0, "empty"),
    ("item", 9, 0.0, 2, 12, 0.0, 0.0, "item"), ("item", 14, 0.1, 9, 10, 0.0, 0.1, "item"), ("item", 3, 1.0, 14, 12, 0.0, 0.0, "item"), ("item", 3, 1.0, 4, 4, 0.0, 0.0, "item"), ("item", 2, 1.0, 5, 9, 0.0, 0.0, "item"), ("item", 30, 0.0, 12, 0, 0.0, 0.0, "item"), ("item", 2, 0.0, 2, 2, 0.0, 0.0, "item"), ("item", 5, 0.2, 3, 3, 1.0, 1.0, "item"),
    ("item", 1, 1.0, 1, 2, 1.0, 1.0, "nav_item"), ("item", 2, 1.0, 0, 3, 0.0, 1.0, "nav_item"), ("item", 3, 1.0, 2, 30, 1.0, 0.0, "nav_item"), ("item", 4, 0.9, 3, 2, 0.9, 1.0, "nav_item"), ("item", 0, 0.0, 8, 8, 0.0, 0.0, "empty"), ("item", 0, 0.0, 2, 2, 0.0, 0.0, "empty"),
    ("bullet", 8, 0.0, 2, 9, 0.0, 0.0, "item"), ("bullet", 15, 0.1, 8, 9, 0.1, 0.0, "item"), ("bullet", 1, 0.0, 6, 2, 0.0, 0.0, "item"), ("bullet", 2, 1.0, 2, 2, 1.0, 1.0, "nav_item"), ("bullet", 0, 0.0, 5, 5, 0.0, 0.0, "empty"),
    ("code", 12, 0.0, 20, 20, 0.0, 0.0, "code"), ("code", 40, 0.0, 2, 3, 0.0, 0.0, "code"), ("code", 3, 0.0, 30, 4, 0.0, 0.0, "code"), ("code", 0, 0.0, 20, 20, 0.0, 0.0, "empty"),
    ("formula", 5, 0.0, 20, 2, 0.0, 0.0, "formula"), ("formula", 1, 0.0, 4, 5, 0.0, 0.0, "formula"), ("formula", 9, 0.0, 0, 0, 0.0, 0.0, "formula"), ("formula", 0, 0.0, 6, 6, 0.0, 0.0, "empty"),
    ("cell", 1, 0.0, 2, 2, 0.0, 0.0, "table"), ("cell", 2, 0.0, 1, 3, 0.0, 0.0, "table"), ("cell", 5, 0.0, 4, 4, 0.0, 0.0, "table"), ("cell", 40, 0.0, 2, 60, 0.0, 0.1, "text"), ("cell", 25, 0.1, 30, 2, 0.0, 0.0, "text"), ("cell", 0, 0.0, 2, 2, 0.0, 0.0, "empty"),
    ("none", 40, 0.05, 2, 3, 0.0, 0.0, "text"), ("none", 12, 0.0, 3, 9, 0.0, 0.0, "text"), ("none", 90, 0.0, 0, 0, 0.0, 0.0, "text"), ("none", 24, 0.2, 1, 25, 1.0, 0.0, "text"), ("none", 4, 1.0, 40, 30, 0.0, 0.0, "text"), ("none", 13, 0.0, 2, 2, 1.0, 0.0, "text"), ("none", 20, 0.0, 30, 2, 0.0, 1.0, "text"), ("none", 6, 0.0, 1, 1, 1.0, 1.0, "text"), ("none", 9, 0.3, 2, 3, 1.0, 1.0, "text"), ("none", 3, 0.7, 13, 2, 0.0, 1.0, "text"), ("none", 3, 0.7, 20, 13, 0.0, 0.0, "text"), ("none", 4, 1.0, 12, 14, 0.0, 0.0, "text"), ("none", 2, 1.0, 3, 4, 0.0, 0.0, "text"), ("none", 3, 0.5, 33, 0, 0.0, 0.0, "text"), ("none", 5, 0.0, 30, 0, 0.0, 0.0, "text"), ("none", 6, 0.0, 2, 2, 0.0, 0.0, "text"), ("none", 3, 0.0, 12, 1, 0.0, 0.0, "text"), ("none", 0, 0.0, 10, 10, 0.0, 0.0, "empty"),
    ("none", 2, 0.0, 30, 12, 0.0, 0.0, "label"), ("none", 3, 0.0, 22, 40, 0.0, 0.1, "label"), ("none", 1, 0.0, 0, 18, 0.0, 0.0, "label"), ("none", 4, 0.0, 45, 9, 0.1, 0.0, "label"),
    ("none", 1, 1.0, 2, 1, 1.0, 1.0, "nav"), ("none", 2, 1.0, 0, 2, 0.0, 1.0, "nav"), ("none", 3, 1.0, 3, 40, 1.0, 0.0, "nav"), ("none", 8, 0.9, 4, 2, 1.0, 0.9, "nav"), ("none", 2, 1.0, 1, 13, 1.0, 0.0, "nav"), ("none", 1, 1.0, 0, 1, 0.0, 1.0, "nav"), ("none", 1, 1.0, 1, 2, 1.0, 1.0, "nav"), ("none", 2, 0.8, 2, 2, 0.7, 1.0, "nav"),
]

TAGS = (
    "a|abbr|article|aside|b|big|blockquote|body|br|caption|center|cite|code|col|colgroup|dd|del|details|div|dl|dt|em|figcaption|figure|font|footer|form|h[1-6]|head|header|hr|html|i|img|input|ins|kbd|label|li|link"
    "|main|mark|meta|nav|noscript|ol|option|p|pre|q|s|samp|script|section|select|small|span|strike|strong|style|sub|summary|sup|svg|table|tbody|td|template|textarea|tfoot|th|thead|title|tr|tt|u|ul|var|video|iframe|button"
)
TAG = re.compile(rf"<(/?)({TAGS})\b((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>", re.I)
BLOCK_TAG = re.compile(r"<(?:p|div|li|ul|ol|h[1-6]|table|tr|td|pre|blockquote|section|article|html|body|script|style|noscript|dl|span)\b[^<>]*>", re.I)
ESCAPED = re.compile(rf"&lt;/?(?:{TAGS})\b", re.I)
COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<!DOCTYPE[^>]*>|<\?xml[^>]*>", re.S | re.I)
UNSEEN = re.compile(r"<(script|style|noscript|template|head)\b[^<>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
MATH_TAG = re.compile(r"<math\b[^<>]*>(.*?)</math\s*>", re.S | re.I)
TEX = r"\\\[(?P<b>.+?)\\\]|\\\((?P<p>.+?)\\\)|\$\$(?P<d>.+?)\$\$"
DOLLAR = r"(?<![\\$\w])\$(?P<s>(?![\s\d$])[^$\n]*?[^\s$\\])\$(?![\d$])"
FORMULA = re.compile(TEX, re.S)
FORMULA_DOLLAR = re.compile(f"{TEX}|{DOLLAR}", re.S)
#: Bullet signs, as they are and as a wrong decoding leaves them.
SIGNS = "•·◦▪●‣∙■"
SIGN = "|".join(map(re.escape, sorted({*SIGNS, *(g for s in "•" for g in (garble(s, chain) for chain in CHAINS) if g)}, key=lambda x: (-len(x), x))))
BULLET = re.compile(rf"\s*(?:{SIGN})")
BULLET_LINE = re.compile(rf"\n(?=[ \t]*(?:{SIGN}))")
LEVELS = {"p", "div", "li", "ul", "ol", "table", "tr", "td", "th", "pre", "blockquote", "section", "article", "br", "hr", "dl", "dt", "dd", "header", "footer", "main", "tbody", "thead", "h1", "h2", "h3", "h4", "h5", "h6"}
LATEX = re.compile(r"\\(?:begin|end|section|subsection|subsubsection|paragraph|textbf|textit|texttt|emph|item|href|noindent|documentclass|usepackage|underline|url)\b")
WIKI = re.compile(r"(?m)^={2,6}[^=\n].*?={2,6}\s*$|'''?[^'\n]+'''?|\[\[(?!field:)[^\[\]\n]+\]\]|\[https?://\S+ [^\]\n]+\]|^\{\||<syntaxhighlight\b|<math>|^\|-\s*$|<source\b|<nowiki>")
MARKDOWN = re.compile(
    r"(?m)^ {0,3}#{1,6}\s+\S|^[^\n]*\S[^\n]*\n {0,3}(?:={3,}|-{3,})\s*$|(?<!\\)!?\[[^\[\]\n]+\]\([^()\s]+[^()\n]*\)|^\s*(?:```|~~~)|^\s*[*+-]\s+\S|^\s*\d{1,3}[.)]\s+\S|\*\*[^*\s][^*\n]*\*\*|(?<!\w)__(?![A-Z_]+__)[^_\s][^_\n]*__(?!\w)"
    r"|(?<![*\w])\*[^*\s](?:[^*\n]*[^*\s])?\*(?![*\w])|(?<!`)`[^`\n]+`(?!`)|^\s*\|?(?:\s*:?-{3,}:?\s*\|)+|^\s*(?:\*\s*){3,}$|^>\s+\S|(?<!\w)_(?![A-Z_]+_)[^_\s][^_\n]*_(?!\w)"
)
LINK = "\x01"  # stands before and after the words of a link


def kind_of(text: str) -> str | None:
    """The markup a text carries: html, latex, wiki or markdown, or none."""
    if BLOCK_TAG.search(text):
        return "wiki" if WIKI.search(text) and "<syntaxhighlight" in text and not re.search(r"<(?:p|li|div)\b", text) else "html"
    if LATEX.search(text):
        return "latex"
    if re.search(r"(?m)^={2,6}[^=\n].*?={2,6}\s*$|'''|\[\[(?!field:)[^\[\]\n]+\]\]|\[https?://\S+ [^\]\n]+\]|^\{\||<syntaxhighlight\b|<math>", text):
        return "wiki"
    if MARKDOWN.search(text) or FORMULA_DOLLAR.search(text):
        return "markdown"
    if WIKI.search(text):
        return "wiki"
    return "html" if TAG.search(text) or COMMENT.search(text) else None


class Blocks:
    """Flat blocks in their order: (cue, text with its links marked)."""

    def __init__(self):
        self.out: list[tuple[str, str]] = []

    def add(self, cue: str, text: str) -> None:
        self.out.append((cue, text))


def formulas_in(text: str, cue: str, blocks: Blocks, pattern: re.Pattern) -> None:
    """The text as blocks, its formulas as blocks of their own; the cue stays with the first part."""
    at = 0
    for m in pattern.finditer(text):
        if m.start() > at or cue in ("item", "heading"):
            blocks.add(cue, text[at : m.start()] or "")
            cue = "none"
        blocks.add("formula", next(g for g in m.groups() if g is not None))
        at = m.end()
    if at < len(text) or not at:
        blocks.add(cue, text[at:])


def from_html(text: str, blocks: Blocks) -> None:
    text = UNSEEN.sub(" ", COMMENT.sub(" ", text))
    text = MATH_TAG.sub(lambda m: "$$" + re.sub(r"<[^<>]+>", " ", m.group(1)) + "$$", text)
    cue, buf, at, code = "none", [], 0, 0

    def flush() -> None:
        nonlocal cue
        whole = "".join(buf)
        buf.clear()
        if cue == "heading" or cue == "item" or whole.strip():
            for i, line in enumerate(BULLET_LINE.split(html.unescape(whole))):
                formulas_in(line, cue if i == 0 and cue != "none" else "bullet" if BULLET.match(line) else "none", blocks, FORMULA)
        cue = "none"

    for m in TAG.finditer(text):
        buf.append(text[at : m.start()])
        at = m.end()
        name, closing = m.group(2).lower(), m.group(1)
        if name == "pre":
            if not closing and not code:
                flush()
                code = 1
            elif closing and code:
                blocks.add("code", html.unescape("".join(buf)))
                buf.clear()
                code = 0
        elif code:
            continue
        elif name == "a":
            buf.append(LINK)
        elif name in LEVELS:
            flush()
            if not closing:
                cue = "heading" if name[0] == "h" and name[1:].isdigit() else "item" if name == "li" else "cell" if name in ("td", "th") else "none"
    buf.append(text[at:])
    if code:
        blocks.add("code", html.unescape("".join(buf)))
    else:
        flush()


def loose(text: str) -> str:
    """A line of another markup without stray HTML tags, entities resolved."""
    return html.unescape(TAG.sub("", text)) if "<" in text or "&" in text else text


def md_inline(t: str) -> str:
    t = re.sub(r"!?\[([^\[\]\n]*)\]\((?:[^()\s]|\([^()\s]*\))*(?:\s+(?:\"[^\"]*\"|'[^']*'))?\)", rf"{LINK}\1{LINK}", t)
    t = re.sub(r"\[([^\[\]\n]+)\]\[[^\[\]\n]*\]", rf"{LINK}\1{LINK}", t)
    t = re.sub(r"<((?:https?|mailto):[^<>\s]+)>", " ", t)
    return loose(t)


def from_markdown(text: str, blocks: Blocks) -> None:
    text = UNSEEN.sub(" ", COMMENT.sub(" ", text))
    lines = text.split("\n")
    i, para = 0, []

    def flush() -> None:
        if para:
            formulas_in(md_inline("\n".join(para)), "none", blocks, FORMULA_DOLLAR)
            para.clear()

    while i < len(lines):
        line = lines[i].rstrip("\r")
        s = line.strip()
        fence = re.match(r"(`{3,}|~{3,})", s)
        if fence:
            flush()
            j = i + 1
            while j < len(lines) and not lines[j].strip().startswith(fence.group(1)):
                j += 1
            blocks.add("code", "\n".join(lines[i + 1 : j]))
            i = j + 1
            continue
        if s.startswith("$$") and not s[2:].rstrip().endswith("$$"):
            j = i + 1
            while j < len(lines) and "$$" not in lines[j]:
                j += 1
            if j < len(lines):
                para.append("\n".join(lines[i : j + 1]))
                i = j + 1
                continue
        head = re.match(r" {0,3}#{1,6}\s+(.*?)\s*#*\s*$", line)
        item = re.match(r"\s*(?:[*+-]|\d{1,3}[.)])\s+(.*)$", line)
        nxt = lines[i + 1].strip() if i + 1 < len(lines) else ""
        if head:
            flush()
            formulas_in(md_inline(head.group(1)), "heading", blocks, FORMULA_DOLLAR)
        elif s and not item and not para and re.fullmatch(r"={3,}|-{3,}", nxt) and "|" not in s:
            formulas_in(md_inline(s), "heading", blocks, FORMULA_DOLLAR)
            i += 1
        elif re.fullmatch(r"(?:\*\s*){3,}|(?:-\s*){3,}|(?:_\s*){3,}", s):
            flush()
        elif item:
            flush()
            formulas_in(md_inline(re.sub(r"^\[[ xX]\]\s+", "", item.group(1))), "item", blocks, FORMULA_DOLLAR)
        elif re.match(r"\[[^\]]+\]:\s*\S+", s):
            flush()
        elif s.count("|") >= 2 or (s.startswith("|") and "|" in s):
            flush()
            if not re.fullmatch(r"\|?(?:\s*:?-{2,}:?\s*\|?)+", s):
                for cell in s.strip("|").split("|"):
                    formulas_in(md_inline(cell), "cell", blocks, FORMULA_DOLLAR)
        elif not s:
            flush()
        else:
            para.append(re.sub(r"^>\s?", "", s))
        i += 1
    flush()


def wiki_inline(t: str) -> str:
    t = re.sub(r"\[\[(?:File|Image|Category|Datei|Kategorie):[^\[\]]*\]\]", " ", t)
    t = re.sub(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]|\n]+)\]\]", rf"{LINK}\1{LINK}", t)
    t = re.sub(r"\[(?:https?|mailto|ftp):[^\s\]]+(?:\s+([^\]\n]*))?\]", lambda m: LINK + (m.group(1) or "") + LINK, t)
    t = re.sub(r"</?(?:nowiki|ref|references|small|big)\b[^<>]*>", "", t)
    return loose(re.sub(r"'{2,}", "", t))


def from_wiki(text: str, blocks: Blocks) -> None:
    text = UNSEEN.sub(" ", COMMENT.sub(" ", text))
    text = re.sub(r"<math\b[^<>]*>(.*?)</math\s*>", lambda m: "\\(" + m.group(1).replace("\n", " ") + "\\)", text, flags=re.S)
    for k, part in enumerate(re.split(r"<(?:syntaxhighlight|source|pre)\b[^<>]*>(.*?)(?:</(?:syntaxhighlight|source|pre)\s*>|\Z)", text, flags=re.S)):
        if k % 2:
            blocks.add("code", part)
            continue
        for line in part.split("\n"):
            s = line.strip()
            if not s or s.startswith(("{|", "|}", "|-", "|+")) and not s.startswith("|+ "):
                continue
            head = re.match(r"(={1,6})\s*([^=].*?)\s*\1\s*$", s)
            item = re.match(r"[*#:;]+\s+(.*)$", s)
            if head:
                formulas_in(wiki_inline(head.group(2)), "heading", blocks, FORMULA)
            elif item:
                formulas_in(wiki_inline(item.group(1)), "item" if s[0] in "*#" else "none", blocks, FORMULA)
            elif s[0] in "|!":
                for cell in re.split(r"\|\||!!", s[1:]):
                    formulas_in(wiki_inline(re.sub(r"^[^|\[\]]*=[^|\[\]]*\|(?!\|)", "", cell)), "cell", blocks, FORMULA)
            else:
                formulas_in(wiki_inline(s), "none", blocks, FORMULA)


CODE_ENV = re.compile(r"\\begin\{(verbatim|lstlisting|minted|Verbatim)\*?\}(?:\[[^\]\n]*\])?(?:\{[^}\n]*\})?(.*?)(?:\\end\{\1\*?\}|\Z)", re.S)
MATH_ENV = re.compile(r"\\begin\{(equation|align|displaymath|math|gather|eqnarray|multline)\*?\}(.*?)\\end\{\1\*?\}", re.S)


def from_latex(text: str, blocks: Blocks) -> None:
    for k, part in enumerate(CODE_ENV.split(text)):
        if k % 3 == 1:
            continue
        if k % 3 == 2:
            blocks.add("code", part)
            continue
        part = COMMENT.sub(" ", part)
        part = re.sub(r"(?<!\\)%.*", "", part)
        part = MATH_ENV.sub(lambda m: "\\[" + m.group(2) + "\\]", part)
        part = part.replace("\\\\", "\n")
        cut = re.split(r"(\\(?:sub)*(?:section|paragraph|chapter)\*?(?:\[[^\]]*\])?\{(?:[^{}]|\{[^{}]*\})*\}|\\item\b(?:\[[^\]]*\])?|\n\s*\n|\\(?:begin|end)\{\w+\*?\}(?:\[[^\]]*\])?(?:\{[lcr|p ]*\})?)", part)
        cue = "none"
        for piece in cut:
            if piece.startswith(("\\begin{", "\\end{")):
                cue = "none"
            elif piece.startswith("\\item") and not re.match(r"\\item[a-z]", piece):
                cue = "item"
                blocks.add("item", " ")
                label = re.match(r"\\item\[([^\]]*)\]", piece)
                if label:
                    blocks.add("none", tex_inline(label.group(1)))
                cue = "none"
            elif re.match(r"\\(?:sub)*(?:section|paragraph|chapter)", piece):
                formulas_in_tex(piece[piece.index("{") + 1 : -1], "heading", blocks)
                cue = "none"
            elif piece.strip():
                formulas_in_tex(piece, cue, blocks)


def formulas_in_tex(text: str, cue: str, blocks: Blocks) -> None:
    parts = Blocks()
    formulas_in(text, cue, parts, FORMULA_DOLLAR)
    for c, t in parts.out:
        blocks.add(c, t if c == "formula" else tex_inline(t))


def tex_inline(t: str) -> str:
    t = re.sub(r"\\href\{[^{}]*\}\{((?:[^{}]|\{[^{}]*\})*)\}", rf"{LINK}\1{LINK}", t)
    t = re.sub(r"\\(?:url|label|ref|cite|input|include|usepackage|documentclass|vspace|hspace|includegraphics)\*?(?:\[[^\]]*\])?\{[^{}]*\}", " ", t)
    t = re.sub(r"\\([_%$&#{}])", "\x02\\1", t)
    t = re.sub(r"\\[a-zA-Z]+\*?(?:\[[^\]\n]*\])?", " ", t)
    return loose(re.sub(r"(?<!\x02)[{}]", "", t).replace("\x02", "").replace("~", " "))


PARSERS = {"html": from_html, "markdown": from_markdown, "wiki": from_wiki, "latex": from_latex}
WORD = re.compile(r"\w+")


@lru_cache(1)
def role_tree() -> Tree:
    return Tree(max_depth=12).fit([features(*b[:-1]) for b in BLOCKS], [b[-1] for b in BLOCKS])


#: The features of a block, in the order of `features`.
FEATURES = (*CUES, "words", "density", "words_before", "words_after", "density_before", "density_after")


def features(cue: str, words: int, density: float, before: int, after: int, density_before: float, density_after: float) -> list[float]:
    return [float(cue == c) for c in CUES] + [words, density, before, after, density_before, density_after]


@lru_cache(1 << 16)
def role_of(cue: str, words: int, tenths: int, before: int, after: int, tenths_before: int, tenths_after: int) -> str:
    return role_tree().label(features(cue, words, tenths / 10, before, after, tenths_before / 10, tenths_after / 10))


def parse(text: str) -> tuple[str, list[tuple[str, str]]] | None:
    """(markup, [(role, clean text)]) of a text, or None where it carries no markup."""
    if not TAG.search(text) and ESCAPED.search(text):
        text = html.unescape(text)
    kind = kind_of(text)
    if kind is None:
        return None
    blocks = Blocks()
    PARSERS[kind](text.replace("\r\n", "\n"), blocks)
    raw = blocks.out
    counts, linked = [], []
    for i, (cue, t) in enumerate(raw):
        n = len(WORD.findall(t))
        if cue in ("item", "heading") and not n and i + 1 < len(raw) and raw[i + 1][0] in ("none", "formula"):
            n = 1  # its text is in the next block
        counts.append(n)
        linked.append(sum(len(WORD.findall(x)) for x in t.split(LINK)[1::2]) if LINK in t else 0)
    tenths = [0, *(round(10 * min(1.0, k / n)) if n else 0 for k, n in zip(linked, counts, strict=True)), 0]
    words = [0, *(min(n, 50) for n in counts), 0]
    roles = [role_of(cue, min(counts[i], 100), tenths[i + 1], words[i], words[i + 2], tenths[i], tenths[i + 2]) for i, (cue, _) in enumerate(raw)]
    return kind, [(role, t.replace(LINK, "")) for role, (_, t) in zip(roles, raw, strict=True)]


def summary(text: str) -> tuple | None:
    """(markup, clean text, headings, items, code blocks, formulas, labels, links of navigation) or None."""
    got = parse(text)
    if got is None:
        return None
    kind, blocks = got
    n = Counter(r for r, _ in blocks)
    clean = "\n".join(t for _, t in blocks)
    return kind, clean, n["heading"], n["item"] + n["nav_item"], n["code"], n["formula"], n["label"], n["nav"] + n["nav_item"]


NOT_LETTERS = re.compile("[^A-Za-z0-9]+")


def letters_digest(clean: str) -> str:
    return hashlib.md5(NOT_LETTERS.sub("", clean).encode()).hexdigest()[:16]


def convert(rows: DataFrame, text_col: str = "description_html", id_col: str = "row_id", keep_text: bool = True) -> DataFrame:
    """(row_id, markup, n_headings, n_items, n_code, n_formulas, n_labels, n_nav, letters_md5[, text]) of each text with markup.

    Blocks come out in order, a line each in `text`; headings, list entries without their numbers,
    table cells, code and the source of formulas are kept, tags, attributes, link targets, commands,
    comments, scripts and styles are not. `n_labels` counts short lines that stand over what follows
    without being marked as headings, `n_nav` the blocks that are links among links. Null and empty texts and texts without markup give no row.
    Whole texts are read, however long; damaged markup is read as far as it goes. Repeated rows give
    repeated results; other columns don't matter.
    """
    fields = f"{id_col} bigint, markup string, n_headings int, n_items int, n_code int, n_formulas int, n_labels int, n_nav int, letters_md5 string" + ", text string" * keep_text

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in fields.split(", ")]
        for pdf in batches:
            out = []
            for i, text in zip(pdf[id_col], pdf[text_col], strict=True):
                s = summary(text)
                if s:
                    out.append((i, s[0], *s[2:], letters_digest(s[1]), s[1])[: len(names)])
            yield pd.DataFrame(out, columns=names)

    return spread(rows.where(F.col(text_col).isNotNull() & (F.col(text_col) != "")).select(id_col, text_col)).mapInPandas(run, fields)
