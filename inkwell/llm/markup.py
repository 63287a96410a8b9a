"""Markup residue: HTML, Markdown, wiki and LaTeX in one text become clean text that keeps its structure.

HTML is parsed to a tree. Every node gets its composite text density: characters per tag, adjusted by the share of linked
characters (so menus are thin and articles dense). The threshold is the smallest density on the path from the body to the
densest node; among the block nodes the subtree with the largest sum of child densities is the content. Blocks with links outside
it whose density is less than ``THIN`` of the threshold are left out: menus, footers and side bars. The other languages are read line by line and span by span.

What the clean text keeps: a heading stands on its own line between blank lines, list items begin with ``•``, code is indented
by four spaces, table cells are separated by tabs, formulas keep their TeX without delimiters. ``parts`` names each part's kind.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.windows import once

# The names of HTML elements that count as markup, and those that break lines.
BLOCK_TAGS = set("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
INLINE_TAGS = set("a abbr b big br cite code del dfn em font i img ins kbd mark math q s samp small span strike strong sub sup time tt u var wbr style script link meta title head label input button iframe svg video audio source ref nowiki".split())
THIN = 0.03  # of the body-path threshold; a paragraph with a link in it has more, a list of links far less
DEEPEST = 200  # levels of nesting; what is deeper hangs side by side below it, so that no text is lost
VOID = {"br", "hr", "img", "input", "link", "meta", "source", "wbr"}

_NAMES = "|".join(sorted(BLOCK_TAGS | INLINE_TAGS, key=len, reverse=True))
_TAG = re.compile(rf"</?(?:{_NAMES})(?:(?:\s|&nbsp;)[^<>]*|/)?>", re.I)
_COMMENT = re.compile(r"<!--.*?(?:-->|$)|<!DOCTYPE[^>]*>", re.S | re.I)
_ENTITY = re.compile(r"&(?:[A-Za-z][A-Za-z0-9]{1,30}|#\d{1,7}|#[xX][0-9A-Fa-f]{1,6});")
_FENCE = re.compile(r"^(```|~~~)[^\n]*\n(.*?)(?:^\1[^\n]*$|\Z)", re.S | re.M)
_MATHY = r"(?:[^$\n]*[\\^_{=][^$\n]*|[A-Za-z])"
_FORMULA = re.compile(rf"\$\$(.+?)\$\$|\\\[(.+?)\\\]|\\\((.+?)\\\)|\\begin\{{(equation|align|gather|displaymath|math)\*?\}}(.+?)\\end\{{\4\*?\}}|(?<![\\$\w])\$(?!\s)({_MATHY})(?<!\s)\$(?![\d$])", re.S)
_BARE_TEX = re.compile(r"\\(?:frac|sqrt|sum|int|prod|alpha|beta|gamma|delta|hat|bar|vec|leq|geq|cdot|times|infty|partial|left|right|lim|log|mathbf|mathrm|tilde|ldots|pm|approx|neq|geq|quad)(?![A-Za-z])")
_COMMAND = re.compile(r"\\(?:textbf|textit|emph|underline|texttt|textsc|text|mbox|footnote|href|url|title|author|caption|paragraph|chapter|(?:sub)*section)\*?(?:\[[^\]]*\])?\{|\\(?:begin|end|item|label|ref|cite|includegraphics|maketitle|centering|hline)\b|\\\\(?:\s|$)|\\[%&_#$]")
_HEAD = re.compile(r"^ {0,3}(#{1,6})[ \t]+(\S.*?)[ \t#]*$", re.M)
_WIKI_HEAD = re.compile(r"^(={1,6})[ \t]*([^=\n].*?)[ \t]*\1[ \t]*$", re.M)
_ITEM = re.compile(r"^[ \t]*[-*+][ \t]+(?=\S)(?!\d+[ \t]*-[ \t]*$)", re.M)
_WIKI_ITEM = re.compile(r"^[*#:;]+[ \t]*(?=[^\s*#:;\d])(?![^*\n]*\*)", re.M)
_NUMBERED = re.compile(r"^[ \t]*\d{1,3}[.)][ \t]+(?=\S)", re.M)
_QUOTE = re.compile(r"^ {0,3}>[ \t]+(?=\S)", re.M)
_ROW = re.compile(r"^[ \t]*\|.*\|[ \t]*$", re.M)
_DASHES = re.compile(r"^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)*\|?[ \t]*$", re.M)
_SPANS = [  # kind, expression, replacement
    ("markdown", re.compile(r"!\[([^\]\n]*)\]\([^)\n]*\)"), r"\1"),
    ("markdown", re.compile(r"\[([^\[\]\n]+)\]\((?:[^()\n\s]|\([^()\n]*\))+(?:\s+\"[^\"\n]*\")?\)"), r"\1"),
    ("markdown", re.compile(r"\[\^[\w-]+\]:?"), ""),
    ("wiki", re.compile(r"\[\[(?:File|Image|Datei|Fichier|Archivo|文件):[^\[\]\n]*\]\]", re.I), ""),
    ("wiki", re.compile(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]|\n]*)\]\]"), r"\1"),
    ("wiki", re.compile(r"\[(?:https?|ftp)://\S+[ \t]+([^\]\n]+)\]"), r"\1"),
    ("wiki", re.compile(r"\{\{[^{}]*\}\}"), ""),
    ("wiki", re.compile(r"'{5}(.+?)'{5}|'{3}(.+?)'{3}|''(.+?)''"), None),
    ("markdown", re.compile(r"~~(?=\S)([^~\n]+?)(?<=\S)~~"), r"\1"),
    ("markdown", re.compile(r"\*\*\*?(?=[^\s*])(.+?)(?<=[^\s*])\*\*\*?|(?<!\w)__(?=[^\s_])(.+?)(?<=[^\s_])__(?!\w)"), None),
    ("markdown", re.compile(r"(?<![\w*])\*(?=[^\s*])([^*\n]+?)(?<=[^\s*])\*(?![\w*])|(?<![\w_])_(?=[^\s_])([^_\n]+?)(?<=[^\s_])_(?![\w_])"), None),
    ("markdown", re.compile(r"`([^`\n]+)`"), r"\1"),
]
_HINT = r"[<&*_`\[{\\$|=~#]|''|(?m)^[ \t]*[>+-][ \t]|(?m)^[:;]"


class Node:
    __slots__ = ("tag", "children", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str):
        self.tag, self.children = tag, []


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("body")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag not in BLOCK_TAGS and tag not in INLINE_TAGS:
            self.open[-1].children.append(self.get_starttag_text() or "")
            return
        if tag in ("li", "tr", "td", "th", "p", "dt", "dd"):  # these end an open one of their kind
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].tag == tag:
                    del self.open[k:]
                    break
                if self.open[k].tag in ("ul", "ol", "table", "div", "td", "th", "li", "blockquote"):
                    break
        node = Node(tag)
        self.open[-1].children.append(node)
        if tag not in VOID and len(self.open) < DEEPEST:
            self.open.append(node)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(text: str) -> Node:
    tree = _Tree()
    tree.feed(text)
    tree.close()
    return tree.root


def measure(node: Node) -> None:
    """Characters, tags, linked characters and linked tags of each subtree, then densities from the root's totals."""

    def count(n: Node, linked: bool) -> None:
        linked = linked or n.tag == "a"
        n.chars = n.tags = n.link_chars = n.link_tags = 0
        for c in n.children:
            if isinstance(c, str):
                k = len(c.strip())
                n.chars += k
                n.link_chars += k * linked
            else:
                count(c, linked)
                n.chars += c.chars
                n.tags += c.tags + 1
                n.link_chars += c.link_chars
                n.link_tags += c.link_tags + (c.tag == "a")

    count(node, False)
    share = node.link_chars / max(1, node.chars)

    def score(n: Node) -> None:
        c, t, lc, lt = n.chars, max(1, n.tags), max(1, n.link_chars), max(1, n.link_tags)
        plain = max(1, c - n.link_chars)
        base = math.log(c / plain * n.link_chars + share * c + math.e)
        n.density = c / t * math.log(max(1.0, c / lc * t / lt) + 1e-9) / max(math.log(max(base, 1.0) + 1e-9), 1.0) if c else 0.0
        n.total = 0.0
        for k in n.children:
            if not isinstance(k, str):
                score(k)
                n.total += k.density

    score(node)


def boilerplate(root: Node) -> set[int]:
    """ids of the block nodes to leave out: with links, far thinner than the threshold, outside the content subtree."""
    measure(root)
    best, path = root, [root]
    stack = [(root, [root])]
    top, inside = root, set()
    while stack:
        n, way = stack.pop()
        if n.density > best.density and n.tag != "a":
            best, path = n, way
        if n.tag in BLOCK_TAGS and n.total > top.total and n is not root:
            top = n
        stack += [(k, [*way, k]) for k in n.children if not isinstance(k, str)]
    threshold = min(n.density for n in path)
    stack2 = [top] if top is not root else []
    while stack2:
        n = stack2.pop()
        inside.add(id(n))
        stack2 += [k for k in n.children if not isinstance(k, str)]
    out, stack3 = set(), [k for k in root.children if not isinstance(k, str)]
    while stack3:
        n = stack3.pop()
        if n.tag in ("script", "style", "head") or n.tag in BLOCK_TAGS and id(n) not in inside and n.density < THIN * threshold and n.link_chars:
            out.add(id(n))
        else:
            stack3 += [k for k in n.children if not isinstance(k, str)]
    return out


def _html_text(text: str) -> str:
    """HTML as lines in the notation of the later steps."""
    root = parse(text)
    left_out = boilerplate(root)
    out: list[str] = []

    def walk(n: Node, ordered: bool = False) -> None:
        if id(n) in left_out:
            return
        t = n.tag
        if t == "br":
            out.append("\n")
            return
        if t == "hr":
            out.append("\n\n")
            return
        if t in ("pre",):
            out.append("\n\x02" + "".join(_raw(n)).strip("\n").replace("\n", "\n\x02") + "\n")
            return
        if t[:1] == "h" and t[1:].isdigit():
            out.append("\n\n\x03" + t[1] + " ".join("".join(_raw(n)).split()) + "\n\n")
            return
        if t == "tr":
            cells = [" ".join("".join(_raw(k)).split()) for k in n.children if not isinstance(k, str)]
            out.append("\n\x05" + "\t".join(cells) + "\n")
            return
        if t == "li":
            out.append("\n\x04")
        elif t in ("td", "th"):
            out.append("\t")
        elif t in BLOCK_TAGS and t != "body":
            out.append("\n\n" if t in ("p", "div", "table", "ul", "ol", "blockquote", "section", "article") else "\n")
        for k in n.children:
            if isinstance(k, str):
                out.append(k)
            else:
                walk(k, t == "ol")
        if t in BLOCK_TAGS and t not in ("body", "li"):
            out.append("\n\n" if t in ("p", "div", "table", "ul", "ol", "blockquote") else "\n")
        elif t == "li":
            out.append("\n")

    walk(root)
    return "".join(out)


def _raw(n: Node) -> Iterator[str]:
    for k in n.children:
        if isinstance(k, str):
            yield k
        elif k.tag == "br":
            yield "\n"
        else:
            yield from _raw(k)


def convert(text: str) -> tuple[list[str], list[tuple[str, str]]]:
    """(kinds of markup found, parts (kind, text)) of one text."""
    kinds: dict[str, None] = {}
    kept: list[tuple[str, str]] = []

    def keep(kind: str, body: str) -> str:
        kept.append((kind, body))
        return f"\x00{len(kept) - 1}\x00"

    text = text.replace("\x00", "").translate({2: None, 3: None, 4: None, 5: None})

    def fence(m: re.Match) -> str:
        kinds["markdown"] = None
        return "\n" + keep("code", m[2].rstrip("\n")) + "\n"

    text = _FENCE.sub(fence, text)

    def formula(m: re.Match) -> str:
        kinds["latex"] = None
        body = next(g for g in (m[1], m[2], m[3], m[5], m[6]) if g is not None)
        display = m[3] is None and m[6] is None
        token = keep("formula" if display else "inline", body.strip())
        return f"\n{token}\n" if display and m.start() == text.rfind("\n", 0, m.start()) + 1 else token

    text = _FORMULA.sub(formula, text)
    if _COMMENT.search(text):
        kinds["html"] = None
        text = _COMMENT.sub("", text)
    if _TAG.search(text):
        kinds["html"] = None
        text = _html_text(re.sub(r"<(\w+)&nbsp;", r"<\1 ", text))
    if _ENTITY.search(text) and (plain := html.unescape(text)) != text:
        kinds["html"] = None
        text = plain.replace("\xa0", " ")
    if _COMMAND.search(text):
        kinds["latex"] = None
        text = re.sub(r"\\((?:sub)*)(?:section|chapter|title|paragraph)\*?\{([^{}]*)\}", lambda m: f"\n\x03{1 + len(m[1]) // 3}{m[2]}\n", text)
        text = re.sub(r"\\(?:begin|end)\{[^{}]*\}(?:\[[^\]]*\]|\{[^{}]*\})?|\\(?:label|ref|cite|includegraphics)(?:\[[^\]]*\])?\{[^{}]*\}|\\(?:maketitle|centering|hline)\b", "", text)
        text = re.sub(r"[ \t]*\\item(?:\[([^\]]*)\])?[ \t]*", "\n\x04", text)
        for _ in range(4):
            text, n = re.subn(r"\\href\{[^{}]*\}\{([^{}]*)\}|\\(?:textbf|textit|emph|underline|texttt|textsc|text|mbox|footnote|url|author|caption)\{([^{}]*)\}", lambda m: m[1] or m[2] or "", text)
            if not n:
                break
        text = re.sub(r"\\\\(?=\s|$)", "\n", text)
        text = re.sub(r"\\([%&_#$])", r"\1", text)
        text = re.sub(r"(?<=\S)~(?=\S|$)", " ", text)  # a tie
    if _BARE_TEX.search(text):
        kinds["latex"] = None
    for kind, spans, to in _SPANS:
        if spans.search(text):
            kinds[kind] = None
            text = spans.sub(to if to is not None else (lambda m: next(g for g in m.groups() if g is not None)), text)
    if _HEAD.search(text):
        kinds["markdown"] = None
        text = _HEAD.sub(lambda m: f"\x03{len(m[1])}{m[2]}", text)
    if _WIKI_HEAD.search(text):
        kinds["wiki"] = None
        text = _WIKI_HEAD.sub(lambda m: f"\x03{len(m[1])}{m[2]}", text)
    rows = _ROW.findall(text)
    if rows and (len(rows) > 1 or _DASHES.search(text)) or _DASHES.search(text) and "|" in text:
        kinds["markdown"] = None
        text = _DASHES.sub("\x05", text)
        text = _ROW.sub(lambda m: "\x05" + "\t".join(c.strip() for c in m[0].strip().strip("|").split("|")), text)
    if re.search(r"^\{\||^\|\}", text, re.M):
        kinds["wiki"] = None
        text = re.sub(r"^(?:\{\||\|\}|\|-).*$", "", text, flags=re.M)
        text = re.sub(r"^[|!][ \t]*(.*)$", lambda m: "\x05" + "\t".join(c.strip() for c in re.split(r"\|\||!!", m[1])), text, flags=re.M)
    if _QUOTE.search(text):
        kinds["markdown"] = None
        text = _QUOTE.sub("", text)
    for shape, kind in ((_ITEM, "markdown"), (_WIKI_ITEM, "wiki")):
        if shape.search(text):
            kinds[kind] = None
            text = shape.sub("\x04", text)
    if kinds and _NUMBERED.search(text):
        text = _NUMBERED.sub("\x04", text)
    parts: list[tuple[str, str]] = []
    for line in text.split("\n"):
        mark, body = (line[0], line[1:]) if line[:1] in ("\x02", "\x03", "\x04", "\x05") else ("", line)
        body = body.strip() if mark != "\x02" else body
        whole = re.fullmatch(r"\x00(\d+)\x00", body)
        if whole and not mark:
            parts.append(kept[int(whole[1])] if kept[int(whole[1])][0] != "inline" else ("formula", kept[int(whole[1])][1]))
            continue
        body = re.sub(r"\x00(\d+)\x00", lambda m: kept[int(m[1])][1], body)
        if mark == "\x02":
            if parts and parts[-1][0] == "code":
                parts[-1] = ("code", parts[-1][1] + "\n" + body)
            else:
                parts.append(("code", body))
        elif mark == "\x05":
            if body:
                parts.append(("row", body))
        elif not body:
            if parts and parts[-1][0] != "blank":
                parts.append(("blank", ""))
        elif mark == "\x03":
            parts.append(("heading", body[1:].strip()))
        elif mark == "\x04":
            parts.append(("item", body))
        else:
            parts.append(("text", " ".join(body.split(" ")) if "  " not in body else re.sub(r" {2,}", " ", body)))
    while parts and parts[-1][0] == "blank":
        parts.pop()
    while parts and parts[0][0] == "blank":
        parts.pop(0)
    return sorted(kinds), parts


def clean(parts: list[tuple[str, str]]) -> str:
    lines: list[str] = []
    for kind, body in parts:
        if kind == "heading":
            lines += ["", body, ""]
        elif kind == "item":
            lines.append("• " + body)
        elif kind == "code":
            lines += ["", *("    " + x for x in body.split("\n")), ""]
        elif kind == "formula":
            lines += ["", body, ""]
        else:
            lines.append(body)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip("\n")


def items(blocks: DataFrame, concepts: DataFrame) -> DataFrame:
    """(item_table, item_key, content): all blocks and concept documents with a content."""
    b = blocks.where("content is not null").select(F.lit("blocks").alias("item_table"), F.col("block_id").alias("item_key"), "content")
    c = concepts.where("body is not null").select(F.lit("concept_documents").alias("item_table"), F.col("filename").alias("item_key"), F.col("body").alias("content"))
    return b.unionByName(c)


def converted(rows: DataFrame, only_markup: bool = False) -> DataFrame:
    """(item_table, item_key, markup array<string>, clean_text, parts array<struct<kind,text>>) once a key.

    Null contents have no row (they hold nothing to clean); empty and blank texts come out empty; a text without markup comes
    out as it is but for runs of spaces and blank lines; long texts are converted whole; of different texts under one key the greatest counts (with ``only_markup`` a key comes as often as its
    texts that hold markup); other columns are not read. Signs that are no
    markup (5 * 3, p < 0.05, $17, unit_cost, #18, {draft}, bullets) stay as they are."""
    rows = rows.select("item_table", "item_key", "content")
    if not only_markup:
        rows = once(rows, ["item_table", "item_key"])
    if only_markup:  # a text without any sign of markup can't hold it
        rows = rows.where(F.col("content").rlike(_HINT))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [convert(t) for t in batch.column(2).to_pylist()]
            at = pa.array([k for k, (m, _) in enumerate(got) if m or not only_markup], pa.int64())
            chosen = [got[k] for k in at.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array([m for m, _ in chosen], pa.list_(pa.string())), pa.array([clean(p) for _, p in chosen], pa.string()), pa.array([[{"kind": k, "text": t} for k, t in p if k != "blank"] for _, p in chosen], kind)],
                ["item_table", "item_key", "markup", "clean_text", "parts"],
            )

    out = rows.mapInArrow(run, "item_table string, item_key string, markup array<string>, clean_text string, parts array<struct<kind:string,text:string>>")
    return out


def found(blocks: DataFrame, concepts: DataFrame) -> DataFrame:
    return converted(items(blocks, concepts), only_markup=True).select("item_table", "item_key").distinct()
