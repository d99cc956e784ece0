"""Problem 2: turn pages with HTML, Markdown, wiki or LaTeX residue into clean text.

Recognisers find the pieces of each language; a page without any passes through untouched. Otherwise
code is set aside, LaTeX, HTML, wiki and Markdown are converted in this order, and headings, list items,
table rows, code lines and formulas are reported as spans of the clean text. HTML becomes a tree whose
paragraphs pass points for length and commas to their ancestors, discounted by link density; the best
container is kept, with all siblings but those that consist of links.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape
from html.entities import html5

import pyarrow as pa
from pyspark.sql import DataFrame

from lexloom.llm.tokenizer import blocks

# Element names of HTML 3.2 to 5.
ELEMENTS = (
    "a abbr acronym address area article aside audio b base basefont bdi bdo big blink blockquote body br button canvas "
    "caption center cite code col colgroup data dd del details dfn dialog dir div dl dt em embed fieldset figcaption "
    "figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend "
    "li link main map mark marquee menu meta meter nav nobr noframes noscript object ol optgroup option output p param "
    "picture pre progress q rp rt ruby s samp script section select small source span strike strong style sub summary sup "
    "svg table tbody td template textarea tfoot th thead time title tr track tt u ul var video wbr"
)
_LONG = "|".join(sorted((e for e in ELEMENTS.split() if len(e) > 1), key=len, reverse=True))
_ANY = "|".join(sorted(ELEMENTS.split(), key=len, reverse=True))
# LaTeX commands that take no argument, and what they stand for.
SYMBOLS = {
    "leq": "≤", "le": "≤", "geq": "≥", "ge": "≥", "neq": "≠", "ne": "≠", "times": "×", "cdot": "·", "div": "÷", "pm": "±",
    "sum": "∑", "prod": "∏", "int": "∫", "infty": "∞", "approx": "≈", "equiv": "≡", "partial": "∂", "nabla": "∇", "in": "∈",
    "forall": "∀", "exists": "∃", "rightarrow": "→", "to": "→", "leftarrow": "←", "Rightarrow": "⇒", "circ": "°", "degree": "°",
    "alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ", "epsilon": "ε", "varepsilon": "ε", "zeta": "ζ", "eta": "η", "theta": "θ",
    "lambda": "λ", "mu": "μ", "nu": "ν", "xi": "ξ", "pi": "π", "rho": "ρ", "sigma": "σ", "tau": "τ", "phi": "φ", "varphi": "φ",
    "chi": "χ", "psi": "ψ", "omega": "ω", "Gamma": "Γ", "Delta": "Δ", "Theta": "Θ", "Lambda": "Λ", "Pi": "Π", "Sigma": "Σ",
    "Phi": "Φ", "Psi": "Ψ", "Omega": "Ω", "ldots": "…", "dots": "…", "cdots": "⋯", "og": "« ", "fg": " »", "euro": "€", "S": "§",
    "quad": " ", "qquad": " ", "hline": "", "centering": "", "noindent": "", "par": "\n\n", "newline": "\n", "newpage": "\n\n",
    "maketitle": "", "tableofcontents": "", "bigskip": "", "medskip": "", "smallskip": "", "toprule": "", "midrule": "",
    "bottomrule": "", "left": "", "right": "", "displaystyle": "", "textstyle": "", "item": "", "bf": "", "it": "", "em": "",
    "large": "", "Large": "", "small": "", "tiny": "", "oe": "œ", "OE": "Œ", "ae": "æ", "AE": "Æ", "LaTeX": "LaTeX", "TeX": "TeX",
}
_BARE = "|".join(sorted((s for s in SYMBOLS if len(s) > 1), key=len, reverse=True))

PIECES: dict[str, re.Pattern] = {
    "html": re.compile(
        rf"</?(?:{_LONG})(?=[\s/>])|</?(?:{_ANY})(?:\s+[\w:-]+\s*=[^<>]*|\s*/?)>|<[abipqsu]\s+[\w:-]+\s*=|<!--|-->|<!doctype\b"
        rf"|&lt;/?(?:{_ANY})\b(?:(?!&gt;).){{0,200}}&gt;|&\#(?:\d{{1,7}}|x[0-9a-f]{{1,6}});|&(?P<name>[a-z][a-z0-9]{{1,31}};)",
        re.I | re.S,
    ),
    "markdown": re.compile(
        r"^ {0,3}(?:\#{1,6}[ \t]+\S|>[ \t]+\S|>$|```|~~~)|^\|?[ \t]*:?-{3,}:?[ \t]*\||^[ \t]*\|(?![-}|])[^\n]*[^|\s][ \t]*\|[ \t]*$"
        r"|(?<!\*)\*{2,3}(?=[^\s*])|(?<=[^\s*])\*{2,3}(?!\*)|(?<![\w_])_{2,3}(?=[^\W_])(?![A-ZÀ-Þ]+__)|(?<=[^\W_])__(?![\w_])(?<!__[A-ZÀ-Þ]__)"
        r"|!?\[[^\[\]\n]*\]\(\S|\]\((?:https?:|/)|\[\^\w+\]|(?<!`)`[^`\n]+`(?!`)|~~(?=\S)[^~\n]+~~|(?<![\w*\\])\*[^\s*][^*\n]{0,300}[^\s*]\*(?![\w*])"
        r"|(?<![\w_\\])_[^\s_][^_\n]{0,300}[^\s_]_(?![\w_])",
        re.M,
    ),
    "wiki": re.compile(
        r"\[\[|(?<=\w)\]\]|\{\{(?=[^\W\d_]|\#)|(?<![\w'])'{2,5}(?=\w)|(?<=[^\s'])'{2,5}(?![\w'])|^={2,6}[ \t]*[^=\s]"
        r"|^\{\||^\|\}|^\|-[ \t]*(?:$|\w+=)|^!.*!!|^\|[^\n]*\|\||__[A-ZÀ-Þ]{3,}__|</?(?:nowiki|ref)\b|~~~~|\[https?://[^\s\[\]]+ [^\[\]\n]+\]",
        re.M,
    ),
    "latex": re.compile(
        rf"\\(?:begin|end)[ \t]*\{{|(?<![\w:\\])\\[A-Za-z]+\*?[ \t]*\{{|(?<![\w:\\])\\(?:{_BARE})(?![A-Za-z\\_])|\$\$|(?<!\\)\\[\[\]]|(?<!\\)\\[()](?=.*\\[()])"
        r"|(?<![\\$])\$(?=[^$\n]*[\\^_={])[^$\n]{1,300}\$|^[^\n&]*&[^\n]*\\\\[ \t]*(?:\\hline)?[ \t]*$|``[^`'\n]{1,300}''",
        re.M,
    ),
}
#: Without one of these a text can't hold a piece of the language.
SIGNS = {
    "html": ("<", "-->", "&"),
    "markdown": ("*", "_", "#", ">", "`", "](", "[^", "|", "~~"),
    "wiki": ("[[", "]]", "{{", "''", "==", "{|", "|}", "|-", "||", "!!", "__", "~~~~", "[http", "<nowiki", "<ref", "</"),
    "latex": ("\\", "$", "``"),
}
_PATH = re.compile(r"(?<![A-Za-z])[A-Za-z]:\\[^\s<>\"|]*|\\\\[A-Za-z][\w.-]*\\[^\s<>\"|]*")
_LATEX_QUOTE = re.compile(r"``[^`'\n]{1,300}''")
_MAGIC = re.compile(r"__[A-ZÀ-Þ]{3,}__")


def kinds_of(text: str) -> list[str]:
    """The markup languages of which ``text`` holds at least one piece."""
    out = []
    for kind, signs in SIGNS.items():
        if not any(x in text for x in signs):
            continue
        at = _PATH.sub(" ", text) if "\\" in text else text
        if kind == "markdown" and "__" in at:
            at = _MAGIC.sub(" ", at)
        elif kind == "wiki" and "``" in at:
            at = _LATEX_QUOTE.sub(" ", at)
        if any(not (m.groupdict().get("name") and m["name"] not in html5) for m in PIECES[kind].finditer(at)):
            out.append(kind)
    return out


# Signs of the private area mark lines of structure until the end; a text that uses them keeps its own.
HEAD, ITEM, ROW, CODE, FORMULA, SET, HOLD, HELD = "\ue010", "\ue018", "\ue019", "\ue01a", "\ue01b", "\ue01d", "\ue01e", "\ue01f"
NAMES = {ITEM: "item", ROW: "row", CODE: "code", FORMULA: "formula"}
_MARKS = re.compile("[\ue010-\ue01f]")


def _code_lines(body: str) -> str:
    return "\n" + "\n".join(CODE + line for line in body.strip("\n").split("\n")) + "\n"


class _Shelf:
    """Takes finished stretches out of a text and puts them back."""

    def __init__(self):
        self.kept: list[str] = []

    def put(self, text: str) -> str:
        self.kept.append(text)
        return f"{HOLD}{len(self.kept) - 1}{HELD}"

    def back(self, text: str) -> str:
        for _ in range(3):
            if HOLD not in text:
                break
            text = re.sub(f"{HOLD}(\\d+){HELD}", lambda m: self.kept[int(m[1])], text)
        return text


def between(text: str, opener: re.Pattern, closer, make) -> str:
    """``text`` with every stretch from an opener to its nearest closer (a pattern that ``closer`` gives for the opener's
    match) replaced by make(match, body). A closer that doesn't come any more is looked for once, so the time stays linear."""
    out: list[str] = []
    at, missing = 0, set()
    for m in opener.finditer(text):
        if m.start() < at or (end_of := closer(m)) in missing:
            continue
        if (end := end_of.search(text, m.end())) is None:
            missing.add(end_of)
            continue
        out += [text[at : m.start()], make(m, text[m.end() : end.start()])]
        at = end.end()
    return "".join((*out, text[at:])) if out else text


_SUPER = str.maketrans("0123456789+-n", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻ⁿ")
_BRACED = r"\{((?:[^{}]|\{(?:[^{}]|\{[^{}]*\})*\})*)\}"


def formula(body: str) -> str:
    """A LaTeX formula in one line of text."""
    for _ in range(6):
        before = body
        body = re.sub(rf"\\[dt]?frac\s*{_BRACED}\s*{_BRACED}", r"(\1)/(\2)", body)
        body = re.sub(rf"\\sqrt\s*{_BRACED}", r"√(\1)", body)
        body = re.sub(rf"\\(?:text|mathrm|mathbf|mathit|operatorname|mbox)\s*{_BRACED}", r"\1", body)
        if body == before:
            break
    body = re.sub(r"\^\{([0-9n+-]+)\}|\^([0-9n])", lambda m: (m[1] or m[2]).translate(_SUPER), body)
    body = re.sub(r"\^\{\\circ\}|\^\\circ", "°", body)
    body = re.sub(rf"\^{_BRACED}", lambda m: m[1] if m[1].isalpha() else f"^({m[1]})", body)
    body = re.sub(rf"_{_BRACED}", lambda m: "_" + (m[1] if m[1].isalnum() else f"({m[1]})"), body)
    body = re.sub(r"\\([A-Za-z]+)\s?", lambda m: SYMBOLS.get(m[1], m[1]), body)
    body = re.sub(r"\\(.)", r"\1", body)
    return re.sub(r"\s+", " ", body.replace("{", "").replace("}", "").replace("~", " ")).strip()


_HEADS = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5}


_VERBATIM = re.compile(r"\\begin\{(verbatim|lstlisting)\}(?:\[[^\[\]]*\])?")
_DISPLAY = re.compile(r"\$\$|\\\[|\\begin\{((?:equation|align|gather|displaymath|math)\*?)\}")
_INLINE = re.compile(r"\\\(")
_ENVIRONMENTS = ("verbatim", "lstlisting", *(e + star for e in ("equation", "align", "gather", "displaymath", "math") for star in ("", "*")))
_END = {e: re.compile(re.escape(f"\\end{{{e}}}")) for e in _ENVIRONMENTS} | {a: re.compile(re.escape(b)) for a, b in (("$$", "$$"), ("\\[", "\\]"), ("\\(", "\\)"))}


def from_latex(text: str, shelf: _Shelf) -> str:
    text = between(text, _VERBATIM, lambda m: _END[m[1]], lambda m, body: shelf.put(_code_lines(body)))
    text = _PATH.sub(lambda m: shelf.put(m[0]), text)
    text = between(text, _DISPLAY, lambda m: _END[m[1] or m[0]], lambda m, body: f"\n{FORMULA}{formula(body)}\n" if body else "")
    text = between(text, _INLINE, lambda m: _END[m[0]], lambda m, body: formula(body))
    text = re.sub(r"(?<![\\$])\$(?=[^$\n]*[\\^_={])([^$\n]{1,300})\$", lambda m: formula(m[1]), text)
    text = re.sub(r"``([^`'\n]{1,300})''", r"“\1”", text)
    text = re.sub(r"\\begin\{(?:tabular|array|tabularx|longtable)\*?\}(?:\[[^\]]*\])?(?:\{[^{}]*\})*", "\n", text)
    row = r"^([^\n&]*(?:(?<!\\)&[^\n&]*)+?)\\\\[ \t]*(?:\[[^\]]*\])?[ \t]*(?:\\hline)?[ \t]*$"
    text = re.sub(row, lambda m: ROW + "\t".join(c.strip() for c in re.split(r"(?<!\\)&", m[1].replace("\\hline", ""))), text, flags=re.M)
    for _ in range(4):
        before = text
        text = re.sub(rf"\\({'|'.join(_HEADS)})\*?\s*(?:\[[^\]]*\])?\s*{_BRACED}", lambda m: f"\n{HEAD}{_HEADS[m[1]]}{m[2].strip()}\n", text)
        text = re.sub(rf"\\(?:footnote|footnotetext)\s*{_BRACED}", r" (\1)", text)
        text = re.sub(rf"\\(?:href|textcolor|colorbox)\s*{_BRACED}\s*{_BRACED}", r"\2", text)
        text = re.sub(rf"\\(?:label|ref|cite|pageref|vspace|hspace|usepackage|documentclass|includegraphics)\*?\s*(?:\[[^\]]*\])?\s*{_BRACED}", "", text)
        text = re.sub(r"\\(?:begin|end)\s*\{[^{}\n]*\}(?:\[[^\]\n]*\])?", "", text)
        text = re.sub(rf"\\(?!item\b|og\b|fg\b)[A-Za-z]+\*?\s*(?:\[[^\]\n]*\])?\s*{_BRACED}", r"\1", text)
        if text == before:
            break
    text = re.sub(r"(?m)^[ \t]*\\item\b[ \t]*(?:\[([^\]\n]*)\])?[ \t]*", lambda m: ITEM + (m[1] + " " if m[1] else ""), text)
    text = re.sub(r"(?:(?<=\S)[ \t]+(?=\\fg))?\\(og|fg)(?:\{\}[ \t]*|[ \t]+)?", lambda m: "« " if m[1] == "og" else " » ", text)
    text = re.sub(r"(?m) »[ ](?=[ ,.;:)]|$)", " »", text)
    text = re.sub(r"\\\\(?:\[[^\]\n]*\])?[ \t]*$", "", text, flags=re.M)
    text = re.sub(r"(?<![\w:])\\\\(?!\w)", "\n", text)
    text = re.sub(r"\\(?:begin|end)\s*\{[^\n]*$", "", text, flags=re.M)
    text = re.sub(rf"(?<![\w:\\])\\({_BARE})(?![A-Za-z\\_])(?:\{{\}})? ?", lambda m: SYMBOLS[m[1]], text)
    text = re.sub(r"(?<![\w:\\])\\[A-Za-z]+\*?\s*\{", "", text)  # cut off: its end is missing
    text = re.sub(r"\\([%&#_{}$])", r"\1", text).replace("$$", "")
    text = re.sub(r"\\[\[\]]", "", text)
    return re.sub(r"(?m)^([^{\n]*)\}[ \t]*$", r"\1", text)  # cut off: its beginning is missing


_SKIPPED = {"script", "style", "head", "title", "noscript", "template", "iframe", "object", "svg"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = set("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())


class Node:
    """An element with its children; its text is data[first:last] of the tree. Counts include all descendants."""

    __slots__ = ("tag", "parent", "children", "first", "last", "score", "chars", "linked", "links", "commas", "standing")

    def __init__(self, tag: str, parent: Node | None, first: int = 0):
        self.tag, self.parent, self.children, self.first, self.last = tag, parent, [], first, first
        self.score, self.chars, self.linked, self.links, self.commas, self.standing = 0.0, 0, 0, 0, 0, 0

    @property
    def navigates(self) -> bool:
        """Whether a block consists of links: several of them, and hardly any text beside."""
        return self.tag in _BLOCK and self.links >= 2 and self.linked > 0.6 * self.chars and self.commas < self.links


#: A tag; its attributes don't matter. A quote without an end stands for itself.
_TAG = re.compile(r"<(/?)([A-Za-z][\w:-]*)(?:(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+|[^<>\n]*+)>")


class _Tree:
    """``nodes`` in document order, so that going through them backwards meets children before parents: no pass recurses,
    however deep a page is nested."""

    def __init__(self):
        self.root = self.at = Node("#root", None)
        self.nodes, self.data = [self.root], []

    def feed(self, text: str) -> None:
        at = 0
        for m in _TAG.finditer(text):
            self._text(text[at : m.start()])
            at = m.end()
            if m[1]:
                self._end(m[2].lower())
            elif m[0][-2] == "/":
                self._open(m[2].lower())
            else:
                self._begin(m[2].lower())
        self._text(text[at:])

    def _open(self, tag: str) -> Node:
        node = Node(tag, self.at, len(self.data))
        self.at.children.append(node)
        self.nodes.append(node)
        return node

    def _begin(self, tag: str) -> None:
        if tag in ("p", "li", "tr", "td", "th", "dt", "dd", "option"):
            self._leave({"p"} if tag == "p" else {tag, "p"} if tag in ("li", "dt", "dd") else {tag})
        node = self._open(tag)
        if tag not in _VOID:
            self.at = node

    def _leave(self, tags: set[str]) -> None:
        up = self.at
        for _ in range(NEAR):
            if up.parent is None or up.tag in ("table", "ul", "ol", "dl", "div", "body", "blockquote"):
                return
            if up.tag in tags:
                self.at = up.parent
                return
            up = up.parent

    def _end(self, tag: str) -> None:
        up = self.at
        for _ in range(NEAR):
            if up is None or up.tag == tag:
                break
            up = up.parent
        if up is not None and up.tag == tag and up.parent is not None:
            self.at = up.parent

    def _text(self, data: str) -> None:
        if data:
            self.at.children.append(data := unescape(data))
            self.data.append(data)

    def text(self, node: Node) -> str:
        return "".join(self.data[node.first : node.last])

    def finish(self) -> None:
        """Extents and counts of all nodes, from the leaves up."""
        for node in reversed(self.nodes):
            for c in node.children:
                if isinstance(c, str):
                    node.chars += len(c)
                    node.commas += c.count(",")
                else:
                    node.chars += c.chars
                    node.linked += c.linked
                    node.links += c.links
                    node.commas += c.commas
            if node.tag == "a":
                node.linked, node.links = node.chars, 1
        at = 0
        for node, begins in self.walk():
            if isinstance(node, str):
                at += 1
            elif begins:
                node.first = at
            else:
                node.last = at

    def walk(self, node: Node | None = None) -> Iterator[tuple[Node | str, bool]]:
        """(node, begins) at its begin and at its end, and the texts between, in document order."""
        stack: list[tuple[Node, Iterator]] = [(node or self.root, iter((node or self.root).children))]
        yield stack[0][0], True
        while stack:
            child = next(stack[-1][1], None)
            if child is None:
                yield stack.pop()[0], False
            elif isinstance(child, str):
                yield child, True
            else:
                stack.append((child, iter(child.children)))
                yield child, True


#: An end tag closes an element that many levels up at most; beyond, it is taken as stray.
NEAR = 500


def _paragraphs(tree: _Tree) -> Iterator[tuple[Node, str, int]]:
    """(container, text, characters in links) of each paragraph: text lines under a block, inline elements included."""
    runs: list[tuple[Node, list[str]]] = []
    skipped = linking = linked = 0

    def flush() -> Iterator[tuple[Node, str, int]]:
        nonlocal linked
        container, run = runs[-1]
        share = linked
        for line in "".join(run).split("\n"):
            if line := line.strip():
                yield container, line, min(share, len(line))
                share = max(0, share - len(line))
        run.clear()
        linked = 0

    for node, begins in tree.walk():
        if isinstance(node, str):
            if not skipped:
                runs[-1][1].append(node)
                linked += len(node) if linking else 0
            continue
        step = 1 if begins else -1
        if node.tag in _SKIPPED:
            skipped += step
        elif node.tag == "a":
            linking += step
        elif node.tag == "br" and begins and runs and not skipped:
            runs[-1][1].append("\n")
        elif node.tag in _BLOCK or node.parent is None:
            if runs:
                yield from flush()
            if begins:
                runs.append((node, []))
            else:
                runs.pop()


def score_tree(tree: _Tree) -> Node:
    """Points of all containers; returns the best. A paragraph's points for its length and commas pass to its ancestors,
    halved at each level; a container's are discounted by its link density."""
    seen: dict[int, Node] = {}
    for container, line, linked in _paragraphs(tree):
        points = 1 + line.count(",") + min(len(line) / 100, 3)
        if linked <= len(line) / 2:
            container.standing += len(line)
        share, up = 1.0, container
        while up is not None and share > 0.05:
            up.score += points * share
            seen[id(up)] = up
            share, up = share / 2, up.parent
    best, most = tree.root, 0.0
    for node in seen.values():
        value = node.score * (1 - node.linked / node.chars) if node.chars else 0.0
        if value > most:
            best, most = node, value
    for node in reversed(tree.nodes):  # text that stands for itself, outside blocks of links
        if node.navigates:
            node.standing = 0
        if node.parent is not None:
            node.parent.standing += node.standing
    return best


def kept(tree: _Tree) -> Node:
    """What is rendered: the best container and its siblings, that is its parent's children, without those that consist of
    links. Where paragraphs stand farther outside it is widened level by level until all are within, as pages are mostly
    fragments of acts and their heads or signatures often lie beside the container of the articles."""
    best = score_tree(tree)
    while best.parent is not None and best.parent.parent is not None and best.parent.standing < tree.root.standing:
        best = best.parent
    return best.parent or best


def render(tree: _Tree, top: Node, shelf: _Shelf) -> str:
    """``top`` as text with marks of structure; an explicit stack holds (node, listed, parts, children, items so far)."""
    stack: list[list] = [[top, top.tag, [], iter(top.children), 0]]
    while True:
        node, listed, parts, children, number = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            inner = "".join(parts)
            if not stack:
                return inner
            stack[-1][2].append(_element(node, inner, stack[-1]))
        elif isinstance(child, str):
            if node.tag != "tr" or not any(not isinstance(c, str) and c.tag in ("td", "th") for c in node.children):
                parts.append(child)
        elif child.tag in _SKIPPED or child.navigates:
            continue
        elif child.tag in ("br", "hr"):
            parts.append("\n" if child.tag == "br" else "\n\n")
        elif child.tag == "pre":
            parts.append(shelf.put(_code_lines(tree.text(child))))
        else:
            stack.append([child, child.tag, [], iter(child.children), 0])


def _element(node: Node, inner: str, above: list) -> str:
    """An element's text with its marks, given what stands inside."""
    tag = node.tag
    if tag in ("td", "th"):
        cell = re.sub(r"\s+", " ", inner).strip()
        above[4] += 1
        return cell if above[4] == 1 else "\t" + cell
    if tag == "tr":
        cells = any(not isinstance(c, str) and c.tag in ("td", "th") for c in node.children)
        return f"\n{ROW}{inner}\n" if cells else f"\n{inner}\n"
    if tag == "li":
        above[4] += 1
        lead = f"{above[4]}. " if above[1] == "ol" else ""
        return f"\n{ITEM}{lead}{inner.strip()}\n"
    if tag in ("sup", "sub"):
        return inner.translate(_SUPER) if tag == "sup" and inner.strip().isdigit() else inner
    if re.fullmatch("h[1-6]", tag):
        inner = re.sub(r"\s+", " ", inner).strip()
        return f"\n{HEAD}{tag[1]}{inner}\n" if inner else "\n"
    return f"\n{inner}\n" if tag in _BLOCK else inner


def from_html(text: str, shelf: _Shelf) -> str:
    text = between(text, _COMMENT, lambda m: _COMMENT_END, lambda m, body: "")
    text = re.sub(r"<!(?:doctype\b[^<>\n]*>?|--)?", "", text, flags=re.I)  # declarations, and comments without an end
    codes: list[str] = []
    text = between(text, _PRE, lambda m: _PRE_END, lambda m, body: codes.append(f"{m[0]}{body}</pre>") or SET)
    parts = [x for i, part in enumerate(text.split(SET)) for x in ((codes[i - 1], part) if i else (part,))]
    escaped = re.compile(rf"&lt;(/?(?:{_ANY})\b(?:(?!&gt;|&lt;).){{0,200}})&gt;", re.I | re.S)
    # Outside code, escaped tags are tags; a bracket that begins no element is text; cut-off tags end at their line.
    for i in range(0, len(parts), 2):
        part = escaped.sub(r"<\1>", parts[i])
        part = re.sub(rf"<(?!/?(?:{_ANY})(?=[\s/>])|!)", "&lt;", part, flags=re.I)
        parts[i] = re.sub(r"<(/?[A-Za-z][^<>\n]*)(?=\n|\Z)", lambda m: m[0] if _closes(m) else "", part)
    tree = _Tree()
    tree.feed("".join(parts))
    tree.finish()
    return re.sub(r"\n{3,}", "\n\n", render(tree, kept(tree), shelf)).replace("-->", "")


_COMMENT, _COMMENT_END = re.compile("<!--"), re.compile("-->")
_PRE, _PRE_END = re.compile(r"<pre\b", re.I), re.compile("</pre>", re.I)


def _closes(m: re.Match) -> bool:
    """Whether the tag goes on behind its line: attributes only, then the bracket."""
    rest = m.string[m.end() : m.end() + 300]
    return bool(re.match(r"\s*(?:[\w:-]++(?:\s*+=\s*+(?:\"[^\"<>]*+\"|'[^'<>]*+'|[^\s<>\"'/]++))?+(?=[\s/>])\s*+)*+/?>", rest))


def _template(m: re.Match) -> str:
    name, *fields = m[1].split("|")
    named = [f.split("=", 1) for f in fields if "=" in f]
    if named:
        rows = "".join(f"\n{ROW}{k.strip()}\t{v.strip()}" for k, v in named)
        return rows + "\n"
    return fields[-1].strip() if fields else ""


_NOWIKI, _NOWIKI_END = re.compile("<nowiki>", re.I), re.compile("</nowiki>", re.I)


def from_wiki(text: str) -> str:
    text = between(text, _NOWIKI, lambda m: _NOWIKI_END, lambda m, body: body)
    text = re.sub(r"<ref\b[^<>]*/>|</?ref\b[^<>]*>", " ", text, flags=re.I)
    for _ in range(8):
        after = re.sub(r"\{\{([^{}]*)\}\}", _template, text)
        if after == text:
            break
        text = after
    text = re.sub(r"\{\{\s*(?:[^|{}\n]*\|)?", "", text).replace("}}", "")
    text = re.sub(r"\[\[(?:[Cc]at[ée]gor(?:ie|y)|[Cc]ategoria)\s*:\s*([^\[\]|\n]*)[^\[\]\n]*\]\]", r"\1", text)
    text = re.sub(r"\[\[(?:Fichier|File|Image|Ficheiro)\s*:(?:[^\[\]\n]*\|)?([^\[\]|\n]*)\]\]", r"\1", text)
    text = re.sub(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]\n]*)\]\]", r"\1", text)
    text = re.sub(r"\[https?://[^\s\[\]]+ ([^\[\]\n]+)\]", r"\1", text)
    text = text.replace("[[", "").replace("]]", "")
    text = re.sub(r"(?<![\w'])'{2,5}(?=\w)|(?<=[^\s'])'{2,5}(?![\w'])", "", text)
    text = re.sub(r"(?m)^(={2,6})(?=[ \t]*[^=\s])(.*)$", lambda m: f"{HEAD}{len(m[1])}{_without_end(m[2], '=', 6)}", text)
    text = re.sub(r"__[A-ZÀ-Þ]{3,}__|~{3,5}", "", text)
    lines, inside = [], "{|" in text or "\n|-" in text or text.startswith("|-")
    for line in text.split("\n"):
        if re.match(r"\{\||\|\}|\|-|\|\+", line):
            continue
        if re.match(r"!.*!!", line) or re.match(r"\|.*\|\|", line) or inside and re.match(r"[!|] ", line):
            cells = re.split(r"!!|\|\|", line[1:])
            line = ROW + "\t".join(re.sub(r"^[^|\n]*=[^|\n]*\|", "", c).strip() for c in cells)
        lines.append(line)
    return "\n".join(lines)


def _without_end(line: str, sign: str, most: int) -> str:
    """A heading without the signs, up to ``most`` of at least two, that close it."""
    line = line.strip(" \t")
    bare = line.rstrip(sign)
    return bare.rstrip(" \t") if len(line) - len(bare) <= most else line


def from_markdown(text: str, shelf: _Shelf) -> str:
    text = re.sub(r"(?m)^ {0,3}(?:```|~~~)[^\n]*\n(.*?)(?:^ {0,3}(?:```|~~~)[ \t]*$|\Z)", lambda m: shelf.put(_code_lines(m[1])), text, flags=re.S | re.M)
    text = re.sub(r"(?m)^ {0,3}(?:```|~~~).*$\n?", "", text)
    text = re.sub(r"(?<!`)`([^`\n]+)`(?!`)", lambda m: shelf.put(m[1]), text)
    text = re.sub(r"(?m)^(?: {0,3}> ?)+", "", text)
    text = re.sub(r"!\[([^\[\]\n]*)\]\([^)\n]*\)?", r"\1", text)
    text = re.sub(r"\[([^\[\]\n]*)\]\([^)\n]*\)?", r"\1", text)
    text = re.sub(r"\]\((?:https?:|/)[^)\s]*\)?", "", text)
    text = re.sub(r"(?m)^\[\^(\w+)\]:[ \t]*", r"[\1] ", text)
    text = re.sub(r"\[\^(\w+)\]", r"[\1]", text)
    text = re.sub(r"(?m)^ {0,3}(#{1,6})[ \t](.*)$", lambda m: f"{HEAD}{len(m[1])}{_without_end(m[2], '#', len(m[2]))}", text)
    text = re.sub(r"(?m)^[ \t]*\|?(?:[ \t]*:?-+:?[ \t]*\|)+(?:[ \t]*:?-+:?)?[ \t]*$\n?", "", text)
    row = r"(?m)^[ \t]*\|(?![-}|])([^\n]*[^|\s])[ \t]*\|[ \t]*$"
    text = re.sub(row, lambda m: ROW + "\t".join(c.strip() for c in m[1].split("|")), text)
    text = re.sub(r"(?<!\*)\*{2,3}(?=[^\s*])|(?<=[^\s*])\*{2,3}(?!\*)|(?<![\w_])_{2,3}(?=[^\W_])|(?<=[^\s_])_{2,3}(?![\w_])", "", text)
    text = re.sub(r"(?<![\w*\\])\*([^\s*][^*\n]{0,300}[^\s*])\*(?![\w*])|(?<![\w_\\])_([^\s_][^_\n]{0,300}[^\s_])_(?![\w_])", lambda m: m[1] or m[2], text)
    text = re.sub(r"~~(\S[^~\n]*)~~", r"\1", text)
    text = re.sub(r"(?m)^[ \t]*[*+] (?=\S)", ITEM, text)
    return re.sub(r"\\([*_#\[\]()>`~])", r"\1", text)


_FENCE = re.compile(r"(?m)^ {0,3}(```|~~~)[^\n]*\n")
_FENCE_END = {f: re.compile(rf"(?m)^ {{0,3}}{f}[ \t]*$") for f in ("```", "~~~")}


def clean(text: str) -> tuple[str, list[dict], list[str]]:
    """(clean text, spans of structure, markup kinds) of one page."""
    kinds = kinds_of(text)
    if not kinds:
        return text, [], []
    shelf, out = _Shelf(), _MARKS.sub("", text)
    if "markdown" in kinds:  # code first, so that nothing in it is read as markup
        out = between(out, _FENCE, lambda m: _FENCE_END[m[1]], lambda m, body: shelf.put(_code_lines(body)))
    if "latex" in kinds:
        out = from_latex(out, shelf)
    if "html" in kinds:
        out = from_html(out, shelf)
    if "wiki" in kinds:
        out = from_wiki(out)
    if "markdown" in kinds:
        out = from_markdown(out, shelf)
    return *_spans(shelf.back(out)), kinds


def _spans(text: str) -> tuple[str, list[dict]]:
    lines: list[str] = []
    spans: list[dict] = []
    at = 0
    for line in text.split("\n"):
        body = line.strip(" \t") if CODE not in line else line
        m = re.match(f"[ \t]*([{HEAD}{ITEM}{ROW}{CODE}{FORMULA}])", body)
        kind, level = "", 0
        if m:
            body = body[m.end() :]
            if m[1] == HEAD:
                kind, level, body = "heading", int(body[:1] or 1), body[1:]
            else:
                kind = NAMES[m[1]]
        body = _MARKS.sub("", body)
        if kind == "item" and not re.match(r"[-–•]|\w{1,4}[.)°]", body):
            body = "- " + body
        if kind == "code":
            body = "    " + body.rstrip()
        body = body.rstrip()
        if not body and (not lines or not lines[-1]):
            continue
        if kind and body:
            spans.append({"kind": kind, "level": level, "begin": at, "stop": at + len(body)})
        lines.append(body)
        at += len(body) + 1
    return "\n".join(lines).rstrip("\n"), spans


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("level", pa.int32()), ("begin", pa.int32()), ("stop", pa.int32())]))


def cleaned(text: str | None) -> tuple[str | None, list[dict], list[str], str | None]:
    """clean() with an error in place of an exception: one page that can't be converted doesn't end the run. Its text stays
    as it is, and its languages are still those recognised."""
    if not text:
        return text, [], [], None
    try:
        return *clean(text), None
    except (RecursionError, ValueError, AssertionError, IndexError, KeyError, re.error) as e:
        return text, [], kinds_of(text), f"{type(e).__name__}: {e}"


def clean_pages(pages: DataFrame) -> DataFrame:
    """(document_id, page, text, markup, structure, error) for every row of ``pages``.

    ``markup`` lists the languages found (html, markdown, wiki, latex; empty if none, then the text is
    unchanged), ``structure`` the spans of headings (with level), list items, table rows (cells parted by
    tabs), code lines (indented by four blanks) and displayed formulas in the clean text. ``error`` says why a page could
    not be converted. A null text stays null without markup; rows keep their number, repeated ones included; extra
    columns are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                done = [cleaned(t) for t in block.column(2).to_pylist()]
                columns = [
                    pa.array([d[0] for d in done], pa.string()),
                    pa.array([d[2] for d in done], pa.list_(pa.string())),
                    pa.array([d[1] for d in done], SPANS),
                    pa.array([d[3] for d in done], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([block.column(0), block.column(1), *columns], names=["document_id", "page", "text", "markup", "structure", "error"])

    schema = "document_id string, page int, text string, markup array<string>, structure array<struct<kind:string,level:int,begin:int,stop:int>>, error string"
    return pages.select("document_id", "page", "text").mapInArrow(run, schema)
