"""Problem 2: markup residue (HTML, Markdown, wiki, LaTeX) in texts, and its conversion to clean text.

Method: minimum-cut labelling. Constructs, the text runs between them and places of machine noise are the nodes of a small
graph for each text. The costs of a classifier are the terminal capacities: for a construct, a first setting of its kind and
how often the kind stands in text rather than in noise, fitted on a bounded sample of the corpus; for a text run, how
surely it is text by its function words. Neighbouring nodes are joined by smoothness edges, stronger between
constructs of one language; DOM proximity joins the children of one element (list items, table rows) and a child with its
element; a place of noise holds what stands in it. A maximum flow separates residue (sink side) from content (source side),
so that a doubtful sign such as ``*word*`` or a lone pipe row follows its surroundings, and the signs of a log or of JSON
stay what they are. Constructs on the sink side are then rewritten: headings become lines of their own (their levels are
kept beside the text), entries ``- `` or their number, cells tabs, code indented lines, formulas linear text.

Null and blank texts have no markup and stay as they are; texts without any sign are not sent to Python.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left, bisect_right
from collections import deque
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, flat_map_rows, language_scores, map_rows

LANGUAGES = ("html", "markdown", "wiki", "latex")
#: A text with none of these signs holds no construct. Java syntax.
SIGNS = r"[<&\\\[{*_`~|$]|''|(?m:^[ \t]*(?:#|=|>|-[ \t]*-[ \t]*-|;|:+#|!))"

#: Element names of HTML.
_TAGS = (
    "a abbr address article aside audio b base big blockquote body br button caption center cite code col colgroup dd del details dfn div dl dt em "
    "embed fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map "
    "mark meta nav noscript object ol option p param picture pre q s samp script section select small source span strike strong style sub summary sup "
    "svg table tbody td template textarea tfoot th thead time title tr track tt u ul var video wbr"
).split()
#: LaTeX commands that count without a brace after them.
_COMMANDS = (
    "alpha beta gamma delta epsilon varepsilon zeta eta theta lambda mu nu xi pi rho sigma tau phi varphi chi psi omega Gamma Delta Theta Lambda Pi Sigma Phi Psi "
    "Omega sum prod int iint oint lim inf sup max min log ln exp sin cos tan leq geq neq le ge ne approx equiv sim times cdot cdots ldots dots pm mp div in notin "
    "subset subseteq cup cap forall exists infty partial nabla to rightarrow leftarrow Rightarrow Leftrightarrow item hline toprule midrule bottomrule newline "
    "newpage clearpage noindent centering maketitle tableofcontents par bigskip medskip smallskip hfill quad qquad left right big textbf textit emph LaTeX TeX"
).split()
_T = "|".join(sorted(_TAGS, key=len, reverse=True))
_C = "|".join(sorted(_COMMANDS, key=len, reverse=True))
_W = r"[^\W\d_]"
_P = r"\n(?![ \t]*\n)"  # a line end inside a paragraph

#: (language, kind, weight, pattern). The weight is the cost of leaving the construct as content; kinds in the same
#: position go by order. Weights under 3 are doubtful on their own.
_SPEC = [
    ("html", "comment", 8, r"<!--.*?(?:-->|\Z)"),
    ("html", "doctype", 8, r"<!doctype[^>]*>|<\?xml[^>]*>"),
    ("html", "pre", 8, r"<pre\b[^>]*>.*?</pre\s*>"),
    ("wiki", "ref", 8, r"<ref\b[^<>]*/>|<ref\b[^<>]*>.*?</ref>|</?(?:nowiki|gallery|references|noinclude|includeonly|math)\b[^<>]*>"),
    ("html", "drop", 8, r"<(script|style)\b[^>]*>.*?</(?:script|style)\s*>"),
    ("html", "tag", 8, rf"</?(?:{_T})(?:\s[^<>]*)?/?>"),
    ("html", "other", 2.5, r"</?[a-zA-Z][\w-]*(?:\s+[\w-]+=[^<>]*)?/?>(?!\w)"),
    ("html", "entity", 7, r"&(?:amp;)*(?:[a-zA-Z][a-zA-Z0-9]{1,30}|#\d{1,7}|#[xX][0-9a-fA-F]{1,6});"),
    ("markdown", "fence", 8, r"^[ \t]*(`{3,}|~{3,})[^\n`]*\n(?:.*?\n)??[ \t]*\1[ \t]*$|^[ \t]*```[^\n]*$"),
    ("latex", "math", 8, r"\\\[.*?\\\]|\\\(.*?\\\)|\$\$.+?\$\$|\\begin\{((?:equation|align|gather|math|displaymath|eqnarray|multline)\*?)\}.*?\\end\{(?:equation|align|gather|math|displaymath|eqnarray|multline)\*?\}"),
    ("latex", "verbatim", 8, r"\\begin\{(?:verbatim|lstlisting)\}.*?\\end\{(?:verbatim|lstlisting)\}"),
    ("latex", "env", 8, r"\\(?:begin|end)\{[\w*]+\}(?:\[[^\]\n]*\]|\{[^}\n]*\})*"),
    ("latex", "head", 8, r"\\(?:part|chapter|section|subsection|subsubsection|paragraph|subparagraph|title|caption)\*?\{[^{}\n]*\}"),
    ("latex", "arg", 8, r"\\(?!(?:begin|end)\b)[a-zA-Z]{2,}\*?(?:\[[^\]\n]*\])?\{[^{}\n]*\}(?:\{[^{}\n]*\})*"),
    ("latex", "command", 6, rf"(?<![:\\\w])\\(?:{_C})(?![a-zA-Zæøåäöü\\])\*?[ \t]?"),
    ("latex", "dollar", 6, rf"\$(?=[^\s$])(?=(?:[^$\n]|{_P})*[\\^_={{}}+])(?:[^$\n]|{_P})+(?<=\S)\$(?!\d)"),
    ("latex", "dollar1", 2.5, r"(?<![\w$])\$[a-zA-Z]\w?\$(?!\w)"),
    ("latex", "row", 3, r"[ \t]\\\\[ \t]*(?:\[\d+\w+\])?(?=\n|\Z)"),
    ("wiki", "table", 8, r"^\{\|[^\n]*$|^\|\}[ \t]*$|^\|-[^\n|]*$|^\|\+[^\n]*$"),
    ("wiki", "row", 7, r"^[|!][^\n]*?(?:\|\||!!)[^\n]*$"),
    ("wiki", "template", 8, r"\{\{(?:[^{}]|\{\{[^{}]*\}\}|\{(?!\{)|\}(?!\}))*\}\}"),
    ("wiki", "link", 8, r"\[\[[^\[\]\n]+(?:\[\[[^\[\]\n]*\]\][^\[\]\n]*)*\]\]"),
    ("wiki", "head", 8, r"^(={2,6})[ \t]*[^=\n][^\n]*?={2,6}[ \t]*$"),
    ("wiki", "quote", 8, r"'{2,5}(?=\S)[^'\n]+?(?:'[^'\n]+?)*(?<=\S)'{2,5}"),
    ("wiki", "magic", 8, r"__[A-ZÆØÅ]{3,}__|^#(?:REDIRECT|OMDIRIGERING)\b[^\n]*|~{3,5}(?=\s|$)"),
    ("wiki", "extlink", 7, r"\[(?:https?:)?//[^\s\]]+(?: [^\]\n]*)?\](?!\()"),
    ("wiki", "entry", 5, r"^(?:\*{2,}|#{1,}[*:]|\*+[#:]+|:{1,}[*#]|;)[ \t]*(?=[^\s*#])(?![^\n]*\*\*)(?=[^\n]*$)"),
    ("markdown", "refdef", 8, r"^[ \t]*\[[^\]\n]+\]:[ \t]*(?:<[^>\n]+>|\S+)(?:[ \t]+[\"'(][^\n]*)?$"),
    ("markdown", "image", 8, r"!\[[^\]\n]*\](?:\([^)\n]*\)|\[[^\]\n]*\])"),
    ("markdown", "link", 8, r"\[[^\[\]\n]+\]\([^()\s]*(?:[ \t]+[\"'][^\"'\n]*[\"'])?\)"),
    ("markdown", "reflink", 7, r"\[[^\[\]\n]+\][ ]?\[[\w .-]*\]"),
    ("markdown", "note", 6, r"\[\^[^\]\s]+\]:?"),
    ("markdown", "autolink", 5, r"<(?:https?|mailto):[^\s<>]+>"),
    ("markdown", "head", 8, r"^ {0,3}#{1,6}[ \t]+[^\s#][^\n]*$"),
    ("markdown", "setext", 7, r"(?<=\S\n)(?:={3,}|-{3,})[ \t]*(?=\n|\Z)"),
    ("markdown", "rule", 4, r"^[ \t]*(?:(?:-[ \t]*){3,}|(?:\*[ \t]*){3,}|(?:_[ \t]*){3,})$"),
    ("markdown", "task", 8, r"^[ \t]*[-*+][ \t]+\[[ xX]\](?=\s)"),
    ("markdown", "cells", 8, r"^[ \t]*\|?(?:[ \t]*:?-{2,}:?[ \t]*\|)+(?:[ \t]*:?-{2,}:?[ \t]*)?$"),
    ("markdown", "piped", 2.6, r"^[ \t]*\|(?![-+}|])[^\n]*\S[^\n]*\|[ \t]*$"),
    ("markdown", "quote", 6, r"^[ \t]{0,3}>+(?:[ \t]+>+)*(?=[ \t]+\S)"),
    ("markdown", "code", 7, r"(?<!`)(`{1,2})(?=[^\s`])[^`\n]+?\1(?!`)"),
    ("markdown", "strong", 8, r"(?<![\w*])\*{2,3}(?=[^\s*])[^\n]+?(?<=[^\s*])\*{2,3}(?![\w*])|(?<![\w_])__(?=[^\s_])(?![A-ZÆØÅ]+__)[^\n]+?(?<=[^\s_])__(?![\w_])"),
    ("markdown", "strike", 8, r"~~(?=\S)[^~\n]+?(?<=\S)~~"),
    ("markdown", "em", 4, rf"(?<![\w*\\])\*(?=[^\s*])(?:[^*\n]|{_P})+?(?<=[^\s*])\*(?![\w*])"),
    ("markdown", "em_", 4, rf"(?<![\w_\\/])_(?=[^\W_])(?:[^_\n]|{_P})+?(?<=[^\s_])_(?![\w_])"),
    ("markdown", "escape", 2.8, r"\\[*_#`\[\]()>!|~-]"),
]


def _compile() -> list[tuple[str, str, float, re.Pattern]]:
    out = []
    for lang, kind, weight, p in _SPEC:
        flags = re.M
        if lang == "html" or kind == "ref":
            flags |= re.I
        if kind in ("comment", "pre", "drop", "fence", "math", "verbatim", "ref", "template"):
            flags |= re.S
        out.append((lang, kind, float(weight), re.compile(p, flags)))
    return out


_CONSTRUCTS = _compile()
#: A sign (or one of several) that must stand in the text for any pattern of the group to match.
_NEED = {"html": "<&", "latex": "\\$", "wiki": "<{[='_~|#*:;!", "markdown": "#`~[*_|>=-<\\"}
_NEED_KIND = {
    ("html", "entity"): "&", ("latex", "dollar"): "$", ("latex", "dollar1"): "$", ("wiki", "ref"): "<", ("wiki", "template"): "{{", ("wiki", "link"): "[[", ("wiki", "quote"): "''",
    ("wiki", "head"): "==", ("wiki", "extlink"): "//", ("wiki", "table"): "|", ("wiki", "row"): ("||", "!!"), ("markdown", "fence"): ("```", "~~~"), ("markdown", "refdef"): "]:", ("markdown", "image"): "![",
    ("markdown", "link"): "](", ("markdown", "reflink"): "]", ("markdown", "note"): "[^", ("markdown", "autolink"): "<", ("markdown", "head"): "#", ("markdown", "task"): "[", ("markdown", "cells"): "|",
    ("markdown", "piped"): "|", ("markdown", "quote"): ">", ("markdown", "code"): "`", ("markdown", "strike"): "~~", ("markdown", "em"): "*", ("markdown", "em_"): "_", ("markdown", "escape"): "\\",
}


class Node:
    """A construct of the text: its span, language, kind, the cost of keeping it as content, and its parent element."""

    __slots__ = ("start", "end", "lang", "kind", "weight", "parent")

    def __init__(self, start: int, end: int, lang: str, kind: str, weight: float) -> None:
        self.start, self.end, self.lang, self.kind, self.weight, self.parent = start, end, lang, kind, weight, -1


#: Costs by (language, kind).
Costs = dict[tuple[str, str], float]


def constructs(text: str, costs: Costs | None = None) -> list[Node]:
    """Candidate constructs in order, without overlaps (an earlier pattern of _SPEC takes the span; emphasis and links may
    hold others and are kept with them)."""
    taken = bytearray(len(text))
    out: list[Node] = []
    for lang, kind, weight, rx in _CONSTRUCTS:
        need = _NEED_KIND.get((lang, kind))
        if need is not None:
            if need not in text if isinstance(need, str) else not any(x in text for x in need):
                continue
        elif not any(c in text for c in _NEED[lang]):
            continue
        for m in rx.finditer(text):
            s, e = m.span()
            if e == s or taken[s] or taken[e - 1] or kind == "entity" and html.unescape(m.group()) == m.group():
                continue
            out.append(Node(s, e, lang, kind, weight if costs is None else costs.get((lang, kind), weight)))
            if kind in ("strong", "em", "em_", "quote", "strike", "head", "piped", "row", "link", "arg"):
                taken[s] = taken[e - 1] = 1
            else:
                taken[s:e] = b"\x01" * (e - s)
    out.sort(key=lambda n: (n.start, -n.end))
    return out


#: Elements without content, and elements that the next one of their kind closes.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_CLOSES = {"li": ("li",), "p": ("p",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",)}
_NAME = re.compile(r"</?([a-zA-Z0-9]+)")


def _parents(text: str, nodes: list[Node]) -> None:
    """Parent element of each node, by a stack of open tags (and of LaTeX environments). A closing tag that closes nothing is
    passed over; an element whose end may be left out ends where the next one begins."""
    stack: list[tuple[str, int]] = []
    open_: dict[str, int] = {}

    def pop() -> str:
        k, _ = stack.pop()
        open_[k] -= 1
        return k

    for i, n in enumerate(nodes):
        g = text[n.start:n.end]
        name = _NAME.match(g).group(1).lower() if n.lang == "html" and n.kind == "tag" else ""
        if name and not g.startswith("</"):
            while stack and stack[-1][0] in _CLOSES.get(name, ()):
                pop()
        n.parent = stack[-1][1] if stack else -1
        if name:
            if g.startswith("</"):
                if open_.get(name):
                    while pop() != name:
                        pass
                    n.parent = stack[-1][1] if stack else -1
            elif not g.endswith("/>") and name not in _VOID:
                stack.append((name, i))
                open_[name] = open_.get(name, 0) + 1
        elif n.lang == "latex" and n.kind == "env":
            if g.startswith("\\begin"):
                stack.append(("\\env", i))
                open_["\\env"] = open_.get("\\env", 0) + 1
            elif open_.get("\\env"):
                while pop() != "\\env":
                    pass


#: Smoothness of the cut: between neighbours of one language, of different languages, between the children of one element, and
#: between a child and its element; and the hold of noise on what stands in it.
SAME, OTHER, PARENT, CHILD, HOLD = 1.2, 0.15, 0.8, 0.4, 24.0
#: Cost of calling a construct residue (what evidence has to outweigh); of calling a text run residue, without function words
#: and for each of them, up to the most.
PRIOR = 3.0
RUN, RUN_WORD, RUN_MOST = 2.0, 1.0, 6.0
NEAR = 160


def min_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Maximum flow by blocking flows in layers (Dinic); True for nodes on the source side. ``source[i]`` is the capacity from
    the source (lost if i ends on the sink side), ``sink[i]`` the one to the sink, ``edges`` are undirected. In graphs like
    these, chains with a few links, the layers are few and a round is linear."""
    n = len(source)
    rs, rt = list(source), list(sink)
    for i in range(n):  # the direct paths first
        f = min(rs[i], rt[i])
        rs[i] -= f
        rt[i] -= f
    adj: list[list[int]] = [[] for _ in range(n)]
    to: list[int] = []
    cap: list[float] = []
    for a, b, c in edges:
        adj[a].append(len(to))
        adj[b].append(len(to) + 1)
        to += [b, a]
        cap += [c, c]
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if rs[i] > 1e-9)
        for i in queue:
            level[i] = 0
        roots, goal = list(queue), False
        while queue:
            i = queue.popleft()
            goal = goal or rt[i] > 1e-9
            for e in adj[i]:
                if cap[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not goal:
            return [l >= 0 for l in level]
        at = [0] * n
        for r in roots:
            path: list[int] = []
            while rs[r] > 1e-9:
                i = to[path[-1]] if path else r
                if rt[i] > 1e-9:
                    f = min([rs[r], rt[i], *(cap[e] for e in path)])
                    rs[r] -= f
                    rt[i] -= f
                    back = len(path)
                    for k in range(len(path) - 1, -1, -1):
                        e = path[k]
                        cap[e] -= f
                        cap[e ^ 1] += f
                        if cap[e] <= 1e-9:
                            back = k
                    del path[back:]
                    continue
                while at[i] < len(adj[i]):
                    e = adj[i][at[i]]
                    if cap[e] > 1e-9 and level[to[e]] == level[i] + 1:
                        path.append(e)
                        break
                    at[i] += 1
                else:
                    if not path:
                        break
                    at[to[path.pop() ^ 1]] += 1


def run_cost(run: str) -> float:
    """Cost of calling a text run residue, by its function words; 0 for a blank one."""
    if not run or run.isspace():
        return 0.0
    return min(RUN_MOST, RUN + RUN_WORD * language_scores(WORD.findall(run.lower()))[0])


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans in order, those that meet made one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def label(text: str, nodes: list[Node], noise: list[tuple[int, int]] | None = None) -> list[bool]:
    """True for each construct that the cut puts on the side of residue. Constructs of one language that follow each other
    on one line (and in one place of noise, or none) form one unit of the graph, so that a table of many cells stays small."""
    if not nodes:
        return []
    _parents(text, nodes)
    noise = merged_spans(noise or [])
    starts = [s for s, _ in noise]
    place = [k if (k := bisect_right(starts, n.start) - 1) >= 0 and n.end <= noise[k][1] else -1 for n in nodes]
    units: list[list[int]] = []
    unit_of = [0] * len(nodes)
    for i, n in enumerate(nodes):
        p = nodes[units[-1][-1]] if units else None
        if p and p.lang == n.lang and n.weight >= 5 and p.weight >= 5 and place[i] == place[units[-1][-1]] and "\n" not in text[min(p.end, n.start):n.start]:
            units[-1].append(i)
        else:
            units.append([i])
        unit_of[i] = len(units) - 1
    source, sink, edges = [], [], []  # source side: content, sink side: residue
    held: dict[int, int] = {}
    for k in sorted({p for p in place if p >= 0}):
        held[k] = len(source)
        source.append(1e6)
        sink.append(0.0)
    me_of: list[int] = []
    last_by_parent: dict[int, int] = {}
    before, run_before = -1, -1
    piped = sum(nodes[u[0]].kind == "piped" for u in units)
    for k, u in enumerate(units):
        a = nodes[u[0]]
        w = min(12.0, sum(nodes[i].weight for i in u))
        if a.kind == "piped" and piped >= 2:
            w += 1.5  # rows of one shape after another
        prev_end = nodes[units[k - 1][-1]].end if k else 0
        cost = run_cost(text[prev_end:a.start])
        if cost:  # a text run between the constructs
            run_before = len(source)
            source.append(cost)
            sink.append(0.0)
            if before >= 0:
                edges.append((before, run_before, OTHER))
            edges.append((run_before, run_before + 1, OTHER))
        me = len(source)
        source.append(PRIOR)
        sink.append(max(0.0, w))
        me_of.append(me)
        if before >= 0:
            p = nodes[units[k - 1][-1]]
            if a.start - p.end <= NEAR:
                edges.append((before, me, SAME if p.lang == a.lang else OTHER))
        if place[u[0]] >= 0:
            edges.append((held[place[u[0]]], me, HOLD))
        if a.parent >= 0:
            q = last_by_parent.get(a.parent, -1)
            if q >= 0 and q != before:
                edges.append((q, me, PARENT))
            up = me_of[unit_of[a.parent]]
            if up != me:
                edges.append((up, me, CHILD))
        last_by_parent[a.parent] = me
        before = me
    side = min_cut(source, sink, edges)
    out = [False] * len(nodes)
    for u, me in zip(units, me_of):
        for i in u:
            out[i] = not side[me]
    return out


_LOGLINE = re.compile(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d", re.M)
_NOISE = re.compile(r"(?<=[^\W\d_])[^\w\s'’\-/](?=[^\W\d_])|[^\w\s]{3,}|[%^§=+?]")


_JSONLINE = ('{"', '[{"', "['")
_ADDRESS = re.compile(r"\S+://\S+")
#: Constructs whose content is code or no text: what stands in them says nothing about the text around.
_HOLDERS = frozenset(("fence", "pre", "verbatim", "drop", "comment", "math", "dollar"))
_BLANK_LINE = re.compile(r"\n[ \t]*(?=\n)")


def _outside(text: str, nodes: list[Node], start: int, end: int) -> str:
    """The text from start to end without holders and addresses, and without the signs of other sure constructs."""
    out, at = [], start
    for n in nodes:
        if n.end <= at or n.start >= end:
            continue
        if n.kind in _HOLDERS:
            out += [text[at:max(at, n.start)], " "]
            at = n.end
        elif (n.weight >= 7 or n.kind == "autolink") and n.start >= at:  # their signs are no noise, their words count
            out += [text[at:n.start], re.sub(r"<[^<>]*>|[^\w\s]+", " ", _ADDRESS.sub(" ", text[n.start:n.end]) if n.kind != "autolink" else "")]
            at = n.end
    rest = "".join(out) + text[at:end]
    return _ADDRESS.sub(" ", rest) if "://" in rest else rest


class _Places:
    """The constructs that reach into a place, found by bisection: they come in the order of their starts, and the greatest end
    of those before tells how far back to look."""

    def __init__(self, nodes: list[Node]) -> None:
        self.nodes = nodes
        self.starts = [n.start for n in nodes]
        self.reach = list(accumulate((n.end for n in nodes), max))

    def within(self, start: int, end: int) -> list[Node]:
        return self.nodes[bisect_right(self.reach, start):bisect_left(self.starts, end)]


def _noisy(rest: str) -> tuple[bool, bool]:
    """Whether what stands outside the constructs is encoded or unreadable; whether it is text by its function words."""
    words = rest.split()
    common, _ = language_scores([w.lower() for w in WORD.findall(rest)])
    is_text = common >= 3 and common * 12 >= len(words)
    if len(rest) > 25 * max(1, len(words)) and rest.strip():
        return True, is_text
    return len(rest) >= 60 and common * 12 < len(words) and len(_NOISE.findall(rest)) * 9 > len(rest), is_text


def noise_spans(text: str, nodes: list[Node]) -> list[tuple[int, int]]:
    """Places of machine output and unreadable signs, whose signs are no markup: lines of JSON, blocks of logs, encoded
    blocks, symbol noise. Blocks end at blank lines; what stands in code, formulas and comments is not judged."""
    places = _Places(nodes)
    held = _Places([n for n in nodes if n.kind in _HOLDERS])
    spans: list[tuple[int, int]] = []
    cuts = [0, *(m.end() for m in _BLANK_LINE.finditer(text)), len(text)]
    whole, _ = _noisy(_outside(text, nodes, 0, len(text)))
    for s, e in zip(cuts, cuts[1:]):
        logs = lines = 0
        at = s
        for l in text[s:e].split("\n"):
            here, at = at, at + len(l) + 1
            if not l.strip() or any(n.start <= here and here + len(l) <= n.end for n in held.within(here, here + 1)):
                continue
            lines += 1
            logs += bool(_LOGLINE.match(l))
            if l.lstrip().startswith(_JSONLINE) and l.count('":') >= 2:
                spans.append((here, here + len(l)))
        if logs * 2 > lines:
            spans.append((s, e))
        elif len(cuts) == 2:
            if whole:
                spans.append((s, e))
        else:
            rest = _outside(text, places.within(s, e), s, e)
            noisy, is_text = _noisy(rest)
            if noisy or whole and not is_text and rest.strip():
                spans.append((s, e))
    return spans


def residue(text: str, costs: Costs | None = None) -> list[Node]:
    """Constructs that the cut calls residue."""
    nodes = constructs(text, costs)
    if not nodes:
        return []
    return [n for n, m in zip(nodes, label(text, nodes, noise_spans(text, nodes))) if m]


def found(text: str, costs: Costs | None = None) -> list[str]:
    """Languages of which residue is in the text."""
    return sorted({n.lang for n in residue(text, costs)})


#: Texts of the sample the costs are fitted on, and the weight of the first setting in texts.
SAMPLE, FIRST = 5_000, 30.0


def kinds_seen(text: str) -> list[tuple[str, str, bool]]:
    """(language, kind, in noise) of a text's constructs, each once."""
    nodes = constructs(text)
    spans = merged_spans(noise_spans(text, nodes)) if nodes else []
    starts = [s for s, _ in spans]
    return sorted({(n.lang, n.kind, (k := bisect_right(starts, n.start) - 1) >= 0 and n.end <= spans[k][1]) for n in nodes})


def costs_of(counts: dict[tuple[str, str], tuple[int, int]]) -> Costs:
    """Cost of leaving a construct as content: the first setting of its kind, and the logarithm of the share of the kind's texts
    in which it stands outside noise (texts outside, texts inside). The first setting counts as FIRST texts, so a kind
    seldom seen keeps it, and one that the corpus mostly has in noise becomes doubtful everywhere."""
    out: Costs = {}
    for lang, kind, weight, _ in _CONSTRUCTS:
        outside, inside = counts.get((lang, kind), (0, 0))
        n = outside + inside
        out[lang, kind] = weight + n / (n + FIRST) * math.log((outside + 0.5) / (n + 0.5))
    return out


def fitted_costs(docs: DataFrame, key: str, text: str, sample: int = SAMPLE) -> Costs:
    """Costs fitted on about ``sample`` texts with signs, chosen by the hash of their content: a bound that does not grow. The
    driver gets one row for each kind of construct."""
    c = candidates(docs, text).select(F.col(text).alias("t"))
    n = c.count()
    if n > sample:
        c = c.where(F.pmod(F.xxhash64("t"), F.lit(1 << 30)) < F.lit(int(sample / n * (1 << 30))))
    seen = flat_map_rows(c, ["t"], kinds_seen, "lang string, kind string, noise boolean")
    rows = seen.groupBy("lang", "kind").agg(F.count_if(~F.col("noise")).alias("outside"), F.count_if("noise").alias("inside")).collect()  # at most one row a kind of construct
    return costs_of({(r.lang, r.kind): (r.outside, r.inside) for r in rows})


# ------------------------------------------------------------------ clean text

#: Linear forms of LaTeX commands in formulas.
_GREEK = dict(zip("alpha beta gamma delta epsilon zeta eta theta lambda mu nu xi pi rho sigma tau phi chi psi omega".split(), "αβγδεζηθλμνξπρστφχψω"))
_SYMBOL = _GREEK | {"leq": "≤", "le": "≤", "geq": "≥", "ge": "≥", "neq": "≠", "ne": "≠", "times": "×", "cdot": "·", "pm": "±", "infty": "∞", "approx": "≈", "sum": "∑", "prod": "∏", "int": "∫", "in": "∈", "to": "→", "rightarrow": "→", "partial": "∂", "ldots": "…", "dots": "…", "cdots": "…"}
_SUP = str.maketrans("0123456789", "⁰¹²³⁴⁵⁶⁷⁸⁹")


def linear(formula: str) -> str:
    """A LaTeX formula as one line of plain text."""
    s = re.sub(r"\\(?:begin|end)\{[\w*]+\}|\\label\{[^}]*\}", " ", formula.strip("$"))
    s = re.sub(r"^\\[\[(]|\\[\])]$", "", s.strip())
    while True:  # each round takes braces away
        t = re.sub(r"\\d?frac\{([^{}]*)\}\{([^{}]*)\}", r"(\1)/(\2)", s)
        t = re.sub(r"\\sqrt\{([^{}]*)\}", r"√(\1)", t)
        t = re.sub(r"\\(?:text|mathrm|mathbf|mathit|operatorname)\{([^{}]*)\}", r"\1", t)
        t = re.sub(r"([\^_])\{([^{}\\]*)\}", lambda m: m.group(1) + (m.group(2) if len(m.group(2)) == 1 else f"({m.group(2)})"), t)
        if t == s:
            break
        s = t
    s = re.sub(r"\\([a-zA-Z]+)", lambda m: _SYMBOL.get(m.group(1), m.group(1)), s)
    s = re.sub(r"\\\\", "; ", s).replace("&", " ").replace("\\", "")
    return re.sub(r"\s+", " ", s).strip()


def _indented(code: str) -> str:
    return "\n" + "\n".join("    " + l for l in html.unescape(code).strip("\n").split("\n")) + "\n"


def _cells(row: str, sep: str) -> str:
    return "\t".join(c.strip() for c in re.split(sep, row.strip().strip("|!")))


def _rewrite(n: Node, g: str, entry: str = "- ") -> str:
    """Clean form of one construct; ``entry`` is the mark of a list's entry."""
    k = n.kind
    if n.lang == "html":
        if k == "entity":
            return html.unescape("&" + re.sub(r"^&(?:amp;)*(?=.)", "", g)).replace("\u00a0", " ")  # however often it was escaped
        if k == "pre":
            return _indented(re.sub(r"<[^<>]+>", "", g))
        if k == "tag":
            name = re.match(r"</?([a-zA-Z0-9]+)", g).group(1).lower()
            close = g.startswith("</")
            if name in ("h1", "h2", "h3", "h4", "h5", "h6"):
                return "\n\n"
            if name in ("li", "dt", "dd"):
                return "" if close else f"\n{entry}"
            if name in ("td", "th"):
                return "\t" if close else ""
            if name in ("p", "div", "tr", "ul", "ol", "table", "blockquote", "section", "article", "dl", "br", "hr"):
                return "\n"
            if name in ("sup", "sub"):
                return "" if close else ("^" if name == "sup" else "_")
            if name == "img":
                m = re.search(r"alt\s*=\s*\"([^\"]*)\"|alt\s*=\s*'([^']*)'", g, re.I)
                return (m.group(1) or m.group(2) or "") if m else ""
        return ""
    if n.lang == "markdown":
        if k == "fence":
            return _indented("\n".join(g.strip().split("\n")[1:-1])) if "\n" in g.strip() else ""
        if k == "head":
            return "\n" + re.sub(r"^\s*#+[ \t]+|[ \t]*#+[ \t]*$", "", g) + "\n"
        if k == "image":
            return re.match(r"!\[([^\]\n]*)\]", g).group(1)
        if k in ("link", "reflink"):
            return re.match(r"\[([^\[\]\n]+)\]", g).group(1)
        if k in ("code",):
            return g.strip("`")
        if k in ("strong", "strike", "em", "em_"):
            return re.sub(r"^[*_~]{1,3}|[*_~]{1,3}$", "", g)
        if k == "task":
            return "-"
        if k == "piped":
            return _cells(g, r"(?<!\\)\|")
        if k == "autolink":
            return g[1:-1]
        if k == "escape":
            return g[1:]
        return ""
    if n.lang == "wiki":
        if k == "link":
            inner = g[2:-2]
            if re.match(r"\s*(?:kategori|category|fil|file|billede|image|kategorie|datei|bild)\s*:", inner, re.I):
                return ""
            return inner.rsplit("|", 1)[-1].strip()
        if k == "quote":
            return g.strip("'")
        if k == "head":
            return "\n" + g.strip().strip("=").strip() + "\n"
        if k == "row":
            return _cells(g, r"\|\||!!")
        if k == "extlink":
            p = g[1:-1].split(" ", 1)
            return p[1] if len(p) > 1 else ""
        if k == "entry":
            return "- "
        return ""
    if k in ("math", "dollar", "dollar1"):
        block = g.startswith(("\\[", "$$", "\\begin"))
        return "\n" + linear(g) + "\n" if block else linear(g)
    if k == "verbatim":
        return _indented(re.sub(r"\\(?:begin|end)\{\w+\}", "", g))
    if k == "head":
        return "\n" + g[g.index("{") + 1:-1] + "\n"
    if k == "arg":
        name = re.match(r"\\([a-zA-Z]+)", g).group(1)
        if name in ("label", "cite", "citep", "citet", "ref", "eqref", "pageref", "bibliography", "bibliographystyle", "usepackage", "documentclass", "includegraphics", "input", "vspace", "hspace", "index"):
            return ""
        if name in ("frac", "sqrt"):
            return linear(g)
        args = re.findall(r"\{([^{}\n]*)\}", g)
        return args[-1] if args else ""
    if k == "command":
        name = g.strip(" \t\\*")
        return entry if name == "item" else _SYMBOL.get(name, "")
    return ""


_SPACE = re.compile(r"\s+")


_ORDERED = re.compile(r"<ol\b|\\begin\{enumerate", re.I)
_HEADING = re.compile(r"<h([1-6])\b", re.I)
_SECTIONS = {"part": 1, "chapter": 1, "title": 1, "section": 1, "subsection": 2, "subsubsection": 3, "paragraph": 4, "subparagraph": 5}


def headings(text: str, nodes: list[Node]) -> list[tuple[int, str]]:
    """(level, heading) of the headings among the constructs, in order."""
    out = []
    for i, n in enumerate(nodes):
        g = text[n.start:n.end]
        if n.kind == "tag" and (m := _HEADING.match(g)):
            end = next((x for x in nodes[i + 1:] if x.kind == "tag" and re.match(r"</h[1-6]", text[x.start:x.end], re.I)), None)
            if end:
                out.append((int(m[1]), _SPACE.sub(" ", re.sub(r"<[^<>]*>", "", text[n.end:end.start])).strip()))
        elif n.kind == "head" and n.lang == "markdown":
            t = g.strip()
            out.append((len(t) - len(t.lstrip("#")), t.strip("#").strip()))
        elif n.kind == "head" and n.lang == "wiki":
            t = g.strip()
            out.append((len(t) - len(t.lstrip("=")), t.strip("=").strip()))
        elif n.kind == "head" and (m := re.match(r"\\([a-z]+)\*?\{([^{}\n]*)", g)) and m[1] in _SECTIONS:
            out.append((_SECTIONS[m[1]], m[2].strip()))
        elif n.kind == "setext":
            out.append((1 if g.lstrip().startswith("=") else 2, text[:n.start].rstrip("\n").rsplit("\n", 1)[-1].strip()))
    return out


def cleaned_text(text: str, costs: Costs | None = None) -> tuple[str, list[tuple[int, str]]]:
    """The text with its residue rewritten, and its headings with their levels. Repeated until no residue is left (an
    escaped tag becomes one); each round but the last takes signs away, so it ends."""
    size = len(_SPACE.sub("", text)) + 1
    heads: list[tuple[int, str]] = []
    while (left := len(_SPACE.sub("", text))) < size:
        size = left
        nodes = constructs(text, costs)
        marks = label(text, nodes, noise_spans(text, nodes)) if nodes else []
        todo = [n for n, m in zip(nodes, marks) if m]
        if not todo:
            break
        heads = heads or headings(text, todo)
        out, at, numbers = [], 0, {}
        for n in todo:
            if n.start < at:
                continue  # inside a construct that was rewritten: the next round takes it
            entry = "- "
            if n.parent >= 0 and _ORDERED.match(text, nodes[n.parent].start) and (n.kind == "tag" and text[n.start + 1:n.start + 3].lower() == "li" or n.kind == "command"):
                numbers[n.parent] = numbers.get(n.parent, 0) + 1
                entry = f"{numbers[n.parent]}. "
            out += [text[at:n.start], _rewrite(n, text[n.start:n.end], entry)]
            at = n.end
            if n.kind in ("cells", "table") and text[at:at + 1] == "\n":
                at += 1  # a table's rule leaves no blank line inside it
        new = "".join(out) + text[at:]
        new = re.sub(r"[ \t]+(?=\n)", "", new)
        new = re.sub(r"\n{3,}", "\n\n", new)
        if new == text:
            break
        text = new
    return text.strip("\n"), heads


def clean_text(text: str, costs: Costs | None = None) -> str:
    return cleaned_text(text, costs)[0]


# ------------------------------------------------------------------ operators

def candidates(docs: DataFrame, text: str) -> DataFrame:
    return docs.where(F.col(text).rlike(SIGNS))


def markup_found(docs: DataFrame, key: str = "paragraph_id", text: str = "paragraph", costs: Costs | None = None) -> DataFrame:
    """Distinct (key, markup): the languages whose residue is in the text. Costs are fitted on a sample if not given."""
    kind = docs.schema[key].dataType.simpleString()
    d = docs.where(F.col(key).isNotNull())
    fit = costs or fitted_costs(d, key, text)
    return flat_map_rows(candidates(d, text), [key, text], lambda k, t: [(k, m) for m in found(t, fit)], f"`{key}` {kind}, markup string").distinct()


def cleaned(docs: DataFrame, key: str = "paragraph_id", text: str = "paragraph", costs: Costs | None = None) -> DataFrame:
    """(key, clean, changed, headings) for each row of the table; ``headings`` are the (level, heading) of the residue. Texts
    without any sign pass by on the JVM."""
    fit = costs or fitted_costs(docs, key, text)
    has = F.coalesce(F.col(text).rlike(SIGNS), F.lit(False))
    kind = "array<struct<level:int,heading:string>>"
    rest = docs.where(~has).select(key, F.col(text).alias("clean"), F.lit(False).alias("changed"), F.array().cast(kind).alias("headings"))

    def one(t: str) -> tuple:
        c, heads = cleaned_text(t, fit)
        return (c, c != t, [{"level": l, "heading": h} for l, h in heads])

    return map_rows(docs.where(has), [key], [text], one, f"clean string, changed boolean, headings {kind}").unionByName(rest)
