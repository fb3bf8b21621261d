"""Evidence that a text stops before its last sentence is finished, as a log-likelihood ratio (positive: cut).

A finished sentence (-9) outweighs any posterior of a limit: length alone makes no case."""

from __future__ import annotations

import re

from .common import ABBREVIATIONS, _MASK

#: Marks and hints of omission at the end of a text.
OMITTED = re.compile(
    r"(?:[(\[]\s*(?:\.{3}|…)\s*[)\]]|(?:\.{3}|…)?\s*[(\[»]?\b(?:læs (?:mere|videre)|se mere|vis mere|fortsættes|fortsæt læsning(?:en)?|read more|continue reading|"
    r"läs mer|fortsätt läsa|mehr lesen|weiterlesen|(?:tekst|text)en? (?:er )?(?:for)?kortet|forkortet|truncated)\b\s*(?:\.{3}|…|→|»|>|\.)*[)\]]?)\s*$",
    re.I,
)
HINT_ALONE = re.compile(r"(?:\.{3}|…|[(\[])\s*[^\n.!?]{0,25}$|[^.!?»«”\"]\s+\S+ \S+[^\w\s]*$")
GLUED = re.compile(r"[\w,;:](?:…|\.{3,})[\"'»«”“’)\]]*$")
SPACED = re.compile(r"\s(?:…|\.{3})[\"'»«”“’)\]]*$")
HYPHEN = re.compile(r"[^\W\d_][-‐¬]$")
STOP = re.compile(r"([.!?]+)[\"'»«”“’)\]*_]*$")
MARKED = re.compile(r"\s*(?:[-–—*•·+]|\(?\d{1,3}[.)]|\(?[a-z][.)]|\\item\b)\s+\S")
LABEL = re.compile(r"\s*[A-ZÆØÅÄÖÜ][\w .-]{1,30}:\s*\S|\s*(?:med (?:venlig|kærlig) hilsen|venlig hilsen|hilsen|mvh|med vänlig hälsning|mit freundlichen grüßen|(?:kind|best) regards|yours)\b", re.I)
MARKUP = re.compile(r"(?:>|\]\]|\}\}|\||`|\\\]|\$|\}|==+)\s*$")
SENTENCE_END = re.compile(r"[.!?…][\"'»«”“’)\]]*\s+(?=[\"'»«„“(]?[A-ZÆØÅÄÖÜ0-9–-])")
#: Abbreviations that may well close a sentence.
CLOSING_ABBREVIATIONS = frozenset("v m mv o osv etc al usw kr mio mia st u a d h aar".split())


BLANKS = " \t\r\n\u00a0\u200b\u2028\ufeff"


def _last_fragment(line: str) -> tuple[str, bool]:
    """What follows the last finished sentence of the line; whether a finished sentence stands before it."""
    at = 0
    for m in SENTENCE_END.finditer(line):
        k = m.start()
        b = k
        while b > 0 and line[b - 1].isalnum():
            b -= 1
        w = line[b:k].lower()
        if line[k] == "." and (w in ABBREVIATIONS or len(w) == 1 and w.isalpha()):
            continue
        at = m.end()
    return line[at:], at > 0


def function_word(w: str) -> bool:
    return w.lower() in _MASK


def ending_evidence(text: str | None, original: str | None = None) -> float:
    """Log-likelihood ratio of cut against whole. ``original``: the longer text the value was taken from, if known.
    Null and blank texts give -9 (nothing was cut off)."""
    t = (text or "").rstrip(BLANKS)
    if not t:
        return -9.0
    follow, whole = None, t
    if original:
        k = original.find(t)
        end = k + len(t) if k >= 0 else -1
        if end < 0:  # not letter for letter: the last words, whatever white space parts them
            found = re.search(r"\s+".join(map(re.escape, t[-80:].split()[-6:])) + r"(?!\w)", original)
            end = found.end() if found else -1
        if end >= 0:
            follow = original[end:]
            whole = original[:end]
    tail = t[-160:]
    m = OMITTED.search(tail)
    if m and (m.group().strip()[:1] in "….([" or HINT_ALONE.search(tail[: m.start()].rstrip() + " x y")):
        return 7.0
    if GLUED.search(tail):
        return 6.0
    if follow is not None and follow[:1].isalnum():
        return 7.0
    if SPACED.search(tail):
        before = re.findall(r"[^\W\d_]+", SPACED.split(tail)[0][-60:])
        if before and function_word(before[-1]):
            return 5.0
        if original:
            return 4.0 if follow is None and original.rstrip() != t else -6.0
        return 3.5 if "..." in SPACED.search(tail).group() else -6.0  # an author's pause is one sign, a machine's cut three stops
    if HYPHEN.search(tail):
        return 6.0
    rest = follow.split("\n", 1)[0].strip(BLANKS) if follow is not None else ""
    line = whole.rsplit("\n", 1)[-1]
    s = STOP.search(tail)
    if s:
        b = e = s.start()
        while b > 0 and tail[b - 1].isalnum():
            b -= 1
        w = tail[b:e].lower()
        if s.group() == "." and (w in ABBREVIATIONS or len(w) == 1 and w.isalpha()):
            if rest and (rest[0].islower() or rest[0].isdigit() or rest[0] in "§,"):
                return 6.0
            if w in CLOSING_ABBREVIATIONS or len(w) < 2:
                return -6.0
            return 3.5
        if s.group() == "." and w.isdigit() and rest and (rest[0].islower() or rest[0].isdigit()):
            return 6.0
        return -9.0
    if rest and rest[0] not in "…":
        return -4.0 if rest in ("»", "«", '"', "”", ")") else 6.0
    if MARKUP.search(tail):
        return -2.0
    if t[-1] in "»«\"”’)" and len(t) > 1 and t[-2] in ".!?…":
        return -9.0
    fragment, after = _last_fragment(line)
    ws = fragment.split()
    closed_line = follow is not None and follow[:1] == "\n"
    if t[-1] == ":":
        return 1.0
    if not after:
        if MARKED.match(line) or LABEL.match(line):
            return -4.0 if closed_line else -3.0
        if len(ws) <= 3 and not closed_line:
            return 3.0
        caps = sum(x[:1].isupper() or x[:1].isdigit() for x in ws)
        names = caps * 5 >= 3 * len(ws) and not function_word(ws[-1]) or ws[-1][:1].isdigit() and len(ws) >= 4 and caps * 5 >= 2 * len(ws)
        if names or line.isupper():
            return -3.0 if closed_line else -2.0
        if closed_line:
            return -3.0
    elif closed_line:
        return -1.0
    if function_word(ws[-1]) or t[-1] in ",;(»„":
        return 6.0
    return 4.0
