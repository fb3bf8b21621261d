"""Problem 3: defective instruction-response pairs, with the type of the defect.

Method: a refusal grammar over all sentences of either side; greedy string tiling of the answer with the instruction for
copies, with rolling hashes and marked tokens on both sides; script and function-word checks for the language, with the language an instruction may ask for;
a pushdown parser of quotations, brackets, fences and markup, joined with the evidence of the ending, for truncation.

A null, blank or stand-in answer is ``empty``; a null instruction is read as an empty one. Empty, refusal and copy exclude
each other (in this order) and the rest; ``truncated`` and ``language`` may both hold.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _MASK, CLOSED, LANGS, WORD, flat_map_rows, language_scores, sentences
from .endings import ending_evidence
from .markup import _TAGS

#: Stand-ins for a missing value, after signs around them are taken off.
STAND_INS = frozenset(
    "none null nil nan n/a na n.a #n/a undefined missing empty tom tomt ingen intet mangler todo tbd tba xxx ukendt unknown "
    "keine inget saknas fehlt".split()
) | {"ingen tekst", "ingen data", "ikke angivet", "ikke relevant", "no text", "no data", "not available", "not applicable", "ingen text", "kein text", "ingen værdi", "intet svar", "no answer", "mangler tekst", "intet indhold", "no content"}
_SIGNS = " \t\r\n\x0b\x0c                 　​‌‍﻿⁠­" + "\"'»«”“’‘()[]{}<>.…-–—_*#|/\\,;:!?`~=+"

_CANNOT = r"(?:(?:kan|må|vil) jeg|jeg (?:kan|må|vil)) (?:\w+ )?ikke(?: (?:dig|jer|dem|her|det|heller|desværre))?"
#: The grammar of refusals, by language. OPENER may come before the core, AFTER may follow it.
OPENER = re.compile(
    r"(?:(?:jeg )?(?:beklager|må beklage)|undskyld|desværre|hmm+|øh|åh|tak for (?:dit|dine|spørgsmålet)[^,.!]*|det er jeg ked af|det gør mig ondt|som (?:en )?(?:ai|sprogmodel|ai-model|ai-assistent|assistent)[^,]*|"
    r"i['’]?m (?:very |so |really )?sorry|i am (?:very |so )?sorry|sorry|i apologi[sz]e|my apologies|unfortunately|regrettably|as an? (?:ai|large |language|assistant)[^,]*|thank you for[^,.]*|"
    r"tyvärr|jag beklagar|förlåt|ursäkta|som (?:en )?språkmodell[^,]*|leider|es tut mir leid|tut mir leid|entschuldigung|als (?:ki|sprachmodell)[^,]*)[\s,.!:;–-]*(?:men |but |aber |og |at |, ?)?",
    re.I,
)
CORE = re.compile(
    r"(?:" + _CANNOT + r" (?:hjælpe|svare|besvare|give|skrive|udføre|opfylde|imødekomme|bistå|lave|generere|formulere|udtale|assistere|gøre det|levere|løse|behandle)\b"
    r"|(?:det|dette|den|her|den opgave|spørgsmålet|dette spørgsmål)(?: her)? (?:kan|må|vil|skal) jeg (?:desværre |altså )?(?:ikke (?:svare|hjælpe|give|besvare|skrive|løse|udtale)|afvise|afslå|takke nej|lade være)"
    r"|jeg må (?:desværre |hellere )?(?:takke nej|afvise|afslå|melde pas|sige nej|undlade)"
    r"|jeg (?:har|ser) (?:desværre )?ikke (?:mulighed for|nogen mulighed)|jeg er (?:desværre )?ikke i stand til"
    r"|(?:det er|er det) (?:desværre )?(?:ikke|umuligt|ikke muligt)(?: muligt| noget)?(?: for mig)? (?:at |jeg kan )(?:skrive|svare|hjælpe|besvare|give|lave)"
    r"|det er (?:desværre )?ikke muligt|det ligger uden ?for,? hvad jeg|teksten (?:giver|indeholder|rummer) (?:mig )?(?:desværre )?ikke (?:nok|tilstrækkelig)|jeg (?:afviser|afslår|ønsker ikke)"
    r"|i (?:cannot|can['’]?t|can not|could not|am not able|am unable|['’]?m not able|['’]?m unable|won['’]?t|will not|must decline|have to decline|decline|do not have|don['’]?t have)(?: to)?\b"
    r"|(?:it is|it['’]s) (?:not possible|impossible) for me|i['’]?m (?:not able|unable)"
    r"|jag kan (?:tyvärr |dessvärre )?inte (?:hjälpa|svara|skriva|ge|besvara)|jag har inte möjlighet|jag måste (?:tyvärr )?(?:avböja|tacka nej)|det kan jag (?:tyvärr )?inte (?:svara|hjälpa)|det är inte möjligt för mig"
    r"|ich kann (?:leider |dir |ihnen |das |diese[rn]? |dabei |dazu |darauf )*(?:nicht|keine)|das kann ich (?:leider )?nicht|es ist mir (?:leider )?nicht möglich|ich bin nicht in der lage|ich muss (?:das |leider )*ablehnen)",
    re.I,
)
AFTER = re.compile(
    r"(?:prøv|har du|spørg|stil|du kan|du er velkommen|jeg (?:hjælper|kan hjælpe|vil gerne|kan i stedet)|kan jeg|sig til|skriv|kontakt|please|try|is there|feel free|you can|let me know|i (?:can|would)|if you|ask|"
    r"försök|har du|fråga|du kan|jag hjälper|versuch|haben sie|hast du|fragen|frag|stellen)",
    re.I,
)
#: What a refusal declines to do. A core that names none of it ("I don't have") may open any sentence.
TASK = re.compile(
    r"\b(?:hjælpe|svare|besvare|give|skrive|udføre|opfylde|imødekomme|bistå|lave|generere|formulere|udtale|assistere|levere|løse|behandle|takke nej|afvise|afslå|melde pas|sige nej|undlade|"
    r"help|assist|answer|respond|reply|comply|fulfil+|provide|write|do that|do this|decline|hjälpa|svara|besvara|avböja|tacka nej|helfen|beantworten|antworten|schreiben|ablehnen)\b",
    re.I,
)
#: Words of a speaker who goes on about the refusal (reasons, offers), and of one who is only quoted.
ABOUT = re.compile(
    r"\b(?:jeg|mig|min|mit|mine|du|dig|din|dit|dine|spørgsmål\w*|opgave\w*|anmodning\w*|forespørgsel\w*|oplysninger|retningslinjer\w*|sprogmodel\w*|assistent\w*|i|my|me|you|your|question|request|task|guidelines|"
    r"information|jag|fråga\w*|uppgift\w*|ich|mich|mein\w*|frage\w*|aufgabe\w*)\b",
    re.I,
)
QUOTED = re.compile(r"[«»\"“”]\s*,?\s*(?:sagde|siger|skrev|lød|svarede|said|says|sade|sagte)\b|\b(?:sagde|svarede|skrev|said|sade|sagte) (?:han|hun|de|jeg|he|she|they|hon|er|sie)\b", re.I)


def is_refusal(text: str) -> bool:
    """Openers, then the core of a refusal; then every sentence that follows is read, however many there are. A core that
    names the task declines it, unless the rest mostly tells something of its own (sentences that neither offer nor
    give reasons). A core that names no task, or one without an opener, needs a rest of offers and reasons only."""
    t = text.strip(" \t\r\n\"'»«“”")
    at = 0
    for _ in range(4):
        m = OPENER.match(t, at)
        if not m or m.end() == at:
            break
        at = m.end()
    m = CORE.match(t, at)
    if not m:
        m = re.match(r"(?:\w+,? ){0,3}", t[at:])
        m = CORE.match(t, at + m.end()) if m else None
        if not m or at == 0:
            return False
    parts = sentences(t[m.end():])
    first, rest = (parts[0], parts[1:]) if parts else ("", [])
    if QUOTED.search(first):
        return False
    if all(AFTER.match(x) or len(x.split()) <= 3 for x in rest) and len(first.split()) <= 40:
        return True
    if not TASK.search(f"{m.group()} {first}") or len(first.split()) > 25:
        return False
    own = [x for x in rest if not (AFTER.match(x) or len(x.split()) <= 3 or ABOUT.search(x) or CORE.search(x))]
    return 2 * sum(map(len, own)) <= sum(map(len, rest)) or at > 0 and not re.search(r"\b(?:men|but|aber)\b[^.!?]*:?\s*$", first, re.I)


#: Names of languages in instructions that ask for one.
ASKED = re.compile(
    r"\b(?:på|til|in|auf|into|ins?)\s+(?:det |the )?(?:(engelsk[ae]?|english|englisch)|(dansk[a]?|danish|dänisch)|(svensk[ae]?|swedish|schwedisch)|(tysk[ae]?|german|deutsch))\b", re.I
)
_ASKED_LANG = ("en", "da", "sv", "de")
_SCRIPT = re.compile(r"\b[a-zåäöüß]*[æøäöüß]\w*")


def language_profile(text: str, script: bool = False) -> list[float]:
    """Weight of each of LANGS by function words; ``script``: with the letters of lower-case words as support."""
    _, s = language_scores(WORD.findall(text.lower()))
    if script:
        for w in _SCRIPT.findall(text):
            if "æ" in w or "ø" in w:
                s[0] += 0.3
            elif "ß" in w or "ü" in w:
                s[3] += 0.3
            else:
                s[1] += 0.15
                s[3] += 0.15
    return s


def top_language(s: list[float], least: float) -> str | None:
    k = max(range(4), key=s.__getitem__)
    return LANGS[k] if s[k] >= least and s[k] > sum(sorted(s)[-2:-1]) else None


#: Function words of further languages, so that their sentences are not taken for one of LANGS.
_FOREIGN = {
    "fr": "le la les des est une dans pour que qui sur pas avec au aux ce cette il elle sont ont été plus par ne se sa son ses nous vous mais ou où leur de du et en un",
    "es": "el la los las es una en por para que con del al se su sus no como más pero fue son muy también desde hay este esta lo y o de un",
    "it": "il la lo gli le è una per che con del della dei delle di non si nel nella sono come più ma anche al alla da dal questo questa e un in",
    "pt": "o a os as é uma em por para que com do da dos das no na não se seu sua como mais mas foi são ao à também este esta e de um",
    "nl": "de het een van en is in dat op te zijn met voor niet aan er ook als bij maar om uit door naar heeft werd wordt deze dit hij zij ze of",
    "no": "av etter noe noen hva nå ble mye mellom uten seg deg meg dere og i at det er en den til på for ikke som et jeg om vi du fra så men hun kan vil ved",
    "pl": "w i na z do się nie jest że to jak po od za przez dla są był była było który która które ale oraz czy może tym tego tej jego jej ich lub",
    "fi": "ja on ei se että oli hän mutta ovat kun niin myös joka tai jos sen ole kuin mukaan jo vain siitä mitä hänen tämä tässä sekä",
}
_FOREIGN = {l: frozenset(w.split()) for l, w in _FOREIGN.items()}
_ONLY_FOREIGN = {l: w - _MASK.keys() for l, w in _FOREIGN.items()}
_ANY_FOREIGN = frozenset().union(*_ONLY_FOREIGN.values())
#: Names of further languages an instruction may ask for, with their script.
ASKED_OTHER = re.compile(
    r"\b(?:på|til|in|auf|into|ins?)\s+(?:det |the )?(?:(?P<no>norsk|norwegian|norwegisch)|(?P<cyrillic>russisk|ryska|russian|russisch|ukrainsk|ukrainska|ukrainian|bulgarsk|bulgarian)|(?P<greek>græsk|grekiska|greek|griechisch)"
    r"|(?P<arabic>arabisk|arabiska|arabic|arabisch|persisk|persian|urdu)|(?P<cjk>kinesisk|kinesiska|chinese|chinesisch|japansk|japanska|japanese|japanisch)|(?P<hangul>koreansk|koreanska|korean|koreanisch)"
    r"|(?P<latin>fransk|franska|french|französisch|spansk|spanska|spanish|spanisch|italiensk|italienska|italian|italienisch|portugisisk|portuguese|hollandsk|nederlandsk|dutch|polsk|polska|polish|polnisch|finsk|finska|finnish|finnisch"
    r"|islandsk|isländska|icelandic|færøsk|grønlandsk|tyrkisk|turkiska|turkish|türkisch|latin|ungarsk|hungarian|tjekkisk|czech|rumænsk|romanian))\b",
    re.I,
)
_OTHER_LETTER = re.compile(r"[^\W\d_A-Za-zªºÀ-ɏḀ-ỿ]")
_EAST = frozenset(("hiragana", "katakana", "halfwidth", "bopomofo", "ideographic"))


@lru_cache(4096)
def _script_of(c: str) -> str:
    name = unicodedata.name(c, "unknown").split()[0].lower()
    return "cjk" if name in _EAST else name


def main_script(text: str) -> str:
    """Script of most letters: ``latin``, or the first word of the Unicode names of the letters (Chinese and Japanese are ``cjk``)."""
    other = _OTHER_LETTER.findall(text)
    if not other:
        return "latin"
    by = Counter(map(_script_of, other))
    by["latin"] += sum(map(str.isalpha, text)) - len(other)
    return by.most_common(1)[0][0]


def sentence_language(x: str, want: str) -> str | None:
    """Language of one sentence: one of LANGS, a further one or another script by name, ``other`` if it has no function
    word of ``want`` though it is long enough to need one, None if it tells nothing (names, entries)."""
    if _OTHER_LETTER.search(x) and (script := main_script(x)) != "latin":
        return script
    words = WORD.findall(x)
    low = [w.lower() for w in words]
    wanted = sum(_MASK.get(w, 0) >> LANGS.index(want) & 1 for w in low) if want in LANGS else 0
    if not _ANY_FOREIGN.isdisjoint(low):
        hits, lang = max((sum(w in f for w in low), l) for l, f in _FOREIGN.items() if sum(w in _ONLY_FOREIGN[l] for w in low) >= 2 or l == want) if any(
            sum(w in o for w in low) >= 2 for o in _ONLY_FOREIGN.values()
        ) else (0, "")
        if hits > max(language_scores(low)[0] if want not in LANGS else wanted, *([sum(_MASK.get(w, 0) >> i & 1 for w in low) for i in range(4)])):
            return lang
    k = top_language(language_profile(x), 1.0)
    if k:
        content = [w for w in words if w.lower() not in _MASK]
        if k != want and content and len(words) - len(content) < 3 and all(w[0].isupper() for w in content):
            return None  # a name or title
        return k
    if not wanted and len(words) >= 6 and CLOSED.search(x) and x.count(",") * 3 < len(words) and sum(w[0].islower() for w in words) * 2 > len(words):
        return "other"
    return None


def wrong_language(instruction: str, answer: str) -> bool:
    """Most of the answer (by characters of its sentences) is in another language or script than wanted."""
    asked = LABEL.sub("", instruction)
    m = ASKED.search(instruction)
    if m:
        want = _ASKED_LANG[[bool(g) for g in m.groups()].index(True)]
    elif m := ASKED_OTHER.search(instruction):
        want = m.lastgroup
    else:
        want = main_script(asked)
        if want == "latin":
            want = top_language(language_profile(asked, True), 0.5)
    if not want:
        return False
    low = WORD.findall(answer.lower())
    if want in LANGS and not _OTHER_LETTER.search(answer):
        k = LANGS.index(want)
        whole = language_scores(low, exclusive=True)[1]
        of_want = sum(_MASK.get(w, 0) >> k & 1 for w in low)
        if whole[k] >= 3 and sum(whole) - whole[k] + sum(w in _ANY_FOREIGN for w in low) < 0.25 * whole[k] and of_want * 4 >= len(low):
            return False  # too few words proper to any other language for it to hold half of the text
    by: Counter = Counter()
    for x in sentences(answer):
        k = sentence_language(x, want)
        if k:
            by[k] += len(x)
    known = by.total()
    if want == "latin":  # asked for a language without a profile: only LANGS and other scripts are surely wrong
        right = known - sum(by[l] for l in LANGS) - sum(n for l, n in by.items() if l not in LANGS and l not in _FOREIGN and l != "other")
    elif want == "no":
        right = by["no"] + by["da"]
    else:
        right = by[want]
    return known - right > 0.5 * known


LABEL = re.compile(r"^\s*(?:format\s+[a-c]\s*[-:—–]\s*|(?:[^\W\d_][\w.]{0,14}\s?){1,3}:\s*)", re.I)
_TOKEN = re.compile(r"\w+")


_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _BASE, np.uint64)]), dtype=np.uint64)


def _windows(x: np.ndarray, s: int, p: np.ndarray) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``s`` tokens, modulo 2^64."""
    h = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * p[: len(x)], dtype=np.uint64)])
    return (h[s:] - h[:-s]) * p[len(p) - 1 - np.arange(len(x) - s + 1)]


def string_tiles(a: list[str], b: list[str], least: int = 3) -> list[bool]:
    """Greedy string tiling: which tokens of ``b`` are in a tile. The longest common run of free tokens is a tile and is marked
    on both sides, then the next longest, down to ``least`` tokens (or all of ``a``, if that is less). As a copy may repeat
    its source, ``a`` stands there as often as it goes into ``b``, and anew while there is something to tile. The longest length
    is found by bisection over window hashes, whose hits are compared token by token."""
    free = np.ones(len(b), bool)
    least = min(least, len(a))
    if not a or not b:
        return [False] * len(b)
    number: dict[str, int] = {}
    one = [number.setdefault(w, len(number) + 1) for w in a]
    y = np.array([number.get(w, 0) for w in b], np.uint64)
    y[y == 0] = np.arange(1, 1 + int((y == 0).sum()), dtype=np.uint64) + np.uint64(1 << 40)  # tokens that a lacks meet nothing
    copies = -(-len(b) // len(a))
    source = np.tile(np.array([*one, 0], np.uint64), copies)
    ends = source == 0
    source[ends] = np.arange(copies, dtype=np.uint64) + np.uint64(1 << 41)
    p = _powers(len(source) + len(b) + 1)
    gone = 1 << 42
    while True:
        x, before = source.copy(), int(free.sum())
        top = len(a)
        while top >= least:
            low, high = least - 1, min(top, len(b))  # a common run of ``low`` free tokens is known to exist
            while low < high:
                mid = (low + high + 1) // 2
                low, high = (mid, high) if np.isin(_windows(y, mid, p), _windows(x, mid, p)).any() else (low, mid - 1)
            if low < least:
                break
            at: dict[int, list[int]] = {}
            hx, hy = _windows(x, low, p), _windows(y, low, p)
            for i in np.flatnonzero(np.isin(hx, hy))[::-1].tolist():
                at.setdefault(int(hx[i]), []).append(i)
            used_x, used_y = np.zeros(len(x), bool), 0
            tiled = False
            for j in np.flatnonzero(np.isin(hy, hx)).tolist():
                stack = at.get(int(hy[j]))
                while j >= used_y and stack:
                    i = stack.pop()
                    if not used_x[i] and not used_x[i + low - 1] and (x[i:i + low] == y[j:j + low]).all():
                        used_x[i:i + low] = True
                        free[j:j + low] = False
                        used_y, tiled = j + low, True
            if tiled:
                x[used_x] = np.arange(int(used_x.sum()), dtype=np.uint64) + np.uint64(gone)
                y[~free] = np.arange(len(b), dtype=np.uint64)[~free] + np.uint64(1 << 43)
                gone += len(x)
                top = low
            else:
                top = low - 1  # hashes that met by chance
        if int(free.sum()) == before:
            return [not f for f in free.tolist()]


def tiled_share(a: list[str], b: list[str], least: int = 3) -> float:
    """Share of the tokens of ``b`` in tiles of ``a``."""
    return sum(string_tiles(a, b, least)) / len(b)


#: Tokens in a row outside the tiles that make a statement of the answer's own.
OWN_WORDS = 4


_ANNOUNCED = re.compile(r"[^.!?\n:]+:\s")


def is_copy(instruction: str, answer: str, share: float = 0.85) -> bool:
    """The answer is covered by tiles of the instruction, and has no run of OWN_WORDS tokens or more outside them. What
    stands before a copy and only announces it (a label, a sentence up to its colon) is left out."""
    a = _TOKEN.findall(instruction.lower())
    known = set(a)
    starts = {0, *(m.end() for m in (LABEL.match(answer), _ANNOUNCED.match(answer)) if m)}
    for at in sorted(starts):
        b = _TOKEN.findall(answer[at:].lower())
        if not b or len(b) < min(3, len(a)) or sum(map(known.__contains__, b)) < share * len(b):
            continue  # tiles hold no token that the instruction lacks
        tiles = string_tiles(a, b)
        run = longest = 0
        for t in tiles:
            run = 0 if t else run + 1
            longest = max(longest, run)
        if sum(tiles) >= share * len(tiles) and longest < OWN_WORDS:
            return True
    return False


_OPEN = {"(": ")", "[": "]", "{": "}", "»": "«", "«": "»", "“": "”", "„": "“", '"': '"'}
_CLOSE = frozenset(_OPEN.values())
#: A quotation may be closed by another sign than its own: »a», “a“.
_ALSO = {"»": "«", "“": "”"}
_QUOTES = frozenset("«»“”\"")
#: Elements that are empty or whose end tag may be left out.
_NO_END = frozenset("area base br col embed hr img input link meta source track wbr p li dt dd td th tr thead tbody tfoot colgroup option body html head".split())
_ELEMENTS = frozenset(_TAGS) - _NO_END
_SCAN = re.compile(
    r"^[ \t]*(?P<fence>`{3,}|~{3,})[^\n]*|`[^`\n]+`|(?P<comment><!--(?:.*?-->)?)|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9]*)(?:\s[^<>]*?)?(?P<empty>/?)>|\\(?P<env>begin|end)\{(?P<of>\w+)\*?\}"
    r"|[\[\](]\s*[-−]?(?:[\d.]+|∞|\w)\s*[;,]\s*[-−]?(?:[\d.]+|∞|\w)\s*[\[\])]|[:;=]-?[(\[](?=\s|$)|(?<!\S)\"(?=\w)|(?<=\()\"(?=\w)|(?P<straight>\")|[()\[\]{}»«“”„]|(?P<blank>\n[ \t]*\n)",
    re.M | re.S,
)
_ENTRY = re.compile(r"[ \t]*(?:(?P<sign>[-–*•·+])|\(?(?P<no>\d{1,3}|[a-z])(?P<by>[.)])|\\item\b)(?P<rest>[^\n]*)$", re.I)
_BARE_ENTRY = re.compile(r"(?:^|\s)\(?(\d{1,3}|[a-z])\)$")


def _before(no: str) -> str:
    return str(int(no) - 1) if no.isdigit() else chr(ord(no) - 1)


def list_left_open(text: str) -> bool:
    """The last entry of a list has its mark but no text, or only announces what it is to hold."""
    lines = [l for l in text.rstrip().split("\n") if l.strip()]
    last = _ENTRY.match(lines[-1]) if lines else None
    entries = [m for l in lines if (m := _ENTRY.match(l)) and (m["sign"] is None or m["rest"][:1] in ("", " ", "\t"))] if last else []
    if len(entries) >= 2:
        kin = [m for m in entries[:-1] if (m["sign"], m["by"]) == (last["sign"], last["by"])]
        if kin and (not last["no"] or any(m["no"] and m["no"].lower() == _before(last["no"].lower()) for m in kin)):
            if not last["rest"].strip() or last["rest"].rstrip().endswith(":"):
                return True
    m = _BARE_ENTRY.search(lines[-1]) if lines else None  # entries inside a sentence: a) one, b)
    return bool(m) and bool(re.search(rf"(?:^|\s)\(?{_before(m[1])}\)\s+\w", lines[-1][:m.start()]))


def left_open(text: str) -> list[str]:
    """Pushdown parser: what stands open at the end of the text (brackets, quotations, code fences, comments, tags,
    environments, lists)."""
    stack: list[str] = []
    fence = ""
    for m in _SCAN.finditer(text):
        g = m.group()
        if m["fence"]:
            if not fence:
                fence = m["fence"]
            elif m["fence"].startswith(fence) and g.strip() == m["fence"]:
                fence = ""
        elif fence:
            continue
        elif m["comment"]:
            if g == "<!--":
                stack.append("-->")
                break
        elif m["name"]:
            name = m["name"].lower()
            if m["empty"] or name not in _ELEMENTS:
                continue
            if not m["end"]:
                stack.append(f"<{name}>")
            elif f"<{name}>" in stack:
                del stack[len(stack) - 1 - stack[::-1].index(f"<{name}>"):]
        elif m["env"]:
            if m["env"] == "begin":
                stack.append(f"\\{m['of']}")
            elif f"\\{m['of']}" in stack:
                del stack[len(stack) - 1 - stack[::-1].index(f"\\{m['of']}"):]
        elif m["blank"]:
            stack = [x for x in stack if x not in _CLOSE]  # a quotation or bracket does not pass a blank line
        elif len(g) > 1:
            continue  # code, an interval, a smiley
        elif stack and (g == stack[-1] or _ALSO.get(g) == stack[-1]):
            stack.pop()
        elif g in _CLOSE and g in stack and not m["straight"]:
            del stack[len(stack) - 1 - stack[::-1].index(g):]
        elif g in _OPEN and not m["straight"]:
            stack.append(_OPEN[g])
    return stack + ([fence] if fence else []) + (["list"] if not fence and list_left_open(text) else [])


TRUNCATED_FROM = 2.5


def is_truncated(answer: str, original: str | None) -> bool:
    """Evidence of the ending, or an open construct: a full stop inside a fence, comment, element, environment, bracket or
    list ends nothing. An open quotation counts unless a full stop or an omission ends the text (the author may leave it)."""
    e = ending_evidence(answer, original)
    if e >= TRUNCATED_FROM:
        return True
    opened = left_open(answer)
    return any(x not in _QUOTES for x in opened) or bool(opened) and e > -6.0


def defects(pair_id: int, instruction: str | None, answer: str | None, original: str | None) -> list[tuple]:
    """(pair_id, defect) of one pair."""
    q, t = instruction or "", answer or ""
    bare = t.strip(_SIGNS)
    if not bare or len(bare) <= 20 and bare.lower() in STAND_INS:
        return [(pair_id, "empty")]
    if is_refusal(t) or is_refusal(LABEL.sub("", q) or q):
        return [(pair_id, "refusal")]
    if q.strip() and is_copy(q, t):
        return [(pair_id, "copy")]
    out = []
    if is_truncated(t, original):
        out.append((pair_id, "truncated"))
    if wrong_language(q, t):
        out.append((pair_id, "language"))
    return out


def defective_pairs(pairs: DataFrame, key: str = "pair_id", instruction: str = "instruction", answer: str = "paragraph", original: str | None = "original_paragraph") -> DataFrame:
    """The operator: distinct (key, defect), one row for each defect of a pair. A narrow map; only the defects are shuffled."""
    cols = pairs.where(F.col(key).isNotNull()).select(
        F.col(key).alias("k"), F.col(instruction).alias("q"), F.col(answer).alias("t"), (F.col(original) if original else F.lit(None).cast("string")).alias("o")
    )
    kind = pairs.schema[key].dataType.simpleString()
    return flat_map_rows(cols, ["k", "q", "t", "o"], defects, f"`{key}` {kind}, defect string").distinct()
