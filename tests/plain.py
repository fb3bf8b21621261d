"""Straightforward row-by-row versions of the operators, which the column expressions are compared with."""

import re

from corpusforge.functions import fixed


def sections(text):
    out, head, body = [], "", []
    for line in text.split("\n") + ["## end"]:
        s = line.strip()
        if re.match(r"#{2,3} ", s):
            whole = "\n".join(body).strip()
            if whole:
                out.append((head, whole))
            head, body = s.lstrip("#").strip(), []
        else:
            body.append(line)
    return out


def chunks(text, limit=3000):
    cuts = [re.split(r"\n\s*\n", text), text.split("\n"), re.split(r"(?<=[.!?])\s+", text.strip())]
    level = [[b.strip() for b in c if b.strip()] for c in cuts[:2]] + [[b for b in cuts[2] if b.strip()]]
    blocks = level[0]
    for k in (1, 2):
        if len(blocks) <= 1 and len(text) > limit:
            blocks = level[k]
    joiner = " " if len(blocks) > 1 and "\n" not in blocks[0] else "\n"
    out, cur = [], None
    for b in blocks:
        if cur is not None and len(b) <= limit and len(cur) + len(joiner) + len(b) <= limit:
            cur += joiner + b
            continue
        if cur is not None:
            out.append(cur)
        cur = b
        if len(b) > limit:
            out.append(b)
            cur = None
    return out + ([cur] if cur is not None else [])


def cleaned(text):
    keep = []
    for line in text.split("\n"):
        s = line.strip()
        if s.startswith("# "):
            continue
        s = re.sub(r"TALER\s+\d+:\s*", "", s)
        if re.match(r"Publiceret:\s*\d{4}-\d{2}-\d{2}|Kategorier:|Kilde:", s):
            continue
        keep.append(s)
    return "\n".join(keep).strip()


def kilde(text):
    hits = [s.strip() for s in text.split("\n") if s.strip().startswith("Kilde:")]
    return hits[-1][len("Kilde:"):].strip() if hits else ""


def rules(t):
    w, l = t.split(), [x.strip() for x in t.split("\n") if x.strip()]
    low = lambda signs: [x.strip(signs).lower() for x in w]
    share = lambda n, d, limit: d > 0 and n / d > limit
    short, long = low(fixed.WORD_SIGNS), low(fixed.WORD_SIGNS_LONG)
    quoted = sum(len(m.group()) for a, b in fixed.QUOTE_PAIRS for m in re.finditer(f"{a}[^{b}]{{2,}}{b}", t))
    return {
        "length": not 100 <= len(t) <= 3000,
        "list": not l or share(sum(x.startswith(fixed.LIST_STARTS) for x in l), len(l), 0.5),
        "links": not t or share(sum(len(m) for m in re.findall(r"\[.*?\]\(.*?\)", t)), len(t), 0.4),
        "stub": "stub" in t.lower() and any(p in t.lower() for p in ("denne artikel", "denne side")),
        "years": len(w) >= 20 and share(sum(bool(re.match(r"\(?[12]\d{3}[).,;:-]*$", x)) and 1000 <= int(re.search(r"\d{4}", x)[0]) <= 2099 for x in w), len(w), 1 / 30),
        "sentences": sum(bool(s.strip()) for s in re.split(r"[.!?](?:\s|$)", t.strip())) < 3,
        "foreign_script": any(a <= ord(c) <= b for c in t for a, b in fixed.FOREIGN_SCRIPTS),
        "doubled": sum(bool(re.search(r"(\w{2,4})\1", x)) and x not in fixed.DOUBLED_ALLOWED for x in short) >= 2,
        "stray": len(w) > 10 and share(sum(0 < len(x) <= 3 and not set(x) & set(fixed.VOWELS) for x in long), len(w), 0.05),
        "quotes": not l or share(sum(x.startswith(fixed.SPEECH_STARTS) for x in l), len(l), 0.4) or share(quoted, len(t), 0.4),
        "boilerplate": len(l) >= 3 and share(sum(len(x.split()) < 8 and not x.endswith((".", "!", "?", ":")) for x in l), len(l), 0.6),
        "old_spelling": len(w) >= 20 and (share(sum("aa" in x and x not in fixed.AA_PLACES for x in long), len(w), 0.02) or share(sum(x in fixed.OLD_WORDS for x in long), len(w), 0.01)),
    }
