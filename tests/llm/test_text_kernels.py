"""The row kernels of problems 1, 2, 3, 5 and 9 on written cases, and their solvers against brute force."""

import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusforge.llm import endings, markup, packing, pairs, quality, readability, tokens, truncation

PROSE = "Byen har en havn, og der er mange skibe om sommeren. Folk kommer fra hele landet for at se dem. Det er en gammel tradition, som de fleste kender godt."


# ------------------------------------------------------------------ problem 2

def cut_value(side, source, sink, edges):
    return sum(t if s else a for s, a, t in zip(side, source, sink)) + sum(c for a, b, c in edges if side[a] != side[b])


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_min_cut_is_the_least_cut(data):
    n = data.draw(st.integers(1, 7))
    cap = st.integers(0, 9).map(float)
    source, sink = ([data.draw(cap) for _ in range(n)] for _ in range(2))
    edges = [(a, b, data.draw(cap)) for a, b in itertools.combinations(range(n), 2) if data.draw(st.booleans())]
    side = markup.min_cut(source, sink, edges)
    best = min(cut_value(s, source, sink, edges) for s in itertools.product([True, False], repeat=n))
    assert abs(cut_value(side, source, sink, edges) - best) < 1e-6


@pytest.mark.parametrize(
    ("text", "languages"),
    [
        ("En <b>fed</b> by.", ["html"]), ("Et &aring;r &#229; &amp; mere", ["html"]), ("<!-- note -->Tekst", ["html"]), ("## Natur\nTekst her.", ["markdown"]), ("Se [siden](http://x.dk) nu.", ["markdown"]),
        ("```\nx = 1\n```", ["markdown"]), ("- [ ] mælk\n- [x] brød", ["markdown"]), ("| a | b |\n|---|---|\n| 1 | 2 |", ["markdown"]), ("Den er **stor**.", ["markdown"]), ("== Historie ==\nTekst", ["wiki"]),
        ("Den [[by|store by]] i {{skabelon|x}}", ["wiki"]), ("'''fed''' skrift", ["wiki"]), ("{| class=w\n|-\n| a || b\n|}", ["wiki"]), (r"Se \textbf{her} og \cite{x}.", ["latex"]), (r"Tal $x^2$ her", ["latex"]),
        ("\\begin{itemize}\n\\item a\n\\end{itemize}", ["latex"]), ("<i>a</i> og [[b]]", ["html", "wiki"]),
        (PROSE, []), ("2 * 3 * 4 er 24", []), ("Skriv til <navn@sted.dk>.", []), (r"Mappen C:\navn\ting er tom", []), ("Mængden {1, 2, 3} og 3 < 5", []), ("Resultatet [1] og [2, 3]", []), ("* et\n* to\n- tre\n1. fire", []),
        ("a\tb\nc\td", []), ("Pris $ 5 og 7 $ her", []), ("fil_med_navn_her og C#", []), ('{"a_b": true, "c_d": "*x*"}', []), ("Firmaet A & B", []), ("#emne", []),
    ],
)
def test_markup_found(text, languages):
    assert markup.found(text) == languages


def test_doubtful_sign_follows_its_surroundings():
    lone = markup.constructs("| a | b |\nTekst her.")
    assert markup.label("| a | b |\nTekst her.", lone) == [False]
    rows = "| a | b |\n| c | d |\n| e | f |"
    assert all(markup.label(rows, markup.constructs(rows)))


def test_the_cut_decides_where_single_costs_do_not(monkeypatch):
    rows, log = "| a | b |\n| c | d |\n| e | f |", '{"a": 1, "b": "se **her** og *der*"}'
    alone = lambda t: sorted({n.lang for n in markup.constructs(t) if n.weight >= markup.PRIOR})
    cases = {rows: ["markdown"], log: [], "Se <ny>kortet</ny> <b>her</b>.": ["html"], "Pris | antal\n" + log: [], "<ul><li>$a$</li><li>$b$</li><li>\\(x\\)</li></ul>": ["html", "latex"]}
    for t, want in cases.items():
        assert markup.found(t) == want, t
    assert sum(alone(t) != want for t, want in cases.items()) >= 3
    doubtful = "<ul><li>\\*et</li><li>\\*to</li><li>\\*tre</li></ul>"
    monkeypatch.setattr(markup, "PARENT", 0.0)
    monkeypatch.setattr(markup, "CHILD", 0.0)
    without = markup.found(doubtful)
    monkeypatch.undo()
    assert markup.found(doubtful) == ["html", "markdown"] and without == ["html"]


def test_costs_are_fitted_by_what_stands_in_noise():
    fit = markup.costs_of({("markdown", "em"): (20, 4000), ("html", "tag"): (5000, 0), ("markdown", "strong"): (0, 2)})
    first = {(l, k): w for l, k, w, _ in markup._CONSTRUCTS}
    assert fit["markdown", "em"] < markup.PRIOR < first["markdown", "em"] and fit["html", "tag"] == pytest.approx(first["html", "tag"], abs=0.01) and fit["markdown", "strong"] > 7.5 and fit["latex", "math"] == first["latex", "math"]
    assert markup.found("Den er *stor* nu.", fit) == [] and markup.found("Den er *stor* nu, se **her** og ## der.\n## Om\n*ja*", fit) == ["markdown"]


def test_the_flow_is_near_linear():
    import time

    took = []
    for n in (500, 4000):
        text = "\n".join(f"\\*ord{i} og | a | b |\n| c{i} | d |\n<x{i}> tekst \\* her" for i in range(n))
        nodes = markup.constructs(text)
        began = time.process_time()
        markup.label(text, nodes)
        took.append(time.process_time() - began)
    assert took[1] < 30 * took[0] + 0.3 and took[1] < 4


@pytest.mark.parametrize(
    ("text", "clean", "heads"),
    [
        ("<ol><li>et</li><li>to</li></ol>", "1. et\n2. to", []), ("<ul><li>a</span><li>b</ul><ol><li>c<li>d</ol>", "- a\n- b\n\n1. c\n2. d", []), ("\\begin{enumerate}\n\\item a\n\\item b\n\\end{enumerate}", "1. a\n2. b", []),
        ("| a | b |\n|---|---|\n| 1 | 2 |", "a\tb\n1\t2", []), ("{| class=w\n|-\n| a || b\n|-\n| c || d\n|}", "a\tb\nc\td", []), ("<h1>By</h1><p>En by.</p><h3>Havn</h3>", "By\n\nEn by.\n\nHavn", [(1, "By"), (3, "Havn")]),
        ("# By\n\n### Havn\nEn havn.", "By\n\nHavn\n\nEn havn.", [(1, "By"), (3, "Havn")]), ("=== Havn ===\nEn havn.", "Havn\n\nEn havn.", [(3, "Havn")]), ("\\subsection{Havn} En havn.", "Havn\n En havn.", [(2, "Havn")]), ("By\n====\nEn by.", "By\n\nEn by.", [(1, "By")]),
    ],
)
def test_lists_tables_and_headings_keep_their_structure(text, clean, heads):
    assert markup.cleaned_text(text) == (clean, heads)


@pytest.mark.parametrize(
    ("text", "clean"),
    [
        ("<h2>By</h2>\n<p>En <b>stor</b> by &amp; å.</p>", "By\n\nEn stor by & å."), ("<ul><li>a</li><li>b</li></ul>", "- a\n- b"), ("<pre><code>x = 1\n  y</code></pre>", "    x = 1\n      y"),
        ("m<sup>2</sup> &lt;em&gt;ja&lt;/em&gt;", "m^2 ja"), ("## Natur\n\n**stor** [by](u)", "Natur\n\nstor by"), ("[[a|b]] og ''c''", "b og c"), ("$\\frac{a}{b}$ og \\(x^{2}\\)", "(a)/(b) og x^2"),
        ("\\section{Om}\nTekst", "Om\n\nTekst"), (PROSE, PROSE), ("", ""),
    ],
)
def test_clean_text(text, clean):
    got = markup.clean_text(text)
    assert got == clean
    assert markup.found(got) == []


JSON = '{"a_b": 1, "c": "*x*", "d": 2}'


@pytest.mark.parametrize(
    ("text", "languages", "clean"),
    [
        (f"## Kald\n\nSend **dette**:\n\n```\n{JSON}\n```", ["markdown"], f"Kald\n\nSend dette:\n\n    {JSON}"), (f"<p>Send <b>dette</b>:</p>\n<pre>\n{JSON}\n</pre>", ["html"], f"Send dette:\n\n    {JSON}"),
        (f"\\section{{Kald}}\n\\begin{{lstlisting}}\n{JSON}\n\\end{{lstlisting}}", ["latex"], f"Kald\n\n    {JSON}"), (f"Send **dette** til os:\n{JSON}\nog vent.", ["markdown"], f"Send dette til os:\n{JSON}\nog vent."), (JSON, [], JSON),
        ("Se <https://www.eksempel.dk/en/meget/lang/sti/til/en/side/med/tekst>", ["markdown"], "Se https://www.eksempel.dk/en/meget/lang/sti/til/en/side/med/tekst"), ("Se **her** " + "Q" * 90, [], "Se **her** " + "Q" * 90),
        ("En <b>fed</b> by, der er stor og rig.\n\n" + "Q" * 300, ["html"], "En fed by, der er stor og rig.\n\n" + "Q" * 300),
    ],
)
def test_noise_vetoes_only_its_own_place(text, languages, clean):
    assert markup.found(text) == languages
    assert markup.clean_text(text) == clean


LONG = "byen er stor og rig " * 15 + "nu"


@pytest.mark.parametrize(
    ("text", "languages", "clean"),
    [
        (f"Se *{LONG}* her.", ["markdown"], f"Se {LONG} her."), (f"Se _{LONG}_ her.", ["markdown"], f"Se {LONG} her."), ("Se *den store\nby* her.", ["markdown"], "Se den store\nby her."), ("Se *den\n\nby* her.", [], "Se *den\n\nby* her."),
        ("$x^2 + " + "y + " * 80 + "z$", ["latex"], "x^2 + " + "y + " * 80 + "z"), ("Se:\n\n~~~\nx = 1\n~~~\n\nNu.", ["markdown"], "Se:\n\n    x = 1\n\nNu."), ("! a !! b\n! c !! d", ["wiki"], "a\tb\nc\td"),
        ("> > > > > > > > Byen er stor.", ["markdown"], " Byen er stor."), ("&" + "amp;" * 9 + "lt;b>fed", ["html"], "fed"),
    ],
)
def test_no_length_or_depth_is_cut(text, languages, clean):
    assert markup.found(text) == languages
    assert markup.clean_text(text) == clean
    assert markup.found(clean) == [] if languages else True


@pytest.mark.parametrize(
    "unit", ["<p>En <b>stor</b> by &amp; å.</p>\n\n<ul><li>a</li></ul>\n", "## By\n\nEn **stor** [by](u) og *ja*.\n\n", '{"a_b": 1, "c": "*x*", "d": 2}\n\n' + PROSE + " **ja**\n\n", "> ", "```\n", "2024-01-02 10:00:00 INFO x_y=1 *z*\n"]
)
def test_very_long_texts_take_time_in_proportion(unit):
    import time

    took = []
    for n in (300, 3000):
        began = time.process_time()
        markup.found(unit * n)
        markup.clean_text(unit * n)
        took.append(time.process_time() - began)
    assert took[1] < 25 * took[0] + 0.5


def test_entities_escaped_any_number_of_times():
    assert markup.clean_text("a &" + "amp;" * 5000 + "lt; b") == "a < b" and markup.clean_text("A &amp; B &amp;amp; &nbsp;C") == "A & B &  C"


def test_signs_let_every_construct_pass():
    import re

    signs = re.compile(markup.SIGNS.replace("(?m:", "(?:"), re.M)
    assert all(signs.search(t) for t in ("a\n- - -\nb", "! a !! b", ":# et", "~~~\nx\n~~~")) and not signs.search("- et\n- to")


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="<>/abp &;#*_`[]{}|\\$='~\n-x1 ", max_size=120))
def test_markup_never_fails(text):
    markup.found(text)
    markup.clean_text(text)


# ------------------------------------------------------------------ problem 1

@pytest.mark.parametrize(
    ("text", "share"),
    [(PROSE, 1.0), ("a) den gamle bro ved havnen.\n- en ny vej langs med åen.\n3) skolen i den store by.", 0.0), ("1) Det er en by, og den er stor.\n2) Der er en havn i den gamle by.", 1.0), ("En by</div> som er stor, ligger<br/> ved vandet i det gamle land.", 1.0), ("- smør\n- brød\n- ost og skinke", 0.0), ("a;b;c\n1;2;3", 0.0), ("Hvem kom? Det gjorde hun, og så gik vi hjem igen.", 1.0), ("", 0.0)],
)
def test_sentence_share(text, share):
    s = dict(zip([c.split()[0] for c in quality.SCHEMA.split(", ")], quality.text_stats(text)))
    assert abs(s["sentence_share"] - share) < 0.05


def test_stats_of_hostile_texts():
    width = len(quality.SCHEMA.split(", "))
    for t in (None, "", " \n\t", "\x00", "a" * 200_000, "🙂" * 500, "\u200b", "|" * 3000, "<" * 3000, "{" * 3000):
        assert len(quality.text_stats(t)) == width


# ------------------------------------------------------------------ problems 3 and 5

@pytest.mark.parametrize(
    ("q", "a", "want"),
    [
        ("Hvad er en by?", None, ["empty"]), ("Hvad er en by?", " \u200b\u00a0", ["empty"]), ("Hvad?", "N/A", ["empty"]), ("Hvad?", "[ ]", ["empty"]), ("Hvad?", "Ingen tekst.", ["empty"]), ("Hvad?", "84 meter.", []),
        ("Fortæl om byen.", "Beklager, men det kan jeg ikke svare på.", ["refusal"]), ("Fortæl om byen.", "I'm sorry, but I can’t help with that.", ["refusal"]), ("Jeg kan ikke hjælpe med det.", PROSE, ["refusal"]),
        ("Som sprogmodel må jeg sige, at det ligger uden for, hvad jeg må svare på.", PROSE, ["refusal"]), ("Undskyld spørgsmålet, men hvad er en by?", PROSE, []), ("Jeg kan ikke finde svaret i bogen: hvad er en by?", PROSE, []),
        ("Fortæl om byen.", "Jeg beklager forsinkelsen. " + PROSE, []), ("Fortæl om den store by.", "»Fortæl om den store by!«", ["copy"]), ("Fortæl om den store by.", "Spørgsmål: FORTÆL OM DEN STORE BY. Fortæl om den store by", ["copy"]),
        ("Fortæl om den store by.", "Fortæl om den store by. " + PROSE, []), ("Vokser den store by?", "Ja, den store by vokser.", []), ("Fortæl om byen.", PROSE[:-9], ["truncated"]), ("Fortæl om byen.", PROSE + " Det er derfor, at de …", ["truncated"]),
        ("Fortæl om byen.", "The town has a harbour and there are many ships in the summer when people come to see them.", ["language"]), ("What is special about the town?", PROSE, ["language"]),
        ("Fortæl om byen – svar på engelsk.", "The town has a harbour and there are many ships in the summer when people come to see them.", []), ("Fortæl om byen på dansk.", PROSE + " Han sagde: “It is so.”", []),
        ("Hvad er byen?", "The town has a harbour and there are many ships in the summer when people come", ["truncated", "language"]), (None, PROSE, []), ("", "", ["empty"]),
    ],
)
def test_pair_defects(q, a, want):
    assert [d for _, d in pairs.defects(1, q, a, None)] == want


@pytest.mark.parametrize(
    ("text", "original", "cut"),
    [
        ("Det er slut.", None, False), ("Det er slut.«", None, False), ("Den er stor m.v.", None, False), ("Prisen er ca.", None, True), ("Det er sl", None, True), ("Han sagde, at den", None, True), ("Det er her og de … Læs mere", None, True),
        ("Det er her (…)", None, True), ("Det er her ved…", None, True), ("Det er en gammel fabri-", None, True), ("Og så tog de hele byen …", None, False), ("Det er slut.\n- smør\n- brød", None, False),
        ("Det er slut.\nMed venlig hilsen Ole Olsen, Kommunen", None, False), ("Det er slut.\nPubliceret: 2019-10-14", None, False), ("Det er slut. Den store by", "Det er slut. Den store by vokser.", True),
        ("Det er en overskrift uden punktum for os alle", "Det er en overskrift uden punktum for os alle\nSå er der mere.", False), ("", None, False), (None, None, False), ("\u200b", None, False),
    ],
)
def test_endings(text, original, cut):
    assert (endings.ending_evidence(text, original) + (-2.94) > 0) == cut


def test_parser_of_open_constructs():
    assert pairs.left_open("Han sagde (at »det") == [")", "«"]
    assert pairs.left_open("```\nx = (1\n") == ["```"] and pairs.left_open("(a) »b« <b>c</b> \\begin{x}d\\end{x}") == []


@pytest.mark.parametrize(
    ("q", "a", "wrong"),
    [
        ("Fortæl om byen.", "Город стоит у моря, и летом там много кораблей.", True), ("Fortæl om byen.", "Η πόλη έχει λιμάνι και πολλά πλοία.", True), ("Fortæl om byen.", "这座城市有一个港口。", True), ("Fortæl om byen.", "المدينة لها ميناء كبير.", True),
        ("Fortæl om byen.", "La ville est située au bord de la mer et compte beaucoup de bateaux.", True), ("Fortæl om byen.", "Miasto jest duże i leży nad morzem, a latem są tam statki.", True), ("Fortæl om byen.", "A város kikötője nagyon régi és nyáron tele van hajókkal.", True),
        ("Fortæl om byen.", "The town is old.", True), ("Hvad hedder bogen?", "Lord of the Rings.", False), ("Fortæl om byen på fransk.", "La ville est située au bord de la mer et compte beaucoup de bateaux.", False), ("Fortæl om byen på russisk.", "Город стоит у моря.", False),
        ("Fortæl om byen på russisk.", PROSE, True), ("Расскажи о городе.", "Город стоит у моря.", False), ("Расскажи о городе.", PROSE, True), ("Fortæl om byen.", PROSE + " På græsk: Η πόλη.", False), ("Hvem kom?", "Niels Bohr, Marie Curie og Albert Einstein.", False), ("Hvad købte du?", "- smør\n- brød\n- ost", False),
    ],
)
def test_language_by_script_and_words(q, a, wrong):
    assert pairs.wrong_language(q, a) == wrong


@pytest.mark.parametrize(
    ("text", "cut"),
    [
        ("Sådan gør du:\n```\nx = 1.\n", True), ("Sådan gør du:\n```\nx = 1\n```\nDet er alt.", False), ("~~~\nx = (1.\n~~~\nDet er alt.", False), ("Byen er stor <b>og rig. Den er gammel.", True), ("<p>Byen er stor.<br>Den er gammel.", False),
        ("Byen (som er stor. " + "Den er rig. " * 40, True), ("Byen (som er stor) er rig.", False), ("Skriv til <navn@sted.dk> i dag.", False), ("Vi ser \\begin{itemize} \\item a.", True), ("\\begin{x}a (b\\end{x} er alt.", False),
        ("Han sagde: »Byen er stor:", True), ("Han sagde: »Byen er stor.", False), ("Tallet ligger i [0, 1) og i ]2; 3[.", False), ("Han var sur :( og gik hjem.", False), ("a) smør og b) brød.", False), ("Skriv `(` her.", False), ("«Byen» er »stor» og „rig“ og “ny”.", False),
        ("Køb disse:\n1. Smør.\n2. Brød.\n3.", True), ("Køb disse:\n1. Smør.\n2. Brød.", False), ("Køb:\n- smør\n- brød\n-", True), ("Køb:\n- smør\n- brød fra:", True), ("Vi har a) smør, b) brød, c)", True), ("Det skete i\n1. januar 2.", False), ("Note <!-- er skjult.", True),
    ],
)
def test_open_constructs_decide_truncation(text, cut):
    assert pairs.is_truncated(text, None) == cut


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), min_size=1, max_size=14))
def test_tiles_are_common_runs(a, b):
    share = pairs.tiled_share(a, b, 2)
    runs = {tuple(a[i:j]) for i in range(len(a)) for j in range(i + 2, len(a) + 1)}
    coverable = sum(any(tuple(b[s:e]) in runs for s in range(k + 1) for e in range(k + 1, len(b) + 1)) for k in range(len(b)))
    assert share <= coverable / len(b) + 1e-9 or len(a) == 1


def plain_tiles(a, b, least):
    """Greedy string tiling by definition, with the source standing there as often as it may be wanted."""
    x, y, used = [], list(b), [False] * len(b)
    for k in range(len(b) + 1):
        x += [*a, ("end", k)]
    free = [True] * len(x)
    while True:
        best, hits = max(min(least, len(a)) - 1, 0), []
        for i in range(len(x)):
            for j in range(len(y)):
                k = 0
                while i + k < len(x) and j + k < len(y) and free[i + k] and not used[j + k] and x[i + k] == y[j + k]:
                    k += 1
                if k > best:
                    best, hits = k, [(i, j)]
                elif k == best and k and k >= min(least, len(a)):
                    hits.append((i, j))
        hits = [h for h in hits if best >= min(least, len(a))]
        done = False
        for i, j in sorted(hits, key=lambda h: (h[1], h[0])):
            if all(free[i:i + best]) and not any(used[j:j + best]):
                free[i:i + best], used[j:j + best], done = [False] * best, [True] * best, True
        if not done:
            return used


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=7), st.lists(st.sampled_from("abcd"), min_size=1, max_size=9), st.integers(1, 3))
def test_tiling_is_greedy_string_tiling(a, b, least):
    assert sum(pairs.string_tiles(a, b, least)) == sum(plain_tiles(a, b, least))


def test_tiling_shortens_runs_and_is_fast():
    import time

    assert pairs.tiled_share("1 2 3 4 5 9 3 4 5 6 7 8".split(), "1 2 3 4 5 6 7 8".split(), 2) == 1.0
    r = random.Random(1)
    w = [str(r.randint(0, 60)) for _ in range(8000)]
    for a, b in ((["ha"] * 5, ["ha"] * 10_000), (["ha"] * 10_000, ["ha"] * 10_000), (w[:4000], w[4000:]), (["ha", "ho"] * 400, ["ho"] * 9000)):
        began = time.process_time()
        pairs.tiled_share(a, b)
        assert time.process_time() - began < 0.5


ASK = "Fortæl om den store by ved havet."


@pytest.mark.parametrize(
    ("q", "a", "want"),
    [
        (ASK, (ASK + " ") * 20, ["copy"]), (ASK, ASK * 40, ["copy"]), (ASK, (ASK + " ") * 6 + "Fortæl om den store by ved kysten.", ["copy"]), (ASK, "Du bad mig om at svare på det følgende spørgsmål: " + ASK, ["copy"]), (ASK, (ASK + " ") * 9 + "Den ligger i det nordlige Jylland.", []),
        (ASK, "Beklager, men det kan jeg ikke svare på. " + "Det er, fordi jeg ikke har oplysninger om dit emne i dag. " * 8, ["refusal"]), (ASK, "I'm sorry, but I can't help with that. " + "The question asks for information I do not have. " * 9, ["refusal"]),
        (ASK, "Jeg kan ikke hjælpe dig, sagde hun. Byen var mørk, og der var ingen på gaden. Han gik hjem til sit hus.", []), (ASK, "Jeg kan ikke give en bedre beskrivelse af byen end den, som står i bogen. " + PROSE * 3, []),
    ],
)
def test_copies_and_refusals_of_any_length(q, a, want):
    assert [d for _, d in pairs.defects(1, q, a, None)] == want


def test_parser_and_tiling_decide_rows(monkeypatch):
    cases = [("Sådan gør du:\n```\nx = 1.\n", "truncated"), ("Byen (som er stor. Den er rig.", "truncated"), ("Køb disse:\n1. Smør.\n2. Brød.\n3.", "truncated"), ("Fortæl om den store by! Fortæl om den store by", "copy")]
    kinds = lambda: [[d for _, d in pairs.defects(1, "Fortæl om den store by.", a, None)] for a, _ in cases]
    assert kinds() == [[k] for _, k in cases]
    monkeypatch.setattr(pairs, "left_open", lambda t: [])
    monkeypatch.setattr(pairs, "string_tiles", lambda a, b, least=3: [False] * len(b))
    assert all(k not in got for got, (_, k) in zip(kinds(), cases))


def test_censored_fit_recovers_the_distribution():
    import math

    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(2)
    x = np.exp(rng.normal(6.0, 0.4, 20000)).astype(int)
    cut = np.minimum(x, 500)
    near = (cut == 499).sum()
    lx = np.log(cut[cut < 500])
    rows = pd.DataFrame({"source": "s", "unit": "chars", "length": [np.nan, 500], "n": [len(lx), (cut == 500).sum()], "near": [np.nan, near], "sx": [lx.sum(), np.nan], "sxx": [(lx**2).sum(), np.nan]})
    f = truncation.fit_censored(rows).iloc[0]
    assert abs(f.mu - 6.0) < 0.02 and abs(f.sigma - 0.4) < 0.02 and f.posterior > 0.97
    assert math.isclose(f.total, 20000)


# ------------------------------------------------------------------ problem 6

@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aæøåÅ é1 ½²\n\t'sld.,!\u00a0\u2028…«»", max_size=80))
def test_token_counts_are_those_of_the_tokenizer(text):
    text = text.encode("utf-8", "ignore").decode()
    assert tokens.count_tokens(text) == len(tokens.encoder(tokens.VOCABULARY).encode_ordinary(text))


# ------------------------------------------------------------------ problem 7

@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=60))
def test_best_fit_takes_the_tightest_bin(sizes):
    sizes = sorted(sizes, reverse=True)
    where, bins = packing.best_fit(sizes, [40], "least")
    free = []
    for s, b in zip(sizes, where):
        fits = [f for f in free if f >= s]
        if fits:
            assert free[b] == min(fits)
        else:
            assert b == len(free)
            free.append(40)
        free[b] -= s
    assert len(bins) == len(free)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 90), max_size=50))
def test_joint_packing_downsizes_and_is_no_worse(sizes):
    sizes = sorted(sizes, reverse=True)
    lengths = [10, 30, 90]
    where, final, held = packing.pack(sizes, lengths)
    assert [sum(s for s, b in zip(sizes, where) if b == k) for k in range(len(final))] == held
    assert all(f == min(c for c in lengths if c >= h) for f, h in zip(final, held))
    one = packing.pack(sizes, [90])[1]
    assert sum(final) + packing.OVERHEAD * len(final) <= sum(one) + packing.OVERHEAD * len(one)


# ------------------------------------------------------------------ problem 9

@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=40), st.sampled_from([0.5, 0.9, 1.0]))
def test_coverage_is_the_smallest_vocabulary(ranks, share):
    from collections import Counter

    got = readability.coverage(dict(Counter(ranks)), len(ranks), share)
    want = next(r for r in sorted(set(ranks)) if sum(x <= r for x in ranks) >= share * len(ranks) - 1e-9)
    assert got == want


def test_sentences_know_abbreviations():
    f = dict(zip([c.split()[0] for c in readability.FEATURES.split(", ")], readability.features("Det er, jf. stk. 3 og nr. 4, en lang sætning. Her er en ny.")))
    assert f["sentences"] == 2


def test_random_texts_never_fail():
    r = random.Random(1)
    for _ in range(200):
        t = "".join(r.choice("abæ .,!?\n\t-–»«()[]{}<>|;:'\"0129…\u00a0\x1c") for _ in range(r.choice((0, 5, 50, 400))))
        readability.features(t)
        endings.ending_evidence(t, t + "x")
        pairs.defects(1, t, t[::-1], t)
        quality.text_stats(t)
