"""SQL that gives the same rows as each query, for the engine the driver compares with."""

from __future__ import annotations

from .functions import fixed, prompts
from .functions.text import WORD
from .functions.text import WS_SQL as WS
from .operators.dedup import PRIME, lsh_bands, permutations

NOT_WS = "[^" + WS[1:]


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '\A{WS}+', ''), '{WS}+\z', '')"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{WS}+'), lambda w: w <> '')"


def nonblank(parts: str) -> str:
    return f"list_filter(list_transform({parts}, lambda l: {strip('l')}), lambda l: l <> '')"


def lines(x: str) -> str:
    return nonblank(f"string_split({x}, chr(10))")


def cnt(a: str, v: str, test: str) -> str:
    return f"len(list_filter({a}, lambda {v}: {test}))"


def sentences(x: str) -> str:
    marked = rf"regexp_replace({strip(x)}, '([.!?]){WS}+', '\1' || chr(1), 'g')"
    return f"list_filter(string_split({marked}, chr(1)), lambda s: {strip('s')} <> '')"


def merged(blocks: str, n: int, joiner: str) -> str:
    """Fold of blocks given as one-element states {d: finished, c: current}."""
    flush = "CASE WHEN a.c = '' THEN a.d ELSE list_append(a.d, a.c) END"
    step = f"""CASE WHEN length(b.c) > {n} THEN {{'d': list_append({flush}, b.c), 'c': ''}}
        WHEN a.c = '' THEN {{'d': a.d, 'c': b.c}}
        WHEN length(a.c) + length({joiner}) + length(b.c) <= {n} THEN {{'d': a.d, 'c': a.c || {joiner} || b.c}}
        ELSE {{'d': {flush}, 'c': b.c}} END"""
    start = "[{'d': CAST([] AS VARCHAR[]), 'c': ''}]"
    return f"list_reduce(list_concat({start}, list_transform({blocks}, lambda x: {{'d': CAST([] AS VARCHAR[]), 'c': x}})), lambda a, b: {step})"


def unfolded(state: str) -> str:
    return f"CASE WHEN {state}.c = '' THEN {state}.d ELSE list_append({state}.d, {state}.c) END"


def unnested(key: str, a: str, source: str, name: str, pos: str) -> str:
    return f"SELECT {key}, CAST(generate_subscripts({a}, 1) - 1 AS INTEGER) AS {pos}, unnest({a}) AS {name} FROM {source}"


# ------------------------------------------------------------------ splitting and cleaning

CHUNKS = rf"""
b AS (SELECT doc_id, title, url, t, {nonblank(rf"string_split_regex(t, '\n{WS}*\n')")} AS b1, {lines('t')} AS b2 FROM src),
c AS (SELECT doc_id, title, url, CASE WHEN length(t) <= 3000 OR len(b1) > 1 THEN b1 WHEN len(b2) > 1 THEN b2 ELSE {sentences('t')} END AS bl FROM b),
j AS (SELECT *, CASE WHEN len(bl) > 1 AND NOT contains(bl[1], chr(10)) THEN ' ' ELSE chr(10) END AS jn FROM c),
f AS (SELECT doc_id, title, url, {merged('bl', 3000, 'jn')} AS s FROM j),
parts AS (SELECT doc_id, title, url, CAST(generate_subscripts({unfolded('s')}, 1) - 1 AS INTEGER) AS chunk_idx, '' AS section_heading, unnest({unfolded('s')}) AS paragraph FROM f)"""


def section_parts(key: str, source: str) -> str:
    """A mark is put before each heading line, and the text split there."""
    inner = WS.replace(r"\s", r"\t\f\r ")
    head = rf"{inner}*#{{2,3}} [^\n]*{NOT_WS}"
    marked = rf"regexp_replace(chr(10) || t, '\n({head})', chr(1) || '\1', 'g')"
    first = r"regexp_extract(p, '\A([^\n]*)', 1)"
    return rf"""
m AS (SELECT *, string_split(CASE WHEN starts_with({marked}, chr(1)) THEN {marked} ELSE substr({marked}, 2) END, chr(1)) AS ps FROM {source}),
e AS (SELECT *, list_filter(list_transform(ps, lambda p: {{'h': CASE WHEN regexp_matches(p, '\A{head}') THEN {strip(rf"regexp_replace({strip(first)}, '\A#+', '')")} ELSE '' END,
   'b': {strip(rf"CASE WHEN regexp_matches(p, '\A{head}') THEN regexp_replace(p, '\A[^\n]*\n?', '') ELSE p END")}}}), lambda s: s.b <> '') AS sec FROM m),
parts AS (SELECT * EXCLUDE (x), x.h AS section_heading, x.b AS paragraph FROM (SELECT {key}, CAST(generate_subscripts(sec, 1) - 1 AS INTEGER) AS chunk_idx, unnest(sec) AS x FROM e))"""


def cleaned(x: str) -> str:
    meta = rf"\A(?:Publiceret:{WS}*\p{{Nd}}{{4}}-\p{{Nd}}{{2}}-\p{{Nd}}{{2}}|Kategorier:|Kilde:)"
    rows = f"list_filter(list_transform(string_split({x}, chr(10)), lambda l: {strip('l')}), lambda l: NOT starts_with(l, '# '))"
    rows = rf"list_transform({rows}, lambda l: regexp_replace(l, 'TALER{WS}+\p{{Nd}}+:{WS}*', '', 'g'))"
    return strip(f"array_to_string(list_filter({rows}, lambda l: NOT regexp_matches(l, '{meta}')), chr(10))")


def kilde(x: str) -> str:
    hits = f"list_filter(list_transform(string_split({x}, chr(10)), lambda l: {strip('l')}), lambda l: starts_with(l, 'Kilde:'))"
    return f"coalesce({strip(f'substr(({hits})[-1], 7)')}, '')"


# ------------------------------------------------------------------ rules over t, w (words) and l (lines)

def one_of(x: str, values) -> str:
    return f"{x} IN ({', '.join(map(lit, values))})"


def bare(x: str, signs: str) -> str:
    return f"lower(trim({x}, {lit(signs)}))"


def chars(pattern: str) -> str:
    return f"coalesce(list_sum(list_transform(regexp_extract_all(t, {lit(pattern)}), lambda m: length(m))), 0)"


_LOW, _LONG = bare("x", fixed.WORD_SIGNS), bare("x", fixed.WORD_SIGNS_LONG)
_DOUBLE = " OR ".join(
    f"len(list_filter(range(1, greatest(length({_LOW}) - {2 * k - 2}, 1)), lambda i: substr({_LOW}, i, {k}) = substr({_LOW}, i + {k}, {k}) AND regexp_full_match(substr({_LOW}, i, {k}), '{WORD}+'))) > 0" for k in (2, 3, 4)
)
_SCRIPTS = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in fixed.FOREIGN_SCRIPTS) + "]"
RULES = {
    "heading": one_of("lower(coalesce(section_heading, ''))", fixed.SKIPPED_HEADINGS),
    "length": "length(t) NOT BETWEEN 100 AND 3000",
    "list": f"(len(l) = 0 OR {cnt('l', 'x', one_of('substr(x, 1, 2)', fixed.LIST_STARTS))} * 2 > len(l))",
    "links": f"(length(t) = 0 OR {chars(r'\[[^\n]*?\]\([^\n]*?\)')} * 10 > length(t) * 4)",
    "stub": "(contains(lower(t), 'stub') AND (contains(lower(t), 'denne artikel') OR contains(lower(t), 'denne side')))",
    "years": "(len(w) >= 20 AND " + cnt("w", "x", r"regexp_full_match(x, '\(?[0-9]{4}[).,;:-]*') AND regexp_extract(x, '([0-9]{4})', 1) BETWEEN '1000' AND '2099'") + " * 30 > len(w))",
    "sentences": f"{cnt(rf"string_split_regex({strip('t')}, '[.!?](?:{WS}|\z)')", 's', strip('s') + " <> ''")} < 3",
    "foreign_script": f"regexp_matches(t, '{_SCRIPTS}')",
    "doubled": f"{cnt('w', 'x', f'({_DOUBLE}) AND NOT ({one_of(_LOW, fixed.DOUBLED_ALLOWED)})')} >= 2",
    "stray": f"(len(w) > 10 AND {cnt('w', 'x', f'length({_LONG}) BETWEEN 1 AND 3 AND NOT regexp_matches({_LONG}, {lit("[" + fixed.VOWELS + "]")})')} * 20 > len(w))",
    "quotes": "(len(l) = 0 OR "
    + cnt("l", "x", f"{one_of('substr(x, 1, 2)', [s for s in fixed.SPEECH_STARTS if len(s) == 2])} OR {one_of('substr(x, 1, 1)', [s for s in fixed.SPEECH_STARTS if len(s) == 1])}")
    + " * 10 > len(l) * 4 OR ("
    + " + ".join(chars(f"{a}[^{b}]{{2,}}{b}") for a, b in fixed.QUOTE_PAIRS)
    + ") * 10 > length(t) * 4)",
    "boilerplate": f"(len(l) >= 3 AND {cnt('l', 'x', f"len({words('x')}) < 8 AND NOT regexp_matches(x, '[.!?:]\\z')")} * 10 > len(l) * 6)",
    "old_spelling": f"(len(w) >= 20 AND ({cnt('w', 'x', f"contains({_LONG}, 'aa') AND NOT ({one_of(_LONG, fixed.AA_PLACES)})")} * 50 > len(w) OR {cnt('w', 'x', one_of(_LONG, fixed.OLD_WORDS))} * 100 > len(w)))",
}
RULES["corrupted"] = f"({RULES['foreign_script']} OR {RULES['doubled']} OR {RULES['stray']})"
_ORDER = ("length", "list", "links", "years", "sentences", "corrupted", "quotes", "boilerplate", "old_spelling")
_WIKI = ("heading", "length", "list", "links", "stub", *_ORDER[3:])


def verdict(order: tuple[str, ...]) -> str:
    return "CASE " + " ".join(f"WHEN {RULES[r]} THEN '{r}'" for r in order) + " ELSE 'kept' END"


def parts_of(source: str, text: str) -> str:
    return f"(SELECT *, {words('t')} AS w, {lines('t')} AS l FROM (SELECT *, coalesce({text}, '') AS t FROM {source}))"


_P = parts_of("paragraphs", "paragraph")


def extracted(order: tuple[str, ...], split: str, source: str) -> str:
    return f"""WITH src AS ({source}), {split},
k AS (SELECT doc_id AS doc_seq, chunk_idx, {cleaned('paragraph')} AS cleaned, title, url, section_heading FROM parts)
SELECT doc_seq, chunk_idx, t AS paragraph, title, url, section_heading, 'knowledge' AS source_type FROM {parts_of('k', 'cleaned')} WHERE {verdict(order)} = 'kept'"""


_URL = f"CASE WHEN coalesce(url, '') = '' THEN {kilde('text')} ELSE url END AS url"
_DOCS = f"SELECT doc_id, text AS t, title, {_URL} FROM documents WHERE text IS NOT NULL"
_HEADED = "regexp_replace(text, '(?m)^# ', '## ', 'g')"
_DOCS_WIKI = f"SELECT doc_id, {_HEADED} AS t, title, CASE WHEN coalesce(url, '') = '' THEN {kilde(_HEADED)} ELSE url END AS url FROM documents WHERE text IS NOT NULL"


# ------------------------------------------------------------------ deduplication

def survivors(key: str, text: str, source: str) -> str:
    """Rows that come first in every bucket, with the same tokens and hash functions."""
    b, r = lsh_bands(0.7, 128)
    perms = permutations(b * r)
    mins = ", ".join(f"min((h * {a} + {c}) % {PRIME}) AS m{k}" for k, (a, c) in enumerate(perms))
    bands = " UNION ALL ".join(f"SELECT k, {i} AS band, concat_ws(',', {', '.join(f'coalesce(m{i * r + q}, {PRIME})' for q in range(r))}) AS v FROM sig" for i in range(b))
    return rf"""WITH d AS (SELECT {key} AS k, max({text}) AS t FROM {source} GROUP BY 1),
tok AS (SELECT DISTINCT k, unnest(regexp_extract_all(lower(t), '{WORD}+|[^\p{{L}}\p{{N}}_' || substr('{WS}', 2))) AS x FROM d),
hashed AS (SELECT k, CAST('0x' || substr(sha256(x), 1, 7) AS BIGINT) AS h FROM tok),
mn AS (SELECT k, {mins} FROM hashed GROUP BY k),
sig AS (SELECT d.k, mn.* EXCLUDE (k) FROM d LEFT JOIN mn USING (k)),
bands AS ({bands}),
firsts AS (SELECT band, v, min(k) AS k FROM bands GROUP BY band, v),
kept AS (SELECT k AS {key} FROM firsts GROUP BY k HAVING count(*) = {b})"""


_ORDER_KEY = "md5(concat_ws('|', '42', CAST({k} AS VARCHAR)))"
_SUBSETS = "[" + ", ".join(lit(k) for k in (*fixed.SUBSET_TYPES, "other")) + "]"
_PROMPT = "CASE " + " ".join(f"WHEN source_type = {lit(k)} THEN {lit(v)}" for k, v in prompts.SELECT.items()) + f" ELSE {lit(prompts.SELECT['knowledge'])} END"


def unlabelled(x: str) -> str:
    one = strip(rf"regexp_replace({strip(x)}, '\AFormat{WS}+[A-C]{WS}*[-:—]{WS}*', '')")
    return strip(rf"regexp_replace({one}, '\AFormat{WS}+[A-C]{WS}*\n+', '')")


_SQUEEZED = "array_to_string({w}, ' ')"
_CONTAINED = f"contains({_SQUEEZED.format(w=words('coalesce(original_paragraph, chr(32))'))}, {_SQUEEZED.format(w=words('coalesce(paragraph, chr(32))'))})"
_FORMAT = "['A', 'B', 'C'][CAST(list_sum(list_transform(range(1, 65), lambda i: CAST('0x' || substr(sha256(paragraph), i, 1) AS INTEGER))) % 3 AS INTEGER) + 1]"
_GENERATE = "CASE (CASE WHEN kind IN (" + ", ".join(map(lit, prompts.SELECT)) + ") THEN kind ELSE 'knowledge' END) || '|' || fmt " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in prompts.GENERATE.items()) + " END"
_RESPONSE = "CASE WHEN selected_id % 7 = 0 THEN ' skip' || chr(10) WHEN selected_id % 11 = 0 THEN '' ELSE paragraph END"
_USABLE = "coalesce(instruction, '') <> '' AND coalesce(paragraph, '') <> '' AND NOT (" + " OR ".join(f"starts_with(instruction, {lit(p)})" for p in fixed.REFUSAL_STARTS) + ")"


# ------------------------------------------------------------------ stages with the offline completer

def pick(x: str) -> str:
    return f"CAST('0x' || substr(sha256({x}), 1, 6) AS BIGINT) % 10"


def selected(source: str, more: str = "") -> str:
    """Stage 2 over (paragraph, title, url, section_heading, source_type): only a cut of the text itself is ever kept."""
    cut = "substr(paragraph, 1, CAST(greatest(150, length(paragraph) * 2 // 3) AS BIGINT))"
    return f"""SELECT {strip(cut)} AS paragraph, paragraph AS original_paragraph, coalesce(title, '') AS title, coalesce(url, '') AS url, coalesce(section_heading, '') AS section_heading,
coalesce(source_type, 'knowledge') AS source_type{more} FROM {source} WHERE {pick('paragraph')} >= 5 AND length({strip(cut)}) >= 150"""


def answer_case(labels: bool) -> str:
    """What the offline completer answers to a paragraph."""
    first = "array_to_string(" + words("paragraph") + "[1:6], ' ')"
    b, c = ("Format B: ", "Format C\n\n") if labels else ("", "")
    answers = {
        0: f"{lit(b)} || 'Kan du fortælle mig, hvad det betyder for os, når man siger: ' || {first} || '?'", 1: f"{lit(c)} || 'Hvad er det, som der menes med: ' || {first} || '?'",
        2: f"'Please tell me more about this particular topic and explain why: ' || {first}", 3: f"'Jeg kan ikke hjælpe med det, for der er ikke nok om: ' || {first}", 4: "''" if labels else "NULL",
    }
    case = f"CASE {pick('paragraph')} " + " ".join(f"WHEN {k} THEN {v}" for k, v in answers.items())
    return case + f" ELSE 'Hvad kan du fortælle mig om det, der er skrevet her, og hvorfor er det sådan: ' || {first} || '?' END"


def instructed(source: str, columns: str) -> str:
    """Stage 3: the completer's instruction without its label, if it looks Danish."""
    return f"""SELECT {columns}, instruction FROM (SELECT *, {words('lower(instruction)')} AS iw FROM (SELECT *,
{strip(answer_case(False))} AS instruction FROM {source})) WHERE instruction IS NOT NULL AND {DANISH}"""


DANISH = f"(len(iw) < 8 OR {cnt('iw', 'x', one_of('x', fixed.DANISH_MARKERS))} * 100 >= len(iw) * 6)"


def finished(source: str, key: str, order: str, more: str = "") -> str:
    """Stage 4 over (key, instruction, paragraph)."""
    return f"""{survivors(key, 'instruction', f'(SELECT * FROM {source} WHERE {_USABLE})')},
second AS ({survivors(key, 'paragraph', f'(SELECT * FROM {source} JOIN kept USING ({key}) WHERE {_USABLE})')} SELECT {key} FROM kept),
one AS (SELECT {key}, max(instruction) AS instruction, max(paragraph) AS answer{more} FROM {source} JOIN second USING ({key}) GROUP BY {key})
SELECT 'prompt_' || CAST(row_number() OVER (ORDER BY {order}, {key}) - 1 AS VARCHAR) AS prompt_id, * EXCLUDE ({key}) FROM one"""


_ASIS = "paragraph, original_paragraph, title, url, section_heading, source_type"
_E2E_ORDER = "md5(concat_ws('|', '42', CAST(k0 // 1000000 AS VARCHAR), CAST(k0 % 1000000 AS VARCHAR)))"


def _type_of(x: str) -> str:
    return f"CASE {' '.join(f'WHEN {x} = {lit(k)} THEN {lit(v)}' for k, v in fixed.SUBSET_TYPES.items())} ELSE 'knowledge' END"


def _judged(r: str) -> str:
    return f"CASE WHEN coalesce({r}, '') = '' THEN 'fail' WHEN upper({strip(r)}) = 'SKIP' THEN 'skip' WHEN length({strip(r)}) < 150 THEN 'short' WHEN NOT c THEN 'verify' ELSE 'kept' END"


ORACLE_SQL: dict[str, str] = {
    "split_generic": f"WITH src AS (SELECT doc_id, text AS t, title, url FROM documents), {CHUNKS} SELECT doc_id, chunk_idx, paragraph FROM parts",
    "split_sections": f"WITH src AS (SELECT paragraph_id, paragraph AS t FROM paragraphs), {section_parts('paragraph_id', 'src')} SELECT paragraph_id, chunk_idx, section_heading, paragraph FROM parts",
    "split_sentences": unnested("doc_id", "s", f"(SELECT doc_id, {sentences('text')} AS s FROM documents)", "sentence", "pos"),
    "merge_blocks": unnested("doc_id", "m", f"(SELECT doc_id, {unfolded('s')} AS m FROM (SELECT doc_id, {merged(lines('text'), 500, 'chr(10)')} AS s FROM documents))", "block", "pos"),
    "clean_paragraph": f"SELECT doc_id, {cleaned('text')} AS cleaned FROM documents",
    "metadata_url": f"SELECT doc_id, {kilde('t')} AS found_url, {kilde('text')} AS own_url FROM (SELECT doc_id, text, text || CASE WHEN doc_id % 2 = 0 THEN chr(10) || 'Kilde: ' || url || ' ' ELSE chr(10) || 'Kilde:x' || chr(10) || 'Publiceret: 2024-01-02' END AS t FROM documents)",
    **{f"rule_{n}": f"SELECT paragraph_id, {r} AS rejected FROM {_P}" for n, r in RULES.items()},
    "filter_generic": f"SELECT paragraph_id, {verdict(_ORDER)} AS verdict FROM {_P}",
    "filter_wiki": f"SELECT paragraph_id, {verdict(_WIKI)} AS verdict FROM {_P}",
    "reject_reason_counts": f"SELECT verdict, count(*) AS n FROM (SELECT {verdict(_WIKI)} AS verdict FROM {_P}) GROUP BY 1",
    "extract_generic": extracted(_ORDER, CHUNKS, _DOCS),
    "extract_wiki": extracted(_WIKI, section_parts("doc_id, title, url", "src"), _DOCS_WIKI),
    "extract_sample": f"SELECT doc_seq, chunk_idx FROM ({extracted(_ORDER, CHUNKS, _DOCS)}) ORDER BY md5(concat_ws('|', '42', CAST(doc_seq AS VARCHAR), CAST(chunk_idx AS VARCHAR))), doc_seq, chunk_idx LIMIT 100",
    "source_types": f"SELECT doc_id, s AS subset, {_type_of('s')} AS source_type, {_type_of('source')} AS own_type FROM (SELECT doc_id, source, {_SUBSETS}[CAST(doc_id % 8 AS INTEGER) + 1] AS s FROM documents)",
    "format_choice": f"SELECT selected_id, {_FORMAT} AS format FROM selected WHERE paragraph IS NOT NULL",
    "render_prompt": f"SELECT paragraph_id, replace({_PROMPT}, '{{paragraph}}', paragraph) AS prompt FROM paragraphs",
    "label_strip": f"SELECT pair_id, {unlabelled('i')} AS instruction, {unlabelled('instruction')} AS own FROM (SELECT pair_id, instruction, CASE WHEN pair_id % 3 = 0 THEN ' Format C' || chr(10) || chr(10) || instruction ELSE instruction END AS i FROM with_instructions)",
    "looks_danish": f"SELECT doc_id, len(w) < 8 OR {cnt('w', 'x', one_of('x', fixed.DANISH_MARKERS))} * 100 >= len(w) * 6 AS danish FROM (SELECT doc_id, {words('lower(text)')} AS w FROM documents)",
    "refusal_filter": f"SELECT pair_id, instruction FROM with_instructions WHERE {_USABLE}",
    "normalised_text": f"SELECT doc_id, {_SQUEEZED.format(w=words('text'))} AS squeezed FROM documents",
    "verbatim_fast": f"SELECT selected_id, {_CONTAINED} AS contained FROM selected",
    "select_verdicts": f"""SELECT selected_id, {_judged('r')} AS verdict, {_judged('paragraph')} AS own FROM (SELECT selected_id, paragraph, {_RESPONSE} AS r, {_CONTAINED} AS c FROM selected)""",
    "resume_anti": "SELECT paragraph_id FROM paragraphs p WHERE NOT EXISTS (SELECT 1 FROM selected s WHERE s.original_paragraph = p.paragraph)",
    "append_done": "SELECT paragraph, source_type, NULL AS title FROM selected UNION ALL SELECT paragraph, source_type, title FROM paragraphs",
    "cache_lookup": "SELECT selected_id, response FROM selected s LEFT JOIN (SELECT sha256(paragraph) AS key, max(instruction) AS response FROM with_instructions WHERE paragraph IS NOT NULL GROUP BY 1) c ON c.key = sha256(s.paragraph)",
    "lsh_dedup": survivors("doc_id", "text", "documents") + " SELECT doc_id FROM kept",
    "lsh_dedup_instructions": survivors("pair_id", "instruction", "with_instructions") + " SELECT pair_id FROM kept",
    "sample_n": f"SELECT doc_id, title FROM documents ORDER BY {_ORDER_KEY.format(k='doc_id')}, doc_id LIMIT 50",
    "shuffle_ids": f"SELECT doc_id, row_number() OVER (ORDER BY {_ORDER_KEY.format(k='doc_id')}, doc_id) - 1 AS row_no FROM documents",
    "chat_format": "SELECT pair_id, instruction AS content, 'user' AS role FROM with_instructions UNION ALL SELECT pair_id, paragraph, 'assistant' FROM with_instructions",
    "postprocess": finished("with_instructions", "pair_id", _ORDER_KEY.format(k="pair_id")),
    "select_stage": selected("(SELECT paragraph, title, url, section_heading, lower(trim(source_type)) AS source_type FROM paragraphs WHERE paragraph IS NOT NULL)"),
    "generate_stage": instructed("(SELECT paragraph, original_paragraph, title, url, section_heading, lower(trim(source_type)) AS source_type FROM selected WHERE paragraph IS NOT NULL)", _ASIS),
    "pipeline_e2e": f"""WITH ex AS ({extracted(_ORDER, CHUNKS, _DOCS)}),
sel AS ({selected("ex", ", doc_seq * 1000000 + chunk_idx AS k0")}),
pairs AS ({instructed("sel", _ASIS + ", k0")})
SELECT * FROM ({finished("pairs", "k0", _E2E_ORDER, ", max(title) AS title, max(url) AS url, max(section_heading) AS section_heading")})""",
    "generate_prompt": f"SELECT selected_id, {lit(prompts.GENERATE_SYSTEM)} AS system, replace({_GENERATE}, '{{paragraph}}', paragraph) AS prompt FROM (SELECT *, lower(trim(source_type)) AS kind, {_FORMAT} AS fmt FROM selected WHERE paragraph IS NOT NULL)",
    "cache_keys": f"""SELECT pair_id, sha256('{{"m":"m","t":0.3,"s":' || to_json({lit(prompts.SELECT_SYSTEM)}) || ',"u":' || to_json(coalesce(instruction, '')) || '}}') AS key FROM with_instructions""",
    "completion_map": f"SELECT selected_id, {answer_case(True)} AS response FROM selected WHERE paragraph IS NOT NULL",
    "resume_generate": "SELECT selected_id FROM selected s WHERE NOT EXISTS (SELECT 1 FROM with_instructions w WHERE w.paragraph = s.paragraph)",
    "stage_counts": f"""SELECT 'loaded' AS step, count(*) AS rows FROM with_instructions UNION ALL SELECT 'usable', count(*) FROM with_instructions WHERE {_USABLE}
UNION ALL SELECT 'instructions', count(*) FROM ({survivors('pair_id', 'instruction', f'(SELECT * FROM with_instructions WHERE {_USABLE})')} SELECT * FROM kept)
UNION ALL SELECT 'answers', count(*) FROM ({finished("with_instructions", "pair_id", _ORDER_KEY.format(k="pair_id"))})""",
    "resolve_defaults": "SELECT r_regionkey AS k, s.* FROM region, (VALUES ('', 'danish_wikipedia', 'title', 'url'), ('ft', 'danish_subsets', 'id', '')) s(subset, dataset, title, url)",
    "parquet_round_trip": "SELECT paragraph_id, paragraph, nullif(lower(trim(source_type)), '') AS source_type FROM paragraphs",
    "source_discovery": "SELECT * FROM (VALUES ('anden', true), ('egen', true), ('none', false)) v(name, local)",
    "skip_done": "SELECT n, there, false AS missing FROM (VALUES (0, true), (1, true), (5, true), (6, false)) v(n, there)",
    "jsonl_round_trip": "SELECT paragraph, title, url, section_heading, source_type FROM paragraphs",
    "source_scan": "SELECT text, CAST(doc_id AS VARCHAR) AS title, url FROM documents WHERE text IS NOT NULL",
}
