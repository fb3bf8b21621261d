"""Shared pieces of the training-data operators: tables kept in the shared folder, Arrow row maps, and
the light text analysis (words, languages, sentences) that several operators need."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.settings import path_of  # noqa: F401 - used by the operators
from ..sources.shared import discard, materialise, shared_dir  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(df: DataFrame, keys: list[str], text_cols: list[str], fn: Callable[..., tuple], schema: str) -> DataFrame:
    """Arrow-batched row map: ``fn(*texts)`` gives the tuple of new columns of one row (None: the row is dropped);
    ``keys`` are passed through unchanged as Arrow columns. ``schema`` is the DDL of the new columns."""
    out_schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys) + ", " + schema
    names = [c.split()[0].strip("`") for c in re.split(r",(?![^<]*>)", schema)]
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    types = [to_arrow_type(f.dataType) for f in StructType.fromDDL(schema).fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in text_cols]
            rows = [fn(*r) for r in zip(*cols)]
            kept = [i for i, r in enumerate(rows) if r is not None]
            if len(kept) < len(rows):
                part = b.take(pa.array(kept, pa.int32()))
                rows = [rows[i] for i in kept]
            else:
                part = b
            new = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index(k)) for k in keys] + [pa.array(list(c), t) for c, t in zip(new, types)], names=[*keys, *names]
            )

    return df.select(*dict.fromkeys([*keys, *text_cols])).mapInArrow(run, out_schema)


def flat_map_rows(df: DataFrame, cols: list[str], fn: Callable[..., list[tuple]], schema: str) -> DataFrame:
    """Arrow-batched flat map: ``fn`` of one row's ``cols`` gives a list of output rows."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(schema).fields
    types, names = [to_arrow_type(f.dataType) for f in fields], [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            src = [b.column(b.schema.get_field_index(c)).to_pylist() for c in cols]
            rows = [o for r in zip(*src) for o in fn(*r)]
            new = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(new, types)], names=names)

    return df.select(*cols).mapInArrow(run, schema)


# ------------------------------------------------------------------ columns

def plain_source(c: Column, default: str) -> Column:
    """Trimmed, lower-cased source name; null or blank read as ``default``."""
    t = F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    return F.when(F.coalesce(t, F.lit("")) == "", F.lit(default)).otherwise(t)


def plain_lang(c: Column) -> Column:
    """Base language of a declared code: ``da-DK`` and ``DA`` are ``da``; null or blank is ``und``."""
    t = F.lower(F.regexp_extract(F.trim(c), r"^([A-Za-z]+)", 1))
    return F.when(F.coalesce(t, F.lit("")) == "", F.lit("und")).otherwise(t)


# ------------------------------------------------------------------ languages
# Frequent function words by language.
FUNCTION_WORDS = {
    "da": "og i at det er en den til af på for ikke der var med de han har som et jeg om vi du fra så men hun kan vil ved skal ud "
          "hvad blev eller ind op over efter nu også når dem hvor hvis under sig mig dig os kun hans hendes dette denne disse "
          "hvordan hvorfor hvilken hvilke fortæl beskriv forklar skriv mellem uden mod hver noget nogle meget siden fordi bag langs foran omkring både samt",
    "sv": "och i att det är en den till av på för inte där var med de han har som ett jag om vi du från så men hon kan vill vid "
          "ska ut vad blev eller in upp över efter nu också när dem hur under sig mig dig oss bara detta denna dessa hur varför vilken vilka berätta beskriv förklara mellan utan "
          "mot varje något några mycket sedan eftersom bakom längs medan utanför både samt finns",
    "en": "the of and to in a is that it was for on are with as his they at be this have from or one had by but not what all were "
          "we when your can there an which their if will each about how up out them then she many some so these would other into "
          "has more her two him see could no than been its who now my over did down only because behind along near while why tell explain describe write",
    "de": "der die das und in zu den mit von ist des sich dem nicht ein eine als auch es an er so dass kann aus wird bei oder auf "
          "nach im wir sie war einen einer um am sind noch wie haben nur über vor zur bis mehr durch man sein wurde wenn hat für "
          "unter während weil hinter zwischen unweit beim zum einem eines ihr ihre was warum wer man erzähle erkläre erklären beschreibe mir",
}
LANGS = tuple(FUNCTION_WORDS)
_MASK: dict[str, int] = {}
for _i, _l in enumerate(LANGS):
    for _w in FUNCTION_WORDS[_l].split():
        _MASK[_w] = _MASK.get(_w, 0) | 1 << _i
#: For the guess a word of one language counts fully and a word that several share counts in part.
_WEIGHT = {m: [(1.0 if m == 1 << i else 0.25) if m >> i & 1 else 0.0 for i in range(4)] for m in range(16)}
WORD = re.compile(r"[^\W\d_]+")


def language_scores(words_lower: list[str], exclusive: bool = False) -> tuple[int, list[float]]:
    """Number of function words (of any language), and the weight for each of LANGS; ``exclusive``: of words proper to one."""
    c = Counter(map(_MASK.get, words_lower))
    none = c.pop(None, 0)
    s = [0.0] * 4
    for m, n in c.items():
        w = _WEIGHT[m]
        if exclusive and m & (m - 1):
            continue
        for i in range(4):
            if w[i]:
                s[i] += w[i] * n
    return len(words_lower) - none, s


def guess_language(words_lower: list[str], least: float = 1.5) -> str:
    """Language by function words, ``und`` if there is too little to tell."""
    _, s = language_scores(words_lower)
    k = max(range(4), key=s.__getitem__)
    return LANGS[k] if s[k] >= least else "und"


# ------------------------------------------------------------------ sentences
#: Abbreviations after which a full stop does not end a sentence.
ABBREVIATIONS = frozenset(
    "jf stk nr bl a ca kl dvs f eks fx m v mv o osv pga ang evt hr fr dr prof tlf inkl ekskl max min pkt cf sec no i e g vs etc al "
    "mr mrs ms st vgl abs u z b d h usw ggf bzw ev t ex kap".split()
)
END = re.compile(r"[.!?…]+[\"'»«”“’)\]]*(?=\s|$)")
CLOSED = re.compile(r"[.!?…]+[\"'»«”“’)\]*_]*\s*$")


def sentences(text: str) -> list[str]:
    """Sentences of a text: a line end closes one, and so do . ! ? … before white space, except after an
    abbreviation, a single letter or before a lower-case letter following a full stop."""
    out = []
    for line in text.split("\n"):
        at = 0
        for m in END.finditer(line):
            e = m.end()
            if m.group()[0] == "." and m.group() != "...":
                k = m.start()
                b = k
                while b > at and line[b - 1].isalnum():
                    b -= 1
                w = line[b:k]
                if w.lower() in ABBREVIATIONS or len(w) == 1 and w.isalpha():
                    continue
                rest = line[e:e + 3].lstrip()
                if w.isdigit() and (not rest or rest[0].islower() or rest[0].isdigit()) and e < len(line):
                    continue
            s = line[at:e].strip()
            if s:
                out.append(s)
            at = e
        s = line[at:].strip()
        if s:
            out.append(s)
    return out
