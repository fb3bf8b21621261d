"""Cleaning of a chunk: speaker labels, title lines and metadata lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import WS, strip

_META = rf"\A(?:Publiceret:{WS}*\p{{Nd}}{{4}}-\p{{Nd}}{{2}}-\p{{Nd}}{{2}}|Kategorier:|Kilde:)"


def cleaned(text: Column) -> Column:
    """Lines stripped; title lines (one number sign) and metadata lines dropped; speaker labels taken out anywhere."""
    rows = F.filter(F.transform(F.split(text, "\n", -1), strip), lambda l: ~l.startswith("# "))
    rows = F.transform(rows, lambda l: F.regexp_replace(l, rf"TALER{WS}+\p{{Nd}}+:{WS}*", ""))
    return strip(F.array_join(F.filter(rows, lambda l: ~l.rlike(_META)), "\n"))


def metadata_url(text: Column) -> Column:
    """What the last line that starts with ``Kilde:`` gives as source; "" if there is none (also for null)."""
    hits = F.filter(F.transform(F.split(text, "\n", -1), strip), lambda l: l.startswith("Kilde:"))
    last = F.try_element_at(hits, F.lit(-1))
    return F.coalesce(strip(F.substring(last, 7, 1 << 30)), F.lit(""))
