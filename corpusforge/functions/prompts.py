"""Prompt templates in our own wording: by source type for selection, by source type and format for instructions."""

from __future__ import annotations

from .fixed import FORMATS

SELECT_SYSTEM = "You judge Danish texts as answers of an assistant. You copy word for word and never rewrite. If in doubt, you skip."
GENERATE_SYSTEM = "You write the messages that Danish users send to an assistant. You give the message only, in Danish."

_KIND = {
    "knowledge": ("an encyclopedic article", "wants to know or understand something"),
    "speech": ("a speech or debate", "asks for a speech, a statement or a point of view"),
    "news": ("a news article", "asks what happened or for a piece of news"),
    "government": ("an official letter or report", "asks about rules, rights or a procedure"),
}
_FORM = {"A": "at most ten words", "B": "one full sentence", "C": "two or three sentences that say why the user asks"}

SELECT = {
    k: f"The text comes from {kind}. Copy the one passage of at least two sentences that answers a question by itself, exactly as it stands. If there is none, answer SKIP.\n\n<text>\n{{paragraph}}\n</text>"
    for k, (kind, _) in _KIND.items()
}
GENERATE = {
    f"{k}|{f}": f"The text comes from {kind} and is the answer to a user who {want}. Write the user's message in Danish, {_FORM[f]}, without naming the text.\n\n<text>\n{{paragraph}}\n</text>"
    for k, (kind, want) in _KIND.items()
    for f in FORMATS
}
