"""What a model that labels a trajectory gets to read: its user's own words, within a budget."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.labels import shortened

# Blocks that frameworks put into a user's turn, and headings that wrap a request.
FRAMES = ("system-reminder", "environment_context", "user_instructions", "command-message", "command-name", "command-args", "local-command-stdout", "permissions instructions", "collaboration_mode", "skills_instructions", "turn_aborted")
WRAPPERS = (r"^\s*#+\s*(?:my request for \w+|user request|task)\s*:?\s*$",)
MEDIA = r"(?is)<(image|audio|video|file)\b[^>]*>.*?</\1\s*>|data:[^\s\"'<>;,]*;base64,[A-Za-z0-9+/=\r\n]+"


def without_frames(text: Column) -> Column:
    """Text without the frameworks' blocks, in built-in expressions; blocks inside blocks are left to :func:`requests`."""
    for name in FRAMES:
        text = F.regexp_replace(text, rf"(?is)<{re.escape(name)}\b[^>]*>.*?</{re.escape(name.split()[0])}[^>]*>", " ")
    return F.trim(F.regexp_replace(text, MEDIA, "[media]"))


def _words(text: str) -> str:
    for name in FRAMES:
        pattern = re.compile(rf"<{re.escape(name)}\b[^>]*>(?:(?!<{re.escape(name)}\b).)*?</{re.escape(name.split()[0])}[^>]*>", re.I | re.S)
        while pattern.search(text):  # the innermost first
            text = pattern.sub(" ", text)
    for pattern in WRAPPERS:
        text = re.sub(pattern, "", text, flags=re.I | re.M)
    text = re.sub(MEDIA, "[media]", text)
    return re.sub(r"\n{3,}", "\n\n", text).strip()


@F.pandas_udf(T.StringType())
def requests(turns: pd.Series) -> pd.Series:
    """The requests of an array of user turns as a JSON array of texts; turns of nothing but frames are left out."""
    return turns.map(lambda own: json.dumps([w for t in (own if own is not None else ()) if (w := _words(t or ""))], ensure_ascii=False))


def within(budget: int):
    """A function that cuts texts to ``budget`` characters, of head and tail alike."""

    @F.pandas_udf(T.StringType())
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else shortened(t, budget))

    return cut
