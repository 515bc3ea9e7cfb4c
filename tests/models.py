"""Plain-Python models of the original application's loops (test oracles)."""

from __future__ import annotations

import re

_WS = re.compile(r"\s+", re.ASCII)


def stop_words_rule(text: str, stop: set[str]) -> str:
    """Our rule for P8: the first and the last token stay, and every other that is no stop word.

    Tokens that were neighbours keep the white space between them, others get one space."""
    tokens, gaps = _WS.split(text), _WS.findall(text)
    kept = [i for i, w in enumerate(tokens) if i in (0, len(tokens) - 1) or w not in stop]
    out = tokens[kept[0]]
    for before, i in zip(kept, kept[1:]):
        out += (gaps[before] if i == before + 1 else " ") + tokens[i]
    return out


def intervals_state_machine(rows):
    """rows: (timestamp, _id, sentiment or None) of one hashtag, any order.

    Returns [(start_ts, end_ts, seconds, tweets)] exactly like the driver loop:
    rows without sentiment are skipped; a run still open at the end is dropped.
    """
    out = []
    open_at, tweets = None, 0
    for ts, _id, sentiment in sorted(rows, key=lambda r: (r[0], r[1])):
        if sentiment is None:
            continue
        if open_at is not None:
            tweets += 1
            if sentiment != "positive":
                out.append((open_at, ts, ts - open_at, tweets))
                open_at, tweets = None, 0
        elif sentiment == "positive":
            open_at, tweets = ts, 0
    return out
