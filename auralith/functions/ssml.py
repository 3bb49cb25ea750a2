"""Speech markup: phrases by offsets, alignment of texts, documents."""

from __future__ import annotations

import re
from difflib import SequenceMatcher
from xml.sax.saxutils import escape, quoteattr

from auralith.hebrew import COMMANDS

# Hint -> rate, pitch, volume, pause before and after in ms.
HINTS = {
    "stress": ("+15%", "+1st", "+3%", 0, 0), "slow": ("-20%", None, None, 150, 0), "break_before": (None, None, None, 250, 0),
    "break_after": (None, None, None, 0, 250), "menace": ("-25%", "-1st", None, 300, 0),
}
FIELDS = ("phrase_id", "char_start", "char_end", "rate", "pitch", "volume", "break_before_ms", "break_after_ms")
PHRASES = "array<struct<phrase_id:string,char_start:int,char_end:int,rate:string,pitch:string,volume:string,break_before_ms:int,break_after_ms:int>>"


def sanitized(text: str) -> str:
    """Without control characters that XML doesn't allow."""
    return re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", text)


def offset_map(source: str, target: str) -> list[int]:
    """Where each position of the source, and its end, lies in the target. Inside replaced parts positions go in proportion, deleted ones to where the target goes on."""
    out = [0] * (len(source) + 1)
    for kind, i, j, p, q in SequenceMatcher(None, source, target, autojunk=False).get_opcodes():
        for k in range(i, j):
            out[k] = p + (k - i if kind == "equal" else (k - i) * (q - p) // (j - i))
        out[j] = q
    out[len(source)] = len(target)
    return out


def moved(phrases: list[dict], source: str, target: str) -> list[dict]:
    """Phrases with offsets in the source, as offsets in the target; those that vanish are left out."""
    to = offset_map(source, target)
    at = lambda k: to[max(0, min(k, len(to) - 1))]
    placed = [p | {"char_start": at(p["char_start"]), "char_end": at(p["char_end"])} for p in phrases]
    return [p for p in placed if p["char_start"] < p["char_end"]]


def hinted(hints: list[dict], original: str, spoken: str) -> list[dict]:
    """The phrases of known hints (phrase_id, hint, char_start_original, char_end_original) in the spoken text."""
    known = [dict(zip(FIELDS, (h["phrase_id"], h["char_start_original"], h["char_end_original"], *HINTS[h["hint"]]), strict=True)) for h in hints if h["hint"] in HINTS]
    return moved(known, original, spoken)


def commands(text: str) -> list[dict]:
    """Words of command at the ends of sentences, slower and after a pause."""
    out, at = [], 0
    for sentence in re.split(r"(?<=[.!?])\s+", text):
        at = text.index(sentence, at)
        words = sentence.split()
        if words and words[-1].translate(str.maketrans("", "", "?!.,;:\"'״׃")) in COMMANDS:
            start = at + sentence.rfind(words[-1])
            out.append(dict(zip(FIELDS, (f"heuristic_p{len(out)}", start, start + len(words[-1]), "-15%", None, None, 200, 0), strict=True)))
        at += len(sentence)
    return out


def phrases(hints: list[dict], original: str, spoken: str) -> list[dict]:
    """Those of the hints and of the words of command by their starts."""
    return sorted(hinted(hints, original, spoken) + commands(spoken), key=lambda p: p["char_start"])


def percent(value: float, low: int = -50, high: int = 50) -> str:
    """A signed whole percentage within bounds, rounded half to even."""
    return f"{max(low, min(high, round(value))):+d}%"


def _inside(text: str, found: list[dict]) -> str:
    """The text with the phrases' markup: neighbouring pauses are one, a phrase that begins inside another is left out."""
    parts: list[str | int] = []  # markup, or the length of a pause
    done = 0

    def pause(ms: int) -> None:
        if ms > 0 and parts and isinstance(parts[-1], int):
            parts[-1] += ms
        elif ms > 0:
            parts.append(ms)

    for p in sorted(found, key=lambda p: p["char_start"]):
        if p["char_start"] >= p["char_end"] or p["char_start"] < done:
            continue
        if p["char_start"] > done:
            parts.append(escape(text[done : p["char_start"]]))
        pause(p["break_before_ms"])
        body = escape(text[p["char_start"] : p["char_end"]])
        marks = "".join(f" {k}={quoteattr(p[k])}" for k in ("rate", "pitch", "volume") if p[k] is not None)
        parts.append(f"<prosody{marks}>{body}</prosody>" if marks else body)
        pause(p["break_after_ms"])
        done = p["char_end"]
    if text[done:]:
        parts.append(escape(text[done:]))
    return "".join(f'<break time="{p}ms" />' if isinstance(p, int) else p for p in parts)


def document(utterances: list[dict], styles: bool = True, language: str = "he-IL") -> str:
    """One document of several utterances (text, voice, style, rate, pitch, volume, phrases), each with its voice; small changes of prosody are left out."""
    voices = []
    for u in utterances:
        body = _inside(sanitized(u["text"]), u.get("phrases") or [])
        rate, pitch, volume = u.get("rate", 1.0), u.get("pitch", 0.0), u.get("volume", 0.0)
        marks = (f' rate="{percent((rate - 1) * 100, -50, 200)}"' if abs(rate - 1) > 0.01 else "") + (f' pitch="{percent(pitch * 5.946)}"' if abs(pitch) > 0.1 else "") + (f' volume="{percent(volume)}"' if abs(volume) > 0.1 else "")
        body = f"<prosody{marks}>{body}</prosody>" if marks else body
        if styles and (u.get("style") or "general").lower() != "general":
            body = f"<mstts:express-as style={quoteattr(u['style'])}>{body}</mstts:express-as>"
        voices.append(f"<voice name={quoteattr(u['voice'])}>{body}</voice>")
    more = ' xmlns:mstts="https://www.w3.org/2001/mstts"' if styles else ""
    return f'<?xml version="1.0" encoding="UTF-8"?>\n<speak version="1.0" xmlns="http://www.w3.org/2001/10/synthesis" xml:lang="{language}"{more}>{"".join(voices)}</speak>'
