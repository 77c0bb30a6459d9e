"""Personal data as people write it past a pattern: variants of labelled spans, for training.

A window's span is rewritten (spelled-out `at` and `dot`, spaces or brackets around marks,
other separators, digits of other scripts) and keeps its label; half of the time its names or
numbers are new ones as well, so that no name or host of the sample is learned by heart.
Windows without spans get things that look alike (dates, versions, prices, long numbers, `at`
and `dot` as words) and keep none.
"""

from __future__ import annotations

import random
import re

AT = (" at ", " [at] ", " (at) ", "[at]", "(at)", " @ ", "＠", " AT ", " {at} ")
DOT = (" dot ", " [dot] ", " (dot) ", "[dot]", "(dot)", " . ", ".", ".", " DOT ")
IP_MARKS = (" . ", "[.]", ". ", " dot ", "(.)", "．", " .", "[dot]")
CARD_MARKS = (".", "/", "_", "  ", " - ", "–", " . ", ":")
PHONE_MARKS = ("/", "–", " / ", "_", " – ", "  ")
ENDINGS = ("com", "org", "net", "de", "fr", "es", "io", "edu", "co.uk", "info")
DIGIT_ZEROS = (0x0660, 0x06F0, 0x0966, 0xFF10)  # Arabic-Indic, Persian, Devanagari, full width

LOOKALIKES = (
    " at the door at nine ", " dot the line dot by dot ", " 3.14 ", " 2024-01-31 ", " 12:30 ",
    " v1.2.3 ", " 1,250.00 ", " (2019) ", " ٣٥ ", " ４２ ", " 10.5 . 3 ",
    " room 12 at 9 ", " 12345678 ", " 3. 4. 5. ", " 99 at 7. ", " page 17/18 ", " 31.12.1999 ",
    " at home. A dot ", " 1/2/3 ", " 5 - 7 ", " 1990–1994 ", " [at 5] ", " 007 ", " 4 x 100 ",
    " pp. 12-14 ", " 20 at 30 dot ", " 0.5 ", " 100 000 ", " +5 ", " ०१ ")


def _other_digits(text: str, rng: random.Random) -> str:
    zero = rng.choice(DIGIT_ZEROS)
    return "".join(chr(zero + int(c)) if "0" <= c <= "9" else c for c in text)


def _word(rng: random.Random) -> str:
    return "".join(rng.choice("bcdfghjklmnprstvwz") + rng.choice("aeiouy") + rng.choice(
        ("", "", "n", "r", "s", "l")) for _ in range(rng.randint(1, 4)))


def _address(rng: random.Random) -> str:
    name = _word(rng) + "".join(rng.choice("._-") + _word(rng) for _ in range(rng.choice((0, 0, 1, 1, 2))))
    name += str(rng.randrange(100)) if rng.random() < 0.2 else ""
    labels = [_word(rng) for _ in range(rng.choice((1, 1, 2)))]
    return f"{name}@{'.'.join(labels)}.{rng.choice(ENDINGS)}"


def _digits(text: str, rng: random.Random) -> str:
    return "".join(rng.choice("0123456789") if c.isdigit() else c for c in text)


def lookalike(rng: random.Random) -> str:
    """Something that is no personal data: words and numbers, or a long number."""
    if rng.random() < 0.3:
        return f" {_digits('0' * rng.choice((7, 9, 11, 12, 13, 14, 20, 21, 24)), rng)} "
    if rng.random() < 0.3:
        return f" {_word(rng)} {rng.choice(('at', 'dot', 'at the', '. At', 'dot. A'))} {_word(rng)} "
    return rng.choice(LOOKALIKES)


def varied(kind: str, text: str, rng: random.Random) -> str:
    """A variant of a span's text that the base patterns do not cover."""
    new = rng.random() < 0.5
    if kind == "email":
        name, _, host = (_address(rng) if new else text).partition("@")
        at, dot = rng.choice(AT), rng.choice(DOT)
        if at in (" at ", " AT ") and dot in (".", " . "):
            dot = " dot "  # `word at word.word` is also prose
        return name + at + dot.join(host.split("."))
    if new:
        text = (".".join(str(rng.randrange(256)) for _ in range(4)) if kind == "ip"
                else _digits(text, rng))
    if rng.random() < 0.35:
        return _other_digits(text, rng)
    if kind == "ip":
        return rng.choice(IP_MARKS).join(text.split("."))
    if kind == "card":
        digits = re.sub(r"[^0-9]", "", text)
        groups = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return rng.choice(CARD_MARKS).join(groups)
    parts = re.findall(r"[0-9]+", text)
    return rng.choice(("00", "+", "(+", "(00")) + rng.choice(PHONE_MARKS).join(parts)
