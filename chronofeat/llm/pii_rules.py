"""The fixed rules for personal data, and checks of spans that a model proposes.

Matches are leftmost and non-overlapping per kind.  Each pattern is written so
that one pass over the text suffices: an address is looked for around each
``@``, runs of digits start where a run starts, loops are possessive."""

from __future__ import annotations

import re
from typing import Iterator, List, Tuple

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_BACK = re.compile(r"[A-Za-z0-9._%+-]*+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def small_parts(text: str) -> bool:
    """Whether every number in a dotted address is at most 255."""
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) < 4 and int(p or "0") <= 255 for p in parts)


def _emails(text: str) -> Iterator[Tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        end = at + 1
        if domain:
            local = len(_LOCAL_BACK.match(text[done:at][::-1]).group()) if at > done else 0
            if local:
                yield at - local, domain.end()
                done = end = domain.end()
        # what stands before this @ can only belong to it, for no part holds an @
        done = max(done, at + 1)
        at = text.find("@", end)


def base_spans(text: str) -> List[Tuple[int, int, str]]:
    """``(start, rank of the kind, kind, end)`` by start, then kind, in code points."""
    out = [(a, 0, "email", b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if small_parts(m.group()):
            out.append((m.start(), 1, "ip", m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _DIGITS.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, "card", m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGITS.sub("", m.group())) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


_PARTS = re.compile(r"[0-9]+")
_AT = re.compile(r"@|[(\[{]\s*at\s*[)\]}]|\sat\s", re.IGNORECASE)
_DOT = re.compile(r"[.]|[(\[{]\s*dot\s*[)\]}]|\sdot\s", re.IGNORECASE)


def plausible(kind: str, text: str) -> bool:
    """Whether a proposed span can be what it is said to be: the digits and
    marks of the base rules, with other writing between them."""
    digits = _DIGITS.sub("", text)
    if kind == "email":
        at = _AT.search(text)
        return bool(at and text[:at.start()].strip() and _DOT.search(text, at.end()) and text[-1:].isalnum())
    if kind == "ip":
        parts = _PARTS.findall(text)
        return len(parts) == 4 and all(len(p) < 4 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and not any(c.isalpha() for c in text)
