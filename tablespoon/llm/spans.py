"""Span findings of a text: ordering, counting and the text form ``kind:start:end`` joined by commas."""

from __future__ import annotations

import hashlib

Span = tuple[str, int, int]  # kind, first code point, code point after the last


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(listed(spans).encode()).hexdigest()


def ascii_lower(text: str) -> str:
    """``text`` with A-Z lower-cased and nothing else, so positions stay."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
