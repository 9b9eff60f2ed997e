"""Run settings from text: key (unit) = value lines."""

from __future__ import annotations

import re

_LINE = re.compile(r"\s*([^=(]+?)\s*(?:\(([^)]*)\))?\s*=\s*(.*?)\s*$")


def parse(text: str) -> dict[str, tuple[str, str | None]]:
    """Lower-case keys to (value, unit). An exclamation mark starts a comment, a trailing backslash joins lines, a line eof ends."""
    out: dict[str, tuple[str, str | None]] = {}
    for line in re.sub(r"\\\n", " ", text).splitlines():
        line = line.split("!", 1)[0]
        if line.strip().lower() == "eof":
            break
        if found := _LINE.match(line):
            out[found[1].lower()] = (found[3], found[2])
    return out


def numbers(value: str) -> list[float]:
    return [float(v) for v in value.split()]
