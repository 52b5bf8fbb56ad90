"""File names for any value, and back."""

from __future__ import annotations

import re

# what stands for NULL, and what stands before the number of a repeated name: escaping makes neither
_NULL, _COPY = "%~", "%+"
_UNSAFE = re.compile(r"[%/\x00-\x1f\x7f]|^\.|^$")


def escaped(value: str | None, copy: int = 1) -> str:
    """A name for a file or folder: slashes, percent signs, control characters and a leading dot as ``%XX``."""
    safe = _NULL if value is None else _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}" if m[0] else "%", value)
    return safe if copy == 1 else f"{safe}{_COPY}{copy}"


def unescaped(name: str) -> str | None:
    """The value that :func:`escaped` was given, without its number."""
    safe = re.sub(r"%\+\d+$", "", name)
    if safe == _NULL:
        return None
    return re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), "" if safe == "%" else safe)
