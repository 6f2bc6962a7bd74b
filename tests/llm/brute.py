"""Brute-force pieces shared by the tests."""

from __future__ import annotations

import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words_of(text: str | None, lower: bool = True) -> list[bytes]:
    data = (text or "").encode()
    return WORD.findall(data.lower() if lower else data)
