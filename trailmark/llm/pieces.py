"""Cuts text where byte-level BPE can never merge, so that results can be kept by piece.

The public split pattern ends a match before every run of white space, lets at most one
space lead the next match, and treats white space itself only by what stands around it.
Cutting at those places alone gives longer pieces, and each piece splits by the full
pattern on its own exactly as it does inside its text.
"""

from __future__ import annotations

import re

# The characters with Unicode's White_Space property, as the pattern's \s has them.
SPACES = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

_PIECE = re.compile(f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")


def pieces(text: str) -> list[str]:
    """The pieces of ``text`` in order; they add up to the text."""
    return _PIECE.findall(text)
