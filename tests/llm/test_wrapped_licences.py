"""Licence notices wrapped over lines."""

from __future__ import annotations

import textwrap

import pytest

from tests.llm import docs as fixture
from trailmark.llm import licenses

MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    'and associated documentation files (the "Software"), to deal in the Software without '
    "restriction, including without limitation the rights to use, copy, modify and merge."
)
GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation, either version 3 of "
    "the License, or (at your option) any later version."
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:"
)


@pytest.fixture(scope="module")
def rows():
    made = [row for row in fixture.rows() if row[0] != 10]
    for i, notice in enumerate((MIT, GPL, BSD)):
        for k, sign in enumerate(("", "# ", " * ")):
            lines = textwrap.wrap(notice, 72, initial_indent=sign, subsequent_indent=sign)
            before, after = fixture.prose(i, 30), fixture.prose(i + 9, 30)
            gap = "\n\n" if k == 0 else "\n"
            text = before + gap + "\n".join(lines) + gap + after
            made.append((700 + 10 * i + k, text, "en", "s", 1))
    parts = [line.split(" ", 6)[-1] for line in textwrap.wrap(MIT, 72)]
    made.append((790, "\n\n".join(parts), "en", "s", 1))  # blank lines keep lines apart
    made.append((791, "Licensed under CC BY 4.0.\n" + fixture.prose(3, 30), "en", "s", 1))
    return made


def test_wrapped_notices_are_found_once(spark, rows):
    docs = fixture.table(spark, rows)
    model = licenses.train(docs)
    found = {row.doc_id: row for row in licenses.scan(docs, model).collect()}
    for i, family in enumerate(("MIT", "GPL", "BSD")):
        for k in range(3):
            named = [(one.paragraph, one.family) for one in found[700 + 10 * i + k].licences]
            assert named == [(1, family)]
    assert found[790].licences == []
    assert [(one.paragraph, one.family) for one in found[791].licences] == [(0, "CC-BY")]


def test_scattered_words_are_no_notice():
    model = licenses.fit([fixture.prose(i, 20) for i in range(50)])
    words = licenses.words_of(MIT)
    spread = [f"{a} {b}\n{fixture.prose(i, 12)}" for i, (a, b) in enumerate(zip(words, words[1:]))]
    assert model.scan("\n".join(spread))[1] == []


def test_lines_of_a_wrapped_notice_are_no_negatives(rows):
    shell = licenses._shell(licenses.Settings(), licenses.TEMPLATES)
    left = shell.other_lines("one line\n" + textwrap.fill(GPL, 72) + "\n\nthe last")
    assert left[0] == "one line" and left[-1] == "the last" and len(left) <= 4
