"""Licence notices as they are laid out: wrapped over lines, behind comment marks."""

from __future__ import annotations

import textwrap

import pytest

from skyloom.llm import licenses

NOTICES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
}
NOTICES |= {
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Unlicense": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}
GPL = NOTICES["GPL-3.0"]
NOTICES |= {"GPL-2.0": GPL.replace(", either version 3", "; either version 2"), "AGPL-3.0": GPL.replace("GNU General", "GNU Affero General"), "LGPL-3.0": GPL.replace("GNU General", "GNU Lesser General")}
# Notices of licences, or versions, that the templates don't hold.
STRANGE = [
    "Licensed under the PostgreSQL License.", "Licensed under the PHP License.", "Licensed under the Ruby License.", "Released under the Python License.", "This work is licensed under a Creative Commons Attribution 3.0 International License.",
    "Licensed under the Apache License, Version 1.1.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.", "Licensed under the Eclipse Public License 1.0.",
    "This work is licensed under the GNU General Public License, version 1.", "Licensed under CC BY 3.0.", "Licensed under CC BY-ND 4.0.", "Licensed under CC BY-NC-SA 3.0.", "Licensed under the Academic Free License, Version 3.0.",
    "Distributed under the Boost Software License, Version 2.0.", "Released under the BSD 4-Clause License.", "Released under the Zope License.", "Licensed under the Artistic License 2.0.", "Licensed under the Microsoft Public License.",
    "This library is licensed under the GNU Lesser General Public License, version 2.", "under the terms of the GNU Lesser General Public License version 2.1", "Licensed under the NASA License.", "Licensed under the X11 License.",
    "This work is licensed under the GNU Free Documentation License, version 3.", "Licensed under the Vim License.", "Licensed under the Open Software License 3.0.", "Licensed under the W3C license.", "Dedicated to the public domain under CC0 2.0.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "This program is licensed under the Sleepycat General Public License, version 3.", "Licensed under the Educational Community License, Version 2.0.",
    "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.",
]
KNOWN = {
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Licensed under the MIT license.": "MIT", "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0", "Licensed under CC BY 4.0.": "CC-BY-4.0", "Released under the BSD 3-Clause License.": "BSD-3-Clause",
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0", "This library is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0", "Licensed under the ISC License.": "ISC",
    "Licensed under the Mozilla Public License 2.0.": "MPL-2.0", "Licensed under the Eclipse Public License 2.0.": "EPL-2.0"}
MARKS = ["", "# ", " * ", "// "]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(10 * i + k, textwrap.indent("Copyright (c) 2020 An Author\n\n" + textwrap.fill(t, 72) + "\n\nmore", mark, lambda _: True)) for i, t in enumerate(NOTICES.values()) for k, mark in enumerate(MARKS)]
    rows += [(100 + i, "\n".join(f"vento{i * j % 97} torre{j} sasso{i} prato monte{j * j % 31} cielo" for j in range(12))) for i in range(100)]
    rows += [(1000 + i, t) for i, t in enumerate(STRANGE)] + [(2000 + i, f"a quiet line\n\n{t}\n\nmore words here") for i, t in enumerate(KNOWN)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r for r in licenses.scan(docs, licenses.train(docs)).collect()}


@pytest.mark.parametrize("family", NOTICES)
@pytest.mark.parametrize("mark", MARKS)
def test_wrapped_notices(found, family, mark):
    got = found[10 * list(NOTICES).index(family) + MARKS.index(mark)]
    assert (got.family, list(got.families)) == (family, [family]), got


def test_wrapped_prose_has_no_licence(found):
    assert not [i for i, r in found.items() if 100 <= i < 1000 and (r.family or r.n_licensed)]


@pytest.mark.parametrize("k", range(len(STRANGE)))
def test_strange_licences_get_no_name(found, k):
    assert (found[1000 + k].family, found[1000 + k].n_licensed) == (None, 0), STRANGE[k]


def test_most_strange_licences_are_noticed(found):
    assert sum(found[1000 + k].n_unknown > 0 for k in range(len(STRANGE))) >= 24


@pytest.mark.parametrize("k", range(len(KNOWN)))
def test_titles_keep_their_names(found, k):
    assert found[2000 + k].family == list(KNOWN.values())[k]


def test_every_template_confirms_its_own_family_alone():
    p = licenses.Licenses()
    for f, texts in licenses.TEMPLATES.items():
        for t in texts:
            words = licenses._tokens("some words before " + t + " and some after")
            assert licenses.confirmed(words, f, p) == (1.0, True)
            assert licenses.matched(words, licenses._tokens(t)) == (len(words) - 6, 3, len(words) - 3)


def test_background_is_drawn_from_whole_texts(spark):
    docs = spark.createDataFrame([(i, "\n".join(f"text{i} line{j} " + "word " * (200 if j == 5 else 10) for j in range(6))) for i in range(3000)] + [(5000 + i, "the same text again and again") for i in range(2000)], "doc_id long, text string")
    p = licenses.Licenses(max_background=300, window=32)
    got = licenses.background_paragraphs(docs, p)
    assert 200 < len(got) < 420 and got.count("the same text again and again") <= 1 and max(len(t.split()) for t in got) <= 32
    assert len({t.split()[1] for t in got if t.startswith("text")}) > 4  # any line, not the first
    assert any(t.startswith("word") for t in got)  # any place of a long line
    assert got == licenses.background_paragraphs(docs.repartition(7), p)
