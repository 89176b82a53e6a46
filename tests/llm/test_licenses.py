"""License scan against a longest common subsequence over every place of a text."""

from __future__ import annotations

import re
import time
from collections import Counter

import numpy as np

from loyaltylens.llm.hashing import windows
from loyaltylens.llm.license_texts import ABSENT, DECIDING, TEMPLATES
from loyaltylens.llm.licenses import TemplateIndex, chain, find_licenses, winnowed

MIT = " ".join(TEMPLATES["mit-text"].split())
PAD = "Some other prose stands here, éé word. " * 5


def rows(df):
    return sorted((r.doc_id or 0, r.license, r.matched_words, round(r.coverage, 3), r.start, r.end) for r in df.collect())


def test_exact_and_edited_statements(docs):
    edited = MIT.replace("free of charge", "completely free of any charge").replace("publish, ", "")
    found = rows(find_licenses(docs([
        "", None, PAD, PAD + "Released under the MIT License.\n" + PAD, "ALL RIGHTS RESERVED. x All rights, reserved",
        PAD + edited, MIT[: len(MIT) // 3], "rights all reserved", PAD * 2000 + "Licensed under CC BY-NC 4.0.",
    ])))
    at = len(PAD)
    words = len(re.findall("[a-z0-9]+", MIT.lower()))
    assert found == [
        (3, "mit", 5, 1.0, at, at + 30), (4, "all-rights-reserved", 3, 1.0, 0, 19),
        (4, "all-rights-reserved", 3, 1.0, 23, 43), (5, "mit-text", words - 1, round((words - 1) / words, 3), at, at + len(edited) - 1),
        (8, "cc-by-nc-4.0", 7, 1.0, at * 2000, at * 2000 + 27),
    ]


def test_the_words_that_name_the_license_decide(docs):
    gpl = "This work is licensed under the GNU {}General Public License, version 3."
    wrong = [
        "Released under the BSD License.", "Released under the Apache License", "it was released under the old license",
        gpl.format("Lesser "), gpl.format("Affero "), "Licensed under CC BY-ND 4.0.", "Licensed under CC BY-NC-ND 4.0.",
        "Licensed under the Apache License, Version 1.1.", "all of the rights are reserved",
    ]
    right = ["Released under the same MIT License", gpl.format(""), "Licensed under CC BY 4.0", "under the MIT License"]
    got = rows(find_licenses(docs(wrong + right)))
    named = [(i, n) for i, n, *_ in got]
    own = {"mit", "gpl-3.0", "cc-by-4.0", "apache-2.0", "all-rights-reserved", "cc-by-nc-4.0", "cc-by-sa-4.0"}
    assert not [x for x in named if x[0] < len(wrong) and x[1] in own]
    assert {x for x in named if x[0] >= len(wrong)} == {(9, "mit"), (10, "gpl-3.0"), (11, "cc-by-4.0"), (12, "mit")}
    alone = find_licenses(docs(["use of the red license", "use of the blue license"]), templates={"red": "Use of the red license"})
    assert [(x[0], x[1]) for x in rows(alone)] == [(0, "red")]


def test_texts_notices_and_identifiers_of_common_licenses(docs):
    holder = TEMPLATES["bsd-3-clause-text"].replace("copyright holder nor", "University nor")
    lines = {
        "SPDX-License-Identifier: MIT": {"mit-spdx"}, "// SPDX-License-Identifier: MIT-0": {"mit-0-spdx"},
        "BSD 3-Clause License": {"bsd-3-clause-name"}, "Licensed under CC BY-NC-SA 4.0.": {"cc-by-nc-sa-4.0"},
        "Licensed under CC BY-ND 4.0.": {"cc-by-nd-4.0"}, "Licensed under CC BY-NC-ND 4.0.": {"cc-by-nc-nd-4.0"},
        "This work is licensed under the GNU Affero General Public License, version 3.": {"agpl-3.0"},
        "This work is licensed under the GNU Lesser General Public License, version 2.1.": {"lgpl-2.1"},
        "Released under the terms of the MIT License": {"mit-terms"}, PAD + holder + PAD: {"bsd-3-clause-text"},
        TEMPLATES["agpl-3.0-notice"]: {"agpl-3.0-notice"}, TEMPLATES["gpl-2.0-notice"]: {"gpl-2.0-notice"},
        PAD + TEMPLATES["gpl-3.0-text"] + PAD: {"gpl-3.0-text"}, PAD + TEMPLATES["apache-2.0-text"]: {"apache-2.0-text"},
        TEMPLATES["lgpl-2.1-text"]: {"lgpl-2.1-text"}, TEMPLATES["epl-2.0-notice"]: {"epl-2.0-notice"},
    }
    got = [set() for _ in lines]
    for i, name, *_ in rows(find_licenses(docs(list(lines)))):
        got[i].add(name)
    assert dict(zip(lines, got)) == lines


def inserted(text, *places, words=45):
    """The text with other words in so many places, each a share of its length."""
    found = text.split()
    for place in sorted(places, reverse=True):
        at = int(len(found) * place)
        found[at:at] = [f"{kind}{n}" for n in range(words // 3) for kind in ("the", "of", "other ")]
    return " ".join(found)


def test_insertions_do_not_hide_a_whole_text(docs):
    edited = [
        inserted(TEMPLATES["mit-full-text"], 0.5, words=40), inserted(TEMPLATES["gpl-3.0-text"], 0.4, words=100),
        PAD + inserted(TEMPLATES["apache-2.0-text"], 0.3, 0.7) + PAD, inserted(TEMPLATES["mit-full-text"], 0.2, 0.3, 0.8, words=30),
        (TEMPLATES["mit-full-text"] + " " + inserted(TEMPLATES["mit-full-text"], 0.5, words=40) + " ") * 3,
    ]
    got = [Counter() for _ in edited]
    for i, name, words, *_ in rows(find_licenses(docs(edited))):
        got[i][name, words] += 1
    whole = {n: len(re.findall("[a-z0-9]+", TEMPLATES[n].lower())) for n in ("mit-full-text", "gpl-3.0-text", "apache-2.0-text")}
    for i, name in enumerate(["mit-full-text", "gpl-3.0-text", "apache-2.0-text", "mit-full-text", "mit-full-text"]):
        assert got[i] == {(name, whole[name]): 6 if i == 4 else 1}


def test_repeats_of_a_phrase_are_all_found_and_cost_in_proportion(docs):
    seconds = []
    for n in (2_000, 20_000):
        index = TemplateIndex(TEMPLATES, 0.7, DECIDING, ABSENT)
        coded = index.code(b"released under the mit license in terms of the gnu general public license ".split() * n)
        start = time.perf_counter()
        found = [m for m in index.matches(coded) if m.license == "mit"]
        seconds.append(time.perf_counter() - start)
        assert [m.first for m in found] == [13 * i for i in range(n)]
    assert seconds[1] < 40 * seconds[0]


def test_short_names(docs):
    lines = ["Licensed under the Apache License 2.0", "License: MIT", "it is GPLv3.", "the license", "MIT"]
    assert [(i, n) for i, n, *_ in rows(find_licenses(docs(lines)))] == [(0, "apache-2.0-name"), (1, "mit-name"), (2, "gpl-3.0-name")]


def test_chain_rises_and_is_longest():
    rng = np.random.default_rng(3)
    for _ in range(100):
        places, at = np.sort(rng.integers(0, 12, 14)), rng.integers(0, 12, 14)
        got = chain(places, at)
        assert all(p < q and a < b for (p, a), (q, b) in zip(got, got[1:])) and set(got) <= set(zip(places.tolist(), at.tolist()))
        best = {}
        for p, a in sorted(set(zip(places.tolist(), at.tolist()))):
            best[p, a] = 1 + max((n for (q, b), n in best.items() if q < p and b < a), default=0)
        assert len(got) == max(best.values())


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


def test_every_template_is_found_alone_and_coverage_is_the_common_subsequence(docs):
    names = sorted(TEMPLATES)
    cut = [" ".join(TEMPLATES[n].split()[1:]) if len(TEMPLATES[n].split()) > 6 else TEMPLATES[n] for n in names]
    got = {(i, n): m for i, n, m, *_ in rows(find_licenses(docs(cut)))}
    for i, name in enumerate(names):
        words = [re.findall("[a-z0-9]+", t.lower()) for t in (TEMPLATES[name], cut[i])]
        assert got[i, name] == lcs(*words), name


def test_repeated_rows_missing_ids_no_rows(docs):
    line = TEMPLATES["mit"]
    assert [r[0] for r in rows(find_licenses(docs([(1, line), (1, line), (None, line)])))] == [0, 1, 1]
    assert find_licenses(docs([])).count() == 0


def test_shared_runs_share_a_kept_fingerprint():
    rng = np.random.default_rng(1)
    for _ in range(200):
        shared = rng.integers(0, 50, 6).astype(np.uint64)
        a, b = (np.r_[rng.integers(0, 50, 9).astype(np.uint64), shared, rng.integers(0, 50, 9).astype(np.uint64)] for _ in "ab")
        kept = [{int(g[p]) for g in [windows(x, 3)] for p in winnowed(g)} for x in (a, b)]
        assert kept[0] & kept[1] & {int(g) for g in windows(shared, 3)}
