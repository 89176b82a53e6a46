"""Quality figures against plain Python; the cascade decides the same in any order."""

from __future__ import annotations

import re
from collections import Counter

from tests.llm.conftest import by_id

from loyaltylens.llm.quality import RULES, VERDICT, Text, passing, quality, rule_order

CLEAN = " ".join(f"word{i}a text{i * 7 % 31}b" for i in range(60))
TEXTS = [
    "", None, "a b c", CLEAN, "The " * 80, CLEAN.upper(), CLEAN + " ###" * 20, "x | " * 60, CLEAN + "\nsame line\nsame line\n \n\n same line",
    "a b c d a b c e " + CLEAN, CLEAN.replace(" ", " "), "é\tß\r\nq\x0bz\x0cy \x1c " + CLEAN, "l1 x\n" * 400, "w" * 100_000, CLEAN + " 1 2 3 4" * 20,
]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeat = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": sum(line in lines[:i] for i, line in enumerate(lines)), "n_repeat_words": len(repeat),
    }


def test_figures_and_verdict(docs):
    got = by_id(quality(docs(TEXTS)))
    for i, text in enumerate(TEXTS):
        want = brute(text)
        assert {k: got[i][k] for k in want} == want, (text or "")[:60]
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert got[i]["base_failed"] == failed
        rejected = [r.name for r in VERDICT if r.rejects(Text((text or "").encode()))]
        assert got[i]["kept"] == (not failed and not rejected)
    assert [i for i in got if got[i]["kept"]] == [3, 8, 9, 11]


def test_passing_keeps_rows_and_columns(docs):
    frame = docs([*((i, t) for i, t in enumerate(TEXTS)), (3, CLEAN), (None, CLEAN)])
    out = passing(frame)
    assert out.schema == frame.schema
    assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 3, 3, 8, 9, 11]
    assert passing(docs([])).count() == 0 and quality(docs([])).count() == 0


def test_order_puts_cheap_rejections_first(docs):
    rows = docs(["tiny"] * 30 + [CLEAN] * 5).select("doc_id", "text")
    order = rule_order(rows, RULES)
    assert sorted(order) == list(range(len(RULES))) and order[0] == 0
