"""Personal data against plain Python, and identifiers that only their context gives away."""

from __future__ import annotations

import hashlib
import re

from tests.llm.conftest import by_id

from loyaltylens.llm.pii import Bootstrap, find_pii, pii_report, redact

KINDS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, digits[::-1]))) % 10 == 0


def ok(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


TEXTS = [
    "", None, "x", "mail a.b+c@d-e.co.uk, or x@y", "a@b.c_x@y.z q@w.e@r.t", "@@a@b.c", "1.2.3.4.5.6.7.8 256.1.1.1 00255.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 5500000000000004", "+1 (389) 555-5010 Les", "+1 2 +44 20 7946 0958. +5", "é😀 a@b.c",
    "1 2" * 6000, "a" * 100_000 + " a@b.c", "9" * 60_000, "a@" * 30_000, "1." * 30_000 + "1", "+1" + "(" * 50_000, "4111\n1111 1111 1111 1111",
    "a@b.c 1.1.1.1",
]


def test_base_kinds_match_brute_force(docs):
    got = by_id(pii_report(docs(TEXTS)))
    for i, text in enumerate(TEXTS):
        spans = {k: [m.span() for m in p.finditer(text or "") if ok(k, m[0])] for k, p in KINDS.items()}
        assert {k: got[i][f"n_{k}"] for k in spans} == {k: len(v) for k, v in spans.items()}, (text or "")[:80]
        joined = ",".join(f"{k}:{a}:{b}" for k, v in spans.items() for a, b in v)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert got[i]["spans"].startswith(joined)


def test_contexts_discover_identifiers_and_leave_numbers_alone(docs):
    rows = [f"please write to user{i}@mail.example.com now" for i in range(6)]
    rows += [f"reach contact: +1 389 555-50{i}0 today" for i in range(6)]
    rows += ["reach contact: 0389-5550-77 today", "the year 2024 went to 1234567 people"]
    # "contact:" mostly stands before phones; "to" stands before mails, but also before other words.
    rows += ["to be or not to be, that is to say to ask to go to it to"] * 3
    got = by_id(find_pii(docs(rows), settings=Bootstrap(min_seeds=5)))
    added = {i: [(s["kind"], s["start"], s["end"]) for s in r["found"] if s["kind"] == "context"] for i, r in got.items()}
    assert added.pop(12) == [("context", 15, 27)]
    assert not any(added.values())


def test_contexts_of_several_words_find_whole_runs(docs):
    seeds = [f"{{}} +1 389 555-50{i}0 {{}}" for i in range(6)]
    rows = [s.format("you may call me at", "") for s in seeds] + [s.format("a", "is the number of mine") for s in seeds]
    rows += ["look at it", "a cat is here", "number of mine", "meet at two"] * 9
    hidden = ["call me at 0389 5550 77, please", "call me at (030) 1234567.", "so 078 05 1120 is the number", "call me at 4111 1111 1111 1112",
              "call me at 12345 10.0.0.1", "at 2024 12 31 it was"]
    got = by_id(find_pii(docs(rows + hidden)))
    texts = [h[s["start"] : s["end"]] if s["kind"] == "context" else None for i, h in enumerate(hidden) for s in got[len(rows) + i]["found"]]
    assert texts == ["0389 5550 77", "030) 1234567", "078 05 1120", "4111 1111 1111 1112", None, "12345"]
    assert not any(s["kind"] == "context" for i in range(len(rows)) for s in got[i]["found"])


def test_rounds_go_on_until_no_cue_is_added(docs):
    # Half of what follows each cue is known from the cue before it, so every round adds one cue.
    rows = [f"zero: +1 389 555-50{i}0" for i in range(6)]
    for n, cue in enumerate(("zero:", "one:", "two:", "three:", "four:")):
        rows += [f"{cue} {n - 1 + 50}000{i}" for i in range(6) if n] + [f"{cue} {n + 50}000{i}" for i in range(6)]
    got = by_id(find_pii(docs(rows)))
    assert all(len(r["found"]) == 1 for r in got.values())


def test_redaction_keeps_columns_and_clean_rows(docs):
    frame = docs([(1, "a@b.c and 1.2.3.4!"), (1, "a@b.c and 1.2.3.4!"), (2, "clean"), (None, "x +1 389 555-5010"), (3, None)])
    out = redact(frame)
    assert out.columns == frame.columns and out.schema == frame.schema
    got = sorted((r.doc_id or 0, r.text, r.n_chars, r.kept) for r in out.collect())
    assert got[:1] == [(0, "x <PHONE>", 9, "x")]
    assert got[1:3] == [(1, "<EMAIL> and <IP>!", 17, "x")] * 2
    assert got[3:] == [(2, "clean", 5, "x"), (3, None, 0, "x")]


def test_no_rows(docs):
    assert pii_report(docs([])).count() == 0 and redact(docs([])).count() == 0
