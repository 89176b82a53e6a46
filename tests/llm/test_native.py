"""Secrets, exact copies and personal data against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from tests.llm.conftest import by_id

from loyaltylens.llm.exact_dedup import exact_dedup
from loyaltylens.llm.secrets import BASE, FORMATS, secrets_report, trigram_query

TEXTS = [
    "", None, "a", "password=hunter22 x", "PassWd : 'abc' token=\"a1b2c3d4\"", "token=secret:abcdefgh", "secret: token: abcdefgh",
    "é AKIA" + "A1" * 8 + " z", "AKIA" + "B" * 15, "x" + "0123456789abcdef" * 2, "deadbeef" * 2 + "deadbee", "deadbeef" * 3,
    " api_key=abc123  apikey:=abcdef api__key=abcdef", "tokentoken = abcdefg", "\U0001f600 secret=\"x/y+z==\"",
    "ghp_" + "aB3" * 12 + " xoxb-1234567890-abc", "a\nb" * 3000 + " token:abcdef", "f" * 100_000, "secret=" + "=" * 50_000,
]
KINDS = {
    "assign": re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def brute_secrets(text):
    text = text or ""
    spans = {"assign": [m.span() for m in KINDS["assign"].finditer(text) if len(m[2]) >= 6]}
    spans["access"] = [m.span() for m in KINDS["access"].finditer(text) if len(m[0]) >= 20]
    spans["hex"] = [m.span() for m in KINDS["hex"].finditer(text) if len(m[0]) >= 24]
    order = sorted((a, rank, f"{k}:{a}:{b}") for rank, k in enumerate(spans) for a, b in spans[k])
    return {k: len(v) for k, v in spans.items()}, hashlib.sha256(",".join(x[2] for x in order).encode()).hexdigest()


def test_secrets_match_brute_force(docs):
    got = by_id(secrets_report(docs(TEXTS)))
    for i, text in enumerate(TEXTS):
        counts, digest = brute_secrets(text)
        assert {k: got[i][f"n_{k}"] for k in counts} == counts, text
        assert got[i]["base_sha256"] == digest, text
    assert got[15]["spans"] == "github:0:40,slack:41:60"


def test_secrets_of_repeated_rows_missing_ids_and_no_rows(docs):
    rows = [(1, "token=abcdef"), (1, "token=abcdef"), (None, "token=abcdefg"), (None, "x"), (1, "none")]
    got = sorted((r.doc_id or 0, r.n_assign, r.spans) for r in secrets_report(docs(rows)).collect())
    assert got == [(0, 0, ""), (0, 1, "assign:0:13"), (1, 0, ""), (1, 1, "assign:0:12"), (1, 1, "assign:0:12")]
    assert secrets_report(docs([])).count() == 0


def test_trigram_queries():
    assert trigram_query("[0-9a-f]++") is None
    assert trigram_query("AKIA[A-Z0-9]++") == [frozenset({"aki", "kia"})]
    assert trigram_query("ab(?:cd|ef)?g") is None or all(trigram_query("ab(?:cd|ef)?g"))
    ways = trigram_query(BASE[0].pattern)
    assert frozenset({"tok", "oke", "ken"}) in ways and frozenset({"api", "pi_", "i_k", "_ke", "key"}) in ways
    for rule in (*BASE, *FORMATS):
        assert (trigram_query(rule.pattern) is None) == (rule.kind == "hex")


LONG = "Sentence one is here. " * 3000


@pytest.mark.parametrize("rows", [
    ["a", "A", "b", None, "", "é", "É", "ß"], [(1, "x"), (1, "x"), (2, "X"), (None, "x"), (None, "q")],
    [LONG, LONG.upper(), LONG + "x", "x" + LONG, LONG[:-1]], [],
])
def test_exact_dedup_matches_brute_force(docs, rows):
    frame = docs(rows)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    pairs = [(r.doc_id, (r.text or "").translate(lower)) for r in frame.collect()]
    groups = {}
    for i, t in pairs:
        groups.setdefault(t, []).append(i)
    want = []
    for i, t in pairs:
        best = max((x for x in groups[t] if x is not None), default=None)
        want.append((i, best, len(groups[t]), i == best, hashlib.sha256(t.encode()).hexdigest()))
    got = [tuple(r) for r in exact_dedup(frame).collect()]
    assert Counter(got) == Counter(want)


def test_equal_identifiers_of_different_chunks_do_not_join_texts(docs, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(5).cast("bigint"))
    got = by_id(exact_dedup(docs(["aa", "AA", "bb", "", None])))
    assert [got[i]["keep_id"] for i in range(5)] == [1, 1, 2, 4, 4]
