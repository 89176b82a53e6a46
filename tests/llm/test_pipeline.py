"""The whole pipeline against plain Python, and what each stage must leave alone."""

from __future__ import annotations

import re
import zlib

import numpy as np
import public_tokenizers
from tests.llm.test_ngram_join import brute
from tests.llm.test_quality import brute as figures
from tokenizers import Tokenizer

import corpus_pipeline
from loyaltylens.llm.ngram_join import Similarity
from loyaltylens.llm.quality import RULES, Text

LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def prose(seed, words=90):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abdeilmnorst"), rng.integers(3, 8))) for _ in range(words))


ROWS = [
    (0, prose(1)), (1, prose(1).upper().lower()), (2, prose(1) + " tail"), (3, prose(2) + " write to jo.x@mail.example.com ok"),
    (4, prose(3).title()), (5, prose(3)), (6, "too short"), (7, "the " * 100), (8, None), (9, prose(4, 1500)), (10, prose(5) + " | # $" * 40),
    *((20 + i, prose(6) + f" n{i}a") for i in range(12)), (40, prose(7)), (40, prose(7)),
]


def expected(rows):
    rows = [(i, t or "") for i, t in rows]
    rows = [(i, t) for i, t in rows if not any(r.rejects(Text(t.encode())) for r in RULES)]
    best = {}
    for i, t in rows:
        best[t.lower()] = max((i, t), best.get(t.lower(), (i, t)))
    rows = sorted(best.values())
    rows = [r for n, (r, (_, first)) in enumerate(zip(rows, brute([t for _, t in rows], Similarity(5, 80, 100)))) if n == first]
    return {i: MAIL.sub("<EMAIL>", t) for i, t in rows}


def test_pipeline_matches_brute_force(spark, docs, tmp_path):
    docs(ROWS).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = {}
    for i, text in expected(ROWS).items():
        ids = np.array([*LIBRARY.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        want[i] = ids
    assert {r.doc_id for r in got} == set(want) == {1, 3, 5, 9, 20, 40}
    parts, used = {}, {}
    for r in got:
        assert zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(want[r.doc_id])
        parts[r.doc_id] = parts.get(r.doc_id, 0) + r.length
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert parts == {i: len(x) for i, x in want.items()}
    assert all(sum(n for _, n in p) <= 2048 for p in used.values())


def test_stages_return_the_columns_of_documents(spark, docs):
    frame = docs(ROWS)
    assert figures(ROWS[6][1])["n_words"] == 2
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, "")
        assert out.dtypes == frame.dtypes, name
