"""Both ways to merge, and the queries on top of them, against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import by_id
from tokenizers import Tokenizer

from loyaltylens.llm import bpe
from loyaltylens.llm.bpe import (
    PieceCounts, PieceIds, PieceTable, RankArrays, WordVocabulary, merge_long, merge_short,
)
from loyaltylens.llm.bpe_codec import codec_digests, decode, encode
from loyaltylens.llm.token_counts import over_limit, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
VOCABULARY = WordVocabulary(PATH)
TEXTS = [
    "", None, " ", "the cat", "It's THE end.\n\n\tok", "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>", "x\x1cy \x1f z",
    "ΑΣ ΟΔΟΣ İstanbul ﬁne é ́x", "日本語 テキスト 12345", "a" * 3000, "ab" * 1500 + "!" * 999, "  q　",
    "we'll i'd they're 's", "\U0001f600\U0001f601 ok", "z" * 40_000 + " end",
]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=30) | st.text("aAé İß´²½\x1c\x85\xa0'stİſK", max_size=20), max_size=8))
def test_all_ways_agree_with_the_library(texts):
    for text in [*texts, "".join(texts)]:
        pieces = VOCABULARY.pieces(text)
        COUNTS.learn(pieces)
        assert [i for p in pieces for i in IDS[p]] == ids_of(text)
        assert sum(map(COUNTS.__getitem__, pieces)) == len(ids_of(text))


def test_every_character_of_the_plain_range_is_cut_as_by_the_library():
    for c in map(chr, range(0x250)):
        for text in (c, f"a{c}b", f"!{c}?", f"1{c}2", f" {c} ", f"{c}{c}", f"'{c}s"):
            assert [i for p in VOCABULARY.pieces(text) for i in IDS[p]] == ids_of(text), (hex(ord(c)), text)


IDS, COUNTS = PieceIds(PATH), PieceCounts(PATH)


def test_short_long_and_array_merges_agree_on_random_symbols():
    rng = random.Random(3)
    pool = [VOCABULARY.ids[c] for c in "aehinorst"] + [VOCABULARY.ids["e</w>"]]
    pieces = [[rng.choice(pool[:n]) for _ in range(rng.randrange(1, 60))] for n in (1, 2, 3, 5, 10) for _ in range(60)]
    arrays = RankArrays(VOCABULARY)
    for arrays.one_at_a_time in (False, True):
        flat = np.array([s for p in pieces for s in p])
        symbols, owner = arrays.merge(flat, np.repeat(np.arange(len(pieces)), list(map(len, pieces))))
        for n, piece in enumerate(pieces):
            want = merge_long(piece, VOCABULARY)
            assert merge_short(piece, VOCABULARY) == want
            assert symbols[owner == n].tolist() == want


@pytest.mark.parametrize("held,held_ids", [(250_000, 4_000_000), (8, 4_000_000), (2, 40), (250_000, 3)])
def test_table_agrees_with_the_library_whatever_it_holds(monkeypatch, held, held_ids):
    monkeypatch.setattr(bpe, "TABLE_PIECES", held)
    monkeypatch.setattr(bpe, "TABLE_IDS", held_ids)
    table = PieceTable(PATH, 1)
    texts = [t or "" for t in TEXTS]
    for batch in [texts, [], [""], *([t] for t in texts), texts[::-1], texts + texts]:
        ids, lengths = table.encoded(batch)
        assert [a.tolist() for a in np.split(ids, np.cumsum(lengths))[:-1]] == [[*ids_of(t), 1] for t in batch]
        assert max(map(len, table)) <= bpe.LONG_PIECE and len(table) <= held + len(VOCABULARY.special)


def test_table_looks_up_each_piece_once_and_merges_common_ones_once(monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_PIECES", 100)
    learnt, looked_up = [], []

    class Watched(PieceTable):
        def __missing__(self, piece):
            learnt.append(piece)
            return super().__missing__(piece)

        def __getitem__(self, piece):
            looked_up.append(piece)
            return super().__getitem__(piece)

    table = Watched(PATH, 1)
    for n in range(30):
        common, rare = ["the", "of", "cats"] * 5, [f"rare{a}{b}" for a in "abcdefgh" for b in "ijklm"[: 1 + n % 5]]
        rare = [f"{w}{chr(97 + n % 26)}q" for w in rare]
        table.encoded([" ".join(common + rare)])
        assert len(looked_up) == len(common + rare)
        looked_up.clear()
    assert len(learnt) > 400
    assert [learnt.count(w) for w in ("the", "of", "cats")] == [1, 1, 1]


def test_counts_query(docs):
    got = by_id(over_limit(token_counts(docs(TEXTS), PATH)))
    for i, text in enumerate(TEXTS):
        n = len(ids_of(text))
        assert got[i] == {"doc_id": i, "n_bytes": len((text or "").encode()), "n_tokens": n, "over_limit": n > 2048}


def test_codec_query(docs):
    frame = docs(TEXTS)
    got, coded = by_id(codec_digests(frame, PATH)), encode(frame, PATH)
    ids, back = by_id(coded), by_id(decode(coded, PATH))
    for i, text in enumerate(TEXTS):
        want = ids_of(text)
        text_back = LIBRARY.decode(want, skip_special_tokens=False)
        assert ids[i]["ids"] == want and back[i]["decoded"] == text_back
        assert got[i]["n_tokens"] == len(want)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text_back.encode()).hexdigest()


@pytest.mark.parametrize("run", [token_counts, codec_digests, encode])
def test_repeated_rows_missing_ids_and_no_rows(docs, run):
    assert sorted((r.doc_id or 0) for r in run(docs([(1, "a"), (1, "a"), (None, None)]), PATH).collect()) == [0, 1, 1]
    assert run(docs([]), PATH).count() == 0
