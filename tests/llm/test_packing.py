import os
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from fixtures import corpus, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from tripdeck.llm import packing as pk

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, "I'll don't 'S x's <|endoftext|> a<|b", "<|ENDOFTEXT|> <|endoftext|>x",
       "é́ é,a,́ «l'été»… —,— 1st 3́ ½ ①", "日本語、123 abc", "a" * 3000,
       "%%%&&& it''s' 'm'll \x00\x01 \x7f\x85 x​y", "ΑΣ İstanbul ǅ ß ẞ", "'́s",
       "\n\t\x0b \x1c a\x1cb  x", "+1 (555) 123-4567 a@b.co ... end.\n"]


@pytest.fixture(scope="module")
def tokenizer():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def test_pieces_and_packing(spark, tokenizer):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(100 + i, t) for i, t in corpus(3, 20)]
    docs = frame(spark, rows + [(None, "gone")])
    out = pk.pack_documents(docs, PATH, 64, 1, with_ids=True).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        assert r.length == len(r.ids) <= 64
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4"))
    for i, t in rows:
        exp = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [x for r in own for x in r.ids] == exp
        assert [r.start for r in own] == list(range(0, len(exp), 64))
    assert set(pieces) == {i for i, _ in rows}
    for rs in sequences.values():
        end = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 64


def test_repeated_rows_and_empty_table(spark):
    out = pk.pack_documents(frame(spark, [(1, "a b"), (1, "a b"), (2, None)]), PATH).collect()
    assert sorted((r.doc_id, r.length) for r in out) == [(1, 3), (1, 3), (2, 1)]
    assert len({(r.sequence_id, r.offset) for r in out}) == 3
    assert pk.pack_documents(frame(spark, []), PATH).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 60).flatmap(lambda m: st.tuples(
    st.just(m), st.dictionaries(st.integers(1, m), st.integers(1, 40), max_size=12))))
def test_plan_is_best_fit_decreasing(case):
    size, histogram = case
    filled = defaultdict(list)
    done = defaultdict(int)
    for length, lo, hi, first, per, offset in pk.packing_plan(histogram, size):
        assert lo == done[length] < hi
        done[length] = hi
        for k in range(hi - lo):
            filled[first + k // per].append((offset + k % per * length, length))
    assert dict(done) == histogram
    for items in filled.values():
        end = 0
        for at, length in sorted(items):
            assert at == end
            end += length
        assert end <= size
    left = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [c for c in left if c >= length]
            if fits:
                left.remove(min(fits))
            left.append((min(fits) if fits else size) - length)
    assert sorted(left) == sorted(size - sum(n for _, n in v) for v in filled.values())
