import math
from collections import Counter

import pytest
from fixtures import corpus, frame, lowered, words

from tripdeck.llm import lm_scoring as lm


def brute(rows, order, alpha, least):
    split = [(i, words(lowered(t))) for i, t in rows]
    count = Counter(tuple(w[k:k + n]) for _, w in split for n in range(1, order + 1)
                    for k in range(len(w) - n + 1))
    total = sum(len(w) for _, w in split)
    out = []
    for i, w in split:
        score, fell = 0.0, 0
        for k in range(len(w)):
            n = longest = min(order, k + 1)
            while n > 1 and count[tuple(w[k - n + 1:k + 1])] < least:
                score += math.log(alpha)
                n -= 1
            base = count[tuple(w[k - n + 1:k])] if n > 1 else total
            score += math.log(count[tuple(w[k - n + 1:k + 1])] / base)
            fell += n < longest
        out.append((i, len(w), round(score, 6), fell))
    return sorted(out)


@pytest.mark.parametrize("order,least,block", [(2, 2, 8 << 20), (3, 2, 500), (4, 1, 2000)])
def test_matches_brute_force(spark, monkeypatch, order, least, block):
    monkeypatch.setattr(lm, "BLOCK_BYTES", block)
    monkeypatch.setattr(lm, "PARTITION_BYTES", 20_000)
    rows = corpus(6, 30)
    out = lm.stupid_backoff(frame(spark, rows), order, 0.4, least).collect()
    got = sorted((r.doc_id, r.n_words, round(r.log_score, 6), r.n_backoff) for r in out)
    exp = brute(rows, order, 0.4, least)
    assert [g[:2] + g[3:] for g in got] == [e[:2] + e[3:] for e in exp]
    assert all(abs(g[2] - e[2]) < 1e-5 for g, e in zip(got, exp, strict=True))


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "a b"), (1, "a b"), (2, None), (None, "c")]
    out = lm.stupid_backoff(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_backoff) for r in out) == [
        (1, 2, 0), (1, 2, 0), (2, 0, 0)]
    assert lm.stupid_backoff(frame(spark, [])).collect() == []
