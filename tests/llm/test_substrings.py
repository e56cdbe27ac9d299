import random
from collections import Counter

import pytest
from fixtures import corpus, frame, words
from pyspark.sql import functions as F

from tripdeck.llm.substrings import anchors, crowded_contexts, remove_repeats
from tripdeck.llm.text import compact


def removed(rows, window):
    split = [(i, words(t)) for i, t in rows]
    seen = Counter(tuple(w[k:k + window]) for _, w in split for k in range(len(w) - window + 1))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True)
                                                   if not g)))
    return sorted(out)


@pytest.mark.parametrize("window,gram,group_rows", [(35, 8, 4096), (35, 8, 3), (12, 4, 5), (5, 5, 9)])
def test_matches_brute_force(spark, window, gram, group_rows):
    rows = corpus(4, 60)
    out = remove_repeats(frame(spark, rows), window, gram, group_rows).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.text) for r in out) \
        == removed(rows, window)


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = " ".join(map(str, range(40)))
    out = remove_repeats(frame(spark, [(1, text), (1, text), (None, text), (2, None)]), 35).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.text) for r in out) == [
        (1, 40, 40, ""), (1, 40, 40, ""), (2, 0, 0, "")]
    assert remove_repeats(frame(spark, []), 35).collect() == []
    with pytest.raises(ValueError):
        remove_repeats(frame(spark, []), 5, 6)


@pytest.mark.parametrize("group_rows", [4096, 2])
def test_rows_of_one_id_with_other_texts_are_documents_of_their_own(spark, group_rows):
    rng = random.Random(9)
    for _ in range(3):
        make = lambda n: [rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(n)]
        short, long = make(20), make(45)
        rows = [(1, " ".join(make(20) + short + make(20))),
                (1, " ".join(make(25) + short + make(15))),
                (2, " ".join(make(9) + long + make(30))), (2, " ".join(make(31) + long)),
                (3, " ".join(long)), (3, " ".join(long)), (3, None)]
        out = remove_repeats(frame(spark, rows), 35, 8, group_rows).collect()
        assert sorted((r.doc_id, r.n_words, r.n_removed, r.text) for r in out) \
            == removed(rows, 35)


def test_places_of_a_crowded_passage_are_one_row_a_document(spark):
    passage = " ".join(f"p{k}" for k in range(400))
    rows = [(i, f"{passage} " + " ".join(f"w{i}x{k}" for k in range(60))) for i in range(50)]
    docs = frame(spark, rows).select(F.col("doc_id").alias("doc"), "text")
    lists = anchors(docs, 35, 8).groupBy("doc").agg(F.collect_list("pos").alias("pos"))
    places = {(r.doc, p) for r in lists.collect() for p in r.pos}
    out = crowded_contexts(compact(docs, ["doc"]).join(lists, "doc").coalesce(1), 35, 8).collect()
    marked = [r for r in out if r["at"] is not None]
    alone = [r for r in out if r["at"] is None]
    assert sorted(r.doc for r in marked) == list(range(50))
    assert sum(len(r["at"]) for r in marked) > 20 * 50
    # every place is in one row: marked there, or the only one of its context
    got = [(r.doc, a.pos) for r in marked for a in r["at"]]
    got += [(r.doc, r.pos) for r in alone if r.n == 1]
    assert len(got) == len(set(got)) and set(got) <= places
    assert sum(r.n for r in alone) == len(got)
    assert all((r.doc is None) == (r.n > 1) for r in alone)
