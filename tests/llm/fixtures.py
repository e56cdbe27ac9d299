"""Small document tables for the operators' tests."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans int, score int"


def frame(spark, rows):
    """Documents from (doc_id, text), with columns whose names clash with operators' own."""
    data = [(i, t, "en", "s", None if t is None else len(t), 7, None) for i, t in rows]
    return spark.createDataFrame(data, SCHEMA)


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def corpus(seed=0, size=60):
    """Random texts with nulls, empty and long ones, copies, near copies and shared passages."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5)))
                  for _ in range(150)]

    def make(n):
        return [rng.choice(vocabulary) for _ in range(n)]
    passage = make(45)
    texts = [None, "", " \n\t ", "one", "one two three", "x " * 90]
    base = make(120)
    for k in range(size):
        own = make(rng.randint(1, 150))
        kind = k % 6
        if kind == 0:
            own[len(own) // 2:len(own) // 2] = passage
        elif kind in (1, 2):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
        texts.append(rng.choice([" ", "\n", "  "]).join(own))
    texts += texts[6:9] + [" ".join(make(4000))]
    rows = [(k * 7 % 1009, t) for k, t in enumerate(texts)]
    return rows
