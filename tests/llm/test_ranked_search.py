import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import ROWS, docs, rows

from loadpanel.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def expected(table, items, k):
    """The contract in plain Python: every item against every document."""
    found = [(d, Counter(own), len(own)) for d, own in ((d, terms(t)) for d, t in table) if own]
    n_docs, total = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        asked, scores = Counter(terms(text)), []
        for d, c, n in found:
            m = 100 - 25 + (25 * n * n_docs) // total
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, times in asked.items()
                if c[t]
            )
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, i, d, -s) for i, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


def made(n=400, seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]

    def text(most):
        return " ".join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(words, weights, k=rng.randint(0, most)))

    table = [(i // 2, text(40)) for i in range(n)] + [(None, "w1 w2 w40"), (7, "w1 w2 w40"), (3, None)]
    # More than 64 terms take masks of several words; "nowhere" is in no document.
    items = [(1, text(8)), (2, " ".join(words + words[:9] + [f"x{i}" for i in range(30)])), (3, "nowhere"), (4, None), (4, "w1 w2 w40"), (None, "w59 w59 w3")]
    return table, items


@pytest.mark.parametrize("tight", [False, True])
def test_equals_plain_python(spark, monkeypatch, tight):
    if tight:
        for name, value in (("ROUND_BYTES", 500), ("BLOCK_DOCS", 30), ("BLOCK_COUNTS", 200), ("FIRST_SCORED", 3)):
            monkeypatch.setattr(rs, name, value)
    table, items = made()
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in table], "doc_id long, text string, score int, item string").repartition(3)
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    got = rs.search(frame, asked, k=7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(got) == expected(table, items, 7)


def test_few_masks_are_scored():
    """Documents with a rare term come first; those whose bound is too low are never scored."""
    n = 20_000
    rng = np.random.default_rng(1)
    common = np.arange(n)
    rare = np.sort(rng.choice(n, 60, replace=False))
    doc = np.concatenate([common, rare])
    order = np.argsort(doc, kind="stable")
    ids = np.concatenate([np.zeros(n, np.int64), np.ones(60, np.int64)])[order]
    lengths = np.bincount(doc, minlength=n)
    block = rs._Block(common, np.zeros(n, bool), np.full(n, 10), lengths, ids, np.ones(n + 60, np.int64), n, 10 * n, 2)
    best = rs._Best(20)
    done = block.search(np.array([0, 1]), np.array([3, 5000]), best)
    assert done < 1000 and set(best.doc) <= set(rare.tolist()) and best.doc.tolist() == sorted(rare.tolist())[:20]


def test_awkward_rows_and_no_rows(spark):
    items = [(1, "The quick brown fox"), (2, None), (3, "one two"), (4, "漢字 😀 café")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert rows(rs.search(docs(spark), asked)) == expected([(d, t) for d, t, *_ in ROWS], items, 20)
    assert rows(rs.search(docs(spark, []), asked)) == []
    assert rows(rs.search(docs(spark), asked.limit(0))) == []
