import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import docs, rows

from loadpanel.llm import divergence as dv

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def expected(table, min_docs, top):
    """The contract in plain Python, on (lang, source, text)."""
    table = [(a or "", b or "", TERM.findall(lower(t or ""))) for a, b, t in table]
    df, counts = Counter(), {}
    for lang, source, terms in table:
        df.update((lang, t) for t in set(terms))
        counts.setdefault((lang, source), Counter()).update(terms)
    out = []
    for lang in {lang for lang, _ in counts}:
        kept = [t for (own, t), n in df.items() if own == lang and n >= min_docs]
        groups = {s: c for (own, s), c in counts.items() if own == lang}

        def parts(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}

        p = {s: parts(c) for s, c in groups.items()}
        q = parts(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(ranked, 1) if part == "pair" or k <= top]
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


def made(n=160, seed=2):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("Ab", "be", "ÜB", "漢") for b in ("a", "eX", "ss", "zz", "字")] + ["rare"]
    return [
        (rng.choice(("en", "de", None)), rng.choice(("a", "a", "a", "b", "ü", "", None)), " ".join(rng.choices(words, k=rng.randint(0, 12))))
        for _ in range(n)
    ] + [("solo", "one", "word"), ("few", "x", "unlike"), ("few", "y", None), ("few", "z", "12 34")]


@pytest.mark.parametrize("n", [1, 2, 3, 50, 5000])
def test_hash_is_perfect_and_minimal(n):
    terms = [f"term{i}".encode() for i in range(n)]
    seed, displacement, slot = dv.perfect_hash(terms)
    assert sorted(slot.tolist()) == list(range(n))
    hashes = dv._hashed(terms, seed)
    bucket = (dv._spread(hashes ^ dv._MIX) % np.uint64(len(displacement))).astype(np.int64)
    assert (dv._slots(hashes, displacement[bucket], n) == slot).all()


def test_unknown_terms_meet_a_stored_key_that_differs():
    stored = [f"t{i}".encode() for i in range(100)]
    seed, displacement, slot = dv.perfect_hash(stored)
    inverse = [b""] * 100
    for t, s in zip(stored, slot):
        inverse[s] = t
    shards = dv._Shards(1, [{"shard": 0, "seed": seed, "displacement": displacement, "terms": inverse}])
    dense = np.zeros(100, np.int64)
    shards.add(Counter({b"t7": 3, b"unknown": 9, b"t": 1, b"": 4}), dense)
    assert dense.sum() == 3 and dense[slot[7]] == 3


@pytest.mark.parametrize("tight", [False, True])
def test_equals_plain_python(spark, monkeypatch, tight):
    if tight:  # several shards, rounds, blocks and handed-on parts
        for name, value in (("SHARD_TERMS", 4), ("BROADCAST_BYTES", 300), ("HELD_TERMS", 5), ("HELD_SLOTS", 8), ("BLOCK_COUNTS", 1)):
            monkeypatch.setattr(dv, name, value)
    table = made()
    frame = spark.createDataFrame([(i % 7, t, a, b, "x") for i, (a, b, t) in enumerate(table)], "doc_id long, text string, lang string, source string, item string")
    got = dv.audit(frame.repartition(4), min_docs=6, top=5)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert rows(got) == expected(table, 6, 5)


def test_parts_are_exact_for_large_counts():
    rng = random.Random(1)
    for _ in range(200):
        total = rng.randint(1, 10**13)
        count = rng.randint(0, total)
        n_terms = rng.randint(1, 10**6)
        got = dv._parts(np.array([count], np.int64), total, n_terms)[0]
        assert got == 1 + 10**9 * (count + 5) // (total + 5 * n_terms)


def test_awkward_rows_and_no_rows(spark):
    from cases import ROWS

    plain = [(lang, source, text) for _, text, lang, source in ROWS]
    assert rows(dv.audit(docs(spark), min_docs=2, top=3)) == expected(plain, 2, 3)
    assert rows(dv.audit(docs(spark), min_docs=99)) == expected(plain, 99, 50)
    assert rows(dv.audit(docs(spark, []))) == []
