import random
import re
from itertools import combinations

import pytest
from cases import ROWS, docs, rows

from loadpanel.llm import ngram_join as nj
from loadpanel.llm.components import connected_components


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def expected(table, size, percent):
    """By rows, so that a doc_id may repeat."""
    sets = [shingles(t, size) for _, t, *_ in table]
    root = list(range(len(table)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(table)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    out = []
    for i, (d, *_) in enumerate(table):
        ids = [table[j][0] for j in range(len(table)) if find(j) == find(i) and table[j][0] is not None]
        out.append((d, len(sets[i]), min(ids) if ids and sets[i] else d))
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80), (1, 50)])
def test_awkward_rows(spark, size, percent):
    assert rows(nj.near_duplicates(docs(spark), size, percent)) == expected(ROWS, size, percent)


@pytest.mark.parametrize("percent", [60, 85])
def test_families_of_edited_texts_with_a_shared_passage(spark, percent):
    rng = random.Random(percent)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(15)]
    table = []
    for family in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(8, 60))] + passage
        for _ in range(rng.randint(1, 14)):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(words)
            table.append((len(table), " ".join(text[rng.randint(0, 2) :]), "en", str(family)))
    rng.shuffle(table)
    assert rows(nj.near_duplicates(docs(spark, table), 3, percent)) == expected(table, 3, percent)


def test_one_document_of_each_group_stays(spark):
    table = [(3, "a b c d e f g", "en", "x"), (5, "a b c d e f g", "en", "x"), (4, "z", "en", "x"), (6, None, "en", "x")]
    left = nj.one_row_each(docs(spark, table))
    assert rows(left, "doc_id") == [(3,), (4,), (6,)]


def test_no_rows(spark):
    assert rows(nj.near_duplicates(docs(spark, []))) == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 201: 200}
    assert found == want
