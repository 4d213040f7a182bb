import hashlib
import random

import pytest
from cases import ROWS, docs, rows

from loadpanel.llm import exact_dedup as ed


def expected(table):
    norm = lambda t: (t or "").encode().lower()
    groups = {}
    for d, t, *_ in table:
        groups.setdefault(norm(t), []).append(d)
    out = []
    for d, t, *_ in table:
        ids = groups[norm(t)]
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out.append((d, keep, len(ids), keep is None or d == keep, hashlib.sha256(norm(t)).hexdigest()))
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


def test_fingerprints_compose():
    rng = random.Random(1)
    for _ in range(50):
        data = bytes(rng.randrange(256) for _ in range(rng.randrange(400)))
        cut = rng.randint(0, len(data))
        whole = ed.chunk_hash(data)
        assert ed.combine(ed.chunk_hash(data[:cut]), ed.chunk_hash(data[cut:])) == whole
        assert ed.fingerprint(data, chunk=rng.randint(1, 50)) == whole


@pytest.mark.parametrize("modulus", [ed.MODULUS, 3, 101])
@pytest.mark.parametrize("huge", [ed.HUGE, 10])
def test_awkward_rows_even_when_fingerprints_collide(spark, modulus, huge):
    got = ed.exact_duplicates(docs(spark), modulus=modulus, huge=huge, chunk=7 if huge == 10 else 4096)
    assert rows(got) == expected(ROWS)


def test_one_row_of_each_text_is_left(spark):
    table = docs(spark)
    left = ed.one_row_each(table)
    assert left.columns == table.columns
    norm = [(t or "").encode().lower() for _, t in rows(left, "doc_id", "text")]
    assert len(norm) == len(set(norm)) == len({(t or "").encode().lower() for _, t, *_ in ROWS})


def test_no_rows(spark):
    assert rows(ed.exact_duplicates(docs(spark, []))) == []
    assert rows(ed.one_row_each(docs(spark, []))) == []
