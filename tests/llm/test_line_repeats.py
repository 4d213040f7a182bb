import re
from collections import Counter, defaultdict

import pytest
from cases import ROWS, docs, rows
from test_line_templates import logs

from loadpanel.llm import line_templates as lt


def left(spark, table, **bounds):
    return {r["doc_id"]: r["text"] for r in lt.drop_repeats(docs(spark, table), **bounds).collect()}


def expected(table, depth, min_docs, share):
    """By rows whose ids and texts differ; of equal ones each is treated alike."""
    lines = [(r, n, line, re.findall(r"[^\x20\x09-\x0D]+", line)) for r, (_, t, *_) in enumerate(table) for n, line in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[3]]
    texts, in_leaf, at = defaultdict(set), defaultdict(set), defaultdict(set)
    leaf = lambda k: (len(k), tuple("<*>" if re.search("[0-9]", t) else t for t in k[:depth]))
    first = lambda rs: min(rs, key=lambda r: (table[r][0] is None, table[r][0] or 0))
    for r, _, line, k in lines:
        texts[line].add(table[r][1])
        in_leaf[leaf(k)].add(table[r][1])
        at[line].add(r)
    support = Counter()
    words = {line: k for _, _, line, k in lines if len(in_leaf[leaf(k)]) >= min_docs}
    for line, k in words.items():
        for i, t in enumerate(k):
            support[leaf(k), i, t] += len(texts[line])
    template, having, held = {}, defaultdict(set), defaultdict(set)
    for line, k in words.items():
        constant = [support[leaf(k), i, t] >= min_docs for i, t in enumerate(k)]
        behind = constant[depth:]
        if not all(constant) and any(behind) and sum(behind) >= share * len(behind):
            template[line] = (leaf(k), " ".join(t if c else "<*>" for t, c in zip(k, constant)))
            having[template[line]] |= texts[line]
            held[template[line]] |= at[line]
    gone = {(r, n) for r, n, line, _ in lines if len(texts[line]) > 1 and table[r][:2] != table[first(at[line])][:2]}
    gone |= {(r, n) for r, n, line, _ in lines if len(having[template.get(line)]) >= min_docs and table[r][:2] != table[first(held[template[line]])][:2]}
    out = []
    for r, (d, t, *_) in enumerate(table):
        parts = (t or "").split("\n")
        kept = [x for n, x in enumerate(parts) if (r, n) not in gone]
        out.append((d, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.mark.parametrize("depth, min_docs, share", [(2, 3, 0.5), (1, 2, 0.3)])
def test_against_brute_force(spark, depth, min_docs, share):
    table = ROWS + logs(12) + [(40 + i, logs(12)[5][1], "en", "s") for i in range(4)]
    assert rows(lt.drop_repeats(docs(spark, table), depth, min_docs, share)) == expected(table, depth, min_docs, share)


def test_copies_of_one_text_lose_nothing(spark):
    text = "A line of the text that many documents copy.\nAnd a second one behind it."
    table = [(i, text, "en", "s") for i in range(12)]
    assert left(spark, table) == dict.fromkeys(range(12), text)


def test_a_template_stays_in_its_smallest_id(spark):
    table = [(i, f"Job {i} started on host a by user u{i}\nown{i}", "en", "s") for i in range(5, 17)]
    assert left(spark, table) == {i: table[0][1] if i == 5 else f"own{i}" for i in range(5, 17)}


def test_exact_repeats_go_from_two_documents_on(spark):
    table = [(2, "shared line of both\nfirst", "en", "s"), (1, "shared line of both\nsecond", "en", "s"), (None, "shared line of both", "en", "s")]
    assert left(spark, table) == {1: "shared line of both\nsecond", 2: "first", None: ""}


def test_a_leaf_alone_drops_no_line(spark):
    table = [(i, f"In the {a} {b}", "en", "s") for i, (a, b) in enumerate(zip("abcdefghijkl", "mnopqrstuvwx"))]
    assert left(spark, table) == {i: t for i, t, *_ in table}


def test_no_rows(spark):
    assert rows(lt.drop_repeats(docs(spark, []))) == []
