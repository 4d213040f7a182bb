import re
from collections import Counter, defaultdict

import pytest
from cases import LONG, ROWS, docs, rows

from loadpanel.llm import line_templates as lt


def expected(table, depth, min_docs, min_constant):
    name = lambda d, t: ("null", t or "") if d is None else d
    lines = [(r, n, line, re.findall(r"[^\x20\x09-\x0D]+", line)) for r, (_, t, *_) in enumerate(table) for n, line in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[3]]
    leaf = lambda tokens: (len(tokens), tuple("<*>" if re.search("[0-9]", t) else t for t in tokens[:depth]))
    docs_of = defaultdict(set)
    for r, _, line, tokens in lines:
        docs_of[line].add(name(*table[r][:2]))
    in_leaf = defaultdict(set)
    for r, _, line, tokens in lines:
        in_leaf[leaf(tokens)].add(name(*table[r][:2]))
    support, distinct = Counter(), {line: tokens for _, _, line, tokens in lines if len(in_leaf[leaf(tokens)]) >= min_docs}
    for line, tokens in distinct.items():
        for i, t in enumerate(tokens):
            support[leaf(tokens), i, t] += len(docs_of[line])
    template, having = {}, defaultdict(set)
    for line, tokens in distinct.items():
        constant = [support[leaf(tokens), i, t] >= min_docs for i, t in enumerate(tokens)]
        if sum(constant) / len(constant) >= min_constant:
            template[line] = (leaf(tokens), " ".join(t if c else "<*>" for t, c in zip(tokens, constant)))
            having[template[line]] |= docs_of[line]
    gone = {line for line, t in template.items() if len(having[t]) >= min_docs}
    out = []
    for d, t, *_ in table:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if x not in gone]
        out.append((d, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


def logs(n):
    return [
        (i, f"Job {i} started on host h{i % 3} by user u{i}\nunique line number{i} with {i * 7} words of its own {'x ' * (i % 4)}\n\nDone.\n{LONG[: i * 10]}", "en", "s")
        for i in range(n)
    ]


@pytest.mark.parametrize("depth, min_docs, share", [(2, 3, 0.5), (1, 2, 0.3), (3, 5, 0.9)])
def test_against_brute_force(spark, depth, min_docs, share):
    table = ROWS + logs(12)
    assert rows(lt.drop_templates(docs(spark, table), depth, min_docs, share)) == expected(table, depth, min_docs, share)


def test_variable_fields_are_generalised(spark):
    templates, dropped = lt.line_templates(docs(spark, logs(12)), depth=1, min_docs=4, min_constant=0.5)
    found = {r["template"]: r["n_docs"] for r in templates.collect()}
    assert found["Job <*> started on host h0 by user <*>"] == 4 and found["Done."] == 12
    assert dropped.count() >= 24


def test_no_rows(spark):
    assert rows(lt.drop_templates(docs(spark, []))) == []
