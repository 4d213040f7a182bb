"""False reports that the forest must not make, and candidates and inputs recomputed in plain Python."""

import hashlib
import math
import random
import re
import zlib

import pytest
from cases import docs

from loadpanel.llm import secrets
from loadpanel.llm.common import table

PATH = "source"
IMAGE = "iVBORw0KGgoAAAANSUhEUgAAAAUAAAAFCAYAAACNbyblAAAAHElEQVQI12P4/8/w38GIAXDIBKE0DHxgljNBAAO9TXL0Y4OHwAAAABJRU5ErkJggg"


def hexa(rng, k=40):
    return "".join(rng.choice("0123456789abcdef") for _ in range(k))


def uuid(rng):
    h = hexa(rng, 32)
    return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


@pytest.fixture(scope="module")
def corpus(spark, sf_dir):
    """The table's documents and, after them, texts of forms that are in no training finding."""
    rng = random.Random(9)
    harmless, secret = [], []
    for _ in range(5):
        harmless += [
            f"fixed in commit {hexa(rng)} last week",
            f"the request {uuid(rng)} was slow",
            f'image "sha256:{hexa(rng, 64)}" is in use',
            f'<img src="data:image/png;base64,{hexa(rng, 6)}{IMAGE}">',
            "look into loadpanel/sources/partitioned/json_files.py for it",
            'then token = "This is only an ordinary sentence about nothing." he said',
            "by author: Jane Austen and others",
        ]
        secret += [f'thnd token = "{hexa(rng)}" the', f"erin api_key: '{hexa(rng, 32)}' on", f"DB_PASSWORD={hexa(rng, 24)}Xy9 more", f"some words here {hexa(rng)} and more"]
    texts = [(10**9 + i, t, "en", "p") for i, t in enumerate(harmless + secret)]
    base = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    whole = base.unionByName(docs(spark, texts, clash=False))
    return whole, harmless, secret


def test_written_forms_that_are_no_secrets_are_not_reported(spark, corpus):
    whole, harmless, secret = corpus
    found = secrets.scan(whole, PATH).filter("doc_id >= 1000000000").collect()
    false = [(harmless[r["doc_id"] - 10**9], r["value"], r["score"]) for r in found if r["doc_id"] - 10**9 < len(harmless) and r["is_secret"]]
    assert false == []
    reported = {r["doc_id"] - 10**9 - len(harmless) for r in found if r["is_secret"]}
    assert set(range(len(secret))) <= reported


def plain_candidates(text):
    """no, value, before and after of every candidate, with the same expression in Python's ``re``."""
    pattern = re.compile(secrets.CANDIDATE)
    spans = [m.span() for m in pattern.finditer(text)]
    space = str.maketrans("\t\r\n\f\v ", "      ")
    ends = [0, *[b for _, b in spans]]
    out = []
    for i, (a, b) in enumerate(spans):
        left, right = text[ends[i] : a], text[b : spans[i + 1][0] if i + 1 < len(spans) else len(text)]
        bare = left.translate(space).rstrip(" ")
        keep = len(left) - len(bare) + len(" ".join(bare.split(" ")[-4:]))
        head = right.translate(space)
        width = len(head) - len(head.lstrip(" ")) + len(head.lstrip(" ").split(" ")[0])
        value, before = text[a:b], left[len(left) - keep :]
        name = re.match(secrets.NAME, value)
        if name:
            value, before = value[name.end() :], before + name[0]
        out.append((i, value, before, right[:width]))
    return out


def plain_inputs(value, before, after, known):
    n = len(value)
    count = lambda p: len(re.findall(p, value))
    words = [w for w in re.findall(r"[^\W\d_]+", value.lower()) if len(w) >= secrets.DICTIONARY_LETTERS]
    near = [re.sub(r"^[\W_]+|[\W_]+$", "", w) for w in re.split(r"[\s ]+", before.lower())]
    near = [w for w in near if w][::-1][:2]
    near += [w for w in (re.sub(r"^[\W_]+|[\W_]+$", "", w) for w in re.split(r"[\s ]+", after.lower())) if w][:1]
    hashed = {zlib.crc32(w.encode()) % secrets.WORD_INPUTS for w in near if not re.search(secrets.NAMING, w)}
    return {
        "length": math.log2(n + 1),
        "digits": count("[0-9]") / n,
        "capitals": count("[A-Z]") / n,
        "spaces": count(r"[ \t\n\x0b\f\r]") / n,
        "bits": -sum(p * math.log2(p) for p in (value.count(c) / n for c in set(value))),
        "hex": float(bool(re.fullmatch("[0-9a-fA-F]+", value))),
        "coverage": sum(len(w) for w in words if w in known) / n,
        "named": float(bool(re.search(secrets.NAMING, before))),
        "near_identifier": float(bool(re.search(secrets.IDENTIFIER, before))),
        **{f"word_{i}": float(i in hashed) for i in range(secrets.WORD_INPUTS)},
    }


def test_candidates_and_inputs_in_plain_python(spark, corpus):
    whole = corpus[0]
    words = secrets.dictionary(whole)
    known = {r["word"] for r in words.collect()}
    found = secrets.features(secrets.without_names(secrets.find_candidates(whole, PATH)), words)
    got = {(r["doc_id"], r["no"]): r for r in found.collect()}
    want = {(r["doc_id"], no): rest for r in whole.collect() for no, *rest in plain_candidates(r["text"] or "")}
    assert got.keys() == want.keys() and len(got) > 80
    for k, (value, before, after) in want.items():
        r = got[k]
        assert (r["value"], r["before"], r["after"]) == (value, before, after)
        for name, x in plain_inputs(value, before, after, known).items():
            assert r[name] == pytest.approx(x, abs=1e-9), (name, value, before)


def test_long_values_are_looked_at_as_a_whole(spark):
    """Random behind the first thousand characters, and accents in dictionary words."""
    long = "a" * 2000 + hashlib.sha256(b"x").hexdigest() * 40
    table_ = [(1, f"see {long} here", "en", "p"), (2, "see naïveté/élégance/naïveté/élégance here", "en", "p"), (3, "naïveté élégance", "en", "p")]
    rows = docs(spark, table_)
    found = secrets.features(secrets.without_names(secrets.find_candidates(rows, PATH)), secrets.dictionary(rows)).collect()
    by = {r["doc_id"]: r for r in found}
    assert by[1]["length"] == pytest.approx(math.log2(len(long) + 1)) and by[1]["bits"] > 2
