import random

from cases import docs

from loadpanel.llm import secrets

PATH = "source"


def hexa(rng, k=40):
    return "".join(rng.choice("0123456789abcdef") for _ in range(k))


def test_unquoted_and_bare_keys_are_secrets_too(spark):
    """Quoted tokens and numbers are labelled by the rule; the forest has to go on from their shape."""
    rng = random.Random(3)
    table = [(i, f'some words token = "{hexa(rng)}" and number {rng.randrange(10**15, 10**16)} more', "en", "p") for i in range(120)]
    plain = [hexa(rng) for _ in range(20)]
    table += [(200 + i, f"some words API_KEY={v} and more" if i % 2 else f"some words here {v} and more", "en", "p") for i, v in enumerate(plain)]
    out = {r["value"]: r for r in secrets.scan(docs(spark, table), PATH).collect()}
    assert set(plain) <= set(out) and all(out[v]["is_secret"] for v in plain)
    assert out[plain[1]]["before"] == "some words API_KEY="
    assert not any(r["is_secret"] for v, r in out.items() if v.isdigit())


def test_forest_of_the_rule_does_not_see_its_flags():
    assert not {"named", "assigned", "quoted", "near_harmless"} & set(secrets.UNRULED)


def test_short_and_broken_values_behind_a_naming_word_are_proposed(spark):
    values = {
        'password = "Tr0ub4dor&3"': "Tr0ub4dor&3",
        "DB_PASSWORD=hunter2 tail": "hunter2",
        '{"api_key": "abcdefghijklmnopqr"}': "abcdefghijklmnopqr",
        "the secret is 'a.b!c@d#e$f%'": "a.b!c@d#e$f%",
        "Authorization: Bearer abc.def": "abc.def",
        "MY_LONG_SERVICE_TOKEN=ab,c;d": "ab,c;d",
        "key=a&x&y": "a&x&y",
    }
    table = [(i, t, "en", "p") for i, t in enumerate(values)] + [(90, "token=" + "a,&" * 100_000, "en", "p"), (91, "token" * 20_000, "en", "p")]
    found = secrets.without_names(secrets.find_candidates(docs(spark, table), PATH))
    got = {r["doc_id"]: r["value"] for r in found.filter("doc_id < 90").collect()}
    assert got == dict(enumerate(values.values()))
    assert {r["doc_id"]: len(r["value"]) for r in found.filter("doc_id >= 90").collect()} == {90: 300_000, 91: 100_000}


def test_dictionary_counts_documents_and_has_no_fixed_size(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [f"{a}{b}{c}q{d}" for a in letters for b in letters for c in letters for d in "xy"]
    table = [(i, " ".join(words), "en", "p") for i in range(2)] + [(2, "once " * 50, "en", "p")]
    known = {r["word"] for r in secrets.dictionary(docs(spark, table)).collect()}
    assert len(words) > 20_000 and known == set(words)
