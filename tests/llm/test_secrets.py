import random

from cases import ROWS, docs, rows
from pyspark.sql import functions as F

from loadpanel.llm import secrets
from loadpanel.llm.queries import all_queries

PATH = "source"


def corpus(n=160, seed=5):
    """Documents with keys in assignments, and with build numbers, long words and hashes that are none."""
    rng = random.Random(seed)
    hexa = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    words = ["config", "server", "please", "update", "module", "internationalisation", "value", "build"]
    out, truth = [], {}
    for i in range(n):
        noise = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(3, 12)))
        value = hexa(rng.choice([32, 40])) if i % 2 == 0 else rng.choice([str(rng.randrange(10**15, 10**16)), "internationalisation" + "module" * rng.randint(1, 2)])
        truth[value] = int(i % 2 == 0)
        lead = rng.choice(['token = "', 'api_key: "', 'password="']) if i % 2 == 0 else rng.choice(["build ", "see ", "number "])
        out.append((i, f'{noise()} {lead}{value}" {noise()}', "en", f"src/{i % 5}/main.py"))
    return out, truth


def test_findings_of_awkward_rows(spark):
    table = ROWS + [(30, "key=ABCDEFGHIJKLMNOP1234 tail", "en", None), (31, "x" * 5000, "en", "p"), (32, "ab12" * 4, "en", "p")]
    found = secrets.find_candidates(docs(spark, table), PATH)
    got = {(r["doc_id"], r["no"], r["value"], r["before"], r["after"]) for r in found.collect() if r["doc_id"] in (30, 31, 32)}
    assert got == {
        (30, 0, "key=ABCDEFGHIJKLMNOP1234", "", " tail"),
        (31, 0, "x" * 5000, "", ""),
        (32, 0, "ab12" * 4, "", ""),
    }
    out = secrets.scan(docs(spark, table), PATH)
    assert out.count() == found.count() and rows(secrets.scan(docs(spark, []), PATH)) == []


def test_forest_from_labelled_findings_removes_false_positives(spark):
    table, truth = corpus()
    labels = spark.createDataFrame([(v, l) for v, l in list(truth.items())[:100]], "value string, label int")
    out = {r["value"]: r["is_secret"] for r in secrets.scan(docs(spark, table), PATH, labels).collect()}
    rest = list(truth.items())[100:]
    assert sum(out[v] == bool(l) for v, l in rest) / len(rest) >= 0.95


def test_one_class_of_labels_reports_everything(spark):
    table, truth = corpus(20)
    labels = spark.createDataFrame([(v, 1) for v in truth], "value string, label int")
    assert {r["score"] for r in secrets.scan(docs(spark, table), PATH, labels).collect()} == {1.0}


def test_planted_tokens_are_reported(spark, sf_dir):
    out = all_queries()["op3_secrets"](spark, sf_dir)
    text = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.explode(F.regexp_extract_all("text", F.lit('token = "([0-9a-f]{40})"'), F.lit(1))).alias("v")
    )
    planted = {r[0] for r in text.select(F.sha2("v", 256)).distinct().collect()}
    found = {r["value_sha256"] for r in out.filter("is_secret").collect()}
    assert planted and planted <= found
    assert out.filter("not is_secret").count() > 0
