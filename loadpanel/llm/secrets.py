"""Secret scan: regular expressions propose, a random forest removes the false positives.

The forest sees a candidate's length, how often its characters change class, how
much of it dictionary words cover, the path it was found in and the words around
it, and learns from labelled findings. Where nobody has labelled any, a rule labels
findings of the corpus, and findings of a few written forms join them: random values
that are no secrets (identifiers, digests, embedded files, paths, quoted prose), and
keys. Everything runs as DataFrame operations and Spark ML; no Python runs on the
executors.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loadpanel.llm.common import new_folder
from loadpanel.scale import lookup_join, materialize, row_bound

# A naming word by itself, or set off in a compound by a mark or a capital: API_KEY and apiKey, but not monkey or author.
NAMING = (
    r"(?:(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z])|(?<=api)|(?<=API))"
    r"(?i:key|token|secret|passwd|password|passphrase|pwd|auth|authorization|authentication|credential|bearer|private)s?(?![a-z]))"
)
# A naming word with what assigns to it, or a word or two and a quote.
_NAMED = (
    r"(?<![A-Za-z0-9_\-])(?=[A-Za-z0-9_\-]*?" f"{NAMING}" r")[A-Za-z0-9_\-]++"
    r"[\"'`]?(?:[ \t]{0,3}(?::=|=>|={1,3}|:)(?!=)[ \t]{0,3}(?:[Bb]earer[ \t]{1,3})?|(?:[ \t]{1,3}[A-Za-z]{1,12}){0,2}[ \t]{1,3}(?=[\"'`]))"
)
# A candidate is any quoted or assigned value behind a naming word (with the name, which is taken off later), a long
# run of key characters, or a shorter one with a digit in it.
CANDIDATE = (
    f"({_NAMED}" r"(?:\"[^\"\r\n]+(?=\")|'[^'\r\n]+(?=')|`[^`\r\n]+(?=`)"
    # Unquoted it ends at white space, or where another name is assigned to.
    r"|[^\s\"'`][^\s\"'`,;&?]*+(?:[,;&?](?![A-Za-z0-9_.\-]++[=:])[^\s\"'`,;&?]*+)*+)"
    r"|[A-Za-z0-9_+/=\-]{20,}|(?=[A-Za-z_+/=\-]*[0-9])[A-Za-z0-9_+/=\-]{16,19})"
)
# Words before a candidate and behind it that are looked at, and the inputs that they are hashed into.
WORDS_BEFORE, WORDS_BEHIND, WORD_INPUTS = 2, 1, 64
HARMLESS = r"(?i)(example|sample|test|dummy|placeholder|changeme|mock|fixture|vendor|doc)"
# Words that say that a random value names or sums up something.
IDENTIFIER = (
    r"(?i)(?<![a-z])(?:commit|revision|rev|changeset|blob|tree|sha|sha[\-_]?\d+|md5|crc32|checksum|digest|hash|etag|integrity|"
    r"fingerprint|uuid|guid|base64|build|serial|isbn|doi|nonce)s?(?![a-z])"
)
# What of a candidate is a name and its assignment, with an opening quote.
NAME = f"^({_NAMED}" r"[\"'`]?(?=[^\"'`])|[A-Za-z_\-][A-Za-z0-9_\-]*=(?=[^=]))"
# A bare value with more bits a character than this, or with letters and digits mixed, may be a secret.
RANDOM_BITS = 3.5
# A value with more of its letters in dictionary words than this is prose.
PROSE = 0.6
# Written findings of each form that join the rule's.
WRITTEN = 40
# Words in this share of the documents, and in two at least, serve as dictionary; of so many letters at least.
DICTIONARY_SHARE = 1e-6
DICTIONARY_LETTERS = 3
# Words of candidates that are broadcast.
SENT_BYTES = 16 << 20
# The forest is fitted on at most so many labelled findings, the first in a fixed pseudo-random order.
TRAINING_ROWS = 20_000
PATH_GROUPS = 16

FEATURES = (
    "length", "transitions", "digits", "capitals", "symbols", "spaces", "bits", "hex", "uuid", "path_like", "coverage",
    "path_depth", "path_harmless", "path_group", "named", "assigned", "quoted", "near_harmless", "near_identifier",
    *[f"word_{i}" for i in range(WORD_INPUTS)],
)
# What rule_label looks at; a forest that learns from it does not see them.
RULE_FLAGS = ("named", "assigned", "quoted", "near_harmless")
UNRULED = tuple(f for f in FEATURES if f not in RULE_FLAGS)


def find_candidates(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, no (in the text, from 0), value, before, after and path of every candidate in the whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), text.alias("text")
    )
    # The text cut at its candidates: piece i stands before candidate i, piece i + 1 behind it.
    rows = rows.filter(F.col("text").rlike(CANDIDATE))
    rows = rows.withColumn("values", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(1)))
    rows = rows.withColumn("pieces", F.split("text", CANDIDATE, -1)).drop("text")
    # Only the neighbourhood goes on, not the pieces: whole words, with what stands between.
    def spaced(p: Column) -> Column:
        return F.translate(p, "\t\r\n\f\u000b\u00a0", "      ")

    near = F.transform(
        "pieces",
        lambda p: F.struct(
            F.right(p, _tail_length(spaced(p))).alias("tail"), F.left(p, _head_length(spaced(p))).alias("head")
        ),
    )
    found = F.transform(
        "values",
        lambda v, i: F.struct(
            v.alias("value"),
            F.get(F.col("near"), i)["tail"].alias("before"),
            F.get(F.col("near"), i + 1)["head"].alias("after"),
        ),
    )
    rows = rows.withColumn("near", near).select("doc_id", "path", F.posexplode(found).alias("no", "f"))
    return rows.select("doc_id", "path", "no", "f.value", "f.before", "f.after")


def _tail_length(piece: Column) -> Column:
    """Length of the last words, with the space between and behind them; double spaces leave room for as many words."""
    bare = F.rtrim(piece)
    return F.length(piece) - F.length(bare) + F.length(F.substring_index(bare, " ", -2 * WORDS_BEFORE))


def _head_length(piece: Column) -> Column:
    bare = F.ltrim(piece)
    return F.length(piece) - F.length(bare) + F.length(F.substring_index(bare, " ", WORDS_BEHIND))


def without_names(found: DataFrame) -> DataFrame:
    """The findings with a leading name and its assignment moved from ``value`` to ``before``."""
    name = F.regexp_extract("value", NAME, 1)
    before = F.concat("before", name)
    return found.withColumns({"before": before, "value": F.substr("value", F.length(name) + 1)})


def dictionary(docs: DataFrame, share: float = DICTIONARY_SHARE) -> DataFrame:
    """The letter-only words that ``share`` of all documents have, two documents at least."""
    text = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    words = docs.select(F.explode(F.array_distinct(F.split(text, r"[^\p{L}]+"))).alias("word"))
    counted = words.filter(F.length("word") >= DICTIONARY_LETTERS).groupBy("word").count()
    bar = max(2, math.ceil(share * docs.count()))
    return materialize(counted.filter(F.col("count") >= bar).select("word"), "secret-dictionary")


def _share(pattern: str) -> Column:
    return F.regexp_count("value", F.lit(pattern)) / F.length("value")


def _bits(value: Column) -> Column:
    """Bits a character: how evenly the value's characters are used, over the whole value."""
    n = F.length(value)
    shares = F.transform(F.array_distinct(F.split(value, "")), lambda c: (n - F.length(F.replace(value, c, F.lit("")))) / n)
    return F.aggregate(shares, F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def _neighbours() -> Column:
    """The words before and behind, in lower case and without the marks around them; naming words are left out.

    Those are what the rule matches.
    """
    def words(c: str) -> Column:
        found = F.transform(F.split(F.lower(c), r"[\s\u00a0]+"), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
        return F.filter(found, lambda w: w != "")

    near = F.concat(F.slice(F.reverse(words("before")), 1, WORDS_BEFORE), F.slice(words("after"), 1, WORDS_BEHIND))
    return F.filter(near, lambda w: ~w.rlike(NAMING))


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """The findings with the forest's inputs, one value each also for odd neighbours."""
    runs = F.filter(F.split(F.lower("value"), r"[^\p{L}]+"), lambda w: F.length(w) >= DICTIONARY_LETTERS)
    # Distinct runs only: a value that thousands of documents share is looked up once. It goes by its digest, as it may be long.
    found = found.withColumn("value_key", F.sha2("value", 256))
    parts = materialize(found.select("value_key", "value").distinct().select("value_key", F.explode(runs).alias("word")), "secret-words")
    size = parts.agg(F.sum(F.length("word") + F.lit(80))).first()[0] or 0
    # Few words are looked for in a long dictionary, so they go to it and not the other way round.
    known = words.join(F.broadcast(parts), "word") if size <= SENT_BYTES else lookup_join(parts, words, ["word"], spread="value_key")
    covered = materialize(known.groupBy("value_key").agg(F.sum(F.length("word")).alias("covered")), "secret-coverage")
    joined = found.join(F.broadcast(covered) if (row_bound(covered) or 0) <= 100_000 else covered, "value_key", "left")
    flag = lambda c: c.cast("double")
    before = F.regexp_replace("before", r"[\s\"'`]+$", "")
    near = joined.withColumn("_near", F.transform(_neighbours(), lambda w: F.pmod(F.crc32(w.cast("binary")), F.lit(WORD_INPUTS))))
    return near.select(
        *joined.columns,
        F.log2(F.length("value") + 1).alias("length"),
        _share(r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[_+/=\-])(?=[A-Za-z0-9])").alias("transitions"),
        _share("[0-9]").alias("digits"),
        _share("[A-Z]").alias("capitals"),
        _share(r"[_+/=\-]").alias("symbols"),
        _share(r"\s").alias("spaces"),
        _bits(F.col("value")).alias("bits"),
        flag(F.col("value").rlike("^[0-9a-fA-F]+$")).alias("hex"),
        flag(F.col("value").rlike(r"^\{?[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}\}?$")).alias("uuid"),
        flag(F.col("value").rlike(r"^[~/]?(?:[A-Za-z_\-]{1,32}/)+[A-Za-z_\-]{1,32}$")).alias("path_like"),
        (F.coalesce("covered", F.lit(0)) / F.length("value")).alias("coverage"),
        F.regexp_count("path", F.lit("/")).cast("double").alias("path_depth"),
        flag(F.col("path").rlike(HARMLESS)).alias("path_harmless"),
        F.pmod(F.xxhash64("path"), F.lit(PATH_GROUPS)).cast("double").alias("path_group"),
        flag(F.col("before").rlike(NAMING)).alias("named"),
        flag(before.rlike(r"([=:]|=>)$")).alias("assigned"),
        flag(F.col("before").rlike(r"[\"'`]$")).alias("quoted"),
        flag(F.col("before").rlike(HARMLESS) | F.col("after").rlike(HARMLESS)).alias("near_harmless"),
        flag(F.col("before").rlike(IDENTIFIER)).alias("near_identifier"),
        *[flag(F.array_contains("_near", F.lit(i).cast("long"))).alias(f"word_{i}") for i in range(WORD_INPUTS)],
    )


def written_findings(spark: SparkSession, n: int = WRITTEN) -> DataFrame:
    """Texts with findings of known forms: doc_id, text, path and label. Values are drawn by digest, the same each time.

    Random values that only name or sum up something, or embed a file, are no secrets; nor are paths and quoted prose.
    The same random values in prose and in assignments are.
    """
    rows = spark.range(n).select(F.col("id").alias("i"), F.sha2(F.concat(F.lit("a"), F.col("id")), 256).alias("a"), F.sha2(F.concat(F.lit("b"), F.col("id")), 512).alias("b"))
    hex32, hex40, hex64 = F.left("a", F.lit(32)), F.left("b", F.lit(40)), F.col("a")
    # Base 64 of a digest's bytes, without the filling at the end.
    mixed = F.rtrim(F.lit("="), F.base64(F.unhex("b")))
    short = F.left(F.regexp_replace(mixed, "[+/]", ""), F.lit(28))
    guid = F.upper(F.regexp_replace(hex32, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))
    person = F.element_at(F.array(*map(F.lit, ("please read", "we think of", "they found", "and then"))), (F.col("i") % 4 + 1).cast("int"))
    opening = F.element_at(F.array(*map(F.lit, ("the", "some words here", "notes about", "now", "see also"))), (F.col("i") % 5 + 1).cast("int"))
    folders = F.element_at(F.array(*map(F.lit, ("include/linux/netfilter", "Documents/letters/archive", "app/views/layouts", "usr/share/icons"))), (F.col("i") % 4 + 1).cast("int"))
    prose = "please read the whole notice before the meeting begins"
    harmless = [
        (opening, F.lit(" revision "), hex40), (F.lit("see changeset"), F.lit(" "), hex40), (opening, F.lit(" blob "), hex40),
        (opening, F.lit(" md5: "), hex32), (F.lit("checksum"), F.lit(" md5="), hex32), (opening, F.lit(" sha512 "), F.col("b")), (opening, F.lit(" etag: \""), hex64),
        (opening, F.lit(" guid "), guid), (opening, F.lit(" item "), guid), (F.lit("src=data:font/woff2;base64,"), F.lit(""), mixed), (opening, F.lit(" url(data:audio/ogg;base64,"), F.concat(mixed, mixed)),
        (person, F.lit(" "), F.concat(folders, F.lit("/"), folders)), (opening, F.lit(" /"), F.concat(folders, F.lit("/"), folders)),
        (opening, F.lit(" secret: \""), F.concat(person, F.lit(f" {prose}"))), (person, F.lit(" password = \""), F.lit(prose)),
    ]
    secret = [
        (opening, F.lit(" "), hex40), (person, F.lit(" "), hex40), (opening, F.lit(" "), short), (person, F.lit(" "), hex64), (opening, F.lit(" "), hex32),
        (opening, F.lit(" password: \""), short), (person, F.lit(" api_key = \""), hex32), (opening, F.lit(" CLIENT_SECRET="), mixed),
        (opening, F.lit(" access_key="), F.concat(F.left("a", F.lit(22)), F.lit("Rk"))), (person, F.lit(" APP_SECRET="), short), (opening, F.lit(" pwd="), F.left("b", F.lit(26))),
        (opening, F.lit(" token = \""), hex40), (person, F.lit(" bearer "), mixed), (opening, F.lit(" access_token='"), hex64),
    ]
    forms = [(*f, 0) for f in harmless] + [(*f, 1) for f in secret]
    texts = F.array(
        *[F.struct(F.concat(lead, mark, value, F.when(mark.contains('"'), '"').when(mark.contains("'"), "'").otherwise(""), F.lit(" and more")).alias("text"), value.alias("written"), F.lit(label).alias("label")) for lead, mark, value, label in forms]
    )
    found = rows.select("i", F.posexplode(texts).alias("form", "t"))
    return found.select((F.col("i") * len(forms) + F.col("form")).alias("doc_id"), "t.text", F.lit("").alias("path"), "t.written", "t.label")


def _assembled(rows: DataFrame, inputs: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(inputs), outputCol="_inputs", handleInvalid="keep").transform(rows)


def fit(
    labelled: DataFrame, trees: int = 40, depth: int = 8, rows: int = TRAINING_ROWS, inputs: Sequence[str] = FEATURES
) -> RandomForestClassificationModel | None:
    """The forest from the features ``inputs`` and ``label`` (0 or 1), or None if the labels know one class only."""
    order = F.xxhash64("value", "before", "after", "path", F.lit(7))
    # So few rows that one task holds them in a fixed order; reruns grow the same trees.
    known = labelled.filter("label in (0, 1)").orderBy(order, "value", "before", "after").limit(rows)
    sample = materialize(known, "secret-training")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        featuresCol="_inputs", labelCol="label", numTrees=trees, maxDepth=depth, seed=11, featureSubsetStrategy="0.4", maxMemoryInMB=64
    )
    model = forest.fit(_assembled(sample.withColumn("label", F.col("label").cast("double")), inputs))
    # Read back, a model carries no reference to its training session into the tasks.
    path = new_folder(labelled.sparkSession, "secret-forest")
    model.write().save(path)
    return RandomForestClassificationModel.load(path)


def scored(
    found: DataFrame, model: RandomForestClassificationModel | None, inputs: Sequence[str] = FEATURES
) -> DataFrame:
    """The findings with ``score``, the forest's share for a true secret; 1 for all if there is no forest."""
    if model is None:
        return found.withColumn("score", F.lit(1.0))
    out = model.setProbabilityCol("_p").setRawPredictionCol("").setPredictionCol("").transform(_assembled(found, inputs))
    return out.withColumn("score", vector_to_array("_p")[1]).drop("_inputs", "_p")


def _random() -> Column:
    """Whether the value's characters look drawn at random."""
    return (F.col("value").rlike("[A-Za-z]") & F.col("value").rlike("[0-9]")) | (F.col("bits") > RANDOM_BITS)


def rule_label() -> Column:
    """Labels for findings where nobody has looked: a random value assigned in quotes to a telling name is true;
    false is one that is neither named nor assigned and does not look random, and what is prose; all else stays unlabelled."""
    named, assigned, quoted = (F.col(c) == 1 for c in ("named", "assigned", "quoted"))
    prose = (F.col("coverage") > PROSE) | ((F.col("spaces") > 0) & ~F.col("value").rlike("[0-9]"))
    true = named & assigned & quoted & (F.col("near_harmless") == 0) & (F.col("near_identifier") == 0) & _random() & ~prose
    return F.when(true, 1).when((~named & ~assigned & ~_random()) | (named & prose), 0)


def scan(docs: DataFrame, path: str, labels: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """Every candidate of ``docs`` with its score: doc_id, no, path, value, before, after, score, is_secret.

    ``labels`` (value, label) marks findings by value. Without it ``rule_label`` marks those of documents outside the
    held-out quarter, ``written_findings`` join them, and the forest does not see what the rule looks at. A name and
    its assignment belong to ``before``. Null and empty texts have no candidates; a null path is empty. Repeated rows
    give their findings again. If the labels know one class only, every candidate is reported with score 1. Without
    rows, no rows.
    """
    words = dictionary(docs)
    # Few rows from a pass over all texts: stored before anything is asked of them.
    candidates = materialize(without_names(find_candidates(docs, path)), "secret-candidates")
    found = materialize(features(candidates, words), "secret-findings")
    inputs = UNRULED if labels is None else FEATURES
    if labels is None:
        held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
        ruled = found.filter(~held).withColumn("label", rule_label()).filter("label is not null")
        labelled = ruled.unionByName(_written_features(docs.sparkSession, words).select(*ruled.columns))
    else:
        marks = labels.groupBy("value").agg(F.max(F.col("label").cast("int")).alias("label"))
        labelled = found.join(marks, "value")
    out = scored(found, fit(labelled, inputs=inputs), inputs)
    return out.withColumn("is_secret", F.col("score") >= threshold)


def _written_features(spark: SparkSession, words: DataFrame) -> DataFrame:
    """The written findings as findings, with their labels."""
    texts = materialize(written_findings(spark), "written-findings")
    found = without_names(find_candidates(texts, "path")).join(F.broadcast(texts.select("doc_id", "written", "label")), "doc_id")
    # A text may have candidates beside the one it was written for.
    own = found.filter((F.col("value") == F.col("written")) | F.col("written").contains(F.col("value"))).drop("written")
    return features(own, words)
