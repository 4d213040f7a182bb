"""The operators as named queries over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from loadpanel.llm import (
    bpe,
    divergence,
    exact_dedup,
    html_text,
    line_templates,
    mixing,
    neighbours,
    ngram_join,
    quality,
    ranked_search,
    secrets,
    suffix_dedup,
    warc,
)
from loadpanel.llm.common import table, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[fn.__name__] = fn
        if sql is not None:
            _SQL[fn.__name__] = sql
        return fn

    return register


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(_SQL)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    f"""
    WITH t AS (SELECT doc_id, {_LOWER} AS body FROM documents)
    SELECT doc_id,
           max(doc_id) OVER (PARTITION BY body) AS keep_id,
           count(*) OVER (PARTITION BY body) AS group_size,
           doc_id = max(doc_id) OVER (PARTITION BY body) AS kept,
           sha256(body) AS text_sha256
    FROM t
    """
)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts by composable fingerprints; the largest doc_id stays."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query()
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of documents that bring each source near its target number of words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("row.doc_id", "size", "source_size", "target", "taken", "copies", "rate")


@query()
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from the labels that are not held out."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and the decoded text of every whole text."""
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_decode(docs, tokenizer_path(), ("n_tokens", "ids_sha256", "decoded_sha256"))


# RFC 4648 alphabet: every five hexadecimal digits are four letters.
_BASE32 = """list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (('0x' || substr(digest, 1 + (i // 4) * 5, 5))::BIGINT >> (15 - 5 * (i % 4)))::INT % 32, 1)), 'string_agg', '')"""


@query(
    f"""
    WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS digest,
                      min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first, url
               FROM pages)
    SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to, url
    FROM p
    """
)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through monolithic archives, their normalised form, and back."""
    return warc.roundtrip(table(spark, sf_dir, "pages"))


@query()
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate secret of every text with the forest's score; values as digests."""
    found = secrets.scan(table(spark, sf_dir, "documents"), "source")
    return found.select(
        "doc_id",
        "no",
        "path",
        F.length("value").alias("value_length"),
        F.sha2("value", 256).alias("value_sha256"),
        F.round("score", 6).alias("score"),
        "is_secret",
    )


_TOKENS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


@query(
    f"""
    WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS no FROM d),
    t AS (SELECT doc_id, no, line, {_TOKENS.format("line")} AS tokens FROM l),
    r AS (SELECT *, len(tokens)::VARCHAR || ' ' || array_to_string(list_transform(tokens[1:{line_templates.DEPTH}],
              lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END), ' ') AS leaf
          FROM t WHERE len(tokens) > 0),
    f AS (SELECT leaf FROM r GROUP BY leaf HAVING count(DISTINCT doc_id) >= {line_templates.MIN_DOCS}),
    c AS (SELECT r.* FROM r JOIN f USING (leaf)),
    u AS (SELECT leaf, line, any_value(tokens) AS tokens, count(DISTINCT doc_id) AS n FROM c GROUP BY leaf, line),
    p AS (SELECT leaf, line, n, unnest(tokens) AS token, unnest(range(len(tokens))) AS place FROM u),
    k AS (SELECT leaf, place, token FROM p GROUP BY ALL HAVING sum(n) >= {line_templates.MIN_DOCS}),
    m AS (SELECT p.leaf, p.line, string_agg(coalesce(k.token, '<*>'), ' ' ORDER BY p.place) AS template
          FROM p LEFT JOIN k ON p.leaf = k.leaf AND p.place = k.place AND p.token = k.token
          GROUP BY p.leaf, p.line HAVING avg((k.token IS NOT NULL)::INT) >= {line_templates.MIN_CONSTANT}),
    x AS (SELECT leaf, template FROM c JOIN m USING (leaf, line) GROUP BY ALL
          HAVING count(DISTINCT doc_id) >= {line_templates.MIN_DOCS}),
    g AS (SELECT doc_id, no FROM c JOIN m USING (leaf, line) JOIN x USING (leaf, template)),
    s AS (SELECT doc_id, list(no) AS gone FROM g GROUP BY doc_id)
    SELECT doc_id, len(lines) AS n_lines, coalesce(len(gone), 0) AS n_dropped,
           sha256(coalesce(array_to_string(list_filter(lines, lambda y, i: NOT list_contains(coalesce(gone, []), i - 1)), chr(10)), '')) AS kept_sha256
    FROM d LEFT JOIN s USING (doc_id)
    """
)
def op9_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of templates that recur across documents."""
    left = line_templates.drop_templates(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op9_line_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines, and the lines of recurring templates, that an earlier document has."""
    left = line_templates.drop_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query(
    f"""
    WITH RECURSIVE w AS (SELECT doc_id, {_TOKENS.format(_LOWER)} AS words FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
              WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
              ELSE list_transform(range(len(words) - 3), lambda i: array_to_string(words[i + 1:i + 4], ' ')) END) AS shingle
          FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    i AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
          GROUP BY ALL),
    e AS (SELECT u, v FROM i JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)),
    r AS (SELECT doc_id AS start, doc_id AS node FROM w UNION SELECT start, v FROM r JOIN e ON node = u)
    SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
    FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT start AS doc_id, min(node) AS component_id FROM r GROUP BY start) c USING (doc_id)
    """
)
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by similar sets of four-word shingles."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=85)


@query()
def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query()
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that a document with a smaller id has."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


@query()
def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


_LETTERS = r"regexp_extract_all({}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"


@query(
    f"""
    WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                      {_LETTERS.format(_LOWER)} AS terms FROM documents),
    g AS (SELECT DISTINCT lang, source FROM d),
    t AS (SELECT lang, source, row, unnest(terms) AS term FROM d),
    k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT row) >= 30),
    o AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
    c AS (SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN o USING (lang, source, term)),
    a AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
    v AS (SELECT lang, count(*) AS v FROM k GROUP BY ALL),
    p AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM c JOIN v USING (lang)),
    q AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q FROM a JOIN v USING (lang)),
    f AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
          FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
    r AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f.value, 0) AS value
          FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
               LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source
          UNION ALL
          SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p > q),
    s AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM s WHERE part = 'pair' OR rank <= 50
    """
)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ, pair by pair, and by which terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query(
    f"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS.format(_LOWER)} AS terms FROM documents),
    e AS (SELECT row, doc_id, len(terms) AS n, terms FROM d WHERE len(terms) > 0),
    c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM e),
    t AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM e) GROUP BY ALL),
    w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
          FROM (SELECT term, count(*) AS df FROM t GROUP BY term), c),
    i AS (SELECT item_id, unnest({_WORDS.format(_LOWER)}) AS term FROM benchmark),
    s AS (SELECT item_id, doc_id, row,
                 sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // total))))::BIGINT AS score
          FROM i JOIN t USING (term) JOIN w USING (term) JOIN e USING (row), c GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 20
    """
)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty documents that score highest for every item of the benchmark."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
