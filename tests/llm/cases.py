"""Awkward rows that every operator has to take."""

from __future__ import annotations

LONG = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu. " * 3000

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from here.", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs far away from here.", "en", "b"),
    (3, "THE QUICK BROWN FOX jumps over the lazy dog and runs far away from here.", "en", "a"),
    (4, None, "en", "a"),
    (5, "", None, None),
    (6, " \n\t ", "en", None),
    (7, LONG, "en", "a"),
    (8, LONG + "end", "en", "a"),
    (9, "one", "en", "c"),
    (9, "one", "en", "c"),
    (9, "two words", "en", "c"),
    (None, "no id here but words enough to make a few shingles of them", "en", "a"),
    (None, "one", None, "d"),
    (12, "naïve café 漢字 😀 İstanbul ǅ ß", "fr", "ü"),
    (-3, "one", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
# Extra columns under names that the operators use inside.
CLASH = (
    "n long, fp binary, key string, row string, size long, score double, h long, doc long, no int, line string, "
    "id long, x string, order long, value string, n_chars long, keep_id long, taken long"
)


def docs(spark, rows=ROWS, clash=True):
    if not clash:
        return spark.createDataFrame(rows, SCHEMA)
    width = len(CLASH.split(","))
    return spark.createDataFrame([(*r, *[None] * width) for r in rows], f"{SCHEMA}, {CLASH}")


def rows(df, *columns):
    """Rows as tuples in an order that bears nulls."""
    out = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])
