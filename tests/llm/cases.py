"""Rows that every operator has to bear."""

from __future__ import annotations

LONG = "lorem ipsum dolor sit amet " * 8000
COPY = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"

# Columns whose names operators use inside, filled with what they would not expect.
CLASHING = "id string, content string, class string, n string, row string, found string, key string, removed string"

TEXTS = [None, "", " \n\t ", "word", "\x00 é́ \U0001f600 ß", LONG, LONG + "end", COPY, COPY, COPY + " fifteen", "!!! ###"]


def documents(spark, texts=TEXTS, *, repeated=True):
    """Texts with nulls in every column, a null id, a repeated row and clashing extra columns."""
    rows = [(i, t, "en" if i % 2 else "fr", "src0" if i % 3 else None) for i, t in enumerate(texts)]
    rows.append((None, "a text without an id", None, None))
    if repeated:
        rows.append(rows[min(7, len(texts) - 1)])
    rows = [(*r, *("x" if (r[0] or 0) % 2 else None for _ in CLASHING.split(","))) for r in rows]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {CLASHING}")


def empty(spark):
    return documents(spark).where("false")


def by_id(df, key="doc_id"):
    """Rows by id; equal rows once."""
    out = {}
    for row in df.collect():
        assert out.setdefault(row[key], row) == row
    return out
