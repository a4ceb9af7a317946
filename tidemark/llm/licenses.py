"""License scans by diagonal voting.

Rolling hashes of four words of every text are joined to their places in
license templates. A match votes for the diagonal (place in the text minus
place in the template). Neighbouring diagonals are merged, and a merged group
is a license if enough of the template's places are matched within a span that
is not much longer than the template.

All of it is DataFrame operations. The templates' grams are at most
``MAX_GRAMS`` rows, which is checked, and broadcast; texts are read once and
never shuffled, only matches and counts are.

Licenses of one family share most of their words, so that a text can bear the
labels of two of them (the notice of the LGPL is close to the GPL's).

Defined cases: null and empty text has no words, no labels and score 0;
repeated rows get equal results; other columns are ignored; an empty table
gives an empty result; very long texts are looked at whole; a license that
stands in a text several times is found as often; a template of fewer than
four words is never found.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.license_texts import EVERY, TEMPLATES, WHOLE  # noqa: F401

# Phrases with their labels, as words in lower case.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 4
MAX_GRAMS = 100_000
# Diagonals this close are one, for words put in or left out.
NEAR = 3
# Least part of a template that must be matched, and how much longer the span may be.
LEAST_COVER, STRETCH = 0.6, 1.5


def _words(text: str) -> Column:
    # Letters beyond ASCII are lowered too; none of them becomes a word of a phrase or leaves a word.
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD), F.lit(0))


def _grams(words: str) -> Column:
    parts = ", ".join(f"{words}[i + {j}]" for j in range(GRAM))
    return F.expr(
        f"if(size({words}) >= {GRAM}, transform(sequence(0, size({words}) - {GRAM}), i -> xxhash64({parts})), "
        "cast(array() as array<bigint>))"
    )


def _places(words: str) -> Column:
    """Start and label of every phrase in an array of words."""
    cases = []
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        # try_element_at is null behind the end, which is no match.
        same = " and ".join(f"try_element_at({words}, i + {j + 1}) = '{w}'" for j, w in enumerate(parts))
        cases.append(f"when {same} then '{label}'")
    lasts = " or ".join(f"array_contains({words}, '{w}')" for w in sorted({p.split()[-1] for p in PHRASES}))
    none = "cast(array() as array<struct<at:int,label:string>>)"
    return F.expr(
        f"if({lasts}, filter(transform(sequence(0, greatest(size({words}) - 1, 0)), "
        f"i -> named_struct('at', i, 'label', case {' '.join(cases)} end)), x -> x.label is not null), {none})"
    )


def template_grams(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """``template``, ``label``, ``length`` in grams, ``place`` and ``gram`` of every template."""
    rows = spark.createDataFrame(
        [(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, text string"
    )
    grams = rows.withColumn("words", _words("text")).withColumn("grams", _grams("words"))
    return grams.select(
        "template", "label", F.size("grams").alias("length"), F.posexplode("grams").alias("place", "gram")
    )


def scan(
    docs: DataFrame,
    templates: list[tuple[str, str]] | None = None,
    *,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: id, ``n_words``, ``places`` of the phrases, and ``found``.

    ``found`` lists each license of the templates by label: its first word,
    the word after its last, and the part of the template that is matched.
    """
    templates = EVERY if templates is None else templates
    if sum(len(re.findall(WORD, t)) for _, t in templates) > MAX_GRAMS:
        raise ValueError(f"templates have more than {MAX_GRAMS} words")
    known = F.broadcast(template_grams(docs.sparkSession, templates))
    own = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    keyed = own.select("id", F.xxhash64("id", "text").alias("row"), _words("text").alias("words"))
    grams = keyed.select(
        "id", "row", F.size("words").cast("long").alias("n_words"), _places("words").alias("places"),
        _grams("words").alias("grams"),
    )
    # The texts are read once: a first, empty gram carries what is known of the row, the others are kept if they match.
    first = F.expr("concat(array(cast(null as bigint)), grams)")
    kept = stored(
        # Outer: else a filter on the whole list of grams would be made and pushed into the splitting of words.
        grams.select("*", F.posexplode_outer(first).alias("nth", "gram"))
        .join(known, "gram", "left")
        .where("nth = 0 OR template IS NOT NULL")
        .select(
            "row", "nth", "template", "label", "length", "place",
            *(F.when(F.col("nth") == 0, F.col(c)).alias(c) for c in ("id", "n_words", "places")),
        )
    )
    matches = kept.where("nth > 0").select("row", "template", "label", "length", "place", F.expr("nth - 1").alias("at"))
    return _voted(kept.where("nth = 0").select("id", "row", "n_words", "places"), matches.distinct(), id_column)


def _voted(rows: DataFrame, matches: DataFrame, id_column: str) -> DataFrame:
    diagonals = matches.groupBy("row", "template", "label", "length", F.expr("at - place").alias("diagonal")).agg(
        F.collect_set("place").alias("places"), F.min("at").alias("first"), F.max("at").alias("last")
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    new = F.col("diagonal") - F.lag("diagonal").over(along) > NEAR
    groups = diagonals.withColumn("new", F.coalesce(new.cast("int"), F.lit(0))).withColumn(
        "nth", F.sum("new").over(along)
    )
    merged = groups.groupBy("row", "template", "label", "length", "nth").agg(
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        F.min("first").alias("first"),
        (F.max("last") + GRAM).alias("end"),
    )
    cover = F.size("places") / F.col("length")
    verified = merged.where(cover >= LEAST_COVER).where(
        F.col("end") - F.col("first") <= STRETCH * (F.col("length") + GRAM - 1)
    )
    found = verified.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("label", "first", "end", cover.alias("cover")))).alias("found")
    )
    return rows.join(found, "row", "left").select(
        F.col("id").alias(id_column),
        "n_words",
        "places",
        F.coalesce("found", F.expr("cast(array() as array<struct<label:string,first:int,end:int,cover:double>>)")).alias("found"),
    )


def digest(scanned: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts, labels and score of each document."""
    joined = lambda labels: f"array_join(array_sort(array_distinct({labels})), ',')"
    base, own = "transform(places, p -> p.label)", "transform(found, f -> f.label)"
    cover = "array_max(concat(array(0.0D), transform(found, f -> f.cover)))"
    return scanned.select(
        id_column,
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.expr("cast(array_min(transform(places, p -> p.at)) as bigint)").alias("first_word"),
        F.expr("cast(array_max(transform(places, p -> p.at)) as bigint)").alias("last_word"),
        F.expr(joined(base)).alias("base_labels"),
        F.expr(joined(f"concat({base}, {own})")).alias("labels"),
        F.expr(f"greatest({cover}, if(size(places) > 0, 0.5D, 0.0D))").alias("score"),
    )
