"""Line deduplication across documents by deletion neighbourhoods.

A line (white space at its ends removed) goes if an earlier line of the
corpus, by id, content and place, equals it, or, from ``MIN_CHARS`` characters
on, is one edit away: a character put in, left out or changed. The earliest
stays. The bound of one edit is part of the method's keys and no parameter;
lines two edits apart both stay.

Equal lines are folded first. For the others, two lines one edit apart have
equal text before and behind one place. Leaving out every single character in
turn and hashing what is left, together with the place, gives equal keys to
exactly such lines: a changed character is left out of both, an extra one out
of the longer, while the shorter stands for itself at every place. All lines
under one key are one edit apart from each other, so each is compared with the
earliest only and no pairs are made.

Equal lines need ``exact_chars`` characters only; by default a single one.

Emitting a variant per character of the corpus would be too much, so the place
is narrowed down before: the same keys are made leaving out one half of the
line, then one of about sqrt(n) pieces of that half, and only lines that share
a key with another line go on. No pair is lost by that, as the edit lies in one
piece and all else is equal. A pair is told by the length of its shorter line,
so each line makes keys for its own length and for one less.

Only column expressions are used. Texts are shuffled once, to fetch the lines
that share half with another, and once more if cleaned texts are asked for.

Defined cases: a null text has no lines; rows with a null id take no part and
stay as they are; repeated rows are one document and get equal results; rows
with one id and different texts are different documents, ordered by the hash
of their text; blank lines always stay; a very long text is one row like any
other, its lines are compared whole; ties can't be, as no two lines begin at
one place; other columns stay; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

# Characters of the shortest lines that are compared for one edit; equal lines are told at any length.
MIN_CHARS, EXACT_CHARS = 10, 1
# Occurrences from which a line can be hot, and tasks that a hot line is dealt to.
HOT_TIMES, DEALS = 1000, 64
BLANKS = " \\t\\r"

_KEY = ["id", "content"]


def _lines(text: str = "text") -> Column:
    return F.expr(f"transform(split({text}, '\\n', -1), l -> trim(BOTH '{BLANKS}' FROM l))")


def _half_keys() -> Column:
    """Keys with half 0 or 1 left out, for a shorter line of n characters, then of n - 1."""
    keys = lambda m: (
        f"xxhash64({m}, 0, right(line, {m} - {m} div 2)), xxhash64({m}, 1, left(line, cast({m} div 2 as int)))"
    )
    return F.expr(f"array({keys('n')}, {keys('(n - 1)')})")


def _least(min_chars: int, exact_chars: int) -> int:
    """Characters of the shortest lines that take part; blank ones never do."""
    return max(1, min(exact_chars, min_chars))


def _occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """id, content, place and text of every line that takes part."""
    return (
        docs.where("id IS NOT NULL AND text IS NOT NULL")
        # Outer, here and below: else the list would be computed a second time, to filter on its size.
        .select("id", F.xxhash64("text").alias("content"), F.posexplode_outer(_lines()).alias("at", "line"))
        .where(F.length("line") >= min_chars)
        .withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), "line")})
    )


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key another line has too."""
    several = rows.groupBy(key).agg(F.count("*").alias("lines")).where("lines > 1").select(key)
    return rows.join(several, key)


def _near_earlier(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """``first`` of the lines one edit away from an earlier one; it names a line, as no other begins there."""
    # Most lines share no half, so only the rows of those that do are fetched for what else is known of them.
    halves = distinct.select("h1", F.posexplode("halves").alias("which", "key"))
    wanted = (
        _shared(halves, "key")
        .join(distinct.select("h1", "first", "n"), "h1")
        .withColumns({"m": F.expr("n - which div 2"), "j": F.expr("which % 2")})
        .groupBy("first.id", "first.content")
        .agg(F.collect_list(F.struct("first", "m", "j", "key")).alias("wanted"))
    )
    texts = docs.where("id IS NOT NULL AND text IS NOT NULL").withColumn("content", F.xxhash64("text"))
    # One line of text per wanted line; repeated rows give it twice.
    fetched = (
        texts.join(wanted, _KEY)
        .select("wanted", _lines().alias("lines"))
        .select("lines", F.explode("wanted").alias("w"))
        .select("w.*", F.expr("element_at(lines, w.first.at + 1)").alias("line"))
        # What is left out of the line, and its length in the shorter line.
        .withColumn("r", F.expr("cast(if(j = 0, m div 2, m - m div 2) as int)"))
        .withColumn(
            "rest",
            F.expr("if(j = 0, left(line, cast(length(line) - (m - m div 2) as int)), substring(line, cast(m div 2 as int) + 1))"),
        )
        .withColumn("longer", F.expr("length(line) > m"))
        .select("first", "key", "r", "rest", "longer")
        .dropDuplicates(["first", "key"])
    )
    pieces = stored(
        fetched.withColumn("b", F.expr("cast(greatest(ceil(sqrt(r)), 1) as int)"))
        .select("*", F.explode(F.expr("sequence(0, b - 1)")).alias("i"))
        .withColumn("low", F.expr("cast(cast(i as bigint) * r div b as int)"))
        .withColumn("high", F.expr("cast((cast(i as bigint) + 1) * r div b as int)"))
        .select(
            "first", "longer",
            F.expr("xxhash64(key, i, left(rest, low), right(rest, r - high))").alias("key"),
            F.expr("substring(rest, low + 1, length(rest) - low - (r - high))").alias("rest"),
        )
    )
    without = "concat(left(rest, p), substring(rest, p + 2))"
    every = "sequence(0, length(rest) - 1)"
    variants = F.expr(
        f"if(longer, transform({every}, p -> xxhash64(key, 'extra', p, {without})), "
        f"concat(if(length(rest) > 0, transform({every}, p -> xxhash64(key, 'changed', p, {without})), "
        "cast(array() as array<bigint>)), "
        "transform(sequence(0, length(rest)), p -> xxhash64(key, 'extra', p, rest))))"
    )
    emitted = (
        _shared(pieces, "key")
        .where("not longer or length(rest) > 0")
        .select("first", "rest", F.explode_outer(variants).alias("variant"))
        .where("variant IS NOT NULL")
    )
    earliest = emitted.groupBy("variant").agg(F.min(F.struct("first", "rest")).alias("one"))
    return (
        emitted.join(earliest, "variant")
        .where(F.col("first") > F.col("one.first"))
        .where(F.levenshtein("rest", "one.rest") <= 1)
        .select("first")
        .distinct()
    )


def _named(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    return docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))


def removals(
    docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, exact_chars: int = EXACT_CHARS
) -> DataFrame:
    """``id``, ``content`` (hash of the text) and ``removed``, the places of the lines that go, where any do."""
    own = _named(docs, id_column, text)
    lines = _occurrences(own, _least(min_chars, exact_chars))
    distinct = stored(
        lines.withColumn("n", F.length("line"))
        .withColumn("halves", F.when(F.col("n") >= min_chars, _half_keys()))
        .groupBy("h1", "h2")
        .agg(
            F.min(F.struct("id", "content", "at")).alias("first"),
            F.count("*").alias("times"),
            F.first("n").alias("n"),
            F.first("halves").alias("halves"),
        )
    )
    near = _near_earlier(own, distinct.where(F.col("n") >= min_chars)).withColumn("near", F.lit(True))
    marked = distinct.select("h1", "h2", "first", "times").join(near, "first", "left")
    bad = marked.where("near OR times > 1").select("h1", "h2", "first", "near", "times")
    # Lines with more than a thousandth of all occurrences are dealt to many tasks; so there are at most a thousand.
    total = distinct.agg(F.sum("times").alias("n")).first().n or 0
    is_hot = (F.col("times") > HOT_TIMES) & (F.col("times") * 1000 > total)
    hot = distinct.where(is_hot).select("h1", "h2", F.lit(True).alias("hot"))
    deal = F.when(F.col("hot"), F.pmod(F.xxhash64("id", "at"), F.lit(DEALS))).otherwise(0).alias("deal")
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(DEALS - 1))).otherwise(F.array(F.lit(0)))
    return (
        lines.select(*_KEY, "at", "h1", "h2")
        .join(F.broadcast(hot), ["h1", "h2"], "left")
        .select(*_KEY, "at", "h1", "h2", deal)
        .join(bad.withColumn("deal", F.explode(every)).drop("times"), ["h1", "h2", "deal"])
        .where(F.coalesce("near", F.lit(False)) | (F.struct("id", "content", "at") > F.col("first")))
        .groupBy(*_KEY)
        .agg(F.array_sort(F.collect_set("at")).alias("removed"))
    )


def dedup(
    docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, exact_chars: int = EXACT_CHARS
) -> DataFrame:
    """``docs`` with the lines taken out of ``text``, and ``n_removed``."""
    gone = removals(docs, id_column=id_column, text=text, min_chars=min_chars, exact_chars=exact_chars).alias("g")
    own = docs.alias("d")
    joined = own.join(
        gone,
        (F.col(f"d.`{id_column}`") == F.col("g.id")) & (F.xxhash64(F.col(f"d.`{text}`")) == F.col("g.content")),
        "left",
    )
    # The outer transform only names the lines, so that the text is split once.
    left = F.expr(
        f"transform(array(split(d.`{text}`, '\\n', -1)), lines -> array_join(transform("
        f"array_except(sequence(0, size(lines) - 1), g.removed), i -> lines[i]), '\\n'))[0]"
    )
    cleaned = F.when(F.col("g.removed").isNull(), F.col(f"d.`{text}`")).otherwise(left)
    return joined.select(
        *(cleaned.alias(c) if c == text else F.col(f"d.`{c}`") for c in docs.columns if c.lower() != "n_removed"),
        F.coalesce(F.size("g.removed"), F.lit(0)).cast("long").alias("n_removed"),
    )


def digest(
    docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, exact_chars: int = EXACT_CHARS
) -> DataFrame:
    """One row per document: id, ``n_lines`` that take part, ``n_removed``, and ``removed`` as places, comma-joined."""
    own = _named(docs, id_column, text)
    counted = own.select(
        "id",
        F.xxhash64("text").alias("content"),
        F.coalesce(F.size(F.filter(_lines(), lambda x: F.length(x) >= _least(min_chars, exact_chars))), F.lit(0)).alias("n_lines"),
    ).withColumn("n_lines", F.greatest("n_lines", F.lit(0)).cast("long"))
    gone = removals(docs, id_column=id_column, text=text, min_chars=min_chars, exact_chars=exact_chars)
    return counted.join(gone, _KEY, "left").select(
        F.col("id").alias(id_column),
        "n_lines",
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed"),
    )
