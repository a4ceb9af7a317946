"""Secret scans: fixed patterns, and tokens that look random to a pair of Markov models.

Both models are first-order over the characters of tokens: one of random
strings, one of ordinary identifiers, trained from labelled samples by counting
neighbouring characters, mixed with the chances behind a kind of character. A token is a secret
if its log-likelihood ratio, in total and per character, is high enough.

All of it is column expressions; the texts are neither joined nor shuffled.
The ratios are at most (alphabet + 1) squared numbers and travel as a constant.

Defined cases: null and empty text has no spans; repeated rows get equal
results; other columns stay, but those with names of the results are replaced;
an empty table gives an empty result; without samples all ratios are 0 and no
token is a secret. Places are code points, ends exclusive. Per kind the
matches are leftmost and don't overlap. A token inside a span of a pattern is
not listed once more; one that reaches beyond it is. Very long texts and
tokens are looked at whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

# The patterns of the kinds, in the order in which equal starts are listed.
VALUE = "[A-Za-z0-9+/_.=-]+"
ASSIGN = rf"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?({VALUE})"""
ACCESS = "(AKIA[A-Z0-9]+)"
HEX = "([0-9a-f]+)"
TOKEN = "([A-Za-z0-9+/_=-]{12,})"
# Kind: pattern, a cheaper condition that a text with such a secret meets, least length of the value.
KINDS = {
    "assign": (ASSIGN, "(?i:password|passwd|secret|token|api_?key)", 12),
    "access": (ACCESS, "AKIA", 18),
    "hex": (HEX, "[0-9a-f]{16}", 16),
}

ALPHABET = "+-/0123456789=ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"
# Ratios are kept in thousandths.
UNIT = 1000
# Least log-likelihood ratio of a secret, in total and per pair of characters.
LEAST_TOTAL, LEAST_MEAN = 10.0, 1.0
# Weight of the chances of a character behind any of the kind (small, capital, digit, other) of the one before it.
BACKOFF = 0.3
# Words of names in code: labelled samples of ordinary identifiers, besides those of the texts.
CODE_WORDS = (
    "account action adapter address application argument array attribute balance block body bool boolean bridge "
    "build bundle byte calendar callback cell channel char check class cluster code collection column command "
    "component config container context controller convert count create current cursor data date debug default "
    "delete descriptor dialog directory document domain double driver dump element email enable engine entity enum "
    "error exception execute export factory field file filter find flag folder format frame function generic group "
    "height helper host icon import info init input insert int interface item iterator job label layer layout length "
    "level library line link loader location log loop manager mapper matrix memory menu message method metric model "
    "module monitor mutex name network null number object offset open option order output page panel parent password path "
    "payload plugin point policy port position primary print process product profile property protocol queue query random "
    "record"
)
# Texts at most that give samples.
SAMPLE_TEXTS = 2000

_SPANS = "array<struct<start:bigint,ord:int,kind:string,end:bigint>>"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def matches(text: str, pattern: str, condition: str) -> Column:
    """``gap`` (length before it), ``hit`` and ``value`` (the group of ``pattern``) of every match.

    ``text`` is a column's name. Each match begins where the last one ended
    (\\G), so that the rest behind the last match is looked through once.
    """
    whole = _quoted(rf"\G[\s\S]*?({pattern})")
    parts = ", ".join(f"regexp_extract_all({text}, {whole}, {i})" for i in (0, 1, 2))
    none = "cast(array() as array<struct<gap:int,hit:string,value:string>>)"
    return F.expr(
        f"if({text} rlike {_quoted(condition)}, transform(arrays_zip({parts}), x -> named_struct("
        f"'gap', length(x['0']) - length(x['1']), 'hit', x['1'], 'value', x['2'])), {none})"
    )


def spans(found: str, kind: str, order: int, accepted: str) -> Column:
    """Spans of the accepted matches (an expression of ``x``) of column ``found``."""
    begin = "s.at + x.gap"
    span = f"named_struct('start', {begin}, 'ord', {order}, 'kind', '{kind}', 'end', {begin} + length(x.hit))"
    return F.expr(
        f"aggregate({found}, named_struct('at', 0L, 'out', cast(array() as {_SPANS})), "
        f"(s, x) -> named_struct('at', {begin} + length(x.hit), "
        f"'out', if({accepted}, concat(s.out, array({span})), s.out)), s -> s.out)"
    )


@dataclass(frozen=True)
class Model:
    """``ratios``: per pair of characters, log of random over ordinary in thousandths, rows by the first."""

    ratios: tuple[int, ...]

    def ratio(self, token: str) -> str:
        """Expression for the total of ``token``, an expression itself, in thousandths."""
        place = lambda at: f"locate(substring({token}, {at}, 1), '{ALPHABET}')"
        table = ",".join(map(str, self.ratios))
        return (
            f"aggregate(sequence(1, greatest(length({token}) - 1, 1)), 0L, "
            f"(t, i) -> t + array({table})[{place('i')} * {len(ALPHABET) + 1} + {place('i + 1')}])"
        )


def _kind(character: str) -> int:
    return 0 if character.islower() else 1 if character.isupper() else 2 if character.isdigit() else 3


def train(samples: DataFrame) -> Model:
    """A model from ``samples`` (token, random). The driver gets one count per label and pair of characters."""
    pairs = samples.where("length(token) > 1").select(
        "random",
        # Outer: else the pairs would be made a second time, to filter on their number.
        F.explode_outer(F.expr("transform(sequence(1, length(token) - 1), i -> substring(token, i, 2))")).alias("pair"),
    )
    counts: dict[tuple[bool, int, int], int] = {}
    place = lambda c: ALPHABET.find(c) + 1
    for random, pair, count in pairs.where(f"pair rlike '^[{ALPHABET.replace('-', '')}-]{{2}}$'").groupBy(
        "random", "pair"
    ).count().collect():
        counts[random, place(pair[0]), place(pair[1])] = count
    size = len(ALPHABET) + 1
    if not counts:
        return Model((0,) * size**2)
    every = range(size)
    first = {(label, a): sum(counts.get((label, a, b), 0) for b in every) for label in (True, False) for a in every}
    kind = [_kind(c) for c in " " + ALPHABET]
    behind: dict[tuple[bool, int, int], float] = {}
    for (label, a, b), n in counts.items():
        behind[label, kind[a], b] = behind.get((label, kind[a], b), 0) + n
    total = {(label, k): sum(behind.get((label, k, b), 0) for b in every) for label in (True, False) for k in range(4)}

    def chance(label: bool, a: int, b: int) -> float:
        alone = (behind.get((label, kind[a], b), 0) + 0.5) / (total[label, kind[a]] + 0.5 * size)
        seen = counts.get((label, a, b), 0) / first[label, a] if first[label, a] else alone
        return (1 - BACKOFF) * seen + BACKOFF * alone

    return Model(tuple(round(UNIT * math.log(chance(True, a, b) / chance(False, a, b))) for a in every for b in every))


def labelled_samples(docs: DataFrame, text: str = "text", id_column: str = "doc_id", limit: int = SAMPLE_TEXTS) -> DataFrame:
    """Tokens with labels from at most ``limit`` texts, chosen by the hash of their ids.

    Random: values of the fixed patterns, and digests of the ids in the usual
    alphabets. Ordinary: all other tokens, as written and in both cases, and
    names made of neighbouring words.
    """
    own = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).where("id IS NOT NULL")
    own = own.withColumn("content", F.xxhash64("text"))
    # Distinct texts, as one id can stand on any number of rows.
    chosen = own.select("id", "content").distinct().orderBy(F.xxhash64("id"), "id", "content").limit(limit)
    sample = own.join(F.broadcast(chosen), ["id", "content"], "left_semi")
    known = stored(sample.groupBy("id", "content").agg(F.first("text").alias("text")))
    for kind, (pattern, condition, _) in KINDS.items():
        known = known.withColumn(kind, matches("text", pattern, condition))
    value = F.expr(
        "concat(" + ", ".join(
            f"transform(filter({k}, x -> length(x.value) >= {least}), x -> x.value)" for k, (_, _, least) in KINDS.items()
        ) + ")"
    )
    known = stored(known.select("text", value.alias("secrets")))
    secret = known.select(F.explode_outer("secrets").alias("token"))
    digest = F.unhex(F.sha2(F.col("id").cast("string"), 512))
    letters = F.base64(digest)
    alphabets = F.array(
        letters, F.lower(F.hex(digest)), F.upper(letters), F.lower(letters), F.regexp_replace(letters, "[^A-Za-z0-9]", "")
    )
    made = chosen.select("id").distinct().select(F.explode(alphabets).alias("token"))
    plain = known.select(
        F.explode_outer(F.array_except(F.expr("regexp_extract_all(text, '[A-Za-z0-9+/_=-]{3,}', 0)"), "secrets")).alias("token")
    ).where("token not rlike '[0-9a-f]{16}|AKIA[A-Z0-9]{14}'")
    cased = plain.select(F.explode(F.array("token", F.lower("token"), F.upper("token"))).alias("token"))
    return secret.union(made).select("token", F.lit(True).alias("random")).union(
        cased.union(identifiers(known)).select("token", F.lit(False).alias("random"))
    )


def identifiers(texts: DataFrame) -> DataFrame:
    """``token``: names as code has them, of two to four words that follow each other in ``texts`` (text), once a text.

    ``CODE_WORDS`` are a text of their own, once in the order given and eight times in other ones.
    """
    code = texts.sparkSession.range(9).select(
        F.expr(f"array_join(transform(array_sort(transform(split('{CODE_WORDS}', ' '), (w, i) -> "
               "struct(if(id = 0, i, xxhash64(w, id)) AS at, w AS w))), x -> x.w), ' ')").alias("text")
    )
    texts = texts.select("text").union(code)
    groups = texts.select(F.expr("regexp_extract_all(text, '[A-Za-z]{2,}', 0)").alias("w")).where("size(w) > 1").select(
        F.explode(
            F.expr("array_distinct(transform(sequence(1, size(w) - 1, 3), i -> transform(slice(w, i, 2 + int(i / 3) % 3), p -> lower(p))))")
        ).alias("g")
    )
    title = "array_join(transform(g, p -> initcap(p)), '')"
    forms = [
        "array_join(g, '_')", "upper(array_join(g, '_'))", "array_join(g, '-')", "array_join(g, '/')", "array_join(g, '')",
        title, f"concat(g[0], substring({title}, length(g[0]) + 1))",
    ]
    return groups.select(F.explode(F.expr(f"array({', '.join(forms)})")).alias("token"))


def scan(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: arrays of (start, ord, kind, end) by start, then kind."""
    kept = [c for c in docs.columns if c.lower() not in ("base_spans", "spans")]
    out = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row")).withColumn(
        "text", F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    )
    for kind, (pattern, condition, _) in KINDS.items():
        out = out.withColumn(f"found_{kind}", matches("text", pattern, condition))
    out = out.withColumn("found_markov", matches("text", TOKEN, TOKEN))
    every = [spans(f"found_{k}", k, i, f"length(x.value) >= {least}") for i, (k, (_, _, least)) in enumerate(KINDS.items())]
    accepted = (
        f"element_at(transform(array({model.ratio('x.value')}), r -> r >= {round(LEAST_TOTAL * UNIT)} "
        f"and r >= {LEAST_MEAN * UNIT} * (length(x.value) - 1)), 1)"
    )
    return (
        out.select("row", F.array_sort(F.concat(*every)).alias("base_spans"),
                   spans("found_markov", "markov", len(KINDS), accepted).alias("others"))
        .withColumn(
            "spans",
            F.expr(
                "array_sort(concat(base_spans, filter(others, m -> "
                "not exists(base_spans, b -> b.start <= m.start and m.end <= b.end))))"
            ),
        )
        .select(*(F.col(f"row.`{c}`").alias(c) for c in kept), "base_spans", "spans")
    )


def listed(found: str) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.expr(f"array_join(transform({found}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")
