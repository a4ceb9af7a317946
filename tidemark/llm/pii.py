"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score.

Four kinds are found by fixed rules and always stay: ``email``, ``ip`` (parts
of at most 255), ``card`` (16 to 19 digits that pass Luhn) and ``phone`` (a
plus sign and 8 to 15 digits). Matches are leftmost and do not overlap within
a kind; one that fails its check is dropped and not tried again.

Three more kinds are weighed: ``iban`` (country letters, 15 to 34 characters,
remainder 1 modulo 97), ``shortcard`` (13 to 15 digits that pass Luhn) and
``localphone`` (9 to 11 digits in groups, without a plus sign). Each starts at
the value of what its checksum proves. A context word of the kind in the words
before it, or right behind it, raises the score, a word that speaks against
personal data (an order, a version, an example) lowers it; the span stays from
``LEAST_SCORE`` on. Spans of the fixed kinds have scores too, but stay at any.
A weighed span that overlaps a fixed one is dropped: it is the same data.

Every pattern is written so that no place of a text is read more than a few
times, so very long texts, and texts without a space, take linear time.

Defined cases: null and empty text has no spans; repeated rows get equal
results; ids are not read; other columns stay, but one named ``pii`` (or
``masked``, by ``mask``) is replaced; an empty table gives an empty result.
Two spans of one kind never tie, as they do not overlap.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from tidemark.llm.common import with_block_columns

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "shortcard", "localphone")
LEAST_SCORE = 0.6

# What a span of a kind is worth by itself, and the words that raise it.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.8, "iban": 0.9, "shortcard": 0.4, "localphone": 0.4}
_CALLS = "phone telephone tel mobile cell fax call telefon handy mobil anruf téléphone portable appel teléfono móvil llamar"
_CARDS = "card credit visa mastercard amex debit karte kreditkarte carte bancaire tarjeta crédito"
CONTEXT = {
    "email": "email mail contact write kontakt courriel correo",
    "ip": "ip address host server client login adresse dirección",
    "card": _CARDS, "shortcard": _CARDS, "phone": _CALLS, "localphone": _CALLS,
    "iban": "iban account bank konto compte cuenta transfer überweisung",
}
CONTEXT = {kind: frozenset(words.split()) for kind, words in CONTEXT.items()}
AGAINST = frozenset("version release order invoice isbn issn example sample test bestellung commande pedido".split())
RAISED, LOWERED = 0.3, 0.3
# Characters before and behind a span in which context words are looked for.
BEFORE, BEHIND = 48, 24

SPAN = StructType(
    [
        StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()),
        StructField("score", DoubleType()),
    ]
)

# The part behind the sign; the part before it is read backwards, so that runs without a sign cost nothing.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Possessive runs of digits that begin where no digit stands before.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_DIGITS = re.compile(r"[0-9]+(?:[ -][0-9]+)*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![\w+.-])\(?[0-9]{2,5}\)?[ ./-][0-9]{3,8}(?:[ .-][0-9]{2,4}){0,3}(?![\w-])")
_WORD = re.compile(r"[^\W\d_]+")

Found = tuple[str, int, int, float]


def _bare(text: str) -> str:
    return text.replace(" ", "").replace("-", "")


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if i % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether the first four characters moved to the end, letters as 10 to 35, leave remainder 1."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and (not part or int(part) <= 255)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0
    for found in _DOMAIN.finditer(text):
        start = at = found.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            free = found.end()
            yield start, free


def _ips(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in _IP.finditer(text) if all(map(_byte, m.groups())))


def _cards(text: str, least: int, most: int) -> Iterator[tuple[int, int]]:
    for found in _DIGITS.finditer(text):
        # Longer than any number with a separator before each digit: no need to copy it.
        if least <= found.end() - found.start() < 2 * most:
            digits = _bare(found[0])
            if least <= len(digits) <= most and luhn(digits):
                yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in _PHONE.finditer(text) if 8 <= sum(map(m[0].count, "0123456789")) <= 15)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    for found in _IBAN.finditer(text):
        bare = found[0].replace(" ", "")
        if len(bare) <= 34 and mod97(bare):
            yield found.span()


def _local_phones(text: str) -> Iterator[tuple[int, int]]:
    return (m.span() for m in _LOCAL_PHONE.finditer(text) if 9 <= sum(map(m[0].count, "0123456789")) <= 11)


def score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's own worth, raised and lowered once each by words nearby."""
    near = {w.lower() for w in _WORD.findall(f"{text[max(0, start - BEFORE) : start]} {text[end : end + BEHIND]}")}
    value = PRIOR[kind] + RAISED * (not near.isdisjoint(CONTEXT[kind])) - LOWERED * (not near.isdisjoint(AGAINST))
    return round(min(1.0, max(0.0, value)), 3)


def spans_of(text: str) -> list[Found]:
    """All spans of a text by kind, then start."""
    has_digit = re.search("[0-9]", text) is not None
    fixed = [("email", _emails(text) if "@" in text else ())]
    if has_digit:
        fixed += [("ip", _ips(text)), ("card", _cards(text, 16, 19)), ("phone", _phones(text) if "+" in text else ())]
    out = [(kind, a, b, score(text, kind, a, b)) for kind, found in fixed for a, b in found]
    if not has_digit:
        return out
    taken = sorted((a, b) for _, a, b, _ in out)
    for kind, found in (("iban", _ibans(text)), ("shortcard", _cards(text, 13, 15)), ("localphone", _local_phones(text))):
        own = []
        for a, b in found:
            worth = score(text, kind, a, b)
            if worth >= LEAST_SCORE and not _overlaps(taken, a, b):
                own.append((kind, a, b, worth))
        out += own
        taken = sorted([*taken, *((a, b) for _, a, b, _ in own)])
    return out


def _overlaps(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    # Few spans stand in a text, so they are looked through.
    return any(a < end and start < b for a, b in taken)


def scan(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``pii``: kind, start, end (code points, end exclusive) and score of every span."""

    def start():
        def block(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            values = batch.column(batch.schema.get_field_index(text)).to_pylist()
            kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
            rows = [[dict(zip(SPAN.fieldNames(), s, strict=True)) for s in spans_of(v or "")] for v in values]
            return {"pii": pa.array(rows, pa.list_(kind))}

        return block

    return with_block_columns(docs, [StructField("pii", ArrayType(SPAN))], start, () if keep_text else (text,))


def mask(found: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """``found`` with ``masked``: every span in ``[kind]``, the rest of the text as it is; of nested spans the outer."""
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("behind"), s["kind"].alias("kind")))
    )
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, span: Column) -> Column:
        before = F.substring(F.col(text), state["at"].cast("int") + 1, (span["start"] - state["at"]).cast("int"))
        taken = F.struct(
            F.concat(state["done"], before, F.lit("["), span["kind"], F.lit("]")).alias("done"), (-span["behind"]).alias("at")
        )
        return F.when(span["start"] >= state["at"], taken).otherwise(state)

    rest = lambda state: F.concat(state["done"], F.substring(F.col(text), state["at"].cast("int") + 1, F.length(text)))
    masked = F.when(F.size(spans) > 0, F.aggregate(ordered, start, step, rest)).otherwise(F.col(text))
    return found.withColumn("masked", masked)


def listed(spans: str | Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of ``kinds``, as they stand, comma-joined."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per document: counts of the fixed kinds, hash of their spans, all spans, the others' number and the highest score."""
    count = lambda kinds: F.size(F.filter("pii", lambda s: s["kind"].isin(*kinds))).cast("long")
    return found.select(
        F.col(id_column),
        *(count([kind]).alias(f"n_{kind}") for kind in BASE),
        F.sha2(listed("pii", BASE), 256).alias("base_sha256"),
        listed("pii").alias("spans"),
        count(KINDS[len(BASE) :]).alias("n_weighed"),
        F.coalesce(F.array_max(F.transform("pii", lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )
