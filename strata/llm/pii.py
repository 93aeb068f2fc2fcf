"""Personal data in texts: patterns propose, checksums confirm, context adjusts.

Everything is column expressions; no Python runs in tasks and nothing is
shuffled. Per kind, ``regexp_replace`` puts a marker around every match and
``split`` cuts the text there, so the pieces are text and match in turn and
their lengths give the positions in code points. (The marker is a control
character that no pattern can match; one in the text itself is first replaced
by another of the same length.)

Patterns are written with possessive quantifiers and start only where a run
of their first class starts (or where the last match ended). They match what
the plain greedy patterns match, in time linear in the text and without
recursion on long runs. Where an IBAN ends cannot be read off its characters
(a capital or numeric word may follow), so its pattern proposes beginnings only:
of the prefixes that end with a word and pass mod-97 the one of its country's
length is taken, else the longest.

Kinds: ``email``, ``ip`` (parts up to 255), ``card`` (13 to 19 digits, Luhn),
``phone`` (9 to 15 digits); beyond these ``iban`` (mod-97) and ``secret``
(32 to 64 hexadecimal digits; needs a context word). Each span has a score:
the kind's prior, raised by a checksum and by whole words (or their plural with
s) among the ``CONTEXT`` characters before the match that speak of the kind; a
word that this window may cut does not count. The four base kinds are always reported; the others from
``THRESHOLD``.

Defined results: a null text counts as empty, an empty text has no spans;
equal rows have equal results; nothing depends on other columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_name

MARK, OTHER = "\u0001", "\u0002"
CONTEXT = 48
THRESHOLD = 0.5


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str           # characters of which a text must hold one, as a regex class
    prior: float
    confirmed: float     # added when a checksum confirms
    words: tuple         # context words
    base: bool = True


KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "[@]", 0.8, 0.0, ("mail", "email", "contact", "write", "kontakt", "correo", "courriel")),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "[0-9]", 0.6, 0.0,
         ("ip", "host", "server", "address", "adresse")),
    Kind("card", r"[0-9]++(?:[ -]?[0-9]++)*+", "[0-9]", 0.4, 0.4,
         ("card", "visa", "credit", "karte", "tarjeta", "carte")),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "[+]", 0.6, 0.0,
         ("phone", "telephone", "telefon", "call", "tel", "mobile", "fax")),
    Kind("iban", r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2} ?[A-Z0-9])", "[0-9]", 0.2, 0.6,
         ("iban", "account", "konto", "kontonummer", "cuenta", "compte", "bank"), base=False),
    Kind("secret", r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![A-Za-z0-9])", "[0-9]", 0.3, 0.0,
         ("token", "secret", "key", "apikey", "password", "passwd", "credential"), base=False),
)
IBAN_RUN = "^[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}"
IBAN_LONGEST = 2 * 34 - 1
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "PT", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}
BASE = tuple(k.name for k in KINDS if k.base)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _letters(c: Column) -> Column:
    """The characters of a text, one by one."""
    return F.filter(F.split(c, ""), lambda x: F.length(x) > 0)


def luhn(digits: Column) -> Column:
    """From the right, every second digit counts double (less 9 if over 9); the sum ends in 0."""
    total = F.aggregate(
        _letters(F.reverse(digits)), F.struct(F.lit(0).alias("sum"), F.lit(False).alias("twice")),
        lambda acc, d: F.struct(
            (acc["sum"] + F.when(acc["twice"], F.try_element_at(
                F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1))
             .otherwise(d.cast("int"))).alias("sum"), (~acc["twice"]).alias("twice")))
    return total["sum"] % 10 == 0


def mod97(iban: Column) -> Column:
    """Four leading characters moved to the end, letters as 10 to 35: the number leaves 1 by 97."""
    moved = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    value = F.aggregate(
        _letters(moved), F.lit(0),
        lambda acc, x: F.when(x.between("0", "9"), (acc * 10 + F.ascii(x) - 48) % 97)
        .otherwise((acc * 100 + F.ascii(x) - 55) % 97))
    return value == 1


def _small_part(p: Column) -> Column:
    """A decimal number of at most 255, however many leading zeros."""
    bare = F.regexp_replace(p, "^0+(?=[0-9])", "")
    return (F.length(bare) <= 3) & (bare.try_cast("int") <= 255)


def _valid(kind: Kind, match: Column) -> Column:
    """Whether a proposed match holds."""
    if kind.name == "ip":
        return F.forall(F.split(match, r"\."), _small_part)
    if kind.name == "card":
        digits = F.translate(match, " -", "")
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(F.lit(False))
    if kind.name == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _proposed(text: Column, kind: Kind) -> Column:
    """All matches of the kind's pattern as array of (start, end, match, before)."""
    marked = F.regexp_replace(text, f"({kind.pattern})", f"{MARK}$1{MARK}")
    pieces = F.split(marked, MARK)
    none = F.lit(None).cast("array<struct<start:int,end:int,match:string,before:string>>")
    walked = F.aggregate(
        pieces,
        F.struct(F.lit(0).alias("at"), F.lit(False).alias("hit"), F.lit("").alias("before"),
                 F.coalesce(none, F.array()).alias("found")),
        lambda acc, piece: F.struct(
            (acc["at"] + F.length(piece)).alias("at"), (~acc["hit"]).alias("hit"),
            F.right(piece, F.lit(CONTEXT)).alias("before"),
            F.when(acc["hit"], F.concat(acc["found"], F.array(F.struct(
                acc["at"].alias("start"), (acc["at"] + F.length(piece)).alias("end"),
                piece.alias("match"), acc["before"].alias("before")))))
            .otherwise(acc["found"]).alias("found")))
    return F.when(text.rlike(kind.needs), walked["found"]).otherwise(F.coalesce(none, F.array()))


def _iban_length(head: Column) -> Column:
    """The length of the IBAN that the text starts with, null without one."""
    run = F.regexp_extract(head, IBAN_RUN, 0)
    bare = lambda n: F.translate(F.left(run, n), " ", "")
    usual = F.coalesce(*[F.when(F.left(head, F.lit(2)).isin(*codes.split()), n) for n, codes in IBAN_LENGTHS.items()])
    ends = F.when(F.length(run) >= 15, F.filter(
        F.sequence(F.length(run), F.lit(15)),  # longest first
        lambda n: F.substring(run, n, 1).rlike("[A-Z0-9]") & ~F.substring(head, n + 1, 1).rlike("[A-Za-z0-9]")
        & F.length(bare(n)).between(15, 34) & mod97(bare(n))))
    return F.coalesce(F.try_element_at(F.filter(ends, lambda n: F.length(bare(n)) == usual), F.lit(1)),
                      F.try_element_at(ends, F.lit(1)))


def _ibans(text: Column, kind: Kind) -> Column:
    """All IBANs as array of (start, end, match, before), each sought from every beginning by itself."""
    pieces = F.split(F.regexp_replace(text, kind.pattern, MARK), MARK)
    # beginnings are five characters apart or more, so what is read around one lies in a few pieces
    near = -(-(IBAN_LONGEST + 1) // 5) + 1
    none = F.lit(None).cast("array<struct<start:int,end:int,match:string,before:string>>")
    heads = F.transform(pieces, lambda p: F.left(p, F.lit(IBAN_LONGEST + 1)))
    seen = F.transform(pieces, lambda p, i: F.struct(
        F.length(p).alias("n"), F.right(p, F.lit(CONTEXT)).alias("tail"),
        F.left(F.array_join(F.slice(heads, i + 1, F.lit(near)), ""), F.lit(IBAN_LONGEST + 1)).alias("head"),
        (i > 0).alias("begins")))
    sized = F.transform(seen, lambda p: F.struct(
        p["n"].alias("n"), p["tail"].alias("tail"), p["head"].alias("head"),
        F.when(p["begins"], _iban_length(p["head"])).alias("size")))
    walked = F.aggregate(
        sized,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("before"), F.coalesce(none, F.array()).alias("found")),
        lambda acc, p: F.struct(
            (acc["at"] + p["n"]).alias("at"),
            F.right(F.concat(acc["before"], p["tail"]), F.lit(CONTEXT)).alias("before"),
            F.when(p["size"].isNotNull(), F.concat(acc["found"], F.array(F.struct(
                acc["at"].alias("start"), (acc["at"] + p["size"]).alias("end"),
                F.left(p["head"], p["size"]).alias("match"), acc["before"].alias("before")))))
            .otherwise(acc["found"]).alias("found")))
    return F.when(text.rlike(kind.needs), walked["found"]).otherwise(F.coalesce(none, F.array()))


def _scored(kind: Kind, proposed: Column) -> Column:
    """Matches that hold, as array of (kind, start, end, score)."""
    kept = F.filter(proposed, lambda m: _valid(kind, m["match"]))
    spoken = r"(?<![\p{L}\p{N}])(?:" + "|".join(kind.words) + r")s?(?![\p{L}\p{N}])"
    uncut = lambda b: F.when(F.length(b) >= CONTEXT, F.regexp_replace(b, r"^[\p{L}\p{N}]+", "")).otherwise(b)
    spans = F.transform(kept, lambda m: F.struct(
        F.lit(kind.name).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
        F.round(F.least(F.lit(1.0), F.lit(kind.prior + kind.confirmed)
                        + F.when(F.lower(uncut(m["before"])).rlike(spoken), 0.2).otherwise(0.0)), 2).alias("score")))
    return spans if kind.base else F.filter(spans, lambda s: s["score"] >= THRESHOLD)


def find(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """All rows with ``out``: array of (kind, start, end, score), by kind as listed, then start."""
    columns = [c for c in docs.columns if c.lower() != out.lower()]
    clean = free_name(docs, "_clean")
    df = docs.withColumn(clean, F.translate(F.coalesce(F.col(text), F.lit("")), MARK, OTHER))
    found = {}
    for kind in KINDS:
        found[kind.name] = free_name(docs, f"_{kind.name}")
        df = df.withColumn(found[kind.name], (_ibans if kind.name == "iban" else _proposed)(F.col(clean), kind))
    spans = F.concat(*[_scored(k, F.col(found[k.name])) for k in KINDS])
    return df.select(*columns, spans.alias(out))


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every span replaced by its kind in brackets; overlapping spans are replaced as one.

    Null texts stay null. All other columns are left as they are.
    """
    columns = docs.columns
    spans = free_name(docs, "_pii")
    df = find(docs, text, spans)
    by_start = F.array_sort(F.transform(F.col(spans), lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    source = F.col(text)
    built = F.aggregate(
        by_start, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], -s["back"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["parts"], F.array(
                F.substring(source, acc["at"] + 1, s["start"] - acc["at"]),
                F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))))
            .otherwise(acc["parts"]).alias("parts")),
        lambda acc: F.concat(F.array_join(acc["parts"], ""),
                             F.substring(source, acc["at"] + 1, F.lit(2 ** 31 - 1))))
    replaced = F.when(F.size(spans) > 0, built).otherwise(source)
    return df.withColumn(text, replaced).select(*columns)
