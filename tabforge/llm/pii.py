"""Personal data: patterns propose spans, validators confirm, context scores.

Everything is a column expression.  For every kind one regular expression is
used twice, to extract all matches and to split the text at them; summing the
lengths of both lists gives each match its place in code points.  Checksums
(Luhn, mod-97) and range tests drop wrong matches without a retry.  A weak
kind (see ``KINDS``) also needs a context word within ``CONTEXT`` characters
before or after it; for the others a context word raises the score.

Patterns never scan a character twice: runs are possessive and a match starts
only where a run starts (or where the last match ended), so a very long run
costs linear time.

Edge cases: a null or empty text has no span; spans of different kinds may
overlap; repeated rows give repeated results; no rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import doc_rows

CONTEXT = 48
BASE = ("email", "ip", "card", "phone")


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: a substring without which no match is possible (a cheap first test), as a regular expression
    needs: str
    score: float
    #: lower-cased context words; each kind's score rises by ``boost`` beside one
    words: tuple = ()
    boost: float = 0.0
    #: spans below this score are dropped; base kinds keep all
    least: float = 0.0


#: The base patterns, written so that they match the same spans
#: in linear time, and the formats of the added kinds.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9,
         ("mail", "contact", "write"), 0.1),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6, ("ip", "host", "server", "address"), 0.3),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]", 0.8, ("card", "visa", "credit", "pay"), 0.2),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.7, ("call", "phone", "tel", "mobile"), 0.3),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}", 0.9,
         ("iban", "account", "bank", "konto"), 0.1),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9]{2}-[0-9]", 0.4,
         ("ssn", "social", "security"), 0.5, 0.5),
)


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(s: Column) -> Column:
    """True if the digits of ``s`` pass the Luhn check."""
    values = F.transform(F.split(F.reverse(digits(s)), ""), lambda c: c.cast("int"))
    doubled = F.transform(values, lambda v, i: F.when(i % 2 == 0, v).when(v > 4, 2 * v - 9).otherwise(2 * v))
    return F.aggregate(doubled, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0))) % 10 == 0


def mod97(s: Column) -> Column:
    """True if an account number passes the mod-97 check (letters count 10 to 35)."""
    bare = F.regexp_replace(s, " ", "")
    turned = F.concat(F.substr(bare, F.lit(5)), F.substr(bare, F.lit(1), F.lit(4)))

    def step(a, c):
        v = F.ascii(c)
        return F.when(c == "", a).when(v >= 65, (a * 100 + v - 55) % 97).otherwise((a * 10 + v - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return s.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(digits(s)).between(16, 19) & luhn(s)
    if kind == "phone":
        return F.length(digits(s)).between(8, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(s, " ", "")).between(15, 34) & mod97(s)
    if kind == "ssn":
        return ~s.rlike("^(?:000|666|9[0-9]{2})|-00-|-0000$")
    return F.lit(True)


_SPAN = "array<struct<kind:string,start:long,end:long,value:string,score:double>>"


#: Elements folded in one go, and code points of a piece of text: both keep the
#: work in proportion to a text's length and matches, however many there are.
RUN, PIECE = 1000, 4096


def running(values: Column, step, zero: int = 0) -> Column:
    """Before each element, ``step`` folded over all elements ahead of it.

    Folds runs of ``RUN`` elements and then the runs, as a fold that grows one
    array copies it at every step."""
    def add_run(acc, r):
        last = F.coalesce(F.get(acc, F.size(acc) - 1)["last"], F.lit(zero).cast("long"))
        inner = F.aggregate(F.slice(values, (r * RUN + 1).cast("int"), F.lit(RUN)),
                            F.struct(last.alias("last"), F.array().cast("array<long>").alias("out")),
                            lambda a, v: F.struct(step(a["last"], v).cast("long").alias("last"), F.concat(a["out"], F.array(a["last"])).alias("out")))
        return F.concat(acc, F.array(inner))

    runs = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(values) - 1) / RUN).cast("int")))
    folded = F.aggregate(runs, F.array().cast("array<struct<last:long,out:array<long>>>"), add_run)
    return F.when(F.size(values) > 0, F.flatten(F.transform(folded, lambda x: x["out"]))).otherwise(F.array().cast("array<long>"))


def pieces_of(text: Column) -> Column:
    """The text in pieces of ``PIECE`` code points."""
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % PIECE), F.lit(0))


def cut(pieces: Column, a: Column, b: Column) -> Column:
    """Code points a to b (exclusive) of the text of ``pieces``; looks at no other piece."""
    i, j = F.floor(a / PIECE).cast("int"), F.floor(b / PIECE).cast("int")

    def piece(k):
        return F.coalesce(F.get(pieces, k), F.lit(""))

    from_a = (a - i * PIECE + 1).cast("int")
    across = F.concat(F.substr(piece(i), from_a), F.array_join(F.slice(pieces, i + 2, F.greatest(F.lit(0), j - i - 1)), ""),
                      F.substr(piece(j), F.lit(1), (b - j * PIECE).cast("int")))
    return F.when(i == j, F.substr(piece(i), from_a, (b - a).cast("int"))).otherwise(across)


def spans_of(kind: Kind, text: Column, pieces: Column) -> Column:
    """All confirmed spans of one kind, by start; ends are exclusive."""
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)
    # gap, match, gap, match ...: the running length gives each start
    both = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"))
    lengths = F.transform(both, lambda z: (F.char_length(z["gap"]) + F.char_length(z["hit"])).cast("long"))
    walked = F.transform(F.arrays_zip(both.alias("z"), running(lengths, lambda at, n: at + n).alias("at")), lambda x: F.struct(
        (x["at"] + F.char_length(x["z"]["gap"])).cast("long").alias("start"), x["z"]["hit"].alias("value")))
    good = F.filter(walked, lambda x: valid(kind.name, x["value"]))

    def scored(x):
        lo = F.greatest(F.lit(0), x["start"] - CONTEXT)
        end = x["start"] + F.char_length(x["value"])
        word = "(?:^|[^a-z])(?:" + "|".join(kind.words) + ")"
        beside = F.lit(False)
        if kind.words:
            beside = F.lower(cut(pieces, lo, x["start"])).rlike(word) | F.lower(cut(pieces, end, end + CONTEXT)).rlike(word)
        score = F.least(F.lit(1.0), F.lit(kind.score) + F.when(beside, kind.boost).otherwise(0.0))
        return F.struct(F.lit(kind.name).alias("kind"), x["start"].alias("start"), (x["start"] + F.char_length(x["value"])).cast("long").alias("end"),
                        x["value"].alias("value"), score.alias("score"))

    out = F.transform(good, scored)
    if kind.least:
        out = F.filter(out, lambda x: x["score"] >= kind.least)
    return F.when(text.rlike(kind.needs), out).otherwise(F.array().cast(_SPAN)).cast(_SPAN)


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, rest (all other columns) and ``spans``: an array of (kind,
    start, end, value, score) by kind as in ``KINDS``, then start."""
    rows = doc_rows(docs, id_col, text_col)
    text = F.coalesce("text", F.lit(""))
    rows = rows.select("doc_id", "text", "rest", pieces_of(text).alias("pieces"))
    each = [spans_of(k, text, F.col("pieces")).alias(k.name) for k in KINDS]
    rows = rows.select("doc_id", "text", "rest", *each)
    return rows.select("doc_id", "text", "rest", F.concat(*[k.name for k in KINDS]).alias("spans"))


def digest(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def of_kinds(spans: Column, kinds) -> Column:
    return F.filter(spans, lambda x: x["kind"].isin(*kinds))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; of
    overlapping spans the earliest (then the longest) is shown."""
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), x["kind"].alias("kind"))))
    ends = F.transform(order, lambda x: (-x["back"]).cast("long"))
    pieces = pieces_of(text)
    # each span with the largest end before it; one that starts ahead of that is not shown
    shown = F.filter(F.arrays_zip(order.alias("x"), running(ends, F.greatest).alias("at")), lambda z: z["x"]["start"] >= z["at"])
    parts = F.transform(shown, lambda z: F.concat(cut(pieces, z["at"], z["x"]["start"]), F.lit("<"), F.upper(z["x"]["kind"]), F.lit(">")))
    rest = cut(pieces, F.array_max(ends), F.char_length(text).cast("long"))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(parts, ""), rest)).otherwise(text)
