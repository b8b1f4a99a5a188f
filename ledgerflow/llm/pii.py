"""Personal data: patterns propose spans, checksums confirm them, context words adjust a score.

DataFrame functions only. A span's place comes from splitting the text by the
same pattern: the lengths of the pieces between matches and of the matches
before it add up to its start, in code points.

Base kinds (email, ip, card, phone) are always reported once their check holds.
Added kinds (iban with mod-97, ssn, mac) carry a score: a start value per
kind, raised by context words shortly before the span; those under
``MIN_SCORE`` are dropped.

Defined cases: null text counts as empty and has no spans; patterns use
possessive loops, so long runs neither backtrack nor recurse; rows are
independent, so repeated rows give repeated results; extra columns are kept out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the four base kinds, with possessive loops. The classes left and right of each
# loop are disjoint, so the matches are those of the greedy forms; a match starts at the start of a
# run, or (emails) right where the last match ended.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
MAC = r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2}){5}(?![0-9A-Fa-f:])"

# Order of the kinds where spans start together.
KINDS = ["email", "ip", "card", "phone", "iban", "ssn", "mac"]
BASE_KINDS = KINDS[:4]
# What must be in a text before a pattern is tried: a necessary part of every match.
NEEDED = {"email": "@", "ip": ".", "phone": "+", "ssn": "-", "mac": ":"}
START_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.9, "phone": 0.6, "iban": 0.9, "ssn": 0.4, "mac": 0.5}
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|contact|write|address|reply)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|login)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|debit|payment)\b",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|fax)\b",
    "iban": r"(?i)\b(?:iban|bank|account|transfer)\b",
    "ssn": r"(?i)\b(?:ssn|social security|tax id)\b",
    "mac": r"(?i)\b(?:mac|device|hardware|wifi|adapter)\b",
}
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.3
MIN_SCORE = 0.5

PATTERN = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN, "ssn": SSN, "mac": MAC}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _ip_valid(value: Column) -> Column:
    def at_most_255(part: Column) -> Column:
        short = F.ltrim(part, F.lit("0"))
        return (F.length(short) <= 3) & (F.lpad(short, 3, "0") <= "255")
    return F.forall(F.split(value, r"\."), at_most_255)


def _mod_97(value: Column) -> Column:
    """ISO 7064 remainder of an account number: country and check digits last, letters as 10 to 35."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(plain, 5, 1 << 20), F.substring(plain, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    characters = F.filter(F.split(turned, ""), lambda c: c != "")
    return F.aggregate(characters, F.lit(0), step)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return _ip_valid(value)
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(value, " ", "")).between(15, 34) & (_mod_97(value) == 1)
    return F.lit(True)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it stands there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sums(parts: Column, step: Callable[[Column], Column]) -> Column:
    """Before each part the sum of the steps of those before it; for a short array, as it is copied at each."""
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(parts, state, lambda s, p: F.struct(
        (s["at"] + step(p)).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])


def _placed(matches: Column) -> Column:
    """Matches with their start, summed in blocks of about the root of their number: n matches take n * sqrt(n) steps."""
    width = F.ceil(F.sqrt(F.size(matches))).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(matches) / width).cast("int") - 1),
                         lambda b: F.slice(matches, b * width + 1, width))

    def start(block: Column, offset: Column) -> Column:
        return F.zip_with(block, _sums(block, lambda m: m["step"]), lambda m, at: F.struct(
            m["value"].alias("value"), (offset + at + m["gap"]).alias("start"), m["before"].alias("before")))

    totals = lambda block: F.aggregate(block, F.lit(0).cast("bigint"), lambda n, m: n + m["step"])
    return _bound(blocks, lambda bs: F.flatten(F.zip_with(bs, _sums(bs, totals), start)))


def _spans(text: Column, kind: str) -> Column:
    """array<struct<start, kind_no, kind, end, score>> of the valid matches of one kind."""
    found = F.regexp_extract_all(text, F.lit(PATTERN[kind]), F.lit(0))
    between = F.slice(F.split(text, PATTERN[kind], -1), F.lit(1), F.size(found))
    placed = _bound(F.zip_with(found, between, lambda value, piece: F.struct(
        value.alias("value"), F.length(piece).cast("bigint").alias("gap"),
        (F.length(piece) + F.length(value)).cast("bigint").alias("step"),
        F.right(piece, F.lit(CONTEXT_CHARS)).alias("before"))), _placed)
    valid = F.filter(placed, lambda s: _valid(kind, s["value"]))

    def scored(s: Column) -> Column:
        near = s["before"].rlike(CONTEXT[kind])
        score = F.least(F.lit(1.0), F.lit(START_SCORE[kind]) + F.when(near, CONTEXT_BONUS).otherwise(0.0))
        return F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"),
                        F.lit(kind).alias("kind"), (s["start"] + F.length(s["value"])).alias("end"),
                        F.round(score, 2).alias("score"))

    spans = F.transform(valid, scored)
    if kind not in BASE_KINDS:
        spans = F.filter(spans, lambda s: s["score"] >= MIN_SCORE)
    none = F.array().cast("array<struct<start:bigint,kind_no:int,kind:string,end:bigint,score:double>>")
    possible = text.contains(NEEDED[kind]) if kind in NEEDED else F.lit(True)
    return F.when(possible & text.rlike(PATTERN[kind]), spans).otherwise(none)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, spans): every span with kind, place and score, ordered by start, then kind."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    for kind in KINDS:
        rows = rows.withColumn(f"s_{kind}", _spans(F.col("text"), kind))
    return rows.select("doc_id", "text",
                       F.array_sort(F.concat(*[F.col(f"s_{k}") for k in KINDS])).alias("spans"))


def redact(found: DataFrame) -> DataFrame:
    """(doc_id, text): each found span replaced by its kind in angle brackets.

    Where spans overlap, the one that starts first is replaced and the rest of the others dropped.
    """
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(s: Column, span: Column) -> Column:
        begins = F.greatest(span["start"], s["at"])
        gap = F.col("text").substr((s["at"] + 1).cast("int"), (begins - s["at"]).cast("int"))
        mark = F.when(span["start"] >= s["at"], F.concat(F.lit("<"), span["kind"], F.lit(">"))).otherwise("")
        return F.struct(F.greatest(span["end"], s["at"]).alias("at"), F.concat(s["out"], gap, mark).alias("out"))

    done = F.aggregate("spans", state, step)
    rest = F.col("text").substr((done["at"] + 1).cast("int"), F.length("text"))
    return found.select("doc_id", F.concat(done["out"], rest).alias("text"))


def span_digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a hash of the base spans and the list of all spans."""
    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(BASE_KINDS))
    return found.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"),
                        F.transform("spans", lambda s: s["score"]).alias("scores"))
