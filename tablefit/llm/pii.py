"""Personal data: regular expressions propose spans, checksums confirm them, words around them adjust a score.

Only DataFrame functions.  Every pattern is written so that a scan is linear in the text: possessive quantifiers, and a
run of pattern characters is entered at its start (or where the last match ended) only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefit.llm.common import quoted

#: Code points before and after a span in which context words count.
CONTEXT_CHARS = 32
#: What stands between the items of a list; context words near one of them count for all.
LIST_GAP = r"(?i)^[^\p{L}\p{N}]{1,8}(?:(?:and|or)[^\p{L}\p{N}]{1,4})?$"
#: A span of an added kind is reported from this score on.
ACCEPT = 0.5
SPAN_TYPE = "array<struct<kind:string,start:int,end:int,score:double>>"


@dataclass(frozen=True)
class Kind:
    """``base``: score of a confirmed match; ``context`` adds ``bonus`` when found shortly before it, or shortly after it unless a colon or
    equals sign there makes it the name of what follows (``after``, where that differs).  ``fixed`` kinds are reported whenever
    confirmed; the score only informs."""

    name: str
    pattern: str
    confirm: Callable[[Column], Column] | None
    base: float
    context: str
    bonus: float
    fixed: bool = False
    after: str | None = None


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True for a digit string whose Luhn sum is a multiple of ten."""
    n = F.length(number)

    def term(i: Column) -> Column:
        d = F.substring(number, n - i, 1).cast("int")  # i-th digit from the right, from 0
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), term), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """True for an account number (letters and digits) with remainder 1 after its first four characters went to the end."""
    moved = F.concat(F.substring(account, 5, F.length(account)), F.substring(account, 1, 4))
    values = F.transform(
        F.sequence(F.lit(1), F.length(moved)),
        lambda i: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.substring(moved, i, 1)) - 1,
    )
    return F.aggregate(values, F.lit(0), lambda a, v: F.when(v < 10, a * 10 + v).otherwise(a * 100 + v) % 97) == 1


def _ip(hit: Column) -> Column:
    part = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(part, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False))


def _card(hit: Column) -> Column:
    number = digits(hit)
    return F.when(F.length(number).between(13, 19), luhn(number)).otherwise(False)


def _phone(hit: Column) -> Column:
    return F.length(digits(hit)).between(9, 15)


def _iban(hit: Column) -> Column:
    account = F.replace(hit, F.lit(" "), F.lit(""))
    return F.when(F.length(account).between(15, 34), mod97(account)).otherwise(False)


#: The kinds that are always reported, in the order of the digest.
BASE_KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", None,
         0.9, r"(?i)mail|contact", 0.1, True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _ip, 0.7, r"(?i)\b(?:ip|host|server|address)\b", 0.3, True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", _card, 0.8, r"(?i)\b(?:card|visa|credit|payment)\b", 0.2, True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _phone, 0.7, r"(?i)\b(?:tel|phone|call|mobile|fax)\b", 0.3, True),
)
#: Added by this method; reported from ACCEPT on.
ADDED_KINDS = (
    Kind("iban", r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Z0-9])", _iban,
         0.7, r"(?i)\b(?:iban|account|konto|bank)\b", 0.3),
    Kind("secret", r"(?<![A-Za-z0-9])[A-Fa-f0-9]{16,128}(?![A-Za-z0-9])", None,
         0.2, r"(?i)(?:password|passwd|secret|token|api.?key|credential)[^A-Za-z0-9]{0,6}$", 0.6,
         after=r"(?i)^[^A-Za-z0-9]{0,6}(?:is (?:the|my|our|your) )?(?:password|passwd|secret|token|api.?key|credential)(?!\s*[:=])"),
    Kind("access_key", r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])", None, 0.8, r"(?i)key|secret|access", 0.2),
    Kind("id_number", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", None,
         0.3, r"(?i)\b(?:ssn|social security|tax id|id number)\b", 0.6),
    Kind("local_phone", r"(?<![0-9+)(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])", None,
         0.3, r"(?i)\b(?:tel|phone|call|mobile|fax)\b", 0.5),
)
KINDS = BASE_KINDS + ADDED_KINDS
#: Prefix sums are taken in blocks of this many, so that a text with very many matches costs n * BLOCK, not n * n.
BLOCK = 128


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, not at each use inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_totals(values: Column) -> Column:
    """Sums of the integers before each element of an array."""
    def blocks(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.ceil(F.size(v) / F.lit(BLOCK)).cast("int") - 1), lambda b: _total(F.slice(v, b * BLOCK + 1, BLOCK)))

    def before(t: Column) -> Column:
        return F.transform(t, lambda _, b: F.when(b > 0, _total(F.slice(t, 1, b))).otherwise(0))

    def totals(v: Column, sums: Column) -> Column:
        return F.transform(v, lambda _, i: F.get(sums, F.floor(i / BLOCK).cast("int"))
                           + F.when(i % BLOCK > 0, _total(F.slice(v, i - i % BLOCK + 1, i % BLOCK))).otherwise(0))

    return _let(values, lambda v: _let(blocks(v), lambda t: _let(before(t), lambda sums: totals(v, sums))))


def _spans(df: DataFrame, kind: Kind) -> DataFrame:
    """Adds the column ``kind.name``: this kind's spans by start."""
    hits = df.withColumn("__hits", F.regexp_extract_all("__text", F.lit(kind.pattern), F.lit(0)))
    hits = hits.withColumn("__gaps", F.when(F.size("__hits") > 0, F.split("__text", kind.pattern, -1)))
    lengths = F.transform(F.col("__hits"), lambda h, i: F.length(h) + F.length(F.get(F.col("__gaps"), i)))
    none = F.array().cast(SPAN_TYPE)
    hits = hits.withColumn("__lengths", F.when(F.size("__hits") > 0, lengths))
    hits = hits.withColumn("__starts", F.when(F.size("__hits") > 0, running_totals(F.col("__lengths"))))

    # base matches have two characters or more, the others eleven: so many pieces fill the context whatever lies between
    some, n, pieces = F.size("__hits") > 0, F.size("__hits"), CONTEXT_CHARS // 2 if kind.fixed else 3
    hits = hits.withColumn("__left", F.when(some, F.transform(F.col("__hits"), lambda h, i: F.right(
        F.concat(F.right(F.get(F.col("__gaps"), i), F.lit(CONTEXT_CHARS)), F.right(h, F.lit(CONTEXT_CHARS))), F.lit(CONTEXT_CHARS)))))
    hits = hits.withColumn("__right", F.when(some, F.transform(F.col("__hits"), lambda h, i: F.left(
        F.concat(F.left(h, F.lit(CONTEXT_CHARS)), F.left(F.get(F.col("__gaps"), i + 1), F.lit(CONTEXT_CHARS))), F.lit(CONTEXT_CHARS)))))

    def near(i: Column) -> Column:
        left, right = F.col("__left"), F.col("__right")
        # single pieces, as a slice would copy the whole array each time
        before = F.concat(*[F.coalesce(F.get(left, i - k), F.lit("")) for k in range(pieces, 0, -1)], F.get(F.col("__gaps"), i))
        behind = F.concat(F.get(F.col("__gaps"), i + 1), *[F.coalesce(F.get(right, i + k), F.lit("")) for k in range(1, pieces + 1)])
        found = F.right(before, F.lit(CONTEXT_CHARS)).rlike(kind.context) | F.left(behind, F.lit(CONTEXT_CHARS)).rlike(
            kind.after or rf"(?:{kind.context})(?!\s*[:=])")
        return F.when(found, 1).otherwise(0)

    # lists: the first match of each, the list of each match, and the matches with context before each match
    hits = hits.withColumn("__near", F.when(some, F.transform(F.col("__hits"), lambda h, i: near(i))))
    hits = hits.withColumn("__opens", F.when(some, F.transform(
        F.col("__hits"), lambda h, i: F.when((i > 0) & F.get(F.col("__gaps"), i).rlike(LIST_GAP), 0).otherwise(1))))
    hits = hits.withColumn("__list", F.when(some, F.transform(running_totals(F.col("__opens")), lambda r, i: r + F.get(F.col("__opens"), i))))
    hits = hits.withColumn("__bounds", F.when(some, F.concat(
        F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get(F.col("__opens"), i) == 1), F.array(n))))
    hits = hits.withColumn("__sums", F.when(some, F.concat(running_totals(F.col("__near")), F.array(_total(F.col("__near"))))))

    def span(hit: Column, i: Column) -> Column:
        start = F.get(F.col("__starts"), i) + F.length(F.get(F.col("__gaps"), i))
        of, bounds, sums = F.get(F.col("__list"), i), F.col("__bounds"), F.col("__sums")
        told = F.get(sums, F.get(bounds, of)) > F.get(sums, F.get(bounds, F.get(F.col("__list"), i) - 1))
        score = F.lit(kind.base) + F.when(told, kind.bonus).otherwise(0.0)
        return F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), (start + F.length(hit)).alias("end"), score.alias("score"))

    marked = F.transform(F.col("__hits"), lambda h, i: F.struct(
        span(h, i).alias("span"), (kind.confirm(h) if kind.confirm else F.lit(True)).alias("ok")))
    good = F.filter(marked, lambda m: m["ok"] if kind.fixed else m["ok"] & (m["span"]["score"] >= ACCEPT))
    spans = F.transform(good, lambda m: m["span"]).cast(SPAN_TYPE)
    return hits.withColumn(kind.name, F.when(F.size("__hits") > 0, spans).otherwise(none)).drop(
        "__hits", "__gaps", "__lengths", "__starts", "__left", "__right", "__near", "__opens", "__list", "__bounds", "__sums")


def find_pii(df: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) of each row, and ``pii_spans``.

    ``pii_spans``: array of (kind, start, end, score) in the order of KINDS, then start; code points, end exclusive.
    Base kinds are leftmost non-overlapping matches that pass their check; failing matches are dropped without a
    second try.  Spans of different kinds may overlap.  Null and empty texts have none; texts of any length are read whole; rows are
    judged one by one, so repeated rows stay repeated and an empty table gives no rows.  A kept column named ``pii_spans`` gives way to
    the result; other names do not matter.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c != "pii_spans"]
    work = df.select(*[quoted(c).alias(f"__keep{i}") for i, c in enumerate(kept)],
                     F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("__text"))
    for kind in KINDS:
        work = _spans(work, kind)
    return work.select(*[F.col(f"__keep{i}").alias(c) for i, c in enumerate(kept)],
                       F.concat(*[F.col(k.name) for k in KINDS]).alias("pii_spans"))


def mask_text(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans, the part not yet replaced
    goes too and the first one's name stands for both."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    # (text so far, where the rest begins): spans are few; each step copies what is kept once
    out = F.aggregate(
        ordered,
        F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("at")),
        lambda a, s: F.struct(
            F.when(s["start"] >= a["at"], F.concat(a["parts"], F.array(
                F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))))
            .otherwise(a["parts"]).alias("parts"),
            F.greatest(a["at"], s["end"]).alias("at"),
        ),
        lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(text, a["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, out).otherwise(text)


def mask_pii(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The same columns, whatever their names, with personal data masked in ``text_col``.

    Null texts stay null, empty ones empty; repeated rows stay repeated; texts of any length are masked whole; an empty table gives no rows.
    """
    given = df.select(*[quoted(c).alias(f"__doc{i}") for i, c in enumerate(df.columns)])
    text = f"__doc{df.columns.index(text_col)}"
    found = find_pii(given, text).withColumn(text, mask_text(F.col(text), F.col("pii_spans")))
    return found.select(*[F.col(f"__doc{i}").alias(c) for i, c in enumerate(df.columns)])
