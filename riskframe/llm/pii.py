"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score.

Native: DataFrame functions only, all inside one row, so nothing is shuffled.

A pattern's places follow from splitting the text by it: the lengths of the pieces and matches
before a match add up to its start.  They are added up in two levels, so that a text with very many
matches takes time in proportion to them, about.  The patterns are possessive or bounded, so long runs neither
backtrack nor recurse; where that changes the form, the comment says why the matches are the same.

Defined results: a null text is an empty one and has no spans; positions are code points from 0, end
exclusive; repeated rows get the same spans each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters before a span in which context words count.
CONTEXT_CHARS = 40
#: Matches whose lengths are added up in one go.
RUN = 64
#: Matches before a match that may hold some of its context: the shortest match has five characters.
NEAR_MATCHES = CONTEXT_CHARS // 5
#: Characters in a piece of a text that is put together anew.
PIECE = 1024

# A match starts at the start of a run of local-part characters, or where the last match ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# Runs of digits with at most one space or hyphen between two are maximal and never overlap, so
# asking for 13 to 19 digits inside the pattern drops the same runs as counting afterwards.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def ip_parts(match: Column) -> Column:
    """Four parts of at most 255; leading zeros do not matter."""
    return F.forall(F.split(match, r"\."), lambda p: p.rlike("^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def luhn(match: Column) -> Column:
    return F.call_function("luhn_check", digits(match))


def phone_digits(match: Column) -> Column:
    return F.length(digits(match)).between(9, 15)


def mod97(match: Column) -> Column:
    """Country and check digits go to the end, letters count from 10, the whole number is 1 modulo 97."""
    moved = F.concat(F.substr(match, F.lit(5)), F.substring(match, 1, 4))
    numbers = F.transform(F.split(moved, ""), lambda c: F.expr("0") + F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1)
    rest = F.aggregate(
        F.filter(numbers, lambda v: v >= 0),
        F.lit(0),
        lambda a, v: F.pmod(F.when(v >= 10, a * 100 + v).otherwise(a * 10 + v), F.lit(97)),
    )
    return rest == 1


def always(match: Column) -> Column:
    return match.isNotNull()


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    confirmed: object
    score: float
    context: str
    #: A span with a lower score is no find; 0 keeps every confirmed one.
    least: float = 0.0
    #: A text without this character has no match.
    needs: str = ""


#: The base kinds, in the order in which their spans are listed.
BASE = (
    Kind("email", EMAIL, always, 0.9, "mail|contact|write", needs="@"),
    Kind("ip", IP, ip_parts, 0.6, "ip|host|server|address", needs="."),
    Kind("card", CARD, luhn, 0.7, "card|visa|credit|pay"),
    Kind("phone", PHONE, phone_digits, 0.6, "tel|phone|call|mobile|fax", needs="+"),
)
#: Further kinds: the first has a checksum, the second counts only near a context word.
MORE = (
    Kind("iban", IBAN, mod97, 0.9, "iban|bank|account"),
    Kind("ssn", SSN, always, 0.3, "ssn|social security", least=0.5, needs="-"),
)


SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _run_starts(lengths: Column) -> Column:
    """array<bigint>: what lies before every run of ``RUN`` lengths, by the same sums over runs of runs."""
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / RUN).cast("int")), lambda r: _sum(F.slice(lengths, r * RUN + 1, RUN)))
    state = F.struct(F.lit(0).cast("long").alias("sum"), F.expr("array()").cast("array<bigint>").alias("starts"))
    # One step per run, so the list that grows stays short.
    return F.aggregate(
        runs, state, lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["starts"], F.array(a["sum"])).alias("starts")), lambda a: a["starts"]
    )


def _kind_spans(found: Column, near: Column, lengths: Column, starts: Column, kind: Kind) -> Column:
    """array<struct<kind, start, end, score>> of one kind, by start.

    ``near`` holds the characters before each match, ``lengths`` the length of each match and of the piece before it,
    ``starts`` what lies before each run of them.
    """

    def place(i: Column) -> Column:
        run = F.floor(i / RUN).cast("int")
        upto = F.get(starts, run) + _sum(F.slice(lengths, run * RUN + 1, i % RUN + 1))
        start = upto - F.length(F.get(found, i))
        return F.struct(start.alias("start"), F.get(found, i).alias("match"), F.get(near, i).alias("before"))

    def span(p: Column) -> Column:
        start = p["start"]
        before = p["before"]
        near = before.rlike(rf"(?i)(?<![A-Za-z])({kind.context})")
        return F.struct(
            F.lit(kind.name).alias("kind"),
            start.cast("long").alias("start"),
            (start + F.length(p["match"])).cast("long").alias("end"),
            F.when(near, F.lit(min(1.0, kind.score + 0.3))).otherwise(F.lit(kind.score)).alias("score"),
        )

    places = F.transform(F.sequence(F.lit(0), F.size(found) - 1), place)
    kept = F.transform(F.filter(places, lambda p: kind.confirmed(p["match"])), span)
    kept = F.filter(kept, lambda s: s["score"] >= kind.least)
    there = (F.size(found) > 0) & near.isNotNull() & lengths.isNotNull() & starts.isNotNull()
    return F.when(there, kept).otherwise(F.expr("array()").cast(SPANS))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def spans(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = BASE + MORE, prefix: str = "") -> DataFrame:
    """``docs`` with one array of spans per kind, in columns ``<prefix><kind>``."""
    whole = F.coalesce(F.col(text), F.lit(""))

    def found(k: Kind) -> Column:
        possible = whole.contains(k.needs) if k.needs else whole.rlike("[0-9]")
        nothing = F.expr("array()").cast("array<string>")
        return F.when(possible, F.regexp_extract_all(whole, F.lit(k.pattern), F.lit(0))).otherwise(nothing)

    # Columns of their own, as an expression inside a lambda is evaluated anew for each element; the optimizer leaves
    # a column alone that is asked for twice, hence the tests for null.
    steps = docs.withColumns({f"_found_{k.name}": found(k) for k in kinds})
    def per_match(k: Kind, made) -> Column:
        places = F.sequence(F.lit(0), F.size(f"_found_{k.name}") - 1)
        return F.when((F.size(f"_found_{k.name}") > 0) & F.col(f"_pieces_{k.name}").isNotNull(), F.transform(places, made))

    def length(k: Kind):
        return lambda i: (F.length(F.get(f"_pieces_{k.name}", i)) + F.length(F.get(f"_found_{k.name}", i))).cast("long")

    def near(k: Kind):
        """The last characters before a match: its piece, and where that is short the matches and pieces before."""

        def made(i: Column) -> Column:
            # So many pieces and matches are sure to hold CONTEXT_CHARS characters, as a match has several.
            first = F.greatest(i - NEAR_MATCHES, F.lit(0))
            parts = F.transform(
                F.sequence(first, i),
                lambda j: F.concat(F.get(f"_pieces_{k.name}", j), F.when(j < i, F.get(f"_found_{k.name}", j)).otherwise(F.lit(""))),
            )
            return F.right(F.array_join(parts, ""), F.lit(CONTEXT_CHARS))

        return made

    for name, made in (
        ("_pieces_", lambda k: F.when(F.size(f"_found_{k.name}") > 0, F.split(whole, k.pattern, -1))),
        ("_lengths_", lambda k: per_match(k, length(k))),
        ("_near_", lambda k: per_match(k, near(k))),
        ("_starts_", lambda k: F.when(F.size(f"_found_{k.name}") > 0, _run_starts(F.col(f"_lengths_{k.name}")))),
    ):
        steps = steps.withColumns({name + k.name: made(k) for k in kinds})
    steps = steps.withColumns(
        {prefix + k.name: _kind_spans(*(F.col(f"_{c}_{k.name}") for c in ("found", "near", "lengths", "starts")), k) for k in kinds}
    )
    return steps.drop(*(f"_{c}_{k.name}" for c in ("found", "pieces", "lengths", "near", "starts") for k in kinds))


def redact(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = BASE + MORE) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in angle brackets.

    Of overlapping spans the one that starts first counts, then the longer one.  A text without
    spans, null included, stays as it is.
    """
    prefix = "_pii_"
    found = spans(docs, text, kinds, prefix)
    every = F.concat(*(F.col(prefix + k.name) for k in kinds))
    ordered = F.array_sort(F.transform(every, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    state = F.struct(F.lit(0).cast("long").alias("at"), F.expr("array()").cast("array<string>").alias("parts"))

    def between(start: Column, end: Column) -> Column:
        """Characters of the text, from the pieces that hold them: places far into a text cost no more than early ones."""
        first = F.floor(start / PIECE).cast("int")
        held = F.array_join(F.slice("_pii_cut", first + 1, F.floor(end / PIECE).cast("int") - first + 1), "")
        return F.substring(held, (start - first * PIECE + 1).cast("int"), (end - start).cast("int"))

    def step(a: Column, s: Column) -> Column:
        before = between(a["at"], s["start"])
        part = F.concat(before, F.lit("<"), s["kind"], F.lit(">"))
        take = s["start"] >= a["at"]
        return F.struct(
            F.when(take, -s["back"]).otherwise(a["at"]).alias("at"),
            F.when(take, F.concat(a["parts"], F.array(part))).otherwise(a["parts"]).alias("parts"),
        )

    def end(a: Column) -> Column:
        return F.concat(F.array_join(a["parts"], ""), F.substr(F.col(text), (a["at"] + 1).cast("int")))

    cut = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    there = (F.size("_pii_spans") > 0) & F.col("_pii_cut").isNotNull()
    clean = F.when(there, F.aggregate("_pii_spans", state, step, end)).otherwise(F.col(text))
    found = found.withColumn("_pii_spans", ordered).withColumn("_pii_cut", F.when(F.size("_pii_spans") > 0, cut))
    return found.withColumn(text, clean).select(*docs.columns)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts per base kind, the digest of the base spans and the list of all spans."""
    found = spans(docs.select(key, text), text, prefix="_")
    base = F.array_join(F.filter(F.array(*(listed(F.col("_" + k.name)) for k in BASE)), lambda s: s != ""), ",")
    every = F.array_join(F.filter(F.array(*(listed(F.col("_" + k.name)) for k in BASE + MORE)), lambda s: s != ""), ",")
    return found.select(
        F.col(key),
        *(F.size("_" + k.name).cast("long").alias("n_" + k.name) for k in BASE),
        F.sha2(base, 256).alias("base_sha256"),
        every.alias("spans"),
    )
