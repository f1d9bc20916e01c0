"""Secret scans: known forms, and tokens that a battery of tests takes for random.

Three patterns give the base spans. Beside them, every long run of code letters is a
candidate. Its encoding is inferred (decimal, hexadecimal, base 32 or base 64), and the
sequence of its digits is put to three tests of randomness: chi-squared for the uniform use
of the alphabet, runs above and below the middle, and serial correlation. A candidate that
passes is held against text: the chance that text of its length has so few coinciding letters.
Long tokens can reach small chances, short ones can't, and a Benjamini-Hochberg limit per
class of lengths, over the candidates of all documents, keeps the share of false discoveries
down. All of it is column expressions; what is gathered is a histogram of fixed size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import own, unused, whole_text

#: Name, pattern, group whose length counts, least length; in the order of the kinds.
BASE = [
    (
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9+/_.=-]+)""",
        1,
        8,
    ),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
]
#: What must occur in a text for any match that counts; cheaper to look for.
HINTS = {"access": "AKIA[A-Z0-9]{12}", "hex": "[0-9a-f]{32}"}
KINDS = [name for name, *_ in BASE] + ["random"]

CANDIDATE = "[A-Za-z0-9+/_-]{20,}"

#: The alphabets of the encodings, and the pattern of the tokens of each.
ALPHABETS = [
    ("^[0-9]+$", "0123456789"),
    ("^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    ("^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    (".", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
]
#: By size of alphabet, for text: the chance that two letters coincide, and that three do.
#: For letters, those of European prose; for digits, of numbers with a few digits preferred.
COINCIDENCE = {10: (0.16, 0.030), 16: (0.10, 0.012), 32: (0.065, 0.0054), 64: (0.065, 0.0054)}

#: A test rejects randomness below this chance (shared by the three).
REJECT = 0.001
#: The accepted share of false discoveries, and where the classes of lengths begin.
FALSE_SHARE = 0.05
LENGTHS = (20, 32, 48, 96)
#: The histogram of chances: steps in a factor of ten, and how many factors.
STEPS, FACTORS = 20, 20


def spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 1) -> Column:
    """The matches from left to right whose ``group`` has ``least`` letters or more.

    Structs of start, kind, end and token. Where a match begins is the length of all that
    comes before it: of the pieces between matches and of the matches.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        matches.alias("match"),
        (F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches).alias(
            "value"
        ),
    )
    nothing = F.expr(
        "named_struct('at', 0, 'found', "
        "cast(array() AS array<struct<start:int,kind:int,end:int,token:string>>))"
    )

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.char_length(part["gap"])
        end = start + F.coalesce(F.char_length(part["match"]), F.lit(0))
        here = F.struct(
            start.alias("start"),
            F.lit(kind).alias("kind"),
            end.alias("end"),
            part["match"].alias("token"),
        )
        found = F.when(
            F.char_length(part["value"]) >= least, F.concat(state["found"], F.array(here))
        ).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    return F.aggregate(parts, nothing, step, lambda state: state["found"])


def empty_spans() -> Column:
    return F.expr("cast(array() AS array<struct<start:int,kind:int,end:int,token:string>>)")


def base_spans(text: Column) -> Column:
    """The base spans of all kinds, by start, then kind."""
    each = [
        F.when(text.rlike(HINTS.get(name, pattern)), spans(text, pattern, kind, group, least))
        .otherwise(empty_spans())
        for kind, (name, pattern, group, least) in enumerate(BASE)
    ]
    return F.array_sort(F.concat(*each))


def chance(z: Column) -> Column:
    """The chance of a normal variable below ``z``, good in the lower tail to 7 digits."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + x / 2)
    # Coefficients of the usual rational fit of the complementary error function.
    fit = F.lit(0.17087277)
    for c in (
        -0.82215223,
        1.48851587,
        -1.13520398,
        0.27886807,
        -0.18628806,
        0.09678418,
        0.37409196,
        1.00002368,
        -1.26551223,
    ):
        fit = c + t * fit
    tail = t * F.exp(fit - x * x) / 2
    return F.when(z < 0, tail).otherwise(1 - tail)


def by_alphabet(token: Column, values: list) -> Column:
    out = F.lit(values[-1])
    for (pattern, _), value in reversed(list(zip(ALPHABETS[:-1], values, strict=False))):
        out = F.when(token.rlike(pattern), F.lit(value)).otherwise(out)
    return out


def counted(c: Column) -> Column:
    """A candidate's digits by its encoding, and how often each is used, squared and summed."""
    letters = by_alphabet(c["token"], [alphabet for _, alphabet in ALPHABETS])
    written = (
        F.when(F.char_length(letters) == 16, F.lower(c["token"]))
        .when(F.char_length(letters) == 64, F.translate(c["token"], "-_", "+/"))
        .otherwise(c["token"])
    )
    return F.struct(
        c["start"].alias("start"), c["end"].alias("end"), letters.alias("letters"),
        written.alias("written"),
    )


def measured(c: Column) -> Column:
    """Length, size of alphabet, sums over the digits, and what the three tests need."""
    length = F.char_length(c["written"])
    size = F.char_length(c["letters"])
    digits = F.transform(
        F.sequence(F.lit(1), length),
        lambda i: (F.instr(c["letters"], F.substring(c["written"], i, F.lit(1))) - 1).cast("double"),
    )
    uses = F.transform(
        F.sequence(F.lit(1), size),
        lambda j: (
            length
            - F.char_length(
                F.replace(c["written"], F.substring(c["letters"], j, F.lit(1)), F.lit(""))
            )
        ).cast("double"),
    )
    return F.struct(
        c["start"].alias("start"),
        c["end"].alias("end"),
        length.cast("double").alias("n"),
        size.cast("double").alias("k"),
        digits.alias("digits"),
        F.aggregate(uses, F.lit(0.0), lambda s, u: s + u * u).alias("squares"),
    )


def summed(c: Column) -> Column:
    pairs = F.zip_with(
        F.slice(c["digits"], F.lit(1), F.size(c["digits"]) - 1),
        F.slice(c["digits"], F.lit(2), F.size(c["digits"]) - 1),
        lambda a, b: F.struct(
            (a * b).alias("product"),
            ((a < c["k"] / 2) != (b < c["k"] / 2)).cast("double").alias("turn"),
        ),
    )
    return F.struct(
        *[c[x].alias(x) for x in ("start", "end", "n", "k", "squares")],
        F.aggregate(c["digits"], F.lit(0.0), lambda s, d: s + d).alias("sum"),
        F.aggregate(c["digits"], F.lit(0.0), lambda s, d: s + d * d).alias("power"),
        F.aggregate(
            c["digits"], F.lit(0.0), lambda s, d: s + (d < c["k"] / 2).cast("double")
        ).alias("low"),
        F.aggregate(pairs, F.lit(0.0), lambda s, p: s + p["product"]).alias("products"),
        (1 + F.aggregate(pairs, F.lit(0.0), lambda s, p: s + p["turn"])).alias("runs"),
    )


def standardised(c: Column) -> Column:
    """Each statistic as a normal variable under its hypothesis."""
    n, k = c["n"], c["k"]
    free = 2 / (9 * (k - 1))
    chi = (k / n * c["squares"] - n) / (k - 1)
    mean_runs = 2 * c["low"] * (n - c["low"]) / n + 1
    spread_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
    spread = c["power"] - c["sum"] * c["sum"] / n
    serial = (c["products"] - c["sum"] * c["sum"] / n) / spread
    kappa, tau = F.lit(0.0), F.lit(0.0)
    for size, (two, three) in COINCIDENCE.items():
        kappa = F.when(k == size, F.lit(two)).otherwise(kappa)
        tau = F.when(k == size, F.lit(three)).otherwise(tau)
    pairs = n * (n - 1) / 2
    spread_text = pairs * kappa * (1 - kappa) + n * (n - 1) * (n - 2) * (tau - kappa * kappa)
    return F.struct(
        c["start"].alias("start"),
        c["end"].alias("end"),
        n.alias("n"),
        ((F.pow(chi, 1 / 3) - (1 - free)) / F.sqrt(free)).alias("uniform"),
        F.when(spread_runs > 0, F.abs(c["runs"] - mean_runs) / F.sqrt(spread_runs))
        .otherwise(F.lit(99.0))
        .alias("turning"),
        F.when(spread > 0, F.abs(serial + 1 / n) * F.sqrt(n)).otherwise(F.lit(99.0)).alias("serial"),
        (((c["squares"] - n) / 2 - pairs * kappa) / F.sqrt(spread_text)).alias("text"),
    )


def judged(c: Column) -> Column:
    """The class of length, and the chance's place in the histogram; 0 if not random."""
    passes = (
        (chance(-c["uniform"]) >= REJECT / 3)
        & (2 * chance(-c["turning"]) >= REJECT / 3)
        & (2 * chance(-c["serial"]) >= REJECT / 3)
    )
    held = F.lit(0)
    for number, least in enumerate(LENGTHS[1:], 1):
        held = F.when(c["n"] >= least, F.lit(number)).otherwise(held)
    place = F.floor(-F.log10(F.greatest(chance(c["text"]), F.lit(10.0**-FACTORS))) * STEPS)
    return F.struct(
        c["start"].alias("start"),
        c["end"].alias("end"),
        held.alias("held"),
        F.when(passes, place.cast("int")).otherwise(F.lit(0)).alias("place"),
    )


def battery(text: Column) -> Column:
    """The candidates of a text: structs of start, end, held (class of length), place."""
    out = spans(text, CANDIDATE, len(BASE))
    for step in (counted, measured, summed, standardised, judged):
        out = F.transform(out, step)
    none = F.expr("cast(array() AS array<struct<start:int,end:int,held:int,place:int>>)")
    return F.when(text.rlike(CANDIDATE), out).otherwise(none)


def discovery_limits(docs: DataFrame, text: str = "text") -> list[int]:
    """For each class of lengths, the first place of the histogram that is a discovery.

    Of all candidates of a class, in all documents, those are discoveries whose chance is at
    most the largest p with p * candidates <= FALSE_SHARE * (candidates of chance p or less).
    What comes to the driver is at most a count for each class and place.
    """
    found = docs.select(F.explode(battery(whole_text(own(docs, text)))).alias("c"))
    counts = found.groupBy("c.held", "c.place").count().collect()
    limits = []
    for held in range(len(LENGTHS)):
        by_place = {r.place: r["count"] for r in counts if r.held == held}
        total, limit = sum(by_place.values()), STEPS * FACTORS + 1
        for place in sorted(by_place):
            tail = sum(n for at, n in by_place.items() if at >= place)
            if place and 10 ** (-place / STEPS) * total <= FALSE_SHARE * tail:
                limit = place
                break
        limits.append(limit)
    return limits


def all_spans(text: Column, base: Column, limits: list[int]) -> Column:
    """Base spans and discoveries that touch none of them, by start, then kind."""
    found = F.filter(
        battery(text),
        lambda c: c["place"]
        >= F.element_at(F.array(*[F.lit(n) for n in limits]), c["held"] + F.lit(1)),
    )
    free = F.filter(
        found,
        lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )
    added = F.transform(
        free,
        lambda c: F.struct(
            c["start"].alias("start"), F.lit(len(BASE)).alias("kind"), c["end"].alias("end")
        ),
    )
    plain = F.transform(
        base,
        lambda b: F.struct(
            b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end")
        ),
    )
    return F.array_sort(F.concat(plain, added))


def listed(found: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(name) for name in KINDS])
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + F.lit(1)), s["start"], s["end"]
            ),
        ),
        ",",
    )


def of_kind(found: Column, kind: int) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Places are code points, the end exclusive. Null texts count as empty and have no spans;
    rows stand for themselves, so null keys and repeated rows are like others, and an empty
    table gives none. Other columns are not looked at.
    """
    limits = discovery_limits(docs, text)
    rows = docs.select(own(docs, key).alias("key"), whole_text(own(docs, text)).alias("text"))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    rows = rows.withColumn("every", all_spans(F.col("text"), F.col("base"), limits))
    return rows.select(
        F.col("key").alias(key),
        *[of_kind(F.col("base"), k).alias(f"n_{name}") for k, (name, *_) in enumerate(BASE)],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("every")).alias("spans"),
    )


def redacted(text: Column, found: Column, mark: str) -> Column:
    """The text with ``mark`` in place of every span; spans that touch become one."""
    begin = F.expr("named_struct('at', 0, 'out', '')")

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        kept = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        out = F.when(fresh, F.concat(state["out"], kept, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(s["end"], state["at"]).alias("at"), out.alias("out"))

    last = F.aggregate(found, begin, step)
    return F.concat(
        last["out"], F.substring(text, last["at"] + 1, F.char_length(text))
    )


def redact_documents(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with all columns and rows, every secret replaced; other texts are untouched."""
    limits = discovery_limits(docs, text)
    content, found = own(docs, text), unused(docs, "found")
    every = all_spans(whole_text(content), base_spans(whole_text(content)), limits)
    wide = docs.withColumn(found, every)
    clean = F.when(F.size(wide[found]) > 0, redacted(content, wide[found], mark)).otherwise(content)
    return wide.withColumn(text, clean).drop(found)
