"""Secret scans: base patterns, and sliding-window entropy of candidate strings."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayloom.llm.common import let, text_or_empty

ASSIGN = r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{14,}"  # the runs of 18 and more characters; a shorter run holds none
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
UNIT = 1 << 20  # entropy sums are whole numbers of this fraction, so that adding and removing leaves no error
# Least bits in a window, by the characters of the candidate; a class without a line is never reported.
LEAST_BITS = {"hex": 3.0, "alphanumeric": 3.6, "symbols": 3.8}
# Letters as words have them: one case, capitals that each start a run of small letters, or runs of at least three small letters among
# abbreviations. Keys of mixed case are none of these. All quantifiers are possessive, so a long candidate neither backtracks nor recurses.
LETTERS = r"(?:[A-Z]++(?![a-z])|[A-Z]?+[a-z]++(?:[A-Z][a-z]++)*+[A-Z]?+(?![A-Za-z])|[A-Z]*+(?:[a-z]{3,}+[A-Z]*+)++)"
ALLOWED = [
    rf"^[_=+/-]*+(?:{LETTERS}(?:[_=+/-]++|$))*+$",  # letters alone: words, paths, separators
    r"^[0-9_=+/-]*$",  # numbers, dates, rules
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUIDs
    r"(?i)example|sample|placeholder|xxxx|0123456789|abcdefgh",
    # paths and numbered words: parts of letters, of three and more with one number behind, and numbers and versions
    rf"^[/_-]*+(?:(?:(?=[A-Za-z]{{3}}){LETTERS}[0-9]{{0,4}}+|{LETTERS}|v?[0-9]{{1,4}}+)(?:[/_-]++|$))++$",
]


def matches(text: Column, pattern: str, kind: str, keep) -> Column:
    """Spans ``(start, end, kind)`` of the non-overlapping matches for which ``keep(match)`` holds.

    The text between the matches is what a split leaves, so positions are sums of lengths of both.
    """

    def locate(found: Column) -> Column:
        pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"))
        empty = F.array().cast("array<struct<start:int,end:int,kind:int>>")

        def step(state: Column, pair: Column) -> Column:
            start = state["at"] + F.length(pair["gap"])
            end = start + F.coalesce(F.length(pair["hit"]), F.lit(0))
            span = F.struct(start.alias("start"), end.alias("end"), F.lit(KINDS.index(kind)).alias("kind"))
            wanted = pair["hit"].isNotNull() & keep(pair["hit"])
            spans = F.when(wanted, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
            return F.struct(end.alias("at"), spans.alias("spans"))

        start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
        return F.when(F.size(found) == 0, empty).otherwise(F.aggregate(pairs, start, step, lambda s: s["spans"]))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), locate)


def long_value(hit: Column) -> Column:
    return F.length(F.regexp_extract(hit, "^" + ASSIGN, 1)) >= 12


def least_bits(candidate: Column) -> Column:
    """The bits a window of this candidate needs; null for a class that is not reported or on the allow list."""
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | candidate.rlike(pattern)
    return (
        F.when(allowed, F.lit(None))
        .when(candidate.rlike("^([0-9a-f]+|[0-9A-F]+)$"), F.lit(LEAST_BITS["hex"]))
        .when(candidate.rlike("^[A-Za-z0-9]+$"), F.lit(LEAST_BITS["alphanumeric"]))
        .otherwise(F.lit(LEAST_BITS["symbols"]))
    )


def entropy_hull(candidate: Column, bits: Column, window: int = WINDOW) -> Column:
    """``(first, last)`` start of the windows whose Shannon entropy reaches ``bits``; -1 where there is none.

    Sliding by one character changes two counts: that of the character that leaves and that of the one
    that enters. The sum of ``c log2 c`` follows by those two terms.
    """
    terms = F.array(*[F.lit(round(c * math.log2(c) * UNIT) if c else 0) for c in range(window + 2)]).cast("array<bigint>")
    count = lambda text, char: F.length(text) - F.length(F.replace(text, char))
    most = F.lit(window * math.log2(window) * UNIT) - bits * float(window * UNIT)  # largest sum of c log2 c that still reaches the bits

    def first_sum(head: Column) -> Column:
        chars = F.array_distinct(F.split(head, ""))
        return F.aggregate(
            F.filter(chars, lambda c: c != ""), F.lit(0).cast("bigint"), lambda s, c: s + F.get(terms, count(head, c))
        )

    def step(state: Column, at: Column) -> Column:
        old = F.substring(candidate, at, F.lit(window))  # the window that starts one character earlier
        gone, new = F.substring(candidate, at, F.lit(1)), F.substring(candidate, at + window, F.lit(1))
        c = count(old, gone)
        d = count(old, new) - (gone == new).cast("int")
        total = state["sum"] - F.get(terms, c) + F.get(terms, c - 1) - F.get(terms, d) + F.get(terms, d + 1)
        hit = total <= most
        return F.struct(
            total.alias("sum"),
            F.when(hit & (state["first"] < 0), at).otherwise(state["first"]).alias("first"),
            F.when(hit, at).otherwise(state["last"]).alias("last"),
        )

    def scan(total: Column) -> Column:
        at = F.when(total <= most, F.lit(0)).otherwise(F.lit(-1))
        start = F.struct(total.alias("sum"), at.alias("first"), at.alias("last"))
        slides = F.when(F.length(candidate) > window, F.sequence(F.lit(1), F.length(candidate) - window)).otherwise(
            F.array().cast("array<int>")
        )
        return F.aggregate(slides, start, step)

    return let(first_sum(F.substring(candidate, 1, window)), scan)


def entropy_spans(text: Column) -> Column:
    """One span a candidate string: from the first to the last window of enough entropy."""

    def located(candidates: Column) -> Column:
        texts = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))

        def judged(pair: Column) -> Column:
            span, word = pair["span"], pair["word"]
            bits = least_bits(word)
            none = F.struct(F.lit(-1).alias("first"), F.lit(-1).alias("last"))

            def hull(need: Column) -> Column:
                found = entropy_hull(word, need)
                return F.when(need.isNull(), none).otherwise(F.struct(found["first"].alias("first"), found["last"].alias("last")))

            return let(
                let(bits, hull),
                lambda h: F.struct(
                    (span["start"] + h["first"]).alias("start"),
                    F.when(h["first"] >= 0, span["start"] + h["last"] + WINDOW).otherwise(F.lit(-1)).alias("end"),
                    F.lit(KINDS.index("entropy")).alias("kind"),
                ),
            )

        zipped = F.zip_with(candidates, texts, lambda s, w: F.struct(s.alias("span"), w.alias("word")))
        return F.filter(F.transform(zipped, judged), lambda s: s["end"] >= 0)

    return let(matches(text, CANDIDATE, "entropy", lambda hit: F.lit(True)), located)


def find_secrets(docs: DataFrame, name: str = "spans") -> DataFrame:
    """``docs`` with a column ``name`` (replaced where it exists): sorted (start, end, kind) in code points, kinds numbered as in ``KINDS``.

    A null text is empty, an empty text has no spans. Repeated rows are judged alike and kept. Per kind the spans are
    disjoint; different kinds may overlap. Allowed strings (words, numbers, UUIDs, placeholders, paths) are
    suppressed for the entropy kind only. Work is linear in the text; a text of m reported spans copies their
    list m times, which matters only for texts that are secrets throughout.
    """
    text = F.col("_scanned")
    always = lambda hit: F.lit(True)
    found = F.concat(
        matches(text, ASSIGN, "assign", long_value), matches(text, ACCESS, "access", always), matches(text, HEX, "hex", always),
        entropy_spans(text),
    )
    by_start = F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return docs.withColumn("_scanned", text_or_empty()).withColumn(name, F.array_sort(by_start)).drop("_scanned")


def span_text(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(docs: DataFrame) -> DataFrame:
    """Per document: counts per base kind, the digest of the base spans, and all spans as text."""
    found = find_secrets(docs.select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
    base = F.filter("spans", lambda s: s["kind"] < KINDS.index("entropy"))
    return found.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        of("entropy").alias("n_entropy"), F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by ``mask``, touching or overlapping spans by one. A null text
    stays null."""
    found = find_secrets(docs, "_spans")
    text = F.col("text")

    def step(state: Column, span: Column) -> Column:
        fresh = span["start"] > state["end"]
        gap = F.substring(text, state["end"] + 1, span["start"] - state["end"])
        return F.struct(
            F.greatest(state["end"], span["end"]).alias("end"),
            F.when(fresh | (state["end"] == 0), F.concat(state["out"], gap, F.lit(mask))).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("end"), F.lit("").alias("out"))
    clean = F.aggregate("_spans", start, step, lambda s: F.concat(s["out"], F.substring(text, s["end"] + 1, F.length(text))))
    return found.withColumn("text", F.when(F.size("_spans") == 0, text).otherwise(clean)).drop("_spans")
