"""Secret scan: fixed patterns, and strings whose characters look random in some sliding window.

Everything is an expression on the row: no shuffle, no Python, and a text of any length is read whole.
A NULL text counts as empty; rows are independent, so repeated rows give repeated results and an empty
table an empty one; other columns are kept, and the new ones can be named.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from rillstone.llm.common import let, whole_text

# The patterns of the kinds, in the order that settles equal starts.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

#: a candidate string of the entropy scan; it also needs a digit and a letter
CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
WINDOW = 20
#: bits per character that some window must reach, by character class
LIMITS = {"hex": 3.0, "base64": 3.8}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
#: whole strings that are never reported by the entropy scan
ALLOWED = (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r".*EXAMPLE.*",
    r".*(0123456789|abcdefghij|ABCDEFGHIJ).*",
    r"(.)\1*",
    r"[a-z]+([-_/][a-z]+)*[-_/]?[0-9]{0,4}",
)

SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def running(values: Column, combine: Callable[[Column, Column], Column], back: bool = False) -> Column:
    """Each element combined with all before it (``back``: behind it), in as many rounds as the array's size has
    binary digits: a round takes in what the element 1, 2, 4, ... places away has gathered. ``combine`` is associative."""
    powers = F.array(*[F.lit(1 << k) for k in range(31)])

    def take_in(state: Column, step: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            far = F.get(state, i + step if back else i - step)
            return F.when(far.isNull(), x).otherwise(combine(x, far))

        return F.transform(state, one)

    def rounds(size: Column) -> Column:
        return F.filter(powers, lambda step: step < size)

    return let(values, lambda known: F.aggregate(let(F.size(known), rounds), known, take_in))


def located(text: Column, pattern: str, kind: int) -> Column:
    """Every leftmost, non-overlapping match with its place in code points. The lengths of matches and of the pieces
    between them, added up, give the places; a match never is empty, so there is one piece more than matches."""

    def placed(found: Column) -> Column:
        lengths = F.zip_with(
            F.split(text, pattern, -1), found, lambda gap, match: F.length(gap) + F.coalesce(F.length(match), F.lit(0))
        )
        ends = F.slice(running(lengths, lambda x, y: x + y), F.lit(1), F.size(found))
        return F.zip_with(
            found,
            ends,
            lambda match, end: F.struct(
                (end - F.length(match)).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), match.alias("value")
            ),
        )

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed).cast(SPAN)


def top_entropy(value: Column, window: int) -> Column:
    """The highest Shannon entropy, in bits per character, of the string's windows.

    Counts of the characters in the window are kept from one window to the next: the character that comes in
    adds one, the one that goes out takes one, and sum(c log c) changes by these two terms only. The counts are a few
    bits each, packed into whole numbers: 7 of them for the alphabet and a window of 20.
    """

    bits = window.bit_length()
    per_word = 62 // bits
    words = len(ALPHABET) // per_word + 1

    def weight(count: Column) -> Column:
        return F.when(count > 0, count * F.log2(count)).otherwise(F.lit(0.0))

    def one(code: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), (code % per_word) * bits)

    def word(code: Column) -> Column:
        return F.floor(code / per_word).cast("int")

    def count(counts: Column, code: Column) -> Column:
        packed = F.get(counts, word(code))
        return F.call_function("shiftright", packed, (code % per_word) * bits).bitwiseAND(F.lit((1 << bits) - 1))

    def changed(counts: Column, code: Column, by: int) -> Column:
        return F.transform(counts, lambda c, at: F.when(at == word(code), c + by * one(code)).otherwise(c))

    def body(codes: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            # the character that goes out first, then the one that comes in
            gone = F.get(codes, F.greatest(i - window, F.lit(0)))
            n_gone = count(state["counts"], gone)
            less = F.when(
                i >= window,
                F.struct(
                    changed(state["counts"], gone, -1).alias("counts"),
                    (state["total"] + weight(n_gone - 1) - weight(n_gone)).alias("total"),
                ),
            ).otherwise(F.struct(state["counts"].alias("counts"), state["total"].alias("total")))

            def more(now: Column) -> Column:
                come = F.get(codes, i)
                n_come = count(now["counts"], come)
                total = now["total"] + weight(n_come + 1) - weight(n_come)
                reached = F.when(i >= window - 1, F.log2(F.lit(float(window))) - total / window).otherwise(F.lit(0.0))
                return F.struct(
                    changed(now["counts"], come, 1).alias("counts"),
                    total.alias("total"),
                    F.greatest(state["best"], reached).alias("best"),
                )

            return let(less, more)

        start = F.struct(
            F.array_repeat(F.lit(0).cast("bigint"), words).alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("best")
        )
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step, lambda state: state["best"])

    characters = F.regexp_extract_all(value, F.lit("(?s)."), F.lit(0))
    return let(F.transform(characters, lambda c: F.instr(F.lit(ALPHABET), c)), body)


def looks_random(value: Column, window: int, limits: dict[str, float], allowed: tuple[str, ...]) -> Column:
    fine = F.lit(False)
    for pattern in allowed:
        fine = fine | value.rlike(f"^(?s:{pattern})$")
    limit = F.when(value.rlike("^[0-9a-fA-F]+$"), F.lit(limits["hex"])).otherwise(F.lit(limits["base64"]))
    return F.when(
        value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~fine, top_entropy(value, window) >= limit
    ).otherwise(F.lit(False))


def find_secrets(
    docs: DataFrame,
    text: str = "text",
    out: str = "secrets",
    window: int = WINDOW,
    limits: dict[str, float] | None = None,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """Adds ``out``: the secrets as structs (start, kind number, end, value), by start, then kind.

    Kinds 0 to 2 are the fixed patterns. Kind 3 are candidate strings with a window of ``window`` characters whose
    entropy reaches the limit of their character class, unless the allow-list has them or a fixed pattern
    already reports characters of theirs.
    """
    body = whole_text(text)
    none = F.array().cast(SPAN)

    def assigned(span: Column) -> Column:
        return F.length(F.regexp_extract(span["value"], ASSIGN, 2)) >= 6

    assign = F.when(
        body.rlike("(?i:password|passwd|secret|token|api_?key)"), F.filter(located(body, ASSIGN, 0), assigned)
    ).otherwise(none)
    access = F.when(body.contains("AKIA"), located(body, ACCESS, 1)).otherwise(none)
    runs = F.when(body.rlike(HEX), located(body, HEX, 2)).otherwise(none)
    candidates = F.when(body.rlike(CANDIDATE), located(body, CANDIDATE, 3)).otherwise(none)

    def random_ones(spans: Column) -> Column:
        """Without the candidates that a fixed pattern touches or that do not look random. In the order of starts a
        candidate is touched if an earlier pattern's span ends behind its start, or the next one starts before its end."""
        ends = F.transform(spans, lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(F.lit(-1)))
        starts = F.transform(spans, lambda s: F.when(s["kind"] < 3, s["start"]).otherwise(F.lit(2**31 - 1)))
        near = F.arrays_zip(
            spans.alias("span"),
            running(ends, F.greatest).alias("reached"),
            running(starts, F.least, back=True).alias("ahead"),
        )

        def stays(at: Column) -> Column:
            span = at["span"]
            covered = (at["reached"] > span["start"]) | (at["ahead"] < span["end"])
            return (span["kind"] < 3) | (~covered & looks_random(span["value"], window, limits or LIMITS, allowed))

        return F.transform(F.filter(near, stays), lambda at: at["span"])

    def joined(spans: Column) -> Column:
        return F.when(F.exists(spans, lambda s: s["kind"] == 3), let(F.sort_array(spans), random_ones)).otherwise(F.sort_array(spans))

    return docs.withColumn(out, let(F.concat(assign, access, runs, candidates), joined))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def redact(docs: DataFrame, text: str = "text", secrets: str = "secrets", mark: str = "[SECRET]") -> DataFrame:
    """The text with each stretch that secrets cover replaced by one ``mark``."""
    size = 1024
    blocks = F.regexp_extract_all(whole_text(text), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))

    def between(parts: Column, start: Column, end: Column) -> Column:
        """Characters ``start`` to ``end``, put together from the blocks that have them."""
        first = F.floor(start / size).cast("int")
        rows = F.sequence(first, F.floor((end - 1) / size).cast("int"))
        joined = F.array_join(F.transform(rows, lambda row: F.get(parts, row)), "")
        return F.when(end > start, F.substring(joined, start - first * size + 1, end - start)).otherwise(F.lit(""))

    def marked(parts: Column) -> Column:
        reached = running(F.transform(F.col(secrets), lambda s: s["end"]), F.greatest)

        def kept(reached: Column) -> Column:
            def piece(span: Column, i: Column) -> Column:
                before = F.coalesce(F.get(reached, i - 1), F.lit(0))
                return F.when(span["start"] >= before, between(parts, before, span["start"]))

            pieces = F.filter(F.transform(F.col(secrets), piece), lambda p: p.isNotNull())
            rest = between(parts, F.element_at(reached, -1), F.length(whole_text(text)))
            return F.array_join(F.concat(pieces, F.array(rest)), mark)

        return let(reached, kept)

    return docs.withColumn(text, F.when(F.size(secrets) > 0, let(blocks, marked)).otherwise(F.col(text)))
