"""Regex capture over text columns with built-in expressions only.

The reference patterns were written for Python's `re`; `rx` adds the inline flags that make
Java's engine agree with it: `d` (only ``\\n`` ends a line) and `U` (Unicode ``\\s \\d \\w \\b``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MATCH = "\u0001"  # brackets a match inside a marked text
FIELD = "\u0002"  # separates captured groups inside a match

#: What Python's str.strip() removes.
WHITESPACE = (
    " \t\n\r\u000b\u000c\u001c\u001d\u001e\u001f\u0085       "
    "          　"
)
#: What Python's str.splitlines() splits on.
LINE_BREAK = "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085  ]"


def rx(pattern: str, flags: str = "") -> str:
    return f"(?dU{flags}){pattern}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind `value` once and use it several times; lambdas have no common-subexpression elimination."""
    return F.transform(F.array(value), body)[0]


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row however often later steps refer to them.

    Plain projections are merged by the optimizer, which then copies a costly expression into every place
    that uses it. Expanding a one-element array keeps the steps apart without a shuffle.
    """
    row = F.struct(*(c.alias(name) for name, c in columns.items()))
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(row)))


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def squeeze(col: Column) -> Column:
    """Collapse every whitespace run to one space and trim. A run that is one space already is not matched.

    Of what `strip` removes only the space and four separators, which are no white space to patterns, can be left."""
    return F.btrim(F.regexp_replace(col, rx(r"[^\S ]\s*+| \s++"), " "), F.lit(" \u001c\u001d\u001e\u001f"))


def blank_to_null(col: Column) -> Column:
    # not nullif on the column itself: inside CASE or coalesce it evaluates its argument, often a regex, twice; nor a lambda, which is
    # interpreted
    return F.get(F.array_remove(F.array(col), F.lit("")), F.lit(0))


def unmarked(text: Column) -> Column:
    """Replace the two marker characters, should a text hold them, by another control character.

    Translating goes character by character, looking for a marker does not."""
    return let(text, lambda t: F.when(t.contains(MATCH) | t.contains(FIELD), F.translate(t, MATCH + FIELD, "\u0003\u0003")).otherwise(t))


def first_match(text: Column, *patterns: tuple[str, int]) -> Column:
    """Group of the first pattern that matches, else null.

    Every group passed here takes at least one character, so an empty extract means "no match" and
    the chain needs one regex evaluation per tried pattern. Whatever the caller does with the text
    afterwards, a later pattern is not tried once an earlier one has matched.
    """
    return F.coalesce(*(blank_to_null(F.regexp_extract(text, p, g)) for p, g in patterns))


def capture_line(line: Column, *patterns: tuple[str, Sequence[int]]) -> Column:
    """Captured groups of the first anchored pattern that fits the line, as an array of strings.

    Each pattern comes with the group numbers in output order, 0 standing for "absent". A line that
    fits no pattern yields an array of one element. One replace per tried pattern, no re-matching
    per group: once a pattern has fitted, the separators keep later patterns from matching.
    """
    out = line
    for pattern, groups in patterns:
        out = F.regexp_replace(out, pattern, FIELD.join(f"${g}" if g else "" for g in groups))
    return F.split(out, FIELD)


def captures(text: Column, pattern: str, groups: Sequence[int]) -> Column:
    """All matches in order, each as an array of its groups; one regex pass over the text."""
    marked = F.regexp_replace(text, pattern, MATCH + FIELD.join(f"${g}" for g in groups) + MATCH)
    pieces = F.split(marked, MATCH)
    odd = F.filter(pieces, lambda _, i: i % 2 == 1)
    return F.transform(odd, lambda m: F.split(m, FIELD))


def running_fold(
    items: Column, start: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str, chunk: int = 256
) -> Column:
    """Fold `items` from the left; `step(state, item)` gives the next state and an element to emit, null for none.

    Appending to an array copies it. Elements are gathered a chunk at a time and the chunks flattened at the end,
    so that no long array is copied for each of its elements.
    """
    none = F.expr(f"cast(array() as array<{kind}>)")

    def chunks(whole: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(whole) - 1, F.lit(0)), F.lit(chunk))
        return F.transform(starts, lambda at: F.slice(whole, at + 1, chunk))

    def one(acc: Column, item: Column) -> Column:
        state, found = step(acc["state"], item)
        grown = let(found.cast(kind), lambda f: F.when(f.isNull(), acc["out"]).otherwise(F.array_append(acc["out"], f)))
        return F.struct(state.alias("state"), grown.alias("out"))

    def many(acc: Column, part: Column) -> Column:
        inside = F.aggregate(part, F.struct(acc["state"].alias("state"), none.alias("out")), one)
        return let(
            inside, lambda r: F.struct(r["state"].alias("state"), F.array_append(acc["out"], r["out"]).alias("out"))
        )

    lists = F.expr(f"cast(array() as array<array<{kind}>>)")
    return F.flatten(F.aggregate(let(items, chunks), F.struct(start.alias("state"), lists.alias("out")), many, lambda acc: acc["out"]))


def running_states(items: Column, start: Column, step: Callable[[Column, Column], Column], kind: str, chunk: int = 256) -> Column:
    """Fold `items` from the left; the state after each of them, as an array: `step(state, item)` gives the next state, of type `kind`.

    The last element of what is gathered is the state, so that a step makes no struct. Appending to an array copies it: elements are
    gathered a chunk at a time and the chunks flattened at the end, so that no long array is copied for each of its elements.
    """
    last = F.lit(-1)

    def chunks(whole: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(whole) - 1, F.lit(0)), F.lit(chunk))
        return F.transform(starts, lambda at: F.slice(whole, at + 1, chunk))

    def inside(part: Column, state: Column) -> Column:
        first = F.array(state.cast(kind))
        return F.aggregate(part, first, lambda acc, item: F.array_append(acc, step(F.element_at(acc, last), item).cast(kind)))

    def many(acc: Column, part: Column) -> Column:
        # each chunk begins with the state it was given
        return F.array_append(acc, inside(part, F.element_at(F.element_at(acc, last), last)))

    none = F.array(F.array(start.cast(kind)))
    gathered = F.aggregate(let(items, chunks), none, many, lambda acc: F.slice(acc, 2, F.size(acc)))
    return F.flatten(F.transform(gathered, lambda part: F.slice(part, 2, F.size(part))))


def located_captures(text: Column, pattern: str, groups: Sequence[int]) -> Column:
    """All matches in order as struct(start, stop, fields); offsets count characters from 0."""
    marked = F.regexp_replace(
        text, pattern, MATCH + FIELD.join(["$0", *(f"${g}" for g in groups)]) + MATCH
    )

    def located(pieces: Column) -> Column:
        # a gap has one part, a match has the matched text and its groups; they alternate
        lengths = F.transform(pieces, lambda p: F.length(F.substring_index(p, FIELD, 1)))
        odd = F.filter(pieces, lambda _, i: i % 2 == 1)
        return let(running_states(lengths, F.lit(0), lambda at, n: at + n, "int"), lambda stops: F.transform(odd, lambda m, i: F.struct(
            F.get(stops, i * 2).alias("start"), F.get(stops, i * 2 + 1).alias("stop"),
            F.slice(F.split(m, FIELD), 2, len(groups)).alias("fields"))))

    return let(F.split(marked, MATCH), located)


def text_lines(text: Column) -> Column:
    return F.split(unmarked(text), LINE_BREAK)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)
