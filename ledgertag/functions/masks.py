r"""The mask language, as column expressions.

A rule keeps a list of masks in one string. Commas separate masks, ``/,`` is a
comma inside a mask, ``?`` stands for one character, ``%`` for any run of
characters. A mask covers the whole value and is case-sensitive. ``_`` and ``\``
keep the meaning they have for LIKE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separator, its escape, and what counts as blank at the ends.
SEPARATOR = r"(?<!/),"
ESCAPED_COMMA = "/,"
EDGE_BLANKS = r"\A[\x00-\x20]+|[\x00-\x20]+\z"

# Separators at the very end make no masks of their own.
_TRAILING = r"(?<!/),+\z"
# Characters that LIKE treats specially.
_SPECIAL = r"[%_\\]"
_PLAIN = r"[^%_\\]"
# A LIKE pattern whose escapes are all allowed ones.
_VALID = r"\A(?:[^\\]++|\\[%_\\])*+\z"

# Masks with wildcards that any list may have and still be checked without higher-order functions.
SLOTS = 3
# Marks masks that fit values of any length.
ANY_LENGTH = 2**31 - 1


def compile_masks(mask_list: Column) -> Column:
    """``array<string>`` of LIKE patterns; empty when the list is null or blank."""
    kept = F.regexp_replace(mask_list, _TRAILING, "")
    pieces = F.split(kept, SEPARATOR)
    patterns = F.transform(pieces, _pattern)
    return F.when(F.coalesce(kept, F.lit("")) == "", _no_masks()).otherwise(patterns)


def _pattern(piece: Column) -> Column:
    plain = F.replace(piece, F.lit(ESCAPED_COMMA), F.lit(","))
    return F.translate(F.regexp_replace(plain, EDGE_BLANKS, ""), "?", "_")


def _no_masks() -> Column:
    return F.array().cast("array<string>")


def has_wildcard(mask_list: Column) -> Column:
    """Does the raw list use ``%`` or ``?`` anywhere?"""
    return mask_list.rlike("[%?]")


def all_valid(patterns: Column) -> Column:
    """Every pattern is one that LIKE accepts."""
    return F.forall(patterns, lambda p: p.rlike(_VALID))


def is_literal(pattern: Column) -> Column:
    """The pattern matches exactly one value: itself."""
    return ~pattern.rlike(_SPECIAL)


def literal_prefix(pattern: Column) -> Column:
    """Characters that every matching value starts with."""
    return F.regexp_extract(pattern, r"\A" + _PLAIN + "*", 0)


def any_like(value: Column, patterns: Column) -> Column:
    """``value LIKE`` any of the patterns, null when the value is null."""
    return F.exists(patterns, lambda p: F.like(value, p))


def literal_suffix(pattern: Column) -> Column:
    """Characters that every matching value ends with."""
    return F.regexp_extract(pattern, _PLAIN + r"*\z", 0)


def parse_masks(patterns: Column) -> Column:
    """LIKE patterns taken apart: an array of structs.

    A value that fits ``mask`` starts with ``head``, ends with ``tail``, holds ``run``, the longest fixed text, and has ``least`` to
    ``most`` characters. For an ``exact`` mask that is also enough; others (text between wildcards, escapes) must be
    checked with LIKE, which compiles a regular expression per row when its pattern is a column. A framed value that fits
    holds ``text``; for a mask that is ``told`` by it, that is enough if it has ``length`` characters (-1 for any).
    """
    return F.transform(patterns, _parsed)


def _parsed(p: Column) -> Column:
    head, tail, literal = literal_prefix(p), literal_suffix(p), is_literal(p)
    runs = F.regexp_extract_all(p, F.lit(_PLAIN + "+"), F.lit(0))
    longest = F.array_max(F.transform(runs, lambda r: F.struct(F.char_length(r).alias("n"), r.alias("text"))))["text"]
    run = F.coalesce(longest, F.lit(""))
    open_ended = F.contains(F.regexp_replace(p, r"(?s)\\.", ""), F.lit("%"))
    size = F.char_length(F.regexp_replace(p, r"(?s)\\(.)|%", "$1"))
    # At most one run of fixed text at each end, or one that may stand anywhere.
    ends_only = p.rlike(rf"\A{_PLAIN}*[%_]*{_PLAIN}*\z")
    held = p.rlike(rf"\A%+{_PLAIN}+%+\z")
    # What to look for in a framed value.
    text = (
        F.when(literal, F.concat(edge(), p, edge()))
        .when(p.rlike(r"\A%+\z"), edge())
        .when((run != "") & (run == head), F.concat(edge(), head))
        .when((run != "") & (run == tail), F.concat(tail, edge()))
        .otherwise(run)
    )
    one_end = p.rlike(rf"\A(?:{_PLAIN}*%+|%+{_PLAIN}*)\z")
    counted = p.rlike(rf"\A(?:{_PLAIN}*_+|_+{_PLAIN}*)\z")
    return F.struct(
        p.alias("mask"),
        literal.alias("literal"),
        head.alias("head"),
        tail.alias("tail"),
        run.alias("run"),
        size.alias("least"),
        F.when(open_ended, ANY_LENGTH).otherwise(size).alias("most"),
        (ends_only | held).alias("exact"),
        text.alias("text"),
        F.when(counted & ~literal, size).otherwise(-1).alias("length"),
        (literal | held | one_end | counted).alias("told"),
    )


def fits(value: Column, mask: Column) -> Column:
    """Whether a value fits a parsed mask; LIKE only where nothing cheaper refuses it."""
    size = F.char_length(value)
    return (
        F.startswith(value, mask["head"])
        & F.endswith(value, mask["tail"])
        & F.contains(value, mask["run"])
        & size.between(mask["least"], mask["most"])
        & (mask["exact"] | F.like(value, mask["mask"]))
    )


def any_mask(value: Column, masks: Column) -> Column:
    """Same result as :func:`any_like`, over the output of :func:`parse_masks`."""
    return F.exists(masks, lambda m: fits(value, m))


def edge() -> Column:
    """Stands before and after a framed value: a byte that no text in UTF-8 has."""
    return F.lit(bytearray(b"\xff")).cast("string")


def framed(value: Column) -> Column:
    """The value between two edges, so that its ends can be looked for as well; empty for null."""
    return F.coalesce(F.concat(edge(), value, edge()), F.lit(""))


def frames(masks: Column, required: Column, slots: Column) -> Column:
    """A parsed list as texts to look for in a framed value: ``struct<n, whole, texts, sizes, exact>``.

    Whole values are listed, framed, in ``whole``. A value passes if it is one of them, or holds one of the ``texts`` (as many as
    there are ``slots``) and has that text's number of characters (-1 for any). An empty list lets everything pass. Where texts
    can't decide, the form isn't ``exact``: it lets too much pass, whether the list is ``required`` or excludes.
    """
    others = F.filter(masks, lambda m: ~m["literal"])
    few = F.size(others) <= slots
    exact = few & F.forall(others, lambda m: m["told"])
    open_ = F.struct(F.lit("").alias("text"), F.lit(-1).alias("size"))
    never = F.concat(edge(), edge(), edge())
    found = F.transform(others, lambda m: F.struct(m["text"].alias("text"), m["length"].alias("size")))
    found = (
        F.when(exact | (required & few), F.when(F.size(masks) == 0, F.array(open_)).otherwise(found))
        .when(required, F.array(open_))
        .otherwise(F.slice(found, 1, 0))
    )

    def each(of: str, other: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda k: F.coalesce(F.get(found, k)[of], other))

    whole = F.transform(F.filter(masks, lambda m: m["literal"]), lambda m: m["text"])
    return F.struct(
        F.size(masks).alias("n"),
        F.when(exact | required, whole).otherwise(F.slice(whole, 1, 0)).alias("whole"),
        each("text", never).alias("texts"),
        each("size", F.lit(-1)).alias("sizes"),
        exact.alias("exact"),
    )
