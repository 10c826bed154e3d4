"""Delimited-line parsers (P1-P5) as column expressions.

The reference splits a line on ``,``, trims each field and converts it
with ``toLong``; a bad line throws and fails the job.  Here every parser
is one Catalyst expression, so it runs inside whole-stage codegen.

``strict=True`` (default) keeps the fail-on-bad-input behaviour: the ANSI
cast raises ``CAST_INVALID_INPUT`` and indexing past the last field raises
``INVALID_ARRAY_INDEX``.  ``strict=False`` yields nulls instead
(``try_cast`` and ``get``), for callers that route bad lines aside.

Two details follow the JVM string rules the reference relies on:
``String.split`` drops trailing empty fields, and ``trim`` strips every
character up to U+0020, not just the space.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The field separator of every line format, and the
# characters a JVM ``trim`` removes (code points 0 to 32).
SEPARATOR = ","
TRIMMED = "".join(map(chr, range(33)))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jtrim(c) -> Column:
    """Trim like the JVM: strip chars <= U+0020 at both ends."""
    return F.btrim(_col(c), F.lit(TRIMMED))


def split_fields(line) -> Column:
    """Split a line on the separator, dropping trailing empty fields."""
    body = F.rtrim(_col(line), F.lit(SEPARATOR))
    return F.split(body, SEPARATOR, -1)


def field(parts: Column, i: int, strict: bool = True) -> Column:
    """Field ``i`` (0-based), trimmed.  Strict raises when it is missing."""
    raw = parts[i] if strict else F.get(parts, i)
    return jtrim(raw)


def to_long(c: Column, strict: bool = True) -> Column:
    """``toLong``: ANSI cast (raises) or ``try_cast`` (null)."""
    return c.cast("bigint") if strict else c.try_cast("bigint")


def parse_fields(line, spec: list[tuple[str, str]], strict: bool = True) -> Column:
    """Parse a line into a struct; ``spec`` is ``[(name, 'long'|'string')]``.

    Fields past ``len(spec)`` are ignored, as in the reference.
    """
    parts = split_fields(line)
    cols = []
    for i, (name, kind) in enumerate(spec):
        v = field(parts, i, strict)
        if kind == "long":
            v = to_long(v, strict)
        cols.append(v.alias(name))
    return F.struct(*cols)


def parse_pair(line, first: str = "first", second: str = "second",
               strict: bool = True) -> Column:
    """``"a, b"`` -> struct of two longs."""
    return parse_fields(line, [(first, "long"), (second, "long")], strict)


def parse_nav_update(line, strict: bool = True) -> Column:
    """``"nav, unitValue"`` -> struct(nav_id, unit_value)."""
    return parse_pair(line, "nav_id", "unit_value", strict)


def parse_ownership(line, strict: bool = True) -> Column:
    """``"nav, user, share"`` -> struct(nav_id, owning struct(user_id, share))."""
    flat = parse_fields(line, [("nav_id", "long"), ("user_id", "long"),
                               ("share", "long")], strict)
    return F.struct(flat["nav_id"].alias("nav_id"),
                    F.struct(flat["user_id"].alias("user_id"),
                             flat["share"].alias("share")).alias("owning"))


# Field layouts of the two transaction line formats.
DEBIT_SPEC = [("trans_id", "long"), ("timestamp", "long"),
              ("account_id", "string"), ("amount", "string")]
CREDIT_SPEC = [("trans_id", "long"), ("timestamp", "long"),
               ("credit_card_id", "string"), ("holder_name", "string"),
               ("amount", "string")]


def parse_debit(line, strict: bool = True) -> Column:
    """``"id, ts_ms, account, amount"``."""
    return parse_fields(line, DEBIT_SPEC, strict)


def parse_credit(line, strict: bool = True) -> Column:
    """P5: ``"id, ts_ms, card, holder, amount"``."""
    return parse_fields(line, CREDIT_SPEC, strict)
