"""String expressions."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Literal replacements, applied in this order.
LITERAL_FIXES = (
    ("#39;", "'"),
    ("amp;", "&"),
    ("#146;", "'"),
    ("nbsp;", " "),
    ("#36;", "$"),
    ("\\n", "\n"),
    ("quot;", "'"),
    ("<br />", "\n"),
    ('\\"', '"'),
    ("<unk>", "u_n"),
    (" @.@ ", "."),
    (" @-@ ", "-"),
    ("\\", " \\ "),
)

# Question patterns of the parallel corpus.
QUESTION_PATTERNS = {"en": r"^(Wh[^?.!]+\?)", "fr": r"^([^?.!]+\?)"}

MARK_BEGIN = "xbos"
MARK_FIELD = "xfld"


def code_points() -> dict[int, str]:
    """Characters of numeric references that do not stand for themselves: Windows-1252 in the
    C1 range, and the replacement character for 0."""
    out = {0: "\ufffd"}
    for n in range(0x80, 0xA0):
        out[n] = bytes([n]).decode("cp1252", "ignore") or chr(n)
    return out


def _name_map(names: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])


def unescape(c: Column) -> Column:
    """Decode character references: all HTML names, decimal and hexadecimal numbers.

    The old names and numbers count without a semicolon too, the longest such name that the text
    goes on with. Numbers of no character (surrogates, above U+10FFFF) become U+FFFD, those of
    control characters and noncharacters vanish, unknown names stay. A reference is decoded
    once: `&amp;lt;` gives `&lt;`.

    The text is cut before each reference, and each piece looks at its own head only.
    """
    closed = {k: v for k, v in html5.items() if k.endswith(";")}
    old = {k: v for k, v in html5.items() if not k.endswith(";")}
    odd = F.create_map(*[F.lit(x) for pair in code_points().items() for x in pair])
    numeric = r"(?s)^&#([xX][0-9a-fA-F]+|[0-9]+);?(.*)$"
    name = r"(?s)^&([A-Za-z][A-Za-z0-9]*;)(.*)$"
    old_name = f"(?s)^&({'|'.join(sorted(old, key=len, reverse=True))})(.*)$"

    def number(piece: Column) -> Column:
        ref = F.regexp_extract(piece, numeric, 1)
        digits = F.regexp_replace(ref, "^[xX]?0*", "")
        size = F.length(digits)
        n = F.when(size <= 8, F.when(ref.rlike("^[xX]"), F.conv(digits, 16, 10)).otherwise(digits)).cast("bigint")
        n = F.coalesce(F.when(size == 0, F.lit(0)).otherwise(n), F.lit(0x110000))
        none = (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
        silent = n.between(1, 8) | (n == 0xB) | n.between(0xE, 0x1F) | (n == 0x7F) | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
        char = F.decode(F.unhex(F.lpad(F.conv(n.cast("string"), 10, 16), 8, "0")), "UTF-32")
        return F.when(none, "\ufffd").when(silent, "").otherwise(F.coalesce(F.try_element_at(odd, n.cast("int")), char))

    def decode(piece: Column) -> Column:
        named = F.try_element_at(_name_map(closed), F.regexp_extract(piece, name, 1))
        old_named = F.try_element_at(_name_map(old), F.regexp_extract(piece, old_name, 1))
        return (
            F.when(piece.rlike(numeric), F.concat(number(piece), F.regexp_extract(piece, numeric, 2)))
            .when(named.isNotNull(), F.concat(named, F.regexp_extract(piece, name, 2)))
            .when(old_named.isNotNull(), F.concat(old_named, F.regexp_extract(piece, old_name, 2)))
            .otherwise(piece)
        )

    decoded = F.array_join(F.transform(F.split(c, "(?=&)", -1), decode), "")
    return F.when(c.rlike("&[#A-Za-z]"), decoded).otherwise(c)


def fixup(c: Column) -> Column:
    """Undo escapes left by crawling, decode character references, collapse runs of blanks."""
    for old, new in LITERAL_FIXES:
        c = F.replace(c, F.lit(old), F.lit(new))
    return F.regexp_replace(unescape(c), "  +", " ")


def part(c: Column, sep: str, index: int) -> Column:
    """1-based piece of a separated text; negative counts from the end."""
    return F.split_part(c, F.lit(sep), F.lit(index))


def ascii_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


def strip_version(c: Column, n: int = 2) -> Column:
    """Drop the last ``n`` characters (the ``v1`` of a paper link)."""
    return F.substring(c, F.lit(1), F.greatest(F.length(c) - n, F.lit(0)))


def question(c: Column, lang: str) -> Column:
    """Leading question of a line; null when there is none."""
    return F.nullif(F.regexp_extract(c, QUESTION_PATTERNS[lang], 1), F.lit(""))


def marked(*fields: Column) -> Column:
    """One training text: begin mark, then every field with its number."""
    pieces = [F.lit(f"\n{MARK_BEGIN}")]
    for i, f in enumerate(fields, 1):
        pieces += [F.lit(f" {MARK_FIELD} {i} "), F.coalesce(f.cast("string"), F.lit(""))]
    return F.concat(*pieces)


def composed(**fields: Column) -> Column:
    """Fields joined as ``<name> value`` pieces."""
    return F.concat_ws(" ", *[F.concat(F.lit(f"<{n}> "), F.coalesce(c, F.lit(""))) for n, c in fields.items()])
