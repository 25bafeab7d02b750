"""Character references of HTML, decoded by expressions: numeric ones by their number, named ones by the standard table."""

from __future__ import annotations

import html.entities
import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The standard library's names; those without a semicolon count in front of other letters, too.
NAMED = {k: v for k, v in html.entities.html5.items() if k.endswith(";")}
BARE = sorted((k for k in html.entities.html5 if not k.endswith(";")), key=lambda k: (-len(k), k))
# Numbers 128 to 159 that stand for characters of Windows-1252 (others of that range are dropped).
WINDOWS = {
    0x80: "€", 0x82: "‚", 0x83: "ƒ", 0x84: "„", 0x85: "…", 0x86: "†", 0x87: "‡", 0x88: "ˆ", 0x89: "‰", 0x8A: "Š", 0x8B: "‹", 0x8C: "Œ", 0x8E: "Ž", 0x91: "‘", 0x92: "’",
    0x93: "“", 0x94: "”", 0x95: "•", 0x96: "–", 0x97: "—", 0x98: "˜", 0x99: "™", 0x9A: "š", 0x9B: "›", 0x9C: "œ", 0x9E: "ž", 0x9F: "Ÿ",
}
NUMBER = r"\A&#(?:([0-9]+)|[xX]([0-9a-fA-F]+));?"
NAME = r"\A&([A-Za-z][A-Za-z0-9]*;)"
PREFIX = r"\A&(" + "|".join(map(re.escape, BARE)) + ")"


def table(names: dict) -> Column:
    """A constant map; it is parsed once, whatever its size."""
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def character(code: Column) -> Column:
    """The character of a number; the replacement character for what is none, '' for controls."""
    odd = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    text = F.decode(F.unhex(F.lpad(F.hex(F.when(odd, 0xFFFD).otherwise(code)), 8, "0")), "UTF-32")
    gone = code.between(1, 8) | code.between(0xE, 0x1F) | (code == 0xB) | code.between(0x7F, 0x9F) | code.between(0xFDD0, 0xFDEF) | ((code % 0x10000) >= 0xFFFE)
    return F.when(code == 0x0D, "\r").when(code.isin(0x81, 0x8D, 0x8F, 0x90, 0x9D), text).when(code.between(0x80, 0x9F), table({str(k): v for k, v in WINDOWS.items()})[code.cast("string")]).when(odd, text).when(gone, "").otherwise(text)


def decoded(c: Column, bare: bool = True) -> Column:
    """The text with its references decoded once, from left to right; what is none stays.

    Without ``bare`` only those count that end in a semicolon.
    """
    def first(part: Column) -> Column:
        rest = lambda pattern: F.regexp_replace(part, pattern, "")
        decimal, hexadecimal = F.regexp_extract(part, NUMBER, 1), F.regexp_extract(part, NUMBER, 2)
        plain = lambda digits, n: F.when(F.length(F.ltrim(digits, F.lit("0"))) <= n, digits).otherwise("110000" if n == 8 else str(0x110000))
        number = F.when(decimal != "", plain(decimal, 9).try_cast("long")).otherwise(F.conv(plain(hexadecimal, 8), 16, 10).try_cast("long"))
        named = table(NAMED)[F.regexp_extract(part, NAME, 1)]
        prefix = F.regexp_extract(part, PREFIX, 1)
        if not bare:
            whole = NUMBER.removesuffix("?")
            return F.when(part.rlike(whole), F.concat(character(number), rest(whole))).when(part.rlike(NAME) & named.isNotNull(), F.concat(named, rest(NAME))).otherwise(part)
        return (
            F.when(part.rlike(NUMBER), F.concat(character(number), rest(NUMBER)))
            .when(part.rlike(NAME) & named.isNotNull(), F.concat(named, rest(NAME)))
            .when(prefix != "", F.concat(table({k: html.entities.html5[k] for k in BARE})[prefix], rest(PREFIX)))
            .otherwise(part)
        )

    parts = F.split(c, "(?=&)")
    return F.when(c.contains("&"), F.array_join(F.transform(parts, lambda p: F.when(p.startswith("&"), first(p)).otherwise(p)), "")).otherwise(c)
