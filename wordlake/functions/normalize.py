"""Normal forms and row rules as Column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Word classes, patterns and names that decide which rows are taken.
HEADWORD = r"^[A-Za-z][A-Za-z' .-]*$"
WORD_PART = r"(?:[a-z]+(?:'[a-z]+)?|[a-z]+s')"
PLAIN_TOKEN = rf"^{WORD_PART}(?:-{WORD_PART})*$"
INITIALISM = r"^(?:[a-z]\.){2,}[a-z]?\.?$"
SHORT_ABBREVIATION = r"^[a-z]{1,5}\.$"
ARPABET = r"^(?:[A-Z]+[0-2]?)(?:\s+[A-Z]+[0-2]?)+$"
AFFIX_POS = ["prefix", "suffix", "infix", "circumfix", "combining form"]
ABBREVIATION_POS = ["abbr", "abbreviation", "acronym", "initialism"]
PHRASE_POS = ["phrase", "prep phrase", "prepositional phrase", "proverb", "idiom"]
POS_NAMES = {"n": "noun", "noun": "noun", "v": "verb", "verb": "verb", "a": "adj", "s": "adj", "adjective": "adj", "adjective_satellite": "adj", "r": "adv", "adverb": "adv"}
RELATED_RELATIONS = (
    "also attribute be_in_state causes derivation entails holo_location holo_member holo_part holo_portion holo_substance hypernym hyponym in_manner instance_hypernym "
    "instance_hyponym is_caused_by is_entailed_by is_subevent_of manner_of mero_location mero_member mero_part mero_portion mero_substance participle pertainym similar state_of subevent"
).split()
BANDS = [(6.0, "A1–A2"), (4.8, "B1–B2"), (3.4, "C1–C2")]
LAST_BAND = "C2+"
CJK = "[㐀-䶿一-鿿]"
LATIN_WORD = "[A-Za-z]+(?:['’-][A-Za-z]+)*"


@F.pandas_udf(StringType())
def nfkc(values: pd.Series) -> pd.Series:
    """Unicode compatibility form; there is no built-in function for it."""
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


def collapse(c: Column) -> Column:
    """White space runs become one space, ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " "))


def norm_key(c: Column, variant: str = "norm") -> Column:
    """Key of a term: ``norm`` and ``term`` (lower, one space, straight apostrophe), ``term_key``
    (NFKC first), ``lookup`` (trim and lower only), ``edge`` (as norm, apostrophes untouched)."""
    if variant == "lookup":
        return F.lower(F.trim(c))
    if variant == "term_key":
        plain = c.rlike(r"\A[\x00-\x7F]*\z")  # ASCII is its own compatibility form: only other texts go to Python
        c = F.coalesce(F.when(plain, c), nfkc(F.when(~plain, c)))
    if variant not in ("norm", "term", "term_key", "edge"):
        raise ValueError(f"unknown key variant {variant}")
    out = collapse(F.lower(c))
    return out if variant == "edge" else F.regexp_replace(out, "’", "'")


def admit_headword(df: DataFrame, word: str, max_len: int) -> DataFrame:
    """Rows whose word is a headword and whose key is at most ``max_len`` long."""
    key = norm_key(F.col(word))
    return df.filter(F.col(word).rlike(HEADWORD) & (F.length(key) > 0) & (F.length(key) <= max_len))


def blank(c: Column) -> Column:
    """Null or only white space."""
    return F.coalesce(collapse(c.cast("string")), F.lit("")) == ""


def pos_names(pos: Column) -> Column:
    """The parts of speech named in a list parted by commas, semicolons or slashes."""
    parts = F.transform(F.split(F.coalesce(pos, F.lit("")), "[,;/]"), lambda p: F.regexp_replace(F.lower(F.trim(p)), "_", " "))
    return F.filter(parts, lambda p: p != "")


def any_of(names: Column, wanted: list[str]) -> Column:
    return F.arrays_overlap(names, F.array(*[F.lit(x) for x in wanted]))


def marked(value: Column) -> Column:
    """True for 1, true, yes in any case."""
    return F.lower(F.trim(F.coalesce(value.cast("string"), F.lit("")))).isin("1", "true", "yes")


def phrase_pos(pos: Column) -> Column:
    return phrase_names(pos_names(pos))


def phrase_names(names: Column) -> Column:
    return any_of(names, PHRASE_POS) | F.exists(names, lambda p: p.endswith(" phrase"))


def is_phrase(term: Column, pos: Column) -> Column:
    """A phrase by part of speech, by a space, or by an inner hyphen."""
    return is_phrase_of(norm_key(term), phrase_pos(pos))


def is_phrase_of(value: Column, named: Column) -> Column:
    """``is_phrase`` of a normalized key and whether its part of speech names a phrase."""
    parts = F.size(F.filter(F.split(value, "-"), lambda p: p != ""))
    hyphen = value.contains("-") & ~value.startswith("-") & ~value.endswith("-") & (parts >= 2)
    return F.coalesce(named | value.contains(" ") | hyphen, F.lit(False))


def phrase_evidence(term: Column, pos: Column, sources: Column, dump_flag: Column, list_flag: Column) -> Column:
    """'' for words; for phrases the evidence joined by '+', null if there is none."""
    return phrase_evidence_of(is_phrase(term, pos), phrase_pos(pos), sources, dump_flag, list_flag)


def phrase_evidence_of(phrase: Column, named: Column, sources: Column, dump_flag: Column, list_flag: Column) -> Column:
    found = F.concat_ws(
        "+",
        F.when(named, "explicit-pos"),
        F.when(F.coalesce(F.array_contains(sources, "kaikki"), F.lit(False)) | marked(dump_flag), "kaikki-entry"),
        F.when(F.coalesce(list_flag.cast("string"), F.lit("")) == "1", "ecdict-oxford"),
    )
    return F.when(phrase, F.nullif(found, F.lit(""))).otherwise("")


def lexical_reason(value: Column, pos: Column, sources: Column, dump_flag: Column, list_flag: Column) -> Column:
    """Why a term (already a term key) is refused, null if it is fine."""
    return lexical_reason_of(value, pos_names(pos), sources, dump_flag, list_flag)


def lexical_reason_of(value: Column, names: Column, sources: Column, dump_flag: Column, list_flag: Column) -> Column:
    """``lexical_reason`` by the names of the part of speech."""
    tokens = F.split(value, " ")
    dots = any_of(names, ABBREVIATION_POS) | F.coalesce(F.array_contains(sources, "kaikki"), F.lit(False)) | marked(dump_flag) | (F.coalesce(list_flag.cast("string"), F.lit("")) == "1")
    fine = value.rlike(r"\A[a-z]+(?: [a-z]+)*\z") | F.forall(tokens, lambda t: t.rlike(PLAIN_TOKEN) | (t.contains(".") & dots & (t.rlike(INITIALISM) | t.rlike(SHORT_ABBREVIATION))))
    return (
        F.when(F.coalesce(value, F.lit("")).eqNullSafe("") | (F.length(value) > 120), "invalid_length")
        .when(any_of(names, AFFIX_POS), "affix")
        .when(value.contains("…") | value.contains(".."), "ellipsis")
        .when(value.startswith("-") | value.endswith("-") | value.contains("--"), "invalid_hyphen")
        .when(F.size(tokens) > 8, "too_many_tokens")
        .when(~fine, "unsupported_punctuation")
        .when((F.length(value) == 1) & ~value.isin("a", "i"), "single_letter_noise")
    )


def map_pos(c: Column) -> Column:
    """Part-of-speech name of a code, '' if unknown."""
    names = F.create_map(*[F.lit(x) for pair in POS_NAMES.items() for x in pair])
    return F.coalesce(names[F.lower(F.trim(c))], F.lit(""))


def bare_phonetic(c: Column) -> Column:
    return F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), "^/+|/+$", "")


def normalize_phonetic(c: Column) -> Column:
    """Older phonetic signs as IPA, without slashes."""
    return F.regexp_replace(F.translate(bare_phonetic(c), "ә:'", "əːˈ"), "ˈˈ", "ˈ")


def phonetic_unreliable(c: Column) -> Column:
    """Empty, an older sign, a broken character, or ARPABET."""
    text = bare_phonetic(c)
    return (text == "") | text.contains("ә") | text.contains(":") | text.contains("�") | text.rlike(ARPABET)


def difficulty_band(score: Column) -> Column:
    out = None
    for least, name in BANDS:
        out = F.when(score >= least, name) if out is None else out.when(score >= least, name)
    return out.otherwise(LAST_BAND)


def frequency_corrupt(c: Column) -> Column:
    """Not a number, or above 10 on the Zipf scale; null and empty are fine."""
    text = F.coalesce(F.trim(c.cast("string")), F.lit(""))
    return (text != "") & F.coalesce(text.try_cast("double") > 10, F.lit(True))


def resolved_difficulty(old: Column, old_frequency: Column, score: Column) -> Column:
    """The old band unless it is blank or stems from a corrupt frequency."""
    return F.when(blank(old) | frequency_corrupt(old_frequency), difficulty_band(score)).otherwise(old)


def fill_empty(old: Column, new: Column) -> Column:
    """struct(value, conflict): the old value unless it is blank and the new one is not; conflict where both differ."""
    both = ~blank(old) & ~blank(new)
    return F.struct(F.when(blank(old) & ~blank(new), new).otherwise(old).alias("value"), F.coalesce(both & (F.trim(old) != F.trim(new)), F.lit(False)).alias("conflict"))


def shard_filter(df: DataFrame, id_col: str, i: int, n: int, mode: str = "range", rank_cap: int | None = None) -> DataFrame:
    """Rows of shard ``i`` of ``n``: a contiguous id range, or owner = id modulo n."""
    if not 0 <= i < n:
        raise ValueError("shard out of range")
    if rank_cap is not None:
        df = df.filter(F.col("frequency_rank") <= rank_cap)
    if mode == "owner":
        return df.filter(F.pmod(F.col(id_col), F.lit(n)) == i)
    low, high = df.agg(F.min(id_col), F.max(id_col)).first()
    if low is None:
        return df
    total = high - low + 1
    return df.filter((F.col(id_col) >= low + i * total // n) & (F.col(id_col) < low + (i + 1) * total // n))


def shard_of(id_col: Column, low: Column, high: Column, n: int) -> Column:
    """Number of the contiguous shard that an id falls into."""
    return F.floor(((id_col - low + 1) * n - 1) / (high - low + 1)).cast("long")


def keep_relation_types(edges: DataFrame, column: str = "relation") -> DataFrame:
    """Edges that become related words or antonyms."""
    return edges.filter(F.col(column).isin(*RELATED_RELATIONS, "antonym"))


def words_of(c: Column) -> Column:
    """Lower-cased Latin words of a text, in order."""
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({LATIN_WORD})")), lambda w: F.lower(w))


def runs_of(words: Column, n: int) -> Column:
    """All runs of n consecutive words, joined by a space."""
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def needs_translation(source: Column, target: Column, run: int = 8) -> Column:
    """The translation is missing, not Chinese, broken, cut short, or copies a run of the source."""
    source, target = F.coalesce(collapse(source), F.lit("")), F.coalesce(collapse(target), F.lit(""))
    short = (F.length(source) > 120) & (F.length(target) < F.greatest(F.lit(20), F.floor(F.length(source) * 0.15)))
    copied = F.arrays_overlap(runs_of(words_of(source), run), runs_of(words_of(target), run))
    return (source != "") & ((target == "") | ~target.rlike(CJK) | target.contains("�") | short | F.coalesce(copied, F.lit(False)))


def quality_gaps(term: Column, definition: Column, translation: Column, us: Column, uk: Column, pos: Column) -> Column:
    """What a row still lacks, in a fixed order."""
    word = ~is_phrase(term, pos)
    gaps = F.array(
        F.when(blank(definition), "definition"),
        F.when(needs_translation(definition, translation), "definition_zh"),
        F.when(word & blank(pos), "pos"),
        F.when(word & phonetic_unreliable(us) & phonetic_unreliable(uk), "phonetic"),
    )
    return F.filter(gaps, lambda g: g.isNotNull())
