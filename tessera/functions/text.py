"""Text functions: Column in, Column out, all within code generation."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F

HAN = "[\\u4e00-\\u9fff]"
# Fixed value: what is no part of a word in alignments, as a class of characters.
PUNCTUATION = r"\s，。！？、；：,.!?;:\"'“”‘’（）()【】\[\]《》<>"


def nonempty(c: Column) -> Column:
    """Null for the empty string."""
    return F.nullif(c, F.lit(""))


def first_nonempty(*columns: Column) -> Column:
    return F.coalesce(*[nonempty(c) for c in columns])


def to_float(c: Column) -> Column:
    """A double; null for null, empty and unparseable values."""
    return nonempty(F.trim(c.cast("string"))).try_cast("double")


def to_bool(c: Column, default: bool = False) -> Column:
    """1, true, yes, y, on and their opposites, in any case; the default for null, empty and other values."""
    x = F.lower(F.trim(c.cast("string")))
    return F.when(x.isin("1", "true", "yes", "y", "on"), True).when(x.isin("0", "false", "no", "n", "off"), False).otherwise(F.lit(default))


def language(c: Column, empty: str = "auto") -> Column:
    """zh if there is a Han character, else en; `empty` for null and empty text."""
    return F.when(nonempty(c).isNull(), empty).when(c.rlike(HAN), "zh").otherwise("en")


def normalized(c: Column, lang: Column) -> Column:
    """zh: letters and digits in lower case, nothing else; en: runs of a-z, 0-9 and apostrophes, joined by a space. Null is empty."""
    low = F.lower(F.coalesce(c, F.lit("")))
    zh = F.regexp_replace(low, r"[^\p{L}\p{N}]", "")
    return F.when(lang == "zh", zh).otherwise(F.array_join(F.regexp_extract_all(low, F.lit("([a-z0-9']+)"), F.lit(1)), " "))


def tokens(c: Column, lang: Column) -> Column:
    """Characters of zh text, words of other text, after normalizing."""
    n = normalized(c, lang)
    parts = F.when(lang == "zh", F.split(n, "")).otherwise(F.split(n, " "))
    return F.filter(parts, lambda x: x != "")


def text_units(c: Column, lang: Column) -> Column:
    """Han characters of zh text, words of other text."""
    zh = F.size(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({HAN})"), F.lit(1)))
    en = F.size(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("([A-Za-z0-9']+)"), F.lit(1)))
    return F.when(lang == "zh", zh).otherwise(en)


def eval_normalized(c: Column, lang: Column) -> Column:
    """The evaluation's form: zh without punctuation, symbols and white space; en runs of a-z and 0-9 joined by a space."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.when(lang == "zh", F.regexp_replace(low, r"(?U)[\p{P}\p{S}\s]", "")).otherwise(F.array_join(F.regexp_extract_all(low, F.lit("([a-z0-9]+)"), F.lit(1)), " "))


def as_symbols(words: Column, vocabulary: Column) -> Column:
    """Words as one character each, by their place in the vocabulary, so that levenshtein counts words. Code points from U+0100 on but surrogates
    stand for 1,111,806 words; a larger vocabulary raises an error."""

    def code_point(w: Column) -> Column:
        place = F.array_position(vocabulary, w) + 255
        place = F.when(place >= 0xD800, place + 0x800).otherwise(place)
        return F.lpad(F.hex(place.cast("long")), 8, "0")

    code = F.decode(F.unhex(F.array_join(F.transform(words, code_point), "")), "UTF-32")
    return F.when(F.size(vocabulary) > 0x110000 - 0x900, F.raise_error(F.lit("too many different words"))).otherwise(code)


def bound(f, *values: Column) -> Column:
    """f(*values) with each value computed once, also where f names it within a lambda."""
    one = F.array(F.struct(*[v.alias(f"v{i}") for i, v in enumerate(values)]))
    return F.get(F.transform(one, lambda s: f(*[s[f"v{i}"] for i in range(len(values))])), 0)


def word_errors(a: Column, b: Column) -> Column:
    """Edit distance between two arrays of words."""
    return bound(lambda x, y, v: F.levenshtein(as_symbols(x, v), as_symbols(y, v)), a, b, F.array_distinct(F.concat(a, b)))


def error_rate(reference: Column, hypothesis: Column, lang: Column) -> Column:
    """Edits for a character (zh) or word of the reference; 0 if both are empty, 1 if only the reference is."""
    return bound(_rate, tokens(reference, lang), tokens(hypothesis, lang), lang)


def _rate(a: Column, b: Column, lang: Column) -> Column:
    edits = F.when(lang == "zh", F.levenshtein(F.array_join(a, ""), F.array_join(b, ""))).otherwise(word_errors(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 0.0).when(F.size(a) == 0, 1.0).otherwise(edits / F.size(a))


def match_score(reference: Column, hypothesis: Column, lang: Column) -> Column:
    """1 - error rate, at least 0; null if either side has no token."""
    some = lambda a, b, lang: F.when((F.size(a) > 0) & (F.size(b) > 0), F.greatest(F.lit(0.0), 1 - _rate(a, b, lang)))
    return bound(some, tokens(reference, lang), tokens(hypothesis, lang), lang)


def slug(c: Column, default: str = "item") -> Column:
    """Letters, digits, dot, dash and underscore; other runs become one underscore; none at the ends."""
    s = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "[^A-Za-z0-9._-]+", "_"), "^_+|_+$", "")
    return F.coalesce(nonempty(s), F.lit(default))


def tagged_label(c: Column, labels: tuple[str, ...]) -> Column:
    """The first of the labels among tags written <|LABEL|>, in lower case."""
    found = F.transform(F.split(F.coalesce(c, F.lit("")), r"<\|"), lambda x: F.lower(F.split_part(x, F.lit("|>"), F.lit(1))))
    return F.get(F.filter(found, lambda x: x.isin(*labels)), 0)


def clean_transcript(c: Column) -> Column:
    """A transcript without <|tags|>, with the word mark as space and white space squeezed. Compatibility forms are left to nfkc()."""
    s = F.replace(F.regexp_replace(c, r"<\|[^>]+\|>", ""), F.lit("▁"), F.lit(" "))
    return F.trim(F.regexp_replace(s, r"(?U)\s+", " "))


def nfkc(c: Column) -> Column:
    """Compatibility composition; neither engine has it built in."""
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))

    return run(c)


def unpunctuated(c: Column) -> Column:
    """Without white space and punctuation; null is empty."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), f"(?U)[{PUNCTUATION}]+", "")


def segments(c: Column, words: tuple[str, ...]) -> Column:
    """Known words, runs of ASCII letters and digits, else single characters; white space and punctuation are dropped."""
    clean = unpunctuated(c)
    return F.regexp_extract_all(clean, F.lit(f"(?s)({'|'.join([*words, '[A-Za-z0-9]+', '.'])})"), F.lit(1))


def syllables(c: Column) -> Column:
    """Han characters, at least 1."""
    return F.greatest(F.size(F.regexp_extract_all(c, F.lit(f"({HAN})"), F.lit(1))), F.lit(1))


def picked(pool: tuple[str, ...], seed: str, key: Column) -> Column:
    """One of the pool, the same for the same seed and key, each as likely."""
    bucket = F.conv(F.substring(F.md5(F.concat(F.lit(seed), key.cast("string"))), 1, 8), 16, 10).cast("bigint")
    return F.element_at(F.array(*[F.lit(p) for p in pool]), (bucket % len(pool) + 1).cast("int"))
