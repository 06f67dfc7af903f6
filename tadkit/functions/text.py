"""Text cleaning expressions.

Cleaning is a chain of JVM regex / translate expressions over the whole text;
token lists are Spark arrays, filtered with higher-order functions.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable
from html.entities import name2codepoint

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _accent_table() -> tuple[str, str]:
    """Every letter whose canonical decomposition is an ASCII character and
    combining marks, and that character."""
    found = []
    for code in range(0xA0, sys.maxunicode + 1):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and parts[0].isascii() and all(unicodedata.combining(c) for c in parts[1:]):
            found.append((chr(code), parts[0]))
    return "".join(a for a, _ in found), "".join(b for _, b in found)


_ACCENTED, _PLAIN = _accent_table()


def strip_accents(x) -> Column:
    """Accented letters become their ASCII letter; what is not ASCII then goes
    (NFD, then ASCII)."""
    return F.regexp_replace(F.translate(_c(x), _ACCENTED, _PLAIN), r"[^\x00-\x7F]+", "")


def clean_text(x) -> Column:
    """Strip accents, non-alphanumerics -> space, lower, collapse blanks."""
    s = strip_accents(x)
    s = F.regexp_replace(s, r"[^A-Za-z0-9]+", " ")
    return F.trim(F.lower(s))


# H14
_ENTITY = r"&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def decode_entities(x) -> Column:
    """HTML's named and numeric character references, each decoded once, from
    left to right; unknown ones stay."""
    def decode(e: Column) -> Column:
        name = F.substring(e, F.lit(2), F.length(e) - 2)
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, F.lit(3), F.length(name)), 16, 10).cast("int")) \
            .when(name.startswith("#"), F.substring(name, F.lit(2), F.length(name)).cast("int"))
        valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
        named = F.create_map(*[F.lit(v) for k, c in sorted(name2codepoint.items()) for v in (k, chr(c))])
        return F.coalesce(char, F.try_element_at(named, name), e)
    t = _c(x)
    new = F.concat(F.transform(F.regexp_extract_all(t, F.lit(_ENTITY), F.lit(0)), decode), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(F.split(t, _ENTITY, -1), new, lambda a, b: F.concat(a, b)), "")
    return F.when(t.contains("&"), joined).otherwise(t)


def strip_html(x) -> Column:
    """Visible text of an HTML page: drop script/style bodies, tags, decode entities."""
    s = F.regexp_replace(_c(x), r"(?is)<script[^>]*>.*?</script\s*>", " ")
    s = F.regexp_replace(s, r"(?is)<style[^>]*>.*?</style\s*>", " ")
    s = F.regexp_replace(s, r"(?s)<!--.*?-->", " ")
    s = F.regexp_replace(s, r"<[^>]*>", " ")
    decoded = F.element_at(F.transform(F.array(s), decode_entities), 1)      # s is worked out once
    return F.trim(F.regexp_replace(decoded, r"[\s\u00a0]+", " "))


# H15
def remove_punctuation(x) -> Column:
    return F.regexp_replace(_c(x), r"[\p{P}\p{S}]", " ")


def drop_digit_tokens(tokens) -> Column:
    """Standalone numbers as whole tokens (word-boundary rules differ between
    regex engines for accented text, so this works on the token array)."""
    return F.filter(_c(tokens), lambda t: ~t.rlike(r"^[0-9]+$"))


def remove_emails(x) -> Column:
    return F.regexp_replace(_c(x), r"\S*@\S*\s?", " ")


def remove_quotes(x) -> Column:
    return F.regexp_replace(_c(x), r"['\"‘’“”]", " ")


def collapse_blanks(x) -> Column:
    return F.trim(F.regexp_replace(_c(x), r"\s+", " "))


def tokenize(x, pattern: str = r"[^\p{L}\p{N}]+", lower: bool = True) -> Column:
    s = F.lower(_c(x)) if lower else _c(x)
    return F.filter(F.split(s, pattern), lambda t: F.length(t) > 0)


# H16
def _spark_stop_words(lang: str) -> list[str]:
    """Spark's bundled list for ``lang`` (read from the ML jar, so no running
    JVM is needed; identical to ``StopWordsRemover.loadDefaultStopWords``)."""
    import glob
    import os
    import zipfile

    import pyspark
    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    if not jars:
        return list(StopWordsRemover.loadDefaultStopWords(lang))
    with zipfile.ZipFile(jars[0]) as z:
        return z.read(f"org/apache/spark/ml/feature/stopwords/{lang}.txt").decode("utf-8").split()


def stop_words(langs: Iterable[str] = ("english",), extra: Iterable[str] = (),
               remove: Iterable[str] = ()) -> list[str]:
    """Union of Spark's built-in lists for the languages, edited."""
    words: set[str] = set()
    for lang in langs:
        words.update(_spark_stop_words(lang))
    words.update(extra)
    words.difference_update(remove)
    return sorted(words)


def remove_stop_words(tokens, words: Iterable[str]) -> Column:
    """Column form (linear scan of the list per token; fine for short lists)."""
    arr = F.array(*[F.lit(w) for w in words])
    return F.filter(_c(tokens), lambda t: ~F.array_contains(arr, t))


def drop_stop_words(df: DataFrame, tokens: str, words: Iterable[str], out: str | None = None) -> DataFrame:
    """DataFrame form through ``StopWordsRemover`` (hash-set lookup in the JVM)."""
    out = out or tokens
    tmp = "_sw_out" if out == tokens else out
    res = StopWordsRemover(inputCol=tokens, outputCol=tmp, stopWords=list(words), caseSensitive=True).transform(df)
    return res.drop(tokens).withColumnRenamed(tmp, out) if out == tokens else res


# H17
def alphabetic_only(tokens) -> Column:
    return F.filter(_c(tokens), lambda t: t.rlike(r"^\p{L}+$"))


_BROADCAST_WORDS = 50_000     # words that go to every task, at most; more are joined by word


def drop_listed_words(df: DataFrame, id_col: str, tokens: str, words: DataFrame,
                      word_col: str = "word", out: str = "tokens_kept") -> DataFrame:
    """Remove tokens found in a (possibly large) word table; the others keep their order.

    Only a row's distinct tokens are looked up, and only those found are gathered by
    ``id_col``; each row is filtered where it lies.  Rows that share an id have their tokens
    put together by position; a null id has none.
    """
    listed = words.select(F.col(word_col).alias("_tok")).distinct()
    if listed.limit(_BROADCAST_WORDS + 1).count() <= _BROADCAST_WORDS:
        listed = F.broadcast(listed)
    found = df.select(F.col(id_col).alias("_id"), F.explode(F.array_distinct(tokens)).alias("_tok")).join(listed, "_tok", "left_semi") \
        .groupBy("_id").agg(F.collect_set("_tok").alias("_listed"))
    none = F.array().cast("array<string>")
    x = df.join(found, F.col(id_col) == F.col("_id"), "left").withColumn("_listed", F.coalesce("_listed", none)) \
        .withColumn("_all", F.collect_list(tokens).over(Window.partitionBy(id_col)))
    placed = F.flatten(F.transform("_all", lambda r: F.transform(r, lambda t, i: F.struct(i.alias("_pos"), t.alias("_tok")))))
    several = F.transform(F.array_sort(F.filter(placed, lambda s: ~F.array_contains("_listed", s["_tok"]))), lambda s: s["_tok"])
    one = F.filter(F.element_at("_all", 1), lambda t: ~F.array_contains("_listed", t))
    kept = F.when(F.col(id_col).isNull() | (F.size("_all") == 0), none).when(F.size("_all") == 1, one).otherwise(several)
    return x.withColumn(out, kept).drop("_id", "_listed", "_all")


# H18
def lemmatize(df: DataFrame, id_col: str, tokens: str, lemmas: DataFrame,
              out: str = "lemmas") -> DataFrame:
    """Replace each token by its lemma from a (word, lemma) table; unknown words kept."""
    exploded = df.select(id_col, F.posexplode(tokens).alias("_pos", "word"))
    mapped = exploded.join(lemmas.select("word", "lemma"), "word", "left").select(
        id_col, "_pos", F.coalesce("lemma", "word").alias("_tok"))
    regrouped = mapped.groupBy(id_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_tok"))), lambda s: s["_tok"]).alias(out))
    return df.join(regrouped, id_col, "left")
