"""Text decoded with the wrong character encoding: found and restored by a table of garbled words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import checkpoint

# Encodings in which UTF-8 bytes get read by mistake.
CODECS = ("cp1252", "latin-1", "cp1251", "mac_roman", "cp437", "cp850", "cp1250", "iso8859_15", "koi8_r")
#: One wrong reading, or any two after each other; of several that give one form the first counts.
CHAINS = [(c,) for c in CODECS]
CHAINS += [(a, b) for a in CODECS[:2] for b in CODECS[:2]] + [(c, c) for c in CODECS[2:]]
CHAINS += [(a, b) for a in CODECS for b in CODECS if (a, b) not in CHAINS]
#: Characters that one character is at most after two wrong readings, each of which makes up to four, or three of those that one makes.
LONGEST_SIGN = 12
#: What Spark's xxhash64 starts from.
SEED = 42
LETTERS = r"\x{80}-\x{10FFFF}A-Za-z"
TOKEN_JAVA = rf"(?<![{LETTERS}])[A-Za-z]*[\x{{80}}-\x{{10FFFF}}][{LETTERS}]*"
TOKEN = re.compile("[A-Za-z]*[\x80-\U0010ffff][\x80-\U0010ffffA-Za-z]*")


@lru_cache(None)
def byte_chars(codec: str) -> tuple[str, ...]:
    """The character each byte is read as; a byte the encoding lacks stays a control character."""
    return tuple(bytes([b]).decode(codec, "ignore") or chr(b) for b in range(256))


@lru_cache(None)
def char_bytes(codec: str) -> dict[str, int]:
    return {c: b for b, c in reversed(list(enumerate(byte_chars(codec))))}


def garble(text: str, chain: tuple[str, ...]) -> str | None:
    """The text after its UTF-8 bytes were read in each encoding of the chain in turn."""
    for codec in chain:
        try:
            text = "".join(map(byte_chars(codec).__getitem__, text.encode()))
        except UnicodeEncodeError:
            return None
    return text


def could_be_garbled(word: str) -> bool:
    """Whether some encoding turns a part of the word into valid UTF-8 of more than one byte a character."""
    return bool(suspect().search(word))


@lru_cache(None)
def suspect() -> re.Pattern:
    """Two characters as a wrong reading of UTF-8 leaves them: for a lead byte as many continuation bytes as it needs."""
    cls = lambda chars: "[" + "".join(f"\\u{ord(x):04x}" for x in sorted(set(chars))) + "]"
    parts, leads = [], set()
    for c in CODECS:
        at = byte_chars(c)
        cont = cls(at[0x80:0xC0])
        parts += [cls(at[0xC2:0xE0]) + cont, cls(at[0xE0:0xF0]) + cont + cont, cls(at[0xF0:0xF5]) + cont * 3]
        leads |= set(at[0xC2:0xF5])
    return re.compile(f"(?={cls(leads)})(?:{'|'.join(parts)})")  # a glance at the first character settles most places


def _words(texts: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(texts, F.lit(TOKEN_JAVA), F.lit(0)))


def forms_of(word: str) -> Iterator[tuple[int, str]]:
    """(number of the chain, garbled form) of a word, under all chains."""
    once = {codec: garble(word, (codec,)) for codec in CODECS}
    for n, chain in enumerate(CHAINS):
        form = once[chain[0]] if len(chain) == 1 else once[chain[0]] and garble(once[chain[0]], chain[1:])
        if form and form != word:
            yield n, form


def _hash(text: str) -> int:
    """The hash that Spark's xxhash64 gives."""
    h = xxhash.xxh64_intdigest(text.encode(), SEED)
    return h - (1 << 64) if h >> 63 else h


def _forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(_hash(form), n, word) for word in pdf.word for n, form in forms_of(word)]
        yield pd.DataFrame(rows, columns=["hash", "chain", "original"])


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What met by its hash and really is the garbled form."""
    for pdf in batches:
        yield pdf[[garble(o, CHAINS[n]) == w for w, n, o in zip(pdf.word, pdf.chain, pdf.original, strict=True)]]


def _signs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame([(form, n, c) for c in pdf.word for n, form in forms_of(c)], columns=["part", "chain", "sign"])


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = {(w, w[i : i + n]) for w in pdf.word for i in range(len(w)) if w[i] > "\x7f" for n in range(2, min(LONGEST_SIGN, len(w) - i) + 1)}
        yield pd.DataFrame(sorted(rows), columns=["word", "part"])


def _put_right(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words whose garbled signs are put right one by one, longest first."""
    for pdf in batches:
        fixed = []
        for word, parts, signs in zip(pdf.word, pdf.parts, pdf.signs, strict=True):
            known = dict(zip(parts, signs, strict=True))
            pattern = re.compile("|".join(re.escape(s) for s in sorted(known, key=lambda s: (-len(s), s))))
            fixed.append(pattern.sub(lambda m, known=known: known[m.group()], word))
        yield pd.DataFrame({"word": pdf.word, "original": fixed})


def _substitute(texts: pd.Series, words: pd.Series, originals: pd.Series) -> pd.Series:
    out = []
    for text, ws, os in zip(texts, words, originals, strict=True):
        fix = dict(zip(ws, os, strict=True))
        out.append(TOKEN.sub(lambda m, fix=fix: fix.get(m.group(), m.group()), text))
    return pd.Series(out, dtype="object")


def restore_encoding(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(row_id, field_name, restored): each field with wrongly decoded text, restored where possible.

    Every distinct word of the corpus with a character beyond ASCII that can't itself be a wrong
    reading is clean; all its garbled forms under all chains of encodings make a table, which the
    suspicious words of the texts are joined with by hash; what meets is verified. Suspicious words
    that the corpus doesn't hold clean are put right sign by sign: their parts are joined with the
    garbled forms of the clean words' characters. `restored` is null where replacement
    characters show that something is lost for good.

    Null and plain ASCII fields are never touched; repeated rows give repeated results; other columns
    don't matter; an empty table gives an empty result. Only suspicious fields are carried past the
    first scan, and only distinct words are joined.
    """
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in fields])).alias("v")
    long = rows.select("row_id", values).select("row_id", "v.*").where(F.col("text").rlike(r"[^\x00-\x7F]"))
    words = checkpoint(
        long.select(F.explode(_words(F.col("text"))).alias("word")).distinct()
        .withColumn("odd", F.col("word").rlike(suspect().pattern) | F.col("word").contains("�"))
    )
    clean, odd = words.where("not odd").select("word"), words.where("odd").select("word")
    odd = odd.where(F.col("word").rlike(suspect().pattern))
    met = clean.mapInPandas(_forms, "hash bigint, chain int, original string").join(odd.withColumn("hash", F.xxhash64("word")), "hash").select("word", "chain", "original")
    forms = met.mapInPandas(_verified, "word string, chain int, original string")
    by_word = checkpoint(forms.groupBy("word").agg(F.min_by("original", F.struct("chain", "original")).alias("original")))
    alphabet = clean.select(F.explode(F.split("word", "")).alias("word")).where(F.ascii("word") > 127).distinct()
    signs = alphabet.mapInPandas(_signs, "part string, chain int, sign string").groupBy("part").agg(F.min_by("sign", F.struct("chain", "sign")).alias("sign"))
    held = odd.join(by_word, "word", "left_anti").mapInPandas(_parts, "word string, part string").join(signs, "part")
    held = held.groupBy("word").agg(F.collect_list(F.struct("part", "sign")).alias("known")).select("word", F.col("known.part").alias("parts"), F.col("known.sign").alias("signs"))
    by_sign = held.mapInPandas(_put_right, "word string, original string")
    fixes = by_word.unionByName(by_sign)

    # only the words beyond ASCII are looked at, a small part of the texts
    odd_words = F.filter(_words(F.col("text")), lambda w: w.rlike(suspect().pattern) | w.contains("�"))
    held = checkpoint(long.withColumn("odd", odd_words).where(F.size("odd") > 0).withColumn("key", F.monotonically_increasing_id()))
    hits = held.select("key", F.explode("odd").alias("word")).join(fixes, "word")
    hits = hits.groupBy("key").agg(F.collect_list("word").alias("words"), F.collect_list("original").alias("originals"))
    lost = F.col("text").contains("�")
    whole = held.where(~lost).join(hits, "key").select("row_id", "field_name", F.pandas_udf(_substitute, "string")("text", "words", "originals").alias("restored"))
    return whole.unionByName(held.where(lost).select("row_id", "field_name", F.lit(None).cast("string").alias("restored")))


def restored_digest(found: DataFrame) -> DataFrame:
    """(row_id, field_name, restored_md5): the md5 of the restored field, or `lost`."""
    return found.select("row_id", "field_name", F.coalesce(F.md5(F.encode("restored", "UTF-8")), F.lit("lost")).alias("restored_md5"))
