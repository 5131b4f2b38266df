"""Garbled text from a wrong character encoding: find it, and restore it where nothing was lost.

Method: round-trip repair.  Text is re-encoded under each legacy encoding it may
have been read with and strictly decoded as what was meant; this repeats for
nested layers, and a step is accepted when the garbling cost drops.  Multi-byte
damage is repaired run by run (a run of non-ASCII characters is self-contained
under UTF-8), single-byte damage sentence by sentence, so a field may be garbled
as a whole or in part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Encodings that UTF-8 bytes may have been read with; and of single-byte text, the one it was read with and the one meant.
READ_AS = ("cp1252", "latin-1", "mac_roman", "cp850", "cp437", "cp1251", "iso8859-15", "cp1250", "koi8_r")
READ_AS_SINGLE = tuple(
    (read, meant)
    for meant in ("cp1252", "mac_roman", "cp850")
    for read in ("cp850", "mac_roman", "cp1252", "cp437", "cp1251")
    if read != meant
)

#: Characters beyond ASCII that text in Portuguese, Spanish or English holds.
USUAL = "áàâãéêíóôõúüçñÁÀÂÃÉÊÍÓÔÕÚÜÇÑªº°“”‘’«»–—…•·©®™€£§¿¡½¼¾ ​‍﻿"
#: Letters of other Latin languages; fine by themselves, but not what a repair should make or leave.
FOREIGN = "äåæèëìîïðòöøùûýþÿßÄÅÆÈËÌÎÏÐÒÖØÙÛÝÞŸıŠšŽžŒœłŁ"
#: Symbols that stand inside a word only if the word is garbled.
_INNER = "”“‘«»–—…•·©®™€£§¿¡½¼¾ªº°¸¶¨˜ˆ˚˙˝˛ˇ¯±²³µ¹×÷¢¤¥¦¬‚„†‡ƒ‰‹›∂∑∏π∫Ω√≈≠≤≥∞◊ﬁﬂ⁄"

_UPPER = "ÁÀÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
#: What the continuation bytes of UTF-8 look like in Windows-1252 and Latin-1.
_TAIL = "\u0080-¿ŒœŠšŽžŸƒˆ˜–—‘’“”‚„†‡•…‰‹›€™"
#: Always garbled, whatever stands around: lost characters, C1 controls.
_HARD = re.compile("[�\u0080-\u009f]")
#: Box drawing draws a box unless it touches a word; an upright line may, but for one that follows a lead byte.
_BOX = "─-▟"
_BOXED = re.compile(
    f"(?<![{_BOX}])[{_BOX}]{{1,3}}(?=\\w)(?<!(?<![├┬])[│┃])|(?<=\\w)[{_BOX}]{{1,3}}(?![{_BOX}])(?<!(?<![├┬])[│┃])|[├┬][^\x00-\x7f](?![{_BOX}])|(?<![{_BOX}])[┴╔╚╩](?= [a-zà-ÿ])"
)
_COSTS = (
    (_HARD, 4.0),
    (_BOXED, 4.0),
    # A lead byte of UTF-8 with a continuation byte after it; a capital word before a closing quote is sound.
    (re.compile(f"(?<![A-ZÀ-Ý])[ÃÂ](?=[{_TAIL}])|[ÃÂ](?=[\u0080-¹»-¿ŒœŠšŽžŸƒˆ˜‚„†‡‰‹›€™])"), 3.0),
    (re.compile("â(?=[€\u0080‚])|Ã(?=[ƒ‚])|√(?=[^\\W\\d_]|[ -ÿ‰-⌀])|‚Ä(?=.)|¬(?=[∫ª°])|ÔÇ(?=.)|в(?=[Ђ‚])"), 3.0),
    (re.compile("[Ѐ-ӿ]+(?=[A-Za-z -¿“”‚„…†‡€‰‹›–—•™])|(?<=[A-Za-z])[Ѐ-ӿ]"), 3.0),
    (re.compile(f"(?<=[a-záàâãéêíóôõúüçñ])[{_UPPER}]"), 2.0),
    (re.compile(f"(?<=[^\\W\\d_])[{_INNER}](?=[^\\W\\d_])"), 2.0),
    # Letters where no language has them: ß before a word or after a consonant, þ and ð within a word, a capital as a word of its own.
    (re.compile("(?<![aeiouäöüAEIOUÄÖÜ])ß|(?<=\\w)[þð]|(?<=[a-zà-ÿ] )[ÚÈ](?= [a-zà-ÿ])|(?<= )[ìôö](?=\\w[^\n]*[îöô])"), 1.0),
    (re.compile(f"[{FOREIGN}]"), 1.0),
)
#: Whole words in Greek, Cyrillic, Hebrew, Arabic or an East Asian script are sound; only their mixture with Latin isn't.
_ODD = re.compile(f"[^\x00-\x7f{USUAL}{FOREIGN}\u0370-\u06ff\u2190-\u21ff\u2300-\u23ff\u2500-\u2fff\u3000-\ud7ff\uf900-\uffef\U00010000-\U0010ffff]")

#: JVM-side test that lets only possibly garbled fields into Python; everything the costs look at passes it.  Every
#: branch stands behind one cheap test for a character beyond ASCII, so that most characters meet no other.
SUSPECT = (
    "(?=[^\\x00-\\x7f])(?:[\ufffd\u0080-\u009f\u0100-\u017f\u0192\u02c6-\u02dd\u0370-\u058f\u201a\u201e\u2020\u2021\u2030\u2039\u203a\u2044\u2200-\u22ff\u2500-\u259f\u25ca\ufb01\ufb02"
    f"\u00a2\u00a4-\u00a6\u00a8\u00ac\u00af\u00b1-\u00b6\u00b8\u00b9\u00d7\u00f7{FOREIGN}]"
    f"|[ÃÂ](?=[^\\x00-\\x7fÀ-Ý]| |$)|(?<=[a-záàâãéêíóôõúüçñ])[{_UPPER}]|[âÔ](?=[€\u201aÇ])"
    "|(?<=\\p{L})[\u201d\u201c\u2018«»–—…•·©®™€£§¿¡½¼¾ªº°](?=\\p{L}))"
)


def cost(text: str, plain: bool = True) -> float:
    """How garbled a text looks; 0 for ordinary text.  Without ``plain`` the letters of other languages cost nothing."""
    if text.isascii():
        return 0.0
    total = 1.5 * len(_ODD.findall(text))
    for rx, weight in _COSTS if plain else _COSTS[:-1]:
        total += weight * len(rx.findall(text))
    return total


@lru_cache(maxsize=64)
def _table(encoding: str) -> dict[str, int]:
    """Characters to bytes; bytes an encoding leaves undefined are the C1 controls, as lenient readers have it."""
    table = {}
    for b in range(128, 256):
        try:
            table[bytes([b]).decode(encoding)] = b
        except UnicodeDecodeError:
            table[chr(b)] = b
    return table


_RUN = re.compile("[^\x00-\x7f]+(?:(?<=[Ã├√Г]) )?")


def _strictly(run: str, table: dict[str, int]) -> str:
    """The whole run decoded as UTF-8 under one encoding; the run itself where it can't be."""
    # à is C3 A0 under UTF-8; its no-break space may have become a plain one.
    try:
        return bytes(0xA0 if c == " " else table[c] for c in run).decode("utf-8")
    except (KeyError, UnicodeDecodeError):
        return run


def _decoded(run: str, table: dict[str, int]) -> str:
    """The run with every stretch that is a UTF-8 character under one encoding decoded; the rest stays.  One pass."""
    out, at = [], 0
    while at < len(run):
        lead = table.get(run[at], 0)
        width = 4 if lead >= 0xF0 else 3 if lead >= 0xE0 else 2 if lead >= 0xC2 else 1
        # The no-break space among the bytes of à may have become a plain one.
        data = bytes(0xA0 if c == " " else table.get(c, 0) for c in run[at : at + width])
        try:
            out.append(data.decode("utf-8") if width > 1 else run[at])
        except UnicodeDecodeError:
            out.append(run[at])
            width = 1
        at += width
    return "".join(out)


def _repair_runs(text: str) -> str:
    """Every run decoded as UTF-8 under the encoding that gives the least cost, where the cost drops."""

    def one(found: re.Match) -> str:
        run = found.group()
        before, after = text[max(0, found.start() - 2) : found.start()], text[found.end() : found.end() + 2]
        best, least = run, cost(before + run + after)
        # A run may join garbled characters and sound ones; it is taken apart only if it can't be decoded as a whole.
        for decode in (_strictly, _decoded):
            for encoding in READ_AS:
                fixed = decode(run, _table(encoding))
                if fixed != run and (now := cost(before + fixed + after)) < least:
                    best, least = fixed, now
            if best != run:
                break
        return best

    return _RUN.sub(one, text)


#: Stretches that single-byte damage may cover, the widest first.
_STRETCHES = tuple(re.compile(rx) for rx in (r"(?s).+", r"[^\n]+", r"[^\n.!?;]*[\n.!?;]*\s*", r"\S+"))


def _single_byte(text: str, read: str, meant: str) -> str | None:
    if text.isascii():
        return None
    table, out = _table(read), []
    try:
        for c in text:
            out.append(c if c < "\x80" else bytes([table[c]]).decode(meant))
    except (KeyError, UnicodeDecodeError):
        return None
    return "".join(out)


#: Characters beyond ASCII by how common they are in Portuguese; of repairs that cost the same the more common spelling wins.
_COMMON = {c: i for i, c in enumerate("ãáçéíóêúâõôà“”ÁÉÃÍÇÚ—º–ÊÓÂÔÕÀ‘’üñ")}


def _rarity(text: str) -> int:
    return sum(_COMMON.get(c, 60) for c in text if c > "\x7f")


def _repair_single(text: str) -> str:
    """The least costly of all single-byte repairs, over stretches of one width; wide ones go first."""
    best, best_cost = text, cost(text)
    for stretches in _STRETCHES:
        if not best_cost:
            break
        options = []
        for read, meant in READ_AS_SINGLE:

            def one(found: re.Match, read: str = read, meant: str = meant) -> str:
                part = found.group()
                # Letters of another language are no damage by themselves; something else must look wrong, and less so after.
                now = cost(part, plain=False)
                fixed = _single_byte(part, read, meant) if now else None
                return fixed if fixed is not None and cost(fixed, plain=False) < now and cost(fixed) < cost(part) else part

            whole = stretches.sub(one, text)
            options.append((cost(whole), _rarity(whole), whole))
        least = min(options)
        if least[0] < best_cost:
            best_cost, _, best = least
    return best


#: What remains garbled beyond doubt.
_LEFT = re.compile(
    f"[\ufffd\u0080-\u009f]|{_BOXED.pattern}|"
    "[a-záâãéêíóôõúç][ÃÂ][a-záâãéêíóôõúç]|[ÃÂ][\u00a1-\u00b9\u00bb-\u00bf]"
    "|√[\u00a0-\u00ff≠≥∫]|[ГВ][\u00a0-\u00bf]"
)


_SUSPECT = re.compile(SUSPECT.replace("\\p{L}", "[^\\W\\d_]"))


def restore(text: str | None) -> tuple[str, str | None]:
    """``(status, text)``: ``clean``, ``restored`` or ``lost`` (garbled, with characters gone for good).

    Null and empty text is clean.  A lost text comes back with those stretches
    restored that could be.
    """
    if not text or text.isascii() or not _SUSPECT.search(text):
        return "clean", text
    best = text
    # Each layer lowers the cost, so this ends.
    while cost(best):
        step = _repair_runs(best)
        if step == best:
            step = _repair_single(best)
        if step == best or cost(step) >= cost(best):
            break
        best = step
    if _LEFT.search(best):
        return "lost", best
    return ("restored" if best != text else "clean"), best


_RESULT = T.StructType().add("status", "string").add("text", "string")


@F.pandas_udf(_RESULT)
def _restore_udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([restore(t) for t in texts], columns=["status", "text"])


def suspect(text: Column) -> Column:
    """Whether a text has anything that may be garbled; decided inside Spark."""
    return F.coalesce(text.rlike(SUSPECT), F.lit(False))


def restore_fields(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key, field, status, text`` for each garbled field, ``text`` being the restored one.

    Nulls and blanks are never garbled, HTML entities are left alone; rows that
    share a key give rows that share it.
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("value")) for f in fields])
    long = df.select(F.col(f"`{key}`").alias("key"), F.explode(F.filter(pairs, lambda p: suspect(p["value"]))).alias("p"))
    done = long.select("key", F.col("p.field").alias("field"), _restore_udf(F.col("p.value")).alias("r"))
    return done.filter(F.col("r.status") != "clean").select("key", "field", "r.status", "r.text")


def found(items: DataFrame) -> DataFrame:
    """``arrival, field`` of every title, summary or body of which any stretch was decoded wrongly."""
    return restore_fields(items, "arrival", ["title", "summary", "body"]).select(F.col("key").alias("arrival"), "field")
