"""Repair of text decoded with the wrong character set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Bytes 0x80-0x9f as control characters, and the characters the Windows set has there (fixed values).
CONTROLS = "".join(chr(i) for i in range(0x80, 0xA0) if i not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
GREMLINS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
# How odd a single-byte character is in running text, by weight (fixed values).
ODD = {
    1: "\u0082\u0084\u0085\u008a\u008b\u008c\u008e\u0091-\u0094\u0096\u0097\u0099-\u009c\u009e\u009f\u00a0\u00ad\u00ae\u00c3\u00d0\u00f0",
    2: "\u0080\u00a2\u00a3\u00a5\u00a7\u00a9\u00aa\u00b0\u00b1\u00b7\u00d7\u00f7",
    3: "\u0086\u0087\u0089\u0095\u00a4\u00ac\u00b2\u00b3\u00b5\u00b6\u00bc-\u00be",
    4: "\u0083\u0088\u0098\u00a6\u00a8\u00af\u00b4\u00b8-\u00ba",
    5: "\\x00-\\x08\\x0b-\\x1f\\x7f\u0081\u008d\u008f\u0090\u009d",
}
# The Windows characters in their own code points weigh half a point less than their bytes.
ODD_GREMLINS = {0.5: "‚„…Š‹ŒŽ‘’“”–—™š›œžŸ", 1.5: "€", 2.5: "†‡‰•", 3.5: "ƒˆ˜"}
SCRIPTS = {
    "latin": r"\p{IsLatin}", "cjk": r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}", "arabic": r"\p{IsArabic}",
    "cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}", "hebrew": r"\p{IsHebrew}", "devanagari": r"\p{IsDevanagari}", "thai": r"\p{IsThai}",
}
SELDOM = r"\p{IsBengali}\p{IsLao}\p{IsKhmer}\p{IsTelugu}\p{IsMalayalam}\p{IsSinhala}\p{IsTamil}\p{IsGeorgian}\p{IsArmenian}\p{IsKannada}"


# Characters that cost their length alone and are the same in every reading.
PLAIN = r"[\t\n\x20-\x7e]"


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def text_cost(text: Column) -> Column:
    """100 per error, 10 per very odd place, 1 to 5 per odd character, plus the length."""
    cost = F.length(text)
    for weight, chars in ODD.items():
        cost = cost + weight * _count(text, f"[{chars}]")
    return cost + F.when(text.rlike(r"[^\x00-\xff]"), _wide_cost(text)).otherwise(F.lit(0))


def _wide_cost(text: Column) -> Column:
    """Cost of errors, of the Windows characters and of letters from unlikely or mixed scripts."""
    known = "".join(SCRIPTS.values())
    cost = 100 * _count(text, r"[\uFFFD\p{Co}]")
    for weight, chars in ODD_GREMLINS.items():
        cost = cost + weight * _count(text, f"[{chars}]")
    for chars in SCRIPTS.values():  # a letter next to one of another script
        cost = cost + 10 * _count(text, rf"(?<=[{chars}&&\p{{L}}])[\p{{L}}&&[^{chars}\x00-\xff]]")
    cost = cost + 2 * _count(text, rf"(?<=\p{{L}})[{SELDOM}&&\p{{L}}]")
    return cost + 10 * _count(text, rf"(?<=\p{{L}})[\p{{L}}&&[^{known}{SELDOM}\x00-\xff]]")


def _as_utf8(text: Column) -> Column:
    """The characters taken as bytes of UTF-8; bytes that are none become replacement characters, which cost 100 each.

    Null without a sequence that UTF-8 could mean: then every odd byte would be an error.
    """
    likely = text.rlike("[\u00c2-\u00f4][\u0080-\u00bf]")
    return F.when(likely, F.make_valid_utf8(F.encode(text, "ISO-8859-1").cast("string")))


def _one_round(text: Column) -> Column:
    """The cheapest reading of the text; the text itself on a tie."""
    narrow = ~text.rlike(r"[^\x00-\xff]")
    windows = ~text.rlike(rf"[^\x00-\xff{GREMLINS}]")
    bytes_of = F.when(narrow, text).otherwise(F.translate(text, GREMLINS, CONTROLS))
    utf8 = F.when(windows, _as_utf8(F.when(windows, bytes_of)))
    cp1252 = F.when(narrow & text.rlike(f"[{CONTROLS}]"), F.translate(text, CONTROLS, GREMLINS))
    # one cost expression runs over the candidates, which keeps the generated code small;
    # a text without another reading is not costed at all
    readings = F.filter(F.array(text, utf8, cp1252), lambda t: t.isNotNull())
    ranked = F.transform(readings, lambda t, i: F.struct(text_cost(t).cast("double").alias("cost"), i.alias("i"), t.alias("t")))
    plain = ~text.rlike(r"[^\x00-\x7f]") | ~windows
    return F.when(plain, text).when(utf8.isNull() & cp1252.isNull(), text).otherwise(F.array_min(ranked)["t"])


def repaired(text: Column) -> Column:
    """The reading at which no round finds a better one.

    A wrong decoding makes at least two characters of each it touches, and a change of
    character set comes at most once between two decodings, so twice the logarithm of the
    length is enough rounds for any text. A settled text is passed on unread.

    A run of plain characters counts as its last one, all that the rules on neighbours
    read, so that the patterns run over the odd places alone and not over the whole text.
    """
    rounds = F.sequence(F.lit(0), (2 * F.ceil(F.log2(F.length(text) + 1)) + 1).cast("int"))
    short = F.regexp_replace(text, f"{PLAIN}+(?={PLAIN})", "")
    ends = F.transform(F.array(short), lambda s: F.struct(s.alias("s"), _settled(s, rounds).alias("t")))
    found = F.transform(ends, lambda e: F.when(e["s"] == e["t"], text).otherwise(_with_runs(e["t"], text)))
    return F.when(text.rlike(r"[^\x00-\x7f]"), F.element_at(found, 1)).otherwise(text)


def _settled(text: Column, rounds: Column) -> Column:
    start = F.struct(text.alias("t"), F.lit(False).alias("settled"))

    def step(a: Column, _: Column) -> Column:
        better = F.transform(F.array(a["t"]), _one_round)
        after = lambda t: F.struct(t.alias("t"), (t == a["t"]).alias("settled"))
        return F.when(a["settled"], a).otherwise(F.element_at(F.transform(better, after), 1))

    return F.aggregate(rounds, start, step, lambda a: a["t"])


def _with_runs(short: Column, text: Column) -> Column:
    """``short`` with the runs of plain characters that ``text`` has; no reading makes or loses a plain character."""
    odd, runs = F.split(short, PLAIN, -1), F.regexp_extract_all(text, F.lit(f"({PLAIN}+)"), 1)
    return F.array_join(F.zip_with(odd, runs, lambda o, r: F.concat(o, F.coalesce(r, F.lit("")))), "")


def repair_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replaces the named columns by their most plausible reading, however deep the wrong decodings go."""
    return df.withColumns({col: repaired(F.col(col)) for col in columns})
