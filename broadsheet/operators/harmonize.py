"""Harmonisation of transcriptions: rule tables compiled to one function over Arrow arrays.

A channel is a list of rules (kind, a, b): 'str' replaces a literal, 're' a pattern in Python's syntax, 'unicode' brings the text into a
normal form, 'tfm' applies another channel. White space is stripped at the end. ``sql_of`` gives the same fold as DuckDB SQL.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.session import ship

Rule = tuple[str, str, str]

# The rules of the default channel, in order.
DEFAULT: list[Rule] = [
    ("unicode", "NFC", ""),
    ("str", "⸗", "-"), ("str", "·", "-"), ("str", "¬", "-"), ("str", "—", "―"), ("str", "–", "-"), ("str", "―", "--"),
    ("str", "Ʒ", "3"), ("str", "ʒ", "3"), ("str", "ꝗ", "q"), ("str", "ꝓ", "p"), ("str", "ꝑ", "p"), ("str", "\u0364", "e"), ("str", "ꝰ", "9"), ("str", "\u1de3", "2"),
    ("str", "ν", "v"), ("str", "ꝝ", "?"), ("str", "ι", "l"), ("str", "ł", "l"), ("str", "ἀ", "ά"), ("str", "ÿ", "y"), ("str", "ꝙ", "q"), ("str", "ꝭ", "f"),
    ("str", "¶", ""), ("str", "\u0303", ""), ("str", "⁊", ""), ("str", "\u0308", ""), ("str", "\u1dd3", ""),
    ("str", "’", "'"), ("str", '"', "''"), ("str", "”", "''"), ("str", "„", "‚‚"), ("str", "“", "''"), ("str", "\u2018", "'"),
    ("re", r"([^‚\s])‚‚", r"\g<1> ‚‚"), ("re", r"‚‚\s+", "‚‚"), ("re", r"''([^'\s])", r"'' \g<1>"), ("re", r"\s+''", "''"),
    ("str", "ſ", "s"), ("str", "½", " 1/2 "), ("str", "¼", " 1/4 "), ("str", "¾", " 3/4 "), ("str", "⅔", " 2/3 "), ("str", "…", "..."),
    ("str", ":", ": "), ("str", ";", "; "), ("str", ".", ". "), ("str", ",", ", "), ("re", r"([0-9]+)\s*,\s*([0-9]+)", r"\g<1>,\g<2>"), ("str", "!", "! "), ("str", "?", "? "),
    ("re", r"\s+\:", ":"), ("re", r"\s+\;", ";"), ("re", r"\s+\.", "."), ("re", r"\s+\,", ","), ("re", r"\s+\!", "!"), ("re", r"\s+\?", "?"),
    ("re", r"\s+\)", ")"), ("re", r"\(\s+", "("),
    ("re", r"\)\s+\:", "):"), ("re", r"\)\s+\;", ");"), ("re", r"\)\s+\.", ")."), ("re", r"\)\s+\,", "),"), ("re", r"\)\s+\!", ")!"), ("re", r"\)\s+\?", ")?"),
    ("re", r"\.\s+\)", ".)"), ("re", r"\!\s+\)", "!)"), ("re", r"\?\s+\)", "?)"),
    ("re", r"\-([^\s-])", r"- \g<1>"), ("re", r"([^\s-])\-", r"\g<1> -"), ("re", r"([0-9]+)\s*\-\-\s*([0-9]+)", r"\g<1>--\g<2>"),
    ("re", r"([0-9]+)\s*--\s*([0-9]+)", r"\g<1>--\g<2>"), ("re", r"([0-9]+)\s*-\s*([0-9]+)", r"\g<1>-\g<2>"),
    ("re", r"([0-9]+)\s+%", r"\g<1>%"), ("re", r"([0-9]+)\s*,\s*([0-9]+)", r"\g<1>,\g<2>"), ("re", r"\s+", " "),
]
# The rules that the styled and the unstyled channel share, in order.
PAPER: list[Rule] = [
    ("re", r"\{\s*\[", "[{"), ("re", r"\]\s*\}", "}]"), ("str", "―", "--"), ("str", "•", "-"),
    ("str", "”", "''"), ("str", "„", "‚‚"), ("str", '"', "''"),
    ("re", r"([^‚\s])‚‚", r"\g<1> ‚‚"), ("re", r"‚‚\s+", "‚‚"), ("re", r"''([^'\s])", r"'' \g<1>"), ("re", r"\s+''", "''"),
    ("str", "½", "<1/2>"), ("str", "¼", "<1/4>"), ("str", "¾", "<3/4>"), ("str", "°", "<0 "), ("re", r"à([0-9]+)", r" à \g<1>"),
    ("str", ":", ": "), ("str", ";", "; "), ("re", r"\.\s*([^\W\d]+)", r". \g<1>"), ("re", r"([^0-9]+)\s*,\s*([^0-9]+)", r"\g<1>, \g<2>"),
    ("re", r"\!\s*([^\W\d]+)", r"! \g<1>"), ("re", r"\?\s*([^\W\d]+)", r"? \g<1>"), ("re", r"Thlr\.\s+\.", "Thlr.."),
    ("re", r"\s+\:", ":"), ("re", r"\s+\;", ";"), ("re", r"\s+\.", "."), ("re", r"\s+\,", ","), ("re", r"\s+\!", "!"), ("re", r"\s+\?", "?"),
    ("re", r"\s+\)", ")"), ("re", r"\(\s+", "("),
    ("re", r"\)\s+\:", "):"), ("re", r"\)\s+\;", ");"), ("re", r"\)\s+\.", ")."), ("re", r"\)\s+\,", "),"), ("re", r"\)\s+\!", ")!"), ("re", r"\)\s+\?", ")?"),
    ("re", r"\.\s+\)", ".)"), ("re", r"\!\s+\)", "!)"), ("re", r"\?\s+\)", "?)"),
    ("re", r"([0-9]+)\s*--\s*([0-9]+)", r"\g<1> -- \g<2>"), ("re", r"([0-9]+)\s+%", r"\g<1>%"), ("re", r"\s+", " "),
]
# Style marks taken out; style marks moved beside the words they hold.
UNSTYLED: list[Rule] = [("re", r"[{}\[\]]", ""), ("tfm", "paper", "")]
STYLED: list[Rule] = [("tfm", "paper", ""), ("re", r"([^\w]+)\]", r"]\g<1>"), ("re", r"\[([^\w]+)", r"\g<1>["), ("re", r"([^\w]+)\}", r"}\g<1>"), ("re", r"\{([^\w]+)", r"\g<1>{"), ("re", r"\s+", " ")]
CHANNELS: dict[str, list[Rule]] = {"default": DEFAULT, "paper": PAPER, "unstyled": UNSTYLED, "styled": STYLED}

# The characters each channel may give.
ALPHABETS = {
    "default": "abcdefghijklmnopqrstuvwxyzßøABCDEFGHIJKLMNOPQRSTUVWXYZæÆœäöüàáâåãéèëêẽôòóõîĩůûùũñçÄÖÜÅÊÇÙÛÚÒØ_-?!.,:; ‚'()[]<>«»/|*+=%1234567890€£§&†⏓⏑Ἰϰχεάαμꝛð",
    "unstyled": "abcdefghijklmnopqrstuvwxyzßABCDEFGHIJKLMNOPQRSTUVWXYZäöüàáâôéèêëçÄÖÜ-?!.,:; ‚'()<>/+=%*†1234567890£$§&△",
    "styled": "abcdefghijklmnopqrstuvwxyzßABCDEFGHIJKLMNOPQRSTUVWXYZäöüàáâôéèêëçÄÖÜ-?!.,:;‚' ()<>/+=%*†1234567890£$§&△{}[]",
}


def flat(channel: str, channels: dict[str, list[Rule]] | None = None) -> list[Rule]:
    """The channel's rules with those of the channels it applies put in their place; a nested channel strips too."""
    channels = channels or CHANNELS
    out: list[Rule] = []
    for rule in channels[channel]:
        out += [*flat(rule[1], channels), ("strip", "", "")] if rule[0] == "tfm" else [rule]
    return out


#: White space of any kind, as a class of patterns whose ``\\s`` knows the plain kinds only.
SPACE = r"\s\p{Z}\x{85}"
ENDS = rf"^[{SPACE}]+|[{SPACE}]+$"


def portable(pattern: str) -> str:
    """A pattern of the rules for an engine whose classes are those of ASCII."""
    p = pattern.replace(r"[^\W\d]", r"[\p{L}\p{M}_]")
    inside = re.sub(r"\[[^\]]*\]", lambda m: m[0].replace(r"\s", SPACE).replace(r"\w", r"\p{L}\p{M}\p{N}_"), p.replace(r"\[", "\x00").replace(r"\]", "\x01"))
    return re.sub(r"(?<!\[)(?<!\^)\\s(?!\\p)", lambda _: f"[{SPACE}]", inside).replace("\x00", r"\[").replace("\x01", r"\]")


def normalized(texts: pa.Array, form: str) -> pa.Array:
    """Texts in a normal form; those without any character from U+0300 on are in composed form already and are not touched."""
    odd = pc.fill_null(pc.match_substring_regex(texts, r"[^\x{00}-\x{2ff}]"), False) if form == "NFC" else pc.is_valid(texts)
    if not pc.any(odd).as_py():
        return texts
    done = pa.array([unicodedata.normalize(form, t) for t in texts.filter(odd).to_pylist()], texts.type)
    return pc.replace_with_mask(texts, odd, done)


def apply_rules(texts: pa.Array, rules: list[Rule]) -> pa.Array:
    """All rules over an Arrow array of texts, each a call for the whole array; the patterns never look back, so long texts take no longer in proportion."""
    for kind, a, b in [*rules, ("strip", "", "")]:
        if kind == "str":
            texts = pc.replace_substring(texts, a, b)
        elif kind == "re":
            texts = pc.replace_substring_regex(texts, portable(a), re.sub(r"\\g<(\d+)>", r"\\\1", b))
        elif kind == "unicode":
            texts = normalized(texts, a)
        else:
            texts = pc.replace_substring_regex(texts, ENDS, "")
    return texts


def harmonized(c: Column, channel: str = "default", channels: dict[str, list[Rule]] | None = None) -> Column:
    """``c`` after all rules of a channel, in one pass over Arrow batches. NULL stays NULL, an empty text empty."""
    rules = flat(channel, channels)
    if (spark := SparkSession.getActiveSession()) is not None:
        ship(spark)

    @F.arrow_udf(T.StringType())
    def fold(texts: pa.Array) -> pa.Array:
        return apply_rules(texts, rules)

    return fold(c)


def violations(df: DataFrame, text: str, channel: str = "default") -> DataFrame:
    """Rows of ``df`` whose text holds a character outside the channel's alphabet, with ``illegal``, the first of them."""
    rest = F.translate(F.col(text), ALPHABETS[channel], "")
    return df.withColumn("illegal", F.substring(rest, 1, 1)).filter(F.col("illegal") != "")


def sql_of(column: str, channel: str = "default") -> str:
    """The same fold as DuckDB SQL."""

    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def stripped(c: str) -> str:
        return rf"regexp_replace(regexp_replace({c}, '^[\s\p{{Z}}\x{{85}}]+', ''), '[\s\p{{Z}}\x{{85}}]+$', '')"

    c = column
    for kind, a, b in flat(channel):
        if kind == "str":
            c = f"replace({c}, {quoted(a)}, {quoted(b)})"
        elif kind == "re":
            c = f"regexp_replace({c}, {quoted(portable(a))}, {quoted(re.sub(r'\\g<(\d+)>', r'\\\1', b))}, 'g')"
        elif kind == "unicode":
            c = f"nfc_normalize({c})"
        else:
            c = stripped(c)
    return stripped(c)
