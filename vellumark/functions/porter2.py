"""English (Porter2) stemming, after the published Snowball description.

``stem_tokens`` takes whole token arrays through Arrow. Each batch is
dictionary-encoded in parts of bounded size, so a word is stemmed once per part however often it
occurs, and nothing is shuffled. A worker holds one part's words and ``REMEMBERED`` stems.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOWELS = frozenset("aeiouy")

# Tokens that are stemmed at once, and stems that a worker remembers.
TOKENS_AT_ONCE = 200_000
REMEMBERED = 50_000

# Fixed values of the published algorithm.
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = frozenset("cdeghkmnrt")
R1_PREFIXES = ("gener", "commun", "arsen")
WHOLE_WORDS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
AFTER_STEP_1A = frozenset(
    "inning outing canning herring earring proceed exceed succeed".split()
)
STEP_2 = {
    "ization": "ize", "ational": "ate", "fulness": "ful", "ousness": "ous", "iveness": "ive",
    "tional": "tion", "biliti": "ble", "lessli": "less",
    "entli": "ent", "ation": "ate", "alism": "al", "aliti": "al", "ousli": "ous", "iviti": "ive", "fulli": "ful",
    "enci": "ence", "anci": "ance", "abli": "able", "izer": "ize", "ator": "ate", "alli": "al",
    "bli": "ble", "ogi": "og", "li": "",
}
STEP_3 = {
    "ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ative": "",
    "ical": "ic", "ness": "", "ful": "",
}
STEP_4 = (
    "ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion",
    "al", "er", "ic",
)


def _after_vowel_consonant(word: str, start: int) -> int:
    """Index just behind the first consonant that follows a vowel, from ``start``."""
    for i in range(start + 1, len(word)):
        if word[i] not in VOWELS and word[i - 1] in VOWELS:
            return i + 1
    return len(word)


def _has_vowel(part: str) -> bool:
    return not VOWELS.isdisjoint(part)


def _ends_short(part: str) -> bool:
    """Whether ``part`` ends in a short syllable."""
    if len(part) == 2:
        return part[0] in VOWELS and part[1] not in VOWELS
    return (
        len(part) > 2
        and part[-1] not in VOWELS
        and part[-1] not in "wxY"
        and part[-2] in VOWELS
        and part[-3] not in VOWELS
    )


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith(("ied", "ies")):
        return word[:-2] if len(word) > 4 else word[:-1]
    if word.endswith(("us", "ss")) or not word.endswith("s"):
        return word
    return word[:-1] if _has_vowel(word[:-2]) else word


def _past_and_gerund(word: str, r1: int) -> str:
    suffix = _longest(word, ("eedly", "ingly", "edly", "eed", "ing", "ed"))
    if suffix is None:
        return word
    base = word[: -len(suffix)]
    if suffix.startswith("eed"):
        return base + "ee" if len(base) >= r1 else word
    if not _has_vowel(base):
        return word
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if base.endswith(DOUBLES):
        return base[:-1]
    return base + "e" if r1 >= len(base) and _ends_short(base) else base


def _derivational(word: str, r1: int, r2: int) -> str:
    suffix = _longest(word, STEP_2)
    if suffix and len(word) - len(suffix) >= r1:
        base = word[: -len(suffix)]
        if (suffix != "ogi" or base.endswith("l")) and (suffix != "li" or base[-1:] in LI_ENDINGS):
            word = base + STEP_2[suffix]

    suffix = _longest(word, STEP_3)
    if suffix and len(word) - len(suffix) >= (r2 if suffix == "ative" else r1):
        word = word[: -len(suffix)] + STEP_3[suffix]

    suffix = _longest(word, STEP_4)
    if suffix and len(word) - len(suffix) >= r2:
        base = word[: -len(suffix)]
        if suffix != "ion" or base.endswith(("s", "t")):
            word = base
    return word


def _final_letter(word: str, r1: int, r2: int) -> str:
    base = word[:-1]
    if word.endswith("e") and (len(base) >= r2 or (len(base) >= r1 and not _ends_short(base))):
        return base
    if word.endswith("ll") and len(base) >= r2:
        return base
    return word


@lru_cache(maxsize=REMEMBERED)
def stem(token: str) -> str:
    if token in WHOLE_WORDS:
        return WHOLE_WORDS[token]
    if len(token) <= 2:
        return token
    word = token
    for i, letter in enumerate(token):
        if letter == "y" and (i == 0 or word[i - 1] in VOWELS):
            word = word[:i] + "Y" + word[i + 1 :]

    prefix = next((p for p in R1_PREFIXES if word.startswith(p)), None)
    r1 = len(prefix) if prefix else _after_vowel_consonant(word, 0)
    r2 = _after_vowel_consonant(word, r1)

    word = _plural(word)
    if word in AFTER_STEP_1A:
        return word
    word = _past_and_gerund(word, r1)
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in VOWELS:
        word = word[:-1] + "i"
    word = _derivational(word, r1, r2)
    return _final_letter(word, r1, r2).replace("Y", "y")


def stem_lists(tokens: pa.Array, min_length: int = 1) -> pa.Array:
    """Stem every element of a list array, one call per distinct word.

    Stems shorter than ``min_length`` are left out; a null list becomes empty.
    """
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    parts = np.cumsum(lengths) // TOKENS_AT_ONCE
    starts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(tokens)]
    stemmed = [_stemmed(tokens.slice(a, b - a), min_length) for a, b in zip(starts, starts[1:])]
    return pa.concat_arrays(stemmed)


def _stemmed(tokens: pa.Array, min_length: int) -> pa.Array:
    encoded = tokens.flatten().dictionary_encode()
    stems = [stem(word) for word in encoded.dictionary.to_pylist()]
    codes = encoded.indices.to_numpy()
    kept = np.array([len(s) >= min_length for s in stems], dtype=bool)[codes]
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    total = np.concatenate([[0], np.cumsum(kept)])
    offsets = total[np.concatenate([[0], ends])].astype("int32")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(stems, pa.string()).take(pa.array(codes[kept])))


def stem_tokens(tokens: Column, min_length: int = 1) -> Column:
    def run(batch: pa.Array) -> pa.Array:
        return stem_lists(batch, min_length)

    # Declared nondeterministic so that a filter on the stems is not pushed
    # below this step, which would run it a second time.
    return F.arrow_udf(run, T.ArrayType(T.StringType())).asNondeterministic()(tokens)
