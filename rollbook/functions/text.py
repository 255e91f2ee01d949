"""Address text as column expressions.

All steps but one compile to built-in functions. Compatibility normalisation (NFKC) has no built-in;
it runs as an Arrow UDF that receives only the values holding a character NFKC could change, so plain
ASCII and ordinary CJK text never leave the JVM. Text that is ASCII throughout (told by comparing two
lengths) also takes shorter patterns without Unicode classes, at less than half the cost per row.
"""

from __future__ import annotations

import ctypes
import json
import re
import unicodedata
from collections.abc import Iterable, Sequence
from functools import cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.functions import fixed_values as fv

# Everything Unicode counts as a blank, and the four information separators.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# The separators among them that a Java `\s` leaves out.
_SEPARATORS = "\x1c\x1d\x1e\x1f"

# Full-width ASCII forms sit at a fixed distance from ASCII; two blanks that NFKC makes a space.
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "\u3000\u00a0"
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + "  "

# Text made of these characters alone is already in NFKC form: ASCII, CJK punctuation up to U+3029,
# and the CJK ideographs. tests/test_text.py checks every one of them.
NFKC_STABLE = r"\x00-\x7F\u3001-\u3029\u3400-\u9FFF"


# Bytes of normalised text that are gathered before they go into one Arrow array.
NFKC_BLOCK = 1 << 22


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


@cache
def _nfkc_udf(marks: bool):
    # A local function travels to the workers by value, so they need not have this package.
    # (pyarrow's own utf8_normalize leaves composed letters decomposed and is of no use here.)
    table = str.maketrans(fv.CJK_MARKS, fv.CJK_MARKS_ASCII) if marks else {}

    def normalise(values: pa.Array) -> pa.Array:
        # One value at a time is a Python string; the others stay bytes, however long the texts of a batch are.
        done, blocks, size = [], [], 0
        for value in values:
            value = value.as_py()
            if value is not None:
                value = unicodedata.normalize("NFKC", value)
                value = (value.translate(table) if table else value).encode()
                size += len(value)
            done.append(value)
            if size >= NFKC_BLOCK:
                blocks.append(pa.array(done, pa.binary()).cast(pa.string()))
                done, size = [], 0
        blocks.append(pa.array(done, pa.binary()).cast(pa.string()))
        del done
        found = pa.concat_arrays(blocks)
        if found.nbytes >= NFKC_BLOCK:
            del blocks
            # Workers are used again: what a batch took should not stay with them.
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
        return found

    return F.arrow_udf(normalise, T.StringType())


def strip_blanks(text: Column) -> Column:
    """Null to empty, then Unicode blanks off both ends (built-in ``trim`` removes only spaces)."""
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))


def nfkc(text: Column, marks: bool = False) -> Column:
    """Unicode NFKC; only values that may change are shipped to Python.

    With ``marks`` CJK quotes and brackets that NFKC brings about become ASCII as well.
    """
    may_change = ~is_ascii(text) & ~text.rlike(rf"\A[{NFKC_STABLE}]*+\z")
    return F.coalesce(_nfkc_udf(marks)(F.when(may_change, text)), text)


def narrow_marks(text: Column) -> Column:
    """Full-width letters, digits and punctuation, CJK quotes and brackets to ASCII; information
    separators to spaces. None of these takes part in a composition, so NFKC may come after."""
    return F.translate(
        text,
        _WIDE + fv.CJK_MARKS + _SEPARATORS,
        _NARROW + fv.CJK_MARKS_ASCII + " " * len(_SEPARATORS),
    )


def noise_patterns(care_of: str = "strict") -> list[str]:
    """The noise patterns in order; ``care_of='loose'`` keeps the care-of pattern that also matches
    inside words."""
    if care_of not in ("strict", "loose"):
        raise ValueError(f"care_of must be 'strict' or 'loose', not {care_of!r}")
    strict = care_of == "strict"
    return [
        fv.CARE_OF_STRICT if strict and p == fv.CARE_OF_LOOSE else p for p in fv.NOISE_PATTERNS
    ]


def _can_match_ascii(pattern: str) -> bool:
    """Whether anything but code points beyond ASCII is left of the pattern."""
    rest = re.sub(r"\\x\{\w+\}|\\u\w{4}", "", pattern)
    return re.search(r"[A-Za-z]|\\.", rest) is not None


def _one_regex(patterns: Sequence[str], extra: Sequence[str]) -> str:
    """One alternation. Patterns starting at a word boundary share one boundary test, which halves
    the cost; the fixed patterns of both kinds start with different characters, so none of them can
    take a match from another by coming first. Extra patterns come last."""
    anywhere = [p for p in patterns if not p.startswith(r"\b")]
    at_word = [p.removeprefix(r"\b") for p in patterns if p.startswith(r"\b")]
    return "|".join([*anywhere, rf"\b(?:{'|'.join(at_word)})", *extra])


def remove_noise(text: Column, care_of: str = "strict", extra: Sequence[str] = ()) -> Column:
    """Every match of a noise pattern to one space."""
    patterns = noise_patterns(care_of)
    of_ascii = "(?i)" + _one_regex([p for p in patterns if _can_match_ascii(p)], extra)
    of_any = "(?iU)" + _one_regex(patterns, extra)
    return F.when(is_ascii(text), F.regexp_replace(text, of_ascii, " ")).otherwise(
        F.regexp_replace(text, of_any, " ")
    )


def squeeze_commas(text: Column) -> Column:
    return F.regexp_replace(text, f"(?iU){fv.COMMA_RUN}", ", ")


def upper_floor(text: Column) -> Column:
    """Floor tokens such as ``8/f``, ``b1/f``, ``m/f`` in capitals.

    What makes a floor is the digit or letter before the slash, so the slash is looked for first.
    """
    out = F.regexp_replace(text, r"(?iU)(?<=[\dBMG])/f", "/F")
    out = F.regexp_replace(out, r"(?U)b(?=\d/F)", "B")
    for letter in "bmg":
        out = F.replace(out, F.lit(f"{letter}/F"), F.lit(f"{letter.upper()}/F"))
    return out


NESTED_CORRECTIONS = 100


def apply_corrections(text: Column, rules: Iterable[tuple[str, str]] = fv.ZH_CORRECTIONS) -> Column:
    """Literal replacements one after the other, longest wrong form first (ties keep their order).

    A few are nested calls; many are one fold over a literal array, so their number has no bound."""
    ordered = sorted(rules, key=lambda rule: len(rule[0]), reverse=True)
    if len(ordered) <= NESTED_CORRECTIONS:
        for wrong, right in ordered:
            text = F.replace(text, F.lit(wrong), F.lit(right))
        return text
    pairs = F.from_json(F.lit(json.dumps(ordered, ensure_ascii=False)), "array<array<string>>")
    return F.aggregate(pairs, text, lambda done, pair: F.replace(done, pair[0], pair[1]))


def tidy_ends(text: Column) -> Column:
    """Blank runs to one space; blanks and end marks off both ends."""
    squeezed = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    return F.trim(F.btrim(squeezed, F.lit(fv.END_MARKS)))


def clean_address(
    address: Column,
    rules: Iterable[tuple[str, str]] = fv.ZH_CORRECTIONS,
    care_of: str = "strict",
    extra_noise: Sequence[str] = (),
    normalise: bool = True,
) -> Column:
    """The cleaning chain; null gives an empty string.

    ``normalise=False`` leaves NFKC out and with it the only Python step, for columns known to
    hold no compatibility characters besides full-width forms.
    """
    text = narrow_marks(strip_blanks(address))
    if normalise:
        text = nfkc(text, marks=True)
    text = remove_noise(text, care_of, extra_noise)
    text = upper_floor(squeeze_commas(text))
    return tidy_ends(apply_corrections(text, rules))
