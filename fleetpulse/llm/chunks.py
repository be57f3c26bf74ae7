"""Pieces of a text whose encodings, put together, are the encoding of the text."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

# Code points (hexadecimal) of white space that is not plain, and of characters on which libraries disagree.
_ODD_POINTS = "0b-0c 1c-1f 85 a0 1680 180e 2000-200f 2028-202f 205f-2064 3000 feff"
_ODD = re.compile("[" + "".join("-".join(chr(int(x, 16)) for x in r.split("-")) for r in _ODD_POINTS.split()) + "]")
# Letters, digits and signs that every Unicode version classes alike and that are their own normal form.
SETTLED = re.compile(f"[\t\n\r -~{chr(0xA1)}-{chr(0xAC)}{chr(0xAE)}-{chr(0x24F)}]*")
# Lowered letters, plain white space, stops and commas.
_PLAIN = re.compile(f"[\t\n\r a-z.,{chr(0xDF)}-{chr(0xF6)}{chr(0xF8)}-{chr(0x24F)}]*")
# Where split() cuts though a library may not.
_DOUBTFUL = [chr(c) for c in (0x1C, 0x1D, 0x1E, 0x1F, 0x85)]
_SPACED_WORDS = re.compile(r"[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+")
# Plain white space behind a character that no library takes for white space.
_SURE_CUT = re.compile(_ODD.pattern.replace("[", "(?<=[^ \t\r\n", 1) + r")(?=[ \t\r\n])")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, the others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()


def style_of(tokenizer_json: str) -> str:
    """How a text may be cut for this tokenizer.

    ``dropped``: its pre-tokens never hold white space, which it removes.
    ``leading``: white space may only start a pre-token (the byte-level
    pattern). ``whole``: neither is known, so texts stay whole.
    """
    spec = json.loads(tokenizer_json)
    first = next(iter(_listed(spec.get("pre_tokenizer"), "pretokenizers")), {})
    plain_steps = all(_keeps_cuts(x) for x in _listed(spec.get("normalizer"), "normalizers"))
    glued = any(" " in x["content"] or x["lstrip"] or x["rstrip"] for x in spec.get("added_tokens") or [])
    if glued or spec.get("truncation") or spec.get("padding"):
        return "whole"
    if first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert"):
        pattern = first["pattern"].get("Regex", " ")
        return "dropped" if plain_steps and _skips_white_space(pattern) else "whole"
    plain = first.get("type") == "ByteLevel" and first.get("use_regex") and not first.get("add_prefix_space")
    return "leading" if plain and not spec.get("normalizer") else "whole"


def lowered_pre_tokens(tokenizer_json: str) -> Callable[[str], list[str]] | None:
    """Cuts lowered, settled text into the pre-tokens of a ``dropped`` tokenizer with byte letters, if it is one."""
    import regex

    spec = json.loads(tokenizer_json)
    steps = _listed(spec.get("pre_tokenizer"), "pretokenizers")
    lowers = any(x.get("type") == "Lowercase" for x in _listed(spec.get("normalizer"), "normalizers"))
    byte_level = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
    if not lowers or len(steps) != 2 or {k: steps[1].get(k) for k in byte_level} != byte_level:
        return None
    if spec["model"].get("type") != "BPE" or spec["model"].get("dropout"):
        return None
    return regex.compile(steps[0]["pattern"]["Regex"]).findall


def is_plain(text: str) -> bool:
    """Whether every stop and comma of a lowered, settled text is a pre-token of its own, and all else words."""
    return _PLAIN.fullmatch(text) is not None and not any(two in text for two in ("..", ",,", ".,", ",."))


def parted(text: str) -> tuple[str, list[str]]:
    """For a ``leading`` tokenizer: the settled pieces of a text, put together, and its other pieces.

    Pieces begin with plain white space and end before it, so the token counts of
    the joined text and of the other pieces add up to that of the whole text.
    """
    if SETTLED.fullmatch(text):
        return text, []
    settled: list[str] = []
    odd: list[str] = []
    for piece in _SURE_CUT.split(text):
        (settled if SETTLED.fullmatch(piece) else odd).append(piece)
    return "".join(settled), odd


def _listed(step: dict | None, inner: str) -> list[dict]:
    return step.get(inner, [step]) if step else []


def _keeps_cuts(step: dict) -> bool:
    """A normaliser that treats what stands on either side of a blank apart."""
    blanks = step.get("type") == "Replace" and step.get("pattern") == {"Regex": r"\s+"} and step.get("content") == " "
    return blanks or step.get("type") in ("NFC", "NFD", "Lowercase")


def _skips_white_space(pattern: str) -> bool:
    bare = pattern.replace(r"[^\s", "")
    return not any(x in bare for x in (" ", ".", "(", "[^", r"\s", r"\W", r"\D", r"\P"))


def cut(text: str, style: str) -> list[str]:
    """The chunks of a text; one chunk if it has signs that not every library takes for white space."""
    if style == "dropped" and not any(sign in text for sign in _DOUBTFUL):
        return text.split()
    if style == "leading" and not _ODD.search(text):
        return _SPACED_WORDS.findall(text)
    return [text]
