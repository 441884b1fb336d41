"""Texts as arrays: code points, character classes and word hashes, block by block."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np

#: Code points of a text that are held as arrays at a time. A longer word is cut.
BLOCK = 1 << 17

#: Character classes: space, line end, lower case, upper case, digit, other letter, other sign;
#: each ASCII sign is a class of its own after these.
SPACE, LINE, LOWER, UPPER, DIGIT, LETTER, SIGN = range(7)
CLASSES = 7 + 32


@functools.cache
def word_codes() -> np.ndarray:
    """By code point: the lower-case code point of a letter or digit, else 0."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalnum():
            low = char.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


@functools.cache
def letters() -> np.ndarray:
    """By code point: 1 for a letter, else 0."""
    return np.fromiter((chr(code).isalpha() for code in range(0x110000)), dtype=np.uint32, count=0x110000)


@functools.cache
def classes() -> np.ndarray:
    """By code point: the character class."""
    out = np.full(0x110000, SIGN, dtype=np.uint8)
    signs = 0
    for code in range(0x110000):
        char = chr(code)
        if char in "\n\r":
            out[code] = LINE
        elif char.isspace():
            out[code] = SPACE
        elif char.isdigit():
            out[code] = DIGIT
        elif char.islower():
            out[code] = LOWER
        elif char.isupper():
            out[code] = UPPER
        elif char.isalpha():
            out[code] = LETTER
        elif 32 < code < 127:
            out[code] = 7 + signs
            signs += 1
    return out


@functools.cache
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64."""
    base = 0x9E3779B97F4A7C15
    both = []
    for factor in (base, pow(base, -1, 1 << 64)):
        row = np.full(BLOCK + 1, factor, dtype=np.uint64)
        row[0] = 1
        both.append(np.cumprod(row))
    return both[0], both[1]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def blocks(text: str) -> Iterator[np.ndarray]:
    """The code points of the whole text, cut between words where there is such a place."""
    at = 0
    while at < len(text):
        codes = code_points(text[at:at + BLOCK])
        if at + BLOCK < len(text):
            gaps = np.flatnonzero(word_codes()[codes] == 0)
            if gaps.size:
                codes = codes[:gaps[-1] + 1]
        yield codes
        at += len(codes)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def word_hashes(codes: np.ndarray, prefixes: tuple[int, ...] = ()) -> list[np.ndarray]:
    """64-bit hashes of the words of one block, and of their first letters for each prefix length.

    A word is a run of letters and digits, in lower case. Words no longer than a prefix have
    no hash for it.
    """
    folded = word_codes()[codes]
    edges = np.flatnonzero(np.diff(folded != 0, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    up, down = powers()
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(folded.astype(np.uint64) * up[:len(codes)], out=sums[1:])
    out = [mixed((sums[ends] - sums[starts]) * down[starts])]
    for length in prefixes:
        long = starts[ends - starts > length]
        out.append(mixed((sums[long + length] - sums[long]) * down[long] + np.uint64(length)))
    return out
