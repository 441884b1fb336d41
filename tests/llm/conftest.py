from __future__ import annotations

import pytest

#: NULLs, empty and blank texts, a word, copies and a row that is there twice.
AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (None, "no id here at all"), (5, "the same text twice"),
           (6, "the same text twice"), (6, "the same text twice"), (7, "é ß İ 漢字 \U0001F600 ok"), (8, "x" * 300_000),
           (9, "many words " * 30_000)]


@pytest.fixture(scope="session")
def awkward() -> list[tuple]:
    return list(AWKWARD)


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return "/root/testdata/sf0.01"
