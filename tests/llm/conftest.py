"""Small tables with every awkward row the corpus operators have to take."""

from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "size int, shard string, token double, key string, word string, n int, copies string, votes int, "
    "score string, rejected int, lang_pred int, held_out string, matches string, rank int, row string, pairs int"
)
SYLLABLES = {
    "en": "the and ing tion ed er th wh sh ou re".split(),
    "de": "der und ung keit sch ein ver ge ich lich".split(),
}


def sentence(seed: int, words: int, lang: str = "en") -> str:
    dice = random.Random(seed)
    made = ("".join(dice.choice(SYLLABLES[lang]) for _ in range(dice.randint(1, 3))) for _ in range(words))
    return " ".join(made) + "."


def documents(spark, rows):
    """Rows of (doc_id, text, lang, source), with columns that clash with names used inside."""
    clashing = (1, "x", 0.5, "k", "w", 7, "c", 3, "s", 1, 2, "h", "m", 3, "r", 4)
    full = [(i, t, lang, s, None if t is None else len(t), *clashing) for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def edge_rows():
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \n\t ", None, "b"),
        (4, "one", "de", None),
        (5, "one two", "de", None),
        (6, "!!! ??? 123", "en", "b"),
        (7, "a  b \n c\r\n\td ", "en", "b"),
        (8, "▁x é ½ 漢字 😀 <|endoftext|> <s> \x00 \x85", "xx", "b"),
        (None, sentence(1, 50), "en", "a"),
        (None, sentence(1, 50), "en", "a"),
        (None, None, None, None),
        (9, sentence(2, 30_000), "en", "a"),
        (10, "x" * 100_000, "en", "a"),
        (11, sentence(3, 60), "en", "c"),
        (11, sentence(3, 60), "en", "c"),
        (11, sentence(4, 60), "en", "c"),
        (12, sentence(3, 60).upper(), "en", "c"),
        (13, "\n".join(["same line here again now"] * 40), "en", "c"),
    ]
    rows += [(100 + i, sentence(10, 80) + f" w{i % 7} end", "en", "hot") for i in range(60)]
    rows += [(200 + i, sentence(20 + i, 40, "de" if i % 3 else "en"), "de" if i % 3 else "en", f"s{i % 4}") for i in range(60)]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return documents(spark, edge_rows()).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
