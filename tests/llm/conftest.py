import random

import public_tokenizers
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _text string, text_sha256 string, batch long, id string, kept boolean, Shard int, _gone long, lang_pred string"


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path("word_bpe_49k.json")


def messy_rows():
    """Nulls everywhere, empty and very long texts, copies, near copies, repeated rows, clashing names."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    base = text(120).split()
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "ONE  two"), (6, "one two"), (None, "one two"), (None, None), (7, text(30_000)), (8, "é ß 漢字 😀   x\x1cy"), (9, "1234 !!"), (9, "1234 !!"), (10, "x" * 70_000)]
    for k in range(40):
        own = list(base)
        for _ in range(k % 4):
            own[r.randrange(len(own))] = word()
        rows.append((100 + k, " ".join(own)))
    rows += [(200, rows[-1][1]), (200, rows[-1][1]), (201, "Released under the MIT License.\n" + text(40)), (202, text(60) + "\nThis work is licensed under the GNU General Public License, version 3.")]
    extra = (0.5, "clash", "clash", 3, "clash", False, 4, 5, "clash")
    langs = ["en", "de", None]
    return [(i, t, langs[k % 3], f"s{k % 2}" if k % 5 else None, len(t) if t else None, *(extra if k % 2 else (None,) * len(extra))) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def rows():
    return messy_rows()


@pytest.fixture(scope="session")
def messy(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same_rows(a, b):
    return sorted(map(str, a)) == sorted(map(str, b))
