import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: extra columns whose names operators use inside or return
CLASH = (
    "score double, predicted int, held_out boolean, lines long, dropped_lines long, size string, same string, "
    "shard string, slot string, bucket string, hot string, law int, text_crc32 string, grown_shard string, "
    "key string, class_id string, links string, bin string, piece string, group string, item string, h string, "
    "d string, t string, row string, quality_score double, own_text_hash string, cluster string, total string"
)


def sentence(draw: random.Random, words: int) -> str:
    return " ".join(draw.choice("alder birch cedar dogwood elm fir ginkgo hazel ivy juniper".split()) + str(draw.randint(0, 9**6)).translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(words))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and clashing extra columns."""
    draw = random.Random(5)
    long = sentence(draw, 30_000)
    body = sentence(draw, 60)
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, "   \n\n ", "en", None, 6),
        (4, long, "en", "a", len(long)),
        (5, body, None, "a", len(body)),
        (6, body, "en", "b", len(body)),
        (6, body, "en", "b", len(body)),
        (None, body, "en", "b", len(body)),
        (None, None, "en", "b", None),
        (7, "!!! ???", "de", "c", 7),
        (8, "one", "de", "c", 3),
        (9, "one", "de", "c", 3),
        (9, "another text under the same id", "de", "c", 30),
    ]
    names = CLASH.split(", ")
    return spark.createDataFrame([r + (None,) * len(names) for r in rows], f"{DOCS}, {CLASH}")


@pytest.fixture(scope="session")
def no_docs(odd):
    return odd.where("false")
