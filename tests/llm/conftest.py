from __future__ import annotations

import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(A_TO_Z))


@pytest.fixture(scope="session")
def docs(spark):
    """Documents of every odd kind: null, empty, short, long, repeated, tied, with a clashing column."""
    base = " ".join(f"w{i % 97}x{i % 13}" for i in range(300))
    near = base.split()
    near[150] = "other"
    far = [w + "y" for w in base.split()]
    rows = [
        (1, base, "en", "a"), (2, " ".join(near), "en", "a"), (3, base.upper(), "de", None), (4, None, None, "b"), (5, "", "fr", "b"),
        (6, "   \n", "fr", None), (7, "two words", "en", "c"), (8, "Two  words", "en", "c"), (9, " ".join(far), "en", "a"),
        (9, " ".join(far), "en", "a"), (10, " ".join(far[:260]), "es", "d"), (None, base, "en", "a"), (11, "ü" * 70_000, "de", "d"),
        (12, " ".join(near[:290]), "en", "a"),
    ]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id bigint, text string, lang string, source string, shard int")
