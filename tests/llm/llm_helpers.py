"""Small inputs that hold every awkward case, and plain-Python statements of the contracts."""

from __future__ import annotations

import random
import re

SPACE = r"[\x20\x09-\x0d]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, digest string, hash long, host string, n long"


def words(text: str | None, lower: bool = True) -> list[str]:
    text = text or ""
    return [w for w in re.split(SPACE, text.translate(LOWER) if lower else text) if w]


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    syllables = ["ta", "re", "mi", "no", "lu", "ven", "ost", "qua", "ri", "del"]
    return " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def documents(spark, texts):
    """Rows (doc_id, text) with the usual columns and some whose names clash with working columns."""
    rows = [(i, t, "en", f"s{(i or 0) % 3}", None if t is None else len(t), 7, "x", 1, "h", 2) for i, t in texts]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)


AWKWARD = [
    (1, None), (2, ""), (3, " \t\n\x0b"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "x" * 70_000),
    (8, "Äther\x0bÖl ÜBER é中文 😀"), (9, prose(1, 30_000)), (None, "no id at all here"), (10, "twice"), (10, "twice"), (10, "another text of the same id"),
]
