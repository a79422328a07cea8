"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

LONG = " ".join(f"w{n % 977}x" for n in range(40_000))
WORDS = ("river stone garden letter window morning silver travel music forest paper market engine bridge summer winter captain "
         "doctor mirror planet shadow copper island valley").split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int = 60, line: int = 12) -> str:
    pick = random.Random(seed)
    chosen = [pick.choice(WORDS) + str(pick.randrange(50)) for _ in range(words)]
    return "\n".join(" ".join(chosen[at:at + line]) + "." for at in range(0, words, line))


def documents(spark, extra: list[tuple] = ()):
    """Prose, copies, repeated rows, a null id, null and empty texts, a very long one."""
    rows = [(n, prose(n), "en", "src0", 1) for n in range(12)]
    rows += [(20, prose(3), "en", "src0", 1), (21, prose(3), None, None, None), (21, prose(3), None, None, None)]
    rows += [(30, None, "en", "src1", None), (31, "", "en", "src1", 0), (32, " \n\t ", "en", None, 3), (33, None, None, None, None)]
    rows += [(None, prose(40), "en", "src1", 1), (None, None, None, None, None), (40, LONG, "en", "src2", 1), (41, LONG, "en", "src2", 1)]
    return spark.createDataFrame([*rows, *extra], SCHEMA).repartition(3)


def none(spark, schema: str = SCHEMA):
    return spark.createDataFrame([], schema)
