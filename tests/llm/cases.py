"""A small table of awkward documents, with extra columns named as result columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, kept string, spans string, _text string"
WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi "
         "chi psi omega").split()
ENDINGS = [a + b for a in "bcdfgklmnprst" for b in "aeiou"]


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(ENDINGS) for _ in range(n))


def documents(spark):
    base = prose(3, 120)
    near = base.replace(base.split()[60], "changed", 1)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "b"), (3, near, "en", "a"), (4, prose(5, 90), "de", "b"),
        (5, "", "en", "c"), (6, None, "en", "c"), (7, "x", None, None), (8, prose(11, 4000), "fr", None),
        (None, prose(2, 70), "en", "a"), (9, " \n\t ", "en", "b"), (4, prose(5, 90), "de", "b"),
        (10, "é🙂 日本 " * 30, "ja", "c"), (11, "###$ " * 80, "en", "a"), (12, "token = \"0123456789abcdef9876\" ok", "en", "a"),
    ]
    return spark.createDataFrame([(*r, len(r[1] or ""), 1, "x", "y", "z") for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
