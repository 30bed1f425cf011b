"""Randomised checks of the column functions against small Python models.

One Spark job per batch of generated inputs (not one per example).
"""

import datetime as dt
import random
import re
import unicodedata

from clinilake.functions import SPANISH_MONTHS, month_text_to_date, normalize_text
from clinilake.operators.normalize import split_person_name

JAVA_SPACE = re.compile(r"[ \t\n\x0b\f\r]+")


def month_model(text):
    if text is None:
        return None
    parts = JAVA_SPACE.split(text)
    if len(parts) < 2 or parts[0] not in SPANISH_MONTHS:
        return None
    year = parts[1]
    if not re.fullmatch(r"\d{4}", year):
        return None
    return dt.date(int(year), SPANISH_MONTHS.index(parts[0]) + 1, 1)


def name_model(text):
    if text is None:
        return (None, None, None)
    tokens = [t for t in JAVA_SPACE.split(text.strip()) if t]
    if not tokens:
        return (None, None, None)
    if len(tokens) == 1:
        return (tokens[0], None, None)
    if len(tokens) == 2:
        return (tokens[0], None, tokens[1])
    if len(tokens) == 3:
        return tuple(tokens)
    return (tokens[0], tokens[1], " ".join(tokens[2:]))


def norm_model(text):
    if text is None:
        return None
    base = "".join(c for c in unicodedata.normalize("NFD", text.strip().upper())
                   if unicodedata.category(c) != "Mn")
    return unicodedata.normalize("NFC", base)


def _texts(rnd, n, alphabet, max_len):
    return [None if rnd.random() < 0.05 else "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, max_len)))
            for _ in range(n)]


def test_month_text_model(spark):
    rnd = random.Random(7)
    texts = []
    for _ in range(600):
        month = rnd.choice(SPANISH_MONTHS + ["enero", "FOO", ""])
        year = rnd.choice(["2023", "1999", "23", "20X3", "12345", ""])
        sep = rnd.choice([" ", "  ", "\t", "", " \n"])
        texts.append(rnd.choice([month + sep + year, sep + month + sep + year, month, None]))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(month_text_to_date("t")).collect()]
    assert got == [month_model(t) for t in texts]


def test_split_name_model(spark):
    rnd = random.Random(11)
    texts = _texts(rnd, 800, ["ANA", "LUZ", "DE", " ", "  ", "\t", "MARIA"], 7)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(split_person_name("t").alias("s")).select("s.*").collect()]
    assert got == [name_model(t) for t in texts]


def test_normalize_model_on_spanish_text(spark):
    rnd = random.Random(3)
    alphabet = list("abcnoyzABCNOYZ áéíóúüñÁÉÍÓÚÜÑçÇàèìòùâêîôûãõ") + ["\t", " "]
    texts = _texts(rnd, 800, alphabet, 12)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(normalize_text("t")).collect()]
    assert got == [norm_model(t) for t in texts]
