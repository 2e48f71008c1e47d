import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, sig string, n string, length string, host string, score string, shard string, spans string, base string"


def made_texts():
    """Texts with copies, near copies, shared passages, odd characters, empty and very long ones."""
    pick = random.Random(7)
    words = [f"w{k}" for k in range(60)] + ["The", "éa", "ß", "x,", "ÀB.", "i'm", "3.14", "日本"]
    texts = [" ".join(pick.choices(words, k=pick.choice((3, 8, 30, 80)))) for _ in range(40)]
    long = texts[5].split() * 3 + pick.choices(words, k=90)
    for _ in range(12):  # near copies of one text
        own = list(long)
        own[pick.randrange(len(own))] = "changed"
        texts.append(" ".join(own))
    texts += [texts[3]] * 4 + [texts[9] + "\n" + texts[10], "", "   \n ", None, None, "one", "Two words", " ".join(pick.choices(words, k=30_000))]
    return texts


@pytest.fixture(scope="session")
def rows():
    texts = made_texts()
    made = [(k * 3, t) for k, t in enumerate(texts)]
    return made + [made[4], made[4], (None, "null id text of some words here"), (None, None)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """Documents with columns that clash with names the operators use inside."""
    df = spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), *["clash"] * 8) for i, t in rows], DOCS).repartition(3)
    return df.cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
