import random

import pytest

from tidemark.llm.workers import ship

EXTRA = ["row", "h", "size", "source_size", "target", "node", "key", "word", "words", "part", "shard", "score",
         "lang_pred", "id", "held_out", "n", "packed", "lines", "keys", "host", "kept", "item_id", "first", "value"]


@pytest.fixture(scope="session")
def workers(spark):
    ship(spark)
    return spark


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    words = [f"{rng.choice('bdfgklmnprst')}{rng.choice('aeiou')}{i % vocabulary}" for i in rng.sample(range(10 * n + 10), n)]
    return " ".join(words)


def edited(text: str, seed: int, changes: int) -> str:
    rng = random.Random(seed)
    words = text.split()
    for i in rng.sample(range(len(words)), changes):
        words[i] = f"edit{seed}x{i}"
    return " ".join(words)


def messy_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls in every column, odd and very long texts, copies, repeated rows."""
    base = prose(1, 120)
    texts = [None, "", " \t\n\x0b\x0c\r ", "!!! ... ###", "Word", "two words", "a b c d e", base, base, edited(base, 5, 3),
             edited(base, 6, 2), "THE Cat's the cat, it's <|endoftext|> don't", "x y 　 café café İstanbul",
             "line one\nline one\nline two\n\n line one", prose(2, 60) + " " + prose(2, 60), "你好，世界 \U0001f468‍\U0001f469‍\U0001f467",
             "long " * 3000 + prose(3, 20_000, 20_000), "z" * 5000, "0 1 2 3 | 4 & 5 $$$"]
    rows = [(i, t, ("en", "fr", None)[i % 3], ("a", "b", None, "B")[i % 4], None if i % 5 == 0 else i) for i, t in enumerate(texts)]
    rows += [(None, prose(4, 30), "en", "a", 1), (None, base, None, None, None), (7, base, "en", "a", 3), (7, base, "en", "a", 3),
             (4, prose(5, 40), "fr", "a", 4)]
    rows += [(100 + i, prose(i, 30 + i % 40), "en" if i % 2 else "fr", "a" if i % 3 else "b", i) for i in range(60)]
    return rows


@pytest.fixture(scope="session")
def messy(workers):
    from pyspark.sql import functions as F
    df = workers.createDataFrame(messy_rows(), "doc_id long, text string, lang string, source string, n_chars long")
    for i, name in enumerate(EXTRA):
        df = df.withColumn(name, F.lit(i))
    return df.coalesce(3)


@pytest.fixture(scope="session")
def empty(workers):
    return workers.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
