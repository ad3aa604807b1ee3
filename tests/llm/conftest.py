import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SYLLABLES = ["ta", "mi", "ron", "el", "sha", "ku", "ven", "or", "dis", "pla"]


@pytest.fixture(scope="session")
def store(tmp_path_factory):
    """Writes rows as a stored table and reads it back."""
    def write(spark, rows, schema, parts=3):
        path = str(tmp_path_factory.mktemp("table"))
        spark.createDataFrame(rows, schema).repartition(parts).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    return write


@pytest.fixture(scope="session")
def words():
    """Invented text of ``n`` words from a seed."""
    def text(seed, n):
        rng = random.Random(repr(seed))
        return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))
                        for _ in range(n))
    return text
