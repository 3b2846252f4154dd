import random

import pytest
from pyspark.sql import types as T

from lakekpi.llm.common import session

# extra columns whose names the operators use inside
CLASHES = ["id", "n", "h", "comp", "key", "row", "text_hash", "n_words", "score", "_removed2"]


@pytest.fixture(scope="session")
def llm(spark):
    return session(spark)


def frame(spark, rows, id_col="doc_id", extra=True):
    """documents-like table from (id, text) rows."""
    fields = [T.StructField(id_col, T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
              T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    fields += [T.StructField(c, T.StringType()) for c in CLASHES] if extra else []
    data = [(i, t, None, "s", None if t is None else len(t)) + (("x",) * len(CLASHES) if extra else ()) for i, t in rows]
    return spark.createDataFrame(data, T.StructType(fields))


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.paretovariate(0.7)) % vocabulary}" for _ in range(n))


@pytest.fixture(scope="session")
def awkward():
    """(id, text) rows: near copies, exact copies, repeated rows, shared passages, nulls, blanks, one long text."""
    rng = random.Random(5)
    base = prose(rng, 120)
    words = base.split()
    rows = [(1, base), (2, base), (7, None), (8, ""), (9, " \n\t "), (10, "one"), (11, "ONE"), (None, base), (None, None)]
    for i in range(20, 60):
        w = list(words)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(w)))
    passage = prose(rng, 70)
    for i in range(60, 90):
        rows.append((i, prose(rng, rng.randint(1, 80)) + " \n" + passage * (i % 3 == 0) + "\t" + prose(rng, 30)))
    rows += [(100, prose(rng, 30_000)), (101, "Éa É b ÇA K! it's 12,5"), (1, base), (60, rows[-30][1])]
    return rows
