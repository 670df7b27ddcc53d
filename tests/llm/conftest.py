"""Small documents with everything that an operator must survive."""
import random
import re

import pytest

LONG = 60_000
TEXT_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns named like an operator's own.
CLASH = ["_d", "_k", "row", "coded", "guess", "tk", "token", "score", "n_tokens", "n_lines", "shard", "part"]
SYLLABLES = "th er on an re he in ed nd ha at en es or nt ea ti to it st io le is ou ar as de rt ve".split()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


def odd_rows(seed=3):
    rng = random.Random(seed)
    base = prose(rng, 120)
    passage = prose(rng, 70)
    near = base.split()
    near[60] = "changed"
    texts = [base, base, " ".join(near), base.upper(), None, "", " \t\n", "...", "one two", "One  two",
             passage + ".\n" + prose(rng, 30), prose(rng, 40) + "\n" + passage + ".\n" + prose(rng, 25),
             "ab " * 300, "x" * LONG, prose(rng, LONG // 6), "line one is here\n\n  \nline two\nline one is here",
             "\n\nleading\n" + passage + "\n\n" + passage, "ñandú 日本語 😀 ▁ \u0000 \ufdd0 ß", "a\r\nb\r\n", passage]
    rows = [(i, t, ("en", "de", None)[i % 3], f"src{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[0], (None, base, "en", "src0", 1), (None, None, None, None, None), (7, prose(rng, 80), "en", "src1", 5)]


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd_rows(), TEXT_COLUMNS)
    return df.withColumns({c: F.lit("own") for c in CLASH}).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def prose_docs(spark):
    """Some hundred documents with exact and near copies, shared passages and shared lines."""
    rng = random.Random(11)
    originals = [prose(rng, rng.randint(3, 160)) for _ in range(90)]
    texts = list(originals)
    for t in originals[:40]:
        w = t.split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = prose(rng, 1)
        texts.append(" ".join(w))
    passage = prose(rng, 60)
    texts += [prose(rng, rng.randint(5, 90)) + "\n" + passage + "\n" + prose(rng, 9) for _ in range(40)]
    rng.shuffle(texts)
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], TEXT_COLUMNS).repartition(4)
