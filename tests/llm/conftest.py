import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use inside, to clash with
CLASH = {"row": "'x'", "shard": "7", "size": "-1", "key": "'k'", "bucket": "3", "node": "'n'", "n": "9", "tokens": "1",
         "word": "'w'", "_row": "'r'", "slot": "5", "component": "'c'", "target": "0.5", "pass": "1"}


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(["Alder", "birch", "cedar", "DOUGLAS", "elm", "fir", "ginkgo", "hazel", "ivy"])
                    + rng.choice("abcdefgh") + str(rng.randrange(3)) for _ in range(n))


def corpus(seed: int = 3) -> list[tuple]:
    """Nulls, empty and blank texts, ties, repeated rows, copies, near copies and a very long text."""
    rng = random.Random(seed)
    rows = []
    base = [prose(rng, rng.randrange(6, 60)) for _ in range(30)]
    for i, t in enumerate(base):
        rows.append((i, t, "en", f"s{i % 4}", len(t)))
    for i in range(12):                                            # copies and near copies
        w = base[i].split(" ")
        rows.append((100 + i, base[i], "en", "s1", None))
        w[rng.randrange(len(w))] = "changed"
        rows.append((200 + i, " ".join(w) + " and more", "de", None, 5))
    hot = base[5] + "\nshared line of text\n  Shared LINE of text \n\nlast"
    rows += [(300 + i, hot, "en", "s0", len(hot)) for i in range(25)]
    rows += [(400, None, None, None, None), (401, "", "en", "s2", 0), (402, " \t\n ", "en", "s2", 4), (403, "one two", "fr", "s3", 7),
             (404, "two\r\n words\x0b", "fr", "s3", 9), (405, "ONE two", "fr", "s3", 7), (None, base[7], "en", "s1", 1), (None, None, None, None, None)]
    long = prose(rng, 30_000)
    rows += [(500, long, "en", "s0", len(long)), (501, long + " x", "en", "s0", len(long))]
    rows += [rows[0], rows[0], (0, base[9], "en", "s1", 3), (600, "ünï çödé \U0001F642 " + base[3], "es", "s2", 3)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    return docs.selectExpr("*", *[f"{v} AS `{k}`" for k, v in CLASH.items()])
