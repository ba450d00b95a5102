import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, gone string, bucket int, fp long, spans string"


def corpus() -> list[tuple[int, str | None]]:
    """Documents with every awkward case: nulls, empty and long texts, ties, copies, odd characters, secrets."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage, line = say(60), say(25)
    docs = [None, "", " \n\t", "...", "one", "One two", "été Жук 日本語\n\U0001f600 ok", "x\x1cy\x85z a b"]
    docs += [say(rnd.randint(5, 80)) for _ in range(20)]
    docs += [f"{say(10)} {passage} {say(8)}" for _ in range(6)] + [f"{say(12)}\n{line}\n{say(30)}" for _ in range(6)]
    long = say(600).split()
    docs += [" ".join(long)] * 3
    for i in range(12):
        near = list(long)
        near[i * 7] = "changed"
        docs.append(" ".join(near))
        docs.append(line.replace(line.split()[i], line.split()[i] + "x", 1) + "\n" + say(6))
    docs += [say(9000), "the " * 50, "the " * 40, "a b " * 30, line.upper(), say(40) + "\n" + "\n" + say(40)]
    key = "".join(rnd.choice("0123456789abcdef") for _ in range(40))
    free = "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(64))
    docs += [
        f'\U0001f511 password = "{free[:12]}" then token:short and secret: token=abcdefgh1',
        f"{say(5)} {key} {say(3)} AKIA{'Q7' * 8} AKIAshort API_KEY='{key}'", f"{say(30)} {free} {say(5)}", "0" * 40, "token=" * 9 + "abcdefgh",
    ]
    return list(enumerate(docs))


@pytest.fixture(scope="session")
def docs():
    return corpus()


@pytest.fixture(scope="session")
def table(spark):
    """Rows (doc_id, text) as documents with extra columns, some of names that the operators use inside."""

    def make(rows):
        full = [(d, t, "en", "s", len(t or ""), 1, "g", 2, 3, "s") for d, t in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def sf(spark, table, docs, tmp_path_factory):
    """Folder with the awkward documents and a benchmark as tables."""
    root = tmp_path_factory.mktemp("sf")
    table(docs).write.parquet(f"{root}/documents.parquet")
    rnd = random.Random(9)
    items = [(1, None), (2, ""), (3, "the"), (4, "One, two!"), (5, " ".join(docs[30][1].split()[3:40])), (6, docs[12][1]), (None, docs[13][1])]
    items += [(7, "the " * 30), (8, docs[9][1][:20]), (10, " ".join(str(rnd.random()) for _ in range(30))), (5, docs[14][1])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), items
