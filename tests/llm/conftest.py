import random

import pytest

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, n_words bigint, carried string, "
          "batch int, h bigint, pos int, fp string")


def corpus(seed: int = 3) -> list[tuple]:
    """Texts with null and repeated ids, null, empty, blank and very long texts, copies, repeated lines and
    passages; the further columns have the names of results and of inner columns."""
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "aa", "aa", "Été", "été", "x|y", "##", "日本", "ends.", "DO", "do"]
    vocabulary += [f"w{i}" for i in range(60)]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passage = words(45)
    license_line = "  Licensed Under X \t"
    texts = [None, None, "", "   ", "\n", "\n\n", "one", "ONE", "One\n", "a b", "İstanbul", "i̇stanbul"]
    for i in range(40):
        lines = [" ".join(words(rng.randint(0, 14))) for _ in range(rng.randint(1, 9))]
        if i % 2:
            lines.insert(rng.randint(0, len(lines)), license_line if i % 4 == 1 else "licensed under x")
        if i % 5 == 0:
            at = rng.randint(0, 20)
            lines.append("\t".join(passage[at:]))
        texts.append("\n".join(lines))
    texts += [" ".join(["aa"] * n) for n in (4, 5, 19, 20, 21, 39, 60)]
    texts += [" ".join((["p", "q", "r"] * 40)[:n]) for n in (22, 61)]
    texts += [" ".join(passage)] * 3 + [" ".join(passage).upper()]
    texts += [" ".join(words(12_000)), "z" * 70_000, "é" * 3_000 + " " + "Z" * 100]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(i, t, "en", "s", None, -1, "c", 7, 9, 2, "f") for i, t in zip(ids, texts)]
    rows += rows[15:18]                                            # repeated rows
    rows += [(rows[20][0], "another text with the id of a row before it", None, None, None, 1, None, 1, 1, 1, None)]
    rows += [(None, t, None, None, None, None, None, None, None, None, None) for t in (None, "", "one", texts[30], texts[30])]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def small_batches(monkeypatch):
    """Many batches, so that rows have to meet across them."""
    from clipledger.llm import batches, katz, substring_dedup

    for module in (katz, substring_dedup):
        monkeypatch.setattr(module, "pack", lambda rows, tag, batch_bytes=0: batches.pack(rows, tag=tag, batch_bytes=3_000))
